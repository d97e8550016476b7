"""Raw scraper items made from the driver's events, and the whole normalising job over them, with its SQL.

An item's shape is its event_id modulo 6: four shapes of sources, one that no
source claims, one without an id. Each field takes one of a few values by the
event's number, so that all combinations of rules occur.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import functions as F

from estatelake.operators import normalize
from estatelake.plans.domain import places, table
from estatelake.plans.registry import query
from estatelake.sources import io
from estatelake.sources.shared import keep, scratch

RUN = datetime(2026, 6, 19, 6, tzinfo=UTC)
#: Values of the fields; the number says how fast they change with the event.
CHOICES = {
    "dealType": (1, ["buy", "Prodej", " RENT ", "pronájem", "swap", None]), "propertyType": (5, ["byty", "Domy", "land", "Garage", None, "komercni"]), "locality": (1, ["Praha 5 - Smíchov", "Prague 12", "Praha - Karlín, ulice", "Brno", "Praha", "x Praha 103", None]),
    "city": (1, ["Praha", None]), "district": (1, [None, "D1", ""]), "rooms": (3, ["2+kk", "DISP_3_KK", "disp_4_1", "GARSONIERA", "OSTATNI", "DISP_ATYPICAL", " 1+1 ", None]), "area": (2, ["50", "63.5", "abc", "", "0", None, "77"]), "lat": (1, ["50.07", "0", None, "-1.5"]), "lon": (1, ["14.4", "0.0", "x"]),
    "price": (4, ["7990000", "12000.7", "n/a", None, "0", "55"]), "currency": (1, ["CZK", "EUR", None]), "scrapedAt": (1, ["2026-06-18T05:54:36.168Z", "2026-06-18T07:54:36+02:00", "garbage", None]), "segment": (1, ["nemovitosti-byty-domy/", ""]), "slug": (1, ["-nabidka-pronajem", "-nabidka-prodej", "/detail"]),
    "perSqm": (1, ["419", "0", None, "x", "88.25"]), "place": (1, ["Prague 3", "", None, "Praha – Žižkov"]), "land": (1, ["120", "", None, "0"]), "image": (1, ["u", None, ""]), "offer": (1, ["PRONAJEM", "PRODEJ", None, "x"]), "address": (1, ["Ke Štvanici, Prague - Karlín", "Brno", None, "Praha 7"]), "main": (1, ["m", None, ""]),
    "title": (1, ["Na predaj 3-izbový byt", "Prenájom garsónky", "Rodinný dom", "Pozemok pri lese", "Nebytový priestor", "Novostavba 1,5-izb", "Predaj aj prenájom", "Chata 2,0 izby", None]), "priceRaw": (1, ["178 000 €", "Dohodou", "6 €", "1 199 €", None, "700", "9 000"]),
    "content": (1, ["pekný, Výmera: 63,5 m2", "1500000 m2 a 45 m²", "predaj domu", "na prenájom", "obchodný register", None, "byt 5 m2"]), "town": (1, ["ALGERIA", "brazil", "Nikde", None, "Peru"]),
}


def _pick(name):
    k, values = CHOICES[name]
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), (F.floor(F.col("event_id") / 6) * k % len(values) + 1).cast("int"))


def raw_items(spark, sf):
    """(event_id, raw)"""
    # Items are much larger than their numbers: a file's few row groups would be as few tasks.
    e = table(spark, sf, "events").select("event_id").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    n, id_ = F.floor(F.col("event_id") / 6), F.col("event_id").cast("string")
    link = F.concat(F.lit("https://www.bezrealitky.cz/"), _pick("segment"), id_, _pick("slug"))
    item = lambda **fields: F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]))
    some = lambda values, count: F.slice(F.array(*map(F.lit, values)), F.lit(1), count.cast("int"))
    shapes = [
        item(listingId=F.col("event_id"), url=F.concat(F.lit("https://www.sreality.cz/d/"), id_), dealType=_pick("dealType"), propertyType=_pick("propertyType"), title=F.concat(F.lit("T"), id_), locality=_pick("locality"), city=_pick("city"), district=_pick("district"), rooms=_pick("rooms"), areaSqm=_pick("area"), latitude=_pick("lat"), longitude=_pick("lon"), price=_pick("price"), currency=_pick("currency"), images=some(("u1", "u2", "u1", ""), n % 5), scrapedAt=_pick("scrapedAt")),
        item(id=F.col("event_id"), source=F.lit("Bezrealitky"), url=link, category=_pick("propertyType"), name=F.lit("Byt Praha 9"), price=_pick("price"), pricePerSqm=_pick("perSqm"), locality=_pick("place"), layout=_pick("rooms"), floorArea=_pick("area"), landArea=_pick("land"), lat=_pick("lat"), lon=_pick("lon"), imageUrl=_pick("image")),
        item(id=F.col("event_id"), url=link, estateType=_pick("propertyType"), offerType=_pick("offer"), disposition=_pick("rooms"), address=_pick("address"), surface=_pick("area"), surfaceLand=_pick("land"), price=_pick("price"), currency=_pick("currency"), coordinates=F.struct(_pick("lat").alias("lat"), _pick("lon").alias("lng")), mainImage=F.struct(_pick("main").alias("url")), publicImages=F.transform(some(("p1", "p2", "p1"), n % 4), lambda x: F.struct(x.alias("url"))), scrapedAt=_pick("scrapedAt")),
        item(id=F.col("event_id"), url=F.concat(F.lit("https://Reality.bazos.sk/inzerat/"), id_), title=_pick("title"), priceRaw=_pick("priceRaw"), content=_pick("content"), locationName=_pick("town"), imageUrl=_pick("image")),
        item(foo=F.col("event_id"), url=F.lit("https://other.example/")),
        item(source=F.lit("bezrealitky"), url=F.lit("https://www.bezrealitky.cz/"), estateType=_pick("propertyType")),
    ]
    return e.withColumn("raw", F.element_at(F.array(*shapes), (F.col("event_id") % 6 + 1).cast("int")))


def towns(spark, sf):
    p = places(spark, sf)
    return p.select(F.col("district").alias("town"), F.concat(F.lit("d "), "district").alias("district"), "region", (F.col("place_no") + 0.25).alias("lat"), (F.col("place_no") + 0.5).alias("lon"))


def normalized(spark, sf):
    return normalize.normalize_listings(raw_items(spark, sf), RUN, towns=towns(spark, sf))


# --- the same rules as SQL --------------------------------------------------


def _sql(name):
    k, values = CHOICES[name]
    listed = ", ".join("NULL" if v is None else "'" + v + "'" for v in values)
    return f'CAST([{listed}][event_id // 6 * {k} % {len(values)} + 1] AS VARCHAR) AS "{name}"'


def _number(x):
    return f"TRY_CAST(nullif(trim({x}), '') AS DOUBLE)"


def _prague(x):
    t = f"regexp_replace({x}, '\\bPrague\\b', 'Praha', 'g')"
    named = f"trim(regexp_extract({t}, 'Praha\\s*[-–]\\s*(\\pL[\\pL\\pN_ -]+)', 1))"
    number = f"regexp_extract({t}, 'Praha\\s+(\\d{{1,2}})\\b', 1)"
    return f"CASE WHEN {number} <> '' THEN 'Praha ' || {number} WHEN {named} <> '' THEN 'Praha - ' || {named} WHEN contains({t}, 'Praha') THEN 'Praha' END"


_LAYOUT = "CASE WHEN upper(trim(rooms)) = 'GARSONIERA' THEN '1+kk' WHEN upper(trim(rooms)) = 'DISP_ATYPICAL' THEN 'atypical' WHEN upper(trim(rooms)) = 'OSTATNI' THEN NULL WHEN regexp_matches(upper(trim(rooms)), '^DISP_\\d+_KK$') THEN regexp_extract(rooms, '\\d+') || '+kk' WHEN regexp_matches(upper(trim(rooms)), '^DISP_\\d+_1$') THEN regexp_extract(rooms, '\\d+') || '+1' ELSE trim(rooms) END"
_KIND = "CASE lower(\"propertyType\") WHEN 'byty' THEN 'apartment' WHEN 'domy' THEN 'house' WHEN 'komercni' THEN 'commercial' ELSE lower(\"propertyType\") END"
_AT = "CASE \"scrapedAt\" WHEN '2026-06-18T05:54:36.168Z' THEN epoch_us(TIMESTAMP '2026-06-18 05:54:36.168') WHEN '2026-06-18T07:54:36+02:00' THEN epoch_us(TIMESTAMP '2026-06-18 05:54:36') ELSE epoch_us(TIMESTAMP '2026-06-19 06:00:00') END"
_RUN_AT = "epoch_us(TIMESTAMP '2026-06-19 06:00:00')"


def _text_kind(x):
    words = [("commercial", "nebytov|kancelár|kancelar|obchodn|sklad|prevádzk|prevadzk|komerč|komerc|reštaurác|restaurac|priemyseln"), ("apartment", "\\bbyt\\w*|\\bizb|garzón|garzon|garsón|garson|apartmán|apartman|mezonet"), ("house", "rodinn\\pL*\\s+dom|\\bdom\\b|domček|domcek|chat\\w*|chalup|\\bvila\\b|novostavb"), ("land", "pozemok|pozemk|parcel|záhrad|zahrad|orn\\w*\\s+pôd")]
    return "CASE " + " ".join(f"WHEN regexp_matches({x}, '(?i){p}') THEN '{k}'" for k, p in words) + " END"


def _text_deal(x):
    rent, buy = f"regexp_matches(lower(coalesce({x}, '')), 'prenaj|prenáj')", f"regexp_matches(lower(coalesce({x}, '')), 'predaj|predá|predam')"
    return f"CASE WHEN {rent} AND NOT {buy} THEN 'rent' WHEN {buy} AND NOT {rent} THEN 'buy' END"


_BAZOS_PRICE = "CASE WHEN TRY_CAST(regexp_replace(regexp_extract(\"priceRaw\", '\\d[\\d ]*'), ' ', '', 'g') AS BIGINT) >= 100 THEN TRY_CAST(regexp_replace(regexp_extract(\"priceRaw\", '\\d[\\d ]*'), ' ', '', 'g') AS BIGINT) END"
_BAZOS_AREA = "list_filter(list_transform(regexp_extract_all(coalesce(content, ''), '(?i)(\\d+(?:[.,]\\d+)?)\\s*m\\s*[²2]', 1), lambda x: TRY_CAST(replace(x, ',', '.') AS DOUBLE)), lambda x: x BETWEEN 8 AND 2000)[1]"
_ROOMS = "CASE WHEN regexp_matches(title, '(?i)garzón|garzon|garsón|garson') THEN '1-izb' WHEN regexp_extract(title, '(?i)(\\d+(?:[.,]\\d+)?)\\s*-?\\s*izb', 1) <> '' THEN regexp_replace(replace(regexp_extract(title, '(?i)(\\d+(?:[.,]\\d+)?)\\s*-?\\s*izb', 1), ',', '.'), '\\.0$', '') || '-izb' END"
_LINK = "'https://www.bezrealitky.cz/nemovitosti-byty-domy/' || event_id || slug"
_URL_DEAL = "CASE WHEN contains(slug, 'pronajem') THEN 'rent' WHEN contains(slug, 'prodej') THEN 'buy' END"
_Z = lambda x: f"nullif({_number(x)}, 0)"
_WHOLE = f"CAST(trunc({_number('price')}) AS BIGINT)"

NORMAL = f"""e AS (SELECT event_id, CAST(event_id AS VARCHAR) AS k, {', '.join(map(_sql, CHOICES))} FROM events), u AS (
  SELECT event_id, 'sreality' AS source, k AS source_listing_id, 'https://www.sreality.cz/d/' || k AS url, CASE lower(trim("dealType")) WHEN 'buy' THEN 'buy' WHEN 'prodej' THEN 'buy' WHEN 'rent' THEN 'rent' WHEN 'pronájem' THEN 'rent' END AS stated, {_KIND} AS category, "propertyType" AS source_category, 'T' || k AS name, locality, city,
    coalesce(nullif(district, ''), {_prague('locality')}) AS district, {_LAYOUT} AS layout, {_number('area')} AS floor_area, CAST(NULL AS DOUBLE) AS land_area, {_Z('lat')} AS lat, {_Z('lon')} AS lon, CASE WHEN event_id // 6 % 5 > 0 THEN 'u1' END AS image_url, CASE event_id // 6 % 5 WHEN 0 THEN '' WHEN 1 THEN 'u1' ELSE 'u1,u2' END AS images, currency, {_WHOLE} AS price, NULL AS given, {_AT} AS scraped_us FROM e WHERE event_id % 6 = 0
  UNION ALL SELECT event_id, 'bezrealitky', k, {_LINK}, {_URL_DEAL}, {_KIND}, "propertyType", 'Byt Praha 9', coalesce(nullif(place, ''), 'Byt Praha 9'), NULL, {_prague("coalesce(nullif(place, ''), 'Byt Praha 9')")}, {_LAYOUT}, {_number('area')}, {_number('land')}, {_Z('lat')}, {_Z('lon')}, nullif(image, ''), coalesce(nullif(image, ''), ''), 'CZK', {_WHOLE}, {_Z('"perSqm"')}, {_RUN_AT} FROM e WHERE event_id % 6 = 1
  UNION ALL SELECT event_id, 'bezrealitky', k, {_LINK}, coalesce(CASE offer WHEN 'PRONAJEM' THEN 'rent' WHEN 'PRODEJ' THEN 'buy' END, {_URL_DEAL}), {_KIND}, "propertyType", replace(address, 'Prague', 'Praha'), replace(address, 'Prague', 'Praha'), NULL, {_prague('address')}, {_LAYOUT}, {_Z('area')}, {_Z('land')}, {_Z('lat')}, {_Z('lon')},
    coalesce(nullif(main, ''), CASE WHEN event_id // 6 % 4 > 0 THEN 'p1' END), CASE event_id // 6 % 4 WHEN 0 THEN coalesce(main, '') WHEN 1 THEN 'p1' ELSE 'p1,p2' END, coalesce(currency, 'CZK'), {_WHOLE}, NULL, {_AT} FROM e WHERE event_id % 6 = 2
  UNION ALL SELECT event_id, 'bazos', k, 'https://Reality.bazos.sk/inzerat/' || k, coalesce({_text_deal('title')}, CASE WHEN {_BAZOS_PRICE} >= 15000 THEN 'buy' WHEN {_BAZOS_PRICE} <= 4000 THEN 'rent' END, {_text_deal('content')}), coalesce({_text_kind('title')}, {_text_kind('content')}), NULL, title, town, town, 'd ' || n_name, {_ROOMS}, {_BAZOS_AREA}, NULL, n_nationkey + 0.25, n_nationkey + 0.5, nullif(image, ''), coalesce(image, ''), 'EUR', {_BAZOS_PRICE}, NULL, {_RUN_AT} FROM e LEFT JOIN nation ON lower(n_name) = lower(town) WHERE event_id % 6 = 3),
nl AS (SELECT * EXCLUDE (stated, given) REPLACE (CAST(price AS DOUBLE) AS price), coalesce(stated, 'buy') AS deal_type, stated IS NULL AS deal_type_inferred, coalesce(given, CASE WHEN price <> 0 AND floor_area <> 0 THEN CAST(round(CAST(price / floor_area AS DECIMAL(18,6)), 2) AS DOUBLE) END) AS price_per_sqm FROM u)"""


@query("n_normalize_listings", f"WITH {NORMAL} SELECT * FROM nl")
def _(spark, sf):
    good, _ = normalized(spark, sf)
    return good.withColumns({"images": F.array_join("images", ","), "price": F.col("price").cast("double"), "scraped_us": F.unix_micros("scraped_at")}).drop("raw", "content_hash", "scraped_at")


@query("n21_quarantine", "SELECT CASE event_id % 6 WHEN 4 THEN 'unknown source' ELSE 'no id' END AS reason, count(*) AS n, min(event_id) AS first FROM events WHERE event_id % 6 >= 4 GROUP BY ALL")
def _(spark, sf):
    return normalized(spark, sf)[1].groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first"))


@query("n20_content_hash", """SELECT event_id, sha256(CASE event_id % 3 WHEN 0 THEN '{"a": ' || user_id || ', "b": {"x": "é", "y": ' || event_id || '}}' WHEN 1 THEN '{"a": [1, 2.5, null, true], "k": "' || event_type || '"}' ELSE '"plain"' END) AS content_hash FROM events""")
def _(spark, sf):
    """Items whose keys landed in another order; hashes are over the order of the keys."""
    e, i = table(spark, sf, "events"), F.col("event_id").cast("string")
    raw = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit('{"b":{"y":'), i, F.lit(',"x":"é"},"a":'), F.col("user_id").cast("string"), F.lit("}"))).when(F.col("event_id") % 3 == 1, F.concat(F.lit('{"k":"'), "event_type", F.lit('", "a":[1,2.5,null,true]}'))).otherwise('"plain"')
    return e.select("event_id", normalize.content_hash(raw).alias("content_hash"))


@query("s6_raw_log", f"WITH {NORMAL} SELECT 'r1' AS run_id, source, source_listing_id, url, scraped_us, 2 AS times FROM nl")
def _(spark, sf):
    """The raw log after two runs over the same items: rows are only ever added."""
    good, _ = normalized(spark, sf)
    path = scratch(spark, "raw-log")
    rows = keep(io.raw_rows(good, "r1"), "raw-rows")
    io.append_raw(rows, path)
    io.append_raw(rows, path)
    log = spark.read.parquet(path)
    return log.groupBy("run_id", "source", "source_listing_id", "url", F.unix_micros("scraped_at").alias("scraped_us")).agg(F.count(F.lit(1)).cast("int").alias("times"))
