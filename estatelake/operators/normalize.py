"""Raw scraper items to canonical listings: column steps of one job.

Input: ``raw`` (the item as JSON text) and what the landing adds. An item that
no source claims, or that has no id, goes to quarantine and to no other table.
"""

from __future__ import annotations

import hashlib
import json
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelake.functions.columns import deal_type_of, number, per_sqm, whole
from estatelake.operators.geo import with_region

#: Names of categories, and words that tell them apart in Slovak texts, in order of precedence.
CATEGORIES = {"byty": "apartment", "byt": "apartment", "apartment": "apartment", "domy": "house", "dum": "house", "house": "house", "pozemky": "land", "pozemek": "land", "land": "land", "komercni": "commercial", "commercial": "commercial"}
TEXT_CATEGORIES = [
    ("commercial", r"nebytov|kancelár|kancelar|obchodn|sklad|prevádzk|prevadzk|komerč|komerc|reštaurác|restaurac|priemyseln"),
    ("apartment", r"\bbyt\w*|\bizb|garzón|garzon|garsón|garson|apartmán|apartman|mezonet"),
    ("house", r"rodinn\w*\s+dom|\bdom\b|domček|domcek|chat\w*|chalup|\bvila\b|novostavb"),
    ("land", r"pozemok|pozemk|parcel|záhrad|zahrad|orn\w*\s+pôd"),
]


#: Fixed names of what the job reads of an item.
FIELDS = ["url", "source", "listingId", "id", "dealType", "propertyType", "title", "locality", "city", "district", "rooms", "areaSqm", "latitude", "longitude", "price", "currency", "images", "scrapedAt", "category", "name", "pricePerSqm", "layout", "floorArea", "landArea", "lat", "lon", "imageUrl", "estateType", "offerType", "disposition", "address", "surface", "surfaceLand", "coordinates", "mainImage", "publicImages", "priceRaw", "content", "locationName"]


#: Of a normalised item: a source claims it, and it has an id.
GOOD = "source IS NOT NULL AND source_listing_id IS NOT NULL"


def category_of(value: F.Column) -> F.Column:
    key = F.lower(F.trim(value))
    table = F.create_map(*[F.lit(x) for pair in CATEGORIES.items() for x in pair])
    return F.coalesce(table[key], F.nullif(key, F.lit("")))


def category_in_text(title: F.Column, content: F.Column) -> F.Column:
    def first(text):
        out = F.lit(None).cast("string")
        for name, pattern in reversed(TEXT_CATEGORIES):
            out = F.when(text.rlike(f"(?iuU){pattern}"), name).otherwise(out)
        return out

    return F.coalesce(first(title), first(content))


def layout_of(value: F.Column) -> F.Column:
    raw, up = F.trim(value), F.upper(F.trim(value))
    code = F.regexp_extract(up, r"^DISP_(\d+)_(KK|1)$", 1)
    kind = F.when(F.regexp_extract(up, r"^DISP_(\d+)_(KK|1)$", 2) == "KK", "+kk").otherwise("+1")
    return F.when(up.isin("GARSONIERA", "DISP_STUDIO"), "1+kk").when(up.isin("DISP_ATYPICAL", "ATYPICAL"), "atypical").when(up.isin("UNDEFINED", "OSTATNI", ""), None).when(code != "", F.concat(code, kind)).otherwise(raw)


def prague(locality: F.Column) -> F.Column:
    return F.regexp_replace(locality, r"\bPrague\b", "Praha")


def prague_district(locality: F.Column) -> F.Column:
    """'Praha 5', else 'Praha - Name', else 'Praha'; null outside of it."""
    text = prague(locality)
    numbered, named = F.regexp_extract(text, r"Praha\s+(\d{1,2})\b", 1), F.trim(F.regexp_extract(text, r"Praha\s*[-–]\s*(\p{L}[\p{L}\p{N}_ -]+)", 1))
    return F.when(numbered != "", F.concat(F.lit("Praha "), numbered)).when(named != "", F.concat(F.lit("Praha - "), named)).when(text.contains("Praha"), "Praha")


def price_in_text(text: F.Column) -> F.Column:
    """The first run of digits and spaces; less than 100 is no price."""
    digits = F.regexp_replace(F.regexp_extract(text, r"(\d[\d\s\x{A0}\x{202F}]*)", 1), r"\D", "")
    value = F.nullif(digits, F.lit("")).try_cast("long")
    return F.when(value >= 100, value)


def area_in_text(text: F.Column) -> F.Column:
    found = F.transform(F.regexp_extract_all(text, F.lit(r"(?iu)(\d+(?:[.,]\d+)?)\s*m\s*[²2]"), F.lit(1)), lambda x: F.replace(x, F.lit(","), F.lit(".")).try_cast("double"))
    return F.get(F.filter(found, lambda x: x.between(8, 2000)), F.lit(0))


def rooms_in_text(title: F.Column) -> F.Column:
    n = F.replace(F.regexp_extract(title, r"(?iu)(\d+(?:[.,]\d+)?)\s*-?\s*izb", 1), F.lit(","), F.lit("."))
    return F.when(title.rlike("(?iu)garzón|garzon|garsón|garson"), "1-izb").when(n != "", F.concat(F.regexp_replace(n, r"\.0$", ""), F.lit("-izb")))


def deal_type_in_text(title: F.Column, content: F.Column, price: F.Column) -> F.Column:
    def word(text):
        t = F.lower(F.coalesce(text, F.lit("")))
        rent, buy = t.rlike("prenaj|prenáj"), t.rlike("predaj|predá|predam")
        return F.when(rent & ~buy, "rent").when(buy & ~rent, "buy")

    return F.coalesce(word(title), F.when(price >= 15000, "buy").when(price <= 4000, "rent"), word(content))


def image_urls(*arrays: F.Column) -> F.Column:
    """All non-empty URLs, each once, in order."""
    return F.array_distinct(F.filter(F.flatten(F.array(*[F.coalesce(a, F.array().cast("array<string>")) for a in arrays])), lambda x: F.coalesce(F.trim(x) != "", F.lit(False))))


def _digests(raw: pd.Series) -> pd.Series:
    def digest(text):
        try:
            return hashlib.sha256(json.dumps(json.loads(text), sort_keys=True, ensure_ascii=False).encode("utf-8", "surrogatepass")).hexdigest()
        except (TypeError, ValueError, RecursionError):
            return None

    return raw.map(digest)


def content_hash(raw: F.Column) -> F.Column:
    """SHA-256 of an item with its keys in order, so that the order in which they landed doesn't count; null if it is no JSON."""
    return F.pandas_udf(_digests, "string")(raw)


def normalize_listings(raw: DataFrame, run_time: datetime, raw_col: str = "raw", towns: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Returns (listings, quarantine).

    towns: (town, district, region, lat, lon): the town of a classified advert
    gives its district and its point.
    """
    out = normalized_items(raw, run_time, raw_col, towns)
    return out.filter(GOOD), out.filter(f"NOT ({GOOD})").select(*raw.columns, F.when(F.col("source").isNull(), "unknown source").otherwise("no id").alias("reason"))


def normalized_items(raw: DataFrame, run_time: datetime, raw_col: str = "raw", towns: DataFrame | None = None) -> DataFrame:
    """A row for each item as ``normalize_listings`` has it; those for which ``GOOD`` doesn't hold belong to quarantine."""
    none = F.lit(None).cast("string")
    # Each item is parsed once; what is nested stays text. Blank is missing.
    g = lambda name: F.nullif(F.col("_item")[name], F.lit(""))
    inner = lambda name, path: F.nullif(F.get_json_object(F.col("_item")[name], f"$.{path}"), F.lit(""))
    has = lambda key: F.array_contains(F.col("_keys"), key)
    url = g("url")
    source = F.when(F.lower(url).contains("reality.bazos.sk"), "bazos").when(F.lower(g("source")) == "bezrealitky", "bezrealitky").when(g("listingId").isNotNull(), "sreality").when(url.contains("bezrealitky.cz"), "bezrealitky")
    rich = F.coalesce(has("estateType") | has("disposition") | has("coordinates"), F.lit(False))
    shape = F.when((source == "bezrealitky") & rich, "rich").otherwise(source)
    by = lambda **c: F.coalesce(*[F.when(F.col("_shape") == k, v) for k, v in c.items()], F.lit(None))
    # A list of texts or of objects with a url.
    linked = lambda path: F.transform(F.from_json(g(path), "array<string>"), lambda x: F.when(x.startswith("{"), F.get_json_object(x, "$.url")).otherwise(x))
    url_id = F.nullif(F.regexp_extract(url, r"/(\d+)-", 1), F.lit(""))
    run = F.lit(run_time).cast("timestamp")
    # A generator's row is computed once: the filters at the end would else move below and parse the item anew for each field that they look at.
    parsed = F.struct(F.from_json(raw_col, ", ".join(f"{x} string" for x in FIELDS)).alias("_item"), F.json_object_keys(raw_col).alias("_keys"))
    df = raw.select("*", F.inline(F.array(parsed))).withColumn("source", source).withColumn("_shape", shape)
    df = df.withColumn("price", by(sreality=whole(g("price")), bezrealitky=whole(g("price")), rich=whole(g("price")), bazos=price_in_text(g("priceRaw"))))
    df = df.withColumn("floor_area", by(sreality=number(g("areaSqm")), bezrealitky=number(g("floorArea")), rich=F.nullif(number(g("surface")), F.lit(0.0)), bazos=area_in_text(g("content"))))
    locality = by(sreality=g("locality"), bezrealitky=F.coalesce(g("locality"), g("name")), rich=prague(g("address")), bazos=g("locationName"))
    stated = by(sreality=deal_type_of(g("dealType"), F.lit("")), bezrealitky=deal_type_of(none, url), rich=deal_type_of(g("offerType"), url), bazos=deal_type_in_text(g("title"), g("content"), F.col("price")))
    card = inner("mainImage", "url")
    gallery = by(sreality=image_urls(linked("images")), bezrealitky=image_urls(F.array(g("imageUrl"))), rich=F.when(F.size(image_urls(linked("publicImages"))) > 0, image_urls(linked("publicImages"))).otherwise(image_urls(F.array(card))), bazos=image_urls(F.array(g("imageUrl"))))
    df = df.withColumn("images", gallery).withColumn("locality", locality)
    if towns is None:
        df = df.withColumns({"town_district": none, "town_lat": F.lit(None).cast("double"), "town_lon": F.lit(None).cast("double")})
    else:
        df = with_region(df, towns, "locality")
    zero = lambda c: F.nullif(c, F.lit(0.0))
    kind = by(sreality=g("propertyType"), bezrealitky=g("category"), rich=g("estateType"))
    return df.select(
        *raw.columns, "source", by(sreality=g("listingId"), bezrealitky=F.coalesce(url_id, g("id")), rich=F.coalesce(url_id, g("id")), bazos=g("id")).alias("source_listing_id"), by(sreality=url, bezrealitky=repaired_url(url), rich=repaired_url(url), bazos=url).alias("url"),
        F.coalesce(stated, F.lit("buy")).alias("deal_type"), stated.isNull().alias("deal_type_inferred"), F.coalesce(by(bazos=category_in_text(g("title"), g("content"))), category_of(kind)).alias("category"), kind.alias("source_category"),
        by(sreality=g("title"), bezrealitky=g("name"), rich=F.col("locality"), bazos=g("title")).alias("name"), "locality", by(sreality=g("city"), bazos=F.col("locality")).alias("city"),
        by(sreality=F.coalesce(g("district"), prague_district(F.col("locality"))), bezrealitky=prague_district(F.col("locality")), rich=prague_district(F.col("locality")), bazos=F.col("town_district")).alias("district"),
        by(sreality=layout_of(g("rooms")), bezrealitky=layout_of(g("layout")), rich=layout_of(g("disposition")), bazos=rooms_in_text(g("title"))).alias("layout"), "floor_area", by(bezrealitky=number(g("landArea")), rich=zero(number(g("surfaceLand")))).alias("land_area"),
        by(sreality=zero(number(g("latitude"))), bezrealitky=zero(number(g("lat"))), rich=zero(number(inner("coordinates", "lat"))), bazos=F.col("town_lat")).alias("lat"), by(sreality=zero(number(g("longitude"))), bezrealitky=zero(number(g("lon"))), rich=zero(number(F.coalesce(inner("coordinates", "lng"), inner("coordinates", "lon")))), bazos=F.col("town_lon")).alias("lon"),
        by(sreality=F.get("images", F.lit(0)), bezrealitky=g("imageUrl"), rich=F.coalesce(card, F.get("images", F.lit(0))), bazos=g("imageUrl")).alias("image_url"), "images",
        by(sreality=g("currency"), bezrealitky=F.lit("CZK"), rich=F.coalesce(g("currency"), F.lit("CZK")), bazos=F.lit("EUR")).alias("currency"), "price",
        F.coalesce(by(bezrealitky=F.nullif(number(g("pricePerSqm")), F.lit(0.0))), per_sqm(F.col("price"), F.col("floor_area"))).alias("price_per_sqm"),
        by(sreality=F.coalesce(F.try_to_timestamp(g("scrapedAt")), run), bezrealitky=run, rich=F.coalesce(F.try_to_timestamp(g("scrapedAt")), run), bazos=run).alias("scraped_at"), content_hash(F.col(raw_col)).alias("content_hash"),
    )


def repaired_url(url: F.Column, host: str = "bezrealitky.cz", segment: str = "/nemovitosti-byty-domy/") -> F.Column:
    """Puts a missing path segment behind the host; again is no change."""
    broken = url.contains(host) & ~url.contains(segment)
    return F.when(broken, F.regexp_replace(url, rf"({host.replace('.', '[.]')})/", f"$1{segment}")).otherwise(url)


def backfilled_deal_type(stored: F.Column, url: F.Column, raw: F.Column) -> F.Column:
    """The stored deal type, else the URL's, else the raw item's, else buy."""
    payload = deal_type_of(F.coalesce(F.get_json_object(raw, "$.dealType"), F.get_json_object(raw, "$.offerType")), F.lit(""))
    return F.coalesce(stored, deal_type_of(F.lit(None).cast("string"), url), payload, F.lit("buy"))


def universal_log(*logs: DataFrame) -> DataFrame:
    """Logs of single sources as one; columns that one lacks are null."""
    out = logs[0]
    for x in logs[1:]:
        out = out.unionByName(x, allowMissingColumns=True)
    return out
