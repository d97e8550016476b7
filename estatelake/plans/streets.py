"""Streets in texts and their points, as queries with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from estatelake.operators import geo
from estatelake.operators.streets import street_of
from estatelake.plans.domain import places, table
from estatelake.plans.registry import query

#: What is planted in texts that name no street: the words, and what they name (street, spellings, house number).
SAID = [
    ("Zrub je hneď voľný, ulica Kvetná 8/14b, tiché miesto", "Kvetná", ["Kvetná"], "8/14b"),
    ("Topoľová ulica pri starom mlyne", "Topoľová", ["Topoľová"], None),
    ("chata stojí v Lipovskej ulici", "Lipovskej", ["Lipovská", "Lipovska", "Lipovskej"], None),
    ("garáž (námestie Mierových Dohôd 2) s vrátami", "námestie Mierových Dohôd", ["námestie Mierových Dohôd", "Mierových Dohôd"], "2"),
    ("obchod pri ul. Pod Brehom RUŠNÁ križovatka", "Pod Brehom", ["Pod Brehom"], None),
    ("kancelária na ulici M.R. Vetra. Voľná od mája", "M.R. Vetra", ["M.R. Vetra"], None),
    ("prízemie, Novej Hornej ul. a záhrada", "Hornej", ["Horná", "Horna", "Hornej"], None),
    ("starý ul. bez mena", None, None, None),
]


def planted(spark, sf, name: str, key: str, text: str):
    """(key, title, content): the first line and the whole text; of four rounds of rows one gets a mention in its title, one at the end of its content."""
    rows = table(spark, sf, name)
    said, n = F.element_at(F.array(*[F.lit(x[0]) for x in SAID]), (F.col(key) % len(SAID) + 1).cast("int")), F.floor(F.col(key) / len(SAID)) % 4
    title = F.regexp_extract(text, r"^([^\n]*)", 1)
    return rows.select(key, F.when(n == 0, F.concat_ws("; ", title, said)).otherwise(title).alias("title"), F.when(n == 1, F.concat_ws("; ", text, said)).otherwise(F.col(text)).alias("content"))


_W = r"\p{L}\p{M}\p{Nd}\p{Pc}"
_NAME = rf"[A-ZÀ-Ž][{_W}.\-À-ž]*(?:\s+[A-ZÀ-Ž][{_W}.\-À-ž]*)*"
_EDGE, _NO = rf"(?:^|[^{_W}])", r"(?:\s+(\d{1,4}(?:/\d{1,4})?[a-zA-Z]?))?"
_FORMS = [rf"{_EDGE}(?:[Uu]l\.|[Uu]lic[aiou])\s+({_NAME}){_NO}", rf"{_EDGE}({_NAME})\s+(?:ul\.|ulic[aiue](?:$|[^{_W}]))", rf"{_EDGE}(?:[Nn]ám\.|[Nn]ámestie|[Nn]ámestí)\s+({_NAME}){_NO}"]


def _quoted(x) -> str:
    return "NULL" if x is None else "'" + x.replace("'", "''") + "'"


def streets_sql(name: str, key: str, text: str) -> str:
    """The three forms in both texts, each cleaned word by word, the first that has a name."""
    said = f"[{', '.join(_quoted(x[0]) for x in SAID)}]"
    spelt = ", ".join(f"({_quoted(s)}, {_quoted('|'.join(c))})" for _, s, c, _ in SAID if s)
    found = " UNION ALL ".join(f"SELECT {key}, {3 * i + f} AS nth, {f} AS form, regexp_extract({t}, '{_FORMS[f]}', ['n'{', ' + repr('h') if f != 1 else ''}]).n AS n, {'NULL' if f == 1 else f'''regexp_extract({t}, '{_FORMS[f]}', ['n', 'h']).h'''} AS h FROM tx" for i, t in enumerate(("title", "content")) for f in range(3))
    stops = "['na', 'pri', 'v', 'vo', 'byt', 'izbový', 'izb', 'novej', 'tejto']"
    return f"""tx AS (SELECT {key}, CASE WHEN {key} // {len(SAID)} % 4 = 0 THEN concat_ws('; ', title, {said}[{key} % {len(SAID)} + 1]) ELSE title END AS title, CASE WHEN {key} // {len(SAID)} % 4 = 1 THEN concat_ws('; ', {text}, {said}[{key} % {len(SAID)} + 1]) ELSE {text} END AS content FROM (SELECT {key}, {text}, regexp_extract({text}, '^([^\\n]*)', 1) AS title FROM {name})),
fo AS ({found}), wo AS (SELECT *, string_split_regex(n, '\\s+') AS w FROM fo WHERE n <> ''),
cu AS (SELECT *, w[:least(coalesce(list_filter(range(1, len(w) + 1), lambda i: w[i] LIKE '%.' AND NOT regexp_full_match(w[i], '(?:[A-ZÀ-Ž]\\.)+'))[1], len(w)), coalesce(list_filter(range(2, len(w) + 1), lambda i: length(w[i]) >= 3 AND upper(w[i]) = w[i])[1] - 1, len(w)))] AS c FROM wo),
st AS (SELECT *, CASE WHEN form = 1 THEN c[coalesce(list_filter(range(1, len(c) + 1), lambda i: NOT list_contains({stops}, lower(c[i])))[1], len(c) + 1):] ELSE c END AS k FROM cu),
na AS (SELECT {key}, nth, form, nullif(h, '') AS h, rtrim(array_to_string(k, ' '), ' ,.:;–-') AS name FROM st), fi AS (SELECT {key}, arg_min({{'form': form, 'name': name, 'h': h}}, nth) AS f FROM na WHERE length(name) >= 3 GROUP BY {key}),
sn AS (SELECT {key}, CASE WHEN f.form = 2 THEN 'námestie ' ELSE '' END || f.name AS street, f.h AS house_number FROM fi), sp AS (SELECT * FROM (VALUES {spelt}) v(street, candidates))"""


for _query, _table, _key, _text in (("x1_streets_in_texts", "documents", "doc_id", "text"), ("x1_street_mentions", "pages", "page_id", "html")):

    @query(_query, f"WITH {streets_sql(_table, _key, _text)} SELECT t.{_key}, sn.street, candidates, house_number FROM tx t LEFT JOIN sn USING ({_key}) LEFT JOIN sp USING (street)")
    def _(spark, sf, name=_table, key=_key, text=_text):
        return planted(spark, sf, name, key, text).select(key, street_of(F.col("title"), F.col("content")).alias("s")).select(key, "s.street", F.array_join("s.candidates", "|").alias("candidates"), "s.house_number")


# --- points -----------------------------------------------------------------

#: Customers: half of them in one street, the others round the earth, up to the pole and over the date line; suppliers likewise, some without a name.
_FAR = "SELECT c_custkey AS point_id, CASE WHEN c_custkey % 2 = 0 THEN 48.1 + (c_custkey % 97) / 1e6 WHEN c_custkey % 3 = 0 THEN 80.0 + (c_custkey % 31) / 1000.0 ELSE 48.1 + (c_custkey % 89) / 1000.0 END AS lat, CASE WHEN c_custkey % 2 = 0 THEN 17.1 + (c_custkey % 83) / 1e6 WHEN c_custkey % 3 = 0 THEN CASE WHEN c_custkey % 4 = 1 THEN 179.99 + (c_custkey % 10) / 1000.0 ELSE -179.99 - (c_custkey % 10) / 1000.0 END ELSE 17.1 + (c_custkey % 79) / 1000.0 END AS lon FROM customer"
_POI = "SELECT s_suppkey AS place_id, CASE WHEN s_suppkey % 4 > 0 THEN s_name END AS name, CASE s_suppkey % 3 WHEN 0 THEN 48.1 WHEN 1 THEN 80.0 + (s_suppkey % 29) / 1000.0 ELSE 48.1 + (s_suppkey % 71) / 1000.0 END AS p_lat, CASE s_suppkey % 3 WHEN 0 THEN 17.1 WHEN 1 THEN CASE WHEN s_suppkey % 2 = 0 THEN 179.995 ELSE -179.995 END ELSE 17.1 + (s_suppkey % 67) / 1000.0 END AS p_lon, CASE WHEN s_suppkey % 2 = 0 THEN 'parks' ELSE 'transport' END AS category FROM supplier"


@query("j14_nearest_named", f"WITH c AS ({_FAR}), s AS ({_POI}), d AS (SELECT *, 2 * 6371000.0 * asin(sqrt(least(pow(sin(radians(p_lat - lat) / 2), 2) + cos(radians(lat)) * cos(radians(p_lat)) * pow(sin(radians(p_lon - lon) / 2), 2), 1.0))) AS m FROM c, s WHERE name IS NOT NULL) SELECT point_id, category, arg_min(place_id, (m, place_id)) AS place_id, arg_min(name, (m, place_id)) AS name FROM d WHERE m <= 3000 GROUP BY ALL")
def _(spark, sf):
    """Half of all points in one cell, the others up to 80 degrees and on both sides of the date line."""
    k, i = F.col("s_suppkey"), F.col("c_custkey")
    dateline = F.when(i % 4 == 1, 179.99 + (i % 10) / 1000).otherwise(-179.99 - (i % 10) / 1000)
    lat = F.when(i % 2 == 0, 48.1 + (i % 97) / 1e6).when(i % 3 == 0, 80.0 + (i % 31) / 1000).otherwise(48.1 + (i % 89) / 1000)
    lon = F.when(i % 2 == 0, 17.1 + (i % 83) / 1e6).when(i % 3 == 0, dateline).otherwise(17.1 + (i % 79) / 1000)
    points = table(spark, sf, "customer").select(i.alias("point_id"), lat.alias("lat"), lon.alias("lon"))
    p_lat = F.when(k % 3 == 0, 48.1).when(k % 3 == 1, 80.0 + (k % 29) / 1000).otherwise(48.1 + (k % 71) / 1000)
    p_lon = F.when(k % 3 == 0, 17.1).when(k % 3 == 1, F.when(k % 2 == 0, 179.995).otherwise(-179.995)).otherwise(17.1 + (k % 67) / 1000)
    held = table(spark, sf, "supplier").select(k.alias("place_id"), F.when(k % 4 > 0, F.col("s_name")).alias("name"), p_lat.alias("lat"), p_lon.alias("lon"), F.when(k % 2 == 0, "parks").otherwise("transport").alias("category"))
    return geo.nearest_place(points, held, 3000.0).select("point_id", "category", "place_id", "name")


_GZ = "SELECT s_suppkey, 'Cesta ' || (s_suppkey % 40) AS street, n_name AS town, CASE WHEN s_suppkey % 3 > 0 THEN CAST(s_suppkey % 4 AS VARCHAR) END AS number, 48 + (s_suppkey % 60) / 100.0 AS lat, CASE WHEN s_suppkey % 11 = 0 THEN 15.0 ELSE 17.0 + (s_suppkey % 50) / 100.0 END AS lon FROM supplier JOIN nation ON n_nationkey = s_nationkey"


@query("j15_ranked_streets", f"""WITH gz AS ({_GZ}), m AS (SELECT c_custkey AS id, ['Cesta ' || (c_custkey % 40), 'Cesta ' || (c_custkey % 7)] AS candidates, CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey % 4 AS VARCHAR) END AS hn, n_name AS town, CASE WHEN c_custkey % 5 > 0 THEN 48.3 END AS tlat, CASE WHEN c_custkey % 5 > 0 THEN 17.2 END AS tlon FROM customer JOIN nation ON n_nationkey = c_nationkey),
u AS (SELECT id, hn, town, tlat, tlon, unnest(candidates) AS cand, generate_subscripts(candidates, 1) AS nth FROM m),
h AS (SELECT u.*, number IS NOT NULL AS house, lat, lon FROM u JOIN gz ON gz.town = u.town AND gz.street = cand AND (number IS NULL OR number = hn) WHERE lat BETWEEN 47.7 AND 49.65 AND lon BETWEEN 16.8 AND 22.6 AND (tlat IS NULL OR sqrt(pow((lat - tlat) * 111.0, 2) + pow((lon - tlon) * 111.0 * cos(radians(tlat)), 2)) <= 25)),
b AS (SELECT id, arg_min({{'cand': cand, 'lat': lat, 'lon': lon, 'house': house}}, (nth, NOT house, lat, lon)) AS g FROM h GROUP BY id)
SELECT m.id, coalesce(g.cand, candidates[1]) AS street, CAST(g.lat AS DOUBLE) AS geo_lat, CAST(g.lon AS DOUBLE) AS geo_lon, CASE WHEN g IS NOT NULL THEN 'street' END AS geo_precision, CASE g.house WHEN TRUE THEN 'house' WHEN FALSE THEN 'street' END AS matched FROM m LEFT JOIN b USING (id)""")
def _(spark, sf):
    """Mentions with and without numbers, towns without a point, and hits outside the box."""
    town = places(spark, sf).select("place_no", F.col("district").alias("town"))
    k, c = F.col("s_suppkey"), F.col("c_custkey")
    road = lambda n: F.concat(F.lit("Cesta "), n.cast("string"))
    gazetteer = table(spark, sf, "supplier").join(F.broadcast(town), F.col("s_nationkey") == F.col("place_no")).select(road(k % 40).alias("street"), "town", F.when(k % 3 > 0, (k % 4).cast("string")).alias("number"), (48 + (k % 60) / 100).alias("lat"), F.when(k % 11 == 0, 15.0).otherwise(17.0 + (k % 50) / 100).alias("lon"))
    known = lambda x: F.when(c % 5 > 0, x)
    mentions = table(spark, sf, "customer").join(F.broadcast(town), F.col("c_nationkey") == F.col("place_no")).select(c.alias("id"), F.array(road(c % 40), road(c % 7)).alias("candidates"), F.when(c % 2 == 0, (c % 4).cast("string")).alias("house_number"), "town", known(48.3).alias("town_lat"), known(17.2).alias("town_lon"))
    return geo.geocode_streets(mentions, gazetteer).select("id", "street", "geo_lat", "geo_lon", "geo_precision", "matched")
