"""The operators as queries over the driver's tables, with their SQL."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from estatelake.functions.columns import per_sqm, rounded
from estatelake.operators import comparables, geo, history, market, merge, photos, search, valuation
from estatelake.plans.domain import BENCH, CHANGES, CURRENT, OBS, SNAP, benchmarks, observations, places, point, r2, table
from estatelake.sources.shared import keep

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return register


def _snaps(spark, sf):
    return history.day_snapshots(observations(spark, sf))


def _current(spark, sf):
    return history.current_listings(observations(spark, sf))


def _changes(spark, sf):
    return history.price_changes(_snaps(spark, sf))


SQM = f"CASE WHEN price <> 0 AND area <> 0 THEN {r2('price / area')} END"
STATS = CURRENT + f""", stats AS (
  SELECT source, deal_type, category, district, count(*) AS n, {r2('percentile_cont(0.5) WITHIN GROUP (ORDER BY price)')} AS median_price, {r2('avg(price)')} AS mean_price,
    {r2('percentile_cont(0.5) WITHIN GROUP (ORDER BY sqm)')} AS median_sqm, {r2('avg(sqm)')} AS mean_sqm, min(price) AS min_price, max(price) AS max_price
  FROM (SELECT *, {SQM} AS sqm FROM cur WHERE price IS NOT NULL) GROUP BY ALL)"""


@query("w11_day_snapshots", f"WITH {SNAP} SELECT source, listing_id, day, event_id, price, area, deal_type, category, district FROM snap")
def _(spark, sf):
    return _snaps(spark, sf).select("source", "listing_id", "day", "event_id", "price", "area", "deal_type", "category", "district")


@query("w3_price_changes", f"WITH {CHANGES} SELECT * FROM changes")
def _(spark, sf):
    return _changes(spark, sf)


@query("p7_price_drops", f"WITH {CHANGES}, cur AS (SELECT DISTINCT source, listing_id, deal_type, category, district, region FROM snap) SELECT c.*, deal_type, category, district, region FROM changes c JOIN cur USING (source, listing_id) WHERE absolute_change < 0 AND day >= (SELECT max(day) FROM snap) - 14 AND deal_type = 'buy'")
def _(spark, sf):
    changes, now = _changes(spark, sf), observations(spark, sf).agg(F.max("day").alias("now"))
    return search.price_drops(changes, _current(spark, sf), now, 14, deal_type="buy")


@query("w1_current_listings", f"WITH {CURRENT} SELECT source, listing_id, event_id, price, area, deal_type, category, district, region, CAST(first_seen_at AS DATE) AS first_seen, CAST(last_seen_at AS DATE) AS last_seen FROM cur")
def _(spark, sf):
    return _current(spark, sf).select("source", "listing_id", "event_id", "price", "area", "deal_type", "category", "district", "region", F.to_date("first_seen_at").alias("first_seen"), F.to_date("last_seen_at").alias("last_seen"))


@query("p8_mark_inactive", f"WITH {CURRENT} SELECT source, listing_id, last_seen_at >= TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 3 DAY AS active FROM cur")
def _(spark, sf):
    return history.mark_inactive(_current(spark, sf), datetime(2024, 1, 30), 3).select("source", "listing_id", "active")


@query("a1_market_statistics", f"WITH {STATS} SELECT * FROM stats")
def _(spark, sf):
    return market.market_statistics(_current(spark, sf))


@query("a2_price_distribution", f"""WITH {CURRENT}, s AS (SELECT district, deal_type, category, {SQM} AS sqm FROM cur), g AS (
  SELECT district, deal_type, category, sqm FROM s WHERE sqm IS NOT NULL UNION ALL SELECT district, deal_type, NULL, sqm FROM s WHERE sqm IS NOT NULL)
SELECT district, deal_type, category, count(*) AS n, min(sqm) AS low, {', '.join(r2(f'percentile_cont({p}) WITHIN GROUP (ORDER BY sqm)') + f' AS p{int(p * 100)}' for p in (0.25, 0.5, 0.75))}, max(sqm) AS high FROM g GROUP BY ALL""")
def _(spark, sf):
    return market.price_distribution(_current(spark, sf), ["district", "deal_type"])


@query("a4_median_index", f"WITH {SNAP} SELECT day, deal_type, category, {r2('percentile_cont(0.5) WITHIN GROUP (ORDER BY price)')} AS median_price, {r2('percentile_cont(0.5) WITHIN GROUP (ORDER BY sqm)')} AS median_sqm, count(*) AS n FROM (SELECT *, {SQM} AS sqm FROM snap WHERE price IS NOT NULL) GROUP BY ALL")
def _(spark, sf):
    return market.median_index(_snaps(spark, sf), ["deal_type", "category"])


@query("a5_covered_districts", f"WITH {SNAP} SELECT district, count(DISTINCT (source, listing_id)) AS n_listings FROM snap GROUP BY district")
def _(spark, sf):
    return market.covered_districts(_snaps(spark, sf))


@query("a13_latest_period", f"WITH {BENCH} SELECT granularity, arg_max(period, year * 10 + quarter) AS period FROM bench GROUP BY granularity")
def _(spark, sf):
    return market.latest_period(benchmarks(spark, sf), ["granularity"])


@query("s4_benchmarks", f"WITH {BENCH} SELECT granularity, place, period, year, quarter, value FROM bench")
def _(spark, sf):
    return benchmarks(spark, sf).select("granularity", "place", "period", F.col("year").cast("long").alias("year"), F.col("quarter").cast("long").alias("quarter"), "value")


@query("j9_match_benchmarks", f"""WITH {CURRENT}, {BENCH}, l AS (SELECT *, '1997_Q' || (listing_id % 4 + 1) AS period FROM cur)
SELECT source, listing_id, l.period, coalesce(d.value, r.value) AS benchmark, CASE WHEN d.value IS NOT NULL THEN 'district' WHEN r.value IS NOT NULL THEN 'region' END AS level
FROM l LEFT JOIN bench d ON d.granularity = 'district' AND d.place = district AND d.period = l.period AND d.quarter <> 4 LEFT JOIN bench r ON r.granularity = 'region' AND r.place = region AND r.period = l.period""")
def _(spark, sf):
    listings = _current(spark, sf).withColumn("period", F.concat(F.lit("1997_Q"), F.col("listing_id") % 4 + 1))
    bench = benchmarks(spark, sf).filter("granularity = 'region' OR quarter <> 4")  # so that some fall back
    return market.match_benchmarks(listings, bench).select("source", "listing_id", "period", "benchmark", "level")


@query("w4_benchmark_series", f"""WITH {BENCH}, p AS (SELECT n_name AS district, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey), u AS (
  SELECT district, period, year, quarter, value, granularity, 0 AS preferred FROM p JOIN bench ON place = district WHERE granularity = 'district' AND quarter <> 2
  UNION ALL SELECT district, period, year, quarter, value, granularity, 1 FROM p JOIN bench ON place = region WHERE granularity = 'region'),
o AS (SELECT *, row_number() OVER (PARTITION BY district, period ORDER BY preferred) AS a FROM u), n AS (SELECT *, row_number() OVER (PARTITION BY district ORDER BY year DESC, quarter DESC) AS b FROM o WHERE a = 1)
SELECT district, period, value, granularity FROM n WHERE b <= 16""")
def _(spark, sf):
    bench = benchmarks(spark, sf).filter("granularity = 'region' OR quarter <> 2")
    return market.benchmark_series(bench, places(spark, sf).select("district", "region")).select("district", "period", "value", "granularity")


@query("w9_year_on_year", f"WITH {BENCH} SELECT place, period, value, CAST(round(CAST((value / nullif(lag(value, 4) OVER (PARTITION BY place ORDER BY year, quarter), 0) - 1) * 100 AS DECIMAL(18,6)), 1) AS DOUBLE) AS yoy FROM bench WHERE granularity = 'region'")
def _(spark, sf):
    return market.year_on_year(benchmarks(spark, sf).filter("granularity = 'region'"), "place").select("place", "period", "value", "yoy")


@query("w8_thinned_series", f"""WITH {SNAP}, i AS (SELECT district, day, count(*) AS n FROM snap GROUP BY ALL), k AS (SELECT *, row_number() OVER (PARTITION BY district ORDER BY day) - 1 AS place, count(*) OVER (PARTITION BY district) AS c FROM i)
SELECT district, day, n FROM k WHERE c <= 16 OR list_contains(list_transform(range(0, 16), lambda i: CAST(round_even(i * (c - 1) / 15.0, 0) AS BIGINT)), place)""")
def _(spark, sf):
    return market.thinned(_snaps(spark, sf).groupBy("district", "day").agg(F.count(F.lit(1)).alias("n")), "district", "day")


@query("j18_market_context", f"""WITH {STATS.replace('stats AS', 'stats_ AS')}, ex AS (SELECT deal_type, category, district, {r2('percentile_cont(0.5) WITHIN GROUP (ORDER BY price)')} AS m FROM cur WHERE category <> 'land' GROUP BY ALL),
lv AS (SELECT deal_type, district, {r2('percentile_cont(0.5) WITHIN GROUP (ORDER BY price)')} AS m FROM cur GROUP BY ALL)
SELECT source, listing_id, coalesce(ex.m, lv.m) AS median, CASE WHEN ex.m IS NOT NULL THEN 'exact' WHEN lv.m IS NOT NULL THEN 'district' END AS context FROM cur LEFT JOIN ex USING (deal_type, category, district) LEFT JOIN lv USING (deal_type, district)""")
def _(spark, sf):
    cur = _current(spark, sf)
    exact = market.market_statistics(cur.filter("category <> 'land'"), ["deal_type", "category", "district"])
    return market.market_context(cur, exact, market.market_statistics(cur, ["deal_type", "district"])).select("source", "listing_id", "median", "context")


@query("p1_search_listings", f"WITH {CURRENT} SELECT source, listing_id, price, district, region FROM cur WHERE price IS NOT NULL AND deal_type = 'buy' AND category = 'house' AND price BETWEEN 20 AND 80")
def _(spark, sf):
    return search.search_listings(_current(spark, sf), deal_type="buy", category="house", min_price=20, max_price=80).select("source", "listing_id", "price", "district", "region")


@query("o1_listing_page", f"WITH {CURRENT} SELECT source, listing_id, price FROM cur ORDER BY last_seen_at DESC NULLS LAST, event_id DESC LIMIT 50 OFFSET 50")
def _(spark, sf):
    return search.page(_current(spark, sf), [F.desc_nulls_last("last_seen_at"), F.desc("event_id")], 50, 50).select("source", "listing_id", "price")


@query("p3_region_members", f"WITH {CURRENT} SELECT source, listing_id, district FROM cur WHERE region IN ('EUROPE', 'ASIA')")
def _(spark, sf):
    return search.in_regions(_current(spark, sf), places(spark, sf), ["EUROPE", "ASIA"]).select("source", "listing_id", "district")


@query("j6_customers_without_orders", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def _(spark, sf):
    o = table(spark, sf, "orders").filter("o_orderstatus = 'F'")
    return table(spark, sf, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("j4_latest_child", "SELECT c_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_order FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey")
def _(spark, sf):
    orders = table(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return search.with_latest(table(spark, sf, "customer"), orders, "c_custkey", "o_orderkey", ["o_orderdate", "o_orderkey"], "last_order").select("c_custkey", "last_order")


@query("j8_user_directory", """WITH s AS (SELECT o_custkey AS c_custkey, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS status FROM orders GROUP BY ALL)
SELECT c_custkey, c_name, status, CASE WHEN c_mktsegment = 'BUILDING' THEN 'pro' WHEN status IN ('F', 'P') THEN 'pro' ELSE 'basic' END AS plan FROM customer LEFT JOIN s USING (c_custkey) WHERE c_name ILIKE '%r#%7%'""")
def _(spark, sf):
    status = F.when(F.col("o_orderstatus") == "F", "active").when(F.col("o_orderstatus") == "P", "past_due").otherwise("canceled")
    subs = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")).alias("o_orderstatus"))
    out = search.user_directory(table(spark, sf, "customer"), subs, "c_custkey", "R#%7", "c_name")
    role = F.when(F.col("c_mktsegment") == "BUILDING", "admin").otherwise("user")
    return out.select("c_custkey", "c_name", F.col("o_orderstatus").alias("status"), search.entitled_plan(role, F.lit(False), status, F.lit(None).cast("string")).alias("plan"))


_U = "lower(c_mktsegment) || (c_custkey * 7) || '@example.org'"


@query("p14_user_directory", f"""WITH s AS (SELECT o_custkey AS c_custkey, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS status FROM orders GROUP BY ALL), f AS (SELECT *, {_U} AS email FROM customer WHERE c_name ILIKE '%7%' OR {_U} ILIKE '%7%')
SELECT c_custkey, c_name, email, status, CASE WHEN c_mktsegment = 'BUILDING' THEN 'pro' WHEN status IN ('F', 'P') THEN 'pro' ELSE 'basic' END AS plan, (SELECT count(*) FROM f) AS total FROM f LEFT JOIN s USING (c_custkey)""")
def _(spark, sf):
    status = F.when(F.col("o_orderstatus") == "F", "active").when(F.col("o_orderstatus") == "P", "past_due").otherwise("canceled")
    subs = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")).alias("o_orderstatus"))
    users = table(spark, sf, "customer").withColumn("email", F.concat(F.lower("c_mktsegment"), F.col("c_custkey") * 7, F.lit("@example.org")))
    out = search.user_directory(users, subs, "c_custkey", "7", "c_name", "email", ["c_custkey"])
    role = F.when(F.col("c_mktsegment") == "BUILDING", "admin").otherwise("user")
    return out.select("c_custkey", "c_name", "email", F.col("o_orderstatus").alias("status"), search.entitled_plan(role, F.lit(False), status, F.lit(None).cast("string")).alias("plan"), "total")


@query("s7a_merge_state", f"""WITH {OBS}, a AS (SELECT source, listing_id, arg_max(price, (scraped_at, event_id)) AS price, min(scraped_at) AS first_seen, max(scraped_at) AS last_seen FROM obs WHERE event_id % 2 = 0 GROUP BY ALL),
b AS (SELECT source, listing_id, arg_max(price, (scraped_at, event_id)) AS price, min(scraped_at) AS first_seen, max(scraped_at) AS last_seen FROM obs WHERE event_id % 2 = 1 GROUP BY ALL)
SELECT coalesce(a.source, b.source) AS source, coalesce(a.listing_id, b.listing_id) AS listing_id, coalesce(b.price, a.price) AS price, CAST(coalesce(a.first_seen, b.first_seen) AS DATE) AS first_seen, CAST(greatest(a.last_seen, b.last_seen) AS DATE) AS last_seen,
  CASE WHEN a.source IS NULL THEN 'inserted' WHEN b.source IS NULL THEN 'kept' ELSE 'updated' END AS merge_action FROM a FULL JOIN b ON a.source = b.source AND a.listing_id = b.listing_id""")
def _(spark, sf):
    def half(i):
        part = observations(spark, sf).filter(F.col("event_id") % 2 == i)
        return part.groupBy("source", "listing_id").agg(F.max_by("price", F.struct("scraped_at", "event_id")).alias("price"), F.min("scraped_at").alias("first_seen"), F.max("scraped_at").alias("last_seen"))

    out = merge.merge_by_key(half(0), half(1), ["source", "listing_id"], {"first_seen": "keep_old", "last_seen": "greatest"})
    return out.withColumn("first_seen", F.to_date("first_seen")).withColumn("last_seen", F.to_date("last_seen"))


@query("s7i_saved_set", "WITH e AS (SELECT o_custkey, l_partkey, CASE WHEN l_returnflag = 'R' THEN 'unsave' ELSE 'save' END AS action, l_orderkey * 10 + l_linenumber AS saved_at FROM lineitem JOIN orders ON l_orderkey = o_orderkey) SELECT o_custkey, l_partkey, max(e.saved_at) AS saved_at FROM e GROUP BY ALL HAVING arg_max(action, (e.saved_at, action)) = 'save'")
def _(spark, sf):
    l, o = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    e = l.join(o, l["l_orderkey"] == o["o_orderkey"]).select("o_custkey", "l_partkey", F.when(F.col("l_returnflag") == "R", "unsave").otherwise("save").alias("action"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("at"))
    return merge.saved_set(e, "o_custkey", "l_partkey", "action", "at")


@query("s7j_partial_updates", "SELECT user_id, arg_max(value, event_id) FILTER (event_type = 'click') AS last_click, arg_max(value, event_id) FILTER (event_type = 'view') AS last_view FROM events GROUP BY user_id")
def _(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id", *[F.when(F.col("event_type") == t, F.col("value")).alias(f"last_{t}") for t in ("click", "view")])
    return merge.fold_partial_updates(e, ["user_id"], "event_id", ["last_click", "last_view"])


_C = "SELECT c_custkey AS point_id, 48.0 + (c_custkey * 37 % 1000) / 10000 AS lat, 17.0 + (c_custkey * 91 % 1000) / 10000 AS lon FROM customer"
_S = "SELECT s_suppkey AS place_id, 48.0 + (s_suppkey * 53 % 1000) / 10000 AS p_lat, 17.0 + (s_suppkey * 71 % 1000) / 10000 AS p_lon, CASE s_suppkey % 6 WHEN 0 THEN 'transport' WHEN 1 THEN 'grocery' WHEN 2 THEN 'schools' WHEN 3 THEN 'parks' WHEN 4 THEN 'restaurants' ELSE 'healthcare' END AS category FROM supplier"
_NEAR = f"c AS ({_C}), s AS ({_S}), d AS (SELECT *, 2 * 6371000.0 * asin(sqrt(least(pow(sin(radians(p_lat - lat) / 2), 2) + cos(radians(lat)) * cos(radians(p_lat)) * pow(sin(radians(p_lon - lon) / 2), 2), 1.0))) AS m FROM c, s)"
WANTED = [("transport_500m", "transport", 500), ("grocery_500m", "grocery", 500), ("schools_1km", "schools", 1000), ("parks_1km", "parks", 1000), ("restaurants_1km", "restaurants", 1000), ("healthcare_1km", "healthcare", 1000), ("transport_1km", "transport", 1000), ("grocery_1km", "grocery", 1000), ("transport_3km", "transport", 3000)]


def _points(spark, sf):
    pts = table(spark, sf, "customer").select(F.col("c_custkey").alias("point_id"), *point(F.col("c_custkey"), 37, 91))
    names = F.array(*map(F.lit, ("transport", "grocery", "schools", "parks", "restaurants", "healthcare")))
    pois = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("place_id"), *point(F.col("s_suppkey"), 53, 71), F.element_at(names, (F.col("s_suppkey") % 6 + 1).cast("int")).alias("category"))
    return pts, pois


_COUNTS = ", ".join(f"count(*) FILTER (category = '{c}' AND m <= {r}) AS {n}" for n, c, r in WANTED)


@query("j13_place_counts", f"WITH {_NEAR} SELECT point_id, {_COUNTS} FROM d GROUP BY point_id")
def _(spark, sf):
    return geo.place_counts(*_points(spark, sf), WANTED).drop("lat", "lon")


@query("a10_location_score", f"WITH {_NEAR}, n AS (SELECT point_id, {_COUNTS} FROM d GROUP BY point_id) SELECT point_id, CAST(round(CAST((" + " + ".join(f"{w} * least({c} / {f}.0, 1.0)" for c, w, f in geo.SCORE) + ") * 100 AS DECIMAL(18,6)), 1) AS DOUBLE) AS score FROM n")
def _(spark, sf):
    return geo.place_counts(*_points(spark, sf), WANTED).select("point_id", geo.location_score().alias("score"))


@query("j14_nearest_place", f"WITH {_NEAR} SELECT point_id, category, arg_min(place_id, (m, place_id)) AS place_id FROM d WHERE m <= 1000 GROUP BY ALL")
def _(spark, sf):
    return geo.nearest_place(*_points(spark, sf), 1000.0).select("point_id", "category", "place_id")


def _listings(spark, sf):
    cur = _current(spark, sf)
    return cur.select(F.col("event_id").alias("id"), *valuation.SEGMENT, F.concat(F.col("listing_id") % 3 + 1, F.lit("+kk")).alias("layout"), "area", "price", "region")


def _pairs(nth: str, first: str) -> str:
    return f"""{CURRENT}, l AS (SELECT event_id AS id, district, category, deal_type, (listing_id % 3 + 1) || '+kk' AS layout, area, price, {SQM} AS sqm FROM cur WHERE price IS NOT NULL),
j AS (SELECT a.*, b.id AS o_id, b.layout AS o_layout, b.area AS o_area, b.price AS o_price, b.sqm AS o_sqm{nth} FROM l a JOIN l b ON a.district = b.district AND a.category = b.category AND a.deal_type = b.deal_type AND a.id <> b.id AND b.sqm IS NOT NULL),
pairs AS (SELECT *, CAST(round_even((CASE WHEN layout = o_layout THEN 40 ELSE 0 END + CASE WHEN area > 0 AND o_area > 0 THEN 30 * greatest(0.0, 1 - abs(area - o_area) / area) ELSE 0 END + CASE WHEN sqm > 0 AND o_sqm > 0 THEN 30 * greatest(0.0, 1 - abs(sqm - o_sqm) / sqm) ELSE 0 END)
  / (40.0::DOUBLE + CASE WHEN area > 0 AND o_area > 0 THEN 30 ELSE 0 END + CASE WHEN sqm > 0 AND o_sqm > 0 THEN 30 ELSE 0 END) * 100, 0) AS INTEGER) AS similarity FROM j{first})"""


#: Pairs of a listing with the first 200 others of its segment, and with all of them.
_PAIRS, _ALL_PAIRS = _pairs(", row_number() OVER (PARTITION BY a.id ORDER BY b.id) AS nth", " WHERE nth <= 200"), _pairs("", "")


#: The estimate from medians mp and ms, and the price's difference to it in percent.
ESTIMATE = "coalesce(round_even(nullif(round_even(ms, 0), 0) * nullif(area, 0), 0), nullif(round_even(mp, 0), 0))"
OFF = f"CAST(round(CAST({r2('price - estimate')} / nullif(estimate, 0) * 100 AS DECIMAL(18,6)), 1) AS DOUBLE)"


@query("w5_best_comparables", f"WITH {_ALL_PAIRS} SELECT id, o_id, similarity, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY similarity DESC, o_id) AS rank FROM pairs WHERE similarity >= 60) WHERE rank <= 2")
def _(spark, sf):
    return comparables.best_of_all(keep(_listings(spark, sf), "listings")).select("id", "o_id", "similarity", "rank")


@query("a7_value_listings", f"""WITH {_PAIRS}, p AS (SELECT id, price, area, percentile_cont(0.5) WITHIN GROUP (ORDER BY o_price) AS mp, percentile_cont(0.5) WITHIN GROUP (ORDER BY o_sqm) AS ms, percentile_cont(0.5) WITHIN GROUP (ORDER BY o_area) AS median_area, count(*) AS sample_size FROM pairs GROUP BY ALL),
e AS (SELECT *, {ESTIMATE} AS estimate FROM p), f AS (SELECT *, {r2('price - estimate')} AS difference, {OFF} AS difference_pct FROM e)
SELECT id, round_even(mp, 0) AS median_price, round_even(ms, 0) AS median_sqm, median_area, sample_size, estimate, round_even(estimate * 0.95, 0) AS low, round_even(estimate * 1.05, 0) AS high, difference, difference_pct, CASE WHEN difference_pct <= -5 THEN 'undervalued' WHEN difference_pct >= 5 THEN 'overpriced' WHEN difference_pct IS NOT NULL THEN 'fair' END AS label FROM f""")
def _(spark, sf):
    return valuation.value_listings(valuation.comparables(_listings(spark, sf)))


@query("v1_gallery_hash", "SELECT conv_id, sha256(string_agg(text, chr(10) ORDER BY turn) FILTER (turn_no <= 50)) AS gallery FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS turn_no FROM conversations) GROUP BY conv_id")
def _(spark, sf):
    turns = table(spark, sf, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("t"))
    return turns.select("conv_id", photos.gallery_hash(F.col("t.text")).alias("gallery"))


_PAY = "cost * 0.8 * (0.04 / 12) / (1 - pow(1 + 0.04 / 12, -360))"


@query("a15_buy_vs_rent", f"""WITH RECURSIVE {CURRENT}, l AS (SELECT event_id AS id, district, region, deal_type, area, price, {SQM} AS sqm FROM cur), rm AS (SELECT district, percentile_cont(0.5) WITHIN GROUP (ORDER BY sqm) AS rent_sqm FROM l WHERE deal_type = 'rent' GROUP BY district),
sale AS (SELECT id, region, CAST(price AS DOUBLE) AS cost, {r2('rent_sqm * area / 200')} AS rent FROM l JOIN rm USING (district) WHERE deal_type = 'buy' AND price > 0 AND rent_sqm IS NOT NULL AND area IS NOT NULL),
f AS (SELECT id, region, 0 AS m, cost, {_PAY} AS pay, cost AS value, cost * 0.8 AS debt, rent, CAST(0 AS DOUBLE) AS buyer, cost - cost * 0.8 AS renter FROM sale
  UNION ALL SELECT id, region, m + 1, cost, pay, value * pow(1.04, 1.0 / 12), greatest(0.0, debt * (1 + 0.04 / 12) - pay), rent * pow(1.025, 1.0 / 12), buyer * pow(1.05, 1.0 / 12) + greatest(rent - pay, 0.0), renter * pow(1.05, 1.0 / 12) + greatest(pay - rent, 0.0) FROM f WHERE m < 360),
y AS (SELECT id, min(m // 12) FILTER (m > 0 AND m % 12 = 0 AND round(value - debt + buyer, 0) >= round(renter, 0)) AS year FROM f GROUP BY id)
SELECT region, CAST(year AS DOUBLE) AS break_even_year, count(*) AS n FROM sale JOIN y USING (id) GROUP BY ALL""")
def _(spark, sf):
    l = _listings(spark, sf)
    rent = l.filter("deal_type = 'rent'").groupBy("district").agg(F.percentile(per_sqm(F.col("price"), F.col("area")), 0.5).alias("rent_sqm"))
    sale = l.filter("deal_type = 'buy' AND price > 0").join(rent, "district").withColumn("rent", rounded(F.col("rent_sqm") * F.col("area") / 200)).withColumn("growth_pct", F.lit(4.0))
    sale = sale.filter("rent IS NOT NULL")
    return valuation.buy_vs_rent(sale).groupBy("region", F.col("break_even_year").cast("double").alias("break_even_year")).agg(F.count(F.lit(1)).alias("n"))


@query("m1_features", f"WITH {STATS}, s AS (SELECT * FROM (SELECT * EXCLUDE (nth) FROM (SELECT *, row_number() OVER (PARTITION BY source, listing_id, day ORDER BY scraped_at DESC, event_id DESC) AS nth FROM obs) WHERE nth = 1)) SELECT s.source, s.deal_type, s.category, s.district, listing_id, day, area, price AS target, n, median_price, median_sqm FROM s LEFT JOIN stats USING (source, deal_type, category, district) WHERE s.deal_type = 'buy' AND price IS NOT NULL")
def _(spark, sf):
    from estatelake.operators.features import build_features

    return build_features(_snaps(spark, sf), market.market_statistics(_current(spark, sf)), "sale_price")


@query("p5_listing_projection", f"WITH {CURRENT} SELECT CAST(event_id AS VARCHAR) AS id, CASE WHEN deal_type = 'rent' THEN 'rent' ELSE 'sale' END AS dealType, category, district, region, price, CASE WHEN area % 2 = 0 THEN 48.5 ELSE 48.0 END AS lat, CASE WHEN area % 2 = 0 THEN 17.5 ELSE 17.0 END AS lon, CASE WHEN area % 2 = 0 THEN 'street' ELSE 'town' END AS geoPrecision FROM cur")
def _(spark, sf):
    hit = F.col("area") % 2 == 0
    cur = _current(spark, sf).withColumn("id", F.col("event_id")).withColumn("lat", F.lit(48.0)).withColumn("lon", F.lit(17.0)).withColumn("geo_lat", F.when(hit, 48.5)).withColumn("geo_lon", F.when(hit, 17.5))
    return search.listing_projection(cur)


@query("p12_benchmark_rows", f"WITH {BENCH} SELECT place, period, value FROM bench WHERE granularity = 'district' AND period = (SELECT arg_max(period, year * 10 + quarter) FROM bench)")
def _(spark, sf):
    return search.benchmark_rows(benchmarks(spark, sf), granularity="district").select("place", "period", "value")


@query("p10_pending_scores", f"WITH {CURRENT} SELECT event_id AS id FROM cur WHERE price > 50 AND NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = listing_id AND o_orderstatus = 'F')")
def _(spark, sf):
    cur = _current(spark, sf).select(F.col("event_id"), F.col("listing_id").alias("id"), (F.col("price") > 50).alias("active"), F.lit(48.0).alias("lat"), F.lit(17.0).alias("lon"))
    scores = table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("id"))
    return search.pending_location_score(cur, scores).select(F.col("event_id").alias("id"))


@query("j17_backfill", "WITH latest AS (SELECT o_custkey, arg_max(o_orderpriority, o_orderkey) AS p FROM orders GROUP BY o_custkey) SELECT c_custkey, coalesce(CASE WHEN c_acctbal > 0 THEN c_mktsegment END, p) AS note FROM customer LEFT JOIN latest ON o_custkey = c_custkey")
def _(spark, sf):
    target = table(spark, sf, "customer").select("c_custkey", F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("note"))
    source = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("note"), "o_orderkey")
    return merge.backfill(target, source, ["c_custkey"], ["note"], "o_orderkey")


@query("w13_index_source", f"""WITH {BENCH}, e AS (SELECT place AS district, period, value FROM bench WHERE granularity = 'district' AND length(place) % 2 = 0), m AS (SELECT n_name AS district, period, value FROM nation JOIN region ON n_regionkey = r_regionkey JOIN bench ON granularity = 'region' AND place = r_name)
SELECT district, period, value, 'external' AS kind FROM e UNION ALL SELECT district, period, value, 'market' FROM m WHERE district NOT IN (SELECT district FROM e)""")
def _(spark, sf):
    b = benchmarks(spark, sf)
    own = b.filter("granularity = 'district'").select(F.col("place").alias("district"), "period", "value")
    wide = b.filter("granularity = 'region'").join(F.broadcast(places(spark, sf)), F.col("place") == F.col("region")).select("district", "period", "value")
    external = own.filter(F.length("district") % 2 == 0)
    return valuation.index_source(external, external.withColumn("value", -F.col("value")), wide)  # the external series goes before the district's own


@query("r4_market_codes", f"""WITH {_PAIRS}, p AS (SELECT id, price, area, sqm, percentile_cont(0.5) WITHIN GROUP (ORDER BY o_price) AS mp, percentile_cont(0.5) WITHIN GROUP (ORDER BY o_sqm) AS ms FROM pairs GROUP BY ALL),
e AS (SELECT *, {ESTIMATE} AS estimate, round_even(ms, 0) AS m2 FROM p)
SELECT id, 'price_' || CASE WHEN price < estimate * 0.99 THEN 'below' WHEN price > estimate * 1.01 THEN 'above' ELSE 'inline' END || ',sqm_' || CASE WHEN sqm < m2 * 0.99 THEN 'below' WHEN sqm > m2 * 1.01 THEN 'above' ELSE 'inline' END AS codes FROM e WHERE sqm IS NOT NULL AND m2 IS NOT NULL AND estimate IS NOT NULL""")
def _(spark, sf):
    listings = _listings(spark, sf)
    facts = listings.select("id", "price", per_sqm(F.col("price"), F.col("area")).alias("sqm"))
    met = valuation.value_listings(valuation.comparables(listings)).join(facts, "id").filter("sqm IS NOT NULL AND median_sqm IS NOT NULL AND estimate IS NOT NULL")
    return met.select("id", F.array_join(valuation.market_codes(F.col("price"), F.col("estimate"), F.col("sqm"), F.col("median_sqm"), F.lit(False)), ",").alias("codes"))


@query("u1_widened_pool", f"""WITH {_PAIRS}, s AS (SELECT id, count(*) FILTER (similarity >= 60) AS strong FROM pairs GROUP BY id), w AS (
  SELECT a.id, b.id AS o_id, row_number() OVER (PARTITION BY a.id ORDER BY b.id) AS n FROM l a JOIN (SELECT event_id, region FROM cur) ra ON ra.event_id = a.id JOIN l b ON a.category = b.category AND a.deal_type = b.deal_type AND a.id <> b.id AND b.sqm IS NOT NULL JOIN (SELECT event_id, region FROM cur) rb ON rb.event_id = b.id AND rb.region = ra.region)
SELECT id, o_id, FALSE AS widened FROM pairs UNION ALL SELECT w.id, w.o_id, TRUE FROM w LEFT JOIN s ON s.id = w.id WHERE n <= 200 AND coalesce(strong, 0) < 3 AND NOT EXISTS (SELECT 1 FROM pairs p WHERE p.id = w.id AND p.o_id = w.o_id)""")
def _(spark, sf):
    listings = _listings(spark, sf)
    wide = valuation.comparables(listings.drop("district").withColumnRenamed("region", "district"))
    return valuation.widened(valuation.comparables(listings).drop("district"), wide.drop("district")).select("id", "o_id", "widened")
