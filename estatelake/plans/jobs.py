"""More operators as queries over the driver's tables, with their SQL: listings with all their facts, stores, photos, places, accounts."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from estatelake.functions.columns import per_sqm
from estatelake.operators import comparables, features, geo, history, market, merge, normalize, photos, search, sketches, valuation
from estatelake.plans.domain import BENCH, CHANGES, CURRENT, OBS, SNAP, benchmarks, observations, places, r2, table
from estatelake.plans.registry import _ALL_PAIRS, _PAIRS, ESTIMATE, OFF, _S, SQM, WANTED, _changes, _current, _listings, _points, _snaps, query
from estatelake.sources import io
from estatelake.sources.shared import keep, scratch

NOW, TODAY = datetime(2024, 1, 30), date(2024, 1, 30)


# --- listings with all their facts ------------------------------------------

_SLUG = "CASE listing_id % 4 WHEN 0 THEN 'prodej' WHEN 1 THEN 'pronajem' WHEN 2 THEN 'predaj' ELSE 'detail' END"
FACTS = f"event_id AS id, CASE WHEN listing_id % 7 = 0 THEN NULL ELSE (listing_id % 3 + 1) || '+kk' END AS layout, district || ' ' || (listing_id % 2) AS locality, listing_id % 5 <> 0 AS active, 'https://x.example/' || {_SLUG} || '/' || listing_id AS url, {SQM} AS sqm"
LI = f"{CURRENT}, li AS (SELECT *, {FACTS} FROM cur)"


def facts(df):
    """Columns that the driver's events lack, from the listing's id."""
    i = F.col("listing_id")
    slug = F.element_at(F.array(*map(F.lit, ("prodej", "pronajem", "predaj", "detail"))), (i % 4 + 1).cast("int"))
    layout = F.when(i % 7 != 0, F.concat((i % 3 + 1).cast("string"), F.lit("+kk")))
    return df.withColumns({"id": F.col("event_id"), "layout": layout, "locality": F.concat_ws(" ", "district", (i % 2).cast("string")), "active": i % 5 != 0, "url": F.concat(F.lit("https://x.example/"), slug, F.lit("/"), i.cast("string")), "sqm": per_sqm(F.col("price"), F.col("area"))})


def listings(spark, sf):
    return facts(_current(spark, sf))


def snapshots(spark, sf):
    return facts(_snaps(spark, sf))


SNAPS = f"{SNAP}, sn AS (SELECT *, {FACTS} FROM snap)"


# --- search -----------------------------------------------------------------


@query("p2_deal_type_fallback", f"WITH {LI}, m AS (SELECT *, CASE WHEN listing_id % 6 = 0 THEN NULL ELSE deal_type END AS d FROM li) SELECT id, price FROM m WHERE price IS NOT NULL AND (d IN ('buy', 'sale') OR (d IS NULL AND (url ILIKE '%prodej%' OR url ILIKE '%predaj%')))")
def _(spark, sf):
    rows = listings(spark, sf).withColumn("deal_type", F.when(F.col("listing_id") % 6 != 0, F.col("deal_type")))
    return search.search_listings(rows, deal_type="sale").select("id", "price")


@query("p6_raw_log_page", "SELECT event_id AS id, event_type AS source, value FROM events WHERE event_type = 'click' ORDER BY ts DESC NULLS LAST, event_id DESC LIMIT 50 OFFSET 50")
def _(spark, sf):
    log = table(spark, sf, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("source"), F.col("ts").alias("scraped_at"), "value")
    return search.raw_log_page(log, "click", 50, 50).drop("scraped_at")


_DROPS = "d AS (SELECT c.*, url, category, district, layout, li.price AS current_price, active FROM changes c JOIN li USING (source, listing_id) WHERE absolute_change < 0 AND active AND c.day >= DATE '2024-01-30' - 14 AND (url ILIKE '%prodej%'))"


@query("p7_drops_page", f"WITH {CHANGES}, {LI.removeprefix(OBS + ', ')}, {_DROPS} SELECT d.*, (SELECT count(*) FROM d) AS total FROM d ORDER BY day DESC, source DESC, listing_id DESC LIMIT 50 OFFSET 10")
def _(spark, sf):
    return search.drops_page(_changes(spark, sf), listings(spark, sf), TODAY, 14, "sale", limit=50, offset=10)


@query("p8_mark_stale", f"WITH {LI} SELECT source, listing_id, active AND last_seen_at >= TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 3 DAY AS active FROM li")
def _(spark, sf):
    return history.mark_inactive(listings(spark, sf), NOW, 3).select("source", "listing_id", "active")


@query("p9_pending_geocode", f"WITH {LI}, g AS (SELECT id, listing_id % 3 = 0 AS never, listing_id % 2 = 0 AS miss FROM li) SELECT * FROM (SELECT id, 'new' AS kind FROM g WHERE never ORDER BY id LIMIT 25) UNION ALL SELECT * FROM (SELECT id, 'miss' AS kind FROM g WHERE NOT never AND miss ORDER BY id LIMIT 25)")
def _(spark, sf):
    i = F.col("listing_id")
    rows = listings(spark, sf).select("id", F.when(i % 3 != 0, F.lit(NOW)).alias("geocoded_at"), F.when(i % 2 != 0, "street").alias("geo_precision"))
    return search.pending_geocode(rows, 25).select("id", F.lit("new").alias("kind")).unionByName(search.pending_geocode(rows, 25, retry_misses=True).select("id", F.lit("miss").alias("kind")))


def _with_images(df):
    n = F.col("listing_id") % 4
    return df.withColumn("images", F.when(n > 0, F.transform(F.sequence(F.lit(1).cast("long"), F.greatest(n, F.lit(1))), lambda k: F.concat_ws("/", F.col("url"), k.cast("string")))))


@query("p11_single_photo", f"WITH {LI} SELECT id FROM li WHERE source = 'click' AND listing_id % 4 <= 1")
def _(spark, sf):
    return search.single_photo(_with_images(listings(spark, sf)), "click").select("id")


@query("p19_by_keys", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def _(spark, sf):
    wanted = table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return search.by_keys(table(spark, sf, "customer"), wanted).select("c_custkey", "c_name")


@query("a6_source_counts", "SELECT event_type AS source, count(*) AS n FROM events GROUP BY ROLLUP (event_type)")
def _(spark, sf):
    return search.source_counts(table(spark, sf, "events").select(F.col("event_type").alias("source")))


@query("j7_saved_listings", "WITH e AS (SELECT o_custkey, l_partkey, CASE WHEN l_returnflag = 'R' THEN 'unsave' ELSE 'save' END AS action, l_orderkey * 10 + l_linenumber AS saved_at FROM lineitem JOIN orders ON l_orderkey = o_orderkey), s AS (SELECT o_custkey, l_partkey, max(e.saved_at) AS saved_at FROM e GROUP BY ALL HAVING arg_max(action, (e.saved_at, action)) = 'save') SELECT l_partkey AS id, p_name, saved_at FROM s JOIN part ON p_partkey = l_partkey WHERE o_custkey = (SELECT min(o_custkey) FROM orders)")
def _(spark, sf):
    line, o = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    e = line.join(o, line["l_orderkey"] == o["o_orderkey"]).select(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("id"), F.when(F.col("l_returnflag") == "R", "unsave").otherwise("save").alias("action"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("at"))
    first = o.agg(F.min("o_custkey")).first()[0]
    return search.saved_listings(merge.saved_set(e, "user_id", "id", "action", "at"), table(spark, sf, "part").select(F.col("p_partkey").alias("id"), "p_name"), first)


@query("j16_picked_lists", """WITH p AS (SELECT p_partkey AS subject, [p_partkey + 3, NULL, p_partkey + 1, p_partkey, p_partkey + 3, 99999999, p_partkey + 2] AS ids FROM part), d AS (SELECT subject, [x for x in [subject + 3, subject + 1, 99999999, subject + 2]][:3] AS ids FROM p),
u AS (SELECT subject, unnest(ids) AS id, generate_subscripts(ids, 1) - 1 AS nth FROM d) SELECT subject, CAST(nth AS INTEGER) AS nth, id, p_size FROM u JOIN part ON p_partkey = id""")
def _(spark, sf):
    p = F.col("p_partkey")
    picks = table(spark, sf, "part").select(p.alias("subject"), F.array(p + 3, F.lit(None), p + 1, p, p + 3, F.lit(99999999), p + 2).alias("ids"))
    return search.picked_lists(picks, table(spark, sf, "part").select(p.alias("id"), "p_size"), 3).select("subject", "nth", "id", "p_size")


# --- market -----------------------------------------------------------------

_AGG = f"count(*) AS n, {r2('percentile_cont(0.5) WITHIN GROUP (ORDER BY price)')} AS median_price, {r2('avg(price)')} AS mean_price, {r2('percentile_cont(0.5) WITHIN GROUP (ORDER BY sqm)')} AS median_sqm, {r2('avg(sqm)')} AS mean_sqm, min(price) AS min_price, max(price) AS max_price"
DAILY = f"daily AS (SELECT DATE '2024-01-30' AS stat_date, source, coalesce(deal_type, '') AS deal_type, coalesce(category, '') AS category, coalesce(locality, '') AS locality, coalesce(layout, '') AS layout, {_AGG} FROM li WHERE active AND price IS NOT NULL GROUP BY ALL)"


def daily(spark, sf, homes=None):
    return market.market_statistics(listings(spark, sf) if homes is None else homes, market.DAILY, stat_date=TODAY)


@query("a1_daily_statistics", f"WITH {LI}, {DAILY} SELECT * FROM daily")
def _(spark, sf):
    return daily(spark, sf)


@query("a2_active_distribution", f"""WITH {LI}, s AS (SELECT * FROM li WHERE active AND sqm IS NOT NULL), g AS (SELECT district, deal_type, category, sqm FROM s UNION ALL SELECT district, deal_type, NULL, sqm FROM s)
SELECT district, deal_type, category, count(*) AS n, min(sqm) AS low, {', '.join(r2(f'percentile_cont({p}) WITHIN GROUP (ORDER BY sqm)') + f' AS p{int(p * 100)}' for p in (0.25, 0.5, 0.75))}, max(sqm) AS high FROM g GROUP BY ALL""")
def _(spark, sf):
    return market.price_distribution(listings(spark, sf), ["district", "deal_type"])


_MEDIANS = f"dm AS (SELECT deal_type, category, district, layout, {_AGG} FROM li WHERE active AND price IS NOT NULL AND layout IS NOT NULL GROUP BY ALL UNION ALL SELECT deal_type, category, district, NULL, {_AGG} FROM li WHERE active AND price IS NOT NULL GROUP BY deal_type, category, district)"


@query("a3_district_medians", f"WITH {LI}, {_MEDIANS} SELECT * FROM dm")
def _(spark, sf):
    return market.district_medians(listings(spark, sf))


REQUESTS = "rq AS (SELECT c_custkey AS request, CASE WHEN c_custkey % 3 = 0 THEN 'rent' ELSE 'buy' END AS deal_type, CASE c_custkey % 4 WHEN 0 THEN 'apartment' WHEN 1 THEN 'house' WHEN 2 THEN 'land' ELSE 'commercial' END AS category, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE n_name || ' ' || (c_custkey % 2) END AS locality, CASE WHEN c_custkey % 2 = 0 THEN (c_custkey % 5) || '+kk' END AS layout, n_name AS district FROM customer JOIN nation ON c_nationkey = n_nationkey)"


@query("j18_request_context", f"""WITH {LI}, {DAILY}, {_MEDIANS}, {REQUESTS}, x AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY deal_type, category, locality, layout ORDER BY stat_date DESC, n DESC, median_price DESC, source DESC) AS nth FROM daily) WHERE nth = 1)
SELECT rq.*, coalesce(x.median_price, f.median_price, c.median_price) AS market_median_price, CASE WHEN x.n IS NOT NULL THEN x.median_sqm WHEN f.n IS NOT NULL THEN f.median_sqm ELSE c.median_sqm END AS market_median_sqm, CAST(coalesce(x.n, f.n, c.n) AS DOUBLE) AS market_n,
  CASE WHEN x.n IS NOT NULL THEN 'exact' WHEN f.n IS NOT NULL THEN 'district_layout' WHEN c.n IS NOT NULL THEN 'district' END AS context
FROM rq LEFT JOIN x ON x.deal_type = coalesce(rq.deal_type, '') AND x.category = coalesce(rq.category, '') AND x.locality = coalesce(rq.locality, '') AND x.layout = coalesce(rq.layout, '')
LEFT JOIN dm f ON f.deal_type = rq.deal_type AND f.category = rq.category AND f.district = rq.district AND f.layout = rq.layout
LEFT JOIN dm c ON c.deal_type = rq.deal_type AND c.category = rq.category AND c.district = rq.district AND c.layout IS NULL""")
def _(spark, sf):
    c, k = table(spark, sf, "customer"), F.col("c_custkey")
    kinds = F.element_at(F.array(*map(F.lit, ("apartment", "house", "land", "commercial"))), (k % 4 + 1).cast("int"))
    asked = c.join(F.broadcast(places(spark, sf)), c["c_nationkey"] == F.col("place_no")).select(k.alias("request"), F.when(k % 3 == 0, "rent").otherwise("buy").alias("deal_type"), kinds.alias("category"), F.when(k % 5 != 0, F.concat_ws(" ", "district", (k % 2).cast("string"))).alias("locality"), F.when(k % 2 == 0, F.concat((k % 5).cast("string"), F.lit("+kk"))).alias("layout"), "district")
    return market.request_context(asked, daily(spark, sf), listings(spark, sf)).withColumn("market_n", F.col("market_n").cast("double"))


@query("w6_latest_statistics", f"""WITH {SNAPS}, st AS (SELECT day AS stat_date, source, deal_type, category, {_AGG} FROM sn WHERE active AND price IS NOT NULL GROUP BY ALL)
SELECT deal_type, category, stat_date, source, n, median_price FROM (SELECT *, row_number() OVER (PARTITION BY deal_type, category ORDER BY stat_date DESC, n DESC, median_price DESC, source DESC) AS nth FROM st) WHERE nth = 1""")
def _(spark, sf):
    stats = market.market_statistics(snapshots(spark, sf).withColumn("stat_date", F.col("day").cast("string")), ["stat_date", "source", "deal_type", "category"]).withColumn("stat_date", F.col("stat_date").cast("date"))
    return market.latest_statistics(stats, ["deal_type", "category"]).select("deal_type", "category", "stat_date", "source", "n", "median_price")


_BUCKETED = "b AS (SELECT s.day, s.deal_type, CASE WHEN s.category IN ('apartment', 'byty') THEN 'apartment' WHEN s.category IN ('house', 'domy') THEN 'house' END AS bucket, CASE WHEN s.listing_id % 11 = 0 THEN NULL ELSE s.district END AS district, s.source, s.listing_id, s.price, s.sqm FROM (SELECT * REPLACE (CASE WHEN category = 'apartment' AND listing_id % 8 = 0 THEN 'byty' ELSE category END AS category) FROM sn) s WHERE s.price IS NOT NULL)"


def _bucket_input(spark, sf):
    snaps = snapshots(spark, sf).withColumn("category", F.when((F.col("category") == "apartment") & (F.col("listing_id") % 8 == 0), "byty").otherwise(F.col("category")))
    return snaps, listings(spark, sf).withColumn("district", F.when(F.col("listing_id") % 11 != 0, F.col("district")).otherwise(F.lit("")))


@query("a4_bucket_index", f"""WITH {SNAPS}, {_BUCKETED}, k AS (SELECT * FROM b WHERE bucket IS NOT NULL), g AS (SELECT deal_type, bucket, district, day, price, sqm FROM k WHERE district IS NOT NULL UNION ALL SELECT deal_type, bucket, NULL, day, price, sqm FROM k)
SELECT day, deal_type, bucket, district, {r2('percentile_cont(0.5) WITHIN GROUP (ORDER BY price)')} AS median_price, {r2('percentile_cont(0.5) WITHIN GROUP (ORDER BY sqm)')} AS median_sqm, count(*) AS n FROM g GROUP BY ALL""")
def _(spark, sf):
    return market.bucket_index(*_bucket_input(spark, sf))


@query("a4_sketched_weeks", f"WITH {SNAP}, w AS (SELECT date_trunc('week', day)::DATE AS week, deal_type, price, {SQM} AS sqm FROM snap WHERE price IS NOT NULL) SELECT week, deal_type, count(*) AS n, count(sqm) AS n_sqm, TRUE AS within_1_percent FROM w GROUP BY ALL")
def _(spark, sf):
    """Sketches stored by day, merged by week: medians whose rank error is measured against all rows of the week."""
    weekly = lambda df: df.withColumn("week", F.date_trunc("week", F.col("day").cast("timestamp_ntz")).cast("date"))
    snaps = weekly(_snaps(spark, sf)).withColumn("sqm", per_sqm(F.col("price"), F.col("area")))
    held, by = keep(sketches.day_sketches(snaps, ["source", "deal_type"]), "sketches"), ["week", "deal_type"]
    index = sketches.index_of(sketches.merged(weekly(held), by))
    exact = sketches.merged(weekly(held), by).select(*by, sketches.quantile(F.col("price_sketch"), 0.5).alias("median_price"), sketches.quantile(F.col("sqm_sketch"), 0.5).alias("median_sqm"))
    errors = [sketches.rank_errors(snaps, exact, by, value, median) for value, median in (("price", "median_price"), ("sqm", "median_sqm"))]
    met = errors[0].join(errors[1].select(*by, F.col("n").alias("n_sqm"), F.col("error").alias("error_sqm")), by).join(index.select(*by, F.col("n").alias("held")), by)
    return met.select(*by, F.col("held").alias("n"), "n_sqm", ((F.col("error") < 0.01) & (F.col("error_sqm") < 0.01)).alias("within_1_percent"))


@query("a2_sketched_distribution", f"WITH {LI}, s AS (SELECT * FROM li WHERE active AND price IS NOT NULL AND sqm IS NOT NULL) SELECT district, count(*) AS n, min(sqm) AS low, max(sqm) AS high, TRUE AS within_1_percent FROM s GROUP BY district")
def _(spark, sf):
    """A district's distribution from the sketches of its sources; small groups are exact."""
    active = listings(spark, sf).filter("active")
    held = sketches.merged(sketches.day_sketches(active.withColumn("day", F.to_date("last_seen_at")), ["district", "source"]), ["district"])
    told = sketches.distribution_of(held)
    middle = held.select("district", sketches.quantile(F.col("sqm_sketch"), 0.5).alias("m"))
    return told.join(sketches.rank_errors(active.select("district", "sqm"), middle, ["district"], "sqm", "m").select("district", "error"), "district").select("district", "n", "low", "high", (F.col("error") < 0.01).alias("within_1_percent"))


@query("a5_bucket_districts", f"WITH {SNAPS}, {_BUCKETED} SELECT deal_type, bucket, district, count(DISTINCT (source, listing_id)) AS n_listings FROM b WHERE bucket IS NOT NULL AND district IS NOT NULL GROUP BY ALL")
def _(spark, sf):
    return market.bucket_districts(*_bucket_input(spark, sf))


@query("w2_latest_snapshots", f"WITH {SNAP} SELECT source, listing_id, max(day) AS day, arg_max(event_id, (day, event_id)) AS event_id FROM snap GROUP BY ALL")
def _(spark, sf):
    return history.latest_snapshots(_snaps(spark, sf))


BENCH2 = f"""{BENCH}, b2 AS (SELECT 's' AS source, period, year, quarter, 'X' AS country, place AS city, NULL AS district, NULL AS locality, 'flat' AS property_type, 'all' AS segment, 'price' AS metric, value, 'city' AS granularity FROM bench WHERE granularity = 'region'
  UNION ALL SELECT 's', period, year, quarter, 'X', r_name, place, NULL, 'flat', 'all', 'price', value, 'district' FROM bench JOIN nation ON n_name = place JOIN region ON n_regionkey = r_regionkey WHERE granularity = 'district')"""


def bench2(spark, sf):
    """The benchmarks with all key columns: a city for each region, its districts."""
    none, b = F.lit(None).cast("string"), benchmarks(spark, sf)
    of = places(spark, sf).select(F.col("district").alias("place"), "region")
    met = b.join(F.broadcast(of), "place", "left")
    city = F.col("granularity") == "region"
    return met.select(F.lit("s").alias("source"), "period", "year", "quarter", F.lit("X").alias("country"), F.when(city, F.col("place")).otherwise(F.col("region")).alias("city"), F.when(~city, F.col("place")).alias("district"), none.alias("locality"), F.lit("flat").alias("property_type"), F.lit("all").alias("segment"), F.lit("price").alias("metric"), "value", F.when(city, "city").otherwise("district").alias("granularity"))


@query("p13_benchmark_summary", f"WITH {BENCH2}, p AS (SELECT * FROM b2 WHERE period = (SELECT arg_max(period, (year, quarter, period)) FROM b2)) SELECT city, district, period, value, granularity = 'city' AS headline FROM p WHERE granularity = 'district' OR (granularity = 'city' AND city = (SELECT min(city) FROM p WHERE granularity = 'city'))")
def _(spark, sf):
    return market.benchmark_summary(bench2(spark, sf)).select("city", "district", "period", "value", "headline")


@query("o3_benchmark_page", f"WITH {BENCH2} SELECT granularity, district, value FROM b2 WHERE city = 'ASIA' AND period = (SELECT arg_max(period, (year, quarter, period)) FROM b2) ORDER BY granularity, district NULLS FIRST, segment LIMIT 3")
def _(spark, sf):
    return search.benchmark_rows(bench2(spark, sf), segment="all", metric="price", city="ASIA").select("granularity", "district", "value").limit(3)


@query("p18_benchmark_projection", f"""WITH {BENCH2} SELECT period || city || coalesce(district, '') AS id, source, period, year, quarter, country, city, district, CAST(locality AS VARCHAR) AS locality, property_type AS "propertyType", segment, metric, value, granularity FROM b2""")
def _(spark, sf):
    rows = bench2(spark, sf).withColumn("id", F.concat("period", "city", F.coalesce("district", F.lit(""))))
    return search.benchmark_projection(rows).withColumns({c: F.col(c).cast("long") for c in ("year", "quarter")})


@query("p18_index_points", f"""WITH {SNAP} SELECT strftime(day, '%Y-%m-%d') AS date, {r2('percentile_cont(0.5) WITHIN GROUP (ORDER BY price)')} AS "medianPrice", {r2('percentile_cont(0.5) WITHIN GROUP (ORDER BY sqm)')} AS "medianPricePerSqm", count(*) AS "propertyCount" FROM (SELECT *, {SQM} AS sqm FROM snap WHERE price IS NOT NULL) GROUP BY day""")
def _(spark, sf):
    return market.index_points(market.median_index(_snaps(spark, sf)))


@query("w13_three_sources", f"""WITH {BENCH}, p AS (SELECT n_name AS district, r_name AS region, n_nationkey AS k FROM nation JOIN region ON n_regionkey = r_regionkey),
e AS (SELECT district, period, value FROM p JOIN bench ON place = district AND granularity = 'district' WHERE k % 3 = 0), o AS (SELECT district, period, value * 2 AS value FROM p JOIN bench ON place = district AND granularity = 'district' WHERE k % 3 <> 2), m AS (SELECT district, period, value FROM p JOIN bench ON place = region AND granularity = 'region')
SELECT *, 'external' AS kind FROM e UNION ALL SELECT *, 'district' FROM o WHERE district NOT IN (SELECT district FROM e) UNION ALL SELECT *, 'market' FROM m WHERE district NOT IN (SELECT district FROM o)""")
def _(spark, sf):
    b, p = benchmarks(spark, sf), places(spark, sf)
    own = b.filter("granularity = 'district'").join(F.broadcast(p), F.col("place") == F.col("district")).select("district", "period", "value", "place_no")
    wide = b.filter("granularity = 'region'").join(F.broadcast(p), F.col("place") == F.col("region")).select("district", "period", "value")
    return valuation.index_source(own.filter("place_no % 3 = 0").drop("place_no"), own.filter("place_no % 3 <> 2").drop("place_no").withColumn("value", F.col("value") * 2), wide)


# --- valuation --------------------------------------------------------------


@query("j22_rent_estimates", f"WITH {LI}, m AS (SELECT district, category, percentile_cont(0.5) WITHIN GROUP (ORDER BY sqm) AS med FROM li WHERE active AND deal_type = 'rent' AND sqm IS NOT NULL GROUP BY ALL) SELECT id, {r2('med')} AS rent_sqm, CAST(round_even(CAST({r2('med')} AS DOUBLE) * area, 0) AS DOUBLE) AS rent FROM li LEFT JOIN m USING (district, category) WHERE deal_type = 'buy' AND price IS NOT NULL")
def _(spark, sf):
    li = listings(spark, sf)
    return valuation.rent_estimates(li.filter("deal_type = 'buy' AND price IS NOT NULL"), li).select("id", "rent_sqm", "rent")


@query("r2_comparable_rows", f"""WITH {_ALL_PAIRS}, b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY similarity DESC, o_id) AS rank FROM pairs WHERE similarity >= 60) WHERE rank <= 2),
m AS (SELECT id, round_even(percentile_cont(0.5) WITHIN GROUP (ORDER BY o_price), 0) AS price, round_even(percentile_cont(0.5) WITHIN GROUP (ORDER BY o_area), 0) AS area, round_even(percentile_cont(0.5) WITHIN GROUP (ORDER BY o_sqm), 0) AS sqm FROM pairs GROUP BY id)
SELECT id, 'subject' AS kind, 0 AS rank, CAST(NULL AS DOUBLE) AS o_id, layout, CAST(area AS DOUBLE) AS area, price, sqm, CAST(NULL AS DOUBLE) AS difference, 100.0 AS similarity FROM l
UNION ALL SELECT m.id, 'median', 0, NULL, l.layout, m.area, m.price, coalesce(round_even(m.price / nullif(m.area, 0), 0), m.sqm), {r2('m.price - l.price')}, NULL FROM m JOIN l USING (id)
UNION ALL SELECT id, 'best', CAST(rank AS INTEGER), o_id, o_layout, o_area, o_price, o_sqm, {r2('o_price - price')}, similarity FROM b""")
def _(spark, sf):
    rows = keep(_listings(spark, sf), "listings")
    return valuation.comparable_rows(rows, comparables.pool_medians(rows), comparables.best_of_all(rows)).withColumns({c: F.col(c).cast("double") for c in ("o_id", "similarity")})


@query("w5_picked_comparables", f"""WITH {_PAIRS}, u AS (SELECT a.id, a.layout, a.area, a.price, a.sqm, unnest([b.n1, b.n2]) AS o_id, unnest([1, 2]) AS rank FROM l a JOIN (SELECT id, lead(id) OVER (PARTITION BY district ORDER BY id) AS n1, lag(id) OVER (PARTITION BY district ORDER BY id) AS n2 FROM l) b USING (id) WHERE b.n1 IS NOT NULL AND b.n2 IS NOT NULL),
w AS (SELECT u.*, o.layout AS o_layout, o.area AS o_area, o.price AS o_price, o.sqm AS o_sqm FROM u JOIN l o ON o.id = u.o_id)
SELECT id, o_id, CAST(rank AS INTEGER) AS rank, CAST(round_even((CASE WHEN layout = o_layout THEN 40 ELSE 0 END + CASE WHEN area > 0 AND o_area > 0 THEN 30 * greatest(0.0, 1 - abs(area - o_area) / area) ELSE 0 END + CASE WHEN sqm > 0 AND o_sqm > 0 THEN 30 * greatest(0.0, 1 - abs(sqm - o_sqm) / sqm) ELSE 0 END)
  / (40.0::DOUBLE + CASE WHEN area > 0 AND o_area > 0 THEN 30 ELSE 0 END + CASE WHEN sqm > 0 AND o_sqm > 0 THEN 30 ELSE 0 END) * 100, 0) AS INTEGER) AS similarity FROM w""")
def _(spark, sf):
    from pyspark.sql import Window

    rows = _listings(spark, sf).filter("price IS NOT NULL")
    w = Window.partitionBy("district").orderBy("id")
    near = rows.select("id", F.lead("id").over(w).alias("a"), F.lag("id").over(w).alias("b")).filter("a IS NOT NULL AND b IS NOT NULL")
    return valuation.picked_comparables(near.select("id", F.array("a", "b").alias("ids")), rows).select("id", "o_id", "rank", "similarity")


@query("r3_recommendation_codes", f"""WITH {_PAIRS}, p AS (SELECT id, price, area, percentile_cont(0.5) WITHIN GROUP (ORDER BY o_price) AS mp, percentile_cont(0.5) WITHIN GROUP (ORDER BY o_sqm) AS ms FROM pairs GROUP BY ALL), e AS (SELECT *, {ESTIMATE} AS estimate FROM p),
f AS (SELECT id, {OFF} AS d FROM e), g AS (SELECT id, CASE WHEN d <= -5 THEN 'undervalued' WHEN d >= 5 THEN 'overpriced' WHEN d IS NOT NULL THEN 'fair' END AS label, id % 90 AS days, id % 3 > 0 AS photos, id % 3 = 2 AS poor FROM f)
SELECT id, 'verdict_' || coalesce(label, 'none') AS verdict, concat_ws(',', CASE label WHEN 'undervalued' THEN 'below' WHEN 'fair' THEN 'inline' END, CASE WHEN days <= 14 THEN 'recent' END) AS strengths,
  concat_ws(',', CASE WHEN label = 'overpriced' THEN 'above' END, CASE WHEN photos THEN 'photo_only' ELSE 'no_photos' END, CASE WHEN photos AND poor THEN 'poor_photos' END, CASE WHEN days >= 60 THEN 'days' END) AS risks, 'viewing,building,benchmark' AS steps FROM g""")
def _(spark, sf):
    i = F.col("id")
    out = valuation.value_listings(valuation.comparables(_listings(spark, sf))).select("id", valuation.recommendation_codes(F.col("label"), i % 90, i % 3 > 0, i % 3 == 2).alias("c"))
    return out.select("id", "c.verdict", *[F.array_join(F.col("c")[x], ",").alias(x) for x in ("strengths", "risks", "steps")])


@query("r5_benchmark_entries", f"WITH {LI} SELECT id, concat_ws(',', CASE WHEN sqm IS NOT NULL THEN 'local_median=' || sqm END, CASE WHEN deal_type <> 'rent' AND listing_id % 4 <> 0 THEN 'region_index=' || CAST(area AS DOUBLE) END) AS entries FROM li")
def _(spark, sf):
    e = valuation.benchmark_entries(F.col("deal_type"), F.col("sqm"), F.when(F.col("listing_id") % 4 != 0, F.col("area").cast("double")))
    return listings(spark, sf).select("id", F.array_join(F.transform(e, lambda x: F.concat_ws("=", x["kind"], x["value"].cast("string"))), ",").alias("entries"))


@query("r6_property_facts", f"WITH {LI} SELECT id, array_to_string(list_concat([url || '/2'], list_filter([url || '/' || k for k in range(1, listing_id % 4 + 1)], lambda x: x <> url || '/2')), '|') AS images, greatest(date_diff('day', CAST(first_seen_at AS DATE), DATE '2024-01-30'), 0) AS days_on_market, CASE WHEN deal_type = 'rent' THEN 'rent' ELSE 'sale' END AS deal FROM li")
def _(spark, sf):
    rows = _with_images(listings(spark, sf)).withColumn("image_url", F.concat("url", F.lit("/2")))
    return valuation.property_facts(rows, NOW).select("id", F.array_join("images", "|").alias("images"), F.col("days_on_market").cast("long").alias("days_on_market"), "deal")


@query("r7_location_facts", f"WITH {LI} SELECT id, concat_ws(',', CASE WHEN listing_id % 3 > 0 THEN 'parks=' || listing_id % 9 END, CASE WHEN listing_id % 2 > 0 THEN 'schools=' || area END) AS facts, listing_id % 3 > 0 OR listing_id % 2 > 0 AS available FROM li")
def _(spark, sf):
    i = F.col("listing_id")
    rows = listings(spark, sf).select("id", F.when(i % 3 > 0, i % 9).alias("parks"), F.when(i % 2 > 0, F.col("area")).alias("schools"))
    found = rows.select("id", valuation.location_facts(["parks", "schools"]).alias("f"))
    return found.select("id", F.array_join(F.transform("f", lambda x: F.concat_ws("=", x["label"], x["count"].cast("string"))), ",").alias("facts"), (F.size("f") > 0).alias("available"))


@query("r8_valuation_block", f"""WITH {_PAIRS}, p AS (SELECT id, area, percentile_cont(0.5) WITHIN GROUP (ORDER BY o_price) AS mp, percentile_cont(0.5) WITHIN GROUP (ORDER BY o_sqm) AS ms, count(*) AS n FROM pairs GROUP BY ALL), e AS (SELECT *, {ESTIMATE} AS v FROM p)
SELECT id, CAST(round(v, 0) AS BIGINT) AS value, CAST(round(v / nullif(area, 0), 0) AS BIGINT) AS value_per_sqm, round_even(v * 0.95, 0) AS low, v AS mid, round_even(v * 1.05, 0) AS high, n AS sample_size FROM e""")
def _(spark, sf):
    rows = _listings(spark, sf)
    values = valuation.value_listings(valuation.comparables(rows)).join(rows.select("id", "area"), "id")
    return valuation.valuation_block(values, F.col("area")).select("id", "valuation.value", "valuation.value_per_sqm", "valuation.range.*", "valuation.sample_size")


# --- photos -----------------------------------------------------------------

_SC = "sc AS (SELECT event_id AS id, CASE WHEN listing_id % 7 = 0 THEN 'mock' WHEN listing_id % 7 = 1 THEN NULL ELSE 'm' END AS model_provider, CASE WHEN listing_id % 5 = 0 THEN NULL ELSE (listing_id % 10) / 10.0 END AS image_quality, CASE WHEN listing_id % 3 = 0 THEN NULL ELSE CAST(listing_id % 11 AS DOUBLE) END AS photo_quality, CASE WHEN listing_id % 13 = 0 THEN NULL ELSE (listing_id % 20) * 5.0 END AS brightness, (listing_id % 4) / 4.0 AS sharpness, CASE WHEN listing_id % 6 = 0 THEN NULL ELSE (listing_id % 100) * 1.0 END AS exposure_quality, (listing_id % 17) / 17.0 AS resolution_quality, CASE listing_id % 3 WHEN 0 THEN 0.0 WHEN 1 THEN 0.25 ELSE 0.75 END AS blurry_image_ratio, listing_id % 6 AS gallery_size FROM cur)"


def _to100(x):
    return f"CASE WHEN {x} IS NOT NULL THEN round_even(greatest(0.0, least(100.0, CASE WHEN {x} <= 1 THEN {x} * 100 WHEN {x} <= 10 THEN {x} * 10 ELSE {x} END)), 0) END"


def photo_scores(spark, sf, current=None):
    i = F.col("listing_id")
    d = lambda c: c.cast("double")
    return (_current(spark, sf) if current is None else current).select(
        F.col("event_id").alias("id"), F.when(i % 7 == 0, "mock").when(i % 7 != 1, "m").alias("model_provider"), F.when(i % 5 != 0, d(i % 10) / 10).alias("image_quality"), F.when(i % 3 != 0, d(i % 11)).alias("photo_quality"), F.when(i % 13 != 0, (i % 20) * 5.0).alias("brightness"), (d(i % 4) / 4).alias("sharpness"),
        F.when(i % 6 != 0, d(i % 100)).alias("exposure_quality"), (d(i % 17) / 17).alias("resolution_quality"), F.when(i % 3 == 0, 0.0).when(i % 3 == 1, 0.25).otherwise(0.75).alias("blurry_image_ratio"), (i % 6).alias("gallery_size"),
    )


@query("v4_photo_section", f"""WITH {CURRENT}, {_SC}, m AS (SELECT *, {_to100('coalesce(image_quality, photo_quality)')} AS q, {_to100('brightness')} AS b, {_to100('sharpness')} AS s, {_to100('exposure_quality')} AS e, {_to100('resolution_quality')} AS r, (model_provider IS NULL OR model_provider <> 'mock') AND (coalesce(image_quality, photo_quality) IS NOT NULL OR brightness IS NOT NULL) AS ok FROM sc)
SELECT id, ok AS available, CASE WHEN ok THEN q END AS quality, CASE WHEN ok THEN b END AS brightness, CASE WHEN ok THEN s END AS sharpness, CASE WHEN ok THEN concat_ws(',', CASE WHEN b IS NOT NULL AND e IS NOT NULL THEN CASE WHEN b >= 50 AND e >= 70 THEN 'bright_well_exposed' WHEN b < 50 THEN 'dim' ELSE 'uneven_exposure' END END,
  CASE WHEN blurry_image_ratio >= 0.5 THEN 'mostly_blurry' WHEN blurry_image_ratio > 0 THEN 'some_blurry' END, CASE WHEN r >= 60 THEN 'resolution_ok' WHEN r IS NOT NULL THEN 'resolution_low' END, CASE WHEN gallery_size < 3 THEN 'limited_coverage' END) END AS observations FROM m""")
def _(spark, sf):
    return photos.photo_section(photo_scores(spark, sf)).withColumn("observations", F.array_join("observations", ","))


@query("j21_photo_comparison", f"""WITH {_PAIRS}, b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY similarity DESC, o_id) AS rank FROM pairs WHERE similarity >= 60) WHERE rank <= 2), {_SC},
k AS (SELECT id, {_to100('coalesce(image_quality, photo_quality)')} AS quality, {_to100('brightness')} AS brightness, {_to100('sharpness')} AS sharpness FROM sc WHERE model_provider IS NULL OR model_provider <> 'mock'),
a AS (SELECT b.id, round_even(avg(k.quality), 0) AS mean_quality, round_even(avg(k.brightness), 0) AS mean_brightness, round_even(avg(k.sharpness), 0) AS mean_sharpness, count(k.quality) AS n_scored FROM b JOIN k ON k.id = b.o_id GROUP BY b.id)
SELECT k.*, mean_quality, mean_brightness, mean_sharpness, n_scored FROM k JOIN a USING (id) WHERE quality IS NOT NULL AND mean_quality IS NOT NULL""")
def _(spark, sf):
    best = valuation.best_comparables(valuation.comparables(_listings(spark, sf)))
    return photos.photo_comparison(best, photo_scores(spark, sf))


@query("j5_latest_snapshot_scores", f"WITH {SNAPS}, {LI.removeprefix(OBS + ', ')}, s AS (SELECT source, listing_id, arg_max(event_id, (day, event_id)) AS snapshot_id FROM sn GROUP BY ALL) SELECT li.id, s.snapshot_id, CAST(CASE WHEN listing_id % 3 = 0 THEN area END AS DOUBLE) AS stored FROM li JOIN s USING (source, listing_id) WHERE active AND listing_id % 4 > 0")
def _(spark, sf):
    li, key = _with_images(listings(spark, sf)), F.concat_ws("|", "source", "listing_id")
    snaps = _snaps(spark, sf).select(key.alias("id"), F.col("event_id").alias("snapshot_id"), "day")
    stored = li.filter("listing_id % 3 = 0").select(key.alias("id"), F.col("area").alias("stored"))
    out = photos.latest_snapshot_scores(li.withColumn("own", F.col("id")).withColumn("id", key), snaps, stored)
    return out.select(F.col("own").alias("id"), "snapshot_id", F.col("stored").cast("double").alias("stored"))


_V = "CASE WHEN listing_id % 4 = 0 THEN NULL ELSE sha256(array_to_string([url || '/' || k for k in range(1, listing_id % 4 + 1)], chr(10))) END"
_STORED = f"st AS (SELECT id, CASE WHEN listing_id % 3 = 0 THEN 'stale' ELSE {_V} END AS gallery, CASE WHEN listing_id % 5 = 1 THEN 'v1' ELSE 'v2' END AS version, CASE listing_id % 11 WHEN 0 THEN TIMESTAMP '2024-01-29 00:00:00' WHEN 1 THEN TIMESTAMP '2024-01-02 00:00:00' END AS failed_at FROM li WHERE listing_id % 2 = 0 AND listing_id % 4 > 0)"


def _stored_scores(spark, sf):
    i = F.col("listing_id")
    rows = _with_images(listings(spark, sf)).filter((i % 2 == 0) & (i % 4 > 0))
    failed = F.when(i % 11 == 0, F.lit("2024-01-29").cast("timestamp")).when(i % 11 == 1, F.lit("2024-01-02").cast("timestamp"))
    return rows.select("id", F.when(i % 3 == 0, "stale").otherwise(photos.gallery_hash(F.col("images"))).alias("gallery"), F.when(i % 5 == 1, "v1").otherwise("v2").alias("version"), failed.alias("failed_at"))


@query("v2_pending_galleries", f"""WITH {LI}, {_STORED}, m AS (SELECT li.id, {_V} AS gallery, st.gallery AS g, st.version, failed_at FROM li LEFT JOIN st USING (id) WHERE listing_id % 4 > 0)
SELECT id, gallery FROM m WHERE NOT (coalesce(gallery = g, FALSE) AND coalesce(failed_at > TIMESTAMP '2024-01-23 00:00:00', FALSE)) AND NOT (coalesce(gallery = g, FALSE) AND coalesce(version = 'v2', FALSE) AND failed_at IS NULL) ORDER BY id LIMIT 100""")
def _(spark, sf):
    return photos.pending_galleries(_with_images(listings(spark, sf)), _stored_scores(spark, sf), NOW, "v2", 100).select("id", "gallery")


@query("v3_merge_scores", f"""WITH {LI}, {_STORED}, r AS (SELECT id, 'g' || id AS gallery, 'v3' AS version, listing_id % 3 AS n FROM li WHERE listing_id % 4 <> 1)
SELECT coalesce(st.id, r.id) AS id, CASE WHEN r.n > 0 THEN r.gallery ELSE st.gallery END AS gallery, CASE WHEN r.n > 0 THEN 'v3' ELSE st.version END AS version, CASE WHEN r.n > 0 THEN NULL WHEN r.id IS NOT NULL THEN TIMESTAMP '2024-01-30 00:00:00' ELSE failed_at END AS failed_at FROM st FULL JOIN r ON st.id = r.id WHERE st.id IS NOT NULL OR r.n > 0""")
def _(spark, sf):
    i = F.col("listing_id")
    results = listings(spark, sf).filter(i % 4 != 1).select("id", F.concat(F.lit("g"), "id").alias("gallery"), F.lit("v3").alias("version"), (i % 3).alias("n_images"))
    return photos.merge_scores(_stored_scores(spark, sf), results, NOW).withColumn("failed_at", F.col("failed_at").cast("timestamp_ntz"))


# --- features ---------------------------------------------------------------


@query("p17_layout_codes", f"WITH {LI} SELECT id, CASE layout WHEN '1+kk' THEN 1 WHEN '2+kk' THEN 3 WHEN '3+kk' THEN 5.0 END AS layout_code FROM li")
def _(spark, sf):
    return listings(spark, sf).select("id", features.layout_code(F.col("layout")).cast("double").alias("layout_code"))


_FEATURES = f"""{SNAPS}, {LI.removeprefix(OBS + ', ')}, st AS (SELECT day AS stat_date, source, coalesce(deal_type, '') AS deal_type, coalesce(category, '') AS category, coalesce(locality, '') AS locality, coalesce(layout, '') AS layout, {_AGG} FROM sn WHERE price IS NOT NULL GROUP BY ALL),
ft AS (SELECT sn.event_id AS snapshot_id, sn.source, sn.listing_id, sn.day, sn.deal_type, sn.category, sn.locality, li.district, sn.layout, CAST(CASE sn.layout WHEN '1+kk' THEN 1 WHEN '2+kk' THEN 3 WHEN '3+kk' THEN 5 END AS DOUBLE) AS layout_code, CAST(sn.area AS DOUBLE) AS area, CAST(NULL AS DOUBLE) AS land_area, 48.5 AS lat, CAST(NULL AS DOUBLE) AS lon, st.median_price, st.median_sqm, CAST(st.n AS DOUBLE) AS n,
  CASE WHEN sn.listing_id % 2 = 0 THEN (sn.listing_id % 10) / 10.0 END AS photo_image_quality, CASE WHEN sn.listing_id % 2 = 0 THEN 0.5 END AS photo_brightness, CAST(NULL AS DOUBLE) AS photo_sharpness, sn.sqm AS target
  FROM sn JOIN li USING (source, listing_id) LEFT JOIN st ON st.stat_date = sn.day AND st.source = sn.source AND st.deal_type = coalesce(sn.deal_type, '') AND st.category = coalesce(sn.category, '') AND st.locality = coalesce(sn.locality, '') AND st.layout = coalesce(sn.layout, '') WHERE sn.deal_type = 'buy' AND sn.price IS NOT NULL)"""


def _feature_table(spark, sf, target="sale_price_per_sqm", snaps=None, homes=None):
    snaps, homes = snapshots(spark, sf) if snaps is None else snaps, listings(spark, sf) if homes is None else homes
    snaps = snaps.withColumn("snapshot_id", F.col("event_id")).withColumn("land_area", F.lit(None).cast("double"))
    day = snaps.drop("active").withColumn("stat_date", F.col("day").cast("string"))
    stats = market.market_statistics(day, ["stat_date", *market.DAILY]).withColumn("stat_date", F.col("stat_date").cast("date"))
    i = F.col("listing_id")
    scores = homes.filter("listing_id % 2 = 0").select("source", "listing_id", ((i % 10) / 10).alias("image_quality"), F.lit(0.5).alias("brightness"), F.lit(None).cast("double").alias("sharpness"))
    homes = homes.withColumns({"lat": F.lit(48.5), "lon": F.lit(None).cast("double")})
    return features.feature_table(snaps, homes, stats, scores, target)


@query("j3_feature_table", f"WITH {_FEATURES} SELECT * FROM ft")
def _(spark, sf):
    return _feature_table(spark, sf).withColumns({c: F.col(c).cast("double") for c in ("layout_code", "n")})


@query("m2_training_frame", f"WITH {_FEATURES} SELECT snapshot_id, target FROM ft WHERE target IS NOT NULL")
def _(spark, sf):
    return features.training_frame(_feature_table(spark, sf)).select("snapshot_id", "target")


@query("a11_model_metrics", f"WITH {_FEATURES}, p AS (SELECT target AS y, quantile_cont(target, 0.5) OVER (PARTITION BY day) AS p FROM ft WHERE target IS NOT NULL), m AS (SELECT avg(y) AS mean FROM p) SELECT round(avg(abs(y - p)), 6) AS mae, round(sqrt(avg((y - p) * (y - p))), 6) AS rmse, round(1 - sum((y - p) * (y - p)) / sum((y - mean) * (y - mean)), 6) AS r2 FROM p, m")
def _(spark, sf):
    """How well the day's median tells a listing's price per m2: what a model has to beat."""
    rows = _feature_table(spark, sf).filter("target IS NOT NULL").select("day", "target")
    medians = rows.groupBy("day").agg(F.percentile("target", 0.5).alias("median"))
    got = features.metrics(rows.join(medians, "day"), "target", "median")
    return spark.createDataFrame([tuple(round(got[m], 6) for m in ("mae", "rmse", "r2"))], "mae double, rmse double, r2 double")


@query("m5_market_of_requests", f"""WITH {LI}, {DAILY}, {_MEDIANS}, rq AS (SELECT id, locality, layout, district, category, CAST(CASE WHEN listing_id % 4 = 0 THEN 7 END AS DOUBLE) AS n FROM li WHERE listing_id % 3 > 0), x AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY deal_type, category, locality, layout ORDER BY stat_date DESC, n DESC, median_price DESC, source DESC) AS nth FROM daily WHERE deal_type = 'buy') WHERE nth = 1)
SELECT id, CASE WHEN rq.n IS NULL THEN CAST(coalesce(x.n, f.n, c.n) AS DOUBLE) ELSE rq.n END AS n, CASE WHEN rq.n IS NULL THEN coalesce(x.median_price, f.median_price, c.median_price) END AS median_price, CASE WHEN rq.n IS NULL THEN CASE WHEN x.n IS NOT NULL THEN 'exact' WHEN f.n IS NOT NULL THEN 'district_layout' WHEN c.n IS NOT NULL THEN 'district' END END AS context
FROM rq LEFT JOIN x ON x.category = coalesce(rq.category, '') AND x.locality = coalesce(rq.locality, '') AND x.layout = coalesce(rq.layout, '') LEFT JOIN dm f ON f.deal_type = 'buy' AND f.category = rq.category AND f.district = rq.district AND f.layout = rq.layout LEFT JOIN dm c ON c.deal_type = 'buy' AND c.category = rq.category AND c.district = rq.district AND c.layout IS NULL""")
def _(spark, sf):
    """Requests to value; one in four gives a number of listings of its own."""
    asked = _requests(spark, sf).withColumn("n", F.when(F.col("listing_id") % 4 == 0, F.lit(7.0)))
    return features.with_market(asked, "sale_price", daily(spark, sf), listings(spark, sf)).select("id", "n", "median_price", "context")


def _requests(spark, sf, homes=None):
    return (listings(spark, sf) if homes is None else homes).filter("listing_id % 3 > 0").select("id", "source", "listing_id", "category", "locality", "district", "layout", "area")


@query("m3_train_and_score")
def _(spark, sf):
    """Trained on the feature table, requests filled from the market and scored, the log appended to and read back."""
    told = ["source", "listing_id", "deal_type", "category", "locality", "layout", "area", "price"]
    snaps, homes = keep(snapshots(spark, sf).select("event_id", "day", *told), "snapshots"), keep(listings(spark, sf).select("id", "district", "active", *told), "listings")
    model, _ = features.train(_feature_table(spark, sf, "sale_price", snaps, homes))
    asked = features.with_market(_requests(spark, sf, homes), "sale_price", daily(spark, sf, homes), homes)
    path = scratch(spark, "predictions")
    features.prediction_log(features.score(model, asked, "sale_price"), "boosted", "sale_price", NOW).write.mode("append").parquet(path)
    log = spark.read.parquet(path)
    given = F.from_json("request", "id long, listing_id long, context string")
    return log.select(given["id"].alias("id"), given["listing_id"].alias("listing_id"), given["context"].alias("context"), "model", "target", "predicted_price")


@query("m6_prediction_log", f"""WITH {LI} SELECT 'm' AS model, 'sale_price' AS target, '{{"id":' || id || ',"area":' || area || '}}' AS request, CAST(area * 10 AS BIGINT) AS predicted_price, CAST(NULL AS DOUBLE) AS predicted_per_sqm, TIMESTAMP '2024-01-30 00:00:00' AS predicted_at FROM li""")
def _(spark, sf):
    scored = listings(spark, sf).select("id", "area", (F.col("area") * 10).cast("long").alias("predicted"))
    return features.prediction_log(scored, "m", "sale_price", NOW).withColumn("predicted_at", F.col("predicted_at").cast("timestamp_ntz"))


# --- stores -----------------------------------------------------------------


@query("s2_read_dumps", "SELECT event_type AS actor, CAST(ts AS DATE) AS landed, count(*) AS items, sum(event_id) AS ids FROM events GROUP BY ALL")
def _(spark, sf):
    """Dumps of events, a file for each type and day, written to the shared folder and read back."""
    e = table(spark, sf, "events").select("event_type", F.to_date("ts").cast("string").alias("day"), F.to_json(F.struct("event_id", "user_id")).alias("item"))
    folder = scratch(spark, "dumps")

    def write(pdf):
        import pandas as pd
        import pyarrow.fs as pafs

        fs, at = pafs.FileSystem.from_uri(folder)
        fs.create_dir(at, recursive=True)
        name = f"{pdf['event_type'].iloc[0]}_{pdf['day'].iloc[0]}_05-00-00.json"
        text = pdf["item"].iloc[0] if len(pdf) == 1 else "[" + ",".join(pdf["item"]) + "]"
        with fs.open_output_stream(f"{at}/{name}") as out:
            out.write(text.encode())
        return pd.DataFrame({"name": [name]})

    e.groupBy("event_type", "day").applyInPandas(write, "name string").count()
    items = io.read_dumps(spark, f"{folder}/*.json")
    return items.groupBy("actor", F.to_date("landed_at").alias("landed")).agg(F.count(F.lit(1)).alias("items"), F.sum(F.get_json_object("raw", "$.event_id").cast("long")).alias("ids"))


@query("s3_import_benchmarks", f"WITH {BENCH2} SELECT period, city, district, year, quarter, value, CAST(quarter * 10 AS INTEGER) AS transaction_count, source_name, n AS rows, n AS imported FROM (SELECT *, CASE WHEN quarter <= 2 THEN 'new' END AS source_name, (SELECT count(*) FROM b2) AS n FROM b2)")
def _(spark, sf):
    """A CSV of benchmarks, written to the shared folder and imported over a store that holds half of its keys with other values."""
    b, folder = bench2(spark, sf), scratch(spark, "benchmarks")
    csv = b.select("*", F.format_string("%d.0", F.col("quarter") * 10).alias("transaction_count"), F.when(F.col("quarter") <= 2, "new").otherwise("  ").alias("source_name"), F.lit("y").alias("extra"))
    csv.write.csv(folder, header=True)
    empty = {c: F.lit(None).cast(t) for c, t in io.BENCHMARK.items()}
    stored = b.filter("quarter % 2 = 0").withColumn("value", F.lit(-1.0)).select(*[(F.col(c).cast(t) if c in b.columns else empty[c]).alias(c) for c, t in io.BENCHMARK.items()])
    out, counts = io.import_benchmarks(spark, folder, stored)
    return out.select("period", "city", "district", "year", "quarter", "value", "transaction_count", "source_name", F.lit(counts["rows"]).cast("long").alias("rows"), F.lit(counts["imported"]).cast("long").alias("imported"))


@query("s4_melted_index", f"WITH {BENCH}, w AS (SELECT * FROM bench WHERE granularity = 'region') SELECT CASE WHEN place = 'ASIA' THEN 'city' ELSE 'district' END AS granularity, place, period, CAST(year AS INTEGER) AS year, CAST(quarter AS INTEGER) AS quarter, value FROM w")
def _(spark, sf):
    b = benchmarks(spark, sf).filter("granularity = 'region'")
    names = [r[0] for r in places(spark, sf).select("region").distinct().collect()]  # 5 regions
    wide = b.groupBy(F.format_string("%dQ %d", "quarter", "year").alias("q")).pivot("place", sorted(names)).agg(F.first("value"))
    return io.melt_index(wide, "q", "ASIA").filter("value IS NOT NULL")


@query("s7b_day_partitions", f"""WITH {SNAP}, k AS (SELECT source, listing_id, day, event_id, price FROM snap), a AS (SELECT * FROM k WHERE event_id % 3 <> 0), b AS (SELECT source, listing_id, day, event_id, price + 1 AS price FROM k WHERE day >= DATE '2024-01-15' AND event_id % 2 = 0)
SELECT source, listing_id, day, coalesce(b.price, a.price) AS price FROM a FULL JOIN b USING (source, listing_id, day)""")
def _(spark, sf):
    """Snapshots stored by day; a second run merges its days' rows and leaves the others' files alone."""
    snaps = _snaps(spark, sf).select("source", "listing_id", "event_id", "price", "day")
    path, keys = scratch(spark, "snapshots"), ["source", "listing_id", "day"]
    merge.upsert_partitions(spark, path, snaps.filter("event_id % 3 <> 0"), keys, "day")
    late = snaps.filter("day >= '2024-01-15' AND event_id % 2 = 0").withColumn("price", F.col("price") + 1)
    merge.upsert_partitions(spark, path, late, keys, "day")
    return spark.read.schema(snaps.schema).parquet(path).drop("event_id")


@query("s7c_statistics_partitions", f"WITH {LI}, {DAILY}, x AS (SELECT source, deal_type, category, locality, layout, n, median_price FROM daily) SELECT DATE '2024-01-29' AS stat_date, * FROM x UNION ALL SELECT DATE '2024-01-30', source, deal_type, category, locality, layout, CASE WHEN source = 'click' THEN n * 2 ELSE n END, median_price FROM x")
def _(spark, sf):
    """Two days of statistics; the second is made again with other counts for one source."""
    path = scratch(spark, "statistics")
    keys = ["stat_date", *market.DAILY]
    stats = keep(daily(spark, sf).select(*market.DAILY, "n", "median_price", "stat_date"), "statistics")
    for rows in (stats.withColumn("stat_date", F.date_sub("stat_date", 1)), stats, stats.filter("source = 'click'").withColumn("n", F.col("n") * 2)):
        merge.upsert_partitions(spark, path, rows, keys, "stat_date")
    return spark.read.schema(stats.schema).parquet(path).select(*keys, "n", "median_price")


@query("s7d_merge_benchmarks", f"WITH {BENCH2} SELECT period, city, district, CASE WHEN quarter % 2 = 0 THEN 'old' ELSE granularity END AS granularity, CASE WHEN quarter = 2 THEN -1.0 ELSE value END AS value FROM b2")
def _(spark, sf):
    """Null-safe keys; granularity isn't refreshed; quarter 2 is stored only."""
    b = bench2(spark, sf)
    full = lambda df: df.select(*[(F.col(c).cast(t) if c in b.columns else F.lit(None).cast(t)).alias(c) for c, t in io.BENCHMARK.items()])
    stored = full(b.filter("quarter % 2 = 0").withColumn("value", F.lit(-1.0)).withColumn("granularity", F.lit("old")))
    return merge.merge_benchmarks(stored, full(b.filter("quarter <> 2"))).select("period", "city", "district", "granularity", "value")


@query("s7e_merge_features", f"WITH {SNAP}, k AS (SELECT event_id AS snapshot_id, event_id % 2 AS feature_set_id, price AS f FROM snap) SELECT snapshot_id, feature_set_id, CASE WHEN snapshot_id % 3 = 0 THEN f * 2 ELSE f END AS f FROM k WHERE snapshot_id % 5 <> 0 OR snapshot_id % 3 = 0")
def _(spark, sf):
    rows = _snaps(spark, sf).select(F.col("event_id").alias("snapshot_id"), (F.col("event_id") % 2).alias("feature_set_id"), F.col("price").alias("f"))
    return merge.merge_features(rows.filter("snapshot_id % 5 <> 0"), rows.filter("snapshot_id % 3 = 0").withColumn("f", F.col("f") * 2)).drop("merge_action")


@query("s7h_feature_sets", "SELECT p_brand AS name, 'v' || (p_size % 3) AS version, p_type AS target, min(p_partkey) FILTER (p_partkey % 2 = 0) IS NOT NULL AS known, CASE WHEN min(p_partkey) FILTER (p_partkey % 2 = 1) IS NOT NULL THEN 'new' ELSE 'old' END AS description, CAST(min(p_partkey) FILTER (p_partkey % 2 = 0) AS DOUBLE) AS id FROM part GROUP BY ALL")
def _(spark, sf):
    key = [F.col("p_brand").alias("name"), F.concat(F.lit("v"), F.col("p_size") % 3).alias("version"), F.col("p_type").alias("target")]
    part = table(spark, sf, "part").select(*key, "p_partkey")
    stored = part.filter("p_partkey % 2 = 0").groupBy("name", "version", "target").agg(F.min("p_partkey").cast("long").alias("id")).withColumns({"description": F.lit("old"), "code_version": F.lit("1")})
    wanted = part.filter("p_partkey % 2 = 1").select("name", "version", "target").distinct().withColumns({"description": F.lit("new"), "code_version": F.lit("2")})
    out = merge.merge_feature_sets(stored, wanted)
    known = F.col("merge_action") != "inserted"
    return out.select("name", "version", "target", known.alias("known"), "description", F.when(known, F.col("id")).cast("double").alias("id"))


_BILL = "e AS (SELECT o_orderkey AS nth, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_custkey END AS u, 'c' || o_custkey AS customer_id, CASE WHEN o_orderkey % 4 = 0 THEN 'pro' END AS plan, CASE o_orderstatus WHEN 'F' THEN 'active' WHEN 'P' THEN 'past_due' END AS status FROM orders), s AS (SELECT c_custkey AS user_id, 'c' || c_custkey AS customer_id, 'basic' AS plan, 'canceled' AS status FROM customer WHERE c_custkey % 2 = 0), m AS (SELECT e.*, coalesce(u, s.user_id) AS user_id FROM e LEFT JOIN s USING (customer_id))"


def _billing(spark, sf):
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    events = o.select(F.col("o_orderkey").alias("nth"), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey")).alias("user_id"), F.concat(F.lit("c"), "o_custkey").alias("customer_id"), F.when(F.col("o_orderkey") % 4 == 0, "pro").alias("plan"), F.when(F.col("o_orderstatus") == "F", "active").when(F.col("o_orderstatus") == "P", "past_due").alias("status"))
    stored = c.filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("user_id"), F.concat(F.lit("c"), "c_custkey").alias("customer_id"), F.lit("basic").alias("plan"), F.lit("canceled").alias("status"), F.lit(True).alias("cancel_at_period_end"))
    return events, stored


@query("c3_billing_events", f"WITH {_BILL} SELECT CAST(user_id AS DOUBLE) AS user_id, arg_max(plan, nth) AS plan, arg_max(status, nth) AS status, FALSE AS orphan FROM m WHERE user_id IS NOT NULL GROUP BY user_id UNION ALL SELECT NULL, plan, status, TRUE FROM m WHERE user_id IS NULL")
def _(spark, sf):
    known, orphans = merge.billing_updates(*_billing(spark, sf), "nth", ["plan", "status"])
    both = known.withColumn("orphan", F.lit(False)).unionByName(orphans.select("user_id", "plan", "status").withColumn("orphan", F.lit(True)))
    return both.withColumn("user_id", F.col("user_id").cast("double"))


@query("s7j_merge_subscriptions", f"WITH {_BILL}, n AS (SELECT user_id, arg_max(plan, nth) AS plan, arg_max(status, nth) AS status, max(customer_id) AS customer_id FROM m WHERE user_id IS NOT NULL GROUP BY user_id) SELECT coalesce(s.user_id, n.user_id) AS user_id, coalesce(n.customer_id, s.customer_id) AS customer_id, coalesce(n.plan, s.plan, 'basic') AS plan, coalesce(n.status, s.status, 'none') AS status, s.user_id IS NOT NULL AS cancel_at_period_end FROM s FULL JOIN n ON s.user_id = n.user_id")
def _(spark, sf):
    events, stored = _billing(spark, sf)
    updates, _ = merge.billing_updates(events, stored, "nth", ["plan", "status", "customer_id"])
    updates = updates.withColumn("cancel_at_period_end", F.lit(None).cast("boolean"))
    return merge.merge_subscriptions(stored, updates).drop("merge_action")


@query("c2_user_facts", f"WITH {_BILL} SELECT c_custkey AS id, lower(c_name) AS email, CASE WHEN c_custkey % 9 = 0 THEN 'admin' ELSE 'user' END AS role, c_custkey % 2 = 0 AS has_google, c_custkey % 3 > 0 AS has_password, CASE WHEN c_custkey % 9 = 0 OR c_custkey % 10 = 0 THEN 'pro' ELSE 'basic' END AS plan, status FROM customer LEFT JOIN s ON user_id = c_custkey")
def _(spark, sf):
    k = F.col("c_custkey")
    users = table(spark, sf, "customer").select(k.alias("id"), F.lower("c_name").alias("email"), F.when(k % 9 == 0, "admin").alias("role"), F.when(k % 2 == 0, "g").alias("google_sub"), F.when(k % 3 > 0, "h").alias("password_hash"), (k % 10 == 0).alias("pro_override"))
    return search.user_facts(users, _billing(spark, sf)[1])


@query("a8_run_summary", f"WITH {CHANGES}, a AS (SELECT DISTINCT source, listing_id FROM obs WHERE event_id % 7 = 0), b AS (SELECT DISTINCT source, listing_id FROM obs WHERE event_id % 7 <> 0) SELECT (SELECT count(*) FROM b ANTI JOIN a USING (source, listing_id)) AS n_new, (SELECT count(*) FROM b SEMI JOIN a USING (source, listing_id)) AS n_updated, (SELECT count(*) FROM changes) AS n_price_changes, (SELECT count(*) FROM events WHERE value > 40) AS n_failed, CASE WHEN (SELECT count(*) FROM events WHERE value > 40) > 0 THEN 'completed_with_errors' ELSE 'succeeded' END AS status")
def _(spark, sf):
    obs = observations(spark, sf)
    half = lambda cond: obs.filter(cond).select("source", "listing_id").distinct()
    return merge.run_summary(merge.merge_by_key(half("event_id % 7 = 0"), half("event_id % 7 <> 0"), ["source", "listing_id"]), _changes(spark, sf), table(spark, sf, "events").filter("value > 40"))


@query("s8_training_lineage", f"WITH {_FEATURES} SELECT 'sale_price_per_sqm' AS target, count(*) AS row_count, 21 AS column_count, 'n' AS notes FROM ft WHERE target IS NOT NULL")
def _(spark, sf):
    frame = features.training_frame(_feature_table(spark, sf))
    return io.export_training(frame, scratch(spark, "training"), "sale_price_per_sqm", "n").drop("path")


@query("s9_exported_index", f"""WITH {SNAP} SELECT strftime(day, '%Y-%m-%d') AS date, {r2('percentile_cont(0.5) WITHIN GROUP (ORDER BY price)')} AS median_price, {r2('percentile_cont(0.5) WITHIN GROUP (ORDER BY sqm)')} AS median_price_per_sqm, count(*) AS property_count, 'market-index-buy-house-nov-mesto-3.csv' AS file FROM (SELECT *, {SQM} AS sqm FROM snap WHERE price IS NOT NULL AND deal_type = 'buy' AND category = 'house') GROUP BY day""")
def _(spark, sf):
    series = market.median_index(_snaps(spark, sf).filter("deal_type = 'buy' AND category = 'house'"))
    path = io.export_index(series, scratch(spark, "index"), "buy", "house", "Nové Mesto 3")
    back = spark.read.csv(path, header=True, schema="date string, median_price double, median_price_per_sqm double, property_count long")
    return back.withColumn("file", F.lit(path.rpartition("/")[2]))


@query("u2_image_union", f"WITH {LI}, a AS (SELECT id, list_filter([url || '/1', NULL, '', url || '/' || (listing_id % 3), url || '/2', url || '/1'], lambda x: x IS NOT NULL AND x <> '') AS l FROM li) SELECT id, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), '|') AS images FROM a")
def _(spark, sf):
    url = lambda c: F.concat_ws("/", "url", c)
    first = F.array(url(F.lit("1")), F.lit(None).cast("string"), F.lit(""))
    second = F.array(url((F.col("listing_id") % 3).cast("string")), url(F.lit("2")), url(F.lit("1")))
    return listings(spark, sf).select("id", F.array_join(normalize.image_urls(first, F.lit(None).cast("array<string>"), second), "|").alias("images"))


@query("u3_universal_log", "SELECT event_id, CAST(user_id AS DOUBLE) AS user_id, value, NULL AS ts FROM events WHERE event_type = 'click' UNION ALL SELECT event_id, NULL, value, ts FROM events WHERE event_type = 'view'")
def _(spark, sf):
    e = table(spark, sf, "events")
    return normalize.universal_log(e.filter("event_type = 'click'").select("event_id", "user_id", "value"), e.filter("event_type = 'view'").select("event_id", "value", "ts")).withColumn("user_id", F.col("user_id").cast("double"))


# --- places -----------------------------------------------------------------

_TOWN = "CASE c_custkey % 4 WHEN 0 THEN lower(n_name) WHEN 1 THEN substr(n_name, 1, 4) WHEN 2 THEN 'nowhere' END"
_TOWNS = "t AS (SELECT n_name AS town, n_name || ' d' AS district, r_name AS region, n_nationkey + 0.5 AS lat FROM nation JOIN region ON n_regionkey = r_regionkey)"


def _towns(spark, sf):
    p = places(spark, sf)
    return p.select(F.col("district").alias("town"), F.concat("district", F.lit(" d")).alias("district"), "region", (F.col("place_no") + 0.5).alias("lat"), F.lit(0.0).alias("lon"))


def _asked_towns(spark, sf):
    c, k = table(spark, sf, "customer"), F.col("c_custkey")
    c = c.join(F.broadcast(places(spark, sf)), c["c_nationkey"] == F.col("place_no"))
    return c.select("c_custkey", F.when(k % 4 == 0, F.lower("district")).when(k % 4 == 1, F.substring("district", 1, 4)).when(k % 4 == 2, "nowhere").alias("asked"), "district")


@query("j10_towns", f"WITH {_TOWNS}, al AS (SELECT substr(town, 1, 4) AS alias, min(town) AS town FROM t WHERE substr(town, 1, 4) NOT IN (SELECT town FROM t) GROUP BY ALL HAVING count(*) = 1), k AS (SELECT town AS name, * FROM t UNION ALL SELECT alias, t.* FROM al JOIN t USING (town)) SELECT c_custkey, k.district AS town_district, region AS town_region, lat AS town_lat FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN k ON lower(k.name) = lower({_TOWN})")
def _(spark, sf):
    towns = _towns(spark, sf)
    short = towns.groupBy(F.substring("town", 1, 4).alias("alias")).agg(F.min("town").alias("town"), F.count(F.lit(1)).alias("n")).filter("n = 1").drop("n")
    return geo.with_region(_asked_towns(spark, sf), towns, "asked", short.join(towns.select(F.col("town").alias("alias")), "alias", "left_anti")).select("c_custkey", "town_district", "town_region", "town_lat")


@query("j11_index_region", f"WITH {_TOWNS}, k AS (SELECT lower(district) AS name, region FROM t UNION ALL SELECT lower(town), region FROM t), q AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 3 = 1 THEN n_name || ' d' ELSE 'x' END AS d, CASE WHEN c_custkey % 2 = 0 THEN lower(n_name) END AS c FROM customer JOIN nation ON c_nationkey = n_nationkey) SELECT c_custkey, coalesce(a.region, b.region, 'SR') AS index_region FROM q LEFT JOIN k a ON a.name = lower(d) LEFT JOIN k b ON b.name = lower(c)")
def _(spark, sf):
    towns, k = _towns(spark, sf), F.col("c_custkey")
    asked = _asked_towns(spark, sf).select("c_custkey", F.when(k % 3 == 1, F.concat("district", F.lit(" d"))).when(k % 3 == 2, "x").alias("district"), F.when(k % 2 == 0, F.lower("district")).alias("city"))
    return geo.index_region(asked, towns.select(F.col("district").alias("name"), "region"), towns=towns).select("c_custkey", "index_region")


@query("j20_admin_district", "WITH q AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'Praha ' || (c_custkey % 10 + 1) WHEN 1 THEN 'Praha - ' || lower(n_name) WHEN 2 THEN n_name ELSE 'Brno' END AS district FROM customer JOIN nation ON c_nationkey = n_nationkey) SELECT c_custkey, q.district, CASE WHEN c_custkey % 4 = 0 THEN q.district WHEN n_name IS NOT NULL THEN 'Praha ' || n_nationkey END AS admin_district FROM q LEFT JOIN nation ON lower(trim(split_part(q.district, '-', -1))) = lower(n_name)")
def _(spark, sf):
    k = F.col("c_custkey")
    named = F.when(k % 4 == 0, F.concat(F.lit("Praha "), k % 10 + 1)).when(k % 4 == 1, F.concat(F.lit("Praha - "), F.lower("district"))).when(k % 4 == 2, F.col("district")).otherwise("Brno")
    asked = _asked_towns(spark, sf).select("c_custkey", named.alias("district"))
    areas = places(spark, sf).select(F.col("district").alias("area"), F.concat(F.lit("Praha "), "place_no").alias("district"))
    return geo.administrative_district(asked, areas)


_NAMES = ["Tatranskej", "Orechova", "Javorovej", "Jarnej", "Starej Jarnej", "Dlhej Tatranskej", "Nemeckej Jarnej ceste", "Hlavná"]
_SPELT = "CASE WHEN lower(w) LIKE '%skej' OR lower(w) LIKE '%ckej' OR (lower(w) LIKE '%nej' AND lower(w) NOT LIKE '%ovej') THEN [left(w, length(w) - 2) || 'á', left(w, length(w) - 2) || 'a'] WHEN lower(w) LIKE '%ovej' THEN [left(w, length(w) - 2) || 'a'] ELSE [w] END"


@query("x2_street_candidates", f"""WITH n AS (SELECT c_custkey, [{', '.join(repr(x) for x in _NAMES)}][c_custkey % {len(_NAMES)} + 1] AS name FROM customer), w AS (SELECT c_custkey, name, [{_SPELT} for w in string_split(name, ' ')] AS v FROM n),
c AS (SELECT c_custkey, name, CASE len(v) WHEN 1 THEN v[1] WHEN 2 THEN flatten([[x || ' ' || y for y in v[2]] for x in v[1]]) ELSE flatten([flatten([[x || ' ' || y || ' ' || z for z in v[3]] for y in v[2]]) for x in v[1]]) END AS made FROM w)
SELECT c_custkey, array_to_string(CASE WHEN list_contains(made[:4], name) THEN made[:4] ELSE list_append(made[:4], name) END, '|') AS candidates FROM c""")
def _(spark, sf):
    name = F.element_at(F.array(*map(F.lit, _NAMES)), (F.col("c_custkey") % len(_NAMES) + 1).cast("int"))
    return table(spark, sf, "customer").select("c_custkey", F.array_join(geo.street_candidates(name), "|").alias("candidates"))


#: What listings say, the spellings to try, and how the gazetteer writes the street.
_SAID = [("Byt, ul. Hlavná 12", None, ["Hlavná"]), ("Dom", "pekny dom na Jarnej ulici", ["Jarná", "Jarna", "Jarnej"]), ("Nám. Slobody 3", "ul. Dlhá", ["námestie Slobody", "Slobody"]), ("bez adresy", "nic", []), (None, "ul. Dlhá 7", ["Dlhá"])]
_GAZETTEER = [("hlavna", 0.0), ("Jarna", 0.1), ("NÁMESTIE SLOBODY", 0.05), ("Slobody", 0.0), ("Dlhá", 2.0)]
_GEO = f"""said AS (SELECT * FROM (VALUES {', '.join(f"({i}, {c!r})" for i, (_, _, c) in enumerate(_SAID))}) v(form, candidates)), gz AS (SELECT * FROM (VALUES {', '.join(f"('{s}', {d})" for s, d in _GAZETTEER)}) v(street, off)),
q AS (SELECT c_custkey AS id, candidates, CASE WHEN c_custkey % 7 > 0 THEN n_name END AS town, c_custkey % 2 AS far FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN said ON form = c_custkey % {len(_SAID)}),
u AS (SELECT id, candidates, town, unnest(candidates) AS cand, generate_subscripts(candidates, 1) AS nth FROM q), m AS (SELECT id, arg_min(cand, nth) AS cand, arg_min(off, nth) AS off FROM u JOIN gz ON strip_accents(lower(street)) = strip_accents(lower(cand)) WHERE town IS NOT NULL AND off < 0.2 GROUP BY id),
gc AS (SELECT q.id, CASE WHEN town IS NOT NULL THEN coalesce(m.cand, candidates[1]) END AS street, 48 + m.off AS geo_lat, CASE WHEN m.off IS NOT NULL THEN 'street' END AS geo_precision FROM q LEFT JOIN m USING (id))"""


def _geocoded(spark, sf):
    k = F.col("c_custkey")
    pick = lambda i: F.element_at(F.array(*[F.lit(x[i]).cast("string") for x in _SAID]), (k % len(_SAID) + 1).cast("int"))
    rows = _asked_towns(spark, sf).select(k.alias("id"), pick(0).alias("name"), pick(1).alias("content"), F.when(k % 7 > 0, F.lower("district")).alias("city"), F.lit(None).cast("string").alias("locality"), F.lit(48.0).alias("lat"), F.lit(17.0).alias("lon"))
    streets = spark.createDataFrame(_GAZETTEER, "street string, off double").crossJoin(places(spark, sf).select(F.col("district").alias("town")))  # 5 streets x 25 towns
    return geo.geocode_batch(rows, streets.select("street", "town", (F.lit(48.0) + F.col("off")).alias("lat"), F.lit(17.0).alias("lon")), NOW)


@query("x3_geocode_batch", f"WITH {_GEO} SELECT * FROM gc")
def _(spark, sf):
    return _geocoded(spark, sf)[0].select("id", "street", "geo_lat", "geo_precision")


@query("a14_geocode_counters", f"WITH {_GEO} SELECT count(*) AS processed, count(street) AS with_street, count(geo_precision) AS geocoded FROM gc")
def _(spark, sf):
    return _geocoded(spark, sf)[1]


_TAGS = [("amenity", "school"), ("shop", "supermarket"), ("highway", "bus_stop"), ("railway", "station"), ("leisure", "park"), ("amenity", "cafe"), ("amenity", "pharmacy"), ("amenity", "bank"), ("shop", "books"), ("name", "x")]


@query("x4_poi_category", f"SELECT s_suppkey, [{', '.join(repr(x) if x else 'NULL' for x in ('schools', 'grocery', 'transport', 'transport', 'parks', 'restaurants', 'healthcare', None, None, None))}][s_suppkey % 10 + 1] AS category FROM supplier")
def _(spark, sf):
    nth = (F.col("s_suppkey") % 10 + 1).cast("int")
    tags = F.create_map(F.element_at(F.array(*[F.lit(k) for k, _ in _TAGS]), nth), F.element_at(F.array(*[F.lit(v) for _, v in _TAGS]), nth))
    return table(spark, sf, "supplier").select("s_suppkey", geo.poi_category(tags).alias("category"))


_C = "SELECT c_custkey AS point_id, 48.0 + (c_custkey * 37 % 1000) / 10000 AS lat, 17.0 + (c_custkey * 91 % 1000) / 10000 AS lon FROM customer"
_SUM = " + ".join(f"{w} * least({c} / {f}.0, 1.0)" for c, w, f in geo.SCORE)


@query("x5_location_batch", f"""WITH c AS ({_C}), s AS ({_S}), d AS (SELECT *, 2 * 6371000.0 * asin(sqrt(least(pow(sin(radians(p_lat - lat) / 2), 2) + cos(radians(lat)) * cos(radians(p_lat)) * pow(sin(radians(p_lon - lon) / 2), 2), 1.0))) AS m FROM c, s WHERE point_id % 3 <> 0),
n AS (SELECT point_id AS id, {', '.join(f"count(*) FILTER (category = '{c}' AND m <= {r}) AS {n}" for n, c, r in WANTED)} FROM d GROUP BY point_id)
SELECT id, transport_500m, CAST(round(CAST(({_SUM}) * 100 AS DECIMAL(18,6)), 1) AS DOUBLE) AS location_score FROM n WHERE id % 5 <> 0 UNION ALL SELECT c_custkey, -1, -1.0 FROM customer WHERE c_custkey % 3 = 0""")
def _(spark, sf):
    pts, pois = _points(spark, sf)
    names = [n for n, _, _ in WANTED]
    stored = pts.filter("point_id % 3 = 0").select(F.col("point_id").alias("id"), *[F.lit(-1).cast("long").alias(n) for n in names], F.lit(-1.0).alias("location_score"))
    rows = pts.select(F.col("point_id").alias("id"), "lat", "lon", (F.col("point_id") % 5 != 0).alias("active"))
    return geo.location_batch(rows, stored, pois, WANTED)[0].select("id", "transport_500m", "location_score")


@query("p15_url_repair", "WITH u AS (SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'https://www.bezrealitky.cz/' || page_id || '-x' WHEN 1 THEN 'https://www.bezrealitky.cz/nemovitosti-byty-domy/' || page_id || '-x' ELSE url END AS url FROM pages) SELECT page_id, CASE WHEN contains(url, 'bezrealitky.cz/') AND NOT contains(url, 'nemovitosti-byty-domy/') THEN replace(url, 'bezrealitky.cz/', 'bezrealitky.cz/nemovitosti-byty-domy/') ELSE url END AS url FROM u")
def _(spark, sf):
    k = F.col("page_id").cast("string")
    url = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("https://www.bezrealitky.cz/"), k, F.lit("-x"))).when(F.col("page_id") % 3 == 1, F.concat(F.lit("https://www.bezrealitky.cz/nemovitosti-byty-domy/"), k, F.lit("-x"))).otherwise(F.col("url"))
    return table(spark, sf, "pages").select("page_id", normalize.repaired_url(url).alias("url"))


@query("p16_deal_type_backfill", f"WITH {LI} SELECT id, coalesce(CASE WHEN listing_id % 3 = 0 THEN deal_type END, CASE WHEN listing_id % 4 = 1 THEN 'rent' WHEN listing_id % 4 IN (0, 2) THEN 'buy' END, CASE WHEN listing_id % 2 = 0 THEN NULL WHEN listing_id % 5 = 0 THEN 'rent' WHEN listing_id % 5 = 1 THEN 'buy' END, 'buy') AS deal_type FROM li")
def _(spark, sf):
    i = F.col("listing_id")
    raw = F.when(i % 2 == 0, "{}").when(i % 5 == 0, '{"offerType": "PRONAJEM"}').when(i % 5 == 1, '{"dealType": "Prodej"}').otherwise('{"dealType": "swap"}')
    return listings(spark, sf).select("id", normalize.backfilled_deal_type(F.when(i % 3 == 0, F.col("deal_type")), F.col("url"), raw).alias("deal_type"))


