"""Valuation documents for all listings, and projections by region, as queries with their SQL."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import functions as F

from estatelake.functions.columns import rounded
from estatelake.operators import geo, report, valuation
from estatelake.plans.domain import BENCH, benchmarks, places, point, r2, table
from estatelake.plans.jobs import _SC, _to100, facts, photo_scores
from estatelake.plans.registry import _S, WANTED, _current, _points, query
from estatelake.sources.shared import keep

OPTIONS = report.Options(datetime(2024, 2, 1, 6, tzinfo=UTC))

# --- inputs -----------------------------------------------------------------


def rows(spark, sf):
    """Listings with all that a document shows; some have no price, category, gallery or point."""
    i = F.col("listing_id")
    lat, lon = point(i, 37, 91)
    out = facts(_current(spark, sf)).withColumns({"price": F.when(i % 11 != 0, F.col("price")), "category": F.when(i % 23 != 0, F.col("category"))}).drop("sqm")
    out = out.withColumns({"title": F.concat(F.lit("Listing "), i.cast("string")), "city": F.col("region"), "land_area": F.when(F.col("category") == "house", F.col("area") * 10), "image_url": F.when(i % 4 != 0, F.concat("url", F.lit("/0")))})
    images = F.transform(F.filter(F.sequence(F.lit(0), F.lit(2)), lambda k: k < i % 3), lambda k: F.concat(F.col("url"), F.lit("/"), k.cast("string")))
    return out.withColumns({"images": images, "lat": F.when(i % 9 != 0, lat), "lon": F.when(i % 9 != 0, lon)})


def region_table(spark, sf):
    """(name, region): some districts are in no region, so the nation's figures hold."""
    return places(spark, sf).filter("place_no % 6 <> 5").select(F.col("district").alias("name"), "region")


def growth_table(spark, sf):
    own = table(spark, sf, "region").select(F.col("r_name").alias("region"), (4 + F.col("r_regionkey") * 0.5).cast("double").alias("growth_pct"))
    return own.unionByName(spark.createDataFrame([("SR", 7.0)], own.schema))


def index_table(spark, sf):
    """(region, year, quarter, period, value), the nation under 'SR'."""
    own = benchmarks(spark, sf).filter("granularity = 'region'").select(F.col("place").alias("region"), "year", "quarter", "period", "value")
    nation = table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("quarter")).agg(rounded(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double") / F.count(F.lit(1))).alias("value"))
    return own.unionByName(nation.select(F.lit("SR").alias("region"), "year", "quarter", F.format_string("%d_Q%d", "year", "quarter").alias("period"), "value"))


def place_table(spark, sf, listings):
    known = listings.filter("lat IS NOT NULL").select(F.col("id").alias("point_id"), "lat", "lon")
    return geo.place_counts(known, _points(spark, sf)[1], WANTED).drop("lat", "lon").withColumnRenamed("point_id", "id")


def documents(spark, sf):
    listings = keep(rows(spark, sf), "listings")
    scores = photo_scores(spark, sf, listings).withColumn("dark_image_ratio", F.when(F.col("id") % 2 == 0, (F.col("id") % 4).cast("double") / 4))
    return report.valuation_reports(listings, index_table(spark, sf), region_table(spark, sf), growth_table(spark, sf), scores, place_table(spark, sf, listings), OPTIONS)


# --- the same in SQL --------------------------------------------------------

_SIM = """CAST(round_even((CASE WHEN layout = o_layout THEN 40 ELSE 0 END + CASE WHEN area > 0 AND o_area > 0 THEN 30 * greatest(0.0, 1 - abs(area - o_area) / area) ELSE 0 END + CASE WHEN sqm > 0 AND o_sqm > 0 THEN 30 * greatest(0.0, 1 - abs(sqm - o_sqm) / sqm) ELSE 0 END)
  / (40.0::DOUBLE + CASE WHEN area > 0 AND o_area > 0 THEN 30 ELSE 0 END + CASE WHEN sqm > 0 AND o_sqm > 0 THEN 30 ELSE 0 END) * 100, 0) AS INTEGER)"""
_SLUG = "CASE listing_id % 4 WHEN 0 THEN 'prodej' WHEN 1 THEN 'pronajem' WHEN 2 THEN 'predaj' ELSE 'detail' END"


def _met(scope: str) -> str:
    return f"""(SELECT *, {_SIM} AS similarity FROM (SELECT a.id, a.layout, a.area, a.price, a.sqm, b.id AS o_id, b.layout AS o_layout, b.area AS o_area, b.price AS o_price, b.sqm AS o_sqm, row_number() OVER (PARTITION BY a.id ORDER BY b.id) AS nth
  FROM ri a JOIN ri b ON a.{scope} = b.{scope} AND (a.category IS NULL OR a.category = b.category) AND (a.deal_type IS NULL OR a.deal_type = b.deal_type) AND a.id <> b.id AND b.active AND b.price IS NOT NULL AND b.sqm IS NOT NULL) WHERE nth <= 200)"""


RI = BENCH + f""", obs AS (
  SELECT event_id, event_type AS source, user_id AS listing_id, ts AS scraped_at, CAST(round(CAST(value AS DECIMAL(18,6)), 2) AS DOUBLE) AS price, CAST(json_extract_string(props, '$.k') AS INTEGER) + 10 AS area, CASE WHEN user_id % 3 = 0 THEN 'rent' ELSE 'buy' END AS deal_type,
    CASE user_id % 4 WHEN 0 THEN 'apartment' WHEN 1 THEN 'house' WHEN 2 THEN 'land' ELSE 'commercial' END AS category, n_name AS district, r_name AS region, n_nationkey AS place_no
  FROM events JOIN nation ON n_nationkey = user_id % 25 JOIN region ON n_regionkey = r_regionkey),
cur AS (
  SELECT * EXCLUDE (nth) FROM (SELECT *, min(scraped_at) OVER (PARTITION BY source, listing_id) AS first_seen_at, max(scraped_at) OVER (PARTITION BY source, listing_id) AS last_seen_at,
    row_number() OVER (PARTITION BY source, listing_id ORDER BY scraped_at DESC, event_id DESC) AS nth FROM obs) WHERE nth = 1),
r0 AS (SELECT event_id AS id, source, listing_id, district, region, region AS city, place_no, deal_type, CASE WHEN listing_id % 23 <> 0 THEN category END AS category, CASE WHEN listing_id % 7 <> 0 THEN (listing_id % 3 + 1) || '+kk' END AS layout, area, CASE WHEN listing_id % 11 <> 0 THEN price END AS price,
  district || ' ' || (listing_id % 2) AS locality, 'https://x.example/' || {_SLUG} || '/' || listing_id AS url, listing_id % 5 <> 0 AS active, first_seen_at, last_seen_at, CASE WHEN listing_id % 9 <> 0 THEN 48.0 + (listing_id * 37 % 1000) / 10000 END AS lat, CASE WHEN listing_id % 9 <> 0 THEN 17.0 + (listing_id * 91 % 1000) / 10000 END AS lon FROM cur),
ix AS (SELECT place AS region, year, quarter, period, value FROM bench WHERE granularity = 'region' UNION ALL SELECT 'SR', year, quarter, year || '_Q' || quarter, {r2('CAST(sum(total) AS DOUBLE) / count(*)')} FROM (SELECT year(o_orderdate) AS year, quarter(o_orderdate) AS quarter, CAST(o_totalprice AS DECIMAL(18,2)) AS total FROM orders) GROUP BY year, quarter),
gr AS (SELECT r_name AS region, CAST(4 + r_regionkey * 0.5 AS DOUBLE) AS growth_pct FROM region UNION ALL SELECT 'SR', 7.0),
ri AS (SELECT r0.*, CASE WHEN price <> 0 AND area <> 0 THEN {r2('price / area')} END AS sqm, CASE WHEN place_no % 6 <> 5 THEN r0.region ELSE 'SR' END AS index_region, growth_pct FROM r0 JOIN gr ON gr.region = CASE WHEN place_no % 6 <> 5 THEN r0.region ELSE 'SR' END)"""
_POOL = f""", own AS (SELECT * FROM {_met('district')}), wid AS (SELECT * FROM {_met('city')}), st AS (SELECT id, count(*) FILTER (similarity >= 60) AS strong FROM own GROUP BY id),
pr AS (SELECT *, FALSE AS widened FROM own UNION ALL SELECT wid.*, TRUE FROM wid LEFT JOIN st USING (id) WHERE coalesce(strong, 0) < 3 AND NOT EXISTS (SELECT 1 FROM own WHERE own.id = wid.id AND own.o_id = wid.o_id)),
vp AS (SELECT id, price, area, round_even(percentile_cont(0.5) WITHIN GROUP (ORDER BY o_price), 0) AS median_price, round_even(percentile_cont(0.5) WITHIN GROUP (ORDER BY o_sqm), 0) AS median_sqm, percentile_cont(0.5) WITHIN GROUP (ORDER BY o_area) AS median_area, count(*) AS n, bool_or(widened) AS wide FROM pr GROUP BY id, price, area),
ve AS (SELECT *, coalesce(round_even(nullif(median_sqm, 0) * nullif(area, 0), 0), nullif(median_price, 0)) AS estimate FROM vp),
vd AS (SELECT *, {r2('price - estimate')} AS difference, CAST(round(CAST({r2('price - estimate')} / nullif(estimate, 0) * 100 AS DECIMAL(18,6)), 1) AS DOUBLE) AS pct FROM ve),
va AS (SELECT *, CASE WHEN pct <= -5 THEN 'undervalued' WHEN pct >= 5 THEN 'overpriced' WHEN pct IS NOT NULL THEN 'fair' END AS label FROM vd)"""
_GROUPS = ", ".join(f"{r2(f'percentile_cont({p / 100}) WITHIN GROUP (ORDER BY sqm)')} AS p{p}" for p in (25, 50, 75))
_SEG = f""", sg AS (SELECT district, deal_type, category, count(*) AS n_sqm, min(sqm) AS low_sqm, {_GROUPS}, max(sqm) AS high_sqm FROM ri WHERE active AND sqm IS NOT NULL AND category IS NOT NULL GROUP BY ALL
  UNION ALL SELECT district, deal_type, NULL, count(*), min(sqm), {_GROUPS}, max(sqm) FROM ri WHERE active AND sqm IS NOT NULL GROUP BY district, deal_type),
xs AS (SELECT region, list({{'period': period, 'value': value}} ORDER BY year, quarter) AS s FROM ix GROUP BY region),
xr AS (SELECT region, s[-1].value AS latest, s[-1].period AS latest_period, CASE WHEN len(s) >= 5 THEN CAST(round(CAST((s[-1].value - s[-5].value) / nullif(s[-5].value, 0) * 100 AS DECIMAL(18,6)), 1) AS DOUBLE) END AS yoy, s[-9:] AS series FROM xs),
bw AS (SELECT ri.id, ri.price AS cost, growth_pct, sg.p50 AS rent_sqm, round_even(sg.p50 * area, 0) AS rent FROM ri LEFT JOIN sg ON sg.district = ri.district AND sg.deal_type = 'rent' AND sg.category IS NOT DISTINCT FROM ri.category WHERE ri.deal_type = 'buy' AND price > 0 AND area > 0 AND round_even(sg.p50 * area, 0) > 0)"""
#: The wealth of both sides month by month, by recursion.
_FOLD = """, RF AS (SELECT id, 0 AS m, cost * 0.8 * (0.04 / 12) / (1 - pow(1 + 0.04 / 12, -360)) AS pay, CAST(cost AS DOUBLE) AS value, cost * 0.8 AS debt, rent, CAST(0 AS DOUBLE) AS buyer, cost - cost * 0.8 AS renter, pow(1 + growth_pct / 100, 1.0 / 12) AS rise FROM bw
  UNION ALL SELECT id, m + 1, pay, value * rise, greatest(0.0, debt * (1 + 0.04 / 12) - pay), rent * pow(1.025, 1.0 / 12), buyer * pow(1.05, 1.0 / 12) + greatest(rent - pay, 0.0), renter * pow(1.05, 1.0 / 12) + greatest(pay - rent, 0.0), rise FROM RF WHERE m < 360),
yr AS (SELECT id, m // 12 AS year, CAST(round(value - debt + buyer, 0) AS BIGINT) AS buyer, CAST(round(renter, 0) AS BIGINT) AS renter, pay FROM RF WHERE m % 12 = 0),
wl AS (SELECT id, list({'year': CAST(year AS INTEGER), 'buyer': buyer, 'renter': renter} ORDER BY year) AS series, min(year) FILTER (year > 0 AND buyer >= renter) AS ahead, CAST(round(any_value(pay), 0) AS BIGINT) AS payment FROM yr GROUP BY id)"""
_KIND = "{{'label': {label}, 'locality': {locality}, 'layout': {layout}, 'floor_area': CAST({area} AS DOUBLE), 'price': {price}, 'price_per_sqm': {sqm}, 'price_difference_vs_subject': {diff}, 'similarity_score': CAST({sim} AS INTEGER), 'source_url': {url}, 'is_subject': {subject}, 'is_median': {median}}}"
_DOC = f""", be AS (SELECT x.id, list({_KIND.format(label="'best_' || x.rank", locality='o.locality', layout='x.o_layout', area='x.o_area', price='x.o_price', sqm='x.o_sqm', diff=r2('nullif(x.o_price, 0) - x.price'), sim='x.similarity', url='o.url', subject='FALSE', median='FALSE')} ORDER BY x.rank) AS best
  FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY similarity DESC, o_id) AS rank FROM pr WHERE similarity >= 60) x JOIN ri o ON o.id = x.o_id WHERE x.rank <= 2 GROUP BY x.id),
{_SC}, s2 AS (SELECT *, {_to100('coalesce(image_quality, photo_quality)')} AS q, {_to100('brightness')} AS b, {_to100('sharpness')} AS sh, {_to100('exposure_quality')} AS e, {_to100('resolution_quality')} AS rq, (model_provider IS NULL OR model_provider <> 'mock') AND (coalesce(image_quality, photo_quality) IS NOT NULL OR brightness IS NOT NULL) AS ok, coalesce(blurry_image_ratio, 0) >= 0.5 OR coalesce(CASE WHEN id % 2 = 0 THEN (id % 4) / 4.0 END, 0) >= 0.5 AS poor FROM sc),
pl AS (SELECT ri.id, {', '.join(f"count(*) FILTER (category_ = '{c}' AND m <= {r}) AS {n}" for n, c, r in WANTED)} FROM ri JOIN (SELECT r.id, s.category AS category_, 2 * 6371000.0 * asin(sqrt(least(pow(sin(radians(p_lat - lat) / 2), 2) + cos(radians(lat)) * cos(radians(p_lat)) * pow(sin(radians(p_lon - lon) / 2), 2), 1.0))) AS m FROM ri r, ({_S}) s WHERE lat IS NOT NULL) USING (id) GROUP BY ri.id),
im AS (SELECT id, list_concat(CASE WHEN listing_id % 4 <> 0 AND NOT listing_id % 3 > 0 THEN [url || '/0'] ELSE [] END, [url || '/' || k for k in range(0, listing_id % 3)]) AS images FROM ri),
dy AS (SELECT id, greatest(floor(date_diff('microsecond', first_seen_at, last_seen_at) / 86400000000), 0)::BIGINT AS days FROM ri),
doc AS (SELECT ri.id, {{
 'report_title': 'Property Valuation Report', 'generated_at': '{OPTIONS.generated_at.isoformat()}',
 'property': {{'title': 'Listing ' || listing_id, 'deal_type': CASE WHEN ri.deal_type = 'rent' THEN 'rent' ELSE 'sale' END, 'property_type': ri.category, 'layout': ri.layout, 'address': ri.locality, 'locality': ri.locality, 'city': city, 'country': 'Slovakia', 'latitude': CAST(lat AS DOUBLE), 'longitude': CAST(lon AS DOUBLE), 'floor_area': CAST(ri.area AS DOUBLE), 'land_area': CAST(CASE WHEN ri.category = 'house' THEN ri.area * 10 END AS DOUBLE),
   'source': ri.source, 'source_url': ri.url, 'first_seen_at': strftime(first_seen_at, '%Y-%m-%d'), 'last_seen_at': strftime(last_seen_at, '%Y-%m-%d'), 'days_on_market': days, 'images': images}},
 'pricing': {{'currency': 'EUR', 'list_price': ri.price, 'price_per_sqm': ri.sqm}},
 'valuation': {{'estimated_value': CAST(estimate AS BIGINT), 'estimated_price_per_sqm': CAST(round_even(estimate / nullif(ri.area, 0), 0) AS BIGINT), 'recommended_price_range': {{'low': CAST(round_even(estimate * 0.95, 0) AS BIGINT), 'mid': CAST(estimate AS BIGINT), 'high': CAST(round_even(estimate * 1.05, 0) AS BIGINT)}}, 'local_median_price': CAST(median_price AS BIGINT), 'local_median_price_per_sqm': CAST(median_sqm AS BIGINT), 'price_difference': difference, 'price_difference_percent': pct, 'sample_size': coalesce(va.n, 0),
   'why_this_estimate': CASE WHEN pct IS NULL THEN ['none'] ELSE list_filter([CASE WHEN pct <= -1 THEN 'price_below' WHEN pct >= 1 THEN 'price_above' ELSE 'price_inline' END, CASE WHEN ri.sqm <> 0 THEN CASE WHEN (ri.sqm - median_sqm) / nullif(median_sqm, 0) * 100 <= -1 THEN 'sqm_below' WHEN (ri.sqm - median_sqm) / nullif(median_sqm, 0) * 100 >= 1 THEN 'sqm_above' WHEN nullif(median_sqm, 0) IS NOT NULL THEN 'sqm_inline' END END, CASE WHEN wide THEN 'widened' END], lambda x: x IS NOT NULL) END}},
 'comparables': list_concat([{_KIND.format(label="'subject'", locality='ri.locality', layout='ri.layout', area='ri.area', price='ri.price', sqm='ri.sqm', diff='CAST(NULL AS DOUBLE)', sim='100', url='CAST(NULL AS VARCHAR)', subject='TRUE', median='FALSE')}],
   CASE WHEN median_price IS NOT NULL THEN [{_KIND.format(label="'median'", locality='ri.district', layout='ri.layout', area='round_even(nullif(median_area, 0), 0)', price='median_price', sqm='coalesce(round_even(median_price / nullif(round_even(nullif(median_area, 0), 0), 0), 0), median_sqm)', diff=r2('median_price - ri.price'), sim='NULL', url='CAST(NULL AS VARCHAR)', subject='FALSE', median='TRUE')}] ELSE [] END, coalesce(best, [])),
 'market_statistics': {{'region': index_region, 'country': 'Slovakia', 'scope_note': 'All residential, average transaction prices', 'source': concat_ws(', ', 'Regional price index', latest_period), 'period': latest_period, 'average_price_per_sqm': latest, 'yoy_change': yoy, 'series': xr.series, 'subject_price_per_sqm': ri.sqm,
   'distribution': CASE WHEN sg.n_sqm > 0 THEN {{'scope': 'Active ' || coalesce(ri.category, 'listings') || ' listings, ' || ri.district, 'min_price_per_sqm': low_sqm, 'p25_price_per_sqm': p25, 'median_price_per_sqm': p50, 'p75_price_per_sqm': p75, 'max_price_per_sqm': high_sqm, 'sample_size': sg.n_sqm}} END}},
 'benchmarks': list_filter([CASE WHEN median_sqm <> 0 THEN {{'name': 'Local listing median', 'benchmark_type': 'listing_asking', 'value_per_sqm': median_sqm, 'source': 'Listing index'}} END, CASE WHEN ri.deal_type <> 'rent' THEN {{'name': 'Price index, ' || index_region, 'benchmark_type': 'realized_sale', 'value_per_sqm': latest, 'source': 'Regional price index, ' || latest_period}} END], lambda x: x IS NOT NULL),
 'buy_vs_rent': CASE WHEN bw.id IS NOT NULL THEN {{'horizon_years': 30, 'assumptions': {{'property_price': ri.price, 'monthly_rent': bw.rent, 'rent_source': 'Active rent-listing median, ' || ri.district, 'mortgage_rate_pct': 4.0::DOUBLE, 'ltv_pct': 80.0::DOUBLE, 'term_years': 30, 'inflation_pct': 2.5::DOUBLE, 'investment_return_pct': 5.0::DOUBLE, 'property_growth_pct': ri.growth_pct, 'growth_source': 'Regional price index, ' || index_region || ', long-run average'}},
   'down_payment': CAST(round(cost - cost * 0.8, 0) AS BIGINT), 'monthly_payment': payment, 'series': wl.series, 'buyer_final': wl.series[-1].buyer, 'renter_final': wl.series[-1].renter, 'breakeven_year': CAST(ahead AS INTEGER)}} END,
 'vision_analysis': {{'available': ok, 'summary': CASE WHEN ok THEN list_filter([CASE WHEN b IS NOT NULL AND e IS NOT NULL THEN CASE WHEN b >= 50 AND e >= 70 THEN 'bright_well_exposed' WHEN b < 50 THEN 'dim' ELSE 'uneven_exposure' END END, CASE WHEN blurry_image_ratio >= 0.5 THEN 'mostly_blurry' WHEN blurry_image_ratio > 0 THEN 'some_blurry' END, CASE WHEN rq >= 60 THEN 'resolution_ok' WHEN rq IS NOT NULL THEN 'resolution_low' END, CASE WHEN gallery_size < 3 THEN 'limited_coverage' END], lambda x: x IS NOT NULL) END,
   'photo_quality': CASE WHEN ok THEN q END, 'brightness': CASE WHEN ok THEN CAST(b AS DOUBLE) END, 'sharpness': CASE WHEN ok THEN sh END, 'gallery_size': CASE WHEN ok THEN CAST(gallery_size AS INTEGER) END, 'images': CASE WHEN ok THEN images[:3] END}},
 'location_facilities': {{'available': pl.id IS NOT NULL, 'map_image_url': CAST(NULL AS VARCHAR), 'facilities': CASE WHEN pl.id IS NOT NULL THEN [{', '.join(f"{{'category': '{label}', 'count': {c}}}" for c, label in report.FACILITIES)}] ELSE [] END}},
 'summary': {{'headline': 'verdict_' || coalesce(label, 'none'), 'recommendation': 'priced_' || coalesce(label, 'none'), 'strengths': list_filter([CASE label WHEN 'undervalued' THEN 'below' WHEN 'fair' THEN 'inline' END, CASE WHEN days <= 14 THEN 'recent' END], lambda x: x IS NOT NULL), 'risks': list_filter([CASE WHEN label = 'overpriced' THEN 'above' END, CASE WHEN ok THEN 'photo_only' ELSE 'no_photos' END, CASE WHEN ok AND poor THEN 'poor_photos' END, CASE WHEN days >= 60 THEN 'days' END], lambda x: x IS NOT NULL), 'next_steps': ['viewing', 'building', 'benchmark']}},
 'methodology': {{'valuation_date': '{OPTIONS.generated_at.isoformat()}', 'model_version': 'comparables', 'data_freshness_note': 'Comparables as stored when the job ran.'}}, 'options': {{'template': 'standard', 'language': 'en'}}}} AS d
FROM ri JOIN im USING (id) JOIN dy USING (id) JOIN s2 ON s2.id = ri.id LEFT JOIN va ON va.id = ri.id LEFT JOIN be ON be.id = ri.id LEFT JOIN xr ON xr.region = index_region LEFT JOIN sg ON sg.district = ri.district AND sg.deal_type = ri.deal_type AND sg.category IS NOT DISTINCT FROM ri.category LEFT JOIN bw ON bw.id = ri.id LEFT JOIN wl ON wl.id = ri.id LEFT JOIN pl ON pl.id = ri.id)"""


@query("s11_valuation_documents", f"WITH RECURSIVE {RI}{_POOL}{_SEG}{_FOLD}{_DOC} SELECT id, CAST(to_json(d) AS VARCHAR) AS document FROM doc")
def _(spark, sf):
    made = documents(spark, sf)
    return made.select("id", F.to_json(F.struct(*[c for c in made.columns if c != "id"]), {"ignoreNullFields": "false"}).alias("document"))


@query("a7_unpriced_listings", f"WITH {RI}{_POOL} SELECT id, estimate, round_even(estimate * 0.95, 0) AS low, round_even(estimate * 1.05, 0) AS high, n AS sample_size, wide AS widened, difference, label FROM va WHERE price IS NULL")
def _(spark, sf):
    listings = rows(spark, sf)
    pools = keep(valuation.pool_summaries(listings.select("id", "layout", "area", "price", "active", "city", *valuation.SEGMENT), F.col("price").isNull()), "pools")
    return valuation.valued(pools).join(pools.select("id", F.col("wide").alias("widened")), "id").select("id", "estimate", "low", "high", "sample_size", "widened", "difference", "label")


@query("a15_break_even_by_region", f"WITH RECURSIVE {RI}{_SEG}{_FOLD} SELECT index_region AS region, CAST(ahead AS DOUBLE) AS break_even_year, count(*) AS n, sum(series[-1].buyer) AS buyer_final, sum(series[-1].renter) AS renter_final FROM ri JOIN wl USING (id) GROUP BY ALL")
def _(spark, sf):
    listings = report.prepared(rows(spark, sf), region_table(spark, sf), growth_table(spark, sf))
    rents = valuation.segment_rents(listings)
    met = listings.join(rents, F.col("district").eqNullSafe(F.col("_d")) & F.col("category").eqNullSafe(F.col("_c")), "left")
    told = report.with_projection(met).filter("can_project")
    total = lambda c: F.sum(F.col(c).cast("long")).cast("double").alias(c)
    return told.groupBy(F.col("index_region").alias("region"), F.col("break_even_year").cast("double").alias("break_even_year")).agg(F.count(F.lit(1)).alias("n"), total("buyer_final"), total("renter_final"))
