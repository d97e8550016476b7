"""The driver's tables as listing data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estatelake.functions.columns import rounded


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(place_no, district, region): 25 nations at most."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return n.join(F.broadcast(r), n["n_regionkey"] == r["r_regionkey"]).select(F.col("n_nationkey").alias("place_no"), F.col("n_name").alias("district"), F.col("r_name").alias("region"))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, user = table(spark, sf_dir, "events"), F.col("user_id")
    obs = e.select(
        "event_id", F.col("event_type").alias("source"), user.alias("listing_id"), F.col("ts").alias("scraped_at"), F.to_date("ts").alias("day"), rounded(F.col("value")).alias("price"), (F.get_json_object("props", "$.k").cast("int") + 10).alias("area"),
        F.when(user % 3 == 0, "rent").otherwise("buy").alias("deal_type"), F.element_at(F.array(*map(F.lit, ("apartment", "house", "land", "commercial"))), (user % 4 + 1).cast("int")).alias("category"), (user % 25).alias("place_no"),
    )
    return obs.join(F.broadcast(places(spark, sf_dir)), "place_no").drop("place_no")


def benchmarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean order totals by quarter, for each nation (district) and region."""
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    rows = o.join(c, o["o_custkey"] == c["c_custkey"]).join(F.broadcast(places(spark, sf_dir)), F.col("c_nationkey") == F.col("place_no"))
    rows = rows.select("district", "region", F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("quarter"), F.col("o_totalprice").cast("decimal(18,2)").alias("total"))
    out = None
    for level in ("district", "region"):
        part = rows.groupBy(F.col(level).alias("place"), "year", "quarter").agg(rounded(F.sum("total").cast("double") / F.count(F.lit(1))).alias("value"))
        part = part.withColumn("granularity", F.lit(level)).withColumn("period", F.format_string("%d_Q%d", "year", "quarter"))
        out = part if out is None else out.unionByName(part)
    return out


def point(key: F.Column, a: int, b: int) -> list[F.Column]:
    return [(F.lit(48.0) + (key * a % 1000) / 10000).alias("lat"), (F.lit(17.0) + (key * b % 1000) / 10000).alias("lon")]


OBS = """obs AS (
  SELECT event_id, event_type AS source, user_id AS listing_id, ts AS scraped_at, CAST(ts AS DATE) AS day, CAST(round(CAST(value AS DECIMAL(18,6)), 2) AS DOUBLE) AS price,
    CAST(json_extract_string(props, '$.k') AS INTEGER) + 10 AS area, CASE WHEN user_id % 3 = 0 THEN 'rent' ELSE 'buy' END AS deal_type,
    CASE user_id % 4 WHEN 0 THEN 'apartment' WHEN 1 THEN 'house' WHEN 2 THEN 'land' ELSE 'commercial' END AS category, n_name AS district, r_name AS region
  FROM events JOIN nation ON n_nationkey = user_id % 25 JOIN region ON n_regionkey = r_regionkey)"""
SNAP = OBS + """, snap AS (
  SELECT * EXCLUDE (nth) FROM (SELECT *, row_number() OVER (PARTITION BY source, listing_id, day ORDER BY scraped_at DESC, event_id DESC) AS nth FROM obs) WHERE nth = 1)"""
CHANGES = SNAP + """, prev AS (
  SELECT *, last_value(price IGNORE NULLS) OVER (PARTITION BY source, listing_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS old_price FROM snap),
changes AS (
  SELECT source, listing_id, day, old_price, price AS new_price, CAST(round(CAST(price - old_price AS DECIMAL(18,6)), 2) AS DOUBLE) AS absolute_change,
    CASE WHEN old_price = 0 THEN 0.0 ELSE CAST(round(CAST((price - old_price) / old_price * 100 AS DECIMAL(24,8)), 4) AS DOUBLE) END AS percent_change
  FROM prev WHERE old_price IS NOT NULL AND price IS NOT NULL AND old_price <> price)"""
CURRENT = OBS + """, cur AS (
  SELECT * EXCLUDE (nth) FROM (SELECT *, min(scraped_at) OVER (PARTITION BY source, listing_id) AS first_seen_at, max(scraped_at) OVER (PARTITION BY source, listing_id) AS last_seen_at,
    row_number() OVER (PARTITION BY source, listing_id ORDER BY scraped_at DESC, event_id DESC) AS nth FROM obs) WHERE nth = 1)"""
BENCH = """orders_by_place AS (
  SELECT n_name AS district, r_name AS region, year(o_orderdate) AS year, quarter(o_orderdate) AS quarter, CAST(o_totalprice AS DECIMAL(18,2)) AS total
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
bench AS (
  SELECT district AS place, year, quarter, CAST(round(CAST(CAST(sum(total) AS DOUBLE) / count(*) AS DECIMAL(18,6)), 2) AS DOUBLE) AS value, 'district' AS granularity, year || '_Q' || quarter AS period FROM orders_by_place GROUP BY ALL
  UNION ALL SELECT region, year, quarter, CAST(round(CAST(CAST(sum(total) AS DOUBLE) / count(*) AS DECIMAL(18,6)), 2) AS DOUBLE), 'region', year || '_Q' || quarter FROM orders_by_place GROUP BY ALL)"""


def r2(x: str) -> str:
    """The SQL of ``rounded``."""
    return f"CAST(round(CAST({x} AS DECIMAL(18,6)), 2) AS DOUBLE)"
