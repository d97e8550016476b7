"""The streamed jobs over the driver's events, each run until all that has landed is done, with the SQL of their rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from estatelake.functions.columns import rounded
from estatelake.operators import history, sketches
from estatelake.plans.domain import CHANGES, CURRENT, OBS, observations
from estatelake.plans.registry import query
from estatelake.sources.shared import scratch
from estatelake.streaming import listings as streams


def observed(spark, sf):
    """The events as a stream of observations, with UTC timestamps."""
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    e = spark.readStream.schema(schema).parquet(f"{sf}/events.parque[t]")
    at = F.to_timestamp(F.concat_ws("", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("+00:00")))
    return e.select("event_id", F.col("event_type").alias("source"), F.col("user_id").alias("listing_id"), at.alias("scraped_at"), F.to_date("ts").alias("day"), rounded(F.col("value")).alias("price"))


def finished(stream, spark, name):
    """The rows that a stream has written once all that landed is done."""
    path = scratch(spark, name)
    stream.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", f"{path}-checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


@query("t1_streamed_ingest", f"WITH {CURRENT} SELECT source, listing_id, event_id, price FROM cur")
def _(spark, sf):
    """Each batch runs the batch job for the current state, and stores its result under the batch's number."""
    path = scratch(spark, "ingest")
    streams.ingest(observed(spark, sf), lambda df, n: history.current_listings(df).write.mode("overwrite").parquet(f"{path}/batch={n}"), f"{path}-checkpoint").awaitTermination()
    return history.current_listings(spark.read.parquet(path)).select("source", "listing_id", "event_id", "price")


@query("t2_streamed_price_changes", f"WITH {CHANGES} SELECT source, listing_id, day, old_price, new_price FROM changes WHERE day + INTERVAL 36 HOUR <= (SELECT max(scraped_at) FROM obs) - INTERVAL 2 DAY")
def _(spark, sf):
    return finished(streams.price_changes(observed(spark, sf), "2 days"), spark, "changes")


@query("t3_stale_listings", f"WITH {OBS}, n AS (SELECT *, lead(scraped_at, 1, (SELECT max(scraped_at) FROM obs)) OVER (PARTITION BY source, listing_id ORDER BY scraped_at) AS next FROM obs) SELECT source, listing_id, epoch_us(scraped_at) AS last_seen FROM n WHERE next - scraped_at >= INTERVAL 3 DAY")
def _(spark, sf):
    return finished(streams.stale_listings(observed(spark, sf), 3), spark, "stale").select("source", "listing_id", F.unix_micros("last_seen_at").alias("last_seen"))


@query("t4_daily_medians", f"WITH {OBS} SELECT day, percentile_cont(0.5) WITHIN GROUP (ORDER BY price) AS median_price, count(*) AS n FROM obs WHERE day + INTERVAL 1 DAY <= (SELECT max(scraped_at) FROM obs) - INTERVAL 2 DAY GROUP BY day")
def _(spark, sf):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")  # days of the stream's window
    try:
        return finished(streams.daily_medians(observed(spark, sf)).withColumn("day", F.col("day").cast("string")), spark, "medians").withColumn("day", F.col("day").cast("date"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@query("t4_sketched_medians", f"WITH {OBS}, d AS (SELECT day, count(*) AS n FROM obs WHERE day + INTERVAL 1 DAY <= (SELECT max(scraped_at) FROM obs) - INTERVAL 2 DAY GROUP BY day) SELECT day, n, TRUE AS within_1_percent FROM d")
def _(spark, sf):
    """The streamed sketches' medians, whose rank error is measured against all prices of the day."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        held = finished(streams.daily_sketches(observed(spark, sf)).withColumn("day", F.col("day").cast("string")), spark, "sketches")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    medians = held.select(F.col("day").cast("date").alias("day"), sketches.quantile(F.col("price_sketch"), 0.5).alias("median"))
    errors = sketches.rank_errors(observations(spark, sf).select("day", "price"), medians, ["day"], "price", "median")
    return errors.select("day", "n", (F.col("error") < 0.01).alias("within_1_percent"))


@query("t5_late_rows", "SELECT event_id, event_id % 9 > 4 AS late FROM events")
def _(spark, sf):
    rows = observed(spark, sf).withColumn("landed_at", F.col("scraped_at") + F.make_dt_interval((F.col("event_id") % 9).cast("int")))
    on_time, late = (finished(part.select("event_id"), spark, name) for part, name in zip(streams.in_time(rows, 4), ("in-time", "late"), strict=True))
    return on_time.withColumn("late", F.lit(False)).unionByName(late.withColumn("late", F.lit(True)))


@query("t5_revised_changes", f"WITH {CHANGES} SELECT source, listing_id, day, old_price, new_price FROM changes")
def _(spark, sf):
    """Events that land up to eight days late, in no order: after all revisions, the batch job's changes."""
    rows = observed(spark, sf).withColumn("landed_at", F.col("scraped_at") + F.make_dt_interval((F.col("event_id") % 9).cast("int")))
    return streams.settled(finished(streams.revised_changes(rows, 10), spark, "revisions"))


@query("t6_without_repeats", "SELECT DISTINCT event_type AS source, user_id AS listing_id, CAST(ts AS DATE) AS day, CAST(event_id % 2 AS VARCHAR) AS content_hash FROM events")
def _(spark, sf):
    rows = observed(spark, sf).withColumn("content_hash", (F.col("event_id") % 2).cast("string"))
    return finished(streams.without_repeats(rows, "40 days").select("source", "listing_id", "day", "content_hash"), spark, "once")
