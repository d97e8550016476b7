"""Runs of the ingest job over the driver's events, from frames and from landed dumps, with the SQL of what they leave."""

from __future__ import annotations

from datetime import UTC, date, datetime

from pyspark.sql import functions as F

from estatelake.operators import ingest
from estatelake.plans.domain import OBS, observations, places, r2, table
from estatelake.plans.registry import query
from estatelake.sources.shared import scratch
from estatelake.sources.versions import VersionedTables
from estatelake.streaming import listings as streams

CHANGED = "source, listing_id, day, old_price, new_price, absolute_change, percent_change"


def _steps(n: int) -> str:
    """What the rows of ``it`` (source, listing_id, step, event_id, day, price, ...) leave when each step is a run, for n steps."""
    out = []
    for k in range(n):
        out.append(f"d{k} AS (SELECT source, listing_id, day, arg_max(price, (step, event_id)) AS price, max(step) AS step FROM it WHERE step <= {k} GROUP BY ALL)")
        out.append(f"p{k} AS (SELECT *, last_value(price IGNORE NULLS) OVER (PARTITION BY source, listing_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS old_price FROM d{k})")
        out.append(f"s{k} AS (SELECT * EXCLUDE (nth) FROM (SELECT *, row_number() OVER (PARTITION BY source, listing_id ORDER BY step DESC, event_id DESC) AS nth FROM it WHERE step <= {k}) WHERE nth = 1)")
    made = " UNION ALL ".join(f"SELECT source, listing_id, day, {k} AS step, old_price, price AS new_price, {r2('price - old_price')} AS absolute_change, CASE WHEN old_price = 0 THEN 0.0 ELSE CAST(round(CAST((price - old_price) / old_price * 100 AS DECIMAL(24,8)), 4) AS DOUBLE) END AS percent_change FROM p{k} WHERE step = {k} AND old_price IS NOT NULL AND old_price <> price" for k in range(n))
    out.append(f"ev AS ({made})")
    out.append(f"ch AS (SELECT ev.* FROM ev JOIN d{n - 1} f ON f.source = ev.source AND f.listing_id = ev.listing_id AND f.day = ev.day AND f.step = ev.step)")
    out.append("fs AS (SELECT source, listing_id, min_by(scraped_at, (step, event_id)) AS first_seen_at, min(step) AS first_step FROM it GROUP BY ALL)")
    return ", ".join(out)


def _stats(k: int) -> str:
    return f"""SELECT DATE '2024-02-0{k + 1}' AS stat_date, source, deal_type, category, district, count(*) AS n, {r2('percentile_cont(0.5) WITHIN GROUP (ORDER BY price)')} AS median_price, {r2('avg(price)')} AS mean_price, {r2('percentile_cont(0.5) WITHIN GROUP (ORDER BY sqm)')} AS median_sqm, {r2('avg(sqm)')} AS mean_sqm, min(price) AS min_price, max(price) AS max_price
  FROM (SELECT *, CASE WHEN price <> 0 AND area <> 0 THEN {r2('price / area')} END AS sqm FROM s{k} WHERE price IS NOT NULL) GROUP BY ALL"""


# --- two dumps, the second twice --------------------------------------------

IT = f"{OBS}, it AS (SELECT *, event_id % 2 AS step FROM obs WHERE event_id % 50 <> 0), {_steps(2)}"


def stored_runs(spark, sf) -> VersionedTables:
    """The store after a run over half of the events, and two runs over the other half; one event in 50 can't be read."""
    store = VersionedTables(spark, scratch(spark, "store"), ingest.PARTS)
    obs = observations(spark, sf)
    for run, step in (("a", 0), ("b", 1), ("b again", 1)):
        part = obs.filter(F.col("event_id") % 2 == step)
        bad = F.col("event_id") % 50 == 0
        ingest.ingest(store, part.filter(~bad).drop("region", "day"), part.filter(bad).count(), run, date(2024, 2, 1 + step))
    return store


def _stored(spark, store, name):
    """All columns, as they were written."""
    held = sorted(store.entry()["tables"][name].values())
    return spark.read.parquet(*held)


@query("e1_ingest_state", f"WITH {IT} SELECT s1.source, s1.listing_id, event_id, price, epoch_us(fs.first_seen_at) AS first_seen, epoch_us(scraped_at) AS last_seen, TRUE AS active FROM s1 JOIN fs USING (source, listing_id)")
def _(spark, sf):
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    return _stored(spark, stored_runs(spark, sf), "state").select("source", "listing_id", "event_id", "price", micros("first_seen_at").alias("first_seen"), micros("last_seen_at").alias("last_seen"), "active")


@query("e1_ingest_snapshots", f"WITH {IT} SELECT source, listing_id, day, price FROM d1")
def _(spark, sf):
    return _stored(spark, stored_runs(spark, sf), "snapshots").select("source", "listing_id", "day", "price")


@query("e1_ingest_changes", f"WITH {IT} SELECT {CHANGED} FROM ch")
def _(spark, sf):
    return _stored(spark, stored_runs(spark, sf), "changes").select(*CHANGED.split(", "))


@query("e1_ingest_statistics", f"WITH {IT} {_stats(0)} UNION ALL {_stats(1)}")
def _(spark, sf):
    return _stored(spark, stored_runs(spark, sf), "statistics")


_RUN = "(SELECT count(*) FROM fs WHERE first_step = {k}) AS n_new, (SELECT count(*) FROM it WHERE step = {k}) - (SELECT count(*) FROM fs WHERE first_step = {k}) AS n_updated, (SELECT count(*) FROM ev WHERE step = {k}) AS n_price_changes, (SELECT count(*) FROM obs WHERE event_id % 50 = 0 AND event_id % 2 = {k}) AS n_failed"


@query("e1_ingest_summary", f"""WITH {IT}, r AS (SELECT 'a' AS run, {_RUN.format(k=0)} UNION ALL SELECT 'b', {_RUN.format(k=1)} UNION ALL SELECT 'b again', 0, (SELECT count(*) FROM it WHERE step = 1), (SELECT count(*) FROM ev WHERE step = 1), (SELECT count(*) FROM obs WHERE event_id % 50 = 0 AND event_id % 2 = 1))
SELECT *, CASE WHEN n_failed > 0 THEN 'completed_with_errors' ELSE 'succeeded' END AS status FROM r""")
def _(spark, sf):
    runs = stored_runs(spark, sf).entry()["runs"]
    return spark.createDataFrame([(run, *(s[c] for c in ("n_new", "n_updated", "n_price_changes", "n_failed", "status"))) for run, s in runs.items()], "run string, n_new long, n_updated long, n_price_changes long, n_failed long, status string")


# --- dumps that land in three steps -----------------------------------------

#: Items of a dump, as a scraper's run has.
ITEMS = 500
#: Dumps of a directory: each has to be listed by the stream at every start. File names number them with three digits.
SHELF = 100
LANDED = f"it AS (SELECT 'sreality' AS source, CAST(user_id AS VARCHAR) AS listing_id, event_id % 3 AS step, event_id, ts AS scraped_at, CAST(ts AS DATE) AS day, CAST(CAST(trunc(value) AS BIGINT) AS DOUBLE) AS price FROM events WHERE event_id % 50 <> 0), {_steps(3)}"


def land(spark, sf, folder: str, step: int) -> None:
    """The step's events as dumps, each a JSON array in a file of its own; some items name no source."""
    i = F.col("user_id")
    at = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    shown = F.to_json(F.struct(F.when(F.col("event_id") % 50 != 0, i).alias("listingId"), F.lit("https://www.sreality.cz/d/x").alias("url"), F.when(i % 3 == 0, "rent").otherwise("buy").alias("dealType"), F.lit("byty").alias("propertyType"), F.concat(F.lit("T"), i).alias("title"), F.col("n_name").alias("district"), F.lit("2+kk").alias("rooms"), F.get_json_object("props", "$.k").alias("areaSqm"), F.col("value").cast("string").alias("price"), at.alias("scrapedAt")))
    e = table(spark, sf, "events").filter(F.col("event_id") % 3 == step).join(F.broadcast(places(spark, sf).select(F.col("place_no"), F.col("district").alias("n_name"))), i % 25 == F.col("place_no"))
    dumps = e.groupBy(F.floor(F.col("event_id") / ITEMS).alias("no")).agg(F.array_sort(F.collect_list(F.struct("event_id", shown.alias("item")))).alias("d"))
    shelved = dumps.select("no", F.format_string("%09d", F.floor(F.col("no") / SHELF)).alias("shelf"), F.concat(F.lit("["), F.array_join("d.item", ","), F.lit("]")).alias("value"))
    # A shelf is written by one task, so its files' names are in the order of dumps.
    shelved.repartition("shelf").sortWithinPartitions("shelf", "no").drop("no").write.mode("append").option("maxRecordsPerFile", 1).partitionBy("shelf").text(f"{folder}/step={step}")


def streamed_dumps(spark, sf, repeat: int = 1) -> VersionedTables:
    """The store after a stream over three landings; batch ``repeat`` is given to the job again."""
    folder = scratch(spark, "landing")
    store = VersionedTables(spark, f"{folder}-store", ingest.PARTS)
    run_time = datetime(2024, 2, 1, tzinfo=UTC)
    for step in range(3):
        land(spark, sf, folder, step)
        streams.ingest_dumps(spark, f"{folder}/*/*", store, run_time, date(2024, 2, 1), f"{folder}-checkpoint").awaitTermination()
    job = streams.ingest_batch(store, run_time, date(2024, 2, 1))
    job(streams.dump_files(spark.read, f"{folder}/step={repeat}/*"), repeat)
    return store


@query("t1_landed_changes", f"WITH {LANDED} SELECT {CHANGED} FROM ch")
def _(spark, sf):
    return _stored(spark, streamed_dumps(spark, sf), "changes").select(*CHANGED.split(", "))


@query("t1_landed_state", f"WITH {LANDED} SELECT s2.source, s2.listing_id, price, epoch_us(fs.first_seen_at) AS first_seen, epoch_us(scraped_at) AS last_seen FROM s2 JOIN fs USING (source, listing_id)")
def _(spark, sf):
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    return _stored(spark, streamed_dumps(spark, sf), "state").select("source", "listing_id", "price", micros("first_seen_at").alias("first_seen"), micros("last_seen_at").alias("last_seen"))
