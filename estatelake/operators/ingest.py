"""A run of the ingest job: raw log, current state, day snapshots, price changes and statistics, seen all at once.

Each table is partitioned (state and statistics' inputs by source, the others by
day), and a run reads and writes only the partitions that its items touch. A run
can be repeated: one that is in the log is skipped, and the same items under
another name give the same rows again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from estatelake.operators.history import KEY, price_changes
from estatelake.operators.market import market_statistics
from estatelake.operators.merge import last_per_key, merge_by_key, require_unique
from estatelake.sources.shared import keep
from estatelake.sources.versions import VersionedTables

#: What each table is partitioned by.
PARTS = {"raw": "run_id", "state": "source", "snapshots": "day", "changes": "day", "statistics": "stat_date"}
STATISTICS_BY = ["source", "deal_type", "category", "district"]
#: A listing that is seen keeps when it was first seen, and is active.
STATE_POLICIES = {"first_seen_at": "keep_old", "active": ("const", True)}
_SNAPSHOTS = [*KEY, "day"]


def as_of_changes(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """Changes of new day rows against the last known price of an earlier day, be it new or stored; rows of the same day replace stored ones.

    Only the histories of listings with new rows are looked at.
    """
    rows = rows.na.drop(subset=_SNAPSHOTS)
    marked = lambda df, new: df.select(*_SNAPSHOTS, "price", F.lit(new).alias("_new"))
    history = marked(stored.join(rows.select(*KEY).distinct(), KEY, "left_semi"), False).unionByName(marked(rows, True))
    # Dealt by listing, so that neither days nor histories are shuffled again.
    history = history.repartition(*KEY).groupBy(*_SNAPSHOTS).agg(F.max_by("price", "_new").alias("price"), F.max("_new").alias("_new"))
    return price_changes(history, F.col("_new"))


def listing_rows(good: DataFrame, place: F.Column) -> DataFrame:
    """Normalised listings as the job takes them; ``place`` orders them, over all dumps of a run."""
    return good.select("source", F.col("source_listing_id").alias("listing_id"), "scraped_at", place.alias("event_id"), F.col("price").cast("double").alias("price"), F.col("floor_area").alias("area"), "deal_type", "category", "locality", "layout", "district", "url", "content_hash", "raw")


def _touched(part: str) -> F.Column:
    """Partition values of a run's rows: its sources or days."""
    return F.collect_set(F.coalesce(F.col(part).cast("string"), F.lit("null")))


def ingest(store: VersionedTables, items: DataFrame, n_failed: int | Observation, run_id: str, stat_date) -> dict:
    """Takes the run's items into the store, and returns its counters.

    items: source, listing_id, scraped_at, event_id (place in the dump), price,
    area, deal_type, category, district and any other facts; later places overwrite
    earlier ones. n_failed: items that could not be normalised, or what observes
    their number (``n_failed``) while the items are written.

    Each table is written once, and what needs it reads what was written: the items
    are those of the raw log. Days are brought together before they are written, so
    that a day's files grow with its rows, not with the tasks.
    """
    since = store.entry()
    if run_id in since["runs"]:
        return since["runs"][run_id]
    items = items.withColumn("day", F.to_date("scraped_at"))
    written = {"raw": store.write("raw", items.withColumn("run_id", F.lit(run_id)))}
    failed = n_failed if isinstance(n_failed, int) else n_failed.get["n_failed"]
    items = store.rows(written["raw"], items.schema)
    n_items, sources, days = items.agg(F.count(F.lit(1)), _touched("source"), _touched("day")).first()

    facts = [c for c in items.columns if c not in KEY]
    newest = items.groupBy(*KEY).agg(F.max_by(F.struct(*facts), "event_id").alias("_r"), F.min_by("scraped_at", "event_id").alias("first_seen_at")).select(*KEY, "_r.*", "first_seen_at")
    newest = newest.withColumns({"last_seen_at": F.col("scraped_at"), "active": F.lit(True)})
    known = store.read("state", newest.schema, sources)
    require_unique(known, KEY, "stored rows")
    written["state"] = store.write("state", merge_by_key(known, newest, KEY, STATE_POLICIES).drop("merge_action"))
    state = store.rows(written["state"], newest.schema)
    # What isn't new is merged into a stored row.
    n_new = state.count() - known.count()

    # The rows of a day are the run's where it has any, so stored and new ones are ranked together.
    ranked = store.read("snapshots", items.schema, days).withColumn("_new", F.lit(False)).unionByName(items.withColumn("_new", F.lit(True)))
    written["snapshots"] = store.write("snapshots", last_per_key(ranked, _SNAPSHOTS, [F.desc("_new"), F.desc("event_id")]).drop("_new").hint("rebalance", "day"))
    rows = keep(last_per_key(items.select(*_SNAPSHOTS, "price", "event_id"), _SNAPSHOTS, [F.desc("event_id")]).drop("event_id"), "ingest-days")
    earlier = [d for d in store.values("snapshots") if d < max(days, default="")]
    changes = keep(as_of_changes(rows, store.read("snapshots", rows.schema, earlier)), "ingest-changes")
    stored = store.read("changes", changes.schema, days)
    written["changes"] = store.write("changes", stored.join(rows.select(*_SNAPSHOTS), _SNAPSHOTS, "left_anti").unionByName(changes).hint("rebalance", "day"))

    statistics = market_statistics(state, STATISTICS_BY, stat_date=stat_date)
    others = store.read("statistics", statistics.schema, [str(stat_date)]).filter(~F.col("source").isin(sources))
    written["statistics"] = store.write("statistics", others.unionByName(statistics))
    summary = {"n_new": n_new, "n_updated": n_items - n_new, "n_price_changes": changes.count(), "n_failed": failed, "status": "completed_with_errors" if failed else "succeeded"}
    emptied = {"changes": [d for d in days if d not in written["changes"]]}
    return store.commit(since, run_id, written, emptied, summary)["summary"]
