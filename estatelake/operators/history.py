"""From scrape observations to snapshots, states and price changes.

Columns: source, listing_id, scraped_at, event_id (arrival order), day, price.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from estatelake.operators.merge import last_per_key

KEY = ["source", "listing_id"]


def day_snapshots(obs: DataFrame) -> DataFrame:
    """One row for each listing and day: the last of the day, by time and arrival."""
    return last_per_key(obs, [*KEY, "day"], [F.desc("scraped_at"), F.desc("event_id")])


def current_listings(obs: DataFrame) -> DataFrame:
    """The newest observation of each listing, with first_seen_at and last_seen_at; rows of one task are combined before the shuffle."""
    newest = F.max_by(F.struct(*[c for c in obs.columns if c not in KEY]), F.struct("scraped_at", "event_id"))
    out = obs.groupBy(*KEY).agg(newest.alias("_row"), F.min("scraped_at").alias("first_seen_at"), F.max("scraped_at").alias("last_seen_at"))
    return out.select(*[F.col(c) if c in KEY else F.col("_row")[c].alias(c) for c in obs.columns], "first_seen_at", "last_seen_at")


def price_changes(snapshots: DataFrame, only: F.Column | None = None) -> DataFrame:
    """A row for each day whose price differs from the last known price before it.

    percent_change has 4 digits, and is 0 if the old price is 0. only: which snapshots to give
    rows for; they are compared with all.
    """
    before = Window.partitionBy(*KEY).orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    old = F.last("price", ignorenulls=True).over(before)
    changed = snapshots.withColumn("old_price", old).filter(F.col("old_price").isNotNull() & F.col("price").isNotNull() & (F.col("old_price") != F.col("price")))
    if only is not None:
        changed = changed.filter(only)
    diff = F.col("price") - F.col("old_price")
    pct = F.when(F.col("old_price") == 0, F.lit(0.0)).otherwise(F.round((diff / F.nullif(F.col("old_price"), F.lit(0.0)) * 100).cast("decimal(24,8)"), 4).cast("double"))
    money = lambda c: F.round(c.cast("decimal(18,6)"), 2).cast("double")
    return changed.select(*KEY, "day", "old_price", F.col("price").alias("new_price"), money(diff).alias("absolute_change"), pct.alias("percent_change"))


def mark_inactive(listings: DataFrame, now, days: int = 3, seen: Observation | None = None) -> DataFrame:
    """Active listings not seen for ``days`` become inactive; inactive ones stay so.

    Without a column ``active`` all count as active. ``seen`` gets ``n_marked``.
    """
    was = F.coalesce("active", F.lit(False)) if "active" in listings.columns else F.lit(True)
    fresh = F.col("last_seen_at") >= F.lit(now).cast("timestamp_ntz") - F.make_dt_interval(F.lit(days))
    out = listings.withColumn("_was", was).withColumn("active", was & fresh)
    if seen:
        out = out.observe(seen, F.count_if(F.col("_was") & ~F.col("active")).alias("n_marked"))
    return out.drop("_was")


def latest_snapshots(snapshots: DataFrame) -> DataFrame:
    """The newest snapshot of each listing: (source, listing_id, day, event_id)."""
    return snapshots.groupBy(*KEY).agg(F.max("day").alias("day"), F.max_by("event_id", F.struct("day", "event_id")).alias("event_id"))
