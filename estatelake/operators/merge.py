"""Keyed merges of updates into a table (upserts)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from estatelake.sources.shared import keep

#: Fixed names: the natural key of a benchmark, whose place names may be null, and what an import refreshes.
BENCHMARK_KEY = ["source", "period", "country", "city", "district", "locality", "property_type", "segment", "metric"]
BENCHMARK_FACTS = ["source_name", "source_url", "year", "quarter", "value", "change_percent", "transaction_count", "transaction_volume", "notes"]
#: Fixed values of a subscription's first row.
SUBSCRIPTION = {"plan": "basic", "status": "none", "cancel_at_period_end": False}


def last_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The row of each key that comes first in ``order``."""
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_nth", nth).filter(F.col("_nth") == 1).drop("_nth")


def require_unique(df: DataFrame, keys: list[str], what: str) -> None:
    """Raises if a key has more than one row."""
    twice = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(3).collect()
    if twice:
        raise ValueError(f"{what}: more than one row for {[tuple(r[k] for k in keys) for r in twice]}")


def merge_by_key(target: DataFrame, updates: DataFrame, keys: list[str], policies: dict[str, str | tuple] | None = None, null_safe: bool = False, unique: bool = False) -> DataFrame:
    """Full outer join of one row for each key on both sides.

    policies, by column: ``overwrite`` (default), ``keep_old`` (the stored value
    stays), ``coalesce`` (a null update keeps the stored value), ``greatest``,
    ``("const", value)`` (updated and inserted rows get the value).
    null_safe: a null in a key equals a null. unique: a repeated key raises.
    """
    policies = policies or {}
    if unique:
        require_unique(target, keys, "stored rows")
        require_unique(updates, keys, "updates")
    t, u = target.withColumn("_t", F.lit(True)).alias("t"), updates.withColumn("_u", F.lit(True)).alias("u")
    same = [F.col(f"t.{k}").eqNullSafe(F.col(f"u.{k}")) if null_safe else F.col(f"t.{k}") == F.col(f"u.{k}") for k in keys]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    out = []
    for c in target.columns:
        old, new, isnew = F.col(f"t.{c}"), F.col(f"u.{c}") if c in updates.columns else F.lit(None), F.col("_u").isNotNull()
        rule = policies.get(c, "overwrite") if c in updates.columns else "keep_old"
        if c in keys:
            value = F.when(isnew, new).otherwise(old)
        elif rule == "overwrite":
            value = F.when(isnew, new).otherwise(old)
        elif rule == "keep_old":
            value = F.when(F.col("_t").isNotNull(), old).otherwise(new)
        elif rule == "coalesce":
            value = F.coalesce(new, old)
        elif rule == "greatest":
            value = F.greatest(old, new)
        elif isinstance(rule, tuple) and rule[0] == "const":
            value = F.when(isnew, F.lit(rule[1])).otherwise(old)
        else:
            raise ValueError(f"no such policy: {rule}")
        out.append(value.alias(c))
    return t.join(u, cond, "full_outer").select(*out, F.when(F.col("_t").isNull(), "inserted").when(F.col("_u").isNull(), "kept").otherwise("updated").alias("merge_action"))


def fold_partial_updates(events: DataFrame, keys: list[str], order: str, columns: list[str]) -> DataFrame:
    """The last non-null value of each column by key: partial updates in the order of events."""
    return events.groupBy(*keys).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in columns])


def saved_set(events: DataFrame, user: str, item: str, action: str, order: str) -> DataFrame:
    """(user, item) whose last event is ``save``; at the same time, an unsave counts."""
    return events.groupBy(user, item).agg(F.max_by(action, F.struct(order, action)).alias("_last"), F.max(order).alias("saved_at")).filter(F.col("_last") == "save").drop("_last")


def backfill(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str], order: str) -> DataFrame:
    """Null columns of the target from the latest source row of its key."""
    latest = source.groupBy(*keys).agg(F.max_by(F.struct(*columns), order).alias("_new"))
    met = target.join(latest, keys, "left")
    return met.withColumns({c: F.coalesce(c, F.col(f"_new.{c}")) for c in columns}).drop("_new")


def upsert_partitions(spark: SparkSession, path: str, updates: DataFrame, keys: list[str], part: str, policies: dict[str, str] | None = None) -> None:
    """Merges updates into a table partitioned by ``part`` (one of the keys): only partitions that the updates name are read and written.

    Rows of other days stay as they are; the same updates again change nothing.
    """
    if spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()).exists(spark._jvm.org.apache.hadoop.fs.Path(path)):
        stored = spark.read.schema(updates.schema).parquet(path)
        stored = stored.join(updates.select(part).distinct(), part, "left_semi").select(*updates.columns)
        merged = merge_by_key(stored, updates, keys, policies).drop("merge_action")
    else:
        merged = updates
    # Written aside first: what is read is overwritten.
    keep(merged, "merged").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)


def merge_benchmarks(stored: DataFrame, imported: DataFrame) -> DataFrame:
    """A benchmark with the same key (nulls in it are equal) gets the imported facts; all its other columns stay."""
    others = [c for c in stored.columns if c not in BENCHMARK_KEY + BENCHMARK_FACTS]
    return merge_by_key(stored, imported, BENCHMARK_KEY, dict.fromkeys(others, "keep_old"), null_safe=True)


def merge_features(stored: DataFrame, made: DataFrame) -> DataFrame:
    """A snapshot's features in a feature set are replaced."""
    return merge_by_key(stored, made, ["snapshot_id", "feature_set_id"])


def merge_location_scores(stored: DataFrame, scored: DataFrame) -> DataFrame:
    return merge_by_key(stored, scored, ["id"])


def merge_feature_sets(stored: DataFrame, wanted: DataFrame) -> DataFrame:
    """(name, version, target) keeps its id if it is stored, and takes the new description and code version; ids of new ones are a hash of the key."""
    keys = ["name", "version", "target"]
    given = wanted.withColumn("id", F.xxhash64(*keys)).select(*stored.columns)
    return merge_by_key(stored, given, keys, {"id": "keep_old"})


def merge_subscriptions(stored: DataFrame, updates: DataFrame) -> DataFrame:
    """Partial updates: null leaves what is stored; a user's first row gets defaults where the update has nothing."""
    out = merge_by_key(stored, updates, ["user_id"], {c: "coalesce" for c in stored.columns if c != "user_id"})
    new = F.col("merge_action") == "inserted"
    return out.withColumns({c: F.when(new, F.coalesce(c, F.lit(v))).otherwise(F.col(c)) for c, v in SUBSCRIPTION.items() if c in out.columns})


def billing_updates(events: DataFrame, stored: DataFrame, order: str, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """events: (user_id, customer_id, ``order``, columns). Returns one partial update for each user, and events whose customer no subscription has.

    An event names its user, or else its customer, who is looked up in the stored subscriptions.
    """
    known = stored.filter(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(F.min("user_id").alias("_known"))
    met = events.join(known, "customer_id", "left").withColumn("user_id", F.coalesce("user_id", "_known")).drop("_known")
    return fold_partial_updates(met.filter(F.col("user_id").isNotNull()), ["user_id"], order, columns), met.filter(F.col("user_id").isNull())


def run_summary(merged: DataFrame, changes: DataFrame, quarantine: DataFrame) -> DataFrame:
    """One row for an ingest run: new and updated listings, price changes, failed items, status."""
    states = merged.agg(F.count_if(F.col("merge_action") == "inserted").alias("n_new"), F.count_if(F.col("merge_action") == "updated").alias("n_updated"))
    out = states.crossJoin(changes.agg(F.count(F.lit(1)).alias("n_price_changes"))).crossJoin(quarantine.agg(F.count(F.lit(1)).alias("n_failed")))  # one row each
    return out.withColumn("status", F.when(F.col("n_failed") > 0, "completed_with_errors").otherwise("succeeded"))
