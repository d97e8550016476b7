"""Session helpers and distributed numbering shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from estatelake.sources.shared import keep, scratch, shared_dir

__all__ = ["ASCII_SPACE", "NULL_ID", "id_key", "keep", "ranked", "scratch", "shared_dir", "table"]

#: A null id sorts after every other id and is one document of its own.
NULL_ID = 2**63 - 1
#: ASCII white space [\x20\x09-\x0D], the only separators that these operators know.
ASCII_SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_key(col: str) -> F.Column:
    """The id as a key without nulls."""
    return F.coalesce(F.col(col).cast("long"), F.lit(NULL_ID))


def ranked(df: DataFrame, keys: list[str], order: list[str], salt: F.Column, salts: int, rank: str) -> DataFrame:
    """Adds ``rank``: 1, 2, ... within ``keys``, in the order of (salt, *order).

    A key may hold most of the rows: each (key, salt) is numbered by itself and
    starts where the counts of the salts before it end. ``df`` is evaluated twice.
    """
    part = df.withColumn("_salt", F.pmod(salt, F.lit(salts)))
    counts = part.groupBy(*keys, "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_salt").alias("_s"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    local = part.withColumn("_r", F.row_number().over(Window.partitionBy(*keys, "_salt").orderBy(*order)))
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)] + [F.col("_salt") == F.col("_s")]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    return local.join(starts, cond).withColumn(rank, F.col("_start") + F.col("_r")).drop("_salt", "_s", "_r", "_start", *[f"_k{i}" for i in range(len(keys))])
