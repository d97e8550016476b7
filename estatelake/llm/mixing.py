"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected target / source_size times in the mix, a
rate of 3 at most. Within the source, documents are ordered by size, so that
each part of the order holds documents of like size; the prefix sums of the
expected copies, moved by one random offset in [0, 1) for the source, cross an
integer once for each copy that is emitted. So a document is taken floor(rate)
or ceil(rate) times, and a source's words miss its target by about one document.

A source may hold most of the rows: ranks come from counts by (source, size,
salt), never from one task over a source. What is windowed without salt is one
row for each (source, size) or source.

Cases: null text has size 0; null source is a source of its own, after all
others; a source of size 0 has target 0 and rate 0; rows with the same id are
ranked one by one; an empty table gives no rows; the offset depends on seed and
source alone, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from estatelake.llm.common import keep, ranked, table

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
#: Documents of one source and size that a task ranks, about; at least LEAST_SALTS parts.
RANKED_ROWS, LEAST_SALTS = 1 << 18, 64


def words(text: F.Column) -> F.Column:
    """Number of [^\\x20\\x09-\\x0D]+ in a text; null: 0. Counts the places where a word begins."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """``sizes``: (source, source_size), a row for each source. Adds ``target``.

    Sharing a total by weight, with what exceeds a source's limit shared again,
    ends at target = min(limit, level * weight): sources are passed in the order
    of limit / weight, and the level is set by the first source that stays below
    its limit. One row for each source goes through these windows.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    weight = F.get(F.array(*[F.lit(w) for w in weights]), F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))))
    w = sizes.withColumn("weight", weight.cast("long")).withColumn("cap", F.col("source_size") * most)
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before, rest, every = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing), order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    w = w.withColumn("level", (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(rest))
    level = F.min(F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.struct(F.col("cap") / F.col("weight"), "level"))).over(every)["level"]
    return w.withColumn("target", F.least(F.col("cap").cast("double"), level * F.col("weight"))).select("source", "source_size", "target")


def offset(source: F.Column, seed: int) -> F.Column:
    """In [0, 1), from the first 32 bits of a digest."""
    return F.conv(F.substring(F.md5(F.encode(F.concat(F.lit(f"{seed}:"), F.coalesce(source, F.lit(""))), "UTF-8")), 1, 8), 16, 10).cast("double") / 2**32


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, seed: int = 17, hot_rows: int = RANKED_ROWS) -> DataFrame:
    """Returns ``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``copies`` and ``taken``; also ``row_no``, if the documents have a column ``_row_no``."""
    numbered = [F.col("_row_no").alias("row_no")] * ("_row_no" in docs.columns)
    sized = keep(docs.select(_row_key(id_col, text_col).alias("key"), *numbered, F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), words(F.col(text_col)).alias("size")), "mix-sizes")
    groups = keep(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-groups")
    goals = targets(groups.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, most)
    starts = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.withColumn("first", F.coalesce(F.sum("n").over(starts), F.lit(0)))
    rated = groups.join(goals, groups["source"].eqNullSafe(goals["source"])).select(groups["source"].alias("g_source"), F.col("size").alias("g_size"), "first", "source_size", "target")
    salts = max(LEAST_SALTS, -(-(groups.agg(F.max("n")).first()[0] or 0) // RANKED_ROWS))
    if numbered:
        # One key may be that of a third of all rows, which then go to as many parts as they need; all other keys stay where their value puts them.
        hot = keep(sized.groupBy("source", "size", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot_rows), "mix-hot").select(F.col("source").alias("h_source"), F.col("size").alias("h_size"), F.col("key").alias("h_key"), F.ceil(F.col("n") / hot_rows).alias("parts"))
        sized = sized.join(hot, F.col("source").eqNullSafe(F.col("h_source")) & (F.col("size") == F.col("h_size")) & (F.col("key") == F.col("h_key")), "left").withColumn("part", F.when(F.col("parts").isNotNull(), F.pmod(F.xxhash64("row_no"), F.col("parts"))).otherwise(F.lit(0))).drop("h_source", "h_size", "h_key", "parts")
        placed = ranked(sized, ["source", "size"], ["key", "row_no"], F.pmod("key", F.lit(salts)) + F.col("part"), salts, "rank")
    else:
        placed = ranked(sized, ["source", "size"], ["key"], F.col("key"), salts, "rank")
    met = placed.join(rated, F.col("source").eqNullSafe(F.col("g_source")) & (F.col("size") == F.col("g_size")))
    rate, at = F.col("target") / F.col("source_size"), F.col("first") + F.col("rank")
    shift = offset(F.col("source"), seed)
    copies = F.when(F.col("source_size") == 0, F.lit(0)).otherwise(F.least(F.floor(rate * at + shift) - F.floor(rate * (at - 1) + shift), F.lit(most))).cast("long")
    return met.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size")).select("doc_id", "source", "size", "source_size", "target", "copies", "taken", *["row_no"] * len(numbered))


def _row_key(id_col: str, text_col: str) -> F.Column:
    """The id; rows without one are told apart by their texts."""
    return F.coalesce(F.col(id_col).cast("long"), F.xxhash64(text_col))


def take_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself: each row as often as it is taken, all columns as they are.

    Rows are written with a number each, by which they meet their copies, so rows
    that share an id or have none are dealt like all others. Which of them is taken
    once more follows the ids first; among rows of one id, and one text where there
    is no id, the numbers decide, and a rerun over other partitions may take another.
    """
    rows = keep(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("n")), "mix-rows")
    asked = rows.select(F.col("row")[id_col].alias(id_col), F.col("row")[text_col].alias(text_col), F.col("row")[source_col].alias(source_col), F.col("n").alias("_row_no"))
    mixed = mix(asked, id_col, text_col, source_col, **options)
    taken = mixed.filter("copies > 0").select(F.col("row_no").alias("n"), F.col("copies").cast("int").alias("copies"))
    return rows.join(taken, "n").select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")


def op10_mix_sources(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = """
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS i FROM d GROUP BY source),
w AS (SELECT source, source_size, CASE i WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, source_size * 3 AS cap FROM s),
l AS (
  SELECT *, CAST((SELECT sum(source_size) FROM w) - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
    / CAST(sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level FROM w),
t AS (
  SELECT source, source_size, least(CAST(cap AS DOUBLE), (SELECT arg_min(level, cap / weight) FROM l WHERE level <= cap / weight) * weight) AS target,
    CAST(CAST('0x' || substr(md5('17:' || coalesce(source, '')), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296 AS shift FROM l),
r AS (
  SELECT d.*, t.source_size, t.target, t.shift, row_number() OVER (PARTITION BY d.source ORDER BY size, doc_id % 64, doc_id) AS rank
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CASE WHEN source_size = 0 THEN 0 ELSE CAST(least(floor(target / source_size * rank + shift) - floor(target / source_size * (rank - 1) + shift), 3) AS BIGINT) * size END AS taken
FROM r
"""
