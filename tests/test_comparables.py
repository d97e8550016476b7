"""Comparables among all others of a segment, against pairs of all."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from estatelake.operators import comparables, valuation


def told(df):
    return sorted(map(repr, map(tuple, df.collect())))


@pytest.mark.parametrize(("sizes", "k"), [((1024, 5000, 500), 2), ((16, 30, 7), 1), ((16, 30, 7), 5), ((3, 1, 2), 2)])
def test_all_others_are_met(spark, monkeypatch, sizes, k):
    """Unknown and odd facts, copies, ties, and segments of one to many tiles."""
    for name, size in zip(("TILE", "PART", "BLOCK"), sizes, strict=True):
        monkeypatch.setattr(comparables, name, size)
    i, h = F.col("id"), lambda n, m: F.pmod(F.xxhash64("id", F.lit(n)), F.lit(m))
    few = F.when(i % 9 == 0, F.lit(50)).otherwise(h(1, 90) - 3).cast("int")
    rows = spark.range(900 if sizes[0] > 3 else 200).select(
        (i * 7 % 1009).alias("id"), F.when(h(2, 7) > 0, h(3, 4).cast("string")).alias("layout"), F.when(h(4, 13) > 0, few).alias("area"), F.when(h(5, 11) > 0, F.when(i % 9 == 0, F.lit(4000.0)).otherwise(F.round((h(6, 9000) - 300) / 7, 2))).alias("price"), F.when(h(7, 50) > 0, h(8, 6) > 0).alias("active"),
        F.when(h(9, 19) > 0, F.when(h(10, 8) == 0, h(11, 40).cast("string")).otherwise("D")).alias("district"), F.when(h(12, 11) > 0, h(13, 2).cast("string")).alias("category"), F.when(h(14, 23) > 0, "buy").alias("deal_type"),
    ).cache()
    pairs = valuation.comparables(rows, 1000).cache()
    want = valuation.best_comparables(pairs, k=k).drop(*valuation.SEGMENT)
    got = comparables.best_of_all(rows, k=k).select(*want.columns)
    assert told(got) == told(want) and len(told(want)) > 100 * k
    want = pairs.groupBy("id").agg(*[F.bround(F.percentile(f"o_{c}", 0.5), 0).alias(c) for c in ("price", "area", "sqm")])
    assert told(comparables.pool_medians(rows)) == told(want)


@pytest.fixture
def one_segment(spark, folder):
    """450 listings of one segment, the dearest first: most have their best among later ones than the first 200. A folder, and DuckDB over it."""
    for name in ("nation", "region"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    i = F.col("id")
    spark.range(450).select(i.alias("event_id"), F.timestamp_seconds(1704067200 + i * 60).alias("ts"), (i * 300).alias("user_id"), F.lit("view").alias("event_type"), (9000.5 - i * 19).alias("value"), F.format_string('{"k": %d}', i % 40).alias("props")).write.parquet(f"{folder}/events.parquet")
    con = duckdb.connect()
    for name in ("nation", "region", "events"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'")
    return folder, con


def same_as_sql(spark, folder, con, name):
    got = entry.queries()[name](spark, folder)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({entry.oracle_sql()[name]})").fetchall()
    texts = lambda rows: sorted(str([x if x is None or isinstance(x, str) else float(x) for x in row]) for row in rows)
    got = [tuple(row) for row in got.collect()]
    assert texts(got) == texts(want)
    return got


def test_rows_of_a_segment_beyond_200(spark, one_segment):
    """others beyond a segment's first 200 were never met, neither as best nor in the medians."""
    got = same_as_sql(spark, *one_segment, "r2_comparable_rows")
    assert sum(r[1] == "best" and r[3] > 200 for r in got) > 400
    # The middle of all others' prices: 4,725.5 or 4,744.5.
    assert {r[6] for r in got if r[1] == "median"} == {4726.0, 4744.0}


def test_best_of_a_segment_beyond_200(spark, one_segment):
    """the best two were chosen among a segment's first 200."""
    got = same_as_sql(spark, *one_segment, "w5_best_comparables")
    assert sum(r[1] > 200 for r in got) > 400
