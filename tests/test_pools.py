"""Pools without a row for each pair, and questions that are asked once."""

import pytest
from pyspark.sql import functions as F

from estatelake.operators import geo, report, valuation


@pytest.mark.parametrize("cap", [200, 7])
def test_summaries_are_those_of_pairs(spark, cap):
    i = F.col("id")
    rows = spark.range(300).select(
        "id", F.when(i % 7 != 0, (i % 3).cast("string")).alias("layout"), F.when(i % 13 != 0, (i % 37 + 1).cast("int")).alias("area"), F.when(F.floor(i / 3) % 5 != 0, F.round(1000 + F.pmod(F.hash("id"), F.lit(9000)) / 7, 2)).alias("price"), (i % 4 != 0).alias("active"),
        F.when(i % 17 != 0, (i % 2).cast("string")).alias("city"), F.when(i % 19 != 0, (i % 12).cast("string")).alias("district"), F.when(i % 11 != 0, (i % 5).cast("string")).alias("category"), F.when(i % 23 != 0, (i % 2).cast("string")).alias("deal_type"),
    ).cache()
    pools = lambda df: valuation.comparables(df, cap).drop(*valuation.SEGMENT)
    pairs = valuation.widened(pools(rows), pools(rows.withColumn("district", F.col("city"))))
    want = valuation.value_listings(pairs).join(pairs.groupBy("id").agg(F.max("widened").alias("wide")), "id").join(rows.filter("price IS NULL").select("id"), "id", "left_semi")
    made = valuation.pool_summaries(rows, F.col("price").isNull(), cap)
    got = valuation.valued(made).join(made.select("id", "wide"), "id")
    told = lambda df: sorted(map(repr, map(tuple, df.select(*want.columns).collect())))
    assert len(told(want)) > 30 and {r["wide"] for r in made.collect()} == {True, False}
    assert told(got) == told(want)


def test_equal_questions_meet_equal_rows_once(spark, monkeypatch):
    met = spark.sparkContext.accumulator(0)

    def looked(*_):
        met.add(1)
        return True

    monkeypatch.setattr(geo, "plausible", lambda *c: F.udf(looked, "boolean")(*c[:4]))
    asked = spark.range(120).select("id", F.array(F.lit("Dlhá"), F.lit("Krátka")).alias("candidates"), F.when(F.col("id") % 2 == 0, "3").alias("house_number"), F.lit("T").alias("town"), (F.col("id") % 1 + 48.0).alias("town_lat"), (F.col("id") % 1 + 17.0).alias("town_lon"))
    held = spark.range(200).select(F.lit("dlha").alias("street"), F.lit("t").alias("town"), F.when(F.col("id") % 10 > 0, (F.col("id") % 10).cast("string")).alias("number"), (48 + (F.col("id") % 10) / 100).alias("lat"), F.lit(17.0).alias("lon"))
    out = geo.geocode_streets(asked, held).collect()
    assert met.value <= 3 and len(out) == 120
    assert {(r["id"] % 2, r["street"], r["geo_lat"], r["matched"]) for r in out} == {(0, "Dlhá", 48.03, "house"), (1, "Dlhá", 48.0, "street")}


def test_report_pools_are_a_row_for_each_listing_with_its_best(spark, monkeypatch):
    monkeypatch.setattr(valuation, "PART_LISTINGS", 900)
    i = F.col("id")
    rows = spark.range(2600).select(
        "id", F.when(i % 7 != 0, (i % 3).cast("string")).alias("layout"), F.when(i % 13 != 0, (i % 37 + 1).cast("int")).alias("area"), F.when(i % 11 != 0, F.round(1000 + F.pmod(F.hash("id"), F.lit(9000)) / 7, 2)).alias("price"), (i % 4 != 0).alias("active"),
        F.lit("C").alias("city"), F.when(i % 100 == 0, (i % 3).cast("string")).when(i % 19 != 0, "D").alias("district"), F.when(i % 5 != 0, "house").alias("category"), F.lit("buy").alias("deal_type"), F.concat(F.lit("l"), "id").alias("locality"), F.concat(F.lit("u"), "id").alias("url"),
    ).cache()
    pools = lambda df: valuation.comparables(df).drop(*valuation.SEGMENT)
    pairs = valuation.widened(pools(rows), pools(rows.withColumn("district", F.col("city")))).cache()
    made = report.pools(rows).cache()
    assert made.count() == made.select("id").distinct().count() == pairs.select("id").distinct().count() > 2000
    told = lambda df: sorted(map(repr, map(tuple, df.collect())))
    want = valuation.value_listings(pairs)
    assert told(valuation.valued(made)) == told(want)
    names = ["o_id", "o_layout", "o_area", "o_price", "o_sqm", "similarity"]
    got = made.select("id", F.posexplode("best").alias("n", "b"))
    assert told(got.select("id", F.col("n") + 1, *[F.col("b")[c] for c in names])) == told(valuation.best_comparables(pairs).select("id", "rank", *names))
    assert got.filter("b.o_url <> concat('u', b.o_id) OR b.o_locality <> concat('l', b.o_id)").count() == 0 < got.count()
