"""Quantiles from sketches that add up: stored by day and group, merged for any range of days, kept as a stream's state.

A KLL sketch of parameter k answers a quantile with a rank error of about 1.7 / k,
whatever the number of values, in some k numbers; up to k values it is exact. So
a day's medians need no second look at its rows, and a range's need the sketches
of its days only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelake.functions.columns import per_sqm, rounded

#: Rank errors stay below half a percent.
K = 800
#: Values of a listing that have a sketch each.
VALUES = {"price": F.col, "sqm": lambda c: per_sqm(F.col("price"), F.col("area"))}


def _sketches(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    shown = rows.select(*by, *[of(name).cast("double").alias(name) for name, of in VALUES.items()]).filter("price IS NOT NULL")
    return shown.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[F.kll_sketch_agg_double(name, F.lit(k)).alias(f"{name}_sketch") for name in VALUES])


def day_sketches(rows: DataFrame, by: list[str], k: int = K) -> DataFrame:
    """(day, by, n, price_sketch, sqm_sketch) of the priced rows: a row for each day and group, to be stored."""
    return _sketches(rows, ["day", *by], k)


def merged(sketches: DataFrame, by: list[str], k: int = K) -> DataFrame:
    """The sketches of any of the days and groups as one for each ``by``."""
    return sketches.groupBy(*by).agg(F.sum("n").alias("n"), *[F.kll_merge_agg_double(f"{name}_sketch", F.lit(k)).alias(f"{name}_sketch") for name in VALUES])


def quantile(sketch: Column, share: float) -> Column:
    """Null for a sketch without values."""
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(float(share))))


def index_of(sketches: DataFrame) -> DataFrame:
    """The median index from sketches, with the names of ``market.median_index``."""
    rest = [c for c in sketches.columns if c not in ("n", *[f"{v}_sketch" for v in VALUES])]
    return sketches.select(*rest, rounded(quantile(F.col("price_sketch"), 0.5)).alias("median_price"), rounded(quantile(F.col("sqm_sketch"), 0.5)).alias("median_sqm"), "n")


def distribution_of(sketches: DataFrame) -> DataFrame:
    """Quartiles of the price per m2 from sketches, with the names of ``market.price_distribution``."""
    rest = [c for c in sketches.columns if c not in ("n", *[f"{v}_sketch" for v in VALUES])]
    at = lambda share: rounded(quantile(F.col("sqm_sketch"), share))
    return sketches.select(*rest, F.kll_sketch_get_n_double("sqm_sketch").alias("n"), at(0.0).alias("low"), at(0.25).alias("p25"), at(0.5).alias("p50"), at(0.75).alias("p75"), at(1.0).alias("high")).filter("n > 0")


def rank_errors(rows: DataFrame, medians: DataFrame, by: list[str], value: str, median: str) -> DataFrame:
    """(by, n, error): how far the share of values below the median, and up to it, is from a half; 0 if a half lies between."""
    met = rows.join(medians.select(*by, F.col(median).alias("_m")), by).filter(F.col(value).isNotNull())
    below, upto = F.avg((F.col(value) < F.col("_m")).cast("double")), F.avg((F.col(value) <= F.col("_m")).cast("double"))
    return met.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.greatest(below - 0.5, 0.5 - upto, F.lit(0.0)).alias("error"))
