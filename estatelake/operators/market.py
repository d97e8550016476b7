"""Statistics of the market: daily groups, distributions, index series, benchmarks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from estatelake.functions.columns import per_sqm, rounded

GROUP = ["source", "deal_type", "category", "district"]
#: The grain of the daily table.
DAILY = ["source", "deal_type", "category", "locality", "layout"]
#: Fixed names of categories, as sources write them.
BUCKETS = {"apartment": ("apartment", "byty"), "house": ("house", "domy")}


def _active(df: DataFrame) -> DataFrame:
    """Rows that are active, if the table says so."""
    return df.filter("active") if "active" in df.columns else df


def bucket(category: F.Column) -> F.Column:
    out = F.lit(None).cast("string")
    for name, words in BUCKETS.items():
        out = F.when(category.isin(*words), name).otherwise(out)
    return out


def _median(c: str, approx: bool) -> F.Column:
    return F.percentile_approx(c, 0.5, 10_000).cast("double") if approx else F.percentile(c, 0.5)


def market_statistics(listings: DataFrame, by: list[str] = GROUP, approx: bool = False, stat_date=None) -> DataFrame:
    """Count, exact median and mean of price and price per m2, smallest and largest price; null groups become ''.

    Inactive listings don't count, if there is a column ``active``. stat_date: the day of the rows.
    """
    priced = _active(listings).filter(F.col("price").isNotNull()).withColumn("sqm", per_sqm(F.col("price"), F.col("area")))
    keyed = priced.select(*[F.coalesce(F.col(k), F.lit("")).alias(k) for k in by], "price", "sqm")
    out = keyed.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), rounded(_median("price", approx)).alias("median_price"), rounded(F.avg("price")).alias("mean_price"), rounded(_median("sqm", approx)).alias("median_sqm"), rounded(F.avg("sqm")).alias("mean_sqm"), F.min("price").alias("min_price"), F.max("price").alias("max_price"))
    return out if stat_date is None else out.select(F.lit(stat_date).cast("date").alias("stat_date"), "*")


def price_distribution(listings: DataFrame, by: list[str], approx: bool = False) -> DataFrame:
    """Quartiles of the price per m2 of active listings for each group, and over all categories (category null)."""
    sqm = _active(listings).withColumn("sqm", per_sqm(F.col("price"), F.col("area"))).filter(F.col("sqm").isNotNull())
    shares = F.array(*[F.lit(x) for x in (0.25, 0.5, 0.75)])
    q = F.percentile_approx("sqm", shares, 10_000) if approx else F.percentile("sqm", shares)
    parts = [df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("sqm").alias("low"), q.alias("q"), F.max("sqm").alias("high")) for df, keys in ((sqm.filter("category IS NOT NULL"), [*by, "category"]), (sqm, by))]
    both = parts[0].unionByName(parts[1], allowMissingColumns=True)
    return both.select(*by, "category", "n", "low", *[rounded(F.col("q")[i]).alias(f"p{p}") for i, p in enumerate((25, 50, 75))], "high")


def median_index(snapshots: DataFrame, by: list[str] | None = None, approx: bool = False) -> DataFrame:
    """By day: median price, median price per m2 and number of snapshots."""
    sqm = snapshots.filter(F.col("price").isNotNull()).withColumn("sqm", per_sqm(F.col("price"), F.col("area")))
    return sqm.groupBy("day", *(by or [])).agg(rounded(_median("price", approx)).alias("median_price"), rounded(_median("sqm", approx)).alias("median_sqm"), F.count(F.lit(1)).alias("n"))


def in_districts(snapshots: DataFrame, listings: DataFrame) -> DataFrame:
    """Priced snapshots of a bucket, with the listing's district (null if it has none)."""
    where = listings.select("source", "listing_id", F.nullif("district", F.lit("")).alias("district"))
    return snapshots.drop("district").withColumn("bucket", bucket(F.col("category"))).filter(F.col("bucket").isNotNull() & F.col("price").isNotNull()).join(where, ["source", "listing_id"])


def bucket_index(snapshots: DataFrame, listings: DataFrame, approx: bool = False) -> DataFrame:
    """The median index by deal type and bucket, for each district and for the whole market (district null)."""
    met = in_districts(snapshots, listings)
    own = median_index(met.filter(F.col("district").isNotNull()), ["deal_type", "bucket", "district"], approx)
    return own.unionByName(median_index(met, ["deal_type", "bucket"], approx), allowMissingColumns=True)


def bucket_districts(snapshots: DataFrame, listings: DataFrame) -> DataFrame:
    """Districts with snapshots by deal type and bucket, and how many listings these are of."""
    met = in_districts(snapshots, listings).filter(F.col("district").isNotNull())
    return met.groupBy("deal_type", "bucket", "district").agg(F.count_distinct("source", "listing_id").alias("n_listings"))


def covered_districts(snapshots: DataFrame) -> DataFrame:
    return snapshots.groupBy("district").agg(F.count_distinct("source", "listing_id").alias("n_listings"))


def latest_period(bench: DataFrame, by: list[str]) -> DataFrame:
    return bench.groupBy(*by).agg(F.max_by("period", F.struct("year", "quarter", "period")).alias("period"))


def match_benchmarks(listings: DataFrame, bench: DataFrame) -> DataFrame:
    """The district's row of the listing's period, else its region's: bench has (granularity, place, period, value)."""
    own = bench.filter("granularity = 'district'").select(F.col("place").alias("district"), "period", F.col("value").alias("own"))
    wide = bench.filter("granularity = 'region'").select(F.col("place").alias("region"), "period", F.col("value").alias("wide"))
    met = listings.join(own, ["district", "period"], "left").join(wide, ["region", "period"], "left")
    return met.withColumn("benchmark", F.coalesce("own", "wide")).withColumn("level", F.when(F.col("own").isNotNull(), "district").when(F.col("wide").isNotNull(), "region")).drop("own", "wide")


def benchmark_series(bench: DataFrame, places: DataFrame, n: int = 16) -> DataFrame:
    """places: (district, region). One row for each district and period, the district's own before the region's; the last n periods."""
    own = places.join(bench.filter("granularity = 'district'").withColumnRenamed("place", "district"), "district").withColumn("preferred", F.lit(0))
    wide = places.join(bench.filter("granularity = 'region'").withColumnRenamed("place", "region"), "region").withColumn("preferred", F.lit(1))
    first = Window.partitionBy("district", "period").orderBy("preferred")
    newest = Window.partitionBy("district").orderBy(F.desc("year"), F.desc("quarter"))
    one = own.unionByName(wide).withColumn("_n", F.row_number().over(first)).filter("_n = 1")
    return one.withColumn("_n", F.row_number().over(newest)).filter(F.col("_n") <= n).drop("_n", "preferred")


def year_on_year(series: DataFrame, key: str) -> DataFrame:
    """Change in percent against four quarters before, one digit."""
    w = Window.partitionBy(key).orderBy("year", "quarter")
    before = F.lag("value", 4).over(w)
    return series.withColumn("yoy", rounded((F.col("value") / F.nullif(before, F.lit(0.0)) - 1) * 100, 1))


def thinned(series: DataFrame, key: str, order: str, most: int = 16) -> DataFrame:
    """At most ``most`` rows of each key, evenly, first and last included: places round(i (n - 1) / (most - 1)), half to even."""
    w = Window.partitionBy(key)
    placed = series.withColumn("_at", F.row_number().over(w.orderBy(order)) - 1).withColumn("_n", F.count(F.lit(1)).over(w))
    picks = F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda i: F.bround(i * (F.col("_n") - 1) / F.lit(float(most - 1)), 0).cast("long"))
    return placed.filter((F.col("_n") <= most) | F.array_contains(picks, F.col("_at").cast("long"))).drop("_at", "_n")


def market_context(requests: DataFrame, stats: DataFrame, medians: DataFrame) -> DataFrame:
    """Exact statistics of a request's group, else its district's median, else null; ``context`` says which."""
    exact = stats.select("deal_type", "category", "district", F.col("median_price").alias("exact"))
    live = medians.select("deal_type", "district", F.col("median_price").alias("live"))
    met = requests.join(exact, ["deal_type", "category", "district"], "left").join(live, ["deal_type", "district"], "left")
    return met.withColumn("median", F.coalesce("exact", "live")).withColumn("context", F.when(F.col("exact").isNotNull(), "exact").when(F.col("live").isNotNull(), "district")).drop("exact", "live")


def latest_statistics(stats: DataFrame, by: list[str]) -> DataFrame:
    """Of each group over all sources, the row of the newest day with the most listings."""
    rest = F.struct(*[c for c in stats.columns if c not in by])
    newest = stats.groupBy(*by).agg(F.max_by(rest, F.struct("stat_date", "n", F.col("median_price"), F.col("source"))).alias("_row"))
    return newest.select(*by, "_row.*")


def district_medians(listings: DataFrame, approx: bool = False) -> DataFrame:
    """Medians of active listings by (deal_type, category, district, layout), and by the first three (layout null)."""
    keys = ["deal_type", "category", "district"]
    known = listings.filter(F.col("district").isNotNull())
    fine = market_statistics(known.filter(F.col("layout").isNotNull()), [*keys, "layout"], approx)
    return fine.unionByName(market_statistics(known, keys, approx), allowMissingColumns=True)


def request_context(requests: DataFrame, stats: DataFrame, listings: DataFrame) -> DataFrame:
    """For each request the newest statistics of its (deal_type, category, locality, layout), else its district's live median with its layout, else without; ``context`` says which."""
    facts = ["median_price", "median_sqm", "n"]
    group = ["deal_type", "category", "locality", "layout"]
    named = lambda df, keys, to: df.select(*[F.col(k).alias(f"_{to}_{k}") for k in keys], F.struct(*facts).alias(to))
    exact = named(latest_statistics(stats, group), group, "exact")
    live, keys = district_medians(listings), ["deal_type", "category", "district"]
    met = requests.join(exact, [F.coalesce(requests[k], F.lit("")) == F.col(f"_exact_{k}") for k in group], "left")
    met = met.join(named(live.filter("layout IS NOT NULL"), [*keys, "layout"], "fine"), [requests[k] == F.col(f"_fine_{k}") for k in [*keys, "layout"]], "left")
    met = met.join(named(live.filter("layout IS NULL"), keys, "coarse"), [requests[k] == F.col(f"_coarse_{k}") for k in keys], "left")
    best = F.coalesce("exact", "fine", "coarse")
    which = F.when(F.col("exact").isNotNull(), "exact").when(F.col("fine").isNotNull(), "district_layout").when(F.col("coarse").isNotNull(), "district")
    return met.select(*[requests[c] for c in requests.columns], *[best[c].alias(f"market_{c}") for c in facts], which.alias("context"))


def benchmark_summary(bench: DataFrame, period: str | None = None, city: str | None = None) -> DataFrame:
    """Rows of a period (default: the latest) in the segment ``all``: the first city's and all districts'; ``headline`` marks the former."""
    from estatelake.operators.search import benchmark_rows

    rows = benchmark_rows(bench, period=period, segment="all", city=city).filter(F.col("granularity").isin("city", "district"))
    whole = rows.filter("granularity = 'city'")
    first = whole.agg(F.min_by(F.struct(*rows.columns), F.struct(F.col("district").isNotNull(), "district", "city", "source")).alias("r")).filter("r IS NOT NULL").select("r.*")
    return first.withColumn("headline", F.lit(True)).unionByName(rows.filter("granularity = 'district'").withColumn("headline", F.lit(False)))


def index_points(series: DataFrame) -> DataFrame:
    """The index as its readers see it: ISO dates, numbers as doubles, names in camel case."""
    return series.select(F.date_format("day", "yyyy-MM-dd").alias("date"), F.col("median_price").cast("double").alias("medianPrice"), F.col("median_sqm").cast("double").alias("medianPricePerSqm"), F.col("n").cast("long").alias("propertyCount"))
