"""Features, training and scoring of the price model."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import Imputer, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estatelake.functions.columns import per_sqm
from estatelake.sources.shared import keep

#: What the model reads, if the frame has it.
CATEGORICAL = ["source", "deal_type", "category", "locality", "district", "layout"]
NUMERIC = ["layout_code", "area", "land_area", "lat", "lon", "n", "median_price", "median_sqm"]
PHOTO = ["photo_image_quality", "photo_brightness", "photo_sharpness"]
#: What a request may leave to the market.
MARKET = ["n", "median_price", "median_sqm"]
#: Rows of a partition in training: at least, about, and at most.
PARTITION_ROWS, MOST_ROWS = 50_000, 4_000_000
#: The order of layouts by rooms.
LAYOUTS = {"atypical": 0, "1+kk": 1, "1+1": 2, "2+kk": 3, "2+1": 4, "3+kk": 5, "3+1": 6, "4+kk": 7, "4+1": 8, "5+kk": 9, "5+1": 10, "6+kk": 11, "6+1": 12}


def layout_code(layout: F.Column) -> F.Column:
    """A layout's place in the order of rooms; null if unknown."""
    return F.create_map(*[F.lit(x) for pair in LAYOUTS.items() for x in pair])[F.lower(layout)]


def target_value(target: str) -> tuple[str, F.Column]:
    """The deal type of a target (sale_*: buy, rent_*: rent), and its value: the price, or the price per m2 for *_per_sqm."""
    kinds = {"sale": "buy", "rent": "rent"}
    if (kind := target.split("_")[0]) not in kinds:
        raise ValueError(f"no such target: {target}")
    return kinds[kind], per_sqm(F.col("price"), F.col("area")) if target.endswith("per_sqm") else F.col("price")


def feature_table(snapshots: DataFrame, listings: DataFrame, stats: DataFrame, photo_scores: DataFrame, target: str) -> DataFrame:
    """Features of all priced snapshots of the target's deal type, with the target.

    snapshots: (snapshot_id, source, listing_id, day, price, area, land_area,
    layout, deal_type, category, locality). listings gives district, lat and lon;
    stats the daily row of the snapshot's day, source, deal type, category,
    locality and layout (null is ''); photo_scores (source, listing_id, and
    PHOTO without its prefix) the photo columns, null if there are none.
    """
    kind, value = target_value(target)
    keys = ["source", "deal_type", "category", "locality", "layout"]
    rows = snapshots.filter((F.col("deal_type") == kind) & F.col("price").isNotNull()).withColumn("target", value)
    rows = rows.select("snapshot_id", *keys, "listing_id", "day", "area", "land_area", "target")
    met = rows.join(listings.select("source", "listing_id", "district", "lat", "lon"), ["source", "listing_id"])
    daily = stats.select(F.col("stat_date").alias("day"), *[F.col(k).alias(f"_{k}") for k in keys], "n", "median_price", "median_sqm")
    met = met.join(daily, [met["day"] == daily["day"], *[F.coalesce(met[k], F.lit("")) == daily[f"_{k}"] for k in keys]], "left").drop(daily["day"])
    photos = photo_scores.select("source", "listing_id", *[F.col(c.removeprefix("photo_")).cast("double").alias(c) for c in PHOTO])
    met = met.join(photos, ["source", "listing_id"], "left").withColumn("layout_code", layout_code(F.col("layout")))
    doubles = [F.col(c).cast("double").alias(c) for c in ("area", "land_area", "lat", "lon", "median_price", "median_sqm")]
    return met.select("snapshot_id", "source", "listing_id", "day", "deal_type", "category", "locality", "district", "layout", "layout_code", *doubles, "n", *PHOTO, "target")


def training_frame(features: DataFrame) -> DataFrame:
    """Rows with a target, in the order of snapshots."""
    return features.filter(F.col("target").isNotNull()).orderBy("snapshot_id")


def build_features(snapshots: DataFrame, stats: DataFrame, target: str) -> DataFrame:
    """Snapshots of the target's deal type (sale_*: buy, rent_*: rent) with their group's statistics.

    The target is the price, or the price per m2 for *_per_sqm; neither is a feature.
    """
    kind, value = target_value(target)
    keys = ["source", "deal_type", "category", "district"]
    rows = snapshots.filter((F.col("deal_type") == kind) & F.col("price").isNotNull())
    rows = rows.select(*[F.coalesce(F.col(k), F.lit("")).alias(k) for k in keys], "listing_id", "day", "area", value.alias("target"))
    return rows.join(stats.select(*keys, "n", "median_price", "median_sqm"), keys, "left")


def metrics(scored: DataFrame, target: str = "target", prediction: str = "prediction") -> dict[str, float]:
    """mae, rmse and r2 of predictions on the price scale; rows without either don't count."""
    known = scored.select(F.col(target).cast("double").alias("target"), F.col(prediction).cast("double").alias("prediction")).na.drop().persist()
    out = {m: RegressionEvaluator(labelCol="target", metricName=m).evaluate(known) for m in ("mae", "rmse", "r2")}
    known.unpersist()
    return out


def training_parts(rows: int, cores: int) -> int:
    """As many as there are cores, or a multiple of it: each tree costs a job for each level, and a partition more than the cores would double its time; fewer for few rows."""
    return max(1, min(rows // PARTITION_ROWS, cores * max(1, -(-rows // (cores * MOST_ROWS)))))


def train(frame: DataFrame, seed: int = 42, rounds: int = 200, depth: int = 5, photos: bool = False, sample: float = 0.9) -> tuple[PipelineModel, dict[str, float]]:
    """Boosted trees on log1p(target); at least 5 rows, a fifth held out from 20 rows on; metrics on the price scale.

    Categories are numbers in their alphabetic order, unknown ones -1, so their
    number is no limit; missing numbers are the median. photos: the model reads
    the photo columns too. sample: share of the rows that a tree sees. A column without a value is left out.
    """
    # Read many times, so written once, before the rows are counted.
    asked, names = [c for c in [*NUMERIC, *PHOTO * photos] if c in frame.columns], [c for c in CATEGORICAL if c in frame.columns]
    rows = keep(frame.filter(F.col("target").isNotNull()).withColumns({c: F.col(c).cast("double") for c in asked}).withColumn("log_target", F.log1p("target")).select(*names, *asked, "target", "log_target"), "training")
    counts = rows.agg(F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(c) for c in asked]).first()
    if counts["rows"] < 5:
        raise ValueError(f"5 rows are needed to train, not {counts['rows']}")
    numbers = [c for c in asked if counts[c]]
    rows = rows.select(*names, *numbers, "target", "log_target").repartition(training_parts(counts["rows"], rows.sparkSession.sparkContext.defaultParallelism))
    fit, held = [part.persist() for part in (rows.randomSplit([0.8, 0.2], seed) if counts["rows"] >= 20 else (rows, rows))]
    indexer = StringIndexer(inputCols=names, outputCols=[f"{c}_index" for c in names], handleInvalid="keep", stringOrderType="alphabetAsc").fit(fit)
    # A new column, without what says that it holds categories: trees then split it as a number.
    order = [f"CASE WHEN {c}_index < {len(labels)} THEN {c}_index ELSE -1D END AS {c}_order" for c, labels in zip(names, indexer.labelsArray, strict=True)]
    steps = [indexer, SQLTransformer(statement=f"SELECT *, {', '.join(order)} FROM __THIS__")]
    for stage in (Imputer(strategy="median", inputCols=numbers, outputCols=[f"{c}_filled" for c in numbers]), VectorAssembler(inputCols=[*[f"{c}_order" for c in names], *[f"{c}_filled" for c in numbers]], outputCol="features"), GBTRegressor(labelCol="log_target", maxIter=rounds, maxDepth=depth, stepSize=0.1, subsamplingRate=sample, seed=seed)):
        ready = PipelineModel(steps).transform(fit)
        steps.append(stage.fit(ready) if hasattr(stage, "fit") else stage)
    model = PipelineModel(steps)
    found = metrics(model.transform(held).withColumn("prediction", F.expm1("prediction")))
    for part in (fit, held):
        part.unpersist()
    return model, found


def score(model: PipelineModel | None, requests: DataFrame, target: str = "sale_price_per_sqm") -> DataFrame:
    """Requests with ``predicted``, on the price scale: whole for a price, two digits for a price per m2. A missing layout code comes from the layout; columns that requests lack are unknown."""
    if model is None:
        raise ValueError(f"no model for {target}")
    asked = requests
    if "layout" in asked.columns:
        given = F.col("layout_code") if "layout_code" in asked.columns else F.lit(None).cast("int")
        asked = asked.withColumn("layout_code", F.coalesce(given, layout_code(F.col("layout"))))
    inputs = model.stages[3].getInputCols()
    lacking = {c.removesuffix("_order"): "string" for c in inputs if c.endswith("_order")} | {c.removesuffix("_filled"): "double" for c in inputs if c.endswith("_filled")}
    asked = asked.withColumns({c: F.lit(None).cast(kind) for c, kind in lacking.items() if c not in asked.columns})
    out = model.transform(asked.withColumns({c: F.col(c).cast("double") for c in [*NUMERIC, *PHOTO] if c in asked.columns}))
    value = F.expm1("prediction")
    shown = F.round(value, 2) if target.endswith("per_sqm") else F.bround(value, 0).cast("long")
    return out.select(*requests.columns, shown.alias("predicted"))


def with_market(requests: DataFrame, target: str, stats: DataFrame, listings: DataFrame) -> DataFrame:
    """Requests of the target's deal type with the market's n, median_price and median_sqm, and ``context``.

    A request that gives none of the three gets them from ``market.request_context``
    (its district, or its locality where it names none); one that gives any keeps
    its own, and its context is null.
    """
    from estatelake.operators.market import request_context

    kind, _ = target_value(target)
    given = requests.withColumn("deal_type", F.lit(kind)).withColumns({c: F.lit(None).cast("double") for c in MARKET if c not in requests.columns})
    own = F.coalesce(*MARKET).isNotNull()
    rest = [c for c in given.columns if c not in (*MARKET, "district")]
    asked = given.select(*rest, F.col("district").alias("_district"), F.struct(*MARKET).alias("_given"), own.alias("_own"), F.coalesce("district", "locality").alias("district"))
    met = request_context(asked, stats, listings)
    filled = [F.when(F.col("_own"), F.col("_given")[c].cast("double")).otherwise(F.col(f"market_{c}").cast("double")).alias(c) for c in MARKET]
    return met.select(*rest, F.col("_district").alias("district"), *filled, F.when(~F.col("_own"), F.col("context")).alias("context"))


def prediction_log(scored: DataFrame, model_name: str, target: str, now) -> DataFrame:
    """What the log gets for scored requests: the request, the prediction as price or price per m2, the model and the time."""
    per = target.endswith("per_sqm")
    price, sqm = (F.lit(None).cast("long"), F.col("predicted")) if per else (F.col("predicted"), F.lit(None).cast("double"))
    request = F.to_json(F.struct(*[c for c in scored.columns if c != "predicted"]))
    return scored.select(F.lit(model_name).alias("model"), F.lit(target).alias("target"), request.alias("request"), price.alias("predicted_price"), sqm.alias("predicted_per_sqm"), F.lit(now).cast("timestamp").alias("predicted_at"))


def save_model(model: PipelineModel, metrics: dict[str, float], path: str, name: str, version: str, target: str, n_rows: int) -> DataFrame:
    """Saves a model under ``path``/name/version with a row beside it: target, columns and metrics. Returns the row."""
    spark = SparkSession.active()
    model.write().overwrite().save(f"{path}/{name}/{version}/model")
    inputs = model.stages[3].getInputCols()
    row = (name, version, target, [c.removesuffix("_order") for c in inputs if c.endswith("_order")], [c.removesuffix("_filled") for c in inputs if c.endswith("_filled")], n_rows, float(metrics["mae"]), float(metrics["rmse"]), float(metrics["r2"]))
    meta = spark.createDataFrame([row], "model_name string, version string, target string, categorical array<string>, numeric array<string>, n_rows long, mae double, rmse double, r2 double")
    meta.write.mode("overwrite").parquet(f"{path}/{name}/{version}/about")
    return meta


def load_model(spark, path: str, name: str, version: str) -> tuple[PipelineModel, DataFrame]:
    return PipelineModel.load(f"{path}/{name}/{version}/model"), spark.read.parquet(f"{path}/{name}/{version}/about")
