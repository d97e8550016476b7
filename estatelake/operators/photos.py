"""Bookkeeping of photo scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def gallery_hash(images: F.Column, most: int = 50) -> F.Column:
    """Identity of a gallery: its first URLs in order."""
    return F.sha2(F.array_join(F.slice(images, 1, most), "\n"), 256)


def pending_galleries(listings: DataFrame, scores: DataFrame, now, version: str, limit: int | None = None, rescore: bool = False, cool_down_days: int = 7) -> DataFrame:
    """Listings to score: a new gallery or version; a gallery that failed within the cool-down waits."""
    met = listings.filter(F.size("images") > 0).withColumn("gallery", gallery_hash(F.col("images"))).join(scores.select("id", F.col("gallery").alias("_g"), F.col("version").alias("_v"), F.col("failed_at").alias("_f")), "id", "left")
    same = F.coalesce(F.col("gallery") == F.col("_g"), F.lit(False))
    waits = same & F.coalesce(F.col("_f") > F.lit(now).cast("timestamp") - F.make_dt_interval(F.lit(cool_down_days)), F.lit(False))
    done = same & F.coalesce(F.col("_v") == version, F.lit(False)) & F.col("_f").isNull()
    out = met if rescore else met.filter(~waits & ~done)
    out = out.drop("_g", "_v", "_f")
    return out.orderBy("id").limit(limit) if limit else out


def merge_scores(scores: DataFrame, results: DataFrame, now) -> DataFrame:
    """results: (id, gallery, version, n_images, metrics...). An empty result never overwrites metrics; it marks the attempt on a stored row."""
    r, s = results.alias("r"), scores.alias("s")
    full = F.coalesce(F.col("r.n_images") > 0, F.lit(False))
    met = s.join(r, F.col("s.id") == F.col("r.id"), "full_outer").filter(F.col("s.id").isNotNull() | full)
    take = [F.when(full, F.col(f"r.{c}") if c in results.columns else F.lit(None)).otherwise(F.col(f"s.{c}")).alias(c) for c in scores.columns if c not in ("id", "failed_at")]
    failed = F.when(full, None).when(F.col("r.id").isNotNull(), F.lit(now).cast("timestamp")).otherwise(F.col("s.failed_at"))
    return met.select(F.coalesce("s.id", "r.id").alias("id"), *take, failed.alias("failed_at"))


def to_100(score: F.Column) -> F.Column:
    """A score on a scale of 0 to 100, whole; up to 1 it is a share, up to 10 a mark."""
    scaled = F.when(score <= 1, score * 100).when(score <= 10, score * 10).otherwise(score)
    return F.when(score.isNotNull(), F.bround(F.greatest(F.lit(0.0), F.least(F.lit(100.0), scaled.cast("double"))), 0))


def photo_section(scores: DataFrame, *also: F.Column | str) -> DataFrame:
    """(id, available, quality, brightness, sharpness, observations, the columns ``also``): observation codes by rule; rows of a mock model, and rows without a metric, are unavailable."""
    real = F.coalesce(F.col("model_provider") != "mock", F.lit(True))
    q, bright, clear, exposed, fine = (to_100(F.coalesce(*map(F.col, c))) for c in (("image_quality", "photo_quality"), ("brightness",), ("sharpness",), ("exposure_quality",), ("resolution_quality",)))
    available = real & (q.isNotNull() | F.col("brightness").isNotNull())
    light = F.when(bright.isNotNull() & exposed.isNotNull(), F.when((bright >= 50) & (exposed >= 70), "bright_well_exposed").when(bright < 50, "dim").otherwise("uneven_exposure"))
    blurred = F.when(F.col("blurry_image_ratio") >= 0.5, "mostly_blurry").when(F.col("blurry_image_ratio") > 0, "some_blurry")
    codes = F.array_compact(F.array(light, blurred, F.when(fine >= 60, "resolution_ok").when(fine.isNotNull(), "resolution_low"), F.when(F.col("gallery_size") < 3, "limited_coverage")))
    shown = lambda c: F.when(available, c)
    return scores.select("id", available.alias("available"), shown(q).alias("quality"), shown(bright).alias("brightness"), shown(clear).alias("sharpness"), shown(codes).alias("observations"), *also)


def photo_comparison(best: DataFrame, scores: DataFrame) -> DataFrame:
    """best: (id, o_id). A listing's photo quality, brightness and sharpness beside the means of its comparables, all 0 to 100; mock rows don't count, and both sides need a quality."""
    real = scores.filter(F.coalesce(F.col("model_provider") != "mock", F.lit(True)))
    marks = real.select("id", to_100(F.coalesce("image_quality", "photo_quality")).alias("quality"), to_100(F.col("brightness")).alias("brightness"), to_100(F.col("sharpness")).alias("sharpness"))
    names = ["quality", "brightness", "sharpness"]
    other = marks.select(F.col("id").alias("o_id"), *[F.col(c).alias(f"o_{c}") for c in names])
    means = best.select("id", "o_id").join(other, "o_id").groupBy("id").agg(*[F.bround(F.avg(f"o_{c}"), 0).alias(f"mean_{c}") for c in names], F.count("o_quality").alias("n_scored"))
    return marks.join(means, "id").filter(F.col("quality").isNotNull() & F.col("mean_quality").isNotNull())


def latest_snapshot_scores(listings: DataFrame, snapshots: DataFrame, scores: DataFrame) -> DataFrame:
    """Active listings with photos, the id of their newest snapshot, and their stored score, if any. snapshots: (id, snapshot_id, day)."""
    newest = snapshots.groupBy("id").agg(F.max_by("snapshot_id", F.struct("day", "snapshot_id")).alias("snapshot_id"))
    held = listings.filter(F.col("active") & (F.coalesce(F.size("images"), F.lit(0)) > 0))
    return held.join(newest, "id", "left").join(scores, "id", "left")
