"""Reading dumps and benchmarks, writing logs and exports."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from estatelake.sources.shared import keep

#: Columns of a benchmark file.
BENCHMARK = {"source": "string", "source_name": "string", "source_url": "string", "period": "string", "year": "int", "quarter": "int", "country": "string", "city": "string", "district": "string", "locality": "string", "property_type": "string", "segment": "string", "metric": "string", "value": "double", "change_percent": "double", "transaction_count": "int", "transaction_volume": "double", "granularity": "string", "notes": "string"}


def dump_files(reader, path: str) -> DataFrame:
    """Files of dumps whole, by ``spark.read`` or ``spark.readStream``: value, file, path."""
    return reader.text(path, wholetext=True).select("value", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_path").alias("path"))


def dump_items(files: DataFrame) -> DataFrame:
    """Items of dump files (an array or one object a file): raw, nth (place in the file), file, path, actor and landed_at (from <actor>_<date>_<time>.json)."""
    whole = F.when(F.ltrim("value").startswith("["), F.col("value")).otherwise(F.concat(F.lit("["), F.col("value"), F.lit("]")))
    items = files.select("file", "path", F.posexplode(F.from_json(whole, "array<string>")).alias("nth", "raw"))
    stamp = F.regexp_extract("file", r"(\d{4}-\d{2}-\d{2}_\d{2}-\d{2}-\d{2})\.json$", 1)
    return items.withColumn("actor", F.regexp_extract("file", r"^(.*)_\d{4}-\d{2}-\d{2}_", 1)).withColumn("landed_at", F.try_to_timestamp(stamp, F.lit("yyyy-MM-dd_HH-mm-ss")))


def read_dumps(spark: SparkSession, path: str) -> DataFrame:
    """Items of JSON dumps: raw, file, actor and landed_at."""
    return dump_items(dump_files(spark.read, path)).select("file", "raw", "actor", "landed_at")


def read_benchmarks(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """A benchmark CSV with typed columns; blanks are null, '12.0' is 12. strict: other columns raise."""
    raw = spark.read.csv(path, header=True)
    if strict and (other := set(raw.columns) - set(BENCHMARK)):
        raise ValueError(f"unknown columns: {sorted(other)}")

    def typed(name: str, kind: str) -> F.Column:
        text = F.nullif(F.trim(F.col(name)), F.lit("")) if name in raw.columns else F.lit(None).cast("string")
        return (text.try_cast("double").cast("int") if kind == "int" else text.try_cast(kind)).alias(name)

    return raw.select(*[typed(k, v) for k, v in BENCHMARK.items()])


def melt_index(wide: DataFrame, quarter_col: str, national: str) -> DataFrame:
    """A quarter for each row and a region for each column ('1Q 2026') to rows of (granularity, place, period, year, quarter, value)."""
    regions = [c for c in wide.columns if c != quarter_col]
    long = wide.unpivot([quarter_col], regions, "place", "value")
    q, y = F.regexp_extract(quarter_col, r"^(\d)Q", 1).cast("int"), F.regexp_extract(quarter_col, r"(\d{4})$", 1).cast("int")
    return long.select(F.when(F.col("place") == national, "city").otherwise("district").alias("granularity"), "place", F.format_string("%d_Q%d", y, q).alias("period"), y.alias("year"), q.alias("quarter"), F.col("value").cast("double").alias("value"))


def import_benchmarks(spark: SparkSession, path: str, stored: DataFrame, strict: bool = False) -> tuple[DataFrame, dict[str, int]]:
    """Merges a benchmark CSV into the stored table. Returns it, and how many rows were read and imported (a key's last row counts)."""
    from estatelake.operators.merge import BENCHMARK_KEY, merge_benchmarks

    seen = Observation("benchmarks")
    rows = read_benchmarks(spark, path, strict).withColumn("_n", F.monotonically_increasing_id()).observe(seen, F.count(F.lit(1)).alias("rows"))
    last = keep(rows.groupBy(*BENCHMARK_KEY).agg(F.max_by(F.struct(*[c for c in BENCHMARK if c not in BENCHMARK_KEY]), "_n").alias("_r")).select(*BENCHMARK_KEY, "_r.*").select(*BENCHMARK), "benchmarks")
    return merge_benchmarks(stored, last).drop("merge_action"), {"rows": seen.get["rows"], "imported": last.count()}


def raw_rows(items: DataFrame, run_id: str) -> DataFrame:
    """Rows of the raw log for normalised items: run, source, id ('unknown' if there is none), URL, time, item and content hash."""
    known = F.coalesce(F.nullif("source_listing_id", F.lit("")), F.lit("unknown"))
    return items.select(F.lit(run_id).alias("run_id"), "source", known.alias("source_listing_id"), "url", "scraped_at", F.col("raw").alias("item"), "content_hash")


def append_raw(items: DataFrame, path: str) -> None:
    """The append-only log, by source and day; rows need source and scraped_at."""
    items.withColumn("scrape_date", F.to_date("scraped_at")).write.mode("append").partitionBy("source", "scrape_date").parquet(path)


def export_training(frame: DataFrame, path: str, target: str, notes: str | None = None) -> DataFrame:
    """Writes a training set as CSV, and returns its row of lineage: path, target, rows, columns."""
    n = export_csv(frame, path)
    return frame.sparkSession.createDataFrame([(path, target, n, len(frame.columns), notes)], "path string, target string, row_count long, column_count int, notes string")


def index_file_name(deal_type: str, category: str, district: str | None = None) -> str:
    """A plain ASCII name for an exported index."""
    parts = ["market-index", deal_type, category]
    if district:
        parts.append(re.sub(r"[^A-Za-z0-9]+", "-", district).strip("-").lower() or "district")
    return "-".join(parts) + ".csv"


def export_index(series: DataFrame, folder: str, deal_type: str, category: str, district: str | None = None) -> str:
    """Writes an index (day, median_price, median_sqm, n), oldest first, as CSV with the header date, median_price, median_price_per_sqm, property_count. Returns the path."""
    path = f"{folder}/{index_file_name(deal_type, category, district)}"
    named = series.select(F.date_format("day", "yyyy-MM-dd").alias("date"), "median_price", F.col("median_sqm").alias("median_price_per_sqm"), F.col("n").alias("property_count"))
    named.orderBy("date").write.mode("overwrite").csv(path, header=True)
    return path


def export_csv(df: DataFrame, path: str) -> int:
    """Writes with a header; returns the number of rows."""
    seen = Observation("export")
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").csv(path, header=True)
    return seen.get["n"]
