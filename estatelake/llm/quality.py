"""Quality rules with verdicts on hosts.

Each document gets plain counts and a base rule. Beside the base rule, softer
rules look at symbols, repeated lines and word lengths. A host (the source of a
document) is judged by the share of its documents that fail any rule, shrunk
towards the shares of all hosts: a beta distribution is fitted to the hosts'
shares by moments, less what chance alone makes them differ by, and a host with
f of n failures has (f + a) / (n + a + b). A host fails if this is surely (by
SURE deviations) more than TIMES the mean of the fitted distribution, or than
half way from the mean to 1. A document is dropped if it fails the base rule or
if its host fails.

Counts are made in one pass over the texts and written; hosts are aggregated
from them with partial sums, so a host with a third of all rows costs no more.
The fit sees one row for each host through sums alone.

Cases: null text has no words and fails the base rule; null source is a host of
its own; with fewer than two hosts, or shares of 0 or 1 alone, the prior weighs
one document; where hosts differ by no more than chance it weighs MOST_WEIGHT;
an empty table gives no rows; repeated rows count each for itself; extra columns
travel inside ``row``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelake.llm.common import keep, table

SYMBOLS = "#*$%&|<>"
#: Soft rules.
MOST_SYMBOLS_PER_WORD = 0.5
MOST_REPEATED_LINES = 0.3
MEAN_WORD_CHARS = (2.0, 15.0)
#: Of the verdict on a host.
TIMES, SURE = 2.0, 2.0
#: Documents that the prior weighs at most, and as little as one.
MOST_WEIGHT = 1e6

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def count_text(text: str) -> tuple[int, int, int, int, int, int]:
    """COUNTS, and the number of lines with a word."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()  # bytes are split at [\x20\x09-\x0D] alone
    n = len(words)
    raw = np.frombuffer(data, np.uint8)
    spaces = np.count_nonzero((raw == 32) | ((raw >= 9) & (raw <= 13)))
    chars = len(text) - int(spaces)
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in data.split(b"\n") if x.split(None, 1)]
    repeated = 0
    if n > 3:
        ids = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
        window = (ids[:-2] * np.uint64(0x9E3779B97F4A7C15) + ids[1:-1]) * np.uint64(0xC2B2AE3D27D4EB4F) + ids[2:]
        order = np.argsort(window)
        ranked = window[order]
        same = ranked[1:] == ranked[:-1]
        twice = np.zeros(n - 2, bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        covered = np.zeros(n, bool)
        for i in range(3):
            covered[i : n - 2 + i] |= twice
        repeated = int(covered.sum())
    return n, chars, symbols, len(lines) - len(set(lines)), repeated, len(lines)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([count_text(t or "") for t in batch["_text"].to_pylist()], np.int64).reshape(-1, 6)
        names = [x for x in batch.schema.names if x != "_text"]
        yield pa.RecordBatch.from_arrays([*(batch[x] for x in names), *(pa.array(c) for c in found.T.copy())], [*names, *COUNTS, "n_lines"])


def fitted_prior(hosts: int, docs: float, failed: float, squares: float, spread: float) -> tuple[float, float]:
    """Mean of the hosts' shares, and the documents that the beta prior weighs.

    squares: sum of n^2; spread: sum of f^2 / n, for hosts of n documents with f
    failures. The weight is 1 / g - 1, where g is the part of the variance that
    the hosts' differences make, as moments weighted by n have it.
    """
    if not docs:
        return 0.0, 1.0
    mean = failed / docs
    chance, room = mean * (1 - mean) * (hosts - 1), mean * (1 - mean) * (docs - squares / docs - (hosts - 1))
    if hosts < 2 or room <= 0:
        return mean, 1.0
    part = (spread - failed * failed / docs - chance) / room
    return mean, MOST_WEIGHT if part <= 0 else min(max(1 / part - 1, 1.0), MOST_WEIGHT)


def host_verdicts(counted: DataFrame, times: float = TIMES, sure: float = SURE) -> DataFrame:
    """(host, n_docs, n_failed, share, host_failed): a row for each host."""
    hosts = counted.groupBy("host").agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("failed").cast("long")).alias("n_failed"))
    n, f = F.col("n_docs").cast("double"), F.col("n_failed").cast("double")
    sums = hosts.agg(F.count(F.lit(1)), F.sum(n), F.sum(f), F.sum(n * n), F.sum(f * f / n)).first()  # five numbers
    mean, weight = fitted_prior(*(x or 0 for x in sums))
    share = (f + mean * weight) / (n + weight)
    least = share - sure * F.sqrt(share * (1 - share) / (n + weight + 1))
    return hosts.select("host", "n_docs", "n_failed", share.alias("share"), (least > min(times * mean, (1 + mean) / 2)).alias("host_failed"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", times: float = TIMES, sure: float = SURE, with_rows: bool = True) -> DataFrame:
    """Returns ``row`` (the input row, if ``with_rows``), ``doc_id``, the counts, ``base_failed``, ``soft_failed``, ``host_failed`` and ``kept``."""
    asked = docs.select(*[F.struct("*").alias("row")] * with_rows, F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), F.col(text_col).alias("_text"))
    schema = asked.drop("_text").schema
    for name in (*COUNTS, "n_lines"):
        schema = schema.add(name, "long")
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    length = F.col("word_chars") / F.greatest("n_words", F.lit(1))
    soft = (F.col("n_symbols") > MOST_SYMBOLS_PER_WORD * F.col("n_words")) | (F.col("n_dup_lines") > MOST_REPEATED_LINES * F.col("n_lines")) | ~length.between(*MEAN_WORD_CHARS)
    counted = keep(asked.mapInArrow(_count, schema).withColumn("base_failed", base).withColumn("soft_failed", soft).withColumn("failed", base | soft), "quality-counts")
    verdicts = host_verdicts(counted, times, sure).select(F.col("host").alias("v_host"), "share", "host_failed")
    met = counted.join(verdicts, F.col("host").eqNullSafe(F.col("v_host")))
    return met.withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed")).select(*["row"] * with_rows, "doc_id", *COUNTS, "base_failed", "kept", "soft_failed", "host_failed", F.col("share").alias("host_share"))


def op6_quality_rules(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), with_rows=False).drop("host_share")


#: DuckDB. The shrunk shares of the hosts come from the same sums.
ORACLE = """
WITH w AS (
  SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS t FROM w, LATERAL (SELECT unnest(range(1, len(ws) - 1)) AS i) x),
q AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, t) AS n FROM p),
r AS (SELECT doc_id, count(DISTINCT j) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM q WHERE n > 1) GROUP BY doc_id),
l AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
c AS (
  SELECT w.doc_id, source, len(ws) AS n_words, CAST(length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines
  FROM w LEFT JOIN l USING (doc_id) LEFT JOIN r USING (doc_id)),
f AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    n_symbols > 0.5 * n_words OR n_dup_lines > 0.3 * n_lines OR word_chars / greatest(n_words, 1) NOT BETWEEN 2 AND 15 AS soft_failed FROM c),
h AS (SELECT source, count(*) AS n, count(*) FILTER (base_failed OR soft_failed) AS k FROM f GROUP BY source),
m AS (SELECT count(*) AS h, CAST(sum(n) AS DOUBLE) AS w, CAST(sum(k) AS DOUBLE) AS f, sum(CAST(n AS DOUBLE) * n) AS nn, sum(CAST(k AS DOUBLE) * k / n) AS kk FROM h),
g AS (SELECT h, w, f / w AS m, (kk - f * f / w - f / w * (1 - f / w) * (h - 1)) AS over_chance, f / w * (1 - f / w) * (w - nn / w - (h - 1)) AS room FROM m),
s AS (SELECT m, CASE WHEN h < 2 OR room <= 0 THEN 1 WHEN over_chance <= 0 THEN 1e6 ELSE least(greatest(room / over_chance - 1, 1), 1e6) END AS s FROM g),
t AS (SELECT source, n, m, s, (k + m * s) / (n + s) AS share FROM h, s),
b AS (SELECT source, share - 2 * sqrt(share * (1 - share) / (n + s + 1)) > least(2 * m, (1 + m) / 2) AS host_failed FROM t)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT host_failed AS kept, soft_failed, host_failed
FROM f JOIN b ON f.source IS NOT DISTINCT FROM b.source
"""
