"""Line dedup by sharded minimal perfect hashes.

Lines that occur in two documents or more stay only in the document with the
smallest id. The hashes of such lines are dealt into shards; for each shard a
task builds a minimal perfect hash and three compact arrays behind it: a 64-bit
fingerprint, the number of holders, and the first holder. The documents' line
hashes stream through the arrays; lines are never joined with lines.

A shard's arrays are small (keys_per_shard bounds them) and are sent to as many
tasks as its probes need, so a line that a third of all documents hold is
probed by many tasks. What goes through a shuffle is hashes, and at the end the
documents once, to meet their lists of dropped lines.

Cases: null text is one empty line; a null id is the largest id; rows with the
same id are one document when lines are counted, and each gets its own result
(those without an id are dealt by their texts, as they may be many); an empty
table gives no rows; all columns of the input travel inside ``row``, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelake.llm.common import ASCII_SPACE, id_key, keep

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEVELS = 40
#: Shards whose salts (16 bytes each) are sent to all tasks.
MOST_BROADCAST = 1 << 20
#: Seeds of the two 64-bit hashes; the first is that of Spark's xxhash64.
SEED_1, SALT_2 = 42, 7


def line_key(line: F.Column) -> F.Column:
    """A line's key: ASCII space stripped at both ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(ASCII_SPACE)), UPPER, LOWER)


# --- the minimal perfect hash ---------------------------------------------


def _mix(x: np.ndarray, level: int) -> np.ndarray:
    x = x + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _key(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    return h1.view(np.uint64) * np.uint64(0xFF51AFD7ED558CCD) ^ h2.view(np.uint64)


class PerfectHash:
    """Levels of bit arrays: a key sits at the first level where no other key has its position.

    A key's slot is the number of bits set before its own, so n keys fill the
    slots 0..n-1. Keys that share all positions (the same 64-bit key, of
    different lines) have no slot; the shard keeps them aside.
    """

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        words = np.bitwise_count(bits)
        self.before = np.concatenate([[0], np.cumsum(words, dtype=np.int64)])
        self.starts = np.concatenate([[0], np.cumsum(sizes)])

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, parts, left = [], [], keys
        for level in range(LEVELS):
            if not len(left):
                break
            size = max(64, -(-2 * len(left) // 64) * 64)
            at = (_mix(left, level) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            parts.append(np.packbits(alone, bitorder="little").view(np.uint64))
            left = left[~alone[at]]
        return cls(np.array(sizes, np.int64), np.concatenate(parts) if parts else np.zeros(0, np.uint64))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 for keys that are surely no members."""
        out = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            if not len(todo):
                break
            at = (_mix(keys[todo], level) % np.uint64(size)).astype(np.int64) + self.starts[level]
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            hit = (self.bits[word] >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(self.bits[word[hit]] & ((np.uint64(1) << bit[hit]) - np.uint64(1)))
            out[todo[hit]] = self.before[word[hit]] + below
            todo = todo[~hit]
        return out


SHARD = "shard long, n_hits long, sizes binary, bits binary, prints binary, counts binary, firsts binary, aside binary"


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    h1, h2 = pdf["h1"].to_numpy(np.int64), pdf["h2"].to_numpy(np.int64)
    found = PerfectHash.build(keys := _key(h1, h2))
    slots = found.slots(keys)
    size = int(found.before[-1])
    prints, counts, firsts = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64)
    ok = slots >= 0
    prints[slots[ok]], counts[slots[ok]], firsts[slots[ok]] = h2[ok], pdf["n"].to_numpy(np.int64)[ok], pdf["first"].to_numpy(np.int64)[ok]
    aside = np.stack([h1[~ok], h2[~ok], pdf["n"].to_numpy(np.int64)[~ok], pdf["first"].to_numpy(np.int64)[~ok]])
    return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "n_hits": [int(pdf["n"].sum())], "sizes": [found.sizes.tobytes()], "bits": [found.bits.tobytes()], "prints": [prints.tobytes()], "counts": [counts.tobytes()], "firsts": [firsts.tobytes()], "aside": [aside.tobytes()]})


def _probe(min_docs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by (shard, salt, arrays first): each shard's arrays, then its probes."""
        index, prints, counts, firsts, aside = None, None, None, None, None
        for batch in batches:
            h1, h2, ids, deal = (batch[c].fill_null(0).to_numpy() for c in ("h1", "h2", "id", "deal"))
            arrays = np.flatnonzero(batch["bits"].is_valid().to_numpy(zero_copy_only=False))
            for begin, end in zip([0, *arrays], [*arrays, batch.num_rows], strict=True):
                if begin < end and begin in arrays:
                    row = batch.slice(begin, 1).to_pylist()[0]
                    index = PerfectHash(np.frombuffer(row["sizes"], np.int64), np.frombuffer(row["bits"], np.uint64))
                    prints, counts, firsts = (np.frombuffer(row[c], np.int64) for c in ("prints", "counts", "firsts"))
                    aside = np.frombuffer(row["aside"], np.int64).reshape(4, -1)
                    begin += 1
                if begin == end or index is None:  # no line of two documents in this shard
                    continue
                own = slice(begin, end)
                slot = index.slots(_key(h1[own], h2[own]))
                hit = slot >= 0
                at = slot[hit]
                hit[hit] = (prints[at] == h2[own][hit]) & (counts[at] >= min_docs) & (firsts[at] != ids[own][hit])
                for other1, other2, n, first in aside.T:
                    hit |= (h1[own] == other1) & (h2[own] == other2) & (n >= min_docs) & (ids[own] != first)
                yield pa.RecordBatch.from_arrays([pa.array(x[own][hit]) for x in (ids, deal, h1)], ["id", "deal", "h1"])

    return run


def _without(min_chars: int):
    lower = str.maketrans(UPPER, LOWER)

    @F.pandas_udf("n_dropped long, kept string")
    def without(text: pd.Series, drops: pd.Series) -> pd.DataFrame:
        """Texts without the lines whose key hashes are in ``drops``; null drops: nothing to do."""
        n, kept = [], []
        for t, d in zip(text, drops, strict=True):
            if d is None:
                n.append(0)
                kept.append(None)
                continue
            gone = {int(x) % 2**64 for x in d}
            lines = t.split("\n")
            keys = (x.strip(ASCII_SPACE).translate(lower) for x in lines)
            stay = [x for x, k in zip(lines, keys, strict=True) if len(k) < min_chars or xxhash.xxh64_intdigest(k.encode(), SEED_1) not in gone]
            n.append(len(lines) - len(stay))
            kept.append("\n".join(stay))
        return pd.DataFrame({"n_dropped": n, "kept": kept})

    return without


def _deal(id_col: str, text_col: str) -> F.Column:
    """Tells rows without an id apart; 0 for all others."""
    return F.when(F.col(id_col).isNull(), F.xxhash64(text_col)).otherwise(F.lit(0).cast("long")).alias("deal")


def line_postings(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(id, deal, h1, h2): a row for each document and distinct line key of at least ``min_chars`` code points."""
    lines = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)
    keys = F.array_distinct(F.filter(F.transform(lines, line_key), lambda k: F.length(k) >= min_chars))
    return docs.select(id_key(id_col).alias("id"), _deal(id_col, text_col), F.explode(keys).alias("k")).select("id", "deal", F.xxhash64("k").alias("h1"), F.xxhash64(F.lit(SALT_2), "k").alias("h2"))


def build_shards(postings: DataFrame, keys_per_shard: int) -> tuple[DataFrame, int]:
    """The arrays of each shard, over the keys that two documents or more hold, and the number of shards."""
    repeated = keep(postings.groupBy("h1", "h2").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count(F.lit(1)).alias("n")).filter("first < last").drop("last"), "line-keys")
    shards = max(1, -(-repeated.count() // keys_per_shard))
    built = repeated.withColumn("shard", F.pmod(F.col("h1"), F.lit(shards))).groupBy("shard").applyInPandas(_build, SHARD)
    return keep(built, "line-shards"), shards


def probe_shards(postings: DataFrame, arrays: DataFrame, shards: int, probes_per_task: int, min_docs: int = 2) -> DataFrame:
    """(id, deal, h1) of the lines to drop."""
    others = postings.count() // shards
    # Two numbers for each shard of keys_per_shard keys; sent to all tasks up to a size, else joined.
    salted = arrays.select("shard", (F.lit(1) + F.floor((F.col("n_hits") + others) / probes_per_task)).cast("long").alias("salts"))
    salted = F.broadcast(salted) if shards <= MOST_BROADCAST else salted
    asked = postings.withColumn("shard", F.pmod(F.col("h1"), F.lit(shards))).join(salted, "shard").withColumn("salt", F.pmod(F.xxhash64("id", "deal", "h2"), F.col("salts"))).drop("salts")
    held = arrays.join(salted, "shard").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))).drop("salts", "n_hits")
    stream = held.unionByName(asked, allowMissingColumns=True).repartition("shard", "salt").sortWithinPartitions("shard", "salt", F.col("bits").isNull())
    return stream.select("id", "deal", "h1", "h2", "sizes", "bits", "prints", "counts", "firsts", "aside").mapInArrow(_probe(min_docs), "id long, deal long, h1 long")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, keys_per_shard: int = 1 << 18, probes_per_task: int = 1 << 18, min_docs: int = 2) -> DataFrame:
    """Returns ``row`` (the input row), ``n_lines``, ``n_dropped`` and ``kept`` (the text that stays).

    Lines that fewer than ``min_docs`` documents hold stay everywhere; 2 at least.
    """
    postings = keep(line_postings(docs, id_col, text_col, min_chars), "line-postings")
    arrays, shards = build_shards(postings, keys_per_shard)
    drops = probe_shards(postings, arrays, shards, probes_per_task, min_docs).groupBy("id", "deal").agg(F.collect_set("h1").alias("drops"))
    met = docs.select(F.struct("*").alias("row"), id_key(id_col).alias("id"), _deal(id_col, text_col)).join(drops, ["id", "deal"], "left")
    text = F.coalesce(F.col("row")[text_col], F.lit(""))
    cleaned = met.withColumn("done", _without(min_chars)(F.when(F.col("drops").isNotNull(), text), F.col("drops")))
    return cleaned.select("row", (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"), F.coalesce("done.n_dropped", F.lit(0)).cast("long").alias("n_dropped"), F.coalesce("done.kept", text).alias("kept"))


def op1_line_dedup(spark, sf_dir: str) -> DataFrame:
    from estatelake.llm.common import table

    out = dedup_lines(table(spark, sf_dir, "documents"))
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


#: DuckDB. chr(9..13) and the space are stripped; lower() would also change other letters than A-Z.
ORACLE = """
WITH lines AS (
  SELECT doc_id, t.pos, t.line, translate(trim(t.line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents) d,
       LATERAL (SELECT unnest(d.ls) AS line, generate_subscripts(d.ls, 1) AS pos) t),
repeated AS (
  SELECT k, min(doc_id) AS first FROM lines WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (first IS NOT NULL AND first <> doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (first IS NULL OR first = doc_id), '')) AS kept_sha256
FROM lines LEFT JOIN repeated USING (k) GROUP BY doc_id
"""
