"""Repeated passages by content-defined chunking.

A gear rolling hash over the last bytes cuts each text where the hash hits a
target, so that equal passages are cut alike wherever they stand; an insertion
moves the cuts next to it alone. Each chunk has a 64-bit digest. What is looked
up is the digest of SPAN chunks in a row, about 60 bytes, which don't meet by
chance as single short chunks do. A maximal run of chunks that lie in looked-up
spans that another document holds too is a repeated passage, unless it is surely
shorter than MIN_WORDS words: what the documents share goes beyond the run by
less than the distance to the next cut by hash, and REACH more on the left, where
the hash still sees what stands before. So a passage of MIN_WORDS words is found
if it holds SPAN chunks, however long its words are, and what is found falls short
of MIN_WORDS by the words next to its ends at most.

1. One pass over the texts packs a batch of documents into a row: cuts, words
   and digests of their chunks.
2. Each batch sends its distinct digests, with the first document that holds
   each and whether there are more, to shards by digest. A passage that a third
   of all documents hold is sent once by each batch.
3. A shard sorts its digests and answers each batch: for the digests that two
   documents or more hold, the smallest id among these.
4. The answers meet their batch, which turns them into passages.

Texts go to no shuffle; batches and shards have bounded sizes.

Cases: null and empty texts have no passages; a null id is the largest and
comes back null; rows with the same id are one document, so they aren't
repeats of each other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelake.llm.common import NULL_ID, id_key, keep, table
from estatelake.llm.sharded import sharded_lookup
from estatelake.llm.textwords import piece_hashes, prefix_sums, word_bounds

#: A cut falls behind about one byte in 256 / CUT; it depends on the last 12 bytes.
CUT = 13
#: Longer stretches without a cut are cut where their hash is smallest.
MOST_BYTES = 64
SPAN = 3
MIN_WORDS = 51
#: Bytes that a cut's hash depends on.
REACH = 16
#: Marks, among the lengths of chunks (MOST_BYTES at most), an end that the hash has set, and one inside a word.
NATURAL, INSIDE = 1 << 15, 1 << 14
#: Beside a chunk's number of words, that of words which begin in the last REACH bytes before its end.
LATE = 1 << 8
#: Texts of a batch, in bytes; digests of a shard.
BATCH_BYTES = 8 << 20
SHARD_DIGESTS = 2_000_000
_GEAR = np.random.Generator(np.random.PCG64(99)).integers(0, 1 << 32, 256, np.uint32)


def gear(raw: np.ndarray) -> np.ndarray:
    """h[i] = sum of gear values of the bytes up to i, each shifted by its distance; doubled up, so without a loop over bytes."""
    h = _GEAR[raw]
    for d in (1, 2, 4, 8):
        moved = h.copy()
        moved[d:] += h[:-d] << np.uint32(d) if d < len(h) else 0
        h = moved
    return h


def chunk_ends(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the chunks of a text, and whether the hash has set them (or the text's end); no chunk is longer than MOST_BYTES.

    A longer stretch without a cut, such as one word over and over, is cut where
    its hash is smallest, at all such places: that too depends on content alone.
    """
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, bool)
    h = gear(raw)
    cuts = natural = np.unique(np.append(np.flatnonzero(((h >> np.uint32(4)) & np.uint32(255)) < CUT) + 1, len(raw)))
    h = h & np.uint32(0xFFFF)  # of the last 16 bytes
    while (long := np.flatnonzero(np.diff(cuts, prepend=0) > MOST_BYTES)).size:
        new = [cuts]
        for i in long.tolist():
            begin, end = (int(cuts[i - 1]) if i else 0), int(cuts[i])
            inner = h[begin : end - 1]
            new.append(np.flatnonzero(inner == inner.min()) + begin + 1)
        cuts = np.unique(np.concatenate(new))
    return cuts, np.isin(cuts, natural, assume_unique=True)


def chunked(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ends in bytes; lengths in code points with their marks; words that begin in each chunk, with LATE; digests of SPAN chunks from each."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    ends, natural = chunk_ends(raw)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[ends]
    begins, stops = word_bounds(raw)
    before = np.searchsorted(begins, ends)  # words that begin before each end
    late = before - np.searchsorted(begins, ends - REACH)
    inside = before > np.searchsorted(stops, ends, "right")
    marked = np.diff(points, prepend=0) + natural * NATURAL + inside * INSIDE
    n = len(ends) - SPAN + 1
    digests = piece_hashes(prefix_sums(raw), starts[:n], ends[SPAN - 1 :]) if n > 0 else np.zeros(0, np.uint64)
    return ends, marked, np.diff(before, prepend=0) + late * LATE, digests


CHUNKS = "batch long, n long, ids binary, chunks binary, counts binary, points binary, words binary, digests binary"


def _chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rng = np.random.default_rng()
    ids, chunks, points, words, digests, size = [], [], [], [], [], 0

    def packed() -> pa.RecordBatch:
        joined = lambda parts, kind: np.concatenate(parts).astype(kind).tobytes()
        return pa.RecordBatch.from_pydict({"batch": [int(rng.integers(1 << 62))], "n": [sum(map(len, digests))], "ids": [np.array(ids, np.int64).tobytes()], "chunks": [np.array(chunks, np.int64).tobytes()], "counts": [np.array([*map(len, digests)], np.int64).tobytes()], "points": [joined(points, np.uint16)], "words": [joined(words, np.uint16)], "digests": [joined(digests, np.uint64)]}, schema=_CHUNK_SCHEMA)

    for batch in batches:
        for i, text in zip(batch["id"].to_pylist(), batch["text"].to_pylist(), strict=True):
            if not text:
                continue
            _, p, w, d = chunked(text)
            ids.append(i)
            chunks.append(len(p))
            points.append(p)
            words.append(w)
            digests.append(d)
            size += len(text)
            if size >= BATCH_BYTES:
                yield packed()
                ids, chunks, points, words, digests, size = [], [], [], [], [], 0
    if ids:
        yield packed()


_CHUNK_SCHEMA = pa.schema([("batch", pa.int64()), ("n", pa.int64()), *((x, pa.binary()) for x in ("ids", "chunks", "counts", "points", "words", "digests"))])


PASSAGE = "doc_id long, start long, end long, n_words long, first_doc_id long, dropped boolean"


def _passages(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A batch's row of chunks with all its answers."""
        for batch in batches:
            for row in batch.to_pylist():
                told = [np.concatenate([np.frombuffer(x or b"", kind) for x in row[c] or [b""]]) for c, kind in (("answers", np.uint64), ("firsts", np.int64))]
                order = np.argsort(told[0])
                known, firsts = told[0][order], told[1][order]
                digests = np.frombuffer(row["digests"], np.uint64)
                at = np.searchsorted(known, digests)
                at[at == len(known)] = 0
                hit = known[at] == digests if len(known) else np.zeros(len(digests), bool)
                first = np.where(hit, firsts[at], NULL_ID) if len(known) else np.full(len(digests), NULL_ID)
                out: list[tuple] = []
                c = d = 0
                points, words = np.frombuffer(row["points"], np.uint16), np.frombuffer(row["words"], np.uint16)
                for i, n in zip(np.frombuffer(row["ids"], np.int64).tolist(), np.frombuffer(row["chunks"], np.int64).tolist(), strict=True):
                    m = max(0, n - SPAN + 1)
                    if m and (own := hit[d : d + m]).any():
                        out += found(i, own, first[d : d + m], points[c : c + n], words[c : c + n].astype(np.int64))
                    c, d = c + n, d + m
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True) if out else [[]] * 6, kinds, strict=True)], [x.split()[0] for x in PASSAGE.split(", ")])

    def found(doc: int, hit: np.ndarray, first: np.ndarray, marked: np.ndarray, words: np.ndarray) -> Iterator[tuple]:
        points = np.concatenate([[0], np.cumsum(marked & (INSIDE - 1), dtype=np.int64)])
        words, late = words & (LATE - 1), words // LATE
        inside = np.zeros(len(words) + 2, np.int8)
        for s in range(SPAN):
            inside[1 + s : 1 + s + len(hit)] |= hit
        step = np.diff(inside)
        for begin, end in zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist(), strict=True):
            n = int(words[begin:end].sum())
            if n >= min_words or n + beyond(begin, end, marked, words, late) >= min_words:
                own = first[begin : end - SPAN + 1]
                holder = int(own[hit[begin : end - SPAN + 1]].min())
                yield (None if doc == NULL_ID else doc, int(points[begin]), int(points[end]), n, None if holder == NULL_ID else holder, holder != doc)

    def beyond(begin: int, end: int, marked: np.ndarray, words: np.ndarray, late: np.ndarray) -> int:
        """Words next to a run's ends that its passage may hold: to the next cut by hash on both sides, and REACH on the left."""
        n = 0
        for right in range(end, len(words)):
            n += int(words[right])
            if marked[right] & NATURAL:
                n -= bool(marked[right] & INSIDE)  # the word that the cut divides isn't whole
                break
        for left in range(begin - 1, -1, -1):
            n += int(words[left])
            if left and marked[left - 1] & NATURAL:
                n += int(late[left - 1])
                break
        return n

    return run


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, shard_digests: int = SHARD_DIGESTS) -> DataFrame:
    """A row for each repeated passage: doc_id, start and end (code points), n_words, first_doc_id (the smallest id that holds a part of it) and dropped (false in that document)."""
    chunks = keep(docs.select(id_key(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(_chunk, CHUNKS), "chunks")
    answers = sharded_lookup(chunks, chunks.agg(F.sum("n")).first()[0] or 0, shard_digests)
    met = chunks.join(answers, "batch", "left").select("ids", "chunks", "points", "words", "digests", F.col("told.digests").alias("answers"), F.col("told.firsts").alias("firsts"))
    return met.mapInArrow(_passages(min_words), PASSAGE)


def op9_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))
