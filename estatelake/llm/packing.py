"""Best-fit-decreasing packing of documents into token sequences.

Best fit decreasing looks at lengths alone, and there are at most ``capacity``
of them. So the whole table is packed exactly, as one list sorted by length: the
driver gets the count of pieces of each length (capacity rows) and places runs
of equal pieces. A segment tree over remaining capacities holds how many open
sequences there are of each; the tightest that fits is found in log2(capacity)
steps. The outcome is a plan of runs (length, ranks) -> (sequences, place), its
size set by the number of lengths, not by the number of documents. Each piece
then finds its place from its rank within its length; ranks are counted in
salted parts, as a third of all pieces may have one length.

Text is cut into words at white space, where byte-level BPE always cuts too, and
each distinct word is encoded once in a task's cache, which is emptied at a size.
A text that holds a token that the file adds to the vocabulary, such as an end
marker, goes to ``tokenizers`` as a whole.

Cases: null or empty text is the closing id alone; repeated rows are packed each
for itself; a null doc_id stays null, and such rows are dealt over all tasks; an
empty table gives no rows; only doc_id and text are read, so other columns can't
clash.
"""

from __future__ import annotations

import functools
import json
import os
import re
import struct
import zlib
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelake.llm.common import id_key, keep, ranked, table

CAPACITY = 2048
CLOSING_ID = 0
#: Pieces of one length that a task ranks, about; at least LEAST_SALTS parts.
RANKED_ROWS, LEAST_SALTS = 1 << 18, 64
_CACHE_WORDS = 150_000
#: White space that the tokenizer knows and the cut below does not: such texts are encoded whole.
_OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
#: The usual word pattern of byte-level BPE.
_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_WORD = re.compile(r"[ \t\n\r\f\v]*[^ \t\n\r\f\v]+|[ \t\n\r\f\v]+")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _slow(path: str) -> Callable[[str], list[int]]:
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(path)
    return lambda text: slow.encode(text, add_special_tokens=False).ids


def _word_encoder(path: str, stored: dict) -> Callable[[str], list[int]]:
    """The tokenizer of a ``tokenizers`` file; where its ids are its merge ranks, the same ids from a quicker library."""
    vocab, merges, before = stored["model"]["vocab"], stored["model"].get("merges") or [], stored["pre_tokenizer"] or {}
    merged = [vocab["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in merges]
    usual = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") and not stored["normalizer"]
    if usual and merged == [*range(256, 256 + len(merges))]:
        import tiktoken

        shown = {chr(b): b for b in [*range(33, 127), *range(161, 173), *range(174, 256)]}  # how byte-level files write bytes
        shown |= {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(shown.values())))}
        ranks = {bytes(shown[c] for c in word): i for word, i in vocab.items() if i < 256 + len(merges)}
        return tiktoken.Encoding(path, pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    return _slow(path)


class _Words(dict):
    """word -> its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, to_ids: Callable[[str], list[int]]):
        self.to_ids = to_ids

    def __missing__(self, word: str) -> bytes:
        ids = self.to_ids(word)
        out = struct.pack(f"<{len(ids)}I", *ids)
        if len(word) < 100:
            self[word] = out
        return out


@functools.cache
def encoder(path: str) -> Callable[[str], bytes]:
    """text -> its ids as little-endian unsigned 32-bit integers; the words are kept for a worker's later tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    with open(path, encoding="utf-8") as file:
        stored = json.load(file)
    words = _Words(_word_encoder(path, stored))
    added = "|".join(re.escape(x["content"]) for x in stored.get("added_tokens") or [])
    holds_added = re.compile(added).search if added else lambda text: None
    whole = functools.cache(lambda: _slow(path))

    def encode(text: str) -> bytes:
        if len(words) > _CACHE_WORDS:
            words.clear()
        if holds_added(text):
            return struct.pack(f"<{len(ids := whole()(text))}I", *ids)
        if _OTHER_SPACE.search(text):
            return struct.pack(f"<{len(ids := words.to_ids(text))}I", *ids)
        return b"".join(map(words.__getitem__, _WORD.findall(text)))

    return encode


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _pieces(path: str | None, capacity: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path or tokenizer_path())
        closing = np.array([CLOSING_ID], "<u4").tobytes()
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                part = batch.slice(begin, 500)
                rows: tuple[list, ...] = ([], [], [], [], [], [])
                for doc, text in zip(part["doc_id"].to_pylist(), part["text"].to_pylist(), strict=True):
                    ids = encode(text or "") + closing
                    n = len(ids) // 4
                    first = n % capacity or capacity
                    for i, start in enumerate([0, *range(first, n, capacity)]):
                        own = ids[4 * start : 4 * (start + (capacity if i else first))]
                        for to, x in zip(rows, (doc, i, start, len(own) // 4, zlib.crc32(own), own), strict=True):
                            to.append(x)
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][: 5 + with_ids]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(rows, kinds, strict=False)], ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + with_ids])

    return run


class OpenSequences:
    """A segment tree over remaining capacities; each leaf holds the sequences with that much left, as runs of numbers."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.runs: list[deque] = [deque() for _ in range(capacity + 1)]

    def _add(self, left: int, n: int) -> None:
        at = left + self.leaves
        while at:
            self.count[at] += n
            at >>= 1

    def put(self, left: int, first: int, n: int) -> None:
        if left and n:
            self.runs[left].append((first, n))
            self._add(left, n)

    def take(self, left: int, most: int) -> tuple[int, int]:
        """Up to ``most`` sequences that follow each other, of those with ``left``."""
        first, n = self.runs[left].popleft()
        if n > most:
            self.runs[left].appendleft((first + most, n - most))
            n = most
        self._add(left, -n)
        return first, n

    def tightest(self, length: int) -> int | None:
        """The smallest remaining capacity of at least ``length`` that an open sequence has."""
        at = length + self.leaves
        if self.count[at]:
            return length
        while at > 1:
            if not at & 1 and self.count[at + 1]:
                at += 1
                break
            at >>= 1
        else:
            return None
        while at < self.leaves:
            at = 2 * at if self.count[2 * at] else 2 * at + 1
        return at - self.leaves


def plan(lengths: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Runs (length, first rank, first sequence, place, pieces in each sequence), by length and rank.

    In a run, rank r of the length (from 0) goes to sequence
    first + (r - first rank) // each, at place + (r - first rank) % each * length.
    """
    tree, runs, new = OpenSequences(capacity), [], 0
    for length in sorted(lengths, reverse=True):
        rank, todo = 0, lengths[length]
        while todo:
            left = tree.tightest(length)
            each = (capacity if left is None else left) // length  # the one just filled stays the tightest
            full, rest = divmod(todo, each)
            need = full + (rest > 0)
            if left is None:
                left, first, n, new = capacity, new, need, new + need
            else:
                first, n = tree.take(left, need)
            done = min(todo, n * each)
            runs.append((length, rank, first, capacity - left, each))
            tree.put(left - each * length, first, done // each)
            if done % each:
                tree.put(left - done % each * length, first + n - 1, 1)
            rank, todo = rank + done, todo - done
    return np.array(sorted(runs), np.int64).reshape(-1, 5)


def _place(runs, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, first_rank, first, place, each = runs.value.T
        keys = length * (1 << 50) + first_rank
        for batch in batches:
            own, rank = batch["length"].to_numpy(), batch["rank"].to_numpy() - 1
            at = np.searchsorted(keys, own * (1 << 50) + rank, "right") - 1
            nth = rank - first_rank[at]
            out = {"sequence_id": pa.array(first[at] + nth // each[at]), "offset": pa.array(place[at] + nth % each[at] * own)}
            names = [x for x in batch.schema.names if x != "rank"]
            yield pa.RecordBatch.from_arrays([*(batch[x] for x in names), *out.values()], [*names, *out])

    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """A row for each piece: doc_id, piece, start, length, ids_crc32, (ids,) sequence_id, offset."""
    spark = docs.sparkSession
    kind = PIECES + ", ids binary" * with_ids
    pieces = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_pieces(tokenizer, capacity, with_ids), kind)
    # Rows without an id may be many: a written random number deals them.
    pieces = keep(pieces.withColumn("deal", F.when(F.col("doc_id").isNull(), F.rand()).otherwise(0.0)), "pieces")
    lengths = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # capacity rows at most
    runs = spark.sparkContext.broadcast(plan(lengths, capacity))
    salts = max(LEAST_SALTS, -(-max(lengths.values(), default=0) // RANKED_ROWS))
    placed = ranked(pieces.withColumn("key", id_key("doc_id")), ["length"], ["key", "piece", "ids_crc32", "deal"], F.xxhash64("key", "deal"), salts, "rank").drop("key", "deal")
    return placed.mapInArrow(_place(runs, capacity), kind + ", sequence_id long, offset long")


def op3_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
