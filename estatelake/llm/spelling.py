"""Spelling variants of words that differ by one letter.

Words are maximal runs of [A-Za-z\\u00C0-\\u00FF], A-Z lower-cased, some with a
letter deleted by the contract's rule; those of at least LEAST_CHARS letters that
occur twice or more overall count. Two words are near if one inserted, deleted
or replaced letter makes them equal. A word's form is its most frequent near word,
if that is at least TIMES as frequent; its root is where forms lead.

Counting: tasks count the words of their texts and send sums.

Near words: a word is a vector of the numbers of its letters. One edit moves it by
a squared distance of 1 (inserted, deleted) or 2 (replaced). Squared distances
come from products of whole blocks, |a|^2 + |b|^2 - 2ab, in NumPy. Blocks hold
words of one length and one number of letters in each of CLASSES classes of
letters: an edit changes the length by one at most, and moves at most one letter
between classes, so a block meets itself and a few neighbours of the same and of
the next length. Blocks of more than ``block_words`` words are dealt into parts,
whose pairs are rows of their own. Of pairs at a distance of 2 at most, the edit
is verified on the words themselves. A task returns one row for each word: how
many near words it met, and the most frequent one.

Roots: forms are at least TIMES as frequent, so chains are short; each round
doubles what is followed.

Cases: null and empty texts have no words; a null id counts as the empty string in
the rule that deletes letters; repeated rows count each; ties of frequency go to
the smaller word in code-point order; an empty table, or no word twice, gives no
rows; only id and text are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelake.llm.common import keep, table

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LEAST_CHARS, LEAST_COUNT, TIMES = 7, 2, 10
#: One run in so many loses a letter.
DELETED = 31
#: Letters are a-z and U+00C0..U+00FF: columns of a block.
LETTERS = 26 + 64
CLASSES = 4
#: Of a part of a block, about: words, and letters in all.
BLOCK_WORDS, BLOCK_CHARS = 2048, 4 << 20
#: Different words that a task holds before it sends their counts.
COUNTED_WORDS = 1 << 20


# --- counting ---------------------------------------------------------------


def words_of(doc_id: int | None, text: str | None) -> Iterator[tuple[str, int]]:
    """A document's words and how often each run gives one; short ones included."""
    if not text:
        return
    # The bytes' lower() knows A-Z alone.
    runs = Counter(RUN.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")))
    start = crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in runs.items():
        h = crc32(run.encode(), start)
        if h % DELETED == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        yield run, n


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def sums() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

    for batch in batches:
        for doc_id, text in zip(batch["id"].to_pylist(), batch["text"].to_pylist(), strict=True):
            for word, n in words_of(doc_id, text):
                if len(word) >= LEAST_CHARS:
                    counts[word] += n
            if len(counts) > COUNTED_WORDS:
                yield sums()
                counts.clear()
    yield sums()


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of the words that count."""
    counted = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(_count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


# --- blocks -----------------------------------------------------------------


def letter_class(c: int) -> F.Column:
    """How many letters of a word are in one of the classes: every CLASSES-th letter is."""
    letters = "".join(chr(x) for i, x in enumerate([*range(97, 123), *range(0xC0, 0x100)]) if i % (CLASSES + 1) == c)
    return F.length("word") - F.length(F.regexp_replace("word", f"[{letters}]", ""))


def _steps() -> list[tuple[int, ...]]:
    """Differences of (length, classes...) between a word and the near words that it visits; the others visit it."""
    unit = [tuple(int(i == c) for i in range(CLASSES)) for c in range(CLASSES)] + [(0,) * CLASSES]  # the last: letters of no class
    longer = [(1, *u) for u in unit]
    moved = {tuple(x - y for x, y in zip(u, v, strict=True)) for u in unit for v in unit}
    return [*longer, *((0, *m) for m in sorted(moved) if m >= (0,) * CLASSES)]


def _key(of: str, step: tuple[int, ...] = (0,) * (CLASSES + 1)) -> F.Column:
    return F.struct((F.col(of)["len"] + step[0]).alias("len"), *[(F.col(of)[f"c{i}"] + step[i + 1]).alias(f"c{i}") for i in range(CLASSES)])


def letters(words: str, n: int) -> np.ndarray:
    """The letters of n words of one length, joined by spaces: a row for each word; all are below 256."""
    return np.frombuffer((words + " ").encode("latin-1"), np.uint8).reshape(n, -1)[:, :-1]


def letter_counts(codes: np.ndarray) -> np.ndarray:
    """A row of letter counts for each word; products of rows of short words are exact in single precision."""
    n, size = codes.shape
    column = np.where(codes < 128, codes - 97, codes - 0xC0 + 26).astype(np.int64) + LETTERS * np.arange(n)[:, None]
    return np.bincount(column.ravel(), minlength=n * LETTERS).reshape(n, LETTERS).astype(np.float32 if size < 2000 else np.float64)


def close_pairs(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of rows at a squared distance of two at most: 2ab - |a|^2 - |b|^2 comes from one product."""
    both = x.any(axis=0) & y.any(axis=0)
    own, other = ((v * v).sum(axis=1, keepdims=True) for v in (x, y))
    one = lambda v: np.ones((len(v), 1), v.dtype)
    near = np.hstack([2 * x[:, both], own, one(x)]) @ np.hstack([y[:, both], -one(y), -other]).T
    return np.divmod(np.flatnonzero(near > -2.5), len(y))


def one_edit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Do rows of letters differ by exactly one inserted, deleted or replaced letter? Rows of y are as long as those of x, or one longer."""
    size = x.shape[1]
    if y.shape[1] == size:
        return (x != y).sum(axis=1) == 1
    head, tail = x != y[:, :size], x != y[:, 1:]
    same_head = np.where(head.any(axis=1), head.argmax(axis=1), size)
    same_tail = np.where(tail.any(axis=1), tail[:, ::-1].argmax(axis=1), size)
    return same_head + same_tail >= size


def near_pairs(x: np.ndarray, y: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of near words in the letters of two blocks, each of words of one length; ``same``: one block, each pair once."""
    if x.shape[1] > y.shape[1]:
        return near_pairs(y, x, same)[::-1]
    i, j = close_pairs(letter_counts(x), letter_counts(y))
    if same:
        i, j = i[i < j], j[i < j]
    good = one_edit(x[i], y[j])
    return i[good], j[good]


def _best(word, counts: np.ndarray, at: np.ndarray, near: np.ndarray) -> tuple[list, ...]:
    """(word, near words met, the most frequent, its count) of each word in ``at``; ``at`` and ``near`` are places of words and counts."""
    met, place = np.unique(near, return_inverse=True)
    spelt = [word(k) for k in met.tolist()]
    rank = np.empty(len(met), np.int64)
    rank[sorted(range(len(met)), key=spelt.__getitem__)] = np.arange(len(met))
    order = np.lexsort((rank[place], -counts[near], at))
    at, place = at[order], place[order]
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    n_near = np.diff(np.append(first, len(at)))
    return [word(k) for k in at[first].tolist()], n_near.tolist(), [spelt[k] for k in place[first].tolist()], counts[met[place[first]]].tolist()


def _lists(column: pa.ListArray) -> list[np.ndarray]:
    values, ends = column.flatten().to_numpy(), np.cumsum(column.value_lengths().to_numpy())
    return np.split(values, ends[:-1])


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of two blocks, or of one (``same``)."""
    for batch in batches:
        out: tuple[list, ...] = ([], [], [], [])
        texts = (batch[c].to_pylist() for c in ("homes", "guests", "same"))
        for homes, guests, same, home_n, guest_n in zip(*texts, _lists(batch["home_n"]), _lists(batch["guest_n"]), strict=True):
            x, y, n = letters(homes, len(home_n)), letters(guests, len(guest_n)), len(home_n)
            i, j = near_pairs(x, y, same)
            if not len(i):
                continue

            def word(k: int, homes=homes, guests=guests, n=n, own=x.shape[1], other=y.shape[1]) -> str:
                return homes[k * (own + 1) : k * (own + 1) + own] if k < n else guests[(k - n) * (other + 1) : (k - n) * (other + 1) + other]

            j = j if same else j + n
            best = _best(word, np.concatenate([home_n, guest_n]), np.concatenate([i, j]), np.concatenate([j, i]))
            for to, found in zip(out, best, strict=True):
                to.extend(found)
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.string(), pa.int64(), pa.string(), pa.int64()), strict=True)], ["word", "n_near", "best", "best_n"])


def near_words(words: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``words``: (word, n). Returns (word, n_near, best, best_n) of the words that have near words."""
    keyed = words.select("word", "n", F.struct(F.length("word").alias("len"), *[letter_class(c).alias(f"c{c}") for c in range(CLASSES)]).alias("own"))
    parts = F.ceil(F.count(F.lit(1)) * F.greatest(F.lit(1 / block_words), F.col("own.len") / BLOCK_CHARS)).cast("int")
    sizes = keep(keyed.groupBy("own").agg(parts.alias("parts")), "spelling-sizes")
    dealt = keyed.join(sizes, "own").withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    blocks = dealt.groupBy("own", "part").agg(F.collect_list(F.struct("word", "n")).alias("w"))
    blocks = keep(blocks.select("own", "part", F.array_join("w.word", " ").alias("words"), F.col("w.n").alias("ns")), "spelling-blocks")
    # A block visits every part of the blocks that one edit leads to; of its own block, those parts that come no earlier.
    steps = F.array(*[F.struct(F.lit(not any(s)).alias("home"), _key("own", s).alias("to")) for s in _steps()])
    visits = blocks.select(F.col("own").alias("from"), "part", F.col("words").alias("guests"), F.col("ns").alias("guest_n"), F.inline(steps))
    visits = visits.join(sizes.withColumnRenamed("own", "to"), "to")
    visits = visits.select("home", F.col("part").alias("own_part"), "guests", "guest_n", F.col("to").alias("own"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    visits = visits.filter(~F.col("home") | (F.col("part") >= F.col("own_part")))
    same = F.col("home") & (F.col("part") == F.col("own_part"))
    pairs = visits.join(blocks, ["own", "part"]).select(F.col("words").alias("homes"), F.col("ns").alias("home_n"), "guests", "guest_n", same.alias("same"))
    met = pairs.mapInArrow(_met, "word string, n_near long, best string, best_n long")
    first = F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("first")
    return met.groupBy("word").agg(F.sum("n_near").alias("n_near"), first).select("word", "n_near", F.col("first.best").alias("best"), (-F.col("first.less")).alias("best_n"))


def roots(forms: DataFrame) -> DataFrame:
    """``forms``: (word, form). Returns (word, root), where forms end."""
    known = keep(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = keep(known.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if not further.filter("moved").limit(1).count():
            return further.select("word", "root")
        known = further.select("word", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """(word, n, n_near, form, form_n, root): a row for each word."""
    words = keep(count_words(docs, id_col, text_col), "spelling-words")
    told = words.join(near_words(words, block_words), "word", "left")
    far = F.col("best_n") >= TIMES * F.col("n")
    told = keep(told.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(far, F.col("best")).alias("form"), F.when(far, F.col("best_n")).alias("form_n")), "spelling-forms")
    ends = roots(told.filter("form IS NOT NULL").select("word", "form"))
    return told.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op12_spelling_variants(spark, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))
