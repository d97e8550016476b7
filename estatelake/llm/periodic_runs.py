"""Runs of periodic words: where a text repeats itself at once.

A run is a stretch of consecutive words with smallest period q, at least
max(LEAST_WORDS, TIMES * q) long, that no neighbouring word extends. Dropping a
run's words after its first q leaves one copy of what it repeats.

Search: at scale k, blocks of B = 2**k words at multiples of B, less those with a
word that its text holds fewer than TIMES times. A run whose period
is in [B, 2B) is at least 4B long, so it holds a whole block whose copy, q words
further on, is in the run as well. For all blocks at once, the sums of squared
differences between a block and the window of 2B words that follows it, at every
distance in [B, 2B), come from one block convolution: two number-theoretic
transforms of length 2B modulo PRIME, and running sums of squares. Words are
residues, so a block's copy has sum 0 exactly; a sum that is 0 by chance is seen
to be none when it is extended. Distances of sum 0 are seeds. A seed goes if the
words that it spans have a smaller period that divides its own, as in a run known
from smaller scales, or if they go on
for less than a period more at both ends; the others are extended to both sides,
by halving over hashes of stretches, and held word for word against the text.

Texts are handled in groups of about GROUP_WORDS words, the words of each text
with numbers of their own, so that nothing matches across texts; a longer text is
a group. The work for n words grows with n * log(n)**2, whatever they repeat.

Cases: null, empty and wordless texts have n = 0, no runs, four nulls and the
hashes of the empty string; a null id has no hash, so its text stays as it is;
repeated rows count each for itself; an empty table gives no rows; extra columns
travel along where ``find_runs`` is asked to keep them.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelake.llm.common import table
from estatelake.llm.textwords import mix, powers

LEAST_WORDS, TIMES = 6, 4
GROUP_WORDS = 1 << 17
#: Words of the blocks that are transformed at once, or a single block.
BLOCKED_WORDS = 1 << 15
#: A prime with roots of unity of order 2**27, and a generator of its residues.
PRIME, GENERATOR = 15 * 2**27 + 1, 31

RESULT = "n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


# --- convolution ------------------------------------------------------------


def _mod(x: np.ndarray) -> np.ndarray:
    """x modulo PRIME; a quotient by one number is quicker than a remainder."""
    return x - (x // np.uint64(PRIME)) * np.uint64(PRIME)


@functools.cache
def _roots(n: int, inverse: bool) -> np.ndarray:
    """Powers 0..n/2-1 of a root of unity of order n."""
    root = pow(GENERATOR, (PRIME - 1) // n, PRIME)
    if inverse:
        root = pow(root, -1, PRIME)
    out = np.ones(max(1, n // 2), np.uint64)
    done = 1
    while done < len(out):
        step = np.uint64(pow(root, done, PRIME))
        out[done : 2 * done] = _mod(out[:done] * step)[: len(out) - done]
        done *= 2
    return out


def transform(x: np.ndarray, inverse: bool = False) -> np.ndarray:
    """Number-theoretic transforms of the rows of x, whose length is a power of two; the inverse isn't divided by the length."""
    rows, n = x.shape
    span, step = n, 1
    while span > 1:
        half = span // 2
        x = x.reshape(rows, 2, half, step)
        out = np.empty((rows, half, 2, step), np.uint64)
        total = x[:, 0] + x[:, 1]
        np.minimum(total, total - np.uint64(PRIME), out=out[:, :, 0])  # below zero wraps round
        out[:, :, 1] = _mod((x[:, 0] + np.uint64(PRIME) - x[:, 1]) * _roots(span, inverse)[:, None])
        x, span, step = out, half, 2 * step
    return x.reshape(rows, n)


def block_matches(values: np.ndarray, size: int, able: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(block start, distance): where a block has no mismatch at a distance in [size, 2 * size).

    ``able``: numbers of the whole blocks to look at, in order. What follows the
    end of the values is 0, as no value is.
    """
    needed = np.unique(np.concatenate([able, able + 1, able + 2]))
    place = needed[:, None] * size + np.arange(size)
    rows = np.zeros((len(needed), 2 * size), np.uint64)
    rows[:, :size] = np.where(place < len(values), values[np.minimum(place, len(values) - 1)], 0)
    f = transform(rows)
    first, second, third = (np.searchsorted(needed, able + i) for i in range(3))
    turned = f[first][:, -np.arange(2 * size)]  # of the block in reverse
    sign = np.tile(np.array([False, True]), size)  # the window's second half is moved by half the length
    window = _mod(f[second] + np.where(sign, np.uint64(PRIME) - f[third], f[third]))
    products = transform(_mod(turned * window), inverse=True)[:, :size]
    products = _mod(products * np.uint64(pow(2 * size, -1, PRIME)))
    squares = np.zeros((len(needed), size + 1), np.uint64)
    np.cumsum(_mod(rows[:, :size] * rows[:, :size]), axis=1, out=squares[:, 1:])
    # The window at distance size + d: the second block from d on, and the third up to d.
    moved = squares[second][:, -1:] - squares[second][:, :-1] + squares[third][:, :-1]
    block, d = np.nonzero(_mod(squares[first][:, -1:] + moved + np.uint64(2 * PRIME) - 2 * products) == 0)
    return able[block] * size, d + size


# --- stretches of a text ----------------------------------------------------


class Stretches:
    """Hashes of stretches of a sequence of whole numbers."""

    def __init__(self, ids: np.ndarray):
        self.n = len(ids)
        up, self.down = powers(self.n)
        self.sums = np.zeros(self.n + 1, np.uint64)
        np.cumsum(mix(ids.astype(np.uint64) + np.uint64(1)) * up[: self.n], out=self.sums[1:])

    def equal(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Are the stretches at a and b alike? Those that leave the sequence are not."""
        fits = (np.minimum(a, b) >= 0) & (np.maximum(a, b) + length <= self.n)
        a, b, length = (np.where(fits, x, 0) for x in (a, b, length))
        one, two = ((self.sums[x + length] - self.sums[x]) * self.down[x] for x in (a, b))
        return fits & (one == two)

    def further(self, a: np.ndarray, b: np.ndarray, way: int) -> np.ndarray:
        """For how many places from a and b on (``way`` 1), or back from before them (-1), the sequence is alike."""
        known = np.zeros(len(a), np.int64)
        step = 1 << max(self.n, 1).bit_length()
        while step:
            length = np.full(len(a), step)
            at = (a + known, b + known) if way > 0 else (a - known - step, b - known - step)
            known = np.where(self.equal(*at, length), known + step, known)
            step //= 2
        return known


def _inside(found: set, at: np.ndarray, end: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Is [at, end) in a known run whose period divides q? Asks, of the runs that begin in time, that which ends last."""
    if not found:
        return np.zeros(len(at), bool)
    start, length, period = np.array(sorted(found)).T
    ends = start + length
    last = np.maximum.accumulate(ends)
    holder = np.maximum.accumulate(np.where(ends == last, np.arange(len(ends)), 0))
    i = np.searchsorted(start, at, "right") - 1
    run = holder[np.maximum(i, 0)]
    return (i >= 0) & (ends[run] >= end) & (q % period[run] == 0) & (period[run] < q)


def _divisors(q: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, prime) for the primes that divide each q."""
    rest, p = q.copy(), 2
    while (rest > 1).any():
        if p * p > rest.max():
            for prime in np.unique(rest[rest > 1]):
                yield np.flatnonzero(rest == prime), prime
            return
        at = np.flatnonzero(rest % p == 0)
        if len(at):
            yield at, p
            while len(again := np.flatnonzero(rest % p == 0)):
                rest[again] //= p
        p += 1


def _checked(ids: np.ndarray, start: int, end: int, q: int, low: int, high: int) -> tuple[int, int]:
    """The stretch [start, end) of period q around [low, high), word for word: hashes may err."""
    same = np.flatnonzero(ids[start : end - q] != ids[start + q : end]) + start
    if len(same) or (start and ids[start - 1] == ids[start - 1 + q]) or (end < len(ids) and ids[end] == ids[end - q]):
        start, end = low, high
        while start and ids[start - 1] == ids[start - 1 + q]:
            start -= 1
        while end < len(ids) and ids[end] == ids[end - q]:
            end += 1
        if (ids[start : end - q] != ids[start + q : end]).any():
            return low, low
    return start, end


def runs(ids: np.ndarray, longest: int | None = None) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, in order. ``longest``: no run is longer, as where ids are of several texts."""
    n = len(ids)
    longest = n if longest is None else longest
    if longest < LEAST_WORDS:
        return []
    held = Stretches(ids)
    values = mix(ids.astype(np.uint64) + np.uint64(1)) % np.uint64(PRIME - 1) + np.uint64(1)
    often = np.bincount(ids)[ids] >= TIMES  # each word of a run is
    found: set[tuple[int, int, int]] = set()
    size = 1
    while TIMES * size <= longest:
        able = np.flatnonzero(often[: n // size * size].reshape(-1, size).all(axis=1))
        step = max(1, BLOCKED_WORDS // size)
        seeds = [block_matches(values, size, able[i : i + step]) for i in range(0, len(able), step)]
        at, q = (np.concatenate([able[:0], *x]) for x in zip(*seeds, strict=True)) if seeds else (able, able)
        known = _inside(found, at, at + q + size, q)
        at, q = at[~known], q[~known]
        # What goes on for a period more, at one end at least.
        on = held.equal(at, at + q, size + q) | held.equal(at - q, at, size + q)
        at, q = at[on], q[on]
        if len(at):
            whole = np.ones(len(at), bool)
            for of, prime in _divisors(q):
                less = q[of] // prime
                whole[of] &= ~held.equal(at[of], at[of] + less, size + q[of] - less)
            at, q = at[whole], q[whole]
        if len(at):
            start, end = at - held.further(at, at + q, -1), at + q + held.further(at, at + q, 1)
            long = end - start >= np.maximum(LEAST_WORDS, TIMES * q)
            ends = np.stack([q, start, end, at, at + q + size], axis=1)[long]
            _, one = np.unique(ends[:, :3], axis=0, return_index=True)
            for period, s, e, low, high in ends[one].tolist():
                s, e = _checked(ids, s, e, period, low, high)
                if e - s >= max(LEAST_WORDS, TIMES * period):
                    found.add((s, e - s, period))
        size *= 2
    return sorted(found, key=lambda r: (r[0], r[2]))


# --- texts ------------------------------------------------------------------


def planted(doc_id: int | None, words: list) -> list:
    """The words of a document under the contract's rule, which makes some ends periodic."""
    n = len(words)
    h = 1 if doc_id is None else crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a : a + p]
    return words[:a] + (unit * (-(-(n - a) // p)))[: n - a]


def collapsed(words: list, found: list[tuple[int, int, int]]) -> list:
    """The words that no run drops."""
    if not found:
        return words
    kept = np.ones(len(words), bool)
    for start, length, period in found:
        kept[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(kept)]


def _described(words: list, found: list[tuple[int, int, int]]) -> tuple:
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return len(words), len(found), *top, sha256(listed.encode()).hexdigest(), sha256(b" ".join(collapsed(words, found))).hexdigest()


def _grouped(texts: list[list]) -> list[list[tuple[int, int, int]]]:
    """The runs of several texts, found together scale by scale; longer texts first, so that large scales see few."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    numbers, bounds, fresh = [], [0], 0
    for i in order:
        place = dict(zip(texts[i], range(fresh, fresh + len(texts[i])), strict=True))
        numbers.append(np.fromiter(map(place.__getitem__, texts[i]), np.int64, len(texts[i])))
        fresh += len(texts[i])
        bounds.append(fresh)
    out: list[list] = [[] for _ in texts]
    for start, length, period in runs(np.concatenate(numbers), len(texts[order[0]])):
        i = int(np.searchsorted(bounds, start, "right")) - 1
        out[order[i]].append((start - bounds[i], length, period))
    return out


def _groups(texts: list[list]) -> Iterator[list[int]]:
    """Indexes of texts of like length, of about GROUP_WORDS words in all."""
    group, size = [], 0
    for i in sorted(range(len(texts)), key=lambda i: len(texts[i])):
        if len(texts[i]) < LEAST_WORDS:
            continue
        group.append(i)
        size += len(texts[i])
        if size >= GROUP_WORDS:
            yield group
            group, size = [], 0
    if group:
        yield group


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch["_id"].to_pylist()
        # Bytes are split at [\x20\x09-\x0D] alone.
        texts = [planted(i, (t or "").encode("utf-8", "surrogatepass").split()) for i, t in zip(ids, batch["_text"].to_pylist(), strict=True)]
        found: list[list] = [[] for _ in texts]
        for group in _groups(texts):
            for i, x in zip(group, _grouped([texts[i] for i in group]), strict=True):
                found[i] = x
        told = list(zip(*(_described(w, f) for w, f in zip(texts, found, strict=True)), strict=True)) or [()] * 8
        names = [x for x in batch.schema.names if x not in ("_id", "_text")]
        own = [x.split(" ") for x in RESULT.split(", ")]
        yield pa.RecordBatch.from_arrays([*(batch[x] for x in names), *(pa.array(x, {"long": pa.int64(), "string": pa.string()}[t]) for x, (_, t) in zip(told, own, strict=True))], [*names, *(x for x, _ in own)])


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_rows: bool = True) -> DataFrame:
    """Returns ``row`` (the input row, if ``with_rows``), ``doc_id`` and RESULT: a row for each document."""
    asked = docs.select(*[F.struct("*").alias("row")] * with_rows, F.col(id_col).alias("doc_id"), F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    schema = asked.drop("_id", "_text").schema
    for field in RESULT.split(", "):
        schema = schema.add(*field.split(" "))
    return asked.mapInArrow(_find, schema)


def op13_periodic_runs(spark, sf_dir: str) -> DataFrame:
    return find_runs(table(spark, sf_dir, "documents"), with_rows=False)
