"""Near-duplicate documents by weighted MinHash.

A text is a weighted set of five-word shingles, weight = (1 + ln tf) * idf. Two
texts are linked if their weighted Jaccard similarity is 0.8 or more; classes
are the connected components of the links.

1. Document frequencies of all shingles over all documents go into a count-min
   sketch of fixed size. Its error is a fixed share of the number of documents,
   so idf tells shingles apart only above RARE of all documents and is flat
   below; it stays between 1 and 1 + IDF_RANGE, so that a few rare words don't
   outweigh a text.
2. Improved consistent weighted sampling draws BANDS * ROWS (shingle, level)
   pairs for each text: a pair is shared with the probability of the weighted
   similarity. The gamma and uniform variates of a shingle are a row of a table
   that its hash points to. ROWS samples make a band; texts that share a band
   are candidates (0.9994 of pairs at similarity 0.8, more above).
3. Equal texts are one node. In a bucket, each node is first compared with a
   centre alone: the member that shares most buckets with others. Links merge
   nodes into components. Buckets that still hold more than one component are
   dealt into blocks of BLOCK_TEXTS nodes; a task gets two blocks (or one with
   itself), compares all their pairs by matrix products over the shingles that
   they share, and returns no more than one row for each node: what it is
   connected to. So each candidate pair is compared or already connected, and
   pairs are no rows of any table.
4. In a bucket of more than one block, a text takes part only if its shingles
   that texts of other components hold too weigh SIMILARITY of its weight: what
   two linked texts share weighs that much. So texts of a large family that
   were edited too much for a link meet no one.

Cases: text that is null or has no word is a class of its own; a text of fewer
than five words is one shingle; a null id is the largest; rows that repeat a
text share its class, and one of them is kept; an empty table gives no rows;
only id and text are read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelake.llm.common import id_key, keep, table
from estatelake.llm.graph import components
from estatelake.llm.sharded import sharded_lookup
from estatelake.llm.textwords import mix, shingles

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 14, 4
#: Of the count-min sketch.
WIDTH, DEPTH = 1 << 17, 2
#: Shingles in fewer than this share of all documents weigh the same.
RARE = 0.02
IDF_RANGE = 0.2
VARIATES = 1 << 14
#: Of a block of a bucket, about: nodes, and code points of their texts. A centre meets as many in a task.
BLOCK_TEXTS, BLOCK_CHARS = 1024, 4 << 20
#: Columns of a matrix product; sums in another order differ by less than SLACK, which counts as equal.
COLUMNS, SLACK = 2048, 1e-9
#: Of the search for shingles that two texts hold: texts of a batch in bytes, digests of a shard.
BATCH_BYTES = 1 << 20
SHARD_DIGESTS = 500_000


# --- weights ----------------------------------------------------------------


def cells(hashes: np.ndarray) -> list[np.ndarray]:
    """The sketch's cell of each shingle in each of its rows."""
    shift = np.uint64(64 - WIDTH.bit_length() + 1)
    return [((hashes * np.uint64(0xA24BAED4963EE407 + 0x1000 * d | 1)) >> shift).astype(np.int64) for d in range(DEPTH)]


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((DEPTH, WIDTH), np.int64)
    for batch in batches:
        hashes = np.concatenate([np.zeros(0, np.uint64), *(shingles(text, WORDS)[0] for text in batch["text"].to_pylist() if text)])
        for row, at in zip(counts, cells(hashes), strict=True):
            row += np.bincount(at, minlength=WIDTH)
    cell = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(counts.ravel()[cell])], ["cell", "n"])


def document_frequencies(docs: DataFrame) -> np.ndarray:
    """The sketch over all documents: DEPTH * WIDTH counts, whatever the number of documents."""
    summed = docs.mapInArrow(_sketch, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(DEPTH * WIDTH, np.int64)
    out[summed["cell"].to_numpy(np.int64)] = summed["n"].to_numpy(np.int64)
    return out.reshape(DEPTH, WIDTH)


class Weights:
    """Weighted shingle sets under the corpus's document frequencies."""

    def __init__(self, counts: np.ndarray, n_docs: int):
        share = np.clip(counts / max(n_docs, 1), RARE, 1)
        self.idf = (1 + IDF_RANGE * np.log(share) / np.log(RARE)).astype(np.float32)

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        hashes, tf = shingles(text, WORDS)
        idf = functools.reduce(np.maximum, [row[at] for row, at in zip(self.idf, cells(hashes), strict=True)])
        return hashes, (1 + np.log(tf)).astype(np.float32) * idf


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard: sum of minimums over sum of maximums."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    x, y = a[1].astype(np.float64), b[1].astype(np.float64)
    both = np.minimum(x[i], y[j]).sum()
    every = x.sum() + y.sum() - both
    return float(both / every) if every else 0.0


# --- sampling ---------------------------------------------------------------


@functools.cache
def variates() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """r, ln c ~ of Gamma(2, 1), and beta ~ Uniform(0, 1), for VARIATES shingle classes and all samples."""
    rng = np.random.Generator(np.random.PCG64(7))
    shape = (VARIATES, BANDS * ROWS)
    r, c = rng.standard_gamma(2.0, shape), rng.standard_gamma(2.0, shape)
    return r.astype(np.float32), np.log(c).astype(np.float32), rng.random(shape, np.float32)


def bands(hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """A 64-bit value for each band, equal if its samples are."""
    r_all, lnc_all, beta_all = variates()
    at = (hashes >> np.uint64(50)).astype(np.int64)
    ln_w = np.log(weights)[:, None]
    best = picked = level = None
    for begin in range(0, len(hashes), 1024):
        part = slice(begin, begin + 1024)
        r, beta = r_all[at[part]], beta_all[at[part]]
        t = np.floor(ln_w[part] / r + beta)
        ln_a = lnc_all[at[part]] - r * (t - beta + 1)
        low = ln_a.argmin(axis=0)
        cols = np.arange(ln_a.shape[1])
        own, shingle, lev = ln_a[low, cols], hashes[part][low], t[low, cols]
        if best is None:
            best, picked, level = own, shingle, lev
        else:
            less = own < best
            best, picked, level = np.where(less, own, best), np.where(less, shingle, picked), np.where(less, lev, level)
    sample = mix(picked ^ (level.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    out = np.zeros(BANDS, np.uint64)
    for i in range(ROWS):
        out = mix(out * np.uint64(0xC2B2AE3D27D4EB4F) + sample[i::ROWS])
    return out.view(np.int64)


def _signatures(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = Weights(*shared.value)
        for batch in batches:
            out = []
            for text in batch["text"].to_pylist():
                hashes, w = weights(text or "")
                out.append(bands(hashes, w) if len(hashes) else None)
            names = [x for x in batch.schema.names if x != "text"]
            yield pa.RecordBatch.from_arrays([*(batch[x] for x in names), pa.array(out, pa.list_(pa.int64()))], [*names, "bands"])

    return run


# --- comparing --------------------------------------------------------------


def shared_weight(sets: list[tuple[np.ndarray, np.ndarray]], split: int) -> np.ndarray:
    """Sums of minimums between sets[:split] and sets[split:] (split 0: between all).

    A shingle is one column for each of the weights that it has: a text of
    weight w holds the columns up to w, and a column counts its step.
    """
    n = len(sets)
    hashes, weights = np.concatenate([x[0] for x in sets]), np.concatenate([x[1] for x in sets]).astype(np.float64)
    owner = np.repeat(np.arange(n), [len(x[0]) for x in sets])
    order = np.lexsort((weights, hashes))
    hashes, weights, owner = hashes[order], weights[order], owner[order]
    fresh = np.concatenate([[True], hashes[1:] != hashes[:-1]])
    group = np.cumsum(fresh) - 1
    left = np.bincount(group[owner < split], minlength=group[-1] + 1) if split else np.bincount(group)
    met = (left > 0) & (np.bincount(group) > left) if split else left > 1
    keep_at = met[group]
    weights, owner, fresh, group = weights[keep_at], owner[keep_at], fresh[keep_at], group[keep_at]
    out = np.zeros((split or n, n - split))
    if not len(owner):
        return out
    step = fresh | np.concatenate([[True], weights[1:] != weights[:-1]])
    level = np.cumsum(step) - 1  # the column of an entry's own weight
    starts = np.flatnonzero(step)
    size = np.where(fresh[starts], weights[starts], weights[starts] - weights[np.maximum(starts - 1, 0)])
    lowest = level[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]  # the first column of an entry's shingle
    begin = 0
    while begin < len(owner):
        end = int(np.searchsorted(level, level[begin] + COLUMNS))
        if end < len(owner):  # whole shingles; a single one may have more columns
            end = int(np.searchsorted(lowest, lowest[end], "left")) if lowest[end] > lowest[begin] else int(np.searchsorted(lowest, lowest[begin], "right"))
        low, deep = lowest[begin:end], level[begin:end] - lowest[begin:end] + 1
        at = np.repeat(low - low[0] - (np.cumsum(deep) - deep), deep) + np.arange(deep.sum())
        held = np.zeros((n, level[end - 1] - low[0] + 1))
        held[np.repeat(owner[begin:end], deep), at] = 1
        out += (held[: split or n] * size[low[0] : level[end - 1] + 1]) @ held[split:].T
        begin = end
    return out


def connected(sets: list[tuple[np.ndarray, np.ndarray]], split: int, comps: np.ndarray, least: float) -> np.ndarray:
    """For each set the first that it is connected to by links, between sets[:split] and sets[split:] (split 0: all); equal ``comps`` aren't compared."""
    n, total = len(sets), np.array([x[1].astype(np.float64).sum() for x in sets])
    rows, cols = np.arange(split or n), np.arange(split, n)
    both = shared_weight(sets, split)
    alike = both / np.maximum(total[rows][:, None] + total[cols] - both, 1e-30)
    link = (comps[rows][:, None] != comps[cols]) & (alike >= least - SLACK)
    a, b = np.nonzero(link)
    a, b, label = rows[a], cols[b], np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _links(rows: list, comps: list, split: int, least: float) -> list[tuple[int, int]]:
    if len(set(comps)) < 2:
        return []
    nodes, sets = zip(*rows, strict=True)
    first = connected(list(sets), split, np.array(comps), least)
    return [(nodes[i], nodes[j]) for i, j in enumerate(first) if i != j]


def _compared(shared, least: float):
    """Rows come sorted by (band, value, i, j, side): the two blocks of a task's pair, or one block (i = j)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weigh = Weights(*shared.value)
        key, rows, comps, split = None, [], [], 0
        for batch in batches:
            out = []
            for *own, side, node, comp, text in zip(*(batch[c].to_pylist() for c in ("band", "value", "i", "j", "side", "node", "comp", "text")), strict=True):
                if own != key:
                    if key and (split or key[2] == key[3]):
                        out += _links(rows, comps, split, least)
                    key, rows, comps, split = own, [], [], 0
                if side and not split:
                    split = len(rows)
                    if not split:  # nothing on the other side
                        key = None
                        continue
                rows.append((node, weigh(text)))
                comps.append(comp)
            yield _pairs(out)
        if key and (split or key[2] == key[3]):
            yield _pairs(_links(rows, comps, split, least))

    return run


def _with_centre(shared, least: float):
    """Rows come sorted by (centre, salt, side): the centre, then nodes to compare with it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weigh, centre = Weights(*shared.value), (None, None)
        for batch in batches:
            out = []
            for side, node, text in zip(*(batch[c].to_pylist() for c in ("side", "node", "text")), strict=True):
                if not side:
                    centre = node, weigh(text)
                elif similarity(centre[1], weigh(text)) >= least - SLACK:
                    out.append((centre[0], node))
            yield _pairs(out)

    return run


def _pairs(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in pairs], pa.int64()) for i in (0, 1)], ["a", "b"])


# --- shingles that texts of other components hold ---------------------------

HELD = "batch long, n long, ids binary, nodes binary, counts binary, weights binary, digests binary"
_HELD_SCHEMA = pa.schema([("batch", pa.int64()), ("n", pa.int64()), *((x, pa.binary()) for x in ("ids", "nodes", "counts", "weights", "digests"))])


def _packed_shingles(shared):
    """Batches of texts as arrays: components (the ids), nodes, their numbers of shingles, the shingles' weights and hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weigh, rng = Weights(*shared.value), np.random.default_rng()
        ids, nodes, sets, size = [], [], [], 0

        def packed() -> pa.RecordBatch:
            hashes, weights = zip(*sets, strict=True)
            row = {"batch": int(rng.integers(1 << 62)), "n": sum(map(len, hashes)), "ids": np.array(ids, np.int64).tobytes(), "nodes": np.array(nodes, np.int64).tobytes(), "counts": np.array([*map(len, hashes)], np.int64).tobytes(), "weights": np.concatenate(weights).tobytes(), "digests": np.concatenate(hashes).tobytes()}
            return pa.RecordBatch.from_pylist([row], schema=_HELD_SCHEMA)

        for batch in batches:
            for comp, node, text in zip(batch["comp"].to_pylist(), batch["node"].to_pylist(), batch["text"].to_pylist(), strict=True):
                ids.append(comp)
                nodes.append(node)
                sets.append(weigh(text))
                size += len(text)
                if size >= BATCH_BYTES:
                    yield packed()
                    ids, nodes, sets, size = [], [], [], 0
        if ids:
            yield packed()

    return run


def _summed_weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            nodes, counts = np.frombuffer(row["nodes"], np.int64), np.frombuffer(row["counts"], np.int64)
            digests, weights = np.frombuffer(row["digests"], np.uint64), np.frombuffer(row["weights"], np.float32).astype(np.float64)
            twice = np.isin(digests, np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(x, np.uint64) for x in row["answers"] or [])]))
            starts = np.cumsum(counts) - counts
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(np.add.reduceat(weights, starts)), pa.array(np.add.reduceat(weights * twice, starts))], ["node", "w", "s"])


# --- candidates and classes -------------------------------------------------


class NearDuplicates:
    """The classes of a table of documents; the tables it writes are in the shared folder.

    rows: (id, h1, h2, chars, bands) of each document. texts: (h1, h2, rep,
    copies, chars, node) of each different text with a word. comps: (node, comp)
    of those with a link. rows_compared: how many texts the tasks that compare
    were sent.
    """

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY, block_texts: int = BLOCK_TEXTS, block_chars: int = BLOCK_CHARS):
        self.spark = docs.sparkSession
        self.least, self.block_texts, self.block_chars = least, block_texts, block_chars
        self.docs = docs.select(id_key(id_col).alias("id"), F.col(text_col).alias("text"))
        counts = document_frequencies(self.docs)
        self.shared = self.spark.sparkContext.broadcast((counts, self.docs.count()))
        hashed = self.docs.withColumn("h1", F.xxhash64("text")).withColumn("h2", F.xxhash64(F.lit(7), "text")).withColumn("chars", F.length("text").cast("long"))
        self.rows = keep(hashed.select("id", "h1", "h2", "chars", "text").mapInArrow(_signatures(self.shared), "id long, h1 long, h2 long, chars long, bands array<long>"), "near-rows")
        texts = self.rows.filter("bands IS NOT NULL").groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("chars").alias("chars"), F.first("bands").alias("bands"))
        self.texts = keep(texts.withColumn("node", F.monotonically_increasing_id()), "near-texts")
        self.rows_compared = 0
        self.comps = self._classes()

    def _buckets(self) -> DataFrame:
        """(band, value, node, chars, n, weight) of the buckets with two nodes or more; weight: how often a node shares a bucket."""
        held = self.texts.select("node", "chars", F.posexplode("bands").alias("band", "value"))
        sizes = held.groupBy("band", "value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        shared = keep(held.join(sizes, ["band", "value"]), "near-buckets")
        weight = shared.groupBy("node").agg(F.sum("n").alias("weight"))
        return keep(shared.join(weight, "node"), "near-buckets")

    def _text_of(self, nodes: DataFrame) -> DataFrame:
        wanted = self.texts.join(nodes, "node").select("node", F.col("rep").alias("id"), "h1", "h2")
        found = self.docs.join(wanted, "id").filter((F.xxhash64("text") == F.col("h1")) & (F.xxhash64(F.lit(7), "text") == F.col("h2")))
        return keep(found.select("node", "text").dropDuplicates(["node"]), "near-texts")

    def _sent(self, rows: DataFrame, keys: list[str], compare, name: str) -> DataFrame:
        """(a, b) that ``compare`` finds in the rows of each key, which come with their texts."""
        rows = keep(rows, name)
        self.rows_compared += rows.count()
        met = rows.join(self.known, "node").repartition(*keys).sortWithinPartitions(*keys, "side")
        return keep(met.mapInArrow(compare(self.shared, self.least), "a long, b long"), "near-links")

    def _star(self) -> DataFrame:
        """Links between the members of a bucket and its centre, the member that shares most buckets."""
        members = self.buckets.select("band", "value", "node", "weight")
        centres = members.groupBy("band", "value").agg(F.max_by("node", F.struct("weight", "node")).alias("centre"))
        pairs = members.join(centres, ["band", "value"]).filter("node <> centre").select("centre", "node").distinct()
        salts = pairs.groupBy("centre").agg(F.ceil(F.count(F.lit(1)) / self.block_texts).alias("salts"))
        met = pairs.join(salts, "centre").select("centre", F.pmod(F.xxhash64("node"), F.col("salts")).alias("salt"), F.lit(1).alias("side"), "node")
        middle = salts.select("centre", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("side"), F.col("centre").alias("node"))
        return self._sent(met.unionByName(middle), ["centre", "salt"], _with_centre, "near-star")

    def _shared_weights(self, nodes: DataFrame) -> DataFrame:
        """``nodes``: (node, comp). Returns (node, w, s): a text's weight, and the weight of its shingles that a text of another component holds too."""
        packed = keep(self.known.join(nodes, "node").select("comp", "node", "text").mapInArrow(_packed_shingles(self.shared), HELD), "near-shingles")
        answers = sharded_lookup(packed, packed.agg(F.sum("n")).first()[0] or 0, SHARD_DIGESTS)
        met = packed.join(answers, "batch", "left").select("nodes", "counts", "weights", "digests", F.col("told.digests").alias("answers"))
        return met.mapInArrow(_summed_weights, "node long, w double, s double")

    def _merged(self, comps: DataFrame, links: DataFrame) -> DataFrame:
        """Components with new links: the graph of components is what is left to solve."""
        label = lambda side: comps.select(F.col("node").alias(side), F.col("comp").alias(f"c{side}"))
        between = links.join(label("a"), "a", "left").join(label("b"), "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).filter("a <> b")
        merged = components(between)
        both = comps.unionByName(merged.join(comps, "node", "left_anti").select("node", F.col("node").alias("comp")))
        return keep(both.join(merged.select(F.col("node").alias("comp"), F.col("comp").alias("to")), "comp", "left").select("node", F.coalesce("to", "comp").alias("comp")), "near-comps")

    def _apart(self, members: DataFrame) -> DataFrame:
        """The buckets that hold more than one component, with ``blocks``, how many they are dealt into; of buckets with the same members, one."""
        each = members.groupBy("band", "value").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64(F.lit(7), "node")).alias("y")).filter("low < high")
        one = each.groupBy("n", "chars", "x", "y").agg(F.min(F.struct("band", "value")).alias("of"))
        return one.select("of.band", "of.value", F.ceil(F.greatest(F.col("n") / self.block_texts, F.col("chars") / self.block_chars)).alias("blocks"))

    def _across(self, comps: DataFrame) -> DataFrame:
        """Connections between nodes that share a bucket and are in different components so far."""
        named = self.buckets.select("band", "value", "node", "chars").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        members = keep(named.join(self._apart(named), ["band", "value"]), "near-apart")
        crowd = members.filter("blocks > 1").drop("blocks")
        members = members.filter("blocks = 1")
        if crowd.limit(1).count():
            weights = self._shared_weights(crowd.select("node", "comp").distinct())
            able = crowd.join(weights.filter(F.col("s") >= self.least * F.col("w") - 1e-6).select("node"), "node")
            able = keep(able, "near-able")
            members = members.unionByName(able.join(self._apart(able), ["band", "value"]).select(*members.columns))
        own = F.pmod(F.xxhash64("node", "band"), F.col("blocks"))
        met = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        rows = met.select("band", "value", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"), "node", "comp")
        return self._sent(rows, ["band", "value", "i", "j"], _compared, "near-blocks")

    def _classes(self) -> DataFrame:
        self.buckets = self._buckets()
        self.known = self._text_of(self.buckets.select("node").distinct())
        comps = components(self._star())
        return self._merged(comps, self._across(comps))

    def text_classes(self) -> DataFrame:
        """(h1, h2, rep, class_id, class_size, keeper): a row for each different text; keeper marks one text of a class."""
        comp = F.coalesce("comp", "node").alias("comp")
        texts = self.texts.drop("bands", "chars").join(self.comps, "node", "left").select("h1", "h2", "rep", "copies", "node", comp)
        classes = texts.groupBy("comp").agg(F.min("rep").alias("class_id"), F.sum("copies").alias("class_size"), F.min_by("node", F.struct("rep", "h1", "h2")).alias("first"))
        return keep(texts.join(classes, "comp").select("h1", "h2", "rep", "class_id", "class_size", (F.col("node") == F.col("first")).alias("keeper")), "near-classes")

    def documents(self) -> DataFrame:
        """(doc_id, class_id, class_size, kept): a row for each document."""
        told = self.rows.drop("bands", "chars").join(self.text_classes(), ["h1", "h2"], "left")
        back = lambda x: F.when(x != 2**63 - 1, x)
        return told.select(back(F.col("id")).alias("doc_id"), back(F.coalesce("class_id", "id")).alias("class_id"), F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"), F.coalesce(F.col("keeper") & (F.col("id") == F.col("rep")), F.lit(True)).alias("kept"))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without all but one of each class; all columns stay as they are."""
    found = NearDuplicates(docs, id_col, text_col)
    keepers = found.text_classes().filter("keeper").select(F.col("rep").alias("k_id"), F.col("h1").alias("k1"), F.col("h2").alias("k2"))
    wordless = ~F.coalesce(F.col(f"row.{text_col}"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    rows = docs.select(F.struct("*").alias("row")).withColumn("k_id", id_key(f"row.{id_col}")).withColumn("k1", F.xxhash64(f"row.{text_col}")).withColumn("k2", F.xxhash64(F.lit(7), f"row.{text_col}"))
    one = rows.filter(~wordless).join(keepers, ["k_id", "k1", "k2"], "left_semi").dropDuplicates(["k_id", "k1", "k2"])
    return one.select("row.*").unionByName(rows.filter(wordless).select("row.*"))


def op5_near_dedup(spark, sf_dir: str) -> DataFrame:
    return NearDuplicates(table(spark, sf_dir, "documents")).documents()
