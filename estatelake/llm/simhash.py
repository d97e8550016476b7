"""Near-duplicate documents by SimHash fingerprints at a small Hamming distance.

A bit of a text's fingerprint is 1 if it is set in over half of the XXH64
hashes (seed 42) of its three-word shingles, repeats included. Fingerprints link
at MOST_BITS or fewer differing bits; a component is what links reach.

Equal fingerprints are one node. Nodes are embedded by the number of ones in
each of 32 segments of two bits: the Manhattan distance of two such vectors is
no more than the Hamming distance of the fingerprints. The vector is cut into
PARTS stretches of segments, so that linked nodes are within a distance of one
in one of them at least. Each stretch is a grid whose cells are its vectors: a
node stands in its own cell of each grid and is sent as a guest to its cell and
to those with one more in one segment (the other direction is met from the other
side). What meets in a cell is first held against the Manhattan distance over
all segments, and what passes against the fingerprints themselves.

A cell is compared by a task as arrays, and what comes out are connections, one
row at most for each node that a batch knows, never pairs. Cells of more than
``block_nodes`` nodes, or with such neighbours, are dealt into blocks by a hash of
the node; each pair of blocks is a row of its own.

Cases: null or wordless text has fingerprint zero, which links like any other;
fewer than three words are one shingle; a null id is the largest, and a
component of null ids alone has a null component_id; repeated rows are rows of
their own in one component; an empty table gives no rows; only id and text are
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelake.llm.common import NULL_ID, id_key, keep, table
from estatelake.llm.graph import components, first_of_each

SHINGLE_WORDS, SEED = 3, 42
MOST_BITS = 3
#: A stretch of PARTS has at most half of MOST_BITS, so one at most.
PARTS = MOST_BITS // 2 + 1
SEGMENTS = 32
LOW_BITS = 0x5555555555555555
#: Nodes of a block of a crowded cell, about; pairs compared at once.
BLOCK_NODES, PAIRS_AT_ONCE = 4096, 1 << 20
#: Rows of one fingerprint that a task joins, about; at least LEAST_SALTS parts.
JOINED_ROWS, LEAST_SALTS = 1 << 20, 64


# --- fingerprints -----------------------------------------------------------


def fingerprint(text: str | None) -> int:
    """64 bits, unsigned."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # A-Z and [\x20\x09-\x0D] alone
    if not words:
        return 0
    line = b" ".join(words)
    n = min(SHINGLE_WORDS, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - n + 1].tolist()
    ends = ends[n - 1 :].tolist()
    hashed, view = xxhash.xxh64_intdigest, memoryview(line)
    values = np.fromiter((hashed(view[a:b], SEED) for a, b in zip(starts, ends, strict=True)), np.uint64, len(ends))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(values), 1 << 16):
        part = values[at : at + (1 << 16), None].astype(">u8").view(np.uint8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(values)).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([fingerprint(t) for t in batch["text"].to_pylist()], np.uint64)
        yield pa.RecordBatch.from_arrays([batch["id"], pa.array(found.view(np.int64))], ["id", "fp"])


# --- the grids --------------------------------------------------------------


def grid_cell(fp: F.Column, part: int) -> F.Column:
    """Numbers of ones of the segments in one stretch: two bits for each segment."""
    bits = 64 // PARTS
    x = F.shiftrightunsigned(fp, part * bits).bitwiseAND(F.lit((1 << bits) - 1))
    low = F.lit(LOW_BITS & ((1 << bits) - 1))
    return x.bitwiseAND(low) + F.shiftrightunsigned(x, 1).bitwiseAND(low)


def guest_cells(cell: F.Column) -> F.Column:
    """The cell itself and those with one more in one segment (at most two fit in one)."""
    more = [F.when(F.shiftrightunsigned(cell, 2 * i).bitwiseAND(F.lit(3)) < 2, cell + F.lit(1 << (2 * i))) for i in range(SEGMENTS // PARTS)]
    return F.filter(F.array(cell, *more), lambda x: x.isNotNull())


def ladder(fp: np.ndarray) -> np.ndarray:
    """Each segment's number of ones as that many low bits: differing bits of two ladders are the Manhattan distance of the vectors."""
    high, low = (fp >> np.uint64(1)) & np.uint64(LOW_BITS), fp & np.uint64(LOW_BITS)
    return (high | low) | ((high & low) << np.uint64(1))


def links(homes: np.ndarray, guests: np.ndarray, n_homes: np.ndarray, n_guests: np.ndarray, most: int = MOST_BITS) -> tuple[np.ndarray, np.ndarray]:
    """(node, first linked node) of what cells hold; ``n_homes`` and ``n_guests`` tell how many of each are in a cell."""
    each = np.repeat(n_guests, n_homes)  # guests that a home meets
    begin = np.repeat(np.cumsum(n_guests) - n_guests, n_homes)
    upto = np.cumsum(each)
    steps_home, steps_guest = ladder(homes), ladder(guests)
    a, b, at = homes[:0], homes[:0], 0
    while at < len(homes):
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIRS_AT_ONCE, "right")))
        n = each[at:end]
        i = np.repeat(np.arange(at, end), n)
        j = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin[at:end], n)
        near = np.bitwise_count(steps_home[i] ^ steps_guest[j]) <= most
        i, j = i[near], j[near]
        apart = np.bitwise_count(homes[i] ^ guests[j])
        linked = (apart <= most) & (apart > 0)
        if linked.any():
            a, b = first_of_each(np.concatenate([a, homes[i[linked]]]), np.concatenate([b, guests[j[linked]]]))
        at = end
    return a, b


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = [batch[side] for side in ("homes", "guests")]
        homes, guests = (x.flatten().to_numpy(zero_copy_only=False).view(np.uint64) for x in lists)
        sizes = [np.diff(x.offsets.to_numpy()).astype(np.int64) for x in lists]
        a, b = links(homes, guests, *sizes)
        yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a, b)], ["a", "b"])


def near_links(nodes: DataFrame, block_nodes: int = BLOCK_NODES) -> DataFrame:
    """``nodes``: distinct ``fp``. Returns (a, b): connections that join all that links join."""
    parts = F.array(*[F.struct(F.lit(p).alias("part"), grid_cell(F.col("fp"), p).alias("cell")) for p in range(PARTS)])
    homes = nodes.select("fp", F.inline(parts))
    crowded = keep(homes.groupBy("part", "cell").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block_nodes), "simhash-crowded")
    visited = crowded.select("part", F.explode(guest_cells(F.col("cell"))).alias("cell"), "n").groupBy("part", "cell").agg(F.sum("n").alias("g"))
    blocks = lambda n: F.ceil(F.coalesce(n, F.lit(1)) / block_nodes).cast("int")
    # Small unless most cells are crowded; it goes to all tasks only if the planner finds its size fit for that.
    crowds = keep(visited.join(crowded, ["part", "cell"], "left").select("part", "cell", blocks(F.col("n")).alias("homes"), blocks(F.col("g")).alias("guests")), "simhash-crowds")
    guests = homes.select("fp", "part", F.explode(guest_cells(F.col("cell"))).alias("cell"))
    rows = homes.select("part", "cell", F.lit(True).alias("home"), "fp").unionByName(guests.select("part", "cell", F.lit(False).alias("home"), "fp"))
    dealt = rows.join(crowds, ["part", "cell"], "left")
    home = F.col("home")
    own_blocks, other_blocks = (F.coalesce(F.when(home, F.col(x)).otherwise(F.col(y)), F.lit(1)) for x, y in (("homes", "guests"), ("guests", "homes")))
    met = dealt.withColumn("own", F.pmod(F.xxhash64("fp"), own_blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), other_blocks - 1)))
    met = met.select("part", "cell", F.when(home, F.col("own")).otherwise(F.col("other")).alias("i"), F.when(home, F.col("other")).otherwise(F.col("own")).alias("j"), "home", "fp")
    # Lists of a block each. Most guests meet an empty cell, and most homes no one but themselves.
    cells = met.groupBy("part", "cell", "i", "j").agg(F.collect_list(F.when(F.col("home"), F.col("fp"))).alias("homes"), F.collect_list(F.when(~F.col("home"), F.col("fp"))).alias("guests"))
    cells = cells.filter((F.size("homes") > 0) & ((F.size("guests") > 1) | ((F.size("guests") > 0) & (F.get("guests", F.lit(0)) != F.get("homes", F.lit(0))))))
    return cells.select("homes", "guests").mapInArrow(_linked, "a long, b long")


# --- components -------------------------------------------------------------


def near_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_nodes: int = BLOCK_NODES) -> DataFrame:
    """(doc_id, fingerprint, component_id): a row for each document."""
    found = docs.select(id_key(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(_fingerprints, "id long, fp long")
    found = keep(found, "simhash-rows")
    # A third of all rows may have one fingerprint: they meet its component in as many parts as their number asks for.
    salts = max(LEAST_SALTS, -(-found.count() // JOINED_ROWS))
    found = found.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)))
    held = keep(found.groupBy("fp", "salt").agg(F.min("id").alias("id")), "simhash-held")
    nodes = keep(held.groupBy("fp").agg(F.min("id").alias("id")), "simhash-nodes")
    label = components(near_links(nodes, block_nodes)).withColumnRenamed("node", "fp")
    named = nodes.join(label, "fp", "left").withColumn("comp", F.coalesce("comp", "fp"))
    firsts = named.groupBy("comp").agg(F.min("id").alias("component_id"))
    told = held.join(named.join(firsts, "comp").select("fp", "component_id"), "fp").select("fp", "salt", "component_id")
    back = lambda c: F.when(F.col(c) != NULL_ID, F.col(c)).alias({"id": "doc_id"}.get(c, c))
    return found.join(told, ["fp", "salt"]).select(back("id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), back("component_id"))


def op11_simhash(spark, sf_dir: str) -> DataFrame:
    return near_documents(table(spark, sf_dir, "documents"))
