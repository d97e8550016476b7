"""Comparing in blocks: rows sent, recall at the threshold, and the matrix products against pairs."""

import numpy as np
import pytest

from estatelake.llm import near_dedup, sharded


def edited(rng, base, low, high):
    copy = list(base)
    for at in rng.choice(len(base), rng.integers(low, high), replace=False):
        copy[at] = f"n{rng.integers(1 << 40)}"
    return copy


@pytest.fixture(scope="module")
def weigh():
    return near_dedup.Weights(np.zeros((near_dedup.DEPTH, near_dedup.WIDTH), np.int64), 10)


@pytest.mark.parametrize("columns", [7, 2048])
def test_products_are_sums_of_minimums(weigh, columns, monkeypatch):
    monkeypatch.setattr(near_dedup, "COLUMNS", columns)
    rng = np.random.default_rng(0)
    base = [f"w{i}" for i in rng.integers(0, 90, 120)]
    sets = []
    for k in range(40):
        words = edited(rng, base, 0, 15)
        sets.append(weigh(" ".join(words + words[: 7 * (k % 5)] + ["of"] * (k % 11) * 3)))
    for split in (0, 15):
        got = near_dedup.shared_weight(sets, split)
        for i in range(split or 40):
            for j in range(split, 40):
                if i != j:
                    _, x, y = np.intersect1d(sets[i][0], sets[j][0], assume_unique=True, return_indices=True)
                    assert got[i, j - split] == pytest.approx(np.minimum(sets[i][1][x].astype(float), sets[j][1][y].astype(float)).sum())


def brute_classes(sets):
    part = list(range(len(sets)))

    def top(x):
        while part[x] != x:
            x = part[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if near_dedup.similarity(sets[a], sets[b]) >= 0.8 - near_dedup.SLACK:
                x, y = sorted((top(a), top(b)))
                part[y] = x
    return [top(i) for i in range(len(sets))]


def test_connected_is_brute_force(weigh):
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in range(60)]
    sets = [weigh(" ".join(edited(rng, base, 0, 4))) for _ in range(60)]
    want = brute_classes(sets)
    assert near_dedup.connected(sets, 0, np.arange(60), 0.8).tolist() == want and 1 < len(set(want)) < 60


def test_links_at_the_threshold_are_found(spark):
    """Pairs at a similarity of 0.8 to 0.83, each in a vocabulary of its own."""
    rng, data = np.random.default_rng(2), []
    for pair in range(400):
        base = [f"p{pair}x{i}" for i in range(200)]
        copy = list(base)
        for at in (20, 60, 100, 140)[: 4 - pair % 2]:
            copy[at] = f"n{rng.integers(1 << 40)}"
        copy[180:] = [f"m{rng.integers(1 << 40)}" for _ in copy[180:]][: 0 if pair % 2 else 20] or copy[180:]
        data += [(2 * pair, " ".join(base)), (2 * pair + 1, " ".join(copy))]
    found = near_dedup.NearDuplicates(spark.createDataFrame(data, "doc_id long, text string"))
    weigh = near_dedup.Weights(*found.shared.value)
    linked = {2 * p for p in range(400) if near_dedup.similarity(weigh(data[2 * p][1]), weigh(data[2 * p + 1][1])) >= 0.8}
    got = {r["class_id"] for r in found.documents().collect() if r["class_size"] == 2}
    assert got <= linked and len(linked) >= 150 and len(got) >= 0.99 * len(linked)


def test_a_family_below_the_threshold_makes_no_pairs(spark):
    """3,000 copies, most edited just too much for a link: what is sent grows with the family, not with its pairs."""
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(100)]
    data = [(i, " ".join(edited(rng, base, 2, 6))) for i in range(3000)]
    found = near_dedup.NearDuplicates(spark.createDataFrame(data, "doc_id long, text string").repartition(8))
    assert found.documents().count() == 3000
    assert found.rows_compared < 3000 * near_dedup.BANDS * 4


def test_blocks_give_the_same_classes(spark):
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(80)]
    data = [(i, " ".join(edited(rng, base, 0, 7))) for i in range(150)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    whole, small = (sorted(tuple(r) for r in near_dedup.NearDuplicates(docs, block_texts=n).documents().collect()) for n in (1000, 16))
    assert whole == small and 1 < len({r[1] for r in whole}) < 150


def test_lookup_with_many_shards(spark):
    """A digest's bytes don't depend on the number of shards; answers are those of one table."""
    rng = np.random.default_rng(5)
    batches, holders = [], {}
    for b in range(12):
        ids, counts = np.arange(20 * b, 20 * b + 20), rng.integers(0, 30, 20)
        digests = rng.integers(0, 900, counts.sum()).astype(np.uint64) << np.uint64(54)
        for d, i in zip(digests.tolist(), np.repeat(ids, counts).tolist(), strict=True):
            holders.setdefault(d, set()).add(i)
        batches.append((b, bytearray(ids.tobytes()), bytearray(counts.astype(np.int64).tobytes()), bytearray(digests.tobytes())))
    held = spark.createDataFrame(batches, "batch long, ids binary, counts binary, digests binary")
    total = sum(len(x[3]) // 8 for x in batches)
    for shards in (1, 300):
        sent = held.mapInArrow(sharded._ask(shards), "shard long, batch long, ids binary, body binary").selectExpr("sum(length(ids) + length(body)) AS n").first()["n"]
        assert sent <= 32 * total
        got = {}
        for r in sharded.sharded_lookup(held, total, -(-total // shards)).collect():
            for t in r["told"]:
                got |= dict(zip(np.frombuffer(t["digests"], np.uint64).tolist(), np.frombuffer(t["firsts"], np.int64).tolist(), strict=True))
        assert got == {d: min(h) for d, h in holders.items() if len(h) > 1}
