"""SimHash components, spelling variants and periodic runs against brute force."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from estatelake.llm import periodic_runs, simhash, spelling

SCHEMA = "doc_id long, text string, source string, id long, fp long, word string, n long, n_runs long"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(spark, pairs):
    return spark.createDataFrame([(i, t, "s", 5, 6, "clash", 7, 8) for i, t in pairs], SCHEMA)


def prose(rng, n, vocabulary=900):
    return " ".join(f"wo{rng.randrange(vocabulary)}rd" for _ in range(n))


def hostile():
    rng = random.Random(3)
    base = prose(rng, 900)
    out = [(1, base), (2, base), (3, base.upper()), (None, base), (None, None), (4, None), (5, ""), (6, " \n\t\x0b "), (7, "one"), (8, "One two"), (8, "One two"), (9, "a\xa0b c\x85d e"), (10, prose(rng, 30_000))]
    for i in range(60):
        words = base.split()
        for at in rng.sample(range(900), rng.randrange(1, 4)):
            words[at] = f"x{rng.randrange(9)}"
        out.append((20 + i, "  ".join(words)))
    return out + [(100 + i, prose(rng, 40)) for i in range(60)]


# --- fingerprints -----------------------------------------------------------


def brute_fingerprint(text):
    words = WORD.findall((text or "").translate(str.maketrans(UPPER, LOWER)))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, ids):
    """The smallest id reachable by links of three bits."""
    prints = np.array(prints, np.uint64)
    near = np.bitwise_count(prints[:, None] ^ prints) <= 3
    label = np.array([2**63 - 1 if i is None else i for i in ids])
    while True:
        new = np.where(near, label[None, :], 2**63 - 1).min(axis=1)
        if (new == label).all():
            return [None if x == 2**63 - 1 else int(x) for x in label]
        label = new


@pytest.mark.parametrize("block", [4096, 3])
def test_simhash_documents(spark, block):
    rows = hostile()
    prints = [brute_fingerprint(t) for _, t in rows]
    want = sorted(zip((i for i, _ in rows), (f"{p:016x}" for p in prints), brute_components(prints, [i for i, _ in rows]), strict=True), key=str)
    got = sorted((tuple(r) for r in simhash.near_documents(table(spark, rows), block_nodes=block).collect()), key=str)
    assert got == want
    assert len({c for _, _, c in want}) < len(rows) - 20


def test_simhash_empty(spark):
    assert simhash.near_documents(table(spark, [])).count() == 0
    only = simhash.near_documents(table(spark, [(None, None), (None, "")])).collect()
    assert [tuple(r) for r in only] == [(None, "0" * 16, None)] * 2


@pytest.mark.parametrize("block", [4096, 5])
def test_every_link_is_met(spark, block):
    """Fingerprints a few bits apart, in clusters that fill cells, and on the border of the distance."""
    rng = np.random.default_rng(1)
    centres = rng.integers(0, 2**64, 60, dtype=np.uint64)
    prints = []
    for c in centres:
        for _ in range(8):
            flips = rng.choice(64, rng.integers(0, 5), replace=False)
            prints.append(int(c) ^ sum(1 << int(b) for b in flips))
    prints = sorted({*prints, 0, 1, 7, 15, 2**64 - 1, 2**64 - 2, 2**63, 2**63 + 7})
    as_long = [p - 2**64 if p >= 2**63 else p for p in prints]
    nodes = spark.createDataFrame([(p,) for p in as_long], "fp long")
    found = simhash.components(simhash.near_links(nodes, block)).collect()
    label = dict(zip(as_long, as_long, strict=True)) | {r["node"]: r["comp"] for r in found}
    group = collections.defaultdict(set)
    for p, q in label.items():
        group[q].add(p)
    want = collections.defaultdict(set)
    for p, q in zip(as_long, brute_components(prints, range(len(prints))), strict=True):
        want[q].add(p)
    assert sorted(map(sorted, group.values())) == sorted(map(sorted, want.values()))


def test_manhattan_distance_is_a_lower_bound():
    x = np.random.default_rng(2).integers(0, 2**64, 4000, dtype=np.uint64)
    a, b = x[:2000], x[2000:]
    steps = np.bitwise_count(simhash.ladder(a) ^ simhash.ladder(b))
    segments = lambda v: np.stack([np.bitwise_count((v >> np.uint64(2 * i)) & np.uint64(3)) for i in range(32)]).astype(int)
    assert (steps == np.abs(segments(a) - segments(b)).sum(axis=0)).all()
    assert (steps <= np.bitwise_count(a ^ b)).all()


def test_a_dense_family_makes_no_pairs(spark):
    """What comes out of a batch is a row for each node at most."""
    rng = np.random.default_rng(4)
    bits = rng.integers(0, 2, (3000, 12), dtype=np.uint64) << np.arange(0, 60, 5, dtype=np.uint64)
    prints = np.unique(bits.sum(axis=1).astype(np.uint64))
    a, b = simhash.links(prints, prints, np.array([len(prints)]), np.array([len(prints)]))
    assert len(a) < len(prints) and len(set(a.tolist())) == len(a) and set(b.tolist()) == {int(prints.min())}


# --- spelling ---------------------------------------------------------------


def brute_variants(rows):
    counts = collections.Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(str.maketrans(UPPER, LOWER))
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= 2}

    def one_apart(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        return len(a) + 1 == len(b) and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    near = {w: [x for x in counts if one_apart(w, x)] for w in counts}
    form = {w: min(near[w], key=lambda x: (-counts[x], x)) for w in counts if near[w]}
    form = {w: f for w, f in form.items() if counts[f] >= 10 * counts[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted(((w, n, len(near[w]), form.get(w), counts.get(form.get(w)), root(w)) for w, n in counts.items()), key=str)


def spelt():
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdeéÉ×ÿ") for _ in range(rng.randrange(7, 11))) for _ in range(25)]
    rows = [(None, "Étienne étienne ÉTIENNE"), (1, None), (2, ""), (3, "short"), (4, "a" * 3000 + " " + "a" * 2999 + "b " + "a" * 2999), (5, "a" * 3000 + " " + "a" * 2999 + "b " + "a" * 2999)]
    for i in range(400):
        out = []
        for _ in range(30):
            w = list(words[min(int(rng.expovariate(0.3)), 24)])
            if rng.random() < 0.04:
                at = rng.randrange(len(w))
                w[at : at + rng.randrange(2)] = rng.choice(["", "a", "é", "Z"])
            out.append("".join(w))
        out += ["chainaaab"] + ["chainaabb"] * (i < 37) + ["chainabbb"] * (i < 3)
        rows.append((10 + i, rng.choice([" ", ", ", "1"]).join(out)))
    return rows + rows[-3:]


@pytest.mark.parametrize("block", [2048, 4])
def test_spelling_variants(spark, block):
    rows = spelt()
    want = brute_variants(rows)
    got = sorted((tuple(r) for r in spelling.variants(table(spark, rows), block_words=block).select("word", "n", "n_near", "form", "form_n", "root").collect()), key=str)
    assert got == want
    assert sum(x[3] is not None for x in want) > 20 and any(x[3] not in (None, x[5]) for x in want)


def test_spelling_empty(spark):
    assert spelling.variants(table(spark, [])).count() == 0
    assert spelling.variants(table(spark, [(1, "lonesome words here")])).count() == 0


def test_chains_of_forms_end_at_their_roots(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(13)] + [("x", "w3")]
    got = {r["word"]: r["root"] for r in spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert got == {w: "w13" for w, _ in chain}


# --- runs -------------------------------------------------------------------


def brute_runs(words):
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            part = words[start : start + length]
            if i > start and length >= max(6, 4 * q) and not any(part[d:] == part[:-d] for d in range(1, q)):
                out.append((start, length, q))
            i += i == start
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute_runs(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    top = sorted(found, key=lambda r: (-r[1], r[0], r[2]))[:1]
    best = (*top[0], 1000 * top[0][1] // top[0][2]) if top else (None,) * 4
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(found), *best, sha("".join(f"{s},{m},{q}\n" for s, m, q in found)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


pieces = st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=7), st.integers(1, 7)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(st.lists(pieces, min_size=1, max_size=4))
def test_runs_of_small_alphabets(texts):
    texts = [[str(x) for unit, times in text for x in unit * times] for text in texts]
    texts = [x for x in texts if len(x) >= 6]
    if texts:
        assert periodic_runs._grouped(texts) == [brute_runs(x) for x in texts]


def periodic():
    rng = random.Random(5)
    rows = [(None, "a " * 9), (None, None), (1, ""), (2, " \n"), (3, "a b c"), (4, "x " * 50), (4, "x " * 50), (5, "the the the the the the"), (6, "u v w " * 40 + "u u u u u u " + "u v w " * 4), (7, ("a " * 8 + "b ") * 60)]
    for i in range(160):
        words = [f"w{rng.randrange(5 if i % 3 else 400)}" for _ in range(rng.randrange(1, 300))]
        if i % 2:
            at = rng.randrange(len(words))
            words[at:at] = words[at : at + rng.randrange(1, 30)] * rng.randrange(1, 9)
        rows.append((100 + i, rng.choice([" ", "\n", " \t "]).join(words)))
    return rows


def test_periodic_runs(spark):
    rows = periodic()
    want = sorted((brute_row(*r) for r in rows), key=str)
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = sorted((tuple(r) for r in periodic_runs.find_runs(table(spark, rows)).select(*names).collect()), key=str)
    assert got == want
    assert sum(r[1] > 0 for r in want) > 40
    assert periodic_runs.find_runs(table(spark, []), with_rows=False).count() == 0


def test_transform_round_trip_and_matches():
    x = np.random.default_rng(0).integers(0, periodic_runs.PRIME, (3, 64)).astype(np.uint64)
    assert (periodic_runs.transform(periodic_runs.transform(x), inverse=True) == x * np.uint64(64) % np.uint64(periodic_runs.PRIME)).all()
    values = np.random.default_rng(1).integers(1, 3, 300).astype(np.uint64)
    for size in (1, 2, 4, 8):
        n = len(values) // size
        want = {(s, d) for s in range(0, n * size, size) for d in range(size, 2 * size) if len(values[s + d : s + d + size]) == size and (values[s : s + size] == values[s + d : s + d + size]).all()}
        assert set(zip(*(v.tolist() for v in periodic_runs.block_matches(values, size, np.arange(n))), strict=True)) == want


def test_long_texts():
    """Of one word, of a nested period, and of noise: 300,000 words each."""
    n = 300_000
    assert periodic_runs._grouped([["a"] * n])[0] == [(0, n, 1)]
    nested = (["a"] * 100 + ["b"]) * (n // 101)
    found = periodic_runs._grouped([nested])[0]
    assert (0, len(nested), 101) in found and len(found) == n // 101 + 1
    noise = [str(x) for x in np.random.default_rng(3).integers(0, 3000, n)]
    assert periodic_runs._grouped([noise])[0] == []


def test_hashes_may_err(monkeypatch):
    """With hashes that call all stretches alike, the words themselves decide."""
    monkeypatch.setattr(periodic_runs, "mix", lambda x: np.ones_like(x) if x.dtype == np.uint64 else x)
    words = list("abcabcabcabcx") + list("zzzzzz")
    ids = np.array([ord(c) for c in words])
    assert [r for r in periodic_runs.runs(ids) if r in brute_runs(words)] == periodic_runs.runs(ids)
