"""Each stage of the pipeline against a brute-force version, on rows with nulls, ties, repeats and clashing names."""

import collections
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from estatelake.llm import line_dedup, mixing, near_dedup, packing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, id int, kept string, size int, key int, rank int, deal string"
WORDS = {"en": "the house stands near river and old mill with garden where people walk".split(), "sk": "dom stoji pri rieke a stary mlyn ma zahradu kde ludia chodia po chodniku".split()}


def rows():
    rng, out = np.random.default_rng(0), []
    for i in range(80):
        lang = ["en", "sk"][i % 2]
        text = " ".join(f"{rng.choice(WORDS[lang])}{rng.integers(30) or ''}" for _ in range(int(rng.integers(20, 120))))
        if i % 5 == 0:
            text = f"A line that many documents hold\n{text}\nanother common line here"
        out.append((i, text, lang, ["b", "a", None][i % 3]))
    near = out[7][1].split()
    near[3] = "changed"
    out += [(100, out[6][1], "en", "a"), (101, " ".join(near), None, "a"), (102, None, "en", "b"), (103, "", None, None), (104, " \n\t", "sk", "a"), (105, "12345 !!", None, "a"), (None, "a house without a number, A line that many documents hold", None, "a"), (None, "another house\nA line that many documents hold", "en", None), (9, out[9][1], "sk", "b"), (106, "dom " * 3000, None, "b")]
    return [(i, t, lang, s, len(t or ""), "clash", 1, "k", 2, 3, 4, "d") for i, t, lang, s in out]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """name -> (rows before, rows after)."""
    docs, out = spark.createDataFrame(rows(), SCHEMA), {}
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.keep(stage(spark, docs, ""), name)
        if name != "pack":
            assert after.columns == docs.columns
        out[name] = docs.collect(), after.collect()
        docs = after
    return out


def bag(found):
    return collections.Counter(map(tuple, found))


def test_language_stage(stages):
    before, after = stages["language_id"]
    assert bag(after) == bag(r for r in before if re.search(r"[^\W\d_]", r["text"] or ""))


def test_line_stage(stages):
    before, after = stages["line_dedup"]
    key = lambda x: x.strip(" \t\n\v\f\r").translate(str.maketrans(line_dedup.UPPER, line_dedup.LOWER))
    held, order = collections.defaultdict(set), lambda i: 2**63 if i is None else i
    for r in before:
        for x in r["text"].split("\n"):
            held[key(x)].add(order(r["doc_id"]))
    want = []
    for r in before:
        text = "\n".join(x for x in r["text"].split("\n") if len(key(x)) < 10 or len(held[key(x)]) < 2 or min(held[key(x)]) == order(r["doc_id"]))
        want.append((r["doc_id"], text, r["lang"], r["source"], len(text), *r[5:]))
    assert bag(after) == bag(want) and any(len(a[1]) != len(b["text"]) for a, b in zip(want, before, strict=True))


def test_near_stage(stages, spark):
    before, after = stages["near_dedup"]
    weigh = near_dedup.Weights(near_dedup.document_frequencies(spark.createDataFrame([(r["text"],) for r in before], "text string")), len(before))
    texts = sorted({r["text"] for r in before if r["text"].split()})
    sets, part = [weigh(t) for t in texts], list(range(len(texts)))

    def top(x):
        return x if part[x] == x else top(part[x])

    for a in range(len(texts)):
        for b in range(a):
            if near_dedup.similarity(sets[a], sets[b]) >= 0.8:
                part[max(top(a), top(b))] = min(top(a), top(b))
    first = {}
    for r in before:
        if r["text"].split():
            at = top(texts.index(r["text"]))
            first[at] = min(first.get(at, (2**64,)), (2**63 if r["doc_id"] is None else r["doc_id"],))
    got = collections.Counter(r["doc_id"] for r in after if r["text"].split())
    assert got == collections.Counter(None if i == 2**63 else i for (i,) in first.values())
    assert sum(not r["text"].split() for r in after) == sum(not r["text"].split() for r in before)
    assert 100 not in got and 101 not in got and got[9] == 1


def test_mix_stage(stages, spark):
    before, after = stages["mix_sources"]
    took = mixing.mix(spark.createDataFrame([tuple(r) for r in before], SCHEMA)).collect()
    want = collections.Counter()
    for r in took:
        want[r["doc_id"], r["source"], r["size"]] += r["copies"]
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert collections.Counter((r["doc_id"], r["source"], size(r["text"])) for r in after) == +want
    assert set(map(tuple, after)) <= set(map(tuple, before))
    for source in {r["source"] for r in took}:
        own = [r for r in took if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 3 * max(r["size"] for r in own)


def test_pack_stage(stages):
    from tokenizers import Tokenizer

    before, after = stages["pack"]
    tok, want = Tokenizer.from_file(packing.tokenizer_path()), collections.Counter()
    for r in before:
        ids = [*tok.encode(r["text"] or "", add_special_tokens=False).ids, 0]
        at, first = 0, len(ids) % 2048 or 2048
        for n, end in enumerate(range(first, len(ids) + 1, 2048)):
            want[r["doc_id"], n, at, end - at, zlib.crc32(np.array(ids[at:end], "<u4").tobytes())] += 1
            at = end
    assert collections.Counter(tuple(r)[:5] for r in after) == want
    used = collections.Counter()
    for r in after:
        used[r["sequence_id"]] += r["length"]
    assert max(used.values()) <= 2048


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0


def test_mix_of_many_rows_without_an_id(spark):
    """50,000 rows without an id or text, 20,000 of one id: each row is taken by itself, and no key's rows stay together."""
    schema = "doc_id long, text string, source string"
    docs = spark.createDataFrame([(i, f"w{i} " * (1 + i % 3), "ab"[i % 2]) for i in range(2000)], schema)
    docs = docs.unionByName(spark.range(50_000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "CAST(NULL AS STRING) AS text", "'a' AS source")).unionByName(spark.range(20_000).selectExpr("7L AS doc_id", "concat('x', id % 5) AS text", "'b' AS source"))
    got = mixing.take_copies(docs, hot_rows=1000)
    counts = {(r["source"], r["k"]): r["n"] for r in got.groupBy("source", mixing.words(got["text"]).alias("k")).count().withColumnRenamed("count", "n").collect()}
    took = mixing.mix(docs).groupBy("source", "size").agg({"copies": "sum"}).collect()
    assert counts == {(r["source"], r["size"]): r["sum(copies)"] for r in took if r["sum(copies)"]}
    kept = {(r["source"], r["size"]): r["target"] / r["source_size"] for r in mixing.mix(docs).select("source", "size", "target", "source_size").distinct().collect()}
    assert all(abs(counts[k] - rate * {("a", 0): 50_000}.get(k, counts[k] / rate)) <= 1 for k, rate in kept.items() if k[1] == 0)


def test_language_stage_is_one_rule_for_all_lengths(spark):
    """Foreign words and letterless texts of one to two thousand characters: what counts is a letter."""
    labelled = [(i, " ".join(WORDS[x] * 3), x, "s") for i in range(60) for x in [["en", "sk"][i % 2]]]
    asked = [(1000 + n, unit * n, None, "s") for unit in ("Ωмегаж ", "7# ", "xq ") for n in (1, 20, 60, 67, 300)]
    asked = [(100 * k + i, t, x, s) for k, (i, t, x, s) in enumerate(asked)]
    docs = spark.createDataFrame(labelled + asked, "doc_id long, text string, lang string, source string")
    left = {r["doc_id"] for r in corpus_pipeline.identify_language(spark, docs, "").collect()}
    assert left == {i for i, t, *_ in labelled + asked if "7#" not in t}
