"""The ten operators against brute force, on small tables with nulls, ties, repeated rows and clashing names."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest

from estatelake.llm import langid, line_dedup, mixing, near_dedup, packing, quality, secret_scan, substring_dedup, topk, warc
from estatelake.llm.common import scratch

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, size long, kept string"
WORDS = [f"wo{i}rd" for i in range(400)]


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(WORDS[i] for i in rng.integers(0, len(WORDS), n))


def rows():
    base = prose(1, 120)
    near = base.split()
    near[60] = "changed"
    out = [(1, base), (2, base), (3, " ".join(near)), (4, None), (5, ""), (6, "  \n\n "), (7, "Common line of text here\nown seven\ncommon LINE of text here "), (8, "own eight\nCommon line of text here"), (9, prose(2, 3000)), (None, "a text without an id, " + prose(3, 60)), (10, "kurz"), (10, "kurz"), (11, prose(4, 5)), (12, prose(5, 200) + " " + base)]
    return [(i, t, ["en", "de", None][k % 3], ["b", "a", None][k % 3], len(t or ""), 99, 98, "clash") for k, (i, t) in enumerate(out)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_lines(docs, empty):
    key = lambda x: x.strip(" \t\n\v\f\r").translate(str.maketrans(line_dedup.UPPER, line_dedup.LOWER))
    held = collections.defaultdict(set)
    for i, t, *_ in rows():
        for x in (t or "").split("\n"):
            held[key(x)].add(2**63 if i is None else i)
    want = []
    for i, t, *_ in rows():
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or len(held[key(x)]) < 2 or min(held[key(x)]) == (2**63 if i is None else i)]
        want.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    got = [(r["row"]["doc_id"], r["n_lines"], r["n_dropped"], r["kept"]) for r in line_dedup.dedup_lines(docs, keys_per_shard=2, probes_per_task=3).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert line_dedup.dedup_lines(empty).count() == 0


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(0).integers(0, 2**63, 50_000).astype(np.uint64))
    found = line_dedup.PerfectHash.build(keys)
    assert sorted(found.slots(keys)) == list(range(len(keys)))


def test_language(spark, empty):
    made = {"xx": "abc", "yy": "xyz", "zz": "mno"}
    rng = np.random.default_rng(0)
    data = [(i, " ".join("".join(rng.choice(list(made[lang]), 4)) for _ in range(20)), lang) for i in range(300) for lang in [list(made)[i % 3]]] + [(900, None, "xx"), (901, "123 !!", "yy"), (None, "abc abc", None)]
    out = {r["doc_id"]: r for r in langid.identify(spark.createDataFrame(data, "doc_id long, text string, lang string")).collect()}
    assert all(out[i]["lang_pred"] == lang and 0 <= out[i]["score"] <= 1 for i, _, lang in data[:300])
    assert out[900]["lang_pred"] == out[901]["lang_pred"] == "und" and out[None]["lang_pred"] == "xx"
    assert all(out[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, *_ in data[:300])
    assert langid.identify(empty).count() == 0


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.tokenizer_path())
    want = collections.Counter()
    for i, t, *_ in rows():
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        at, first = 0, len(ids) % 2048 or 2048
        for n, end in enumerate(range(first, len(ids) + 1, 2048)):
            want[i, n, at, end - at, zlib.crc32(np.array(ids[at:end], "<u4").tobytes())] += 1
            at = end
    got = packing.pack(docs).collect()
    assert collections.Counter(tuple(r)[:5] for r in got) == want
    bins = collections.defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        b.sort()
        assert [o for o, _ in b] == np.cumsum([0, *(n for _, n in b)])[:-1].tolist() and sum(n for _, n in b) <= 2048
    assert packing.pack(empty).count() == 0


def test_plan_is_best_fit_decreasing():
    rng = np.random.default_rng(3)
    for _ in range(100):
        cap = int(rng.integers(2, 60))
        lengths = sorted(rng.integers(1, cap + 1, rng.integers(0, 80)).tolist(), reverse=True)
        left = []
        for n in lengths:
            fit = [(r, i) for i, r in enumerate(left) if r >= n]
            if fit:
                left[min(fit)[1]] -= n
            else:
                left.append(cap - n)
        runs = packing.plan(dict(collections.Counter(lengths)), cap)
        used = collections.Counter()
        for n, c in collections.Counter(lengths).items():
            own = [r for r in runs.tolist() if r[0] == n]
            for rank in range(c):
                _, first_rank, first, _, each = [r for r in own if r[1] <= rank][-1]
                used[first + (rank - first_rank) // each] += n
        assert sorted(used.values()) == sorted(cap - r for r in left)


def test_word_cache_is_the_tokenizer():
    from tokenizers import Tokenizer

    tok, encode = Tokenizer.from_file(packing.tokenizer_path()), packing.encoder(packing.tokenizer_path())
    for text in ["", "  a  b\n\n c\t\td ", "x\xa0 y  z", "don't  we'll\r\n\x0b12 34  ", "a 　 b", " \n ", " \x1c a", "èé 漢字 \U0001f600 x"]:
        assert np.frombuffer(encode(text), "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids, repr(text)


def tlv(tag, body):
    n = len(body)
    return bytes([tag]) + (bytes([n]) if n < 128 else bytes([0x81, n]) if n < 256 else bytes([0x82, n >> 8, n & 255])) + body


def test_secrets(spark, empty):
    import base64

    key = base64.b64encode(tlv(0x30, tlv(2, b"\0") + b"".join(tlv(2, bytes(range(1, 65))) for _ in range(4)))).decode()
    j = lambda x: base64.urlsafe_b64encode(x).decode().rstrip("=")
    token = j(b'{"alg":"HS256"}') + "." + j(b'{"sub":"1"}') + ".sig"
    texts = ["é password: secret: abcdefghijk Token='abcdefgh' AKIA1234567890AB AKIA12 " + "0a" * 16, None, "", f"x {key} y", f"x {key[:-8]}AAAA y", f"a {token} b eyJabc.def.ghi", "paſſword=abcdefghijk"]
    out = {r["doc_id"]: r for r in secret_scan.scan_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, t in enumerate(texts):
        spans = []
        for kind, (pattern, flags, least) in {"assign": (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A, None), "access": (r"AKIA[A-Z0-9]+", 0, 16), "hex": (r"[0-9a-f]+", 0, 32)}.items():
            spans += [(m.start(), kind, m.end()) for m in re.finditer(pattern, t or "", flags) if (len(m[2]) >= 8 if least is None else len(m[0]) >= least)]
        spans.sort(key=lambda x: (x[0], ("assign", "access", "hex").index(x[1])))
        text = ",".join(f"{k}:{a}:{b}" for a, k, b in spans)
        assert out[i]["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert set(filter(None, text.split(","))) <= set(out[i]["spans"].split(","))
    assert out[3]["spans"].startswith("der64:2:") and out[4]["spans"] == "" and out[5]["spans"] == f"token:2:{2 + len(token)}"
    assert secret_scan.scan_secrets(empty).count() == 0


def test_near_duplicates(docs, empty):
    out = {(r["doc_id"]): r for r in near_dedup.NearDuplicates(docs).documents().collect()}
    assert out[1]["class_id"] == out[2]["class_id"] == out[3]["class_id"] == 1 and out[1]["class_size"] == 3
    assert [out[i]["kept"] for i in (1, 2, 3)] == [True, False, False]
    assert all(out[i]["class_id"] == i and out[i]["kept"] for i in (4, 5, 6, 9, 11, 12))
    kept = near_dedup.keep_one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.filter("doc_id is not null").collect()) == [1, 4, 5, 6, 7, 8, 9, 10, 11, 12]
    assert near_dedup.NearDuplicates(empty).documents().count() == 0


def test_near_duplicates_match_brute_force(spark):
    rng = np.random.default_rng(5)
    data = []
    for family in range(6):
        base = prose(100 + family, 80).split()
        for _ in range(25):
            copy = list(base)
            for at in rng.integers(0, 80, rng.integers(0, 6)):
                copy[at] = f"new{rng.integers(1 << 30)}"
            data.append((len(data), " ".join(copy)))
    found = near_dedup.NearDuplicates(spark.createDataFrame(data, "doc_id long, text string"))
    weigh = near_dedup.Weights(*found.shared.value)
    sets = [weigh(t) for _, t in data]
    part = list(range(len(data)))

    def top(x):
        while part[x] != x:
            x = part[x]
        return x

    for a in range(len(data)):
        for b in range(a):
            if near_dedup.similarity(sets[a], sets[b]) >= 0.8:
                x, y = sorted((top(a), top(b)))
                part[y] = x
    got = {r["doc_id"]: r["class_id"] for r in found.documents().collect()}
    assert sum(got[i] != top(i) for i in got) <= 2  # bands miss a link in a thousand


def test_quality(docs, empty):
    out = {r["doc_id"]: r for r in quality.judge(docs).collect()}
    assert out[4]["n_words"] == 0 and out[4]["base_failed"] and not out[4]["kept"] and out[1]["kept"]
    for i, t, *_ in rows():
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        win = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        n = collections.Counter(win)
        assert out[i]["n_repeat_words"] == len({k + d for k, x in enumerate(win) if n[x] > 1 for d in range(3)})
        assert out[i]["n_words"] == len(w) and out[i]["word_chars"] == sum(map(len, w))
    assert quality.count_text("a b c a b c #\na b\na b \na b\n\n")[2:4] == (1, 1)
    assert quality.judge(empty).count() == 0


def test_top_k(spark):
    rng = np.random.default_rng(1)
    data = [(int(i), rng.normal(size=8).round(1).tolist()) for i in range(400)] + [(500, None), (550, [float("nan")] * 8), (600, [1.0, None] + [0.0] * 6), (650, []), (None, [1.0] * 8), (700, [1.0, 2.0]), (750, [3.0, 4.0]), (100, data_tie := [0.5] * 8), (101, data_tie)]
    v = topk.integers(spark.createDataFrame(data, "vec_id long, embedding array<float>"), "vec_id", "embedding")
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in topk.search(v.filter("id % 50 = 0"), v, shard_rows=64, block_queries=3).collect()}
    ok = [(i, [int(np.floor(np.float64(np.float32(x)) * 256)) for x in e]) for i, e in data if i is not None and e and all(x is not None and np.isfinite(x) for x in e)]
    for q, e in ok:
        if q % 50 == 0 and q != 100:
            best = sorted((-sum(a * b for a, b in zip(e, f, strict=True)), i) for i, f in ok if i != q and len(f) == len(e))[:5]
            assert [got.get((q, k + 1)) for k in range(len(best))] == [(i, -s) for s, i in best]
    assert topk.search(v.filter("id < 0"), v).count() == 0


def test_warc(spark):
    big = "<p>same page</p>" * 20
    data = [(5, "http://B.example.org/x?y=1", big), (3, "http://b.example.org/x", big), (9, None, big), (4, "https://a.example.com:8080/", "small"), (6, "http://a.example.com/", "small"), (7, "u\r\nX: 1", None), (None, "http://z.org/", big), (8, "http://ü.org/ä", "ä" * 200), (3, "http://b.example.org/x", big)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string").repartition(3)
    folder = scratch(spark, "warc-test")
    index = warc.merge_runs(warc.write_archives(pages, folder, archive_bytes=300), range_rows=3, sample=5)
    out = sorted(warc.read_archives(index, folder, with_payload=True).collect(), key=lambda r: r["position"])
    assert [r["position"] for r in out] == list(range(len(data))) and [r["url_key"] for r in out] == sorted(r["url_key"] for r in out)
    for r in out:
        html = next((h for i, _, h in data if i == r["page_id"]), None) or ""
        assert r["payload_bytes"] == len(html.encode()) and r["payload_digest"] == hashlib.sha256(html.encode()).hexdigest()
        again = html == big and r["page_id"] != 3
        assert (r["record_type"], r["refers_to"], r["payload"]) == (("revisit", 3, b"") if again else ("response", None, html.encode()))
    none = pages.filter("page_id < 0")
    assert warc.read_archives(warc.merge_runs(warc.write_archives(none, folder)), folder).count() == 0


def test_loser_tree():
    rng = np.random.default_rng(2)
    for _ in range(100):
        runs = [sorted(rng.integers(0, 30, rng.integers(0, 9)).tolist()) for _ in range(rng.integers(1, 10))]
        assert list(warc.LoserTree([iter(r) for r in runs], lambda x: (x,))) == sorted(sum(runs, []))


def test_passages(spark, docs, empty):
    shared = prose(50, 60)
    data = [(i, f"{prose(1000 + i, 100)} {shared if i < 4 else ''} {prose(2000 + i, 50 + i)}") for i in range(12)] + [(20, None), (21, ""), (22, "of " * 300), (23, "x " + "of " * 200), (24, prose(7, 30) * 2)]
    out = substring_dedup.repeated_passages(spark.createDataFrame(data, "doc_id long, text string"), shard_digests=50).collect()
    by = collections.defaultdict(list)
    for r in out:
        by[r["doc_id"]].append(r)
    assert set(by) == {0, 1, 2, 3, 22, 23}
    for i in range(4):
        (r,) = by[i]
        assert dict(data)[i][r["start"] : r["end"]] in dict(data)[0] and r["first_doc_id"] == 0 and r["dropped"] == (i > 0)
    assert {r["doc_id"] for r in substring_dedup.repeated_passages(docs).collect()} >= {1, 2, 3, 12}
    assert substring_dedup.repeated_passages(empty).count() == 0


def test_mixing(docs, empty):
    out = mixing.mix(docs).collect()
    assert len(out) == len(rows()) and all(0 <= r["copies"] <= 3 for r in out)
    sizes = collections.Counter()
    for _, t, _, source, *_ in rows():
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    weights = {"a": 5, "b": 2, None: 1}
    left, target = dict(sizes), {}
    goal, total = dict.fromkeys(sizes, 0.0), sum(sizes.values())
    while left:
        free = total - sum(target.values())
        goal = {s: free * weights[s] / sum(weights[x] for x in left) for s in left}
        over = [s for s in left if goal[s] > 3 * sizes[s]]
        if not over:
            target |= goal
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            del left[s]
    for r in out:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
    taken = mixing.take_copies(docs)
    assert taken.columns == docs.columns and taken.count() == sum(r["copies"] for r in out)
    assert mixing.mix(empty).count() == 0 and mixing.take_copies(empty).count() == 0


def test_pipeline(spark, docs, tmp_path):
    import corpus_pipeline

    kept = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept, str(tmp_path)).cache()
        assert out.columns == kept.columns, name
        kept = out
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, str(tmp_path))
    assert packed.filter("piece = 0").count() == kept.count()
