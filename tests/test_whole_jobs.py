"""Jobs that once did less than the whole."""

import inspect
import time
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from estatelake.operators import features, history, search, streets
from estatelake.plans.streets import SAID
from estatelake.streaming import listings as streams

SF = "/root/testdata/sf0.001"


def test_user_directory(spark):
    users = spark.createDataFrame([(1, "Ann", "x@a.org", 10), (2, "Bob", "ann@b.org", 30), (3, "Cyd", None, 20), (4, None, "joANNe@c.org", 40), (5, "Hanna", "h@d.org", 10)], "id int, name string, email string, created int")
    subs = spark.createDataFrame([(2, "active")], "id int, status string")
    found = lambda **more: [(r["id"], r["status"], r["total"]) for r in search.user_directory(users, subs, "id", email="email", newest=["created", "id"], **more).collect()]
    assert found(q="aNN") == [(4, None, 4), (2, "active", 4), (5, None, 4), (1, None, 4)]
    assert found(q="ann", limit=2, offset=1) == [(2, "active", 4), (5, None, 4)]
    assert found() == [(4, None, 5), (2, "active", 5), (3, None, 5), (5, None, 5), (1, None, 5)]
    with pytest.raises(ValueError, match="order"):
        search.user_directory(users, subs, "id", limit=1)


def test_directory_query_searches_all_customers(spark):
    customers = spark.read.parquet(f"{SF}/customer.parquet").collect()
    rows = entry.queries()["p14_user_directory"](spark, SF).collect()
    by_name = {c["c_custkey"] for c in customers if "7" in c["c_name"]}
    want = sorted((c["c_custkey"] for c in customers if "7" in c["c_name"] or "7" in str(c["c_custkey"] * 7)), reverse=True)
    assert [r["c_custkey"] for r in rows] == want and {r["total"] for r in rows} == {len(want)}
    assert by_name < set(want) and len(want) < len(customers)


def told(spark, rows):
    df = spark.createDataFrame([(i, *t) for i, t in enumerate(rows)], "i int, title string, content string")
    found = df.select("i", streets.street_of(F.col("title"), F.col("content")).alias("s")).orderBy("i").collect()
    return [(r["s"]["street"], r["s"]["house_number"], r["s"]["candidates"]) if r["s"] else None for r in found]


def test_streets_by_the_rules(spark):
    """Each text with what the rules say by hand."""
    want = [
        ((None, "dom, ulica Brezová 9"), ("Brezová", "9", ["Brezová"])),
        (("Námestie Baníkov 3", "ulica Brezová 9"), ("námestie Baníkov", "3", ["námestie Baníkov", "Baníkov"])),
        (("vila", "hneď pri Námestí Baníkov, LUXUS"), ("námestie Baníkov", None, ["námestie Baníkov", "Baníkov"])),
        (("ulica je tichá", "tá ul. nemá meno"), None),
        (("Zo", "ul. Ob"), None),
        (("ul. Ob 4, Brezová ulica", None), ("Brezová", None, ["Brezová"])),
        (("(Brezovej ulici)", ""), ("Brezovej", None, ["Brezova", "Brezovej"])),
        (("roh x-Bučinej ul. a parku", ""), ("Bučinej", None, ["Bučiná", "Bučina", "Bučinej"])),
        (("Na Pri Tejto ulici", ""), None),
        (("voľný Byt Na Hradskej ulici", ""), ("Hradskej", None, ["Hradská", "Hradska", "Hradskej"])),
        (("ulica Pod Lesom Malá. Veľká Záhrada 7", ""), ("Pod Lesom Malá", "7", ["Pod Lesom Malá"])),
        (("ulica Pod Lesom MALÁ 7a", ""), ("Pod Lesom", "7a", ["Pod Lesom"])),
        (("ULICA Dolná, ulicu Hornú 1/2", ""), ("Hornú", "1/2", ["Hornú"])),
        (("ul. A.B.C. Rybára 12345", ""), ("A.B.C. Rybára", "1234", ["A.B.C. Rybára"])),
        (("ul.\n\tDlhé  Hony 5", ""), ("Dlhé Hony", "5", ["Dlhé Hony"])),
        (("Ulička, Ulicami Starými", ""), None),
        (("Skratka ul.", ""), ("Skratka", None, ["Skratka"])),
        (("", ""), None),
        ((None, None), None),
    ]
    assert told(spark, [t for t, _ in want]) == [w for _, w in want]


def test_streets_of_hostile_texts(spark):
    """Two megabytes of capitals, of dashes and of half-said words, each in linear time."""
    n = 300_000
    texts = ["Aa " * n + "ulici", "A-" * (3 * n), "ul. " * (n + n), "B" * (6 * n) + " ulica", "ul. " + "Cc " * n + "7", "Dd, ul.\n" * (n // 2), "Nám. " * n + "x", "Ee" + " " * (4 * n) + "Ff ulica"]
    started = time.monotonic()
    got = told(spark, [(t, None) for t in texts])
    assert time.monotonic() - started < 120
    assert [g and (len(g[0]), g[1]) for g in got] == [(3 * n - 1, None), None, None, (6 * n, None), (3 * n - 1, "7"), None, (12, None), (5, None)]


def test_planted_streets_are_found(spark):
    rows = entry.queries()["x1_streets_in_texts"](spark, SF).collect()
    by_said = {}
    for r in rows:
        by_said.setdefault((r["doc_id"] % len(SAID), r["doc_id"] // len(SAID) % 4 < 2), set()).add((r["street"], r["candidates"], r["house_number"]))
    for i, (_, street, spelt, number) in enumerate(SAID):
        assert by_said[i, True] == {(street, spelt and "|".join(spelt), number)} and by_said[i, False] == {(None, None, None)}


def test_training_query_uses_all_trees(spark, monkeypatch):
    asked, real = [], features.train

    def few(frame, **options):
        asked.append(options)
        return real(frame, rounds=1)

    monkeypatch.setattr(features, "train", few)
    assert entry.queries()["m3_train_and_score"](spark, SF).count() > 0
    assert asked == [{}] and inspect.signature(real).parameters["rounds"].default == 200


def in_batches(spark, folder, batches, late, zone):
    """The rows of the streamed job, a micro-batch for each list of (listing, day, hour, event, price); and all observations."""
    kind, parts = "source string, listing_id long, scraped_at timestamp_ntz, event_id long, price double", []
    for i, rows in enumerate(batches):
        df = spark.createDataFrame([("s", k, datetime(2026, 1, d, h), e, p) for k, d, h, e, p in rows], kind).withColumn("day", F.to_date("scraped_at"))
        parts.append(df.withColumn("scraped_at", F.col("scraped_at").cast("timestamp")) if zone else df)
        parts[-1].coalesce(1).write.mode("append").parquet(f"{folder}/in")
        changes = streams.price_changes(spark.readStream.schema(parts[-1].schema).parquet(f"{folder}/in"), **({"late": late} if late else {}))
        changes.writeStream.foreachBatch(lambda out, n: out.write.mode("append").parquet(f"{folder}/out")).outputMode("append").option("checkpointLocation", f"{folder}/c").trigger(availableNow=True).start().awaitTermination()
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return sorted(map(tuple, spark.read.parquet(f"{folder}/out").collect())), out


def test_late_and_same_day_rows_match_batch(spark, folder):
    batches = [[(1, 1, 8, 1, 100.0), (2, 1, 8, 2, 5.0)], [(1, 4, 8, 3, 120.0), (2, 2, 9, 4, 6.0)], [(1, 2, 8, 5, 90.0), (2, 2, 7, 6, 9.0), (1, 4, 6, 7, 77.0)], [(1, 4, 20, 8, 130.0), (2, 3, 8, 9, None)], [(3, 28, 8, 10, 1.0), (2, 5, 8, 11, 6.0)]]
    got, obs = in_batches(spark, folder, batches, "5 days", True)
    batch = history.price_changes(history.day_snapshots(obs)).select("source", "listing_id", "day", "old_price", "new_price")
    assert got == sorted(map(tuple, batch.collect())) == [("s", 1, date(2026, 1, 2), 100.0, 90.0), ("s", 1, date(2026, 1, 4), 90.0, 130.0), ("s", 2, date(2026, 1, 2), 5.0, 6.0)]


def test_late_row_meets_the_price_before_its_day(spark, folder):
    got, _ = in_batches(spark, folder, [[(1, 1, 8, 1, 100.0)], [(1, 4, 8, 2, 120.0)], [(1, 2, 8, 3, 100.0)], [(1, 5, 8, 4, 120.0)]], None, False)
    assert got == [("s", 1, date(2026, 1, 4), 100.0, 120.0)]


def test_search_by_the_url_where_no_deal_type_is_stored(spark):
    rows = [(1, "buy", "x", 1), (2, None, "http://x/Prodej-bytu", 1), (3, None, "http://x/predaj", 1), (4, None, "http://x/prenajom", 1), (5, "rent", "http://x/predaj", 1), (6, None, None, 1), (7, "sale", None, 1)]
    df = spark.createDataFrame(rows, "id int, deal_type string, url string, price int")
    found = lambda kind: sorted(r["id"] for r in search.search_listings(df, deal_type=kind).collect())
    assert found("buy") == found("sale") == [1, 2, 3, 7] and found("rent") == [4, 5]


def test_saved_listings_and_benchmark_filters(spark):
    saved = spark.createDataFrame([(1, 10, 5), (1, 11, 9), (2, 12, 7), (1, 99, 8)], "user_id int, id int, saved_at int")
    assert [r["id"] for r in search.saved_listings(saved, spark.createDataFrame([(10,), (11,), (12,)], "id int"), 1).collect()] == [11, 10]
    bench = spark.createDataFrame([("p", 2024, 1, "new", "avg", "A"), ("p", 2024, 1, "old", "avg", "A"), ("p", 2024, 1, "new", "avg", "B"), ("o", 2023, 1, "new", "avg", "A")], "period string, year int, quarter int, segment string, metric string, city string")
    assert search.benchmark_rows(bench, segment="new", metric="avg", city="A").count() == 1
