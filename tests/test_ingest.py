"""Runs of the ingest job: repeated, half done, over late days, and from a stream of dumps."""

import json
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from estatelake.operators import ingest, merge
from estatelake.plans import ingests
from estatelake.plans.ingests import land, streamed_dumps
from estatelake.sources.versions import VersionedTables
from estatelake.streaming import listings as streams

SF = "/root/testdata/sf0.001"
ITEM = "source string, listing_id string, scraped_at timestamp_ntz, event_id long, price double, area double, deal_type string, category string, district string"


def items(spark, rows):
    return spark.createDataFrame([(s, k, datetime(2026, 1, d, h), n, p, 50.0, "buy", "house", "D") for n, (s, k, d, h, p) in enumerate(rows)], ITEM)


def stored(spark, store, name, *cols):
    held = store.entry()["tables"][name]
    return sorted(tuple(r) for r in spark.read.parquet(*held.values()).select(*cols).collect())


@pytest.fixture
def store(spark, folder):
    return VersionedTables(spark, f"{folder}/store", ingest.PARTS)


CHANGE = ["listing_id", "day", "old_price", "new_price"]


def test_two_dumps_the_second_twice(spark, store):
    first = items(spark, [("a", "1", 1, 8, 100.0), ("a", "1", 3, 8, 120.0), ("b", "9", 1, 8, 5.0), ("a", "1", 3, 7, 110.0)])
    second = items(spark, [("a", "1", 2, 8, 90.0), ("a", "2", 4, 8, 7.0), ("a", "1", 4, 8, 130.0), ("a", "1", 4, 9, None)])
    one = ingest.ingest(store, first, 0, "one", date(2026, 1, 3))
    assert one == {"n_new": 2, "n_updated": 2, "n_price_changes": 1, "n_failed": 0, "status": "succeeded"}
    assert stored(spark, store, "changes", *CHANGE) == [("1", date(2026, 1, 3), 100.0, 110.0)]  # of a day, what comes later in the dump
    two = ingest.ingest(store, second, 3, "two", date(2026, 1, 4))
    assert two == {"n_new": 1, "n_updated": 3, "n_price_changes": 1, "n_failed": 3, "status": "completed_with_errors"}
    tables = {t: stored(spark, store, t, "*") for t in ("state", "snapshots", "changes", "statistics")}
    assert [r[:4] for r in stored(spark, store, "changes", *CHANGE)] == [("1", date(2026, 1, 2), 100.0, 90.0), ("1", date(2026, 1, 3), 100.0, 110.0)]
    again = ingest.ingest(store, second, 3, "two again", date(2026, 1, 4))
    assert again == {**two, "n_new": 0, "n_updated": 4}
    assert {t: stored(spark, store, t, "*") for t in tables} == tables
    assert ingest.ingest(store, second, 3, "two", date(2026, 1, 4)) == two and len(store.entries()) == 3
    assert stored(spark, store, "state", "listing_id", "first_seen_at", "last_seen_at", "active") == [("1", datetime(2026, 1, 1, 8), datetime(2026, 1, 4, 9), True), ("2", datetime(2026, 1, 4, 8), datetime(2026, 1, 4, 8), True), ("9", datetime(2026, 1, 1, 8), datetime(2026, 1, 1, 8), True)]
    assert len(stored(spark, store, "raw", "run_id")) == 12


def test_only_touched_partitions_are_read_and_written(spark, store, monkeypatch):
    ingest.ingest(store, items(spark, [("a", "1", 1, 8, 1.0), ("b", "1", 2, 8, 2.0), ("b", "1", 5, 8, 3.0)]), 0, "one", date(2026, 1, 5))
    before, read = store.entry()["tables"], []
    real = VersionedTables.read
    monkeypatch.setattr(VersionedTables, "read", lambda self, table, schema, only=None, number=None: read.append((table, only)) or real(self, table, schema, only, number))
    ingest.ingest(store, items(spark, [("a", "2", 2, 8, 4.0)]), 0, "two", date(2026, 1, 6))
    after = store.entry()["tables"]
    assert after["state"]["b"] == before["state"]["b"] and after["state"]["a"] != before["state"]["a"]
    assert {d: after["snapshots"][d] == p for d, p in before["snapshots"].items()} == {"2026-01-01": True, "2026-01-02": False, "2026-01-05": True}
    assert ("state", ["a"]) in read and ("snapshots", ["2026-01-02"]) in read and ("snapshots", ["2026-01-01"]) in read
    rows = store.read("snapshots", spark.read.parquet(after["snapshots"]["2026-01-01"]).schema, ["2026-01-01"])
    assert all("/_part=2026-01-01/" in f for f in rows.inputFiles())


def test_a_run_that_fails_leaves_nothing(spark, store, monkeypatch):
    ingest.ingest(store, items(spark, [("a", "1", 1, 8, 1.0)]), 0, "one", date(2026, 1, 1))
    known = store.entry()
    with monkeypatch.context() as m:
        m.setattr(ingest, "market_statistics", lambda *a, **b: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ingest.ingest(store, items(spark, [("a", "1", 2, 8, 2.0)]), 0, "two", date(2026, 1, 2))
    assert store.entry() == known
    since = store.entry()
    store.commit(since, "x", {}, {}, {})
    with pytest.raises(RuntimeError, match="another run"):
        store.commit(since, "y", {}, {}, {})


def test_a_change_that_goes(spark, store):
    """The day's row comes again with the price of before, so its change is no more."""
    ingest.ingest(store, items(spark, [("a", "1", 1, 8, 1.0), ("a", "1", 2, 8, 2.0)]), 0, "one", date(2026, 1, 2))
    assert len(stored(spark, store, "changes", *CHANGE)) == 1
    ingest.ingest(store, items(spark, [("a", "1", 2, 9, 1.0)]), 0, "two", date(2026, 1, 2))
    held = store.entry()["tables"]["changes"]
    assert not held or spark.read.parquet(*held.values()).count() == 0


def test_repeated_keys_raise_and_const_policy(spark):
    stored_rows = spark.createDataFrame([(1, "a", False), (2, "b", False)], "k int, v string, active boolean")
    new = spark.createDataFrame([(2, "c", False), (3, "d", False)], "k int, v string, active boolean")
    merged = merge.merge_by_key(stored_rows, new, ["k"], {"active": ("const", True)}, unique=True)
    assert sorted(tuple(r) for r in merged.collect()) == [(1, "a", False, "kept"), (2, "c", True, "updated"), (3, "d", True, "inserted")]
    for t, u in ((stored_rows.union(stored_rows), new), (stored_rows, new.union(new))):
        with pytest.raises(ValueError, match="more than one row"):
            merge.merge_by_key(t, u, ["k"], unique=True)


def test_stream_of_dumps_is_the_batch_job(spark, folder):
    """Three landings, one batch given twice: the rows are those of three runs over the same files."""
    streamed = streamed_dumps(spark, SF)
    batch = VersionedTables(spark, f"{folder}/batch", ingest.PARTS)
    job = streams.ingest_batch(batch, datetime(2024, 2, 1), date(2024, 2, 1), "batch")
    for step in range(3):
        land(spark, SF, f"{folder}/landing", step)
        job(streams.dump_files(spark.read, f"{folder}/landing/step={step}/*"), step)
    assert len(streamed.entries()) == len(batch.entries()) == 3
    assert list(streamed.entry()["runs"].values()) == list(batch.entry()["runs"].values())
    assert sum(r["n_failed"] for r in batch.entry()["runs"].values()) > 0
    drop = lambda t: [F.col(c) for c in spark.read.parquet(*batch.entry()["tables"][t].values()).columns if c not in ("event_id", "scraped_at")]
    for t in ("state", "snapshots", "changes", "statistics"):
        assert stored(spark, streamed, t, *drop(t)) == stored(spark, batch, t, *drop(t))


def test_a_directory_holds_many_dumps_in_order(spark, folder, monkeypatch):
    """The stream lists each directory at every start; names have to be in the order of events, as later places overwrite earlier ones."""
    monkeypatch.setattr(ingests, "ITEMS", 10)
    monkeypatch.setattr(ingests, "SHELF", 30)
    land(spark, SF, f"{folder}/landing", 1)
    files = sorted(Path(folder, "landing").glob("step=1/*/*.txt"))
    dumps = [json.loads(f.read_text()) for f in files]
    times = [x["scrapedAt"] for d in dumps for x in d]
    n = spark.read.parquet(f"{SF}/events.parquet")
    wanted = [r[0] for r in n.filter("event_id % 3 = 1").orderBy("event_id").select(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")).collect()]
    assert times == wanted and len(files) == n.selectExpr("event_id div 10").distinct().count()
    assert len({f.parent for f in files}) == n.selectExpr("event_id div 300").distinct().count()


def test_days_and_items_are_written_once(spark, store, monkeypatch):
    """Few rows of a day are one file, whatever the tasks; only narrow tables are kept aside."""
    kept, real = [], ingest.keep
    monkeypatch.setattr(ingest, "keep", lambda df, name: kept.append(df.columns) or real(df, name))
    many = items(spark, [("a", str(i), 1 + i % 3, 8 + j, float(i + d)) for i in range(60) for j in range(2) for d in range(2)]).repartition(8)
    with_setting = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        ingest.ingest(store, many, 0, "one", date(2026, 1, 3))
        ingest.ingest(store, many.withColumn("price", F.col("price") + 1), 0, "two", date(2026, 1, 4))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", with_setting)
    assert {len([f for f in Path(p).glob("*.parquet")]) for p in store.entry()["tables"]["snapshots"].values()} == {1}
    assert all("deal_type" not in columns for columns in kept)


def test_quarantine_is_counted_in_one_pass(spark, folder, monkeypatch):
    """An item that no source claims is counted while the raw log is written, so no item is parsed for it again."""
    Path(folder, "in").mkdir()
    Path(folder, "in", "a.json").write_text(json.dumps([{"listingId": "1", "price": "5"}, {"title": "none"}, {"listingId": "2", "price": "6"}]))
    store, given = VersionedTables(spark, f"{folder}/store", ingest.PARTS), []
    real = ingest.ingest
    monkeypatch.setattr(ingest, "ingest", lambda store, items, failed, *rest: given.append(failed) or real(store, items, failed, *rest))
    streams.ingest_batch(store, datetime(2024, 2, 1), date(2024, 2, 1))(streams.dump_files(spark.read, f"{folder}/in"), 0)
    assert not isinstance(given[0], int) and store.entry()["summary"]["n_failed"] == 1 and store.entry()["summary"]["n_new"] == 2


def test_histories_are_dealt_by_listing_alone(spark):
    """Days of a listing are ranked where its history is, so nothing is shuffled by day."""
    rows = items(spark, [("a", "1", 2, 8, 2.0), ("a", "1", 3, 8, 3.0)]).withColumn("day", F.to_date("scraped_at"))
    stored_rows = items(spark, [("a", "1", 1, 8, 1.0), ("a", "1", 2, 9, 9.0), ("b", "1", 1, 8, 1.0)]).withColumn("day", F.to_date("scraped_at"))
    changes = ingest.as_of_changes(rows, stored_rows)
    plan = changes._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(source#" in plan and not any("day#" in x.split(")")[0] for x in plan.split("hashpartitioning(")[1:])
    assert sorted(tuple(r)[2:5] for r in changes.collect()) == [(date(2026, 1, 2), 1.0, 2.0), (date(2026, 1, 3), 2.0, 3.0)]
