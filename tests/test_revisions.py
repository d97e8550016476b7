"""Streams that take back what late rows change, sketches that add up, and trees by hand."""

import math
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from estatelake.operators import features, history, search, sketches
from estatelake.streaming import listings as streams

DAY0 = datetime(2026, 1, 1)
ROW = "source string, listing_id long, scraped_at timestamp, event_id long, price double, landed_at timestamp"


def streamed(spark, folder, batches, keep_days):
    """All revisions, a micro-batch for each list of rows."""
    for rows in batches:
        df = spark.createDataFrame(rows, ROW).withColumn("day", F.to_date("scraped_at"))
        df.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        revisions = streams.revised_changes(spark.readStream.schema(df.schema).parquet(f"{folder}/in"), keep_days)
        revisions.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/c").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def batch_changes(spark, rows):
    obs = spark.createDataFrame(rows, ROW).withColumn("day", F.to_date("scraped_at"))
    return sorted(map(tuple, history.price_changes(history.day_snapshots(obs)).select("source", "listing_id", "day", "old_price", "new_price").collect()))


def test_rows_in_any_order_end_as_the_batch_job(spark, folder):
    rng = random.Random(1)
    seen = [("s", k, DAY0 + timedelta(days=d, hours=rng.randrange(24)), 100 * k + d, rng.choice([1.0, 2.0, 3.0, None])) for k in range(6) for d in range(12) for _ in range(rng.randrange(3))]
    seen = [(*x[:3], n, x[4]) for n, x in enumerate(seen)]
    rng.shuffle(seen)
    landed = DAY0 + timedelta(days=14)
    parts = [[(*x, landed + timedelta(hours=i)) for x in seen[i::4]] for i in range(4)]
    out = streamed(spark, folder, parts, 30)
    first = out.filter("op = 'retract'").count()
    assert first > 0 and out.filter("op = 'late'").count() == 0
    assert sorted(map(tuple, streams.settled(out).collect())) == batch_changes(spark, [x for p in parts for x in p])


def test_closed_days_are_late_and_stay(spark, folder):
    at = lambda d, h=8: DAY0 + timedelta(days=d, hours=h)
    parts = [
        [("s", 1, at(0), 1, 10.0, at(0, 9)), ("s", 1, at(1), 2, 11.0, at(1, 9))],
        [("s", 2, at(20), 3, 5.0, at(20, 9))],  # moves the watermark
        [("s", 1, at(0, 12), 4, 99.0, at(20, 12)), ("s", 1, at(19), 5, 12.0, at(20, 12))],  # the first is of a day that is over
        [("s", 1, at(18), 6, 11.5, at(20, 20))],  # comes late, but its day is open: the day after is revised
    ]
    out = streamed(spark, folder, parts, 5)
    assert sorted(map(tuple, streams.settled(out).collect())) == [("s", 1, date(2026, 1, 2), 10.0, 11.0), ("s", 1, date(2026, 1, 19), 11.0, 11.5), ("s", 1, date(2026, 1, 20), 11.5, 12.0)]
    assert [(r["listing_id"], r["day"], r["new_price"]) for r in out.filter("op = 'late'").collect()] == [(1, date(2026, 1, 1), 99.0)]
    assert [(r["day"], r["old_price"]) for r in out.filter("op = 'retract'").collect()] == [(date(2026, 1, 20), 11.0)]


class Held:
    """A state that is read and written in memory."""

    def __init__(self, watermark=0):
        self.get, self.exists, self.watermark = None, False, watermark

    def update(self, row):
        self.get, self.exists = row, True

    def getCurrentWatermarkMs(self):
        return self.watermark

    def setTimeoutTimestamp(self, at):
        assert at > self.watermark


def rows_of(days):
    import pandas as pd

    return pd.DataFrame({"day": [date(2026, 1, 1) + timedelta(days=d) for d in days], "scraped_at": pd.to_datetime([DAY0 + timedelta(days=d) for d in days]), "event_id": list(days), "price": [float(d % 7) for d in days]})


def test_state_is_bounded():
    """A thousand days of one listing: the states hold the open days alone."""
    state = Held()
    for d in range(1000):
        list(streams._changes(False, 60)(("s", 1), iter([rows_of([d])]), state))
        assert len(state.get[2]) <= 61
    state = Held()
    for d in range(1000):
        state.watermark = int((DAY0 - datetime(1970, 1, 1)).total_seconds() * 1000) + d * 86_400_000
        list(streams._revisions(10 * 86_400_000)(("s", 1), iter([rows_of([d])]), state))
        assert len(state.get[2]) <= 13


# --- sketches ---------------------------------------------------------------


@pytest.mark.parametrize("n", [50, 20_000])
def test_merged_sketches_against_all_rows(spark, n):
    rows = spark.range(n).select((F.col("id") % 9).cast("int").alias("day"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("source"), F.when(F.col("id") % 50 != 7, F.pow(F.rand(3) * 100, F.lit(2.0))).alias("price"), F.when(F.col("id") % 11 != 0, 10.0).alias("area"))
    rows = rows.withColumn("week", F.floor(F.col("day") / 4)).cache()
    held = sketches.day_sketches(rows, ["week", "source"], 800)
    weekly = sketches.merged(held, ["week"])
    index = {r["week"]: r for r in sketches.index_of(weekly).collect()}
    assert {w: r["n"] for w, r in index.items()} == {r["week"]: r["n"] for r in rows.filter("price IS NOT NULL").groupBy("week").agg(F.count("price").alias("n")).collect()}
    medians = weekly.select("week", sketches.quantile(F.col("price_sketch"), 0.5).alias("m"))
    errors = [r["error"] for r in sketches.rank_errors(rows, medians, ["week"], "price", "m").collect()]
    assert max(errors) < (0.01 if n > 1000 else 1e-9)
    size = held.agg(F.max(F.length("price_sketch"))).first()[0]
    assert size < 30_000
    told = sketches.distribution_of(weekly).collect()
    assert all(r["low"] <= r["p25"] <= r["p50"] <= r["p75"] <= r["high"] for r in told)


def test_sketches_of_nothing(spark):
    none = spark.createDataFrame([(1, "a", None, None), (1, "b", 5.0, None)], "day int, source string, price double, area double")
    got = sketches.index_of(sketches.day_sketches(none, ["source"])).collect()
    assert [tuple(r) for r in got] == [(1, "b", 5.0, None, 1)]
    assert sketches.distribution_of(sketches.day_sketches(none, ["source"])).count() == 0


# --- trees ------------------------------------------------------------------


def best_split(rows, names):
    """(gain, column, threshold) of the split that lessens the squared error most, by trying all."""
    error = lambda part: sum((y - sum(t for _, t in part) / len(part)) ** 2 for _, y in part) if part else 0.0
    best = (0.0, None, None)
    for name in names:
        values = sorted({x[name] for x, _ in rows})
        for low, high in zip(values, values[1:], strict=False):
            cut = (low + high) / 2
            left, right = [r for r in rows if r[0][name] <= cut], [r for r in rows if r[0][name] > cut]
            gain = error(rows) - error(left) - error(right)
            if gain > best[0] + 1e-9:
                best = (gain, name, cut)
    return best


def test_first_tree_by_hand(spark):
    """One tree of two levels: its splits and leaf values are those that lessen the error most."""
    rng = random.Random(2)
    data = [("a" if i % 2 else "b", float(20 + 5 * (i % 4)), [48.0, 48.5, 49.0][i % 3], math.exp(3 + 0.9 * (i % 2) + 0.1 * (i % 4) + rng.random() / 20)) for i in range(19)]  # fewer than 20: none is held out
    frame = spark.createDataFrame(data, "category string, area double, lat double, target double")
    model, _ = features.train(frame, rounds=1, depth=2, sample=1.0)
    tree = model.stages[-1].trees[0]
    names = ["category", "area", "lat"]
    rows = [({"category": "ab".index(c), "area": a, "lat": lat}, math.log1p(t)) for c, a, lat, t in data]

    def check(node, part, depth):
        split = node.split() if node.subtreeDepth() else None
        if split is None:
            assert node.prediction() == pytest.approx(sum(y for _, y in part) / len(part))
            return 1
        gain, name, cut = best_split(part, names)
        # Thresholds lie between values of all rows; what counts is which of these rows go left.
        assert names[split.featureIndex()] == name and [x[name] <= split.threshold() for x, _ in part] == [x[name] <= cut for x, _ in part]
        left, right = [r for r in part if r[0][name] <= cut], [r for r in part if r[0][name] > cut]
        return check(node.leftChild(), left, depth + 1) + check(node.rightChild(), right, depth + 1)

    assert check(tree._call_java("rootNode"), rows, 0) == 4


def test_requests_take_the_market_only_if_they_give_none_of_it(spark):
    kind = "source string, listing_id int, deal_type string, category string, locality string, district string, layout string, price double, area double, active boolean, stat_date date"
    rows = [("s", i, "buy", "house", "L", "D", "2+kk", 100.0 + i, 10.0, True, date(2026, 1, 1)) for i in range(3)]
    held = spark.createDataFrame(rows, kind)
    from estatelake.operators import market

    stats = market.market_statistics(held, market.DAILY).withColumn("stat_date", F.lit("2026-01-01").cast("date"))
    asked = spark.createDataFrame([(1, "house", "L", "D", "2+kk", None), (2, "house", "X", "D", "9+1", None), (3, "house", "D", None, "2+kk", None), (4, "house", "L", "D", "2+kk", 5.0), (5, "land", "Q", "Q", None, None)], "id int, category string, locality string, district string, layout string, median_price double")
    got = {r["id"]: (r["n"], r["median_price"], r["context"], r["district"]) for r in features.with_market(asked, "sale_price", stats, held).collect()}
    assert got == {1: (3.0, 101.0, "exact", "D"), 2: (3.0, 101.0, "district", "D"), 3: (3.0, 101.0, "district_layout", None), 4: (None, 5.0, None, "D"), 5: (None, None, None, "Q")}
    with pytest.raises(ValueError, match="no such target"):
        features.with_market(asked, "price", stats, held)


def test_pages_have_limits(spark):
    df = spark.range(600)
    assert search.page(df, ["id"], 500).count() == 500
    for limit, offset in ((0, 0), (501, 0), (5, -1)):
        with pytest.raises(ValueError, match="1 to 500"):
            search.page(df, ["id"], limit, offset)
    users = spark.range(300).select(F.col("id"), F.lit("x").alias("name"))
    none = spark.createDataFrame([], "id long, status string")
    assert [search.user_directory(users, none, "id", newest=["id"], limit=n, offset=-3).count() for n in (-5, 1, 9999)] == [1, 1, 200]
