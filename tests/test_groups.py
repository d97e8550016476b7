"""Streams hold listings' states in groups: as many calls of Python as there are groups, and the rows of the batch jobs."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from estatelake.operators import history
from estatelake.streaming import listings as streams

DAY0 = datetime(2026, 1, 1)
ROW = "source string, listing_id long, scraped_at timestamp, event_id long, price double, landed_at timestamp"


def landed(n):
    """Ten days of n listings, of no source, and of no id; three of four are seen on each day but the seventh to ninth."""
    at = lambda k, d: DAY0 + timedelta(days=d, hours=(k + d) % 20)
    key = lambda k: (None if k % 7 == 0 else "s", None if k == 1 else 2**60 + k)
    return [(*key(k), at(k, d), 100 * k + d, None if (k + d) % 5 == 0 else float((k * d) % 3), at(k, d) + timedelta(hours=1)) for k in range(n) for d in range(10) if (k + d) % 4 and not (k % 2 and 6 <= d <= 8)]


def run(df, folder, spark, made):
    """Two batches; the rows and the number of states."""
    for i in range(2):
        df.filter(F.col("scraped_at") < F.lit(DAY0 + timedelta(days=5)) if i == 0 else F.col("scraped_at") >= F.lit(DAY0 + timedelta(days=5))).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        q = made(spark.readStream.schema(df.schema).parquet(f"{folder}/in")).writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/c").trigger(availableNow=True).start()
        q.awaitTermination()
    return spark.read.parquet(f"{folder}/out"), max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress)


def told(df):
    return sorted(map(repr, map(tuple, df.collect())))


@pytest.fixture(scope="module")
def obs(spark):
    return spark.createDataFrame(landed(60), ROW).withColumn("day", F.to_date("scraped_at"))


def test_changes_of_groups(spark, folder, obs):
    out, states = run(obs, folder, spark, lambda s: streams.price_changes(s, "20 days", groups=3))
    assert states == 3 and out.count() == 0  # no day is over
    out, states = run(obs, f"{folder}/b", spark, lambda s: streams.price_changes(s, "1 day", groups=3))
    closed = history.price_changes(history.day_snapshots(obs)).filter(F.expr("timestamp(day) + INTERVAL 36 HOURS") <= F.lit(max(x[2] for x in landed(60)) - timedelta(days=1)))
    assert states == 3 and out.count() > 50
    assert told(out) == told(closed.select("source", "listing_id", "day", "old_price", "new_price"))


def test_revisions_of_groups(spark, folder, obs):
    out, states = run(obs, folder, spark, lambda s: streams.revised_changes(s, 30, groups=3))
    assert states == 3
    assert told(streams.settled(out)) == told(history.price_changes(history.day_snapshots(obs)).select("source", "listing_id", "day", "old_price", "new_price"))


def test_stale_listings_of_groups(spark, folder, obs):
    out, states = run(obs, folder, spark, lambda s: streams.stale_listings(s, 3, groups=3))
    assert states == 3
    seen, want = {}, []
    for source, listing, at, *_ in sorted(landed(60), key=lambda r: r[2]):
        if (source, listing) in seen and at - seen[source, listing] >= timedelta(days=3):
            want.append((source, listing, seen[source, listing]))
        seen[source, listing] = at
    newest = max(seen.values())
    want += [(*k, at) for k, at in seen.items() if newest - at >= timedelta(days=3)]
    assert len(want) > 10 and told(out) == sorted(map(repr, want))
