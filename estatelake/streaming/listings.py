"""The batch jobs on streams of observations."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from datetime import date, timedelta
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from estatelake.operators import ingest as ingests
from estatelake.operators import sketches
from estatelake.operators.normalize import normalized_items
from estatelake.sources.io import dump_files, dump_items

CHANGES = "source string, listing_id long, day date, old_price double, new_price double"
_STATE = "sources array<string>, listings array<string>, days array<int>, stamps array<long>, events array<long>, prices array<double>, bases array<double>, closed array<int>, sizes array<int>"
#: Groups of listings: a call of Python takes a group, as one for each listing costs more than its rows do. Fixed for a checkpoint.
GROUPS = 1024
#: Without a watermark, days that a listing's state holds behind its newest.
KEEP_DAYS = 60
_EPOCH = date(1970, 1, 1)


def ingest(stream: DataFrame, batch_job: Callable[[DataFrame, int], None], checkpoint: str):
    """Runs a batch job on each arrival until all that has landed is done; start it again for what comes later."""
    return stream.writeStream.foreachBatch(batch_job).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ingest_dumps(spark, landing: str, store, run_time, stat_date, checkpoint: str, name: str = "stream", towns: DataFrame | None = None):
    """Whole dumps that land in a folder, through the normalising job and a run of the ingest job for each batch.

    A batch's run is named by its number, so a batch that is given again, as after
    a failure between its commit and the stream's own, is skipped. Items come in the
    order of landing time, path and place in the file.
    """
    return ingest(dump_files(spark.readStream, landing), ingest_batch(store, run_time, stat_date, name, towns), checkpoint)


def ingest_batch(store, run_time, stat_date, name: str = "stream", towns: DataFrame | None = None) -> Callable[[DataFrame, int], None]:
    """What a batch of dump files is given to."""

    def job(files: DataFrame, number: int) -> None:
        if (run := f"{name}-{number}") in store.entry()["runs"]:
            return
        items = dump_items(files).withColumn("place", F.struct("landed_at", "path", "nth"))
        # Items are parsed once: those of the quarantine are counted on the way to the raw log.
        seen = Observation(run)
        rows = ingests.listing_rows(normalized_items(items, run_time, towns=towns), F.col("place"))
        bad = F.col("source").isNull() | F.col("listing_id").isNull()
        ingests.ingest(store, rows.observe(seen, F.count_if(bad).alias("n_failed")).filter(~bad), seen, run, stat_date)

    return job


def daily_medians(stream: DataFrame, late: str = "2 days") -> DataFrame:
    """Median price and count of each day; a day closes when the watermark passes it."""
    timed = stream.withWatermark("scraped_at", late)
    return timed.groupBy(F.window("scraped_at", "1 day")).agg(F.percentile("price", 0.5).alias("median_price"), F.count(F.lit(1)).alias("n")).select(F.to_date("window.start").alias("day"), "median_price", "n")


def daily_sketches(stream: DataFrame, late: str = "2 days", k: int = sketches.K) -> DataFrame:
    """(day, n, price_sketch): a day's state is a sketch of its prices and its count, whatever their number; see ``sketches``."""
    timed = stream.withWatermark("scraped_at", late).filter("price IS NOT NULL")
    return timed.groupBy(F.window("scraped_at", "1 day")).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("price", F.lit(k)).alias("price_sketch")).select(F.to_date("window.start").alias("day"), "n", "price_sketch")


def without_repeats(stream: DataFrame, late: str = "2 days") -> DataFrame:
    """Each (source, listing, day, content) once within the watermark."""
    return stream.withWatermark("scraped_at", late).dropDuplicatesWithinWatermark(["source", "listing_id", "day", "content_hash"])


def _epoch_ms(day: int) -> int:
    """A day is over in each time zone: its end in UTC and half a day for zones west of it."""
    return (day + 1) * 86_400_000 + 43_200_000


def _stamps(times: pd.Series) -> pd.Series:
    """In microseconds: the column's own unit depends on the reader."""
    return times.astype("datetime64[us]" if times.dt.tz is None else "datetime64[us, UTC]").astype("int64")


def _grouped(timed: DataFrame, groups: int, *columns: str):
    """Rows by group; each row names its listing, whose id is a text, as pandas has no whole numbers with nulls."""
    group = F.pmod(F.xxhash64("source", "listing_id"), F.lit(groups)).cast("int").alias("group")
    return timed.select(group, "source", F.col("listing_id").cast("string").alias("listing"), *columns).groupBy("group")


def _known(values: pd.Series) -> pd.Series:
    return values.astype(object).where(values.notna(), None)


def _names(key: tuple, rows: pd.DataFrame) -> Iterable[tuple]:
    """(source, listing) of each row; the call's key where it has the rows of one listing."""
    return zip(_known(rows["source"]), _known(rows["listing"]), strict=True) if "listing" in rows else repeat(key, len(rows))


class _Days:
    """A listing's state: the last observation of each open day, the last price before them, and the newest closed day."""

    def __init__(self, base: float | None = None, closed: int | None = None, held: Iterable[tuple] = ()):
        self.base, self.closed = base, closed
        self.open = {d: (at, event, price) for d, at, event, price in held}

    def take(self, d: int, new: tuple[int, int, float | None]) -> bool:
        """False if the day is closed."""
        if self.closed is not None and d <= self.closed:
            return False
        if d not in self.open or new[:2] > self.open[d][:2]:
            self.open[d] = new
        return True

    def changes(self) -> list[tuple[int, float, float]]:
        """(day, old price, new price) of the open days."""
        out, old = [], self.base
        for d in sorted(self.open):
            price = self.open[d][2]
            if price is not None:
                if old is not None and price != old:
                    out.append((d, old, price))
                old = price
        return out

    def close(self, holds) -> None:
        """Folds the days for which ``holds(day)`` into the price before the open ones."""
        for d in sorted(d for d in self.open if holds(d)):
            price = self.open.pop(d)[2]
            self.base = self.base if price is None else price
            self.closed = d if self.closed is None else max(d, self.closed)


def _held(state: GroupState) -> dict[tuple, _Days]:
    """The states of a group's listings."""
    if not state.exists:
        return {}
    sources, listings, *held, bases, closed, sizes = state.get
    rows = zip(*held, strict=True)
    return {(s, i): _Days(base, last, [next(rows) for _ in range(n)]) for s, i, base, last, n in zip(sources, listings, bases, closed, sizes, strict=True)}


def _stored(held: dict[tuple, _Days]) -> tuple:
    days = held.values()
    rows = [(d, *x.open[d]) for x in days for d in sorted(x.open)]
    return ([k[0] for k in held], [k[1] for k in held], *[[r[i] for r in rows] for i in range(4)], [x.base for x in days], [x.closed for x in days], [len(x.open) for x in days])


def _arrived(key: tuple, batches: Iterator[pd.DataFrame]) -> dict[tuple, list[tuple]]:
    """(day, (time, event, price)) of the rows, by listing; none on a timeout."""
    out: dict[tuple, list[tuple]] = {}
    for rows in batches:
        if not rows.empty:
            for name, day, at, event, price in zip(_names(key, rows), rows["day"], _stamps(rows["scraped_at"]).tolist(), rows["event_id"].tolist(), _known(rows["price"]), strict=True):
                out.setdefault(name, []).append(((day - _EPOCH).days, (at, event, None if price is None else float(price))))
    return out


def _frame(rows: list[tuple], *more: str) -> pd.DataFrame:
    """rows: ((source, listing), day, the rest)."""
    number = lambda x: None if x is None else int(x)
    return pd.DataFrame([(name[0], number(name[1]), _EPOCH + timedelta(days=d), *rest) for name, d, *rest in rows], columns=["source", "listing_id", "day", "old_price", "new_price", *more], dtype=object)


def _worked(step, over_ms: int, timed: bool, *more: str):
    """``step(days, rows, now)`` for each listing of a group that has rows, or (``timed``) a day that is over by the watermark, ``over_ms`` after its end."""

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held, now, out = _held(state), state.getCurrentWatermarkMs() if timed else 0, []
        due = lambda x: _epoch_ms(min(x.open)) + over_ms
        arrived = _arrived(key, batches)
        late = {k for k, x in held.items() if x.open and due(x) <= now} if timed else set()
        for name in [*arrived, *(late - arrived.keys())]:
            days = held.setdefault(name, _Days())
            out += [(name, *x) for x in step(days, arrived.get(name, []), now)]
        state.update(_stored(held))
        if timed and (waiting := [due(x) for x in held.values() if x.open]):
            state.setTimeoutTimestamp(max(min(waiting), now + 1))
        yield _frame(out, *more)

    return run


def _changes(hold: bool, keep_days: int):
    def step(days: _Days, rows: list[tuple], now: int) -> list[tuple]:
        touched = set()
        for d, new in rows:
            if days.take(d, new) and days.open[d] is new:
                touched.add(d)
        if hold:
            touched = {d for d in days.open if _epoch_ms(d) <= now}
        out = [x for x in days.changes() if x[0] in touched]
        newest = max(days.open, default=0)
        days.close(lambda d: d in touched if hold else d < newest - keep_days)
        return out

    return _worked(step, 0, hold)


def price_changes(stream: DataFrame, late: str | None = None, keep_days: int = KEEP_DAYS, groups: int = GROUPS) -> DataFrame:
    """Changes of a day's last price against the last price strictly before its day, by listing.

    With ``late`` (as for a watermark; scraped_at is a timestamp) a day's row waits
    until the watermark has passed the day, so the rows are those of the batch job
    for all that comes in time; what comes later is dropped. Without it, rows come
    at once: a later observation of a day gives a further row, and a late day is
    compared with the price before it but doesn't revise the rows of days after it
    (``revised_changes`` does). The state then holds the ``keep_days`` days behind a
    listing's newest, and what is older than these is dropped. Here and below,
    ``groups`` is the number of groups of listings whose states are held together.
    """
    timed = stream.withWatermark("scraped_at", late) if late else stream
    timeout = GroupStateTimeout.EventTimeTimeout if late else GroupStateTimeout.NoTimeout
    return _grouped(timed, groups, "day", "scraped_at", "event_id", "price").applyInPandasWithState(_changes(bool(late), keep_days), CHANGES, _STATE, "append", timeout)


def _revisions(keep_ms: int):
    def step(days: _Days, rows: list[tuple], now: int) -> list[tuple]:
        # Closed by what had landed when the batch began, whether or not the listing's timer has run.
        over = lambda d: _epoch_ms(d) + keep_ms <= now
        kept = [x for x in days.changes() if not over(x[0])]
        days.close(over)
        if now:
            last = (now - keep_ms - 43_200_000) // 86_400_000 - 1
            days.closed = last if days.closed is None else max(days.closed, last)
        out = [(d, None, new[2], "late") for d, new in rows if not days.take(d, new)]
        after = days.changes()
        return out + [(*x, "retract") for x in kept if x not in after] + [(*x, "insert") for x in after if x not in kept]

    return _worked(step, keep_ms, True, "op")


def revised_changes(stream: DataFrame, keep_days: int, groups: int = GROUPS) -> DataFrame:
    """Price changes at once, with revisions: rows with ``op`` insert or retract, and late observations.

    stream: as for ``price_changes``, and landed_at (a timestamp), the time of
    arrival, which drives the watermark. A day stays open for ``keep_days`` after its
    end; an observation of an open day, in whatever order it comes, gives the rows
    that are new by it and takes back those that no longer hold, on its own day and
    on the next. A day that is over goes into the price before the open days, by a
    timer too, so the state of a listing is bounded by the open days. An observation
    of a day that is over gives a row ``late`` (its price as new_price).
    """
    timed = stream.withWatermark("landed_at", "1 second")
    return _grouped(timed, groups, "day", "scraped_at", "event_id", "price", "landed_at").applyInPandasWithState(_revisions(keep_days * 86_400_000), f"{CHANGES}, op string", _STATE, "append", GroupStateTimeout.EventTimeTimeout)


def settled(revisions: DataFrame) -> DataFrame:
    """The changes that hold after all revisions."""
    weight = F.when(F.col("op") == "insert", 1).when(F.col("op") == "retract", -1).otherwise(0)
    names = ["source", "listing_id", "day", "old_price", "new_price"]
    return revisions.groupBy(*names).agg(F.sum(weight).alias("n")).filter("n > 0").select(*names)


def in_time(stream: DataFrame, late_days: int) -> tuple[DataFrame, DataFrame]:
    """(rows in time, late rows): late are those that landed (``landed_at``) more than ``late_days`` after their day. Each goes to a table of its own."""
    late = F.date_diff(F.to_date("landed_at"), F.to_date("scraped_at")) > late_days
    return stream.filter(~late), stream.filter(late)


def _stale(days: int):
    span = days * 86_400_000_000

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        """The state: when each listing of the group was last seen, in microseconds."""
        parts = [pd.DataFrame(dict(zip(("source", "listing", "at"), state.get, strict=True)))] if state.exists else []
        before, now = len(parts[0]) if parts else 0, state.getCurrentWatermarkMs()
        parts += [pd.DataFrame({"source": rows["source"], "listing": rows["listing"], "at": _stamps(rows["scraped_at"])}) for rows in batches if not rows.empty]
        every = pd.concat(parts, ignore_index=True)
        who, at = every.groupby(["source", "listing"], dropna=False, sort=False).ngroup().to_numpy(), every["at"].to_numpy(dtype="int64")
        order = np.lexsort((at, who))
        who, at = who[order], at[order]
        last = np.append(who[1:] != who[:-1], True)
        gone = np.append(at[1:] - at[:-1] >= span, False) & ~last
        # What has no new row and is due by the watermark is given up; a listing with rows is waited for until the next batch.
        fresh = np.bincount(who, order >= before) > 0
        due = last & ~fresh[who] & ((at + span) // 1000 <= now)
        left, told = order[last & ~due], order[gone | due]
        if len(left):
            state.update(tuple(_known(every[c].iloc[left]).tolist() for c in ("source", "listing", "at")))
            state.setTimeoutTimestamp(max((int(every["at"].iloc[left].min()) + span) // 1000, now + 1))
        else:
            state.remove()
        yield pd.DataFrame({"source": _known(every["source"].iloc[told]), "listing_id": pd.Series([None if x is None else int(x) for x in _known(every["listing"].iloc[told])], dtype=object, index=told), "last_seen_at": every["at"].iloc[told].astype("int64").astype("datetime64[us]")})

    return run


def stale_listings(stream: DataFrame, days: int = 3, late: str = "0 days", groups: int = GROUPS) -> DataFrame:
    """(source, listing_id, last_seen_at): a row each time that a listing isn't seen for ``days``, once a later row or the watermark shows it."""
    timed = stream.withWatermark("scraped_at", late)
    return _grouped(timed, groups, "scraped_at").applyInPandasWithState(_stale(days), "source string, listing_id long, last_seen_at timestamp", "sources array<string>, listings array<string>, seen array<long>", "append", GroupStateTimeout.EventTimeTimeout)
