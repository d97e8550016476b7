"""WARC archives with a globally ordered capture index.

Writing: each task writes its pages as gzipped WARC records into archives of
bounded size in the shared folder and returns the archive's index entries,
sorted by URL key, timestamp and id: one sorted run for each archive. A task
that is run again writes archives of new names; the index knows only those of
the run that Spark committed.

Merging: the runs' entries are dealt to ranges of keys of about RANGE_ROWS entries
(by the whole key, so that one URL may span several; Spark samples the bounds
from all runs). A range's part of each run comes in the run's order, and a loser
tree merges the parts. Ranges follow each other, so the merged entries are in
global order.

Reading: the entries of an archive meet in one task, which reads the archive
from front to back, parses each record and checks payloads against digests.

Of pages with equal payloads of at least MIN_REVISIT bytes, the one with the
smallest id is a response, others are revisits that refer to it and hold its
HTTP head only. That is found on digests; payloads go through one shuffle, by
page, so equal payloads don't meet.

Cases: null html is an empty payload; a null URL is an empty target; a null id
is the largest and comes back null; rows that repeat the smallest id are all
responses; an empty table gives no rows; control characters in URLs are
percent-encoded in headers; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import itertools
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime, timedelta
from urllib.parse import quote, urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from estatelake.llm.common import NULL_ID, id_key, keep, scratch, table

MIN_REVISIT = 100
ARCHIVE_BYTES = 64 << 20
RANGE_ROWS = 200_000
#: Keys that Spark samples from each partition to find the ranges' bounds, and ranges whose counts are sent to all tasks.
RANGE_SAMPLE, MOST_BROADCAST = 100, 1 << 20
#: The first capture's time where the table has no time: a page follows its id by seconds, within ten years.
EPOCH, SPAN = datetime(2024, 1, 1, tzinfo=UTC), 315_360_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = b"\r\n"


# --- records ----------------------------------------------------------------


def url_key(url: str) -> str:
    """Host parts from the last to the first, then path and query: pages of a site sort together."""
    try:
        parts = urlsplit(url.strip())
        host = (parts.hostname or "").lower()
        port = f":{parts.port}" if parts.port else ""
    except ValueError:
        return url
    host = host.removeprefix("www.")
    return ",".join(reversed(host.split("."))) + port + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")


def record(kind: str, name: str, url: str, date: str, digest: str, payload: bytes, refers_to: str | None) -> bytes:
    """One WARC record, gzipped by itself."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{name}>", f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}", f"WARC-Date: {date}", f"WARC-Payload-Digest: sha256:{digest}"]
    if kind == "revisit":
        head += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    out = zlib.compressobj(3, wbits=31)
    return out.compress("\r\n".join(head).encode() + CRLF + CRLF + block + CRLF + CRLF) + out.flush()


def parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers (names in lower case) and payload of a gzipped record."""
    raw = zlib.decompress(data, wbits=31)
    head, _, rest = raw.partition(CRLF + CRLF)
    fields = lambda lines: {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    first, *lines = head.decode().split("\r\n")
    warc = fields(lines)
    size = int(warc["content-length"])
    if first != "WARC/1.1" or rest[size:] != CRLF + CRLF:
        raise ValueError("not a WARC record")
    http, _, payload = rest[:size].partition(CRLF + CRLF)
    return warc, fields(http.decode().split("\r\n")[1:]), payload


# --- writing ----------------------------------------------------------------

ENTRY = "url_key string, ts string, page_id long, archive string, start long, length long"
KEYS = ("url_key", "ts", "page_id")


def _page_name(page_id: int | None) -> str:
    return f"urn:page:{'' if page_id is None else page_id}"


def _write(folder: str, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, at = pafs.FileSystem.from_uri(folder)
        fs.create_dir(at, recursive=True)
        out, path, size, entries = None, "", 0, []

        def closed() -> Iterator[pa.RecordBatch]:
            out.close()
            entries.sort(key=lambda e: (e[0], e[1], NULL_ID if e[2] is None else e[2]))
            for i in range(0, len(entries), 10_000):
                part = list(zip(*entries[i : i + 10_000], strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip([*part, range(i, i + len(part[0]))], [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()], strict=True)], [*(x.split()[0] for x in ENTRY.split(", ")), "seq"])

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    path, size, entries = f"{at}/{uuid.uuid4().hex}.warc.gz", 0, []
                    out = fs.open_output_stream(path, compression=None)
                page, url = row["page_id"], row["url"] or ""
                date = (EPOCH + timedelta(seconds=(page or 0) % SPAN)).strftime("%Y-%m-%dT%H:%M:%SZ")
                refers = None if row["first"] is None else _page_name(row["first"])
                data = record("response" if refers is None else "revisit", _page_name(page), url, date, row["digest"], row["payload"], refers)
                out.write(data)
                entries.append((url_key(url), date, page, path.rpartition("/")[2], size, len(data)))
                size += len(data)
                if size >= archive_bytes:
                    yield from closed()
                    out = None
        if out is not None:
            yield from closed()

    return run


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_revisit: int = MIN_REVISIT, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes the archives; returns the index entries, as sorted runs (``archive`` names the run, ``seq`` the place in it)."""
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    rows = pages.select(id_key(id_col).alias("key"), F.col(url_col).alias("url"), payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    ids = keep(rows.filter(F.length("payload") >= min_revisit).select("key", "digest"), "warc-digests")
    groups = ids.groupBy("digest").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    revisits = ids.join(groups, "digest").filter("key <> first").select("key", "digest", "first").distinct()
    # A null id stays out of the records' names and comes back as null.
    told = rows.join(revisits, ["key", "digest"], "left").select(F.when(F.col("key") != NULL_ID, F.col("key")).alias("page_id"), "url", "digest", "payload", "first")
    return keep(told.mapInArrow(_write(folder, archive_bytes), ENTRY + ", seq long"), "warc-runs")


# --- the index --------------------------------------------------------------


class LoserTree:
    """Merges sorted runs: each inner node keeps the loser of its game, so the next item costs one game a level."""

    def __init__(self, runs: list[Iterator], key):
        self.runs, self.key = runs, key
        self.n = max(1, len(runs))
        self.items: list = [None] * self.n
        self.heads: list = [None] * self.n
        for i in range(len(runs)):
            self._advance(i)
        self.losers = [-1] * self.n
        self.winner = self._play(1) if self.n > 1 else 0

    def _advance(self, i: int) -> None:
        item = next(self.runs[i], None)
        self.items[i], self.heads[i] = item, None if item is None else (*self.key(item), i)

    def _less(self, i: int, j: int) -> bool:
        a, b = self.heads[i], self.heads[j]
        return b is None or (a is not None and a < b)

    def _play(self, node: int) -> int:
        """Winner of the games under a node; leaves follow the inner nodes 1..n-1."""
        if node >= self.n:
            return node - self.n
        a, b = self._play(2 * node), self._play(2 * node + 1)
        won, lost = (a, b) if self._less(a, b) else (b, a)
        self.losers[node] = lost
        return won

    def __iter__(self) -> Iterator:
        while self.items[self.winner] is not None:
            yield self.items[self.winner]
            self._advance(won := self.winner)
            node = (won + self.n) // 2
            while node:
                if self._less(self.losers[node], won):
                    self.losers[node], won = won, self.losers[node]
                node //= 2
            self.winner = won


def _key(e: tuple) -> tuple:
    return e[0], e[1], NULL_ID if e[2] is None else e[2]


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A range's entries, sorted by (run, seq), to their merged order."""
    names = [x.split()[0] for x in ENTRY.split(", ")]
    kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
    at, runs = TaskContext.get().partitionId(), {}
    for batch in batches:
        for entry in zip(*(batch[x].to_pylist() for x in names), strict=True):
            runs.setdefault(entry[3], []).append(entry)
    nth = 0
    for part in itertools.batched(LoserTree([iter(x) for x in runs.values()], _key), 10_000):
        yield pa.RecordBatch.from_arrays([pa.array([at] * len(part), pa.int64()), pa.array(range(nth, nth + len(part)), pa.int64()), *(pa.array(x, t) for x, t in zip(zip(*part, strict=True), kinds, strict=True))], ["range", "nth", *names])
        nth += len(part)


def merge_runs(runs: DataFrame, range_rows: int = RANGE_ROWS, sample: int = RANGE_SAMPLE) -> DataFrame:
    """The entries of all runs with ``position``, their place in the order of (url_key, ts, page_id), from 0."""
    spark, setting = runs.sparkSession, "spark.sql.execution.rangeExchange.sampleSizePerPartition"
    ranges, before = max(1, -(-runs.count() // range_rows)), spark.conf.get(setting)
    spark.conf.set(setting, sample)
    try:
        dealt = runs.withColumn("key", id_key("page_id")).repartitionByRange(ranges, "url_key", "ts", "key").sortWithinPartitions("archive", "seq")
        merged = keep(dealt.mapInArrow(_merge, "range long, nth long, " + ENTRY), "warc-index")
    finally:
        spark.conf.set(setting, before)
    counts = merged.groupBy(F.col("range").alias("of")).agg(F.count(F.lit(1)).alias("n"))  # a row for each range
    starts = counts.select("of", F.coalesce(F.sum("n").over(Window.orderBy("of").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    starts = F.broadcast(starts) if ranges <= MOST_BROADCAST else starts
    return merged.join(starts, F.col("range") == F.col("of")).select((F.col("before") + F.col("nth")).alias("position"), *[x.split()[0] for x in ENTRY.split(", ")])


# --- reading ----------------------------------------------------------------

RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, url_key string, capture_time string, position long"


def _read(folder: str, with_payload: bool):
    def number(name: str) -> int | None:
        digits = name.strip("<>").rpartition(":")[2]
        return int(digits) if digits else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, at = pafs.FileSystem.from_uri(folder)
        opened, file, place = None, None, 0
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary())
        names = [*(x.split()[0] for x in RECORD.split(", ")), "payload"]
        width = len(names) - (not with_payload)
        for batch in batches:
            for begin in range(0, batch.num_rows, 1000):
                out = []
                for row in batch.slice(begin, 1000).to_pylist():
                    if row["archive"] != opened or row["start"] < place:
                        if file:
                            file.close()
                        opened, file, place = row["archive"], fs.open_input_stream(f"{at}/{row['archive']}", compression=None, buffer_size=1 << 20), 0
                    if row["start"] > place:
                        file.read(row["start"] - place)
                    data = file.read(row["length"])
                    place = row["start"] + row["length"]
                    warc, http, payload = parse(data)
                    digest = warc["warc-payload-digest"].removeprefix("sha256:")
                    kind = warc["warc-type"]
                    if kind == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != int(http["content-length"])):
                        raise ValueError(f"{row['archive']}, {row['start']}: the payload isn't what its digest says")
                    out.append((number(warc["warc-record-id"]), int(http["content-length"]), digest, kind, number(warc["warc-refers-to"]) if kind == "revisit" else None, warc["warc-target-uri"], row["url_key"], warc["warc-date"], row["position"], payload)[:width])
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=False)], names[:width])
        if file:
            file.close()

    return run


def read_archives(index: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """A row for each record of the index, as its archive has it."""
    by_file = index.repartition("archive").sortWithinPartitions("archive", "start")
    return by_file.mapInArrow(_read(folder, with_payload), RECORD + ", payload binary" * with_payload)


def op8_warc(spark, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "warc")
    index = merge_runs(write_archives(table(spark, sf_dir, "pages"), folder))
    return read_archives(index, folder).drop("url", "capture_time")


