"""Tables of a folder that change together: a run's new files count once a log entry names them.

A table lies in directories of one partition value each. A run writes the
partitions that it touches under a new name and then adds one entry to the log,
``log/<number>.json``: for each table, which directory holds which partition. Readers
take the newest entry, so they see all of a run or nothing of it, and a run that is
lost half way leaves files that no entry names. An entry is renamed into place and
never replaced: of two writers that commit the same number the second raises. A run
that is in the log isn't run again.
"""

from __future__ import annotations

import json
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class VersionedTables:
    """``parts``: the column that each table is partitioned by."""

    def __init__(self, spark: SparkSession, folder: str, parts: dict[str, str]):
        self.spark, self.folder, self.parts = spark, folder.rstrip("/"), parts

    def _fs(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def _names(self, path: str) -> list[str]:
        fs, at = self._fs(path)
        return [x.getPath().getName() for x in fs.listStatus(at)] if fs.exists(at) else []

    def entries(self) -> list[int]:
        """Numbers of the log's entries, oldest first."""
        return sorted(int(x.removesuffix(".json")) for x in self._names(f"{self.folder}/log") if x.endswith(".json") and not x.startswith((".", "_")))

    def entry(self, number: int | None = None) -> dict:
        """An entry (the newest if no number is given): run, number, summary, runs, tables."""
        held = self.entries()
        if not held:
            return {"number": 0, "run": None, "summary": {}, "runs": {}, "tables": {}}
        fs, at = self._fs(f"{self.folder}/log/{number or held[-1]:012d}.json")
        stream = fs.open(at)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def read(self, table: str, schema: StructType, only: list[str] | None = None, number: int | None = None) -> DataFrame:
        """A table's rows; with ``only``, those of these partition values, and no other file is read."""
        held = self.entry(number)["tables"].get(table, {})
        return self.rows({value: p for value, p in held.items() if only is None or value in only}, schema)

    def rows(self, held: dict[str, str], schema: StructType) -> DataFrame:
        """The rows of an entry's directories, or of what ``write`` returned."""
        paths = [p for _, p in sorted(held.items())]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def values(self, table: str) -> list[str]:
        return sorted(self.entry()["tables"].get(table, {}))

    def write(self, table: str, rows: DataFrame) -> dict[str, str]:
        """Writes rows to new directories and returns which one holds which partition value; nobody sees them before ``commit``."""
        part, path = self.parts[table], f"{self.folder}/{table}/{uuid.uuid4().hex}"
        rows.withColumn("_part", F.coalesce(F.col(part).cast("string"), F.lit("null"))).write.partitionBy("_part").parquet(path)
        return {unquote(x.removeprefix("_part=")): f"{path}/{x}" for x in self._names(path) if x.startswith("_part=")}

    def commit(self, since: dict, run: str, written: dict[str, dict[str, str]], emptied: dict[str, list[str]], summary: dict) -> dict:
        """Adds the entry after ``since``. ``emptied``: partitions that have no rows any more."""
        tables = {t: {v: p for v, p in held.items() if v not in emptied.get(t, [])} for t, held in since["tables"].items()}
        for table, dirs in written.items():
            tables[table] = tables.get(table, {}) | dirs
        made = {"number": since["number"] + 1, "run": run, "summary": summary, "runs": since["runs"] | {run: summary}, "tables": tables}
        final = f"{self.folder}/log/{made['number']:012d}.json"
        fs, at = self._fs(f"{self.folder}/log/.{uuid.uuid4().hex}")
        stream = fs.create(at, False)
        try:
            stream.write(bytearray(json.dumps(made).encode()))
        finally:
            stream.close()
        _, to = self._fs(final)
        if fs.exists(to) or not fs.rename(at, to):
            raise RuntimeError(f"another run has committed entry {made['number']}")
        return made
