"""A log of publications: what a table consists of, changed by one small write at a time."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_SCHEMA = "version bigint, label string, entry string, body string"
SEGMENT = 64  # publications in a folder


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none where there is no folder."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(context._jsc.hadoopConfiguration())
    return sorted(x.getPath().getName() for x in files.listStatus(folder)) if files.exists(folder) else []


class State(NamedTuple):
    """The last publication and the entries that hold after it."""

    version: int
    label: str
    entries: dict[str, str]


class VersionLog:
    """Publications by number. Each sets or removes entries (name and body) and has a label.

    A publication is one folder of one small file; it is there as a whole or not at
    all, and until it is there the state before it holds. Publications are kept in
    segments. The first of a segment repeats all entries that hold and all labels,
    so the newest segment alone says everything: however many publications there
    were, at most `SEGMENT` files are read. Earlier segments are left to the owner.
    One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _newest(self) -> tuple[str, int] | None:
        """Segment and number of the last publication; a folder without a data file is a write that did not end."""
        for segment in reversed([n for n in folder_names(self.spark, self.path) if n.startswith("segment=")]):
            for version in reversed([n for n in folder_names(self.spark, f"{self.path}/{segment}") if n.startswith("version=")]):
                if any(n.startswith("part-") for n in folder_names(self.spark, f"{self.path}/{segment}/{version}")):
                    return segment, int(version.removeprefix("version="))
        return None

    def _lines(self, segment: str) -> DataFrame:
        reader = self.spark.read.schema(LOG_SCHEMA).option("mode", "FAILFAST").option("recursiveFileLookup", "true")
        return reader.json(f"{self.path}/{segment}")

    def state(self) -> State | None:
        """What holds now. Entries are as many as the table has folders."""
        newest = self._newest()
        if newest is None:
            return None
        segment, version = newest
        lines = self._lines(segment).filter((F.col("version") == version) | F.col("entry").isNotNull()).collect()
        entries: dict[str, str | None] = {}
        for line in sorted((x for x in lines if x["entry"] is not None), key=lambda x: x["version"]):
            entries[line["entry"]] = line["body"]
        label = next(x["label"] for x in lines if x["version"] == version and x["label"] is not None)
        return State(version, label, {e: b for e, b in entries.items() if b is not None})

    def latest(self) -> int | None:
        newest = self._newest()
        return newest[1] if newest else None

    def has(self, label: str) -> bool:
        newest = self._newest()
        return newest is not None and not self._lines(newest[0]).filter(F.col("label") == label).isEmpty()

    def publish(self, label: str, entries: Mapping[str, str | None], *, before: State | None = None) -> int:
        """Set entries (a body of None removes one) under the next number. before: the state, where it is known."""
        before = before or self.state()
        version = before.version + 1 if before else 1
        lines = [(version, label, None, None), *[(version, None, e, b) for e, b in entries.items()]]
        out = self.spark.createDataFrame(lines, LOG_SCHEMA)
        segment = (version - 1) // SEGMENT
        if before and (before.version - 1) // SEGMENT != segment:
            carried = [(before.version, None, e, b) for e, b in before.entries.items()]
            out = out.unionByName(self.spark.createDataFrame(carried, LOG_SCHEMA)).unionByName(self._lines(self._newest()[0]).filter("label IS NOT NULL"))
        out.coalesce(1).write.mode("overwrite").json(f"{self.path}/segment={segment:09}/version={version:012}")
        return version
