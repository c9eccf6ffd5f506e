"""Tables that may not exist yet, and tables of which only what changes is written."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.digest import quoted
from siltstone.sources.versions import State, VersionLog


def read_if_there(read: Callable[[], DataFrame]) -> DataFrame | None:
    """The table, or nothing where its path does not exist; other errors are raised."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _schema(text: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(text))


class VersionedTable:
    """A parquet table replaced as a whole while it is being read.

    Each write goes to a new folder; a publication in `_versions` makes it the
    current one. A write that fails leaves the table as it was. One writer at a
    time; folders of old versions are left to the owner.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.log = VersionLog(spark, f"{self.root}/_versions")

    def latest(self) -> int | None:
        return self.log.latest()

    def has(self, label: str) -> bool:
        return self.log.has(label)

    def _new_folder(self) -> str:
        """Every attempt has a folder of its own, so none can harm what an earlier one wrote."""
        return f"data/{uuid.uuid4().hex}"

    def _parquet(self, schema: T.StructType, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*[f"{self.root}/{f}" for f in folders])
        return rows.select(*[F.col(quoted(c)) for c in schema.names])

    def read(self) -> DataFrame | None:
        state = self.log.state()
        if state is None:
            return None
        return self._parquet(_schema(state.entries["schema"]), [state.entries["folder"]])

    def replace(self, df: DataFrame, label: str) -> int:
        folder = self._new_folder()
        df.write.parquet(f"{self.root}/{folder}")
        return self.log.publish(label, {"folder": folder, "schema": df.schema.json()})


class PartedTable(VersionedTable):
    """A table that grows by parts, each named by the load that wrote it.

    `replace` starts anew with one part. `add_part` writes one folder and then
    publishes it; a part of the same name is replaced, so a repeated load counts
    once, and readers have the old part until the new one is whole. Parts may bring
    columns of their own, which are null in others, and wider types of a column,
    in which the others are read. Types without a common one raise before anything
    is written.
    """

    def _parts(self, state: State) -> dict[str, dict]:
        return {e.removeprefix("part/"): json.loads(b) for e, b in state.entries.items() if e.startswith("part/")}

    def parts(self) -> list[str]:
        state = self.log.state()
        return sorted(self._parts(state)) if state else []

    def _whole(self, schemas: Iterable[T.StructType]) -> T.StructType:
        """All columns, each in the type that holds every part's."""
        empty = [self.spark.createDataFrame([], s) for s in schemas]
        whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), empty).schema
        for part in empty:
            for f in part.schema.fields:
                kind = whole[f.name].dataType
                if kind != f.dataType and isinstance(f.dataType, T.StringType) != isinstance(kind, T.StringType):
                    raise ValueError(f"column {f.name} is {f.dataType.simpleString()} in one part and {kind.simpleString()} in others")
        return T.StructType([T.StructField(f.name, f.dataType) for f in whole.fields])

    def _union(self, parts: dict[str, dict]) -> DataFrame:
        by_schema: dict[str, list[str]] = {}
        for _, p in sorted(parts.items()):
            by_schema.setdefault(p["schema"], []).append(p["folder"])
        whole = self._whole([_schema(s) for s in by_schema])

        def aligned(schema: str, folders: list[str]) -> DataFrame:
            rows = self._parquet(_schema(schema), folders)
            there = {f.name for f in rows.schema.fields}
            return rows.select(*[(F.col(quoted(f.name)) if f.name in there else F.lit(None)).cast(f.dataType).alias(f.name) for f in whole.fields])

        return reduce(lambda a, b: a.unionByName(b), [aligned(s, f) for s, f in by_schema.items()])

    def read(self) -> DataFrame | None:
        state = self.log.state()
        return None if state is None else self._union(self._parts(state))

    def read_part(self, part: str) -> DataFrame:
        found = self._parts(self.log.state())[part]
        return self._parquet(_schema(found["schema"]), [found["folder"]])

    def replace(self, df: DataFrame, label: str) -> int:
        before = self.log.state()
        gone = {e: None for e in before.entries} if before else {}
        return self._publish(df, "full", label, gone, before)

    def add_part(self, df: DataFrame, part: str) -> int:
        before = self.log.state()
        if before:
            others = [p["schema"] for name, p in self._parts(before).items() if name != part]
            self._whole([*map(_schema, dict.fromkeys(others)), df.schema])
        return self._publish(df, part, part, {}, before)

    def _publish(self, df: DataFrame, part: str, label: str, gone: dict, before: State | None) -> int:
        folder = self._new_folder()
        df.write.parquet(f"{self.root}/{folder}")
        body = json.dumps({"folder": folder, "schema": df.schema.json()})
        return self.log.publish(label, {**gone, f"part/{part}": body}, before=before)


STATE, BUCKET = "_state", "_bucket"


class KeyedTable(VersionedTable):
    """A table with one row per key, in folders by a hash of the key.

    A batch rewrites the folders of its own keys; the publication names them and
    leaves the others as they are. The number of folders is fixed by the first
    write; choose it so that a folder is a few files.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        super().__init__(spark, root)
        self.buckets = buckets
        self.last: str | None = None  # folder of the last write of this object

    def _bucket(self, keys: Sequence[str], buckets: int) -> Column:
        return F.pmod(F.xxhash64(*[F.col(quoted(k)) for k in keys]), F.lit(buckets)).cast("int")

    def schema(self) -> T.StructType | None:
        state = self.log.state()
        return None if state is None else _schema(state.entries["schema"])

    def touched(self, batch: DataFrame, keys: Sequence[str]) -> list[int]:
        """Folders that hold keys of the batch, which may have them in narrower types; at most as many as there are."""
        state = self.log.state()
        kinds = _schema(state.entries["schema"])
        typed = batch.select(*[F.col(quoted(k)).cast(kinds[k].dataType).alias(k) for k in keys])
        return [r[0] for r in typed.select(self._bucket(keys, int(state.entries["buckets"]))).distinct().collect()]

    def current(self, buckets: Sequence[int] | None = None) -> DataFrame | None:
        """The rows that hold now, all or those of some folders."""
        state = self.log.state()
        if state is None:
            return None
        wanted = None if buckets is None else {f"current/{b}" for b in buckets}
        folders = [b for e, b in sorted(state.entries.items()) if e.startswith("current/") and (wanted is None or e in wanted)]
        return self._parquet(_schema(state.entries["schema"]), folders)

    def read(self) -> DataFrame | None:
        return self.current()

    def write(self, rows: DataFrame, label: str, keys: Sequence[str], buckets: Sequence[int] | None = None, ended: Column | None = None) -> int:
        """Publish `rows` as all rows of `buckets` (None: of the table); rows that `ended` are kept beside them for good."""
        before = self.log.state()
        n = int(before.entries["buckets"]) if before else self.buckets
        folder = self._new_folder()
        state = F.lit("current") if ended is None else F.when(ended, F.lit("ended")).otherwise(F.lit("current"))
        dealt = rows.withColumn(STATE, state).withColumn(BUCKET, self._bucket(keys, n))
        dealt.write.partitionBy(STATE, BUCKET).parquet(f"{self.root}/{folder}")
        there = self.written(folder, rows.schema).select(STATE, BUCKET).distinct().collect()
        self.last = folder
        gone = range(n) if buckets is None else buckets
        entries: dict[str, str | None] = {f"current/{b}": None for b in gone if before and f"current/{b}" in before.entries}
        entries |= {f"current/{b}": f"{folder}/{STATE}=current/{BUCKET}={b}" for s, b in there if s == "current"}
        if any(s == "ended" for s, _ in there):
            entries[f"ended/{folder}"] = f"{folder}/{STATE}=ended"
        return self.log.publish(label, {**entries, "schema": rows.schema.json(), "buckets": str(n)}, before=before)


    def written(self, folder: str, schema: T.StructType) -> DataFrame:
        """What one write has put into its folder, with `_state` and `_bucket`."""
        parts = [T.StructField(STATE, T.StringType()), T.StructField(BUCKET, T.IntegerType())]
        return self.spark.read.schema(T.StructType([*schema.fields, *parts])).parquet(f"{self.root}/{folder}")


class HistoryTable(KeyedTable):
    """An SCD type 2 table whose batches rewrite the current rows of their own keys' folders.

    Versions a batch ends are written once, beside them, and never read for a merge.
    """

    def read(self) -> DataFrame | None:
        state = self.log.state()
        if state is None:
            return None
        folders = [b for e, b in sorted(state.entries.items()) if e.startswith(("current/", "ended/"))]
        return self._parquet(_schema(state.entries["schema"]), folders)
