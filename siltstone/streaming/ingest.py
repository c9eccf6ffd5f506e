"""Streams: only new files are read, the checkpoint is the watermark."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from siltstone.operators.keys import without_keys
from siltstone.operators.mapping import MappingRow
from siltstone.operators.silver import build_silver
from siltstone.plans.layered import apply_batch
from siltstone.sources.tables import HistoryTable, read_if_there


def file_stream(spark: SparkSession, path: str, schema, *, pattern: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """New parquet files of a folder, as they arrive."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def _start(writer, trigger: str) -> StreamingQuery:
    if trigger == "available":
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()


def ingest(stream: DataFrame, path: str, checkpoint: str, *, trigger: str = "10 minutes", partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Write a stream to parquet exactly once. `trigger="available"` takes what is there and stops."""
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _start(writer, trigger)


def stream_silver(stream: DataFrame, mapping: Sequence[MappingRow], *, rules: str = "") -> DataFrame:
    """The batch expressions on a stream: every flag column, no look at the data, no dedup.

    Strategies that need the whole table (means, medians, neighbours) have no
    meaning on a stream and raise.
    """
    for row in mapping:
        if row.strategy in ("fill_mean", "fill_median", "ffill_bfill_else_drop"):
            raise ValueError(f"{row.strategy} on {row.source_column} needs the whole table")
    return build_silver(stream, mapping, rules=rules, fixed_schema=True, dedup=False, counted=False).df


def stream_distinct(stream: DataFrame, event_time: str, keys: Sequence[str], delay: str = "10 minutes") -> DataFrame:
    """One row per key within the delay; state older than it is dropped."""
    timed = stream.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return timed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


LATE_SCHEMA = "query string, batch bigint, late bigint"


class LateRows(StreamingQueryListener):
    """Keeps a table of the rows that came after the watermark had passed them and were dropped.

    Spark itself keeps the last 100 progress reports of a query; this adds each
    report that tells of late rows to a table, one folder for a batch, so that a
    batch that runs again replaces its own count. Register it with
    `spark.streams.addListener` before the query starts.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        report = event.progress
        late = sum(op.numRowsDroppedByWatermark for op in report.stateOperators)
        if late:
            line = self.spark.createDataFrame([(str(report.id), report.batchId, late)], LATE_SCHEMA)
            line.coalesce(1).write.mode("overwrite").json(f"{self.path}/{report.id}-{report.batchId}")

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.id))

    def wait(self, query: StreamingQuery, seconds: float = 60.0) -> None:
        """Until all reports of a query that has ended are in the table; they come after its end."""
        until = time.monotonic() + seconds
        while str(query.id) not in self.ended:
            if time.monotonic() > until:
                raise TimeoutError(f"no word of the end of query {query.id}")
            time.sleep(0.05)

    def table(self) -> DataFrame:
        """(query, batch, late)."""
        found = read_if_there(lambda: self.spark.read.schema(LATE_SCHEMA).json(f"{self.path}/*"))
        return self.spark.createDataFrame([], LATE_SCHEMA) if found is None else found


def late_rows(query: StreamingQuery, kept: LateRows | None = None) -> int:
    """Rows dropped as late: of all batches with a `LateRows` table, else over the last 100 progress reports."""
    if kept is not None:
        total = kept.table().filter(F.col("query") == str(query.id)).agg(F.sum("late")).first()[0]
        return int(total or 0)
    return sum(op["numRowsDroppedByWatermark"] for report in query.recentProgress for op in report["stateOperators"])


def stream_history(
    stream: DataFrame, root: str, checkpoint: str, keys: Sequence[str], as_of, *,
    order_by: Sequence[str] = (), trigger: str = "10 minutes", repeated: str = "raise",
) -> StreamingQuery:
    """Merge every micro-batch into a history table; a repeated batch is recognised by its stream and number.

    `as_of` maps a batch number to the time its versions start. The stream's id
    is the one its checkpoint holds: another stream into the same table, or
    this one with a new checkpoint, counts from 0 again without being skipped.
    `repeated` is that of `apply_batch`.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        stream_id = spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]
        label = f"stream-{stream_id}-batch-{batch_id}"
        apply_batch(HistoryTable(spark, root), batch, keys, as_of(batch_id), label=label, order_by=order_by, repeated=repeated)

    return _start(stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(merge), trigger)


def serve(batch_view: DataFrame, speed_view: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch and speed layer as one table; where both know a key, the speed layer's row counts."""
    return without_keys(batch_view, speed_view, keys).unionByName(speed_view, allowMissingColumns=True)
