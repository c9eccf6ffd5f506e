"""Small helpers for functions over Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def small_batches(spark: SparkSession) -> None:
    """Arrow batches by bytes: 10 000 long texts at once would fill a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def texts_of(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """UTF-8 bytes of a text column, null as empty."""
    column = batch.column(batch.schema.get_field_index(name))
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def slices(batch: pa.RecordBatch, name: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch whose texts have about `most_bytes`; one long text stands alone."""
    sizes = [len(x) for x in texts_of(batch, name)]
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most_bytes:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if sizes:
        yield batch.slice(start)


def with_columns(df: DataFrame, added: StructType, function: Callable[[pa.RecordBatch], dict[str, pa.Array]]) -> DataFrame:
    """`df` and the columns that `function` makes of each batch, in one pass without a shuffle."""
    clash = set(added.names) & set(df.columns)
    if clash:
        raise ValueError(f"columns in the way: {sorted(clash)}")
    schema = StructType([*df.schema.fields, *added.fields])
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())  # gives back what it frees; workers outlive a stage
        for batch in batches:
            made = function(batch)
            fields = [*batch.schema, *[pa.field(n, made[n].type) for n in added.names]]
            yield pa.RecordBatch.from_arrays([*batch.columns, *[made[n] for n in added.names]], schema=pa.schema(fields))

    return df.mapInArrow(run, schema)
