"""Distinct counts by sketch."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def approx_distinct(col: Column, lg_k: int = 12) -> Column:
    """Distinct non-null values: exact for a few dozen, within about 2 % beyond (lg_k 12).

    One binary buffer of a few KB per column and task, whatever the type.
    Values go in as hashes, since the sketch takes no doubles and skips "".
    """
    return F.hll_sketch_estimate(F.hll_sketch_agg(F.when(col.isNotNull(), F.xxhash64(col)), F.lit(lg_k)))
