"""Gold tables with history (SCD type 2) and without (type 1)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.digest import row_digest
from siltstone.operators.keys import KEY, key_of, one_row_per_key, q, with_keys, without_keys

VERSION_COLUMNS = ("_valid_from", "_valid_to", "_is_current", "_change_hash", "_last_updated")


def change_hash(df: DataFrame, tracked: Sequence[str]) -> Column:
    """The digest by which a version is told from the next."""
    return row_digest(df, tracked)


def default_keys(columns: Sequence[str], keys: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """Keys and tracked columns; without keys the first column is the key."""
    chosen = list(keys) or list(columns[:1])
    missing = [k for k in chosen if k not in columns]
    if missing:
        raise ValueError(f"key columns not in the table: {missing}")
    return chosen, [c for c in columns if c not in chosen]


def _stamp(as_of) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("timestamp")


def first_load(batch: DataFrame, tracked: Sequence[str], as_of) -> DataFrame:
    """Every row is a current version from `as_of` on."""
    now = _stamp(as_of)
    return batch.select(
        "*",
        now.alias("_valid_from"),
        F.lit(None).cast("timestamp").alias("_valid_to"),
        F.lit(True).alias("_is_current"),
        change_hash(batch, tracked).alias("_change_hash"),
        now.alias("_last_updated"),
    )


def _same(current: DataFrame, columns: Sequence[str], old: Column, new: Column) -> Column:
    """The old and the new row agree in these columns; maps have no order, so they are compared as text."""
    parts = []
    for c in columns:
        sides = [old[c], new[c]]
        if "map<" in current.schema[c].dataType.simpleString():
            sides = [F.to_json(F.struct(side.alias(c))) for side in sides]
        parts.append(sides[0].eqNullSafe(sides[1]))
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def classify(
    current: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    *,
    order_by: Sequence[str] = (),
    snapshot: bool = False,
    repeated: str = "raise",
) -> DataFrame:
    """Current versions against a batch: `status`, the `old` version and the `new` row.

    Keys are compared null-safe and all together. A key only in gold has status
    `missing`. A batch must hold a key once, or name the columns that order it.

    A batch of changes is much smaller than gold. It is looked up from the
    current rows, which Spark does without moving them when the batch is small
    enough to broadcast by `spark.sql.autoBroadcastJoinThreshold`; otherwise it
    shuffles both. `snapshot=True` says that the batch is about as large as gold
    and joins the two sides once.

    A row has changed if a tracked column that both sides have holds another
    value, null-safe. So the order of the batch's columns, the session's time
    zone, a column the batch lacks and a new column without values change nothing.

    `repeated="pairs"` takes a batch that may hold a key more than once, as a full
    outer join does: an event for each pair of a current version and a batch row of
    the key. `starts` is then how many of the key's events are new or changed. All
    rows of a key are in one task. A key that comes several times and has several
    current versions raises. It takes no `order_by`.

    `repeated="sequence"` gives the same events. `place` numbers those of a key, the new
    or changed ones first and by their change hash, so that each can follow the one before.
    """
    _check_repeated(repeated, order_by)
    types = {f.name: f.dataType for f in current.schema.fields}
    # Values are compared in, and hashed as, the types and the order gold has.
    tracked = [c for c in current.columns if c in tracked] + [c for c in tracked if c not in types]
    aligned = batch.select(
        *[F.col(q(c)).cast(types[c]).alias(c) if c in types else F.col(q(c)) for c in batch.columns]
    )
    compared = [c for c in tracked if c in types and c in aligned.columns]
    single = one_row_per_key(aligned, keys, order_by, keep_key=True) if repeated == "raise" else aligned.select(key_of(keys), "*")
    single = single.withColumn("_change_hash", change_hash(single, [c for c in tracked if c in single.columns]))
    # Both sides hold one row per key, so no key can be hot in these joins.
    left = current.select(key_of(keys), F.struct(*[F.col(q(c)) for c in current.columns]).alias("old"))
    right = single.select(KEY, F.struct(*[F.col(q(c)) for c in single.columns if c != KEY]).alias("new"))
    if repeated != "raise":
        right = _rows_by_key(right, current, keys)
    if snapshot:
        pairs = left.join(right, KEY, "full_outer").select("old", "new")
    else:
        looked_up = left.join(right, KEY, "left").select("old", "new")
        known = with_keys(current.select(*[F.col(q(k)) for k in keys]), aligned, keys)
        fresh = right.join(known.select(key_of(keys)).distinct(), KEY, "left_anti")
        pairs = looked_up.unionByName(fresh.select(F.lit(None).cast(left.schema["old"].dataType).alias("old"), "new"))
    if repeated != "raise":
        differs = lambda row: F.col("old").isNull() | ~_same(current, compared, F.col("old"), row)
        differing = F.filter("new", differs)
        starts = F.coalesce(F.size(differing), F.lit(0)).alias("starts")
        if repeated == "pairs":
            pairs = pairs.select("old", F.explode_outer("new").alias("new"), starts)
        else:
            events = F.concat(F.array_sort(differing, _by_hash), F.filter("new", lambda row: ~differs(row)))
            pairs = pairs.select("old", F.posexplode_outer(events).alias("place", "new"), starts)
    return pairs.withColumn(
        "status",
        F.when(F.col("old").isNull(), F.lit("new"))
        .when(F.col("new").isNull(), F.lit("missing"))
        .when(_same(current, compared, F.col("old"), F.col("new")), F.lit("unchanged"))
        .otherwise(F.lit("changed")),
    )


def _check_repeated(repeated: str, order_by: Sequence[str]) -> None:
    if repeated not in ("raise", "pairs", "sequence"):
        raise ValueError("repeated is 'raise', 'pairs' or 'sequence'")
    if repeated != "raise" and order_by:
        raise ValueError(f"repeated='{repeated}' takes all rows of a key, order_by picks one")


def _by_hash(a: Column, b: Column) -> Column:
    """The order of two rows of one key; those with equal hashes are equal."""
    return F.when(a["_change_hash"] < b["_change_hash"], -1).when(a["_change_hash"] > b["_change_hash"], 1).otherwise(0)


def _rows_by_key(rows: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The batch's rows (`new`) of each key as a list; a key of several rows must have one current version at most."""
    listed = rows.groupBy(KEY).agg(F.collect_list("new").alias("new"))
    several = rows.groupBy(KEY).agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1")
    versions = current.select(key_of(keys)).join(several, KEY, "left_semi").groupBy(KEY).agg(F.count(F.lit(1)).alias("_versions"))
    problem = F.raise_error(F.concat(F.lit("repeated key with several current versions: "), F.to_json(KEY)))
    checked = listed.join(versions.filter("_versions > 1"), KEY, "left")
    return checked.select(KEY, F.when(F.col("_versions") > 1, problem).otherwise(F.col("new")).alias("new"))


def versions_after(classified: DataFrame, columns: Sequence[str], as_of, *, expire_missing: bool = False) -> DataFrame:
    """The versions that follow from a classified batch: kept, expired and inserted rows.

    A column the batch lacks keeps its value. A version cannot end before it
    began: a batch dated before the version it would end raises when the result
    is computed, before a table publishes it. A version that began at the same
    moment never held, so the new one stands in its place.

    Of keys that a batch holds more than once (`repeated="pairs"`), a version is kept or
    ends once per event of its key, and each row of the batch starts a version per event
    that is new or changed, as joins with the events do. So the key may have several
    current versions. One that began at the same moment is replaced row by row.

    Of a key that comes several times in a `repeated="sequence"`, the old version ends once,
    rows that are new or changed follow it in the order of `place`, and all but the last of
    them end at the moment they begin. So it keeps one current version. Rows equal to the
    old version start nothing.
    """
    now, open_end = _stamp(as_of), F.lit(None).cast("timestamp")
    names = [f.name for f in classified.schema["old"].dataType.fields]
    arrived = {f.name for f in classified.schema["new"].dataType.fields}
    types = {f.name: f.dataType for f in classified.schema["old"].dataType.fields}

    def version(values: dict[str, Column]) -> Column:
        return F.struct(*[values[c].cast(types[c]).alias(c) for c in names])

    old = {c: F.col(f"old.{q(c)}") for c in names}
    kept = version(old)
    late = F.concat(F.lit("the batch is dated "), now.cast("string"), F.lit(", its version began "), old["_valid_from"].cast("string"))
    end = F.when(now < old["_valid_from"], F.raise_error(late).cast("timestamp")).otherwise(now)
    expired = version({**old, "_valid_to": end, "_is_current": F.lit(False)})
    fresh = {c: F.col(f"new.{q(c)}") if c in arrived else old[c] for c in names}
    inserted = version(
        {**fresh, "_valid_from": now, "_valid_to": open_end, "_is_current": F.lit(True), "_last_updated": now}
    )
    status, at_once = F.col("status"), old["_valid_from"] == now
    several = "starts" in classified.columns
    started = F.array_repeat(inserted, F.col("starts")) if several else F.array(inserted)
    none = F.slice(F.array(kept), F.lit(1), F.lit(0))
    gone = F.when(at_once, none).otherwise(F.array(expired)) if expire_missing else F.array(kept)
    if "place" in classified.columns:
        first, last = F.col("place") == 0, F.col("place") == F.col("starts") - 1
        passed = version({**fresh, "_valid_from": now, "_valid_to": now, "_is_current": F.lit(False), "_last_updated": now})
        follows = F.when(last, F.array(inserted)).otherwise(F.array(passed))
        rows = (
            F.when(status == "new", follows)
            .when(status == "changed", F.when(first & ~at_once, F.concat(F.array(expired), follows)).otherwise(follows))
            .when(status == "missing", gone)
            .otherwise(F.when(first, F.array(kept)).otherwise(none))
        )
        return classified.select(F.inline(rows)).select(*[F.col(q(c)) for c in columns])
    rows = (
        F.when((status == "changed") & at_once, F.array(inserted))
        .when(status == "new", started)
        .when(status == "changed", F.concat(F.array(expired), started) if several else F.array(expired, inserted))
        .when(status == "missing", gone)
        .otherwise(F.when(at_once, F.array(kept)).otherwise(F.concat(F.array(kept), started)) if several else F.array(kept))
    )
    return classified.select(F.inline(rows)).select(*[F.col(q(c)) for c in columns])


def widened(gold: DataFrame, batch: DataFrame) -> DataFrame:
    """Gold with the columns a batch brings for the first time; they are empty in old versions."""
    fresh = [f for f in batch.schema.fields if f.name not in gold.columns]
    return gold.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in fresh]) if fresh else gold


def scd2_merge(
    gold: DataFrame | None,
    batch: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    as_of,
    *,
    order_by: Sequence[str] = (),
    expire_missing: bool = False,
    snapshot: bool = False,
    repeated: str = "raise",
) -> DataFrame:
    """Gold after a batch. History is carried over without a shuffle, current rows as `classify` says.

    `expire_missing` takes the batch for a full snapshot: a key it lacks ends. Of
    `repeated`, see `classify`; the first batch must hold a key once in any case.
    """
    _check_repeated(repeated, order_by)
    if gold is None:
        return first_load(one_row_per_key(batch, keys, order_by), tracked, as_of)
    gold = widened(gold, batch)
    history = gold.filter(~F.col("_is_current"))
    classified = classify(
        gold.filter("_is_current"), batch, keys, tracked, order_by=order_by, snapshot=snapshot or expire_missing, repeated=repeated
    )
    return history.unionByName(versions_after(classified, gold.columns, as_of, expire_missing=expire_missing))


def merge_stats(classified: DataFrame, *, expire_missing: bool = False) -> DataFrame:
    """One row: new, changed, unchanged, missing and expired (one old version per changed or, on request, missing key)."""
    by = lambda s: F.count_if(F.col("status") == s)
    return classified.agg(
        by("new").alias("new"),
        by("changed").alias("changed"),
        by("unchanged").alias("unchanged"),
        by("missing").alias("missing"),
        (by("changed") + by("missing") if expire_missing else by("changed")).alias("expired"),
    )


def scd1_upsert(
    gold: DataFrame | None, batch: DataFrame, keys: Sequence[str], order_by: Sequence[str] = (), *, repeated: str = "raise"
) -> DataFrame:
    """One row per key: the batch's, or gold's where the batch has none.

    Values are taken in the types gold has, and a column the batch lacks keeps
    gold's value. Gold rows are not moved when the batch is small enough to broadcast.

    With `repeated="pairs"` all rows the batch has of a key take the place of gold's; a
    column it lacks keeps the values of each of gold's rows. It takes no `order_by`.
    """
    _check_repeated(repeated, order_by)
    if repeated == "sequence":
        raise ValueError("a sequence is of versions, which only a history keeps")
    latest = batch if repeated == "pairs" else one_row_per_key(batch, keys, order_by)
    if gold is None:
        return latest
    types = {f.name: f.dataType for f in gold.schema.fields}
    latest = latest.select(*[F.col(q(c)).cast(types[c]).alias(c) if c in types else F.col(q(c)) for c in latest.columns])
    lacking = [c for c in gold.columns if c not in batch.columns]
    if lacking:
        old = with_keys(gold, latest, keys).select(key_of(keys), *[F.col(q(c)) for c in lacking])
        latest = latest.select(key_of(keys), "*").join(old, KEY, "left").drop(KEY)
    return without_keys(gold, latest, keys).unionByName(latest, allowMissingColumns=True)
