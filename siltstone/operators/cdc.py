"""Snapshot comparison: inserts, updates, deletes and unchanged rows by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.digest import row_digest
from siltstone.functions.missing import is_missing
from siltstone.operators.keys import KEY, key_of, one_row_per_key, q

OPS = ("insert", "update", "delete", "unchanged")


def _aligned(df: DataFrame, other: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All columns, in the types that hold both sides' values."""
    both = df.limit(0).unionByName(other.limit(0), allowMissingColumns=True).schema
    return df.select(*[(F.col(q(c)) if c in df.columns else F.lit(None)).cast(both[c].dataType).alias(c) for c in columns])


def _changed_columns(columns: Sequence[str]) -> Column:
    """Names of the columns in which `before` and `after` differ."""
    return F.array_compact(F.array(*[F.when(~F.col(f"before.{q(c)}").eqNullSafe(F.col(f"after.{q(c)}")), F.lit(c)) for c in columns]))


def _digest_first(old: DataFrame, new: DataFrame, key: str, columns: Sequence[str], repeated: str) -> DataFrame:
    """Keys and row digests are compared; rows are fetched for keys that differ or, if allowed, occur repeatedly."""
    rest = [c for c in columns if c != key]

    def side(df: DataFrame, other: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
        rows = _aligned(df.filter(~is_missing(F.col(q(key)), df.schema[key].dataType)), other, columns)
        short = rows.select(F.col(q(key)).alias("pk"), F.unhex(row_digest(rows, rest)).alias("_digest"))
        if repeated == "raise":
            single = one_row_per_key(short, ["pk"], keep_key=True).withColumn("_copies", F.lit(1))
        else:
            single = short.groupBy(key_of(["pk"])).agg(F.any_value("pk").alias("pk"), F.any_value("_digest").alias("_digest"), F.count(F.lit(1)).alias("_copies"))
        single = single.select(KEY, F.col("pk").alias(f"_{name}_pk"), F.col("_digest").alias(f"_{name}"), F.col("_copies").alias(f"_{name}_copies"))
        return single, rows.select(key_of([key]), F.struct(*[F.col(q(c)) for c in columns]).alias(name))

    before, old_rows = side(old, new, "before")
    after, new_rows = side(new, old, "after")
    found = before.join(after, KEY, "full_outer")
    several = F.greatest("_before_copies", "_after_copies") > 1
    pairs = (found if repeated == "raise" else found.filter(~several)).select(
        KEY,
        F.coalesce("_after_pk", "_before_pk").alias("pk"),
        F.when(F.col("_before").isNull(), F.lit("insert"))
        .when(F.col("_after").isNull(), F.lit("delete"))
        .when(F.col("_before") != F.col("_after"), F.lit("update"))
        .otherwise(F.lit("unchanged"))
        .alias("op"),
    )
    # A large side is looked up from, which Spark does without moving it where few keys differ.
    wanted = pairs.filter("op <> 'unchanged'")
    olds = old_rows.join(wanted.filter("op <> 'insert'").select(KEY), KEY, "left_semi")
    news = new_rows.join(wanted.filter("op <> 'delete'").select(KEY), KEY, "left_semi")
    none = F.array().cast("array<string>")
    differing = wanted.join(olds, KEY, "left").join(news, KEY, "left").select(
        "pk", "op", "before", "after", F.when(F.col("op") == "update", _changed_columns(rest)).otherwise(none).alias("changed_cols")
    )
    images = [F.lit(None).cast(differing.schema[c].dataType).alias(c) for c in ("before", "after")]
    events = differing.unionByName(pairs.filter("op = 'unchanged'").select("pk", "op", *images, none.alias("changed_cols")))
    if repeated == "raise":
        return events
    # Keys that occur repeatedly are few: their rows are fetched and compared each with each.
    more = found.filter(several).select(KEY)
    sides = [rows.join(more, KEY, "left_semi").select(KEY, name, F.lit(True).alias(f"_{name}")) for rows, name in ((old_rows, "before"), (new_rows, "after"))]
    compared = _compared(sides[0].join(sides[1], KEY, "full_outer"), F.col("_before"), F.col("_after"), rest, F.col(f"{KEY}.k0"))
    differs = F.col("op") != "unchanged"
    return events.unionByName(compared.select("pk", "op", *[F.when(differs, F.col(c)).alias(c) for c in ("before", "after")], "changed_cols"))


def _compared(pairs: DataFrame, has_before: Column, has_after: Column, columns: Sequence[str], pk: Column) -> DataFrame:
    """Events of joined rows, of which either may be missing."""
    both = has_before.isNotNull() & has_after.isNotNull()
    marked = pairs.withColumn("_changed", F.when(both, _changed_columns(columns)))
    return marked.select(
        pk.alias("pk"),
        F.when(has_before.isNull(), F.lit("insert"))
        .when(has_after.isNull(), F.lit("delete"))
        .when(F.size("_changed") > 0, F.lit("update"))
        .otherwise(F.lit("unchanged"))
        .alias("op"),
        F.when(has_before.isNotNull(), F.col("before")).alias("before"),
        F.when(has_after.isNotNull(), F.col("after")).alias("after"),
        F.coalesce("_changed", F.array().cast("array<string>")).alias("changed_cols"),
    )


def snapshot_diff(
    old: DataFrame, new: DataFrame, key: str, *, order_by: Sequence[str] = (), images: str = "all", repeated: str = "raise"
) -> DataFrame:
    """One row per key: `op`, images before and after, and the changed columns.

    Rows without a key are ignored. A key that occurs twice in a snapshot needs
    `order_by` (the last row wins) or raises. `images="all"` gives every key its
    rows: one exchange per side of whole rows, which collapsing to one row per key
    and the join share. `images="changed"` leaves the images of unchanged keys null:
    only keys and digests are exchanged, and rows of keys that differ. It takes no
    `order_by`.

    `repeated="pairs"` takes snapshots in which a key may occur more than once, as a
    full outer join does: a row for each pair of an old and a new row of the key, so
    the product of both counts. It takes no `order_by` either.
    """
    if repeated not in ("raise", "pairs"):
        raise ValueError("repeated is 'raise' or 'pairs'")
    if repeated == "pairs" and order_by:
        raise ValueError("repeated='pairs' compares all rows of a key, order_by picks one")
    columns = list(dict.fromkeys([*new.columns, *old.columns]))
    if images not in ("all", "changed"):
        raise ValueError("images is 'all' or 'changed'")
    if images == "changed":
        if order_by:
            raise ValueError("images='changed' compares one row per key; bring the snapshots to that first")
        return _digest_first(old, new, key, columns, repeated)

    def side(df: DataFrame, name: str) -> DataFrame:
        keyed = df.filter(~is_missing(F.col(q(key)), df.schema[key].dataType))
        other = new if df is old else old
        if repeated == "pairs":
            single = keyed.select(key_of([key]), "*")
        else:
            single = one_row_per_key(keyed, [key], order_by, keep_key=True)
        fields = [
            (F.col(q(c)) if c in df.columns else F.lit(None).cast(other.schema[c].dataType)).alias(c) for c in columns
        ]
        return single.select(KEY, F.col(q(key)).alias(f"_{name}_key"), F.struct(*fields).alias(name))

    pairs = side(old, "before").join(side(new, "after"), KEY, "full_outer")
    pk = F.coalesce("_after_key", "_before_key")
    return _compared(pairs, F.col("_before_key"), F.col("_after_key"), [c for c in columns if c != key], pk)


def diff_counts(events: DataFrame) -> DataFrame:
    """One row with the number of events of each kind; `total_processed` counts the new snapshot's keys."""
    return events.agg(
        F.count_if(F.col("op") == "insert").alias("inserts"),
        F.count_if(F.col("op") == "update").alias("updates"),
        F.count_if(F.col("op") == "delete").alias("deletes"),
        F.count_if(F.col("op") == "unchanged").alias("unchanged"),
        F.count_if(F.col("op") != "delete").alias("total_processed"),
    )


def apply_diff(old: DataFrame, events: DataFrame, key: str, *, repeated: str = "raise") -> DataFrame:
    """The new snapshot, rebuilt from the old one and the events.

    With `repeated="pairs"`, as in `snapshot_diff`, the new snapshot may hold a key more
    than once; an old row then stays as often as events say that it is unchanged. The old
    snapshot must hold the keys of events once, or this raises.
    """
    if repeated == "pairs":
        kept = _kept(old, events, key)
    else:
        touched = events.filter("op in ('update', 'delete')").select(F.col("pk").alias(key))
        kept = old.join(touched, key, "left_anti").select(old.columns)
    added = events.filter("op in ('insert', 'update')").select("after.*")
    return kept.unionByName(added, allowMissingColumns=True)


def _kept(old: DataFrame, events: DataFrame, key: str) -> DataFrame:
    """Old rows, each as often as it is unchanged; rows whose key has no event stay."""
    zero, one = F.lit(0), F.lit(1)
    # Keys of old rows, in the type they have there.
    compared = events.filter("op <> 'insert'").select(F.col("pk").cast(old.schema[key].dataType).alias(key), "op")
    keys = old.select(key_of([key]), one.alias("rows"), zero.alias("events"), zero.alias("stays")).unionByName(
        compared.select(key_of([key]), zero.alias("rows"), one.alias("events"), (F.col("op") == "unchanged").cast("int").alias("stays"))
    )
    sums = keys.groupBy(KEY).agg(*[F.sum(c).cast("int").alias(c) for c in ("rows", "events", "stays")])
    problem = F.raise_error(F.concat(F.lit("repeated key in the old snapshot: "), F.to_json(KEY))).cast("int")
    times = F.when(F.col("events") == 0, one).when(F.col("rows") > 1, problem).otherwise(F.col("stays"))
    looked_up = old.select(key_of([key]), "*").join(sums.select(KEY, times.alias("times")).filter("times <> 1"), KEY, "left")
    return looked_up.select(*[F.col(q(c)) for c in old.columns], F.explode(F.array_repeat(one, F.coalesce("times", one))).alias(KEY)).drop(KEY)
