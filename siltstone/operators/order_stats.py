"""Exact order statistics (quartiles, medians) of columns of any size.

`percentile` and its relatives keep every distinct value of a column in one
task. Here a column is first narrowed to a bracket that is known, by counting,
to hold the wanted rank; only a bracket with few distinct values is given to
`percentile_disc`. A round of narrowing costs two scans of the column and
shrinks it some thousandfold, so 10^12 values take two rounds.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.sketch import approx_distinct
from siltstone.operators.keys import q


@dataclass
class _Bracket:
    """Values from low to high hold rank `rank`; `below` values are smaller than low."""

    column: str
    rank: int
    low: float
    high: float
    below: int
    inside: int
    distinct: int
    answer: float | None = None
    misses: int = 0
    stuck: bool = False

    def holds(self) -> Column:
        return F.col(q(self.column)).between(F.lit(self.low), F.lit(self.high))

    @property
    def share(self) -> float:
        # Half a rank past the wanted one, so that rounding cannot move it.
        return (self.rank - self.below + 0.5) / self.inside


def order_statistics(
    df: DataFrame,
    ranks: Mapping[str, Sequence[int]],
    *,
    max_distinct: int = 100_000,
    accuracy: int = 10_000,
) -> dict[tuple[str, int], float]:
    """Value at each 0-based rank of each double column, nulls left out.

    The columns must be doubles without NaN; infinity is a value like others.
    Only one row of statistics per round reaches the driver. A bracket that no
    longer shrinks is given to `percentile_disc` as it is.
    """
    if accuracy < 10:
        raise ValueError("accuracy below 10 narrows nothing")
    if not ranks:
        return {}
    stats = df.agg(
        *[
            agg
            for i, c in enumerate(ranks)
            for agg in (
                F.count(q(c)).alias(f"n{i}"),
                F.min(q(c)).alias(f"l{i}"),
                F.max(q(c)).alias(f"h{i}"),
                approx_distinct(F.col(q(c))).alias(f"d{i}"),
            )
        ]
    ).first()
    brackets = [
        _Bracket(c, r, stats[f"l{i}"], stats[f"h{i}"], 0, stats[f"n{i}"], stats[f"d{i}"])
        for i, c in enumerate(ranks)
        for r in ranks[c]
        if 0 <= r < stats[f"n{i}"]
    ]
    while True:
        for b in brackets:
            if b.low == b.high:
                b.answer = b.low
        wide = [b for b in brackets if b.answer is None and not b.stuck and b.distinct > max_distinct]
        if not wide:
            break
        _narrow(df, wide, accuracy)
    open_ = [b for b in brackets if b.answer is None]
    if open_:
        inside = df.select(*[F.when(b.holds(), F.col(q(b.column))).alias(f"v{i}") for i, b in enumerate(open_)])
        found = inside.agg(
            *[F.expr(f"percentile_disc({b.share!r}D) within group (order by v{i})").alias(f"p{i}") for i, b in enumerate(open_)]
        ).first()
        for i, b in enumerate(open_):
            b.answer = found[f"p{i}"]
    return {(b.column, b.rank): b.answer for b in brackets}


def _narrow(df: DataFrame, brackets: list[_Bracket], accuracy: int) -> None:
    margins = [4.0 / accuracy * 2**b.misses for b in brackets]
    guesses = df.agg(
        *[
            F.percentile_approx(
                F.when(b.holds(), F.col(q(b.column))),
                [max(b.share - m, 0.0), min(b.share + m, 1.0)],
                accuracy,
            ).alias(f"g{i}")
            for i, (b, m) in enumerate(zip(brackets, margins))
        ]
    ).first()
    cuts = [tuple(guesses[f"g{i}"]) for i in range(len(brackets))]
    aggs = []
    for i, (b, (low, high)) in enumerate(zip(brackets, cuts)):
        v = F.col(q(b.column))
        aggs += [
            F.count_if(v < low).alias(f"b{i}"),
            F.count_if(v.between(low, high)).alias(f"i{i}"),
            approx_distinct(F.when(v.between(low, high), v)).alias(f"d{i}"),
        ]
    counted = df.agg(*aggs).first()
    for i, (b, (low, high)) in enumerate(zip(brackets, cuts)):
        below, inside, distinct = counted[f"b{i}"], counted[f"i{i}"], counted[f"d{i}"]
        if below <= b.rank < below + inside:
            b.stuck = inside >= b.inside
            b.low, b.high, b.below, b.inside, b.distinct = low, high, below, inside, distinct
        else:
            # The sketch missed the rank: keep the bracket, guess wider.
            b.stuck = margins[i] >= 1
            b.misses += 1
