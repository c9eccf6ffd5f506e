"""Quality rules: a threshold table compiled into one projection.

Everything is built-in expressions over the text; nothing is shuffled and no
user function runs. `measure` adds the counts, `compile_rules` turns the table
of thresholds into one boolean and the names of the rules that failed.

Defined results: a null text has no words (all counts 0) and, having fewer
words than `min_words`, is not kept; an empty text likewise. Ratios of a text
without words are 0. Repeated rows are judged one by one and alike. Input
columns are kept, whatever their names; a column that a measure would hide
raises unless `prefix` sets the measures apart. An empty table gives an empty
result. Texts are judged whole.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_GAP = "[\\x20\\x09-\\x0D]+"
GAPS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

# Frequent function words of the languages judged here.
STOP_WORDS = {
    "en": "the of and to in is that for it as was with be by on are this from at or an which not have".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par au sur pas avec il sont la".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más".split(),
}


class Rule(NamedTuple):
    """A text passes if low <= measure <= high; None leaves that side open."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


# The verdict on top of the base: lengths, symbols, stop words, lines.
RULES = (
    Rule("mean_word_length", "mean_word_chars", 2.0, 20.0),
    Rule("symbols", "symbol_ratio", None, 0.1),
    Rule("exclamations", "exclamation_ratio", None, 0.3),
    Rule("capitals", "capital_ratio", None, 0.5),
    Rule("stop_words", "stop_word_ratio", 0.02, None),
    Rule("duplicate_lines", "dup_line_ratio", None, 0.5),
)

BASE = (
    Rule("min_words", "n_words", 50, None),
    Rule("repeated_words", "repeat_word_percent", None, 50),
)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RATIOS = (
    "mean_word_chars", "symbol_ratio", "exclamation_ratio", "capital_ratio",
    "stop_word_ratio", "dup_line_ratio", "repeat_word_percent",
)


def _repeated_words(words: Column) -> Column:
    """Words that lie in a window of three that occurs twice or more.

    Windows are sorted by hash, then by their words, then by place, so equal
    ones are neighbours; the covered words are the steps between the places of
    repeated windows, three at most each.
    """
    places = F.sequence(F.lit(1), F.size(words) - 2)
    windows = F.transform(
        places,
        lambda i: F.struct(
            F.xxhash64(words[i - 1], words[i], words[i + 1]).alias("h"),
            words[i - 1].alias("a"), words[i].alias("b"), words[i + 1].alias("c"), i.alias("i"),
        ),
    )

    def same(x: Column, y: Column) -> Column:
        return (x["h"] == y["h"]) & (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])

    def repeated(w: Column, k: Column, ordered: Column) -> Column:
        before = F.when(k > 0, same(w, F.get(ordered, k - 1))).otherwise(False)
        after = F.when(k < F.size(ordered) - 1, same(w, F.get(ordered, k + 1))).otherwise(False)
        return before | after

    def covered(found: Column) -> Column:
        steps = F.transform(found, lambda i, k: F.least(F.lit(3), F.coalesce(F.get(found, k + 1) - i, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    # An array made of one value binds it to a name, so that it is computed once.
    ordered = F.transform(F.array(F.array_sort(windows)), lambda o: F.filter(o, lambda w, k: repeated(w, k, o)))[0]
    found = F.transform(F.array(F.sort_array(F.transform(ordered, lambda w: w["i"]))), covered)[0]
    return F.when(F.size(words) >= 4, found).otherwise(0)


def measure(df: DataFrame, text: str = "text", prefix: str = "", stop_words: dict[str, list[str]] | None = None) -> DataFrame:
    """`df` with the counts (long) and ratios (double) of its text column."""
    hidden = {prefix + c for c in (*COUNTS, *RATIOS)} & set(df.columns)
    if hidden:
        raise ValueError(f"columns in the way: {sorted(hidden)}; choose another prefix")
    stops = sorted({w for words in (STOP_WORDS if stop_words is None else stop_words).values() for w in words})
    kept = [df[c] for c in df.columns]
    body = F.coalesce(df[text], F.lit(""))
    bare = F.trim(body, F.lit(GAPS))
    split = df.select(
        *kept,
        body.alias("__body"),
        F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, WORD_GAP)).alias("__words"),
        F.filter(F.split(body, "\n"), lambda line: F.trim(line, F.lit(GAPS)) != "").alias("__lines"),
    )
    words, lines = F.col("__words"), F.col("__lines")
    joined = F.array_join(words, "")
    counted = split.select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.size(words).cast("long").alias(prefix + "n_words"),
        F.length(joined).cast("long").alias(prefix + "word_chars"),
        F.length(F.regexp_replace("__body", f"[^{SYMBOLS}]+", "")).cast("long").alias(prefix + "n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias(prefix + "n_dup_lines"),
        _repeated_words(words).cast("long").alias(prefix + "n_repeat_words"),
        F.size(lines).alias("__n_lines"),
        F.size(F.filter(words, lambda w: F.lower(w).isin(stops))).alias("__n_stops"),
        F.length(F.regexp_replace("__body", "[^!]+", "")).alias("__n_exclaim"),
        F.length(F.regexp_replace(joined, "[^\\p{Lu}]+", "")).alias("__n_capitals"),
    )
    n, chars = F.col(prefix + "n_words"), F.col(prefix + "word_chars")

    def share(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part / whole).otherwise(0.0)

    return counted.select(
        *[F.col(f"`{c}`") for c in (*df.columns, *(prefix + c for c in COUNTS))],
        share(chars, n).alias(prefix + "mean_word_chars"),
        share(F.col(prefix + "n_symbols"), n).alias(prefix + "symbol_ratio"),
        share(F.col("__n_exclaim"), n).alias(prefix + "exclamation_ratio"),
        share(F.col("__n_capitals"), chars).alias(prefix + "capital_ratio"),
        share(F.col("__n_stops"), n).alias(prefix + "stop_word_ratio"),
        share(F.col(prefix + "n_dup_lines"), F.col("__n_lines")).alias(prefix + "dup_line_ratio"),
        share(100 * F.col(prefix + "n_repeat_words"), n).alias(prefix + "repeat_word_percent"),
    )


def compile_rules(rules: tuple[Rule, ...], prefix: str = "") -> Column:
    """Names of the rules that a row fails, in the table's order."""
    failed = []
    for rule in rules:
        value = F.col(prefix + rule.measure)
        bad = F.lit(False)
        if rule.low is not None:
            bad = bad | (value < rule.low)
        if rule.high is not None:
            bad = bad | (value > rule.high)
        failed.append(F.when(bad, F.lit(rule.name)))
    return F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>")


def judge(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, base: tuple[Rule, ...] = BASE, prefix: str = "") -> DataFrame:
    """`df` with its measures, `base_failed`, `failed_rules` and `kept`."""
    measured = measure(df, text, prefix)
    return measured.select(
        *[F.col(f"`{c}`") for c in measured.columns],
        (F.size(compile_rules(base, prefix)) > 0).alias(prefix + "base_failed"),
        compile_rules(base + rules, prefix).alias(prefix + "failed_rules"),
    ).withColumn(prefix + "kept", F.size(prefix + "failed_rules") == 0)


def keep(df: DataFrame, text: str = "text", **how) -> DataFrame:
    """The rows of `df` that pass. A generator does the filtering: a filter would be moved below the measures, each then repeated in it."""
    judged = judge(df, text, prefix="__", **how)
    once = F.when(F.col("__kept"), F.array(F.lit(1))).otherwise(F.array().cast("array<int>"))
    return judged.select(*[F.col(f"`{c}`") for c in df.columns], F.explode(once).alias("__once")).drop("__once")
