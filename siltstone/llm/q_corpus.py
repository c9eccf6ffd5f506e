"""Queries on word variants, periodic runs and fingerprints of documents."""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.periodic_runs import find_runs
from siltstone.llm.registry import query, table
from siltstone.llm.simhash_links import simhash_components
from siltstone.llm.spelling_variants import group_variants, word_counts

GAP = r"[\x20\x09-\x0D]+"


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): by a checksum of its id, a tenth of the documents repeats some of its words to the end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    split = F.filter(F.split("text", GAP), lambda w: w != "")
    rows = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, split).alias("words"))
    g, n = F.floor(F.col("h") / 10), F.size("words")
    rows = rows.withColumn("a", F.when(n > 0, (g % n).cast("int")))
    rows = rows.withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + g % 8))).cast("int"))
    block = F.slice("words", F.col("a") + 1, F.col("p"))
    again = F.flatten(F.array_repeat(block, F.ceil((n - F.col("a")) / F.col("p")).cast("int")))
    planted = F.slice(F.concat(F.slice("words", F.lit(1), F.col("a")), again), F.lit(1), n)
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(planted, " ")).otherwise(F.col("text")).alias("text"))


def _longest() -> Column:
    """Of `runs` the one of greatest length, then smallest start, then smallest period; null where there is none."""
    ranked = F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("p"), r.alias("run")))
    return F.try_element_at(F.sort_array(ranked, asc=False), F.lit(1))["run"]


@query("op12_periodic_runs")
def periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_runs(with_planted_runs(docs)).withColumn("longest", _longest())
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "longest.start", "longest.length", "longest.period",
        F.floor(F.col("longest.length") * 1000 / F.col("longest.period")).alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("op13_simhash_dedup")
def simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


def with_letters_deleted(doc_id: str, words: list[str]) -> list[str]:
    """By a checksum of document and word, one word in 199 loses a letter."""
    out, prefix = [], zlib.crc32(f"{doc_id}:".encode())
    for word in words:
        h = zlib.crc32(word.encode(), prefix)
        if h % 199 == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
        out.append(word)
    return out


@query("op11_spelling_variants")
def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = word_counts(table(spark, sf_dir, "documents"), change=with_letters_deleted)
    return group_variants(words).select("word", "form", "root", "n", "n_near", "form_n")
