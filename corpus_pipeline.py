"""Corpus pipeline: quality rules, near-duplicates, benchmark passages, personal data, pieces.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which `run`
writes and reads again as the next one's documents. All but the last return the
columns of `documents`; n_chars follows a text that a stage has changed.

Every stage judges rows: rows whose doc_id is null take part in all of them, and
rows that share a doc_id are told apart among the near-duplicates. Empty documents
are rejected by the first stage; no documents give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.decontaminate import decontaminate
from siltstone.llm.jaccard_join import similar_components
from siltstone.llm.piece_sampling import sample_pieces
from siltstone.llm.pii_sanitise import sanitise
from siltstone.llm.quality_rules import keep
from siltstone.llm.queries import ORACLES, QUERIES
from siltstone.llm.registry import TOKENIZERS, query, table
from siltstone.session import shared_dir


def _like(docs: DataFrame, changed: DataFrame, text: str) -> DataFrame:
    """The columns of `docs` with the text of `changed`, and n_chars where that is another."""
    same = F.col(f"`{text}`").eqNullSafe(F.col("text"))
    new = {"text": F.col(f"`{text}`"), "n_chars": F.when(same, F.col("n_chars")).otherwise(F.length(f"`{text}`"))}
    return changed.select(*[new.get(c, F.col(f"`{c}`")).cast(t).alias(c) for c, t in docs.dtypes])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component one row stays: the smallest doc_id (null last), then text hash, then row."""
    folder = shared_dir(spark, "rows")
    docs.withColumn("__row", F.monotonically_increasing_id()).write.parquet(folder)  # written once, so a row keeps its number
    rows = spark.read.parquet(folder)
    linked = similar_components(rows.select(F.col("__row").alias("doc_id"), "text")).select(F.col("doc_id").alias("__row"), "component_id")
    keys = rows.select("__row", F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.md5(F.col("text").cast("binary")).alias("hash"), "__row").alias("key"))
    folder = shared_dir(spark, "copies")
    linked.join(keys, "__row").write.parquet(folder)
    copies = spark.read.parquet(folder)
    stays = copies.groupBy("component_id").agg(F.min("key").alias("key")).select(F.col("key.__row").alias("__row"))
    gone = copies.select("__row").join(stays, "__row", "left_anti")
    return rows.join(gone, "__row", "left_anti").select(*docs.columns)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; a span of more than 50 words that is left is cut out."""
    return _like(docs, decontaminate(docs, table(spark, sf_dir, "benchmark")), "cleaned")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and terms that give it away are replaced."""
    return _like(docs, sanitise(docs), "sanitised")


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, ids, n_pieces, lossless)."""
    return sample_pieces(docs, f"{TOKENIZERS}/piece_bpe_32k.model").drop("text", "n_chars")


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_passages),
    ("pii_sanitisation", personal_data),
    ("sentencepiece_sampling", pieces),
]

# Hashes of shingles, automata and sampled pieces: SQL cannot say these stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = shared_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs


query("pipeline", ORACLE_SQL)(run)
__all__ = ["ORACLES", "ORACLE_SQL", "QUERIES", "STAGES", "run"]
