"""Queries over documents that need no other document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.decontaminate import coverage_exceeds, find_hits
from siltstone.llm.jaccard_join import similar_components
from siltstone.llm.language_id import fit, held_out, predict
from siltstone.llm.piece_sampling import sample_pieces
from siltstone.llm.pii_sanitise import sanitise, spans_text
from siltstone.llm.quality_rules import STOP_WORDS, judge
from siltstone.llm.registry import TOKENIZERS, query, table
from siltstone.llm.suffix_dedup import remove_repeats
from siltstone.llm.token_counts import Rollup, count_tokens
from siltstone.session import shared_dir

GAPS = r"[\x20\x09-\x0D]+"

QUALITY_COLUMNS = (
    "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
)


def quality_sql(source: str = "documents") -> str:
    """The verdict of every row of `source` (doc_id must be unique there)."""
    stops = ", ".join(f"'{w}'" for w in sorted({w for words in STOP_WORDS.values() for w in words}))
    gap = r"'[\x20\x09-\x0D]+'"
    return rf"""
WITH split AS (
 SELECT doc_id, coalesce(text, '') AS body,
  list_filter(regexp_split_to_array(coalesce(text, ''), {gap}), lambda w: w <> '') AS words,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
 FROM {source}),
windows AS (
 SELECT doc_id, unnest(range(1, len(words) - 1)) AS i, words FROM split WHERE len(words) >= 3),
found AS (
 SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS n FROM windows),
covered AS (
 SELECT doc_id, count(DISTINCT i + step) AS n_repeat_words
 FROM (SELECT doc_id, i, unnest([0, 1, 2]) AS step FROM found WHERE n >= 2) GROUP BY doc_id),
counted AS (
 SELECT s.doc_id, CAST(len(words) AS BIGINT) AS n_words,
  CAST(length(list_aggregate(words, 'string_agg', '')) AS BIGINT) AS chars,
  CAST(length(regexp_replace(body, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, len(lines) AS n_lines,
  CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
  len(list_filter(words, lambda w: lower(w) IN ({stops}))) AS n_stops,
  length(regexp_replace(body, '[^!]+', '', 'g')) AS n_exclaim,
  length(regexp_replace(regexp_replace(body, {gap}, '', 'g'), '[^\p{{Lu}}]+', '', 'g')) AS n_capitals
 FROM split s LEFT JOIN covered c ON s.doc_id = c.doc_id)
SELECT doc_id, n_words, coalesce(chars, 0) AS word_chars, n_symbols, n_dup_lines, n_repeat_words,
 n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
 n_words >= 50 AND 100 * n_repeat_words <= 50 * n_words AND chars BETWEEN 2 * n_words AND 20 * n_words
  AND n_symbols / n_words <= 0.1 AND n_exclaim / n_words <= 0.3 AND n_capitals / chars <= 0.5
  AND n_stops / n_words >= 0.02 AND n_dup_lines / n_lines <= 0.5 AS kept
FROM counted
"""


@query("op2_quality_rules", quality_sql())
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).select(*QUALITY_COLUMNS)


@query("op3_benchmark_decontamination")
def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = find_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.select(
        "doc_id", "n_words", "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        coverage_exceeds().alias("contaminated"),
        F.col("longest_match").cast("long").alias("longest_match"),
    )


@query("op4_token_counts")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents under two tokenizer versions; those labelled toxic are taken down, and the
    first version's counts revised to those of texts with single blanks; a load is then sent again."""
    docs = table(spark, sf_dir, "documents")
    toxic = table(spark, sf_dir, "labels").filter("toxic = 1").select("doc_id").distinct()
    rollup = Rollup(spark, shared_dir(spark, "token-counts"))
    first, second = "byte_bpe_50k", "byte_bpe_multi_50k"
    counted = count_tokens(docs, f"{TOKENIZERS}/{first}.tiktoken", first)
    rollup.commit("load", counted)
    rollup.commit("load-second", count_tokens(docs, f"{TOKENIZERS}/{second}.tiktoken", second))
    versions = F.explode(F.array(F.lit(first), F.lit(second))).alias("tokenizer")
    rollup.commit("takedown", deletes=toxic.select("doc_id", versions))
    revised = count_tokens(docs.withColumn("text", F.regexp_replace("text", GAPS, " ")), f"{TOKENIZERS}/{first}.tiktoken", first)
    rollup.commit("revision", revised.join(toxic, "doc_id", "left_anti"))  # counts are joined, texts stay where they are
    rollup.commit("load", counted)
    return rollup.totals()


@query("op10_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    dictionaries = fit(docs.filter(~held_out()))
    found = predict(docs.select("doc_id", "text", held_out().alias("held_out")), dictionaries)
    return found.select("doc_id", "held_out", "lang_pred", "score", "margin", "rejected")


@query("op5_sentencepiece_sampling")
def sentencepiece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sample_pieces(docs, f"{TOKENIZERS}/piece_bpe_32k.model", digests=True).drop("text")


@query("op9_pii_sanitisation")
def pii_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sanitise(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"] != "term")
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone",
        F.sha2(spans_text(base), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
    )


@query("op7_jaccard_join")
def jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_components(table(spark, sf_dir, "documents"))


@query("op6_suffix_array_dedup")
def suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))
