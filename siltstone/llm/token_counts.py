"""Token counts by source, language and tokenizer version, kept by deltas.

Three tables below one folder:

* `ledger`: signed facts, a folder per batch: +1 rows bring a document's count,
  -1 rows take back exactly what was there. A revision is both.
* `totals`: what each batch adds to the totals, summed by group; a folder per batch.
* `committed`: one file per batch, written last. Only batches named there are
  read, so a batch that died half-way is as if it had not been; running it
  again replaces its folders. A batch that is committed is not applied again.

Totals are sums over committed batches, so they never look at a document twice.

Defined results: null texts have 0 tokens; null source or language is a group
of its own. `insert` of a document that is there under the same tokenizer
version counts as a revision, and repeated rows of one document in one batch
count once (the largest row by count, source, language). `delete` of a document
that is not there changes nothing. Documents without an id are refused. Empty
batches are committed and add nothing. Columns beside those named are ignored.
"""

from __future__ import annotations

import base64

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from siltstone.llm.batches import with_columns

PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

KEY = ("doc_id", "tokenizer")
GROUP = ("source", "lang", "tokenizer")
LEDGER = "doc_id bigint, tokenizer string, source string, lang string, tokens bigint, sign int, batch string"
TOTALS = "source string, lang string, tokenizer string, inserted_docs bigint, inserted_tokens bigint, deleted_docs bigint, deleted_tokens bigint, batch string"

_CODERS: dict[str, tiktoken.Encoding] = {}  # by path, one load for each worker


def coder(path: str) -> tiktoken.Encoding:
    if path not in _CODERS:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _CODERS[path] = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _CODERS[path]


def count_tokens(docs: DataFrame, vocabulary: str, version: str, text: str = "text") -> DataFrame:
    """(doc_id, tokenizer, source, lang, tokens) of whole texts; no shuffle."""

    def count(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        encode = coder(vocabulary).encode_ordinary
        found = [len(encode(t)) if t else 0 for t in batch.column(batch.schema.get_field_index("__text")).to_pylist()]
        return {"tokens": pa.array(found, pa.int64())}

    picked = docs.select("doc_id", F.lit(version).alias("tokenizer"), "source", "lang", docs[text].alias("__text"))
    return with_columns(picked, StructType([StructField("tokens", LongType())]), count).drop("__text")


class Rollup:
    """The three tables below `root`, a folder every executor can reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _exists(self, path: str) -> bool:
        jvm_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return jvm_path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(jvm_path)

    def committed(self) -> list[str]:
        """Batches in force; one short name for each."""
        if not self._exists(f"{self.root}/committed"):
            return []
        return sorted(r[0] for r in self.spark.read.schema("batch string").json(f"{self.root}/committed").collect())

    def _read(self, table: str, schema: str) -> DataFrame:
        paths = [f"{self.root}/{table}/{batch}" for batch in self.committed()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def documents(self) -> DataFrame:
        """Documents in force: (doc_id, tokenizer, source, lang, tokens)."""
        return (
            self._read("ledger", LEDGER)
            .groupBy(*KEY, "source", "lang", "tokens")
            .agg(F.sum("sign").alias("n"))
            .filter("n > 0")
            .drop("n")
        )

    def totals(self) -> DataFrame:
        added = self._read("totals", TOTALS).groupBy(*GROUP).agg(
            *[F.sum(c).alias(c) for c in ("inserted_docs", "inserted_tokens", "deleted_docs", "deleted_tokens")]
        )
        return added.select(
            *GROUP,
            (F.col("inserted_docs") - F.col("deleted_docs")).alias("docs"),
            (F.col("inserted_tokens") - F.col("deleted_tokens")).alias("tokens"),
            "inserted_docs", "inserted_tokens", "deleted_docs", "deleted_tokens",
        )

    def commit(self, batch: str, inserts: DataFrame | None = None, deletes: DataFrame | None = None) -> bool:
        """Applies counted `inserts` (also revisions) and `deletes` (doc_id, tokenizer); False if it was there already."""
        if not batch or not all(c.isalnum() or c in "-_." for c in batch):
            raise ValueError(f"not a batch name: {batch!r}")
        done = self.committed()
        if batch in done:
            return False
        folder = f"{self.root}/ledger/{batch}"
        new = self.spark.createDataFrame([], LEDGER).drop("batch")
        if inserts is not None:
            fact = F.struct("tokens", "source", "lang")
            checked = inserts.withColumn("doc_id", F.when(F.col("doc_id").isNull(), F.raise_error(F.lit("a document without an id"))).otherwise(F.col("doc_id")))
            new = checked.groupBy(*KEY).agg(F.max(fact).alias("f")).select(*KEY, "f.source", "f.lang", "f.tokens", F.lit(1).alias("sign"))
        # New facts are written before their keys are looked up, so that each text is counted once.
        new.withColumn("batch", F.lit(batch)).write.mode("overwrite").parquet(folder)
        if done:
            keys = self.spark.read.schema(LEDGER).parquet(folder).select(*KEY)
            if deletes is not None:
                keys = keys.unionByName(deletes.select(*KEY))
            old = self.documents().join(keys.distinct(), list(KEY), "left_semi").withColumn("sign", F.lit(-1))
            old.select(*KEY, "source", "lang", "tokens", "sign").withColumn("batch", F.lit(batch)).write.mode("append").parquet(folder)
        written = self.spark.read.schema(LEDGER).parquet(folder)
        plus, minus = F.col("sign") > 0, F.col("sign") < 0
        zero = F.lit(0).cast("long")
        written.groupBy(*GROUP).agg(
            F.count_if(plus).alias("inserted_docs"),
            F.sum(F.when(plus, F.col("tokens")).otherwise(zero)).alias("inserted_tokens"),
            F.count_if(minus).alias("deleted_docs"),
            F.sum(F.when(minus, F.col("tokens")).otherwise(zero)).alias("deleted_tokens"),
        ).withColumn("batch", F.lit(batch)).write.mode("overwrite").parquet(f"{self.root}/totals/{batch}")
        # The commit: one small file, whose folder appears whole or not at all.
        self.spark.createDataFrame([(batch,)], "batch string").coalesce(1).write.mode("append").json(f"{self.root}/committed")
        return True
