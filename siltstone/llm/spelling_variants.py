"""Spelling variants: words one edit apart, by asymmetric chunks and grams.

Two words are near if they differ by exactly one inserted, deleted or replaced
code point. Of a pair the shorter word (either, if as long) gives two disjoint
chunks, its first and last `q` code points with `q` half its length; the other
gives the positional grams of that length. An edit touches at most one of two
disjoint chunks, so the other stands in the longer word too: the first at the same
place, the last shifted by the difference of lengths, which is 0 or 1. Joining chunks
to grams on (length, place, content) therefore finds every pair. Candidates are then
verified by edit distance.

Chunks that many words share would bring all pairs of them together. A list of more
than `CANDIDATES` possible pairs is not joined: the part of its words that may still
differ is cut into two chunks in turn, so each of the next lists agrees on half of the
rest as well. This ends where a single code point is open, in lists bounded by the
alphabet.

The form of a word is its most frequent near word (ties: smallest in code-point order)
if that is `times` as frequent; the root follows forms to the last one, by doubling.

Defined results: null and empty texts have no words. Rows that repeat count again;
a null id is written as nothing. Words are counted over all rows before any is left
out. Columns other than id and text are ignored. No words, no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.batches import small_batches, texts_of
from siltstone.session import shared_dir

WORD = r"[A-Za-zÀ-ÿ]+"
SHORTEST = 6  # code points
RAREST = 5  # occurrences
TIMES = 5
CANDIDATES = 4_096  # pairs of one list
HELD = 1 << 17  # distinct words counted at once in a task

Change = Callable[[str, list[str]], list[str]]


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", change: Change | None = None, shortest: int = SHORTEST, rarest: int = RAREST) -> DataFrame:
    """(word, n): words of `shortest` code points and `rarest` occurrences or more, A to Z in lower case.

    change: gives what stands for each distinct word of a document, from the id as text and the words.
    """
    small_batches(docs.sparkSession)
    pattern = re.compile(WORD)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())
        total: Counter[str] = Counter()

        def gathered() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])
            total.clear()
            return made

        for batch in batches:
            for key, raw in zip(batch.column(0).to_pylist(), texts_of(batch, "text"), strict=True):
                found = Counter(pattern.findall(raw.lower().decode()))  # of bytes: only A to Z
                words = change(key or "", list(found)) if change else found
                for word, n in zip(words, found.values(), strict=True):
                    if len(word) >= shortest:
                        total[word] += n
                if len(total) > HELD:
                    yield gathered()
        yield gathered()

    picked = docs.select(docs[doc_id].cast("string").alias("key"), docs[text].alias("text"))
    counted = picked.mapInArrow(scan, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= rarest)


def _key(length: Column, a: Column, b: Column, size: Column) -> Column:
    """The part of a word outside [a, b) of a chunk word of this length, as found in a word of `size` code points."""
    return F.xxhash64(length, a, b, F.substring("word", F.lit(1), a), F.substring("word", size - (length - b) + 1, length - b))


def _refined(rows: DataFrame) -> DataFrame:
    """Each row twice, with the first and with the last half of its open part fixed."""
    half = F.floor((F.col("b") - F.col("a")) / 2).cast("int")
    parts = F.array(F.struct((F.col("a") + half).alias("a"), F.col("b").alias("b")), F.struct(F.col("a").alias("a"), (F.col("b") - half).alias("b")))
    split = rows.select("word", "n", "size", "length", "chunk", F.explode(parts).alias("part")).select("word", "n", "size", "length", "chunk", "part.*")
    return split.withColumn("key", _key(F.col("length"), F.col("a"), F.col("b"), F.col("size")))


def near_pairs(words: DataFrame, candidates: int = CANDIDATES) -> DataFrame:
    """(x, n_x, y, n_y): every pair of near words once, x not longer than y. words: distinct word, n."""
    spark = words.sparkSession

    def kept(df: DataFrame, label: str) -> DataFrame:
        folder = shared_dir(spark, label)
        df.write.parquet(folder)
        return spark.read.parquet(folder)

    size = F.length("word")
    # As a chunk word, and as the gram word of chunk words as long or one shorter.
    roles = F.array(*[F.struct((size - d).alias("length"), F.lit(c).alias("chunk")) for d, c in ((0, True), (0, False), (1, False))])
    rows = words.select("word", "n", size.alias("size"), F.explode(roles).alias("role")).select("word", "n", "size", "role.*")
    rows = _refined(rows.withColumn("a", F.lit(0)).withColumn("b", F.col("length")))
    found = []
    while True:
        lists = rows.groupBy("key").agg(F.count_if("chunk").alias("c"), F.count_if(~F.col("chunk")).alias("g")).filter("c > 0 AND (c > 1 OR g > 1)")
        held = kept(rows.join(lists.select("key", (F.col("c") * F.col("g")).alias("pairs")), "key"), "chunks")
        many = (F.col("pairs") > candidates) & (F.col("b") - F.col("a") > 1)
        few = held.filter(~many)
        x = few.filter("chunk").select("key", F.col("word").alias("x"), F.col("n").alias("n_x"), "length")
        y = few.filter("NOT chunk").select("key", F.col("word").alias("y"), F.col("n").alias("n_y"), "size")
        met = x.join(y, "key").filter((F.col("length") < F.col("size")) | (F.col("x") < F.col("y")))
        found.append(kept(met.filter(F.levenshtein("x", "y", 1) == 1).select("x", "n_x", "y", "n_y"), "near"))
        rest = held.filter(many)
        if rest.isEmpty():
            break
        rows = _refined(rest.drop("key", "pairs"))
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs.distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where forms lead to. forms: word, form, of distinct words and without circles."""
    spark = forms.sparkSession

    def kept(df: DataFrame) -> DataFrame:
        folder = shared_dir(spark, "roots")
        df.write.parquet(folder)
        return spark.read.parquet(folder)

    now = kept(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")))
    while not now.filter("moved").isEmpty():
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = kept(now.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
    return now.select("word", "root")


def group_variants(words: DataFrame, times: int = TIMES, candidates: int = CANDIDATES) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for each word. words: distinct word, n."""
    spark = words.sparkSession

    def kept(df: DataFrame, label: str) -> DataFrame:
        folder = shared_dir(spark, label)
        df.write.parquet(folder)
        return spark.read.parquet(folder)

    words = kept(words.select("word", "n"), "words")
    pairs = kept(near_pairs(words, candidates), "pairs")
    sides = F.array(
        F.struct(F.col("x").alias("word"), (-F.col("n_y")).alias("less"), F.col("y").alias("other")),
        F.struct(F.col("y").alias("word"), (-F.col("n_x")).alias("less"), F.col("x").alias("other")),
    )
    each = pairs.select(F.explode(sides).alias("s")).select("s.*")
    near = each.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct("less", "other")).alias("best"))
    often = -F.col("best.less") >= times * F.col("n")
    judged = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(often, F.col("best.other")).alias("form"), F.when(often, -F.col("best.less")).alias("form_n"),
    )
    judged = kept(judged, "forms")
    led = roots(judged.filter("form IS NOT NULL"))
    return judged.join(led, "word", "left").withColumn("root", F.coalesce("root", "word"))
