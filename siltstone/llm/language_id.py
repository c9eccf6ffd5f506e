"""Language identification by compression.

Each language has a raw-content zstandard dictionary of labelled text. Text is
brought to its letters, in lower case and with single blanks between; it
is cut into pieces of `PIECE_BYTES`, every piece is compressed with every
dictionary, and the language with the smallest total wins. Compared with the
runner-up this gives a margin; a margin below `min_margin` sets `rejected`.

The dictionaries are fitted on a bounded sample: about `sample_docs` texts a
language, the first `sample_chars` characters of each, `dictionary_bytes` in
all, drawn by a hash of the text from the distinct texts of each language, of which at
least one is taken. That bound is a parameter and the same at every size of the
input. Prediction reads whole texts.

Defined results: a null text, a text without a letter, and any text when no
language was learned give `und` with score 0. Rows without a label, or whose
text is null or has no letter, teach nothing. A tie goes to the language that
sorts first. With one language learned every text gets it, with score 1.
Repeated rows get equal results. Input columns are kept; those added are in
`ADDED`, which may not be among them. No rows in, no rows out.
"""

from __future__ import annotations

import re

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from siltstone.llm.batches import with_columns

UNKNOWN = "und"
PIECE_BYTES = 8 << 10
LEVEL = 6
MAX_LANGUAGES = 1_000

ADDED = StructType([
    StructField("lang_pred", StringType()),
    StructField("score", DoubleType()),
    StructField("margin", DoubleType()),
    StructField("rejected", BooleanType()),
])


NO_LETTERS = re.compile(r"[\W\d_]+")


def letters_of(text: str) -> bytes:
    return NO_LETTERS.sub(" ", text.lower()).strip().encode()


def fit(
    labelled: DataFrame,
    text: str = "text",
    lang: str = "lang",
    sample_docs: int = 384,
    sample_chars: int = 1_000,
    dictionary_bytes: int = 256 << 10,
) -> dict[str, bytes]:
    """Raw dictionary by language, all of one size where there is text enough."""
    usable = labelled.select(labelled[text].alias("t"), labelled[lang].alias("l")).filter(
        F.col("l").isNotNull() & F.col("t").rlike("\\p{L}")
    )
    # Copies are one text: they stand or fall together in the draw, so a language's texts are counted once each.
    usable = usable.withColumn("h", F.xxhash64("t", F.lit("draw")))
    sizes = usable.groupBy("l").agg(F.approx_count_distinct("h").alias("texts"), F.min("h").alias("least")).limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: is {lang!r} a label?")
    if not sizes:
        return {}
    # A draw by hash keeps about four times what is needed, whatever the size of a language, and its least hash.
    bound = {r["l"]: max(r["least"], int(2.0**64 * min(1.0, 4 * sample_docs / max(1, r["texts"])) - 2.0**63) - 1) for r in sizes}
    most = F.create_map(*[F.lit(x) for lang, h in bound.items() for x in (lang, min(h, 2**63 - 1))])
    rows = (
        usable.filter(F.col("h") <= most[F.col("l")].cast("bigint"))
        .select("l", "h", F.substring("t", 1, sample_chars).alias("t"))
        .distinct()
        .collect()
    )
    found: dict[str, bytes] = {}
    for row in sorted(rows, key=lambda r: (r["l"], r["h"], r["t"])):
        text_bytes = letters_of(row["t"])
        if len(found.get(row["l"], b"")) < dictionary_bytes:
            found[row["l"]] = found.get(row["l"], b"") + text_bytes + b"\n"
    return {k: v[:dictionary_bytes] for k, v in sorted(found.items())}


def predict(df: DataFrame, dictionaries: dict[str, bytes], text: str = "text", min_margin: float = 0.02, sharpness: float = 40.0) -> DataFrame:
    """`df` with `ADDED`; only the text is read."""
    shared = df.sparkSession.sparkContext.broadcast(dictionaries)  # languages x dictionary_bytes
    letter = regex.compile(r"\p{L}")

    def judge(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        coders = []
        for name, content in shared.value.items():
            raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(level=LEVEL)
            coders.append((name, zstandard.ZstdCompressor(level=LEVEL, dict_data=raw, write_content_size=False, write_dict_id=False).compress))
        column = batch.column(batch.schema.get_field_index(text))
        out = []
        for value in column.to_pylist():
            if not coders or value is None or not letter.search(value):
                out.append((UNKNOWN, 0.0, 0.0, True))
                continue
            raw = letters_of(value)
            pieces = [raw[i : i + PIECE_BYTES] for i in range(0, max(1, len(raw)), PIECE_BYTES)]
            costs = sorted((sum(len(code(p)) for p in pieces), name) for name, code in coders)
            if len(costs) == 1:
                out.append((costs[0][1], 1.0, 1.0, False))
                continue
            (best, name), (second, _) = costs[:2]
            margin = 1 - best / second
            out.append((name, 1 / (1 + (best / second) ** sharpness), margin, margin < min_margin))
        columns = zip(*out, strict=True)
        types = (pa.string(), pa.float64(), pa.float64(), pa.bool_())
        return {n: pa.array(c, t) for n, c, t in zip(ADDED.names, columns, types, strict=True)} if out else {
            n: pa.array([], t) for n, t in zip(ADDED.names, types, strict=True)
        }

    return with_columns(df, ADDED, judge)


def held_out(doc_id: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """Rows that teach nothing; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds == fold
