"""Benchmark decontamination with a generalised suffix automaton over words.

Items and documents are lower-cased (A-Z) and cut into words of digits, letters
and non-ASCII characters. The automaton holds every run of words of every item;
a document's words are streamed through it, and at each word it gives the
longest run ending there that occurs in an item. Where that reaches `window`
words (or a whole shorter item), the words of the window are hit.

The automaton is broadcast, so its size is bounded: items are cut into pieces
that overlap by `window - 1` words (no window is lost) and dealt to blocks of
about `block_words` words; each block is one more pass over the documents. Items of
equal words are one group: their words are held once, and beside them their ids.

Defined results: null and empty texts have no words, no hits and stay as they
are. Items without words match nothing. Items whose id is null hit words but
are not named in `item_ids`. Items that repeat an id count once. Repeated
documents are judged one by one. All input columns are kept; `HIT_COLUMNS` may
not be among them. No documents: an empty result; no items: no hits.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from siltstone.llm.batches import small_batches, texts_of, with_columns
from siltstone.session import shared_dir

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
PIECE_WORDS = 2_000

HITS = StructType([
    StructField("n_words", LongType()),
    StructField("longest_match", IntegerType()),
    StructField("hit_spans", ArrayType(ArrayType(IntegerType()))),
    StructField("item_ids", ArrayType(StringType())),
])
HIT_COLUMNS = (*HITS.names, "n_hit", "cleaned")


def words_of(text: bytes) -> list[bytes]:
    return WORD.findall(text.lower())


class Piece(NamedTuple):
    item: str | None  # its name
    words: list[bytes]
    whole: bool  # a whole item of fewer words than the window


class Automaton:
    """Suffix automaton of pieces; the arrays are indexed by state, 0 is the root."""

    def __init__(self, pieces: list[Piece], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.length, self.link = [0], [-1]
        self.arc: dict[int, int] = {}  # (state << 32 | word) -> state
        self._out: list[set[int]] = [set()]  # words that leave a state, needed to copy it
        coded = [[self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in p.words] for p in pieces]
        for ids in coded:
            last = 0
            for word in ids:
                last = self._extend(last, word)
        del self._out
        # Which items a window or a short item belongs to, by its state.
        self.items: dict[int, set[str | None]] = {}
        self.short: dict[int, dict[int, set[str | None]]] = {}
        for piece, ids in zip(pieces, coded, strict=True):
            state = size = 0
            for word in ids:
                state, size = self.step(state, size, word)
                if size >= window:
                    self.items.setdefault(self.at_length(state, window), set()).add(piece.item)
            if piece.whole:
                self.short.setdefault(state, {}).setdefault(len(ids), set()).add(piece.item)
        self.least = min([window, *(n for found in self.short.values() for n in found)])

    def _new(self, length: int, link: int, out: set[int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self._out.append(out)
        return len(self.length) - 1

    def _extend(self, last: int, word: int) -> int:
        known = self.arc.get(last << 32 | word)
        if known is not None:  # of an earlier piece
            return known if self.length[known] == self.length[last] + 1 else self._copy(last, known, word)
        made = self._new(self.length[last] + 1, 0, set())
        state = last
        while state != -1 and (state << 32 | word) not in self.arc:
            self.arc[state << 32 | word] = made
            self._out[state].add(word)
            state = self.link[state]
        if state != -1:
            target = self.arc[state << 32 | word]
            self.link[made] = target if self.length[target] == self.length[state] + 1 else self._copy(state, target, word)
        return made

    def _copy(self, state: int, target: int, word: int) -> int:
        twin = self._new(self.length[state] + 1, self.link[target], set(self._out[target]))
        for w in self._out[target]:
            self.arc[twin << 32 | w] = self.arc[target << 32 | w]
        self.link[target] = twin
        while state != -1 and self.arc.get(state << 32 | word) == target:
            self.arc[state << 32 | word] = twin
            state = self.link[state]
        return twin

    def step(self, state: int, size: int, word: int) -> tuple[int, int]:
        """The state and length of the longest match after one more word."""
        to = self.arc.get(state << 32 | word)
        while to is None and state:
            state = self.link[state]
            size = self.length[state]
            to = self.arc.get(state << 32 | word)
        return (to, size + 1) if to is not None else (0, 0)

    def at_length(self, state: int, size: int) -> int:
        """The state of the match's last `size` words."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def match(self, words: list[bytes]) -> tuple[int, list[list[int]], set[str | None]]:
        """Longest match, spans [from, to) of hit words, items found."""
        get = self.vocabulary.get
        longest, spans, found = 0, [], set()
        place = 0
        # A word of no item ends every match, so runs of known words stand alone.
        for known, run in groupby([get(w, 0) for w in words], bool):
            ids = list(run)
            if known:
                if len(ids) >= self.least:
                    longest = max(longest, self._match_run(ids, place, spans, found))
                elif not longest:
                    longest = 1
            place += len(ids)
        return longest, spans, found

    def _match_run(self, ids: list[int], place: int, spans: list[list[int]], found: set[str | None]) -> int:
        state = size = longest = 0
        for end, word in enumerate(ids, place + 1):
            state, size = self.step(state, size, word)
            longest = max(longest, size)
            reach = 0
            if size >= self.window:
                reach = self.window
                found |= self.items[self.at_length(state, self.window)]
            above, most = state, size
            while above and self.short:
                for n, items in self.short.get(above, {}).items():
                    if n <= most:
                        reach = max(reach, n)
                        found |= items
                above = self.link[above]
                most = self.length[above]
            if reach:
                # Spans grow at their end only, but a long one may swallow several.
                start = end - reach
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append([start, end])
        return longest


def _merge(spans: list[list[int]]) -> list[list[int]]:
    merged: list[list[int]] = []
    for start, end in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(end, merged[-1][1])
        else:
            merged.append([start, end])
    return merged


def item_pieces(items: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """(item, group, words, n, whole): words joined by blanks, at most PIECE_WORDS of them; group: a digest of all the item's words."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for item, raw in zip(batch.column(0).to_pylist(), texts_of(batch, "text"), strict=True):
                words = words_of(raw)
                group = hashlib.md5(b" ".join(words), usedforsecurity=False).hexdigest()
                for at in range(0, max(1, len(words) - window + 1), PIECE_WORDS - window + 1):
                    part = words[at : at + PIECE_WORDS]
                    if part:
                        out.append((item, group, b" ".join(part), len(part), len(words) < window))
            columns = [list(c) for c in zip(*out, strict=True)] if out else [[], [], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.binary(), pa.int64(), pa.bool_()), strict=True)],
                names=["item", "group", "words", "n", "whole"],
            )

    picked = items.select(items[item_id].cast("string").alias("item"), items[text].alias("text"))
    return picked.mapInArrow(cut, "item string, group string, words binary, n bigint, whole boolean")


def find_hits(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 13,
    block_words: int = 250_000,
    max_span_words: int | None = None,
) -> DataFrame:
    """`docs` with n_words, longest_match, hit_spans (words, end exclusive), item_ids (sorted) and n_hit.

    With `max_span_words` also `cleaned`: the text without spans of more words; other texts stay byte for byte.
    """
    clash = set(HIT_COLUMNS) & set(docs.columns)
    if clash:
        raise ValueError(f"columns in the way: {sorted(clash)}")
    spark = docs.sparkSession
    small_batches(spark)
    folder = shared_dir(spark, "benchmark-pieces")
    item_pieces(items, item_id, item_text, window).write.parquet(folder)
    cut = spark.read.parquet(folder)
    # Items of equal words are one group, whose words are dealt, collected and broadcast once.
    names = cut.filter("item IS NOT NULL").select("group", "item").distinct()
    pieces = cut.select("group", "words", "n", "whole").distinct()
    total, n_bytes = pieces.agg(F.sum("n"), F.sum(F.length("words"))).first()
    blocks = max(1, -(-(total or 0) // block_words), -(-(n_bytes or 0) // (16 * block_words)))
    if blocks > 1:
        folder = shared_dir(spark, "benchmark-blocks")
        pieces.withColumn("block", F.pmod(F.xxhash64("words"), F.lit(blocks))).write.parquet(folder)
        pieces = spark.read.parquet(folder)
    found = docs
    for block in range(blocks):
        part = pieces if blocks == 1 else pieces.filter(F.col("block") == block)
        last = block == blocks - 1
        found = _one_pass(spark, found, text, part, names, window, first=block == 0, cut=max_span_words if last else None)
        if not last:  # one automaton at a time in a worker
            folder = shared_dir(spark, "benchmark-hits")
            found.write.parquet(folder)
            found = spark.read.parquet(folder)
    covered = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, span: n + (span[1] - span[0]))
    return found.withColumn("n_hit", covered)


def _one_pass(
    spark: SparkSession, docs: DataFrame, text: str, part: DataFrame, names: DataFrame, window: int, first: bool, cut: int | None
) -> DataFrame:
    rows = part.select("group", "words", "whole").collect()  # at most about block_words words
    automaton = Automaton([Piece(r["group"], bytes(r["words"]).split(b" "), r["whole"]) for r in rows], window)
    mine = names.join(part.select("group").distinct(), "group", "left_semi").groupBy("group").agg(F.collect_list("item").alias("items"))
    ids_of = {r["group"]: r["items"] for r in mine.collect()}  # an id for each item of the block
    shared = spark.sparkContext.broadcast((vars(automaton), ids_of))  # plain values, readable without this package

    def scan(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        automaton = object.__new__(Automaton)
        automaton.__dict__, ids_of = shared.value
        made: dict[str, list] = {n: [] for n in HITS.names}
        earlier = [[0, [], []] for _ in range(batch.num_rows)]
        if not first:
            earlier = list(zip(*(batch.column(f"__{n}").to_pylist() for n in HITS.names[1:]), strict=True))
        for raw, (length, spans, ids) in zip(texts_of(batch, text), earlier, strict=True):
            words = words_of(raw)
            longest, hit, found = automaton.match(words)
            made["n_words"].append(len(words))
            made["longest_match"].append(max(longest, length))
            made["hit_spans"].append(_merge([*hit, *spans]) if spans else hit)
            made["item_ids"].append(sorted({x for group in found for x in ids_of.get(group, ())}.union(ids)) if found or ids else [])
        types = (pa.int64(), pa.int32(), pa.list_(pa.list_(pa.int32())), pa.list_(pa.string()))
        out = {n: pa.array(made[n], t) for n, t in zip(HITS.names, types, strict=True)}
        if cut is not None:
            texts = batch.column(batch.schema.get_field_index(text)).cast(pa.large_binary()).to_pylist()
            out["cleaned"] = pa.array([_without(t, s, cut) for t, s in zip(texts, made["hit_spans"], strict=True)], pa.string())
        return out

    added = HITS if cut is None else StructType([*HITS.fields, StructField("cleaned", StringType())])
    if first:
        return with_columns(docs, added, scan)
    before = docs.drop("n_words").withColumnsRenamed({n: f"__{n}" for n in HITS.names[1:]})
    return with_columns(before, added, scan).drop(*[f"__{n}" for n in HITS.names[1:]])


def coverage_exceeds(limit_percent: int = 5):
    """The contract's rule: some hit, and hits reach `limit_percent` of the words."""
    return (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= limit_percent * F.col("n_words"))


def _without(raw: bytes | None, spans: list[list[int]], max_span_words: int) -> str | None:
    long = [s for s in spans if s[1] - s[0] > max_span_words]
    if raw is None or not long:
        return None if raw is None else raw.decode()
    places = [m.span() for m in WORD.finditer(raw.lower())]
    kept, at = [], 0
    for start, end in long:
        kept.append(raw[at : places[start][0]])
        at = places[end - 1][1]
    return b"".join([*kept, raw[at:]]).decode()


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", max_span_words: int = 50, limit_percent: int = 5, **how) -> DataFrame:
    """`docs` and `cleaned`: documents over the coverage limit go; spans over the length limit are cut out of the rest."""
    hits = find_hits(docs, items, text, max_span_words=max_span_words, **how).filter(~coverage_exceeds(limit_percent))
    return hits.select(*[F.col(f"`{c}`") for c in (*docs.columns, "cleaned")])
