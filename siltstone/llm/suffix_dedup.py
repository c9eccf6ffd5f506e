"""Repeated byte strings: every byte that lies in a `length`-byte string that starts twice or more.

Not all suffixes of a corpus can be sorted in one place, so strings are brought
together by their content first, by rules that equal strings share:

* **Anchors.** Among the hashes of all `gram`-byte strings within a window of
  `length` bytes the least (the leftmost of equals) is the window's anchor.
  Equal windows have equal anchors at equal places, so a window that repeats
  has an anchor that repeats. About every 70th byte is an anchor; those that
  occur once are dropped, and with them all text that is new.
* **Classes.** Anchors with equal surroundings (the bytes that windows around
  them can hold) are one class. A class of two or more is repeated as a whole,
  so copies cost a hash each, whatever their number.
* **Suffix arrays.** What is left are anchors with surroundings that differ,
  one text for each class. These are gathered by anchor, whose own bytes, the
  same in all, shrink to one symbol, and the suffixes that begin at or before it
  are sorted in two stages: those smaller than their successor directly, all
  others induced by a scan of the buckets by first symbol. Neighbours with a
  common prefix as long as a window are repeats.
  An anchor with more than `BLOCK` classes is dealt over several tasks; their
  distinct windows are then compared across tasks by fingerprint, first of the
  core that `RANGE` neighbouring windows share, then of those left.

Defined results: a null text is empty; empty and short texts lose nothing.
Matches never cross texts. Rows that repeat are separate occurrences, so both
lose what they share; a null id is an id like any other. Overlapping strings
count. Judged on the input, not on what is left. Texts are UTF-8 bytes of any
length. Columns beside id and text are ignored. No rows in, no rows out.
Equality of anchors and surroundings is by 128 bits of hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.batches import slices, small_batches, texts_of
from siltstone.llm.shingles import BASE, INVERSE, mixed, powers
from siltstone.session import shared_dir

LENGTH = 400
GRAM = 257  # a window then differs from others with its anchor in 143 bytes only
BLOCK = 4_096  # classes of one anchor in a task
RANGE = 8  # windows of a split anchor that are first compared by their core
SORTED_BYTES = 1 << 17  # of surroundings sorted at once, some 100 bytes of memory each; one anchor's are never parted
SLICE_BYTES = 1 << 18  # of text scanned at once, some 120 bytes of memory each
SEGMENT = 1 << 23
BROADCAST_ROWS = 1 << 20  # of 8 to 16 bytes
INDEX = np.uint64((1 << 24) - 1)


def _rows(columns: dict, types: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[n], t) for n, t in types.items()], names=list(types))


def _anchors(data: np.ndarray, whole: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of anchors in `data`, hashes of their grams, sums for other hashes; whole: does a window begin there, by byte."""
    n = len(data)
    reach = length - gram + 1
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none.astype(np.uint64), none.astype(np.uint64)
    with np.errstate(over="ignore"):
        up, down = powers(BASE, n + 1), powers(INVERSE, n + 1)
        upto = np.r_[np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n])]
        grams = mixed((upto[gram:] - upto[: n - gram + 1]) * down[: n - gram + 1])
    found = []
    for a in range(0, n - length + 1, SEGMENT):
        # Hash in front, place behind: the least is the leftmost of the least.
        part = grams[a : a + SEGMENT + reach - 1]
        part = (part & ~INDEX) | np.arange(len(part), dtype=np.uint64)
        full = np.full(-(-len(part) // reach) * reach, np.uint64(0xFFFFFFFFFFFFFFFF))
        full[: len(part)] = part
        blocks = full.reshape(-1, reach)
        forward = np.minimum.accumulate(blocks, axis=1).ravel()
        backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        windows = len(part) - reach + 1
        least = np.minimum(backward[:windows], forward[reach - 1 : reach - 1 + windows])
        inside = whole[a : a + windows]
        found.append((least[inside] & INDEX).astype(np.int64) + a)
    places = np.unique(np.concatenate(found))
    return places, grams[places], upto


def _surroundings(places: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    return np.maximum(starts[places], places - (length - gram)), np.minimum(ends[places], places + length)


def _placed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, whole: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of anchors in `data`, hashes of their grams and of their surroundings; starts, ends: of the text, by byte."""
    places, grams, upto = _anchors(data, whole, length, gram)
    if not len(places):
        return places, grams, grams
    low, high = _surroundings(places, starts, ends, length, gram)
    with np.errstate(over="ignore"):
        return places, grams, mixed((upto[high] - upto[low]) * powers(INVERSE, len(data) + 1)[low] + mixed(((places - low) << 32 | (high - low)).astype(np.uint64)))


def _placed_in_pieces(text: bytes, length: int, gram: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The same of one text, by `SLICE_BYTES` windows, each with the bytes around its anchors."""
    last = -1
    for a in range(0, len(text) - length + 1, SLICE_BYTES):
        begin = max(0, a - length)
        data = np.frombuffer(text[begin : a + SLICE_BYTES + 2 * length], np.uint8)
        at = np.arange(len(data))
        own = (at >= a - begin) & (at < a - begin + SLICE_BYTES) & (len(data) - at >= length)
        places, grams, around = _placed(data, np.zeros_like(at), np.full_like(at, len(data)), own, length, gram)
        new = places + begin > last  # anchors ascend with their windows, so a piece can only repeat the last
        if new.any():
            last = int(places[-1]) + begin
            yield places[new] + begin, grams[new], around[new]


def anchors(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(anchor, around, id, hash, pos): one row for each anchor of each text."""
    types = {"anchor": pa.int64(), "around": pa.int64(), "id": pa.int64(), "hash": pa.int64(), "pos": pa.int64()}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                texts = texts_of(part, "text")
                ids, hashes = part.column(0).to_numpy(), part.column(1).to_numpy()
                if len(texts) == 1 and len(texts[0]) > SLICE_BYTES:
                    for places, grams, around in _placed_in_pieces(texts[0], length, gram):
                        one = np.zeros_like(places)
                        yield _rows({"anchor": grams.view(np.int64), "around": around.view(np.int64), "id": ids[one], "hash": hashes[one], "pos": places}, types)
                    continue
                size = np.array([len(t) for t in texts], np.int64)
                bounds = np.r_[0, np.cumsum(size)]
                data = np.frombuffer(b"".join(texts), np.uint8)
                starts, ends = np.repeat(bounds[:-1], size), np.repeat(bounds[1:], size)
                places, grams, around = _placed(data, starts, ends, ends - np.arange(len(data)) >= length, length, gram)
                if not len(places):
                    continue
                row = np.searchsorted(bounds, places, side="right") - 1
                yield _rows({"anchor": grams.view(np.int64), "around": around.view(np.int64), "id": ids[row], "hash": hashes[row], "pos": places - bounds[row]}, types)

    return docs.select("id", "hash", "text").mapInArrow(scan, "anchor bigint, around bigint, id bigint, hash bigint, pos bigint")


def surroundings(docs: DataFrame, wanted: DataFrame, length: int, gram: int) -> DataFrame:
    """(anchor, part, split, around, before, after): the bytes around one place of each class.

    wanted: id, hash, places (array of anchor, around, part, split, pos).
    """
    side = length - gram
    types = {"anchor": pa.int64(), "part": pa.int32(), "split": pa.bool_(), "around": pa.int64(), "before": pa.binary(), "after": pa.binary()}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                out = []
                for text, places in zip(texts_of(part, "text"), part.column(part.schema.get_field_index("places")).to_pylist(), strict=True):
                    for x in places:
                        at = x["pos"]
                        out.append((x["anchor"], x["part"], x["split"], x["around"], text[max(0, at - side) : at], text[at + gram : at + length]))
                if out:
                    yield _rows(dict(zip(types, zip(*out, strict=True), strict=True)), types)

    ids = wanted.select("id", "hash")
    if ids.count() <= BROADCAST_ROWS:  # then only these texts are shuffled, else all
        docs = docs.join(F.broadcast(ids), ["id", "hash"], "left_semi")
    joined = docs.join(wanted, ["id", "hash"]).select("text", "places")
    return joined.mapInArrow(cut, "anchor bigint, part int, split boolean, around bigint, before binary, after binary")


def sort_in_two_stages(symbols: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """`starts` in the order of the suffixes of `symbols` there, compared up to `depth` symbols.

    starts: ascending; after each comes the next one, or a symbol smaller than all that begin suffixes before it.
    """
    # First stage: suffixes that begin with a smaller symbol than the next, or the same and so on.
    here, following = symbols[starts], symbols[starts + 1]
    differs = np.flatnonzero(here != following)
    decider = np.minimum(np.searchsorted(differs, np.arange(len(starts))), len(differs) - 1)
    smaller = (here < following)[differs[decider]]
    smaller |= ~np.isin(starts + 1, starts, assume_unique=True)  # nothing to induce it from
    raw = symbols.astype(">u2").tobytes()
    direct = starts[smaller]
    direct = direct[np.argsort(symbols[direct], kind="stable")]
    sorted_by_symbol = {}
    for x in np.split(direct, np.flatnonzero(np.diff(symbols[direct])) + 1):  # only one symbol's keys at a time
        if len(x):
            keys = [raw[2 * i : 2 * (i + depth)] for i in x.tolist()]
            sorted_by_symbol[int(symbols[x[0]])] = x[sorted(range(len(keys)), key=keys.__getitem__)]
    # Second stage: scanned by first symbol, each suffix places the larger one before it.
    induced = np.zeros(len(symbols) + 1, bool)
    induced[starts[~smaller]] = True
    waiting: dict[int, list[np.ndarray]] = {}
    order = []
    todo = sorted({*sorted_by_symbol, *np.unique(symbols[starts]).tolist()})
    for symbol in todo:
        front = waiting.pop(symbol, [])
        head = np.concatenate(front) if front else direct[:0]
        run = head
        while True:
            # Larger suffixes go in front of their bucket, also those that this bucket itself brings.
            order.append(run)
            before = run - 1
            before = before[(before >= 0) & induced[before]]
            same = before[symbols[before] == symbol]
            _wait(waiting, symbols, before[symbols[before] != symbol])
            if not len(same):
                break
            run = same
        last = sorted_by_symbol.get(symbol)
        if last is not None:
            order.append(last)
            before = last - 1
            before = before[(before >= 0) & induced[before]]
            _wait(waiting, symbols, before)
    return np.concatenate(order) if order else direct


def _wait(waiting: dict[int, list[np.ndarray]], symbols: np.ndarray, places: np.ndarray) -> None:
    if len(places):
        by = np.argsort(symbols[places], kind="stable")
        places = places[by]
        first = symbols[places]
        for part in np.split(places, np.flatnonzero(np.diff(first)) + 1):
            waiting.setdefault(int(symbols[part[0]]), []).append(part)


def repeated_windows(groups: list[list[tuple[bytes, bytes]]], side: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows of all members (before, after) of all groups: member, bytes before the anchor, size of its run of equals, run.

    Members are numbered through all groups. A window has `side` bytes beside the anchor's.
    """
    depth = side + 1
    # Symbols: 0 ends a text, then one for each anchor, then bytes. An anchor's is smaller than every byte.
    n_groups = len(groups)
    pieces, lefts, rights = [], [], []
    for g, group in enumerate(groups):
        mark = np.array([g + 1], np.uint16)
        for before, after in group:
            pieces += [np.frombuffer(before, np.uint8).astype(np.uint16) + n_groups + 1, mark, np.frombuffer(after, np.uint8).astype(np.uint16) + n_groups + 1, np.zeros(1, np.uint16)]
            lefts.append(len(before))
            rights.append(len(after))
    symbols = np.concatenate([*pieces, np.zeros(depth + 4, np.uint16)])
    left, right = np.array(lefts), np.array(rights)
    size = left + right + 2
    begin = np.cumsum(size) - size
    member = np.repeat(np.arange(len(left)), left + 1)
    starts = begin[member] + np.arange(len(member)) - np.repeat(np.cumsum(left + 1) - left - 1, left + 1)
    order = sort_in_two_stages(symbols, starts, depth)
    owner = np.searchsorted(begin, order, side="right") - 1
    before = begin[owner] + left[owner] - order
    whole = right[owner] >= side - before  # else the text ends first
    order, owner, before = order[whole], owner[whole], before[whole]
    # Common prefixes of neighbours, four symbols at a time.
    words = symbols[:-3].astype(np.uint64)
    for j in range(1, 4):
        words |= symbols[j : len(symbols) - 3 + j].astype(np.uint64) << np.uint64(16 * j)
    equal = np.flatnonzero(symbols[order[1:]] == symbols[order[:-1]])
    for at in range(0, depth, 4):
        at = min(at, depth - 4)
        equal = equal[words[order[equal] + at] == words[order[equal + 1] + at]]
    joined = np.zeros(len(order), bool)
    joined[equal + 1] = True
    run = np.cumsum(~joined) - 1
    return owner, before, np.bincount(run, minlength=1)[run], run


def _print(before: bytes, after: bytes, left: int, right: int) -> int:
    """Fingerprint of the bytes next to an anchor."""
    digest = hashlib.blake2b(before[len(before) - left :] + after[:right], digest_size=8, salt=left.to_bytes(8, "little"))
    return int.from_bytes(digest.digest(), "little", signed=True)


def sorted_windows(cut: DataFrame, length: int, gram: int) -> DataFrame:
    """kind 0: (anchor, around, low, high), least and most bytes before the anchor of repeated windows;
    kind 1: (anchor, around, low, core, windows), distinct windows of an anchor that is split, by ranges of `before` that share a core."""
    side = length - gram
    types = {"kind": pa.int32(), "anchor": pa.int64(), "around": pa.int64(), "low": pa.int32(), "high": pa.int32(), "core": pa.int64(), "windows": pa.list_(pa.struct({"before": pa.int32(), "print": pa.int64(), "alone": pa.bool_()}))}

    def settle(groups: list[tuple]) -> Iterator[pa.RecordBatch]:
        owner, before, size, run = repeated_windows([g[3] for g in groups], side)
        anchor = np.concatenate([np.full(len(g[2]), g[0], np.int64) for g in groups])
        around = np.concatenate([np.array(g[2], np.int64) for g in groups])
        split = np.concatenate([np.full(len(g[2]), g[1]) for g in groups])
        many = size > 1
        if many.any():
            low, high = np.full(len(anchor), side + 1, np.int32), np.full(len(anchor), -1, np.int32)
            np.minimum.at(low, owner[many], before[many])
            np.maximum.at(high, owner[many], before[many])
            hit = np.flatnonzero(high >= 0)
            yield _rows({"kind": np.zeros(len(hit), np.int32), "anchor": anchor[hit], "around": around[hit], "low": low[hit], "high": high[hit], "core": np.zeros(len(hit), np.int64), "windows": pa.nulls(len(hit))}, types)
        # Of an anchor that is split: one of each run of equal windows, in ranges that share a core.
        _, first = np.unique(run, return_index=True)
        first = first[split[owner[first]]]
        if len(first):
            texts = [m for g in groups for m in g[3]]
            span = before[first] // RANGE
            first = first[np.lexsort((span, owner[first]))]
            name = owner[first] * np.int64(side + 1) + before[first] // RANGE
            out = []
            for rows in np.split(first, np.flatnonzero(np.diff(name)) + 1):
                o, j = int(owner[rows[0]]), int(before[rows[0]]) // RANGE
                left, right = texts[o]
                befores = before[rows].tolist()
                prints = [_print(left, right, b, side - b) for b in befores]
                core = _print(left, right, j * RANGE, max(0, side - j * RANGE - RANGE + 1))
                out.append((1, int(anchor[o]), int(around[o]), j, j, core, [dict(before=b, print=p, alone=x) for b, p, x in zip(befores, prints, (size[rows] == 1).tolist(), strict=True)]))
                if len(out) == 4_000:
                    yield _rows(dict(zip(types, zip(*out, strict=True), strict=True)), types)
                    out = []
            if out:
                yield _rows(dict(zip(types, zip(*out, strict=True), strict=True)), types)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: list[tuple] = []
        total, key, last = 0, None, None
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                anchor, part, split, around, before, after = row
                if (anchor, part) != key:
                    if total > SORTED_BYTES or len(groups) > 30_000:
                        yield from settle(groups)
                        groups, total = [], 0
                    key = (anchor, part)
                    groups.append((anchor, split, [], []))
                elif around == last:  # the same class from a row that repeats
                    continue
                last = around
                groups[-1][2].append(around)
                groups[-1][3].append((before, after))
                total += len(before) + len(after)
        if groups:
            yield from settle(groups)

    placed = cut.repartition("anchor", "part").sortWithinPartitions("anchor", "part", "around")
    return placed.mapInArrow(scan, "kind int, anchor bigint, around bigint, low int, high int, core bigint, windows array<struct<before:int,print:bigint,alone:boolean>>")


def repeated_spans(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(id, hash, spans): merged spans [from, to) of repeated bytes; `to` may lie beyond the text. docs: id, hash, text."""
    spark = docs.sparkSession
    small_batches(spark)

    def kept(df: DataFrame, label: str) -> DataFrame:
        folder = shared_dir(spark, label)
        df.write.parquet(folder)
        return spark.read.parquet(folder)

    side = length - gram
    found = anchors(docs, length, gram)
    again = kept(found.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor"), "anchors")
    if again.count() <= BROADCAST_ROWS:
        again = F.broadcast(again)
    found = kept(found.join(again, "anchor", "left_semi"), "places")
    classes = kept(found.groupBy("anchor", "around").agg(F.count("*").alias("n"), F.min("id").alias("id"), F.min_by(F.struct("hash", "pos"), F.struct("id", "hash", "pos")).alias("at")), "classes")
    several = classes.groupBy("anchor").agg(F.count("*").alias("c")).filter("c > 1")
    place = F.struct("anchor", "around", F.pmod(F.xxhash64("around"), F.ceil(F.col("c") / BLOCK)).cast("int").alias("part"), (F.col("c") > BLOCK).alias("split"), "at.pos")
    wanted = kept(classes.join(several, "anchor").groupBy("id", F.col("at.hash").alias("hash")).agg(F.collect_list(place).alias("places")), "wanted")
    windows = kept(sorted_windows(surroundings(docs, wanted, length, gram), length, gram), "windows")
    prints = windows.filter("kind = 1")
    # Ranges whose core occurs once have no equal windows elsewhere.
    cores = prints.groupBy("anchor", "low", "core").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    single = kept(prints.join(cores, ["anchor", "low", "core"]).select("anchor", "around", F.explode("windows").alias("w")).select("anchor", "around", "w.*"), "prints")
    crossing = single.groupBy("anchor", "before", "print").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    across = single.filter("alone").join(crossing, ["anchor", "before", "print"]).select("anchor", "around", F.col("before").alias("low"), F.col("before").alias("high"))
    whole = classes.filter("n > 1").select("anchor", "around", F.lit(0).alias("low"), F.lit(side).alias("high"))
    spans = (
        windows.filter("kind = 0").select("anchor", "around", "low", "high").unionByName(across).unionByName(whole)
        .groupBy("anchor", "around").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    )
    # All windows of an anchor hold it, so together they are one span.
    start = F.greatest(F.lit(0).cast("long"), F.col("pos") - F.col("high"))
    each = found.join(spans, ["anchor", "around"]).select("id", "hash", F.struct(start.alias("a"), (F.col("pos") - F.col("low") + length).alias("b")).alias("s"))
    # Rows that repeat have the same spans, and one value holds them once.
    return each.groupBy("id", "hash").agg(F.sort_array(F.collect_set("s")).alias("spans"))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, texts: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) and, with `texts`, kept (binary)."""
    if not 8 <= length - gram + 1 or gram < 8 or (length - gram + 1) % 4:
        raise ValueError("length - gram + 1 must be a multiple of four, 8 or more, and gram 8 or more")
    keyed = docs.select(
        docs[doc_id].alias("doc_id"), docs[text].alias("text"),
        F.coalesce(docs[doc_id].cast("long"), F.lit(-(2**63))).alias("id"), F.xxhash64(docs[text], F.lit(1)).alias("hash"),
    )
    spans = repeated_spans(keyed.select("id", "hash", "text"), length, gram)
    kind = docs.schema[doc_id].dataType.simpleString()
    types = {"n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string(), **({"kept": pa.binary()} if texts else {})}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for raw, found in zip(texts_of(batch, "text"), batch.column(2).to_pylist(), strict=True):
                kept, at, n_spans = [], 0, 0
                end = -1
                for s in found or []:
                    a, b = s["a"], min(s["b"], len(raw))
                    if a > end:
                        kept.append(raw[at:a])
                        n_spans += 1
                    end = at = max(end, b)
                kept.append(raw[at:])
                left = b"".join(kept)
                out.append((len(raw), len(raw) - len(left), n_spans, hashlib.sha256(left).hexdigest(), left)[: len(types)])
            made = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types.values(), strict=True)] if out else [pa.array([], t) for t in types.values()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=["doc_id", *types])

    joined = keyed.join(spans, ["id", "hash"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(cut, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept binary" * texts)
