"""Sampled SentencePiece segmentations: filter forwards, sample backwards.

All ways to cut a text into pieces of the vocabulary form a lattice. Its
probabilities are summed forwards (log domain), then one segmentation is drawn
from the end backwards, each piece with its exact conditional probability.
Random numbers are a hash of (seed, row key, place in the text), so a row gets
the same pieces whatever its batch, task or attempt.

The vocabulary file has merge ranks, not probabilities; a piece of rank r weighs
1 / (r + 1), raised to `alpha` (0: all alike; large: nearly the best path only).
White space is as the model has it: blanks are U+2581 and one is put in front.
Characters outside the vocabulary, U+2581 itself included, become byte pieces,
so decoding gives back every text exactly; that is checked for each row.

The lattice falls apart where no piece can reach across (before a run of
blanks, around byte characters); equal parts of a batch are filtered once.

Defined results: null and empty texts have no pieces (`ids` empty) and decode
to empty text; such rows are lossless. Rows with equal key and text get equal
pieces; a null key is a key like any other. Texts are encoded whole, in memory
in proportion to the longest. Input columns are kept; `ADDED` may not be among
them. No rows in, no rows out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from siltstone.llm.batches import slices, with_columns

BLANK = 0x2581
FOREIGN = 0x110000  # stands for U+2581 in a text
SLICE_BYTES = 1 << 17
KNOWN_CHARS = 1 << 20
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
MIX = np.uint64(0x9E3779B97F4A7C15)

ADDED = StructType([
    StructField("ids", ArrayType(IntegerType())),
    StructField("n_pieces", LongType()),
    StructField("lossless", BooleanType()),
])
DIGESTS = StructType([StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())])


class Vocabulary(NamedTuple):
    """Plain values of a model; `keys` and `to` are a hash table (state, character) -> state of the trie."""

    pieces: list[bytes]  # by id, blanks in place of U+2581
    first_byte: int  # id of byte piece 0
    keys: np.ndarray
    to: np.ndarray
    piece_at: np.ndarray  # id that ends in a trie state, or -1
    weight: np.ndarray  # log weight by id


def read_vocabulary(path: str, alpha: float = 1.0) -> Vocabulary:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    names = [model.id_to_piece(i) for i in range(n)]
    plain = [not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) for i in range(n)]
    bytes_at = [i for i in range(n) if model.is_byte(i)]
    if len(bytes_at) != 256:
        raise ValueError("the model has no byte pieces: decoding would lose characters")
    first = bytes_at[0]
    pieces = [
        names[i].replace(chr(BLANK), " ").encode() if plain[i] else bytes([i - first]) if first <= i < first + 256 else b""
        for i in range(n)
    ]
    arcs: dict[tuple[int, int], int] = {}
    ends: dict[int, int] = {}
    for i in range(n):
        if plain[i]:
            state = 0
            for c in map(ord, names[i]):
                state = arcs.setdefault((state, c), len(arcs) + 1)
            ends[state] = i
    rank = np.cumsum(plain)
    weight = -alpha * np.log(np.maximum(rank, 1).astype(float))
    size = 1 << (2 * len(arcs)).bit_length()
    keys, to = np.full(size, EMPTY), np.zeros(size, np.int32)
    for (state, c), target in arcs.items():
        key = np.uint64(state << 21 | c)
        slot = int(_slot(np.array([key]), size)[0])
        while keys[slot] != EMPTY:
            slot = (slot + 1) % size
        keys[slot], to[slot] = key, target
    piece_at = np.full(len(arcs) + 1, -1, np.int32)
    for state, i in ends.items():
        piece_at[state] = i
    return Vocabulary(pieces, first, keys, to, piece_at, weight)


def _slot(keys: np.ndarray, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((keys * MIX) >> np.uint64(65 - size.bit_length())).astype(np.int64)


def _walk(v: Vocabulary, state: np.ndarray, char: np.ndarray) -> np.ndarray:
    """Next states, -1 where the trie ends."""
    keys = state.astype(np.uint64) << np.uint64(21) | char.astype(np.uint64)
    slot = _slot(keys, len(v.keys))
    seen = v.keys[slot]
    out = np.where(seen == keys, v.to[slot], -1)
    open_ = np.flatnonzero((seen != keys) & (seen != EMPTY))
    while len(open_):
        slot[open_] = (slot[open_] + 1) % len(v.keys)
        seen = v.keys[slot[open_]]
        hit = seen == keys[open_]
        out[open_[hit]] = v.to[slot[open_[hit]]]
        open_ = open_[~hit & (seen != EMPTY)]
    return out


def _uniform(counter: np.ndarray) -> np.ndarray:
    """Hashed counters as numbers in (0, 1)."""
    with np.errstate(over="ignore"):
        x = counter * MIX
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53


class Lattice(NamedTuple):
    """Edges by the place where they end: of `e` in first[p]:first[p + 1], start, piece, cumulative probability."""

    first: np.ndarray
    start: np.ndarray
    piece: np.ndarray
    upto: np.ndarray


def _filter_forwards(v: Vocabulary, chars: np.ndarray, place: np.ndarray, left: np.ndarray) -> Lattice:
    """chars: all parts in a row; place: index of each character in its part; left: characters from it to the part's end."""
    n = len(chars)
    at, state = np.arange(n, dtype=np.int32), np.zeros(n, np.int32)
    starts, ends, ids = [], [], []
    length = 0
    while len(at):
        state = _walk(v, state, chars[at + length])
        length += 1
        alive = state >= 0
        at, state = at[alive], state[alive]
        piece = v.piece_at[state]
        is_piece = piece >= 0
        starts.append(at[is_piece])
        ends.append(at[is_piece] + length)  # exclusive
        ids.append(piece[is_piece])
        more = left[at] > length
        at, state = at[more], state[more]
    start, end, piece = (np.concatenate(x).astype(np.int32) for x in (starts, ends, ids))
    by_end = np.argsort(end, kind="stable")  # each length comes in order, so this merges runs
    start, end, piece = start[by_end], end[by_end], piece[by_end]
    count = np.bincount(end, minlength=n + 2)
    first = np.r_[0, np.cumsum(count)].astype(np.int32)[: n + 2]
    weight = v.weight[piece]
    # Then by the place within the part, so that one step serves all parts.
    depth = place[end - 1]
    small = depth.astype(np.uint16) if len(depth) and depth.max() < 1 << 16 else depth
    order = np.argsort(small, kind="stable").astype(np.int32)
    depth = depth[order]
    steps = np.flatnonzero(np.r_[True, depth[1:] != depth[:-1], True])
    # total[p]: log probability of all ways from the start of a part to before character p; a part's
    # end and the next one's start share a place, hence `begun`.
    total = np.zeros(n + 1)
    begun = place[start] == 0
    reached = np.empty(len(start))
    for a, b in zip(steps[:-1], steps[1:], strict=True):
        edges = order[a:b]
        to = end[edges]
        heads = np.flatnonzero(np.r_[True, to[1:] != to[:-1]])
        value = np.where(begun[edges], 0.0, total[start[edges]]) + weight[edges]
        of = np.cumsum(np.r_[False, to[1:] != to[:-1]])
        most = np.maximum.reduceat(value, heads)
        ratio = np.exp(value - most[of])
        summed = np.add.reduceat(ratio, heads)
        total[to[heads]] = most + np.log(summed)
        reached[edges] = ratio / summed[of]
    # Added up within each place alone, so that a text's numbers do not hang on its batch.
    rank = (np.arange(len(end)) - first[end]).astype(np.uint8)  # pieces are short, so few end at a place
    later = np.argsort(rank, kind="stable")[int((rank == 0).sum()) :]
    for edges in np.split(later, np.flatnonzero(np.diff(rank[later])) + 1):
        reached[edges] += reached[edges - 1]
    return Lattice(first, start, piece, reached.astype(np.float32))


class Known:
    """Lattices of parts seen before, by the part's hash; forgotten all at once beyond `KNOWN_CHARS` characters."""

    def __init__(self) -> None:
        self.names, self.base = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.lattice = Lattice(np.zeros(2, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.float32))

    def look_up(self, v: Vocabulary, names: np.ndarray, size: np.ndarray, chars: Callable) -> tuple[Lattice, np.ndarray]:
        """names: sorted. A lattice that holds these parts, and the place where each begins."""
        if len(self.lattice.first) > KNOWN_CHARS:
            self.__init__()
        spot = np.minimum(np.searchsorted(self.names, names), max(0, len(self.names) - 1))
        new = self.names[spot] != names if len(self.names) else np.ones(len(names), bool)
        rows = np.flatnonzero(new)
        if len(rows):
            more = _filter_forwards(v, *chars(rows))
            places, edges = len(self.lattice.first) - 2, len(self.lattice.start)
            begin = places + np.cumsum(size[rows]) - size[rows]
            # The new places follow the old ones: place 0 of `more` is the last of the old.
            self.lattice = Lattice(
                np.r_[self.lattice.first[:-1], more.first[1:] + edges].astype(np.int32),
                np.r_[self.lattice.start, more.start + places].astype(np.int32),
                np.r_[self.lattice.piece, more.piece],
                np.r_[self.lattice.upto, more.upto],
            )
            merged = np.searchsorted(self.names, names[rows])
            self.names = np.insert(self.names, merged, names[rows])
            self.base = np.insert(self.base, merged, begin)
            spot = np.searchsorted(self.names, names)
        return self.lattice, self.base[spot]


def encode(v: Vocabulary, texts: list[bytes], keys: list[int], known: Known | None = None, share: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids of all texts and where each text's ids begin."""
    decoded = [t.decode() for t in texts]
    sizes = np.array([len(t) + 1 if t else 0 for t in decoded], np.int64)  # with the blank in front
    bounds = np.r_[0, np.cumsum(sizes)]
    n = int(bounds[-1])
    if n == 0:
        return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
    chars = np.frombuffer("".join(" " + t for t in decoded if t).encode("utf-32-le"), np.uint32).astype(np.int64)
    chars = np.where(chars == BLANK, FOREIGN, chars)
    chars[chars == 0x20] = BLANK
    # A text's number is the first of those that begin at its place and are not empty.
    doc = np.repeat(np.arange(len(texts)), sizes)
    foreign = v.piece_at[np.maximum(_walk(v, np.zeros(n, np.int32), chars), 0)] < 0
    blank = chars == BLANK
    new_text = np.r_[True, doc[1:] != doc[:-1]]
    cut = new_text | foreign | np.r_[True, foreign[:-1]] | (blank & ~np.r_[False, blank[:-1]])
    head = np.flatnonzero(cut)
    size = np.diff(np.r_[head, n])
    spelt = ~foreign[head]
    head, size = head[spelt], size[spelt]
    out = np.full(n, -1, np.int32)
    if len(head):
        if share:
            with np.errstate(over="ignore"):
                power = np.cumprod(np.full(int(size.max()) + 1, 0x100000001B3, np.uint64))
                part = np.repeat(np.arange(len(head)), size)
                inner = np.arange(len(part)) - np.repeat(np.cumsum(size) - size, size)
                spots = np.repeat(head, size) + inner
                term = (chars[spots].astype(np.uint64) + np.uint64(1)) * MIX
                term = (term ^ (term >> np.uint64(29))) * power[inner]
                name = np.add.reduceat(term, np.cumsum(size) - size) + size.astype(np.uint64) * MIX
        else:
            name = np.arange(len(head)).astype(np.uint64)
        distinct, rep, which = np.unique(name, return_index=True, return_inverse=True)

        def part_chars(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            length = size[rep[rows]]
            place = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
            return chars[np.repeat(head[rep[rows]], length) + place], place, np.repeat(length, length) - place

        lattice, base = (known or Known()).look_up(v, distinct, size[rep], part_chars)
        _sample_backwards(lattice, out, head, base[which], size, np.array(keys, np.uint64)[doc[head]], bounds[doc[head]])
    return _spell(v, chars, foreign, out, bounds)


def _sample_backwards(lattice: Lattice, out: np.ndarray, head: np.ndarray, base: np.ndarray, size: np.ndarray, key: np.ndarray, text_start: np.ndarray) -> None:
    """Writes into `out` the piece that starts at each character, for all parts at once."""
    at = base + size
    shift = head - base
    while len(at):
        with np.errstate(over="ignore"):
            draw = _uniform(key + (at + shift - text_start).astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
        edge = lattice.first[at]
        last = lattice.first[at + 1] - 1
        wait = np.flatnonzero((lattice.upto[edge] < draw) & (edge < last))
        while len(wait):
            edge[wait] += 1
            wait = wait[(lattice.upto[edge[wait]] < draw[wait]) & (edge[wait] < last[wait])]
        at = lattice.start[edge]
        out[at + shift] = lattice.piece[edge]
        go = at > base
        at, base, shift, key, text_start = at[go], base[go], shift[go], key[go], text_start[go]


def _spell(v: Vocabulary, chars: np.ndarray, foreign: np.ndarray, out: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Puts byte pieces in the place of foreign characters and drops places where no piece starts."""
    value = np.where(chars == FOREIGN, BLANK, chars)
    width = np.where(foreign, 1 + (value > 0x7F) + (value > 0x7FF) + (value > 0xFFFF), (out >= 0).astype(np.int64))
    ends = np.r_[0, np.cumsum(width)]
    ids = np.zeros(int(ends[-1]), np.int32)
    piece = out >= 0
    ids[ends[:-1][piece]] = out[piece]
    spots = np.flatnonzero(foreign)
    short = spots[value[spots] <= 0x7F]
    ids[ends[short]] = v.first_byte + value[short]
    for spot in spots[value[spots] > 0x7F].tolist():
        code = chr(value[spot]).encode()
        ids[ends[spot] : ends[spot] + len(code)] = np.frombuffer(code, np.uint8).astype(np.int32) + v.first_byte
    return ids, ends[bounds]


def decode(pieces: list[bytes], ids: list[int]) -> bytes:
    """The text of some ids: their pieces without the blank in front."""
    return b"".join([pieces[i] for i in ids])[1:]


def sample_pieces(df: DataFrame, model: str, text: str = "text", key: str = "doc_id", seed: int = 0, alpha: float = 1.0, digests: bool = False) -> DataFrame:
    """`df` with `ADDED` (with `digests` also `DIGESTS`, in place of the ids); one pass, no shuffle."""
    shared = df.sparkSession.sparkContext.broadcast(tuple(read_vocabulary(model, alpha)))  # one vocabulary
    added = StructType([*ADDED.fields[digests:], *(DIGESTS.fields if digests else [])])

    known = Known()  # each task unpacks its own

    def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        v = Vocabulary(*shared.value)
        made: dict[str, list] = {n: [] for n in added.names}
        for part in slices(batch, text, SLICE_BYTES):
            texts = [x or b"" for x in part.column(part.schema.get_field_index(text)).cast(pa.large_binary()).to_pylist()]
            keys = [xxhash.xxh64_intdigest(repr(k), seed) for k in part.column(part.schema.get_field_index(key)).to_pylist()]
            flat, first = encode(v, texts, keys, known)
            back = [decode(v.pieces, flat[a:b].tolist()) for a, b in zip(first[:-1], first[1:], strict=True)]
            if back != texts:  # two parts with one hash: filter every part for itself
                flat, first = encode(v, texts, keys, share=False)
                back = [decode(v.pieces, flat[a:b].tolist()) for a, b in zip(first[:-1], first[1:], strict=True)]
            if digests:
                made["ids_sha256"] += [hashlib.sha256(flat[a:b].astype("<i4").tobytes()).hexdigest() for a, b in zip(first[:-1], first[1:], strict=True)]
                made["decoded_sha256"] += [hashlib.sha256(x).hexdigest() for x in back]
            else:
                made["ids"].append(pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(flat, pa.int32())))
            made["n_pieces"] += np.diff(first).tolist()
            made["lossless"] += [a == b for a, b in zip(back, texts, strict=True)]
        types = {"n_pieces": pa.int64(), "lossless": pa.bool_(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}
        out = {n: pa.array(made[n], types[n]) for n in added.names if n != "ids"}
        if not digests:
            out["ids"] = pa.concat_arrays(made["ids"]) if made["ids"] else pa.array([], pa.list_(pa.int32()))
        return out

    return with_columns(df, added, run)


def decode_pieces(df: DataFrame, model: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """`df` with the text that its ids stand for; null ids give null."""
    shared = df.sparkSession.sparkContext.broadcast(read_vocabulary(model).pieces)

    def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        rows = batch.column(batch.schema.get_field_index(ids)).to_pylist()
        return {into: pa.array([None if r is None else decode(shared.value, r).decode() for r in rows], pa.string())}

    return with_columns(df, StructType([StructField(into, StringType())]), run)
