"""Periodic runs of words: maximal stretches that repeat a block of words, found by block convolution.

A run is a maximal stretch of words in which words `q` apart are identical, `q`
being its smallest period, of `max(least, 2 q)` words or more. At each scale
`B = 2, 4, 8, ...` the text is cut into blocks of B words. The first `q` words
of a run hold a whole block of the scale with `2 B - 1 <= q <= 4 B - 2`, and
that block comes again `q` words later, so it is enough to know at which
distances of its scale each block recurs:

* **Convolution.** With words as numbers, the sum of squared differences of a
  block and the stretch at distance d is `sum p^2 + sum t^2 - 2 (p * t)`. The
  correlations of a block with all distances of its scale are one product of
  number-theoretic transforms of length 4 B modulo 15 * 2^27 + 1: whole numbers, no
  rounding, so no distance is missed.
* **Seeds.** A distance whose sum is zero is a seed, extended to both sides as far as
  words that distance apart agree, by bisection over weighted sums. Stretches long
  enough to be a run are compared word by word, which corrects the rare ones where
  a sum misled; those found at several multiples of their period keep the smallest.

A block with a word that does not come again within the distances of its scale
cannot recur and is not transformed; nor is one that lies, distances included, in a
run found before with a period of at most B: inside it recurs at multiples of the
period only, and these give the same run, as does any seed at such a distance. So text without repetition costs a sort of
its words, and a text of n words O(n log^2 n) at most.

Defined results: null, empty and blank texts have no words and no runs. Texts may be
as long as a row may be; one text is held by one task. Rows that repeat, with the
same or no id, are judged each on its own. Columns other than id and text are
ignored. No rows in, no rows out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from siltstone.llm.batches import slices, small_batches, texts_of

LEAST = 12  # words of a run
SLICE_BYTES = 1 << 20  # of texts judged at once; a longer text stands alone
HELD = 1 << 18  # numbers of a matrix transformed or compared at once

# The prime 15 * 2^27 + 1 has transforms of every power of two up to 2^27; 31 generates its units.
PRIME = 15 * 2**27 + 1
GENERATOR = 31
MODULUS = np.uint64(PRIME)

BASE = 0x2F0B4C37  # of the weights by which stretches are compared
FAR = np.int64(1) << np.int64(62)


def _powers(root: int, n: int) -> np.ndarray:
    """1, root, root^2, ... of n terms modulo PRIME, n a power of two."""
    out = np.ones(n, np.uint64)
    step, factor = 1, root
    while step < n:
        out[step : 2 * step] = out[:step] * np.uint64(factor) % MODULUS
        step, factor = 2 * step, factor * factor % PRIME
    return out


def transform(a: np.ndarray) -> np.ndarray:
    """Number-theoretic transform along the first axis; the result is in bit-reversed order."""
    n, columns = a.shape
    roots = _powers(pow(GENERATOR, (PRIME - 1) // n, PRIME), max(1, n // 2))
    h = n // 2
    while h:
        pairs = a.reshape(n // (2 * h), 2, h, columns)
        u, v = pairs[:, 0], pairs[:, 1]
        a = np.empty_like(pairs)
        a[:, 0] = (u + v) % MODULUS
        a[:, 1] = (u + (MODULUS - v)) * roots[:: n // (2 * h)][:h, None] % MODULUS
        h //= 2
    return a.reshape(n, columns)


def inverse(a: np.ndarray) -> np.ndarray:
    """What `transform` has transformed, from its bit-reversed order."""
    n, columns = a.shape
    roots = _powers(pow(GENERATOR, PRIME - 1 - (PRIME - 1) // n, PRIME), max(1, n // 2))
    h = 1
    while h < n:
        pairs = a.reshape(n // (2 * h), 2, h, columns)
        u, v = pairs[:, 0], pairs[:, 1] * roots[:: n // (2 * h)][:h, None] % MODULUS
        a = np.empty_like(pairs)
        a[:, 0] = (u + v) % MODULUS
        a[:, 1] = (u + (MODULUS - v)) % MODULUS
        h *= 2
    return a.reshape(n, columns) * np.uint64(pow(n, -1, PRIME)) % MODULUS


def squared_differences(blocks: np.ndarray, stretches: np.ndarray) -> np.ndarray:
    """For each column the sum of squared differences, modulo PRIME, of the block and the stretch from each place on.

    blocks: B rows; stretches: up to 4 B rows. Row d of the result is for the place d; all that fit.
    """
    size, length = len(blocks), len(stretches)
    n = 4 * size
    turned = np.zeros((n, blocks.shape[1]), np.uint64)
    turned[-np.arange(size) % n] = blocks
    padded = np.zeros_like(turned)
    padded[:length] = stretches
    both = inverse(transform(turned) * transform(padded) % MODULUS)[: length - size + 1]
    squares = np.zeros((length + 1, blocks.shape[1]), np.uint64)
    np.cumsum(stretches * stretches % MODULUS, axis=0, out=squares[1:])
    theirs = squares[size:] - squares[: length - size + 1]
    mine = (blocks * blocks % MODULUS).sum(axis=0)
    return (mine + theirs + 2 * (MODULUS - both)) % MODULUS


def _next(words: np.ndarray) -> np.ndarray:
    """How far the next equal word is, FAR where there is none."""
    order = np.argsort(words, kind="stable")
    out = np.full(len(words), FAR)
    again = np.flatnonzero(words[order[1:]] == words[order[:-1]])
    out[order[again]] = order[again + 1] - order[again]
    return out


def _seeds(words: np.ndarray, blocks: np.ndarray, size: int, low: int, high: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, distance) where the block of `size` words that begins at one of `blocks` recurs low to high words later.

    All such places, and those few where the sum of squares is another multiple of PRIME.
    """
    last = len(words) - 1
    at_once = max(1, HELD // (4 * size))
    for k in range(0, len(blocks), at_once):
        c = blocks[k : k + at_once]
        mine = words[c + np.arange(size)[:, None]]
        theirs = words[np.minimum(c + low + np.arange(high - low + size)[:, None], last)]
        d, column = np.nonzero(squared_differences(mine.astype(np.uint64), theirs.astype(np.uint64)) == 0)
        yield c[column], d + low


class Extensions:
    """How far two places of a text agree: by sums of the words weighted with powers, so at least as far as they do."""

    def __init__(self, words: np.ndarray) -> None:
        self.n = len(words)
        self.power = _powers(BASE, 1 << self.n.bit_length())
        weighted = words.astype(np.uint64) * self.power[: self.n] % MODULUS
        self.upto = np.r_[np.uint64(0), np.cumsum(weighted)] % MODULUS

    def _equal(self, a: np.ndarray, b: np.ndarray, distance: np.ndarray) -> np.ndarray:
        here = (self.upto[b] + MODULUS - self.upto[a]) * self.power[distance] % MODULUS
        return (self.upto[b + distance] + MODULUS - self.upto[a + distance]) % MODULUS == here

    def forwards(self, place: np.ndarray, distance: np.ndarray) -> np.ndarray:
        """How many words from each place on equal those `distance` later."""
        low, high = np.zeros(len(place), np.int64), self.n - place - distance
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = self._equal(place, place + middle, distance)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def backwards(self, place: np.ndarray, distance: np.ndarray) -> np.ndarray:
        """How many words before each place equal those `distance` later."""
        low, high = np.zeros(len(place), np.int64), place.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = self._equal(place - middle, place, distance)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low


def _exact(words: np.ndarray, place: int, distance: int) -> tuple[int, int]:
    """The longest stretch with the period `distance` around a place, word by word."""
    differs = np.flatnonzero(words[:-distance] != words[distance:])
    at = int(np.searchsorted(differs, place))
    start = int(differs[at - 1]) + 1 if at else 0
    end = int(differs[at]) if at < len(differs) else len(words) - distance
    return start, end + distance


def runs_of(words: np.ndarray, least: int = LEAST) -> np.ndarray:
    """(start, length, period) of every run, by start and period.

    words: numbers below PRIME; the first and the last must occur once, and so must one between texts that are joined.
    """
    found: dict[tuple[int, int], int] = {}
    by_period: dict[int, list[tuple[int, int]]] = {}
    extensions = Extensions(words)
    reach = _next(words)
    size = 2
    reach = reach[: len(reach) // size * size].reshape(-1, size).max(axis=1)
    while len(reach):
        low, high = (1 if size == 2 else 2 * size - 1), 4 * size - 2
        blocks = np.flatnonzero(reach <= high) * size
        known = np.array([(a, b) for (a, b), q in found.items() if q <= size], np.int64).reshape(-1, 2)
        if len(known) and len(blocks):
            known = known[np.argsort(known[:, 0], kind="stable")]
            end = np.maximum.accumulate(known[:, 1])
            before = np.searchsorted(known[:, 0], blocks, side="right") - 1
            inside = (before >= 0) & (end[before] >= blocks + high + size)
            blocks = blocks[~inside]
        if len(blocks):
            seeds = [np.concatenate(x) for x in zip(*_seeds(words, blocks, size, low, high), strict=True)]
            if seeds:
                place, distance = seeds
                new = np.ones(len(place), bool)
                for q, runs in by_period.items():  # a multiple of its period inside a run gives that run again
                    starts, ends = np.array(sorted(runs)).T
                    before = np.searchsorted(starts, place, side="right") - 1
                    new &= (before < 0) | (distance % q != 0) | (ends[before] < place + distance + size)
                place, distance = place[new], distance[new]
                start = place - extensions.backwards(place, distance)
                end = place + extensions.forwards(place, distance) + distance
                long = end - start >= np.maximum(least, 2 * distance)
                stretches, at = np.unique(np.stack([start, end, distance], axis=1)[long], axis=0, return_index=True)
                at = np.flatnonzero(long)[at]
                for (a, b, q), i in sorted(zip(stretches.tolist(), at.tolist(), strict=True), key=lambda x: x[0][2]):
                    if q % found.get((a, b), q + 1) == 0:  # found by its period
                        continue
                    if not np.array_equal(words[a : b - q], words[a + q : b]):
                        a, b = _exact(words, int(place[i]), q)
                        if b - a < max(least, 2 * q) or (a, b) in found:
                            continue
                    found[a, b] = q
                    by_period.setdefault(q, []).append((a, b))
        reach = reach[: len(reach) // 2 * 2].reshape(-1, 2).max(axis=1)
        size *= 2
    return np.array(sorted((a, q, b - a) for (a, b), q in found.items()), np.int64).reshape(-1, 3)[:, [0, 2, 1]]


def find_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for each row.

    runs: by start, then period; collapsed: the words joined by one blank, without
    those that a run holds after its first period.
    """
    if least < 8:
        raise ValueError("least must be 8 or more: shorter runs need not hold a whole block")
    small_batches(docs.sparkSession)
    kind = docs.schema[doc_id].dataType.simpleString()
    run_type = pa.list_(pa.struct({"start": pa.int64(), "length": pa.int64(), "period": pa.int64()}))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                texts = [t.split() for t in texts_of(part, "text")]  # bytes are split at ASCII white space
                numbers: dict[bytes, int] = {}
                joined = [0]
                for k, words in enumerate(texts):
                    joined += [numbers.setdefault(w, len(numbers) + len(texts) + 1) for w in words]
                    joined.append(k + 1)  # a word of its own between texts
                runs = runs_of(np.array(joined, np.int64), least)
                begin = np.cumsum([1, *[len(words) + 1 for words in texts]])
                bounds = np.searchsorted(runs[:, 0], begin)
                out = []
                for k, words in enumerate(texts):
                    mine = runs[bounds[k] : bounds[k + 1]] - [begin[k], 0, 0]
                    kept = words
                    if len(mine):
                        dropped = np.zeros(len(words) + 1, np.int64)
                        np.add.at(dropped, mine[:, 0] + mine[:, 2], 1)
                        np.add.at(dropped, mine[:, 0] + mine[:, 1], -1)
                        kept = [words[i] for i in np.flatnonzero(np.cumsum(dropped[:-1]) == 0)]
                    listed = [dict(zip(("start", "length", "period"), r, strict=True)) for r in mine.tolist()]
                    out.append((len(words), listed, b" ".join(kept)))
                n_words, listed, collapsed = zip(*out, strict=True)
                columns = [part.column(0), pa.array(n_words, pa.int64()), pa.array(listed, run_type), pa.array(collapsed, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])

    picked = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    return picked.mapInArrow(scan, f"doc_id {kind}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")
