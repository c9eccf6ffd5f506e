"""SimHash near-duplicates: fingerprints within a few bits, by a hierarchical index in Gray order.

A document's fingerprint has a bit set where over half of its word shingles' hashes
have it. Equal fingerprints are one from then on. The index over them has three
kinds of nodes, each a bit mask and the pattern its members share under it:

* **Upper nodes.** The bits are cut into `BLOCKS` blocks; a mask joins all but `most`
  of them, so two fingerprints that differ in at most `most` bits agree on at least
  one mask. Every fingerprint goes below the node of its pattern for each mask:
  Spark's exchange by (mask, pattern) is the top of the tree. Rows are dealt by
  ranges of (mask, pattern, Gray rank), so a node with many members is spread.
* **Blocks and leaves.** Below an upper node fingerprints stand in the order of their
  rank in the Gray code, neighbours differing in few bits. They are cut into blocks
  of `BLOCK`, and these by `FAN` down to leaves; each node takes the bits all its
  members share as its mask.
* **Search.** Two nodes are compared by the differences under both masks, which only
  add up on the way down. Groups that differ too much are left out as a whole, and so
  are groups that already belong to one component.

A task searches within each block. Upper nodes of several blocks hand on one row per
block; pairs of blocks that masks and components leave open are searched in a second
exchange, two blocks to a task. Only links that join components are written, so a
group of copies costs rows in proportion to its size.

Defined results: null, empty and blank texts have the fingerprint zero and link like
any other; texts of 1 to `shingle - 1` words are one shingle. Rows without a doc_id
link others but do not name a component; where no member has an id the component is
null. Rows that repeat are members of one component. Columns other than id and text
are ignored. No rows in, no rows out.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.batches import slices, small_batches, texts_of
from siltstone.llm.components import connected_components
from siltstone.session import shared_dir

SHINGLE = 4
SEED = 42
MOST = 4  # differing bits of a link
BLOCKS = 6  # of the 64 bits; MOST of them may differ
BLOCK = 8_192  # fingerprints searched at once
LEAF, FAN = 16, 8
HELD = 1 << 20  # comparisons made at once
SLICE_BYTES = 1 << 20


def fingerprints_of(texts: list[bytes], shingle: int = SHINGLE) -> np.ndarray:
    """The fingerprint of each text."""
    hashes: list[int] = []
    sizes = []
    for text in texts:
        words = text.lower().split()  # of bytes: only A-Z, only ASCII white space
        joined = b" ".join(words)
        if len(words) <= shingle:
            found = [xxhash.xxh64_intdigest(joined, SEED)] if words else []
        else:
            ends = list(itertools.accumulate(len(w) + 1 for w in words))
            starts = [0, *ends[:-shingle]]
            found = [xxhash.xxh64_intdigest(joined[a : b - 1], SEED) for a, b in zip(starts, ends[shingle - 1 :], strict=True)]
        hashes += found
        sizes.append(len(found))
    out, size = np.zeros(len(texts), np.uint64), np.array(sizes, np.int64)
    full = np.flatnonzero(size)
    if len(full):
        bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        starts = (np.cumsum(size) - size)[full]
        counts = np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
        out[full] = np.packbits(2 * counts > size[full, None], axis=1).view(">u8").ravel().astype(np.uint64)
    return out


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of each number in the Gray code: each bit is the parity of those from it up."""
    for shift in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(shift))
    return x


def masks(most: int = MOST, blocks: int = BLOCKS) -> list[int]:
    """All unions of `blocks - most` blocks of the 64 bits."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [(1 << b) - (1 << a) for a, b in itertools.pairwise(edges)]
    return [sum(chosen) for chosen in itertools.combinations(parts, blocks - most)]


def _settled(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Labels after u[i] and v[i] are joined: the least place of each component."""
    while True:
        a, b = label[u], label[v]
        if np.array_equal(a, b):
            return label
        parent = np.arange(len(label))
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(parent, parent[parent]):
            parent = parent[parent]
        label = parent[label]


class Tree:
    """Nodes over fingerprints in Gray order: masks and shared patterns by level, leaves first."""

    def __init__(self, prints: np.ndarray) -> None:
        self.prints = prints
        self.starts = [np.arange(0, len(prints), LEAF)]
        every, some = (f.reduceat(prints, self.starts[0]) for f in (np.bitwise_and, np.bitwise_or))
        self.nodes = [(~(every ^ some), every)]
        while len(self.starts[-1]) > 1:
            cut = np.arange(0, len(self.starts[-1]), FAN)
            every, some = np.bitwise_and.reduceat(every, cut), np.bitwise_or.reduceat(some, cut)
            self.starts.append(self.starts[-1][cut])
            self.nodes.append((~(every ^ some), every))

    def _open(self, level: int, a: np.ndarray, b: np.ndarray, label: np.ndarray, most: int) -> np.ndarray:
        """Which pairs of nodes may hold a link between components."""
        mask, pattern = self.nodes[level]
        near = np.bitwise_count((pattern[a] ^ pattern[b]) & mask[a] & mask[b]) <= most
        least, largest = (f.reduceat(label, self.starts[level]) for f in (np.minimum, np.maximum))
        return near & ~((least[a] == largest[a]) & (least[b] == largest[b]) & (least[a] == least[b]))

    def joined(self, label: np.ndarray, most: int) -> np.ndarray:
        """`label` after all links among the fingerprints."""
        n = len(self.prints)
        for k in (1, 2, 3):  # neighbours in Gray order are near, and join what then need not be compared
            at = np.flatnonzero(np.bitwise_count(self.prints[:-k] ^ self.prints[k:]) <= most)
            label = _settled(label, at, at + k)
        todo = [(len(self.nodes) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while todo:
            level, a, b = todo.pop()
            keep = self._open(level, a, b, label, most)
            a, b = a[keep], b[keep]
            width = LEAF if level == 0 else FAN
            step = max(1, HELD // width**2)
            if len(a) > step:
                todo += [(level, a[i : i + step], b[i : i + step]) for i in range(0, len(a), step)]
                continue
            size = n if level == 0 else len(self.starts[level - 1])
            x = (a[:, None, None] * width + np.arange(width)[:, None] + np.zeros(width, np.int64)).ravel()
            y = (b[:, None, None] * width + np.arange(width) + np.zeros((width, 1), np.int64)).ravel()
            once = (y < size) & (x < y if level == 0 else x <= y)
            x, y = x[once], y[once]
            if level:
                if len(x):
                    todo.append((level - 1, x, y))
                continue
            linked = np.bitwise_count(self.prints[x] ^ self.prints[y]) <= most
            label = _settled(label, x[linked], y[linked])
        return label


def joined_within(prints: np.ndarray, most: int, label: np.ndarray | None = None) -> np.ndarray:
    """The component of each fingerprint, as a place in `prints`; label: components known before."""
    order = np.argsort(gray_rank(prints), kind="stable")
    first = np.arange(len(prints)) if label is None else np.unique(label[order], return_index=True)[1][np.unique(label[order], return_inverse=True)[1]]
    joined = Tree(prints[order]).joined(first, most)
    out = np.empty(len(prints), np.int64)
    out[order] = order[joined]
    return out


def _small_groups(prints: np.ndarray, group: np.ndarray, largest: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (places) within groups of at most `largest` members that stand together."""
    u, v = [], []
    for k in range(1, largest):
        at = np.flatnonzero(group[:-k] == group[k:])
        if not len(at):
            break
        at = at[np.bitwise_count(prints[at] ^ prints[at + k]) <= most]
        u.append(at)
        v.append(at + k)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *u]), np.concatenate([none, *v])


def _links(prints: np.ndarray, u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    n = len(u)
    columns = [np.zeros(n, np.int32), prints[u].view(np.int64), prints[v].view(np.int64), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["kind", "a", "b", "mask", "pattern"])


def _members(prints: np.ndarray, mask: int, pattern: int) -> pa.RecordBatch:
    """One row for each fingerprint of a block, which is named by its first."""
    n = len(prints)
    columns = [np.ones(n, np.int32), prints.view(np.int64), np.full(n, prints[0]).view(np.int64), np.full(n, mask, np.int32), np.full(n, pattern, np.int64)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["kind", "a", "b", "mask", "pattern"])


def search_blocks(placed: DataFrame, most: int, block: int) -> DataFrame:
    """kind 0: links (a, b); kind 1: fingerprint a of block b, of nodes that may have more than one block.

    placed: (mask, pattern, print), in ranges and sorted.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)]
        first, parted = True, False  # parted: a block of the node in `rest` is gone

        def settled(mask: int, pattern: int, prints: np.ndarray, shown: bool) -> Iterator[pa.RecordBatch]:
            joined = joined_within(prints, most)
            at = np.flatnonzero(joined != np.arange(len(prints)))
            yield _links(prints, at, joined[at])
            if shown:
                yield _members(prints, mask, pattern)

        def nodes(columns: list[np.ndarray], ends: bool) -> Iterator[pa.RecordBatch]:
            """Whole nodes; the first and, if it ends the partition, the last may go on elsewhere."""
            nonlocal first, parted
            mask, pattern, prints = columns[0], columns[1], columns[2].view(np.uint64)
            if not len(mask):
                return
            start = np.flatnonzero(np.r_[True, (mask[1:] != mask[:-1]) | (pattern[1:] != pattern[:-1])])
            size = np.diff(np.r_[start, len(mask)])
            alone = np.flatnonzero(size > LEAF).tolist()
            shown = {0} if first or parted else set()
            if ends:
                shown.add(len(size) - 1)
            for k in sorted(shown.union(alone)):
                rows = prints[start[k] : start[k] + size[k]]
                for i in range(0, len(rows), block):
                    yield from settled(int(mask[start[k]]), int(pattern[start[k]]), rows[i : i + block], k in shown or len(rows) > block)
            group = np.repeat(np.arange(len(size)), size)
            few = np.repeat((size > 1) & (size <= LEAF), size)
            group, near = group[few], prints[few]
            yield _links(near, *_small_groups(near, group, LEAF, most))
            first = parted = False

        for batch in batches:
            columns = [np.concatenate([r, batch.column(i).to_numpy()]) for i, r in enumerate(rest)]
            mask, pattern = columns[0], columns[1]
            changes = np.flatnonzero((mask[1:] != mask[:-1]) | (pattern[1:] != pattern[:-1]))
            last = int(changes[-1]) + 1 if len(changes) else 0
            if last:
                yield from nodes([c[:last] for c in columns], False)
            rest = [c[last:] for c in columns]
            while len(rest[0]) >= 2 * block:  # a node with many members: whole blocks go on
                yield from settled(int(rest[0][0]), int(rest[1][0]), rest[2][:block].view(np.uint64), True)
                rest, parted = [c[block:] for c in rest], True
        yield from nodes(rest, True)

    return placed.mapInArrow(scan, "kind int, a bigint, b bigint, mask int, pattern bigint")


def search_pairs(members: DataFrame, most: int) -> DataFrame:
    """Links (a, b) between components within each pair of blocks. members: pair, print, root."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.zeros(0, np.int64)] * 3

        def pairs(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            if not len(columns[0]):
                return
            cuts = np.flatnonzero(np.diff(columns[0])) + 1
            a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for prints, root in zip(*[np.split(c, cuts) for c in columns[1:]], strict=True):
                joined = joined_within(prints.view(np.uint64), most, root)
                at = np.flatnonzero(root != root[joined])
                a.append(prints[at])
                b.append(prints[joined[at]])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (a, b)], names=["a", "b"])

        for batch in batches:
            columns = [np.concatenate([r, batch.column(i).to_numpy()]) for i, r in enumerate(rest)]
            last = int(np.searchsorted(columns[0], columns[0][-1])) if len(columns[0]) else 0
            yield from pairs([c[:last] for c in columns])
            rest = [c[last:] for c in columns]
        yield from pairs(rest)

    return members.select("pair", "print", "root").repartition("pair").sortWithinPartitions("pair").mapInArrow(scan, "a bigint, b bigint")


def _rank(x: Column) -> Column:
    for shift in (1, 2, 4, 8, 16, 32):
        x = x.bitwiseXOR(F.shiftrightunsigned(x, shift))
    return x


def component_roots(prints: DataFrame, most: int = MOST, block: int = BLOCK) -> DataFrame:
    """(node, root) for every fingerprint that is linked with another. prints: distinct `print` (bigint), written."""
    spark = prints.sparkSession
    if not 0 < most < BLOCKS:
        raise ValueError(f"most must lie between 1 and {BLOCKS - 1}")

    def kept(df: DataFrame, label: str) -> DataFrame:
        folder = shared_dir(spark, label)
        df.write.parquet(folder)
        return spark.read.parquet(folder)

    signed = [m - (1 << 64) if m >> 63 else m for m in masks(most)]
    nodes = F.array(*[F.struct(F.lit(k).alias("mask"), F.col("print").bitwiseAND(F.lit(m).cast("long")).alias("pattern")) for k, m in enumerate(signed)])
    upper = prints.select("print", F.explode(nodes).alias("node")).select("node.*", "print").withColumn("rank", _rank(F.col("print")))
    placed = upper.repartitionByRange("mask", "pattern", "rank").sortWithinPartitions("mask", "pattern", "rank")
    found = kept(search_blocks(placed.select("mask", "pattern", "print"), most, block), "gray-blocks")
    links = found.filter("kind = 0").select("a", "b").distinct()

    members = found.filter("kind = 1").select("mask", "pattern", F.col("a").alias("print"), F.col("b").alias("block"))
    several = members.filter("print = block").groupBy("mask", "pattern").agg(F.count("*").alias("n")).filter("n > 1").select("mask", "pattern")
    members = kept(members.join(several, ["mask", "pattern"], "left_semi"), "gray-members")
    if members.isEmpty():
        return connected_components(links, "a", "b")
    links = kept(links, "links")
    roots = connected_components(links, "a", "b").withColumnRenamed("node", "print")
    members = kept(members.join(roots, "print", "left").withColumn("root", F.coalesce("root", "print")), "gray-rooted")
    shared = F.bitwise_not(F.bit_and("print").bitwiseXOR(F.bit_or("print")))
    blocks = members.groupBy("mask", "pattern", "block").agg(shared.alias("bits"), F.bit_and("print").alias("common"), F.min("root").alias("low"), F.max("root").alias("high"))
    blocks = kept(blocks, "gray-nodes")
    x, y = blocks.alias("x"), blocks.alias("y")
    differ = F.bit_count(F.col("x.common").bitwiseXOR(F.col("y.common")).bitwiseAND(F.col("x.bits")).bitwiseAND(F.col("y.bits")))
    one = (F.col("x.low") == F.col("x.high")) & (F.col("y.low") == F.col("y.high")) & (F.col("x.low") == F.col("y.low"))
    same = (F.col("x.mask") == F.col("y.mask")) & (F.col("x.pattern") == F.col("y.pattern"))
    pairs = x.join(y, same & (F.col("x.block") < F.col("y.block"))).filter((differ <= most) & ~one)
    sides = pairs.select("x.mask", "x.pattern", F.xxhash64("x.mask", "x.pattern", "x.block", "y.block").alias("pair"), F.explode(F.array("x.block", "y.block")).alias("block"))
    more = search_pairs(members.join(sides, ["mask", "pattern", "block"]), most)
    return connected_components(kept(links.unionByName(more).distinct(), "links"), "a", "b")


def simhash_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", most: int = MOST, shingle: int = SHINGLE, block: int = BLOCK) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of `docs`; the fingerprint as 16 hexadecimal digits."""
    spark = docs.sparkSession
    small_batches(spark)
    kind = docs.schema[doc_id].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                found = fingerprints_of(texts_of(part, "text"), shingle).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found)], names=["doc_id", "print"])

    picked = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    folder = shared_dir(spark, "fingerprints")
    picked.mapInArrow(scan, f"doc_id {kind}, print bigint").write.parquet(folder)
    rows = spark.read.parquet(folder)
    folder = shared_dir(spark, "fingerprints-distinct")
    rows.groupBy("print").agg(F.min("doc_id").alias("least")).write.parquet(folder)
    prints = spark.read.parquet(folder)
    roots = component_roots(prints.select("print"), most, block).withColumnRenamed("node", "print")
    rooted = prints.join(roots, "print", "left").withColumn("root", F.coalesce("root", "print"))
    folder = shared_dir(spark, "fingerprints-rooted")
    rooted.write.parquet(folder)
    rooted = spark.read.parquet(folder)
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("print", "component_id")
    return rows.join(named, "print").select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")
