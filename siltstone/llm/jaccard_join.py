"""Exact Jaccard self-join of documents on word shingles, by set relations.

Documents become sets of 64-bit shingle hashes; equal sets are one set from then
on. A set's shingles are put in one global order, rare ones first, and its first
`n - ceil(0.8 n) + 1` go into an inverted index: two sets that are similar share
one of those. Each list of the index is sorted by position and size, and two
relations between sets keep the work small:

* **Index skipping.** The head of a list, the set with the fewest rarer
  shingles, is compared with the others, and whole blocks of the list are
  skipped whose size and position rule out enough overlap.
* **Derived answers.** Sets that turn out to be one component need no answers
  of each other. For the pairs of a list that are left, what can overlap is
  bounded from their overlaps with the head and from a map of parities of each
  set; only pairs within both bounds are compared. So groups of copies cost in proportion to their size, no link
  between different texts is lost, and answers are exact (up to hash collisions,
  about 2^-64 for a pair of shingles).

The order only affects speed. Frequent shingles are found by counters of fixed
size (Misra-Gries) in each task; the `HOT` most frequent are broadcast.

Sets are not stored: pairs are compared where the texts meet, grouped by head,
large groups dealt over several tasks. Components come from `components`.

Defined results: null and empty texts have no shingles, link with nothing and
are their own component; texts of 1 to 4 words are one shingle. Rows without a
doc_id keep their count, link with nothing and have no component. Rows that
repeat a doc_id and text are equal in every way; two texts under one doc_id are
told apart by their sets. Other columns are ignored. No documents: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.batches import slices, small_batches, texts_of
from siltstone.llm.components import connected_components
from siltstone.llm.shingles import shingle_sets
from siltstone.session import shared_dir

SLICE_BYTES = 1 << 20
COUNTERS = 1 << 20  # shingle counters in a task
GATHERED = 1 << 21  # shingles counted at once
HOT = 200_000  # shingles put last in the order: 3 MB are broadcast
GROUP = 2_000  # sets compared with one head in a task
LONG_LIST = 1 << 16  # entries of one list held at once
LEAST_BITS = 1024  # of a set's parity map
BLOCK_SETS = 1 << 12  # of a list compared with each other in a task
BROADCAST_ROWS = 1 << 20  # of 32 bytes


def _least_overlap(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Shared shingles that two sets of these sizes need: 100 * both >= 80 * either."""
    return -(-4 * (n + m) // 9)


def _sid(shingles: np.ndarray) -> int:
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes()))))


def _parities(shingles: np.ndarray) -> bytes:
    """For each class of hashes, whether the set has an odd number; two sets differ in at least as many shingles as bits.

    A power of two of classes, one or more for a shingle; a map is folded to a shorter one by XOR of its parts.
    """
    bits = max(LEAST_BITS, 1 << (len(shingles) - 1).bit_length())
    return np.packbits(np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1).tobytes()


def _folded(maps: np.ndarray, size: int) -> np.ndarray:
    return np.stack([np.bitwise_xor.reduce(np.frombuffer(m, np.uint64).reshape(-1, size // 8), axis=0) for m in maps])


def _rows(columns: dict[str, list | np.ndarray], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[n], t) for n, t in types.items()], names=list(types))


class Counters:
    """Misra-Gries counts: every shingle in more than 1 / COUNTERS of the sets is among them."""

    def __init__(self) -> None:
        self.names, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting: list[np.ndarray] = []

    def add(self, shingles: list[np.ndarray]) -> None:
        self.waiting += shingles
        if sum(map(len, self.waiting)) > GATHERED:
            self.settle()

    def settle(self) -> None:
        names, counts = np.unique(np.concatenate([self.names[:0], *self.waiting]), return_counts=True)
        self.waiting = []
        names, inverse = np.unique(np.r_[self.names, names], return_inverse=True)
        total = np.bincount(inverse, np.r_[self.counts, counts]).astype(np.int64)
        if len(names) > COUNTERS:
            total -= np.partition(total, -COUNTERS - 1)[-COUNTERS - 1]
        self.names, self.counts = names[total > 0], total[total > 0]


def document_sets(docs: DataFrame, text: str) -> DataFrame:
    """kind 0: (doc_id, n, sid, parities) for each row; kind 1: (shingle, count, null, null)."""
    types = {"kind": pa.int32(), "a": pa.int64(), "b": pa.int64(), "c": pa.int64(), "d": pa.binary()}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = Counters()
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                sets = shingle_sets(texts_of(part, "text"))
                sids = [_sid(s) if len(s) else None for s in sets]
                fresh = list({i: s for i, s in zip(sids, sets, strict=True) if i is not None}.values())
                counters.add(fresh)
                ids = part.column(0).to_pylist()
                yield _rows({"kind": [0] * len(sets), "a": ids, "b": [len(s) for s in sets], "c": [s if d is not None else None for s, d in zip(sids, ids, strict=True)], "d": [_parities(s) if len(s) else None for s in sets]}, types)
        counters.settle()
        often = np.flatnonzero(counters.counts >= 3)
        yield _rows({"kind": np.ones(len(often), np.int32), "a": counters.names[often].view(np.int64), "b": counters.counts[often], "c": pa.nulls(len(often)), "d": pa.nulls(len(often))}, types)

    picked = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs[text].alias("text"))
    return picked.mapInArrow(scan, "kind int, a bigint, b bigint, c bigint, d binary")


def postings(docs: DataFrame, text: str, hot: dict[int, int]) -> DataFrame:
    """(token, sid, n_pos): the index entries of each set, `hot` shingles last in the order; size and place are one number."""
    names = np.array(sorted(hot), np.int64).view(np.uint64)
    order = np.argsort(names)
    shared = docs.sparkSession.sparkContext.broadcast((names[order], np.array([hot[k] for k in sorted(hot)], np.int64)[order]))
    types = {"token": pa.int64(), "sid": pa.int64(), "n_pos": pa.int64()}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, often = shared.value
        seen: set[int] = set()
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                tokens, sids, places = [], [], []
                for s in shingle_sets(texts_of(part, "text")):
                    sid = _sid(s)
                    if not len(s) or sid in seen:
                        continue
                    if len(seen) < 1 << 16:  # copies within a task are left out early, all others later
                        seen.add(sid)
                    if len(known):
                        at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                        frequent = known[at] == s
                        if frequent.any():
                            late = s[frequent]
                            s = np.r_[s[~frequent], late[np.argsort(often[at[frequent]], kind="stable")]]
                    first = s[: len(s) - -(-4 * len(s) // 5) + 1]
                    tokens.append(first)
                    sids.append(np.full(len(first), sid, np.int64))
                    places.append(np.arange(len(first)) << 32 | len(s))
                if tokens:
                    yield _rows({"token": np.concatenate(tokens).view(np.int64), "sid": np.concatenate(sids), "n_pos": np.concatenate(places)}, types)

    # A row without an id has no part in links.
    picked = docs.filter(docs["doc_id"].isNotNull()).select(docs[text].alias("text"))
    return picked.mapInArrow(scan, "token bigint, sid bigint, n_pos bigint")


def heads_and_lists(entries: DataFrame) -> DataFrame:
    """kind 0: pairs (head, sid) to compare; kind 1: members (list, head, sid, n) of lists of three or more."""
    types = {"kind": pa.int32(), "list": pa.int64(), "head": pa.int64(), "n_head": pa.int32(), "sid": pa.int64(), "n": pa.int32()}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] = [np.zeros(0, np.int64)] * 4
        open_list: tuple | None = None  # token and head of a list of which a part is gone
        seen: set[int] = set()

        def lists(token: np.ndarray, sid: np.ndarray, n: np.ndarray, pos: np.ndarray, part: bool) -> Iterator[pa.RecordBatch]:
            """Whole lists one after the other, or (part) some of one long list."""
            nonlocal open_list
            start = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
            size = np.diff(np.r_[start, len(token)])
            if not part and open_list is None:
                many = size > 1  # most shingles occur in one set only
                keep = np.repeat(many, size)
                token, sid, n, pos = token[keep], sid[keep], n[keep], pos[keep]
                size = size[many]
                if not len(size):
                    return
                start = np.cumsum(size) - size
            first = np.repeat(start, size)
            head, n_head, pos_head = sid[first], n[first], pos[first]
            if open_list is not None:
                mine = token == open_list[0]
                head, n_head, pos_head = (np.where(mine, value, x) for value, x in zip(open_list[1:], (head, n_head, pos_head), strict=True))
            small, large = np.minimum(n, n_head), np.maximum(n, n_head)
            possible = (5 * small.astype(np.int64) >= 4 * large) & (np.minimum(n - pos, n_head - pos_head) >= _least_overlap(n.astype(np.int64), n_head)) & (sid != head)
            at = np.flatnonzero(possible)
            if len(at):
                _, once = np.unique(np.stack([head[at], sid[at]]), axis=1, return_index=True)
                at = at[once]
                yield _rows({"kind": np.zeros(len(at), np.int32), "list": np.zeros(len(at), np.int64), "head": head[at], "n_head": n_head[at], "sid": sid[at], "n": n[at]}, types)
            if part or open_list is not None:
                name, want = token, np.ones(len(token), bool)
            else:
                # Lists of the same sets are one list; copies of a passage make many such.
                with np.errstate(over="ignore"):
                    hashed = (sid.astype(np.uint64) ^ (sid.astype(np.uint64) >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
                    names = (np.add.reduceat(hashed ^ (hashed >> np.uint64(29)), start) + head[start].astype(np.uint64)).view(np.int64)
                new = np.array([s > 2 and x not in seen for s, x in zip(size.tolist(), names.tolist(), strict=True)])
                _, once = np.unique(names, return_index=True)
                single = np.zeros(len(names), bool)
                single[once] = True
                new &= single
                if len(seen) < 1 << 18:
                    seen.update(names[new].tolist())
                name, want = np.repeat(names, size), np.repeat(new, size)
            if want.any():
                yield _rows({"kind": np.ones(int(want.sum()), np.int32), "list": name[want], "head": head[want], "n_head": n_head[want], "sid": sid[want], "n": n[want]}, types)
            if part and open_list is None:
                open_list = (token[0], head[0], n_head[0], pos_head[0])

        def flush(columns: list[np.ndarray], part: bool) -> Iterator[pa.RecordBatch]:
            nonlocal open_list
            if not len(columns[0]):
                return
            if open_list is not None and columns[0][0] != open_list[0]:
                open_list = None  # it ended with the batch before; the next list has a head of its own
            if open_list is not None and not part:
                mine = columns[0] == open_list[0]
                if mine.any():
                    yield from lists(*[c[mine] for c in columns], False)
                open_list = None
                columns = [c[~mine] for c in columns]
                if not len(columns[0]):
                    return
            yield from lists(*columns, part)

        for batch in batches:
            token, sid, n_pos = (c.to_numpy() for c in batch.columns)
            columns = [np.concatenate(x) for x in zip(rest, (token, sid, n_pos & 0xFFFFFFFF, n_pos >> 32), strict=True)]
            token = columns[0]
            last = int(np.searchsorted(token, token[-1]))  # sorted: where the last list begins
            if last:
                yield from flush([c[:last] for c in columns], False)
            rest = [c[last:] for c in columns]
            if len(rest[0]) > LONG_LIST:
                yield from flush(rest, True)
                rest = [c[:0] for c in rest]
        yield from flush(rest, False)

    placed = entries.repartition("token").sortWithinPartitions("token", "n_pos", "sid")  # by place, then size
    return placed.mapInArrow(scan, "kind int, list bigint, head bigint, n_head int, sid bigint, n int")


def overlaps(docs: DataFrame, text: str, sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """(head, sid, n_head, n, both) of `pairs` (head, sid), from the texts themselves."""
    spark = docs.sparkSession
    place = sets.filter("sid IS NOT NULL").groupBy("sid").agg(F.min("doc_id").alias("doc_id"))
    groups = pairs.groupBy("head").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("parts"))
    members = pairs.join(groups, "head").select("head", F.pmod(F.xxhash64("sid"), F.col("parts")).cast("int").alias("part"), "sid", F.lit(1).alias("turn"))
    heads = groups.select("head", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("head").alias("sid"), F.lit(0).alias("turn"))
    folder = shared_dir(spark, "compared")
    members.unionByName(heads).join(place, "sid").write.parquet(folder)
    wanted = spark.read.parquet(folder)
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs[text].alias("text"))
    if wanted.count() <= BROADCAST_ROWS:  # then only the texts to compare are shuffled, and once
        wanted = F.broadcast(wanted)
    texts = texts.join(wanted, "doc_id")
    types = {"head": pa.int64(), "sid": pa.int64(), "n_head": pa.int32(), "n": pa.int32(), "both": pa.int32()}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, mine = None, np.zeros(0, np.uint64)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                out = []
                head, sid, turn = (part.column(part.schema.get_field_index(c)).to_pylist() for c in ("head", "sid", "turn"))
                for h, x, t, found in zip(head, sid, turn, shingle_sets(texts_of(part, "text")), strict=True):
                    if _sid(found) != x:  # another text under the same doc_id
                        continue
                    if t == 0:
                        current, mine = h, found
                    elif h == current:
                        at = np.minimum(np.searchsorted(mine, found), len(mine) - 1)
                        out.append((h, x, len(mine), len(found), int((mine[at] == found).sum())))
                if out:
                    yield _rows(dict(zip(types, zip(*out, strict=True), strict=True)), types)

    placed = texts.repartition("head", "part").sortWithinPartitions("head", "part", "turn")
    return placed.select("head", "part", "sid", "turn", "text").mapInArrow(scan, "head bigint, sid bigint, n_head int, n int, both int").distinct()


def pairs_left(members: DataFrame) -> DataFrame:
    """Pairs (head, sid) of different components in one list that their overlaps with its head do not rule out.

    members: list, sid, n, root, both (null where not known), parities. A list of more
    than BLOCK_SETS is cut into parts, and each pair of parts is a task's work of its own.
    """
    types = {"head": pa.int64(), "sid": pa.int64()}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] = [np.zeros(0, np.int64)] * 6 + [np.zeros(0, object)]

        def pairs(sid: np.ndarray, n: np.ndarray, root: np.ndarray, both: np.ndarray, part: np.ndarray, maps: np.ndarray) -> Iterator[pa.RecordBatch]:
            order = np.argsort(n, kind="stable")
            sid, n, root, both, part, maps = sid[order], n[order], root[order], both[order], part[order], maps[order]
            across = part.max() != part.min()  # two parts: only pairs between them
            length = np.array([len(m) for m in maps])  # grows with n
            bits, skipped = np.zeros((0, 1), np.uint64), 0
            most = np.where(both < 0, n, both)  # not known: all of it may be shared
            other = np.where(both < 0, n, n - both)
            found: list[tuple[np.ndarray, np.ndarray]] = []
            for i in range(len(sid) - 1):
                # Sorted by size: a block of sizes that can match follows.
                j = slice(i + 1, int(np.searchsorted(n, 5 * n[i] // 4, side="right")))
                bound = np.minimum(np.minimum(most[i], most[j]) + np.minimum(other[i], other[j]), np.minimum(n[i], n[j]))
                open_ = (root[j] != root[i]) & (bound >= _least_overlap(n[i], n[j]))
                ok = np.flatnonzero(open_ & (part[j] != part[i]) if across else open_) + i + 1
                if len(ok):
                    if bits.shape[1] * 8 != length[i]:
                        bits, skipped = _folded(maps[i:], length[i]), i
                    differ = np.bitwise_count(bits[ok - skipped] ^ bits[i - skipped]).sum(axis=1, dtype=np.int64)
                    ok = ok[9 * differ <= n[i] + n[ok]]
                if len(ok):
                    found.append((np.minimum(sid[i], sid[ok]), np.maximum(sid[i], sid[ok])))
                if sum(len(x) for x, _ in found[-64:]) > 1 << 16 or len(found) > 4096:
                    yield _rows({"head": np.concatenate([x for x, _ in found]), "sid": np.concatenate([y for _, y in found])}, types)
                    found = []
            if found:
                yield _rows({"head": np.concatenate([x for x, _ in found]), "sid": np.concatenate([y for _, y in found])}, types)

        def whole(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            if len(columns[0]):
                cuts = np.flatnonzero(np.diff(columns[0])) + 1
                for part in zip(*[np.split(c, cuts) for c in columns[1:]], strict=True):
                    yield from pairs(*part)

        for batch in batches:
            bits = np.array([*batch.column(6).to_pylist(), None], object)[:-1]
            new = [*[batch.column(i).to_numpy() for i in range(6)], bits]
            columns = [np.concatenate(x) for x in zip(rest, new, strict=True)]
            last = int(np.searchsorted(columns[0], columns[0][-1]))
            yield from whole([c[:last] for c in columns])
            rest = [c[last:] for c in columns]
        yield from whole(rest)

    parts = members.groupBy("list").agg(F.ceil(F.count("*") / BLOCK_SETS).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("sid"), F.col("parts")).cast("int")
    dealt = members.join(parts, "list").withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    block = F.when(F.col("parts") == 1, F.col("list")).otherwise(F.xxhash64("list", F.least("part", "other"), F.greatest("part", "other")))
    placed = dealt.select(
        block.alias("list"), "sid", F.col("n").cast("long"), "root", F.coalesce("both", F.lit(-1)).cast("long").alias("both"),
        F.col("part").cast("long"), "parities",
    )
    return placed.repartition("list").sortWithinPartitions("list", "sid").mapInArrow(scan, "head bigint, sid bigint").distinct()


def similar_components(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of `docs`."""
    spark = docs.sparkSession
    small_batches(spark)

    def kept(df: DataFrame, label: str) -> DataFrame:
        folder = shared_dir(spark, label)
        df.write.parquet(folder)
        return spark.read.parquet(folder)

    scanned = kept(document_sets(docs, text), "sets")
    sets = scanned.filter("kind = 0").select(F.col("a").alias("doc_id"), F.col("b").alias("n"), F.col("c").alias("sid"))
    frequent = scanned.filter("kind = 1").groupBy("a").agg(F.sum("b").alias("n")).orderBy(F.desc("n"), "a").limit(HOT)
    hot = {r["a"]: r["n"] for r in frequent.collect()}  # at most HOT; only the order depends on it
    index = kept(heads_and_lists(postings(docs, text, hot)), "index")
    first = index.filter("kind = 0").select("head", "sid").distinct()
    compared = kept(overlaps(docs, text, sets, first), "overlaps")
    similar = F.col("both") * 9 >= 4 * (F.col("n_head") + F.col("n"))
    links = compared.filter(similar).select("head", "sid")
    roots = connected_components(links, "head", "sid")
    # Lists whose sets are not of one component yet.
    members = index.filter("kind = 1").select("list", "head", "sid", "n").distinct()
    rooted = members.join(roots.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    rooted = kept(rooted, "lists")
    mixed = rooted.groupBy("list").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("list")
    known = compared.select("head", "sid", "both").unionByName(rooted.filter("head = sid").select("head", "sid", F.col("n").alias("both")).distinct())
    maps = scanned.filter("kind = 0 AND c IS NOT NULL").groupBy(F.col("c").alias("sid")).agg(F.any_value("d").alias("parities"))
    unsettled = rooted.join(mixed, "list", "left_semi").join(known, ["head", "sid"], "left").join(maps, "sid")
    left = kept(pairs_left(unsettled), "pairs-left")
    done = compared.select(F.least("head", "sid").alias("head"), F.greatest("head", "sid").alias("sid"))
    more = overlaps(docs, text, sets, left.join(done, ["head", "sid"], "left_anti"))
    links = links.unionByName(kept(more, "overlaps").filter(similar).select("head", "sid"))
    roots = connected_components(links, "head", "sid")
    named = sets.join(roots.withColumnRenamed("node", "sid"), "sid", "left").select("doc_id", "n", F.coalesce("root", "sid").alias("root"))
    named = kept(named, "named")
    least = named.filter("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return named.join(least, "root", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
