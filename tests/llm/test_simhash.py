"""SimHash links against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from siltstone.llm import simhash_links as sl

SCHEMA = "doc_id long, text string"


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] if len(words) > 3 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, most=4):
    """Least index of each component, by all pairs."""
    x = np.array(prints, np.uint64)
    label = np.arange(len(x))
    while True:
        near = np.bitwise_count(x[:, None] ^ x) <= most
        new = np.where(near, label, len(x)).min(axis=1)
        if np.array_equal(new, label):
            return label.tolist()
        label = new


def ball(rng, n, centres, flips):
    x = [rng.choice(centres) for _ in range(n)]
    return sorted({p ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, flips))) for p in x})


def same_groups(got, want):
    return len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))


def test_gray_rank_and_masks():
    ranks = sl.gray_rank(np.array([i ^ (i >> 1) for i in range(1000)], np.uint64))
    assert ranks.tolist() == list(range(1000))
    masks = sl.masks()
    rng = random.Random(1)
    for _ in range(2000):
        differ = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(not differ & m for m in masks)


def test_tree_against_all_pairs():
    rng = random.Random(2)
    for _ in range(60):
        prints = ball(rng, rng.randint(1, 500), [rng.getrandbits(64) for _ in range(rng.randint(1, 9))], rng.randint(0, 9))
        rng.shuffle(prints)
        x, want = np.array(prints, np.uint64), components(prints)
        assert same_groups(sl.joined_within(x, 4).tolist(), want)
        known = np.array(components(prints, 2)) * 7  # labels of an earlier search
        assert same_groups(sl.joined_within(x, 4, known).tolist(), want)


@pytest.mark.parametrize("block", [16, 100, 8192])
def test_roots_in_blocks(spark, block):
    """Small blocks: nodes are spread over blocks and partitions, and no link is lost."""
    rng = random.Random(3)
    prints = ball(rng, 700, [rng.getrandbits(64) for _ in range(3)], 7) + [rng.getrandbits(64) for _ in range(100)] + [0, 1, (1 << 64) - 1]
    prints = sorted(set(prints))
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    roots = {r.node: r.root for r in sl.component_roots(spark.createDataFrame(signed, "print long"), block=block).collect()}
    assert same_groups([roots.get(p, p) for (p,) in signed], components(prints))


def test_documents_against_all_pairs(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "One"), (5, "one"), (6, "a b c"), (None, "A  b C"), (7, "word " * 30_000), (8, "word\x0bword word word"), (9, "same id"), (9, "same id"), (9, "other text here now"), (None, "nobody's words stand here alone")]
    for _ in range(40):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 4, 5, 80, 300]))]
        for _ in range(rng.randint(1, 6)):
            w = list(base)
            if rng.random() < 0.7:
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            rows.append((100 + 7 * len(rows) % 997, " ".join(w)))
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("fingerprint", F.lit(1)).withColumn("print", F.lit(2)).repartition(5)
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in sl.simhash_components(docs).collect()), key=repr)
    prints = [fingerprint(t) for _, t in rows]
    label = components(prints)
    least = {}
    for (doc_id, _), c in zip(rows, label, strict=True):
        if doc_id is not None:
            least[c] = min(doc_id, least.get(c, doc_id))
    want = [(d, f"{p:016x}", least.get(c)) for (d, _), p, c in zip(rows, prints, label, strict=True)]
    assert got == sorted(want, key=repr)
    assert sl.simhash_components(docs.limit(0)).count() == 0
    with pytest.raises(ValueError, match="most"):
        sl.component_roots(docs.select(F.lit(1).cast("long").alias("print")), most=6)


def test_native_hash_is_the_same(spark):
    """The shingle hash is Spark's own xxhash64 with its seed."""
    assert spark.sql("SELECT xxhash64('a b c d') AS h").first().h & (1 << 64) - 1 == xxhash.xxh64_intdigest(b"a b c d", 42)
