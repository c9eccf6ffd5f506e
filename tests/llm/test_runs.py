"""Periodic runs of words against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.llm import periodic_runs as pr
from siltstone.llm.q_corpus import periodic_runs, with_planted_runs

SCHEMA = "doc_id long, text string"


def runs_by_force(words, least=12):
    """Every maximal stretch for every distance, kept under its smallest period."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def random_words(rng):
    n = rng.choice([0, 1, 5, 11, 12, 13, 30, 60, 100, 200])
    vocabulary = rng.choice([1, 2, 3, 5, 50])
    words = [f"w{rng.randrange(vocabulary)}" for _ in range(n)]
    for _ in range(rng.randint(0, 2)):
        if n > 3:
            a, old = rng.randrange(n), list(words)
            p = rng.randint(1, max(1, (n - a) // 2))
            for i in range(a, min(n, a + rng.randint(p, 4 * p))):
                words[i] = old[a + (i - a) % p]
    return words


def test_transform_is_exact():
    rng = np.random.default_rng(1)
    for size in (1, 2, 8, 64):
        blocks = rng.integers(0, pr.PRIME, (size, 3)).astype(np.uint64)
        stretches = rng.integers(0, pr.PRIME, (3 * size, 3)).astype(np.uint64)
        got = pr.squared_differences(blocks, stretches)
        for d in range(len(got)):
            for c in range(3):
                want = sum((int(p) - int(t)) ** 2 for p, t in zip(blocks[:, c], stretches[d : d + size, c], strict=True))
                assert int(got[d, c]) == want % pr.PRIME
        assert np.array_equal(pr.inverse(pr.transform(stretches[: 2 * size])), stretches[: 2 * size])


def test_runs_of_single_texts():
    rng = random.Random(3)
    for _ in range(400):
        words = random_words(rng)
        numbers = {w: i + 2 for i, w in enumerate(dict.fromkeys(words))}
        got = pr.runs_of(np.array([0, *[numbers[w] for w in words], 1], np.int64))
        assert [(a - 1, n, q) for a, n, q in got.tolist()] == runs_by_force(words)


def test_misled_sums_are_corrected(monkeypatch):
    """Sums that agree too often: the comparison word by word still gives the right runs."""
    equal = pr.Extensions._equal
    monkeypatch.setattr(pr.Extensions, "_equal", lambda self, a, b, distance: equal(self, a, b, distance) | ((7 * a + b) % 3 > 0))
    words = [0, *([2, 3, 4] * 8), *range(5, 30), *([30] * 15), 1]
    assert [tuple(r) for r in pr.runs_of(np.array(words)).tolist()] == runs_by_force(words) == [(1, 24, 3), (50, 15, 1)]


def test_documents_against_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice([" ", "\n", " \t"]).join(random_words(rng)) + " é") for i in range(300)]
    rows += [(1000, None), (1001, ""), (1002, " \n\t "), (1003, "one"), (None, "a b " * 20), (1004, "x " * 30_000), (7, "a b " * 20), (7, "a b " * 20), (1005, "B b " * 9)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("runs", F.lit(1)).withColumn("n_words", F.lit("x")).repartition(4)
    got = sorted((r.doc_id is None, r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in pr.find_runs(docs).collect())
    want = []
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        runs = [(0, 30_000, 1)] if doc_id == 1004 else runs_by_force(words)
        dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
        want.append((doc_id is None, doc_id, len(words), runs, " ".join(w for i, w in enumerate(words) if i not in dropped)))
    assert got == sorted(want)
    assert pr.find_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError, match="least"):
        pr.find_runs(docs, least=6)


def contract(doc_id, text):
    """The returned row of one document, read from the contract."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = runs_by_force(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    milli = 1000 * best[1] // best[2] if runs else None
    return doc_id, len(runs), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest()


def test_query_against_brute_force(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, " ".join(random_words(rng)) if i % 17 else None) for i in range(400)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in periodic_runs(spark, str(tmp_path)).collect())
    assert got == sorted(contract(*r) for r in rows)
    null = spark.createDataFrame([(None, "a b")], SCHEMA)
    assert with_planted_runs(null).collect() == [(None, "a b")]
