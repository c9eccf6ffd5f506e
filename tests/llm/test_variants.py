"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from siltstone.llm import spelling_variants as sv
from siltstone.llm.q_corpus import spelling_variants

LETTERS = "abcé×"


def edited(word, letters):
    """All words one edit away."""
    out = set()
    for i in range(len(word) + 1):
        out |= {word[:i] + c + word[i:] for c in letters}
        if i < len(word):
            out |= {word[:i] + c + word[i + 1 :] for c in letters} | {word[:i] + word[i + 1 :]}
    return out - {word}


def by_force(counts, times=5):
    letters = {c for w in counts for c in w}
    form, near = {}, {}
    for word, n in counts.items():
        others = edited(word, letters) & counts.keys()
        near[word] = len(others)
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[word] = best if best is not None and counts[best] >= times * n else None
    out = []
    for word, n in counts.items():
        root = word
        while form[root] is not None:
            root = form[root]
        out.append((word, n, near[word], form[word], counts.get(form[word]), root))
    return sorted(out)


def vocabulary(rng, n):
    """Families of words a few edits apart, some with counts five times another's."""
    words = {}
    while len(words) < n:
        w = "".join(rng.choice(LETTERS) for _ in range(rng.randint(6, 12)))
        for _ in range(rng.randint(1, 6)):
            if len(w) >= 6:
                words[w] = rng.choice([5, 6, 25, 30, 125, 150, 700, 4000])
            w = rng.choice(sorted(edited(w, LETTERS)))
    return words


@pytest.mark.parametrize("candidates", [30, 4096])
def test_words_against_brute_force(spark, rows, candidates):
    counts = vocabulary(random.Random(candidates), 300)
    counts |= {"aaaaaa" + "".join(p): 7 for p in (x + y + z for x in LETTERS for y in LETTERS for z in LETTERS)}  # all within three letters
    counts |= {"a" * 300: 900, "a" * 299: 100, "a" * 150 + "b" + "a" * 149: 20}
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(4)
    got = rows(sv.group_variants(words, candidates=candidates), "word", "n", "n_near", "form", "form_n", "root")
    assert sorted(got) == by_force(counts)


def test_ties_and_empty(spark, rows):
    words = spark.createDataFrame([("abcdex", 50), ("abcdey", 50), ("abcdef", 10), ("abcde", 1)], "word string, n long")
    got = {r.word: r for r in sv.group_variants(words).collect()}
    assert (got["abcdef"].form, got["abcdef"].n_near, got["abcde"].form, got["abcdex"].form) == ("abcdex", 3, "abcdex", None)
    assert sv.group_variants(words.limit(0)).count() == 0


def test_counts(spark, rows):
    data = [(1, "Straße STRASSE strasse"), (2, None), (3, ""), (None, "strasse"), (4, "strasse " * 3), (4, "strasse"), (5, "écoute ÉCOUTE a÷bcdef×"), (6, "x" * 40_000), (7, "don't stop")]
    docs = spark.createDataFrame(data, "doc_id long, text string").withColumn("word", F.lit(1)).withColumn("n", F.lit(1)).repartition(3)
    want = [("strasse", 7), ("straße", 1), ("x" * 40_000, 1), ("a÷bcdef×", 1), ("écoute", 1), ("École"[:1] + "coute", 1)]
    assert sorted(rows(sv.word_counts(docs, rarest=1))) == sorted(want)
    assert rows(sv.word_counts(docs)) == [("strasse", 7)]
    assert sv.word_counts(docs.limit(0)).count() == 0


def test_query_against_brute_force(spark, rows, tmp_path):
    rng = random.Random(9)
    words = list(vocabulary(rng, 60))
    data = [(i, None if i % 29 == 0 else " ".join(rng.choice(words).capitalize() for _ in range(rng.randint(0, 150)))) for i in range(300)]
    spark.createDataFrame(data, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    counts = Counter()
    for doc_id, text in data:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    got = rows(spelling_variants(spark, str(tmp_path)), "word", "n", "n_near", "form", "form_n", "root")
    assert sorted(got) == by_force(counts)
