"""Operators on texts against brute force, with nulls, empty and long texts, ties and repeated rows."""

import hashlib
import math
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from siltstone.llm import decontaminate as dec
from siltstone.llm import jaccard_join, language_id, piece_sampling, pii_sanitise, quality_rules, suffix_dedup
from siltstone.llm.registry import TOKENIZERS

SCHEMA = "doc_id long, text string"
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "a"), (5, "word " * 30_000), (6, "same text"), (6, "same text"), (None, "no id here")]


def made(seed, n=120, vocabulary=300, copies=12):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    rows = []
    while len(rows) < n:
        base = [rng.choice(words) for _ in range(rng.choice([3, 6, 20, 60, 200]))]
        for _ in range(rng.randint(1, copies)):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 25))):
                at = rng.randrange(len(w))
                w[at : at + 1] = rng.choice([[], [rng.choice(words)], [w[at], rng.choice(words)]])
            rows.append((100 + 3 * len(rows), " ".join(w)))
    return rows


def test_quality_counts(spark):
    df = spark.createDataFrame([*ODD, (7, "a b c a b c x\nq\nq \nq\n" + "#" * 9), (8, "a b c d e")], SCHEMA)
    got = {r.doc_id: r for r in quality_rules.judge(df.withColumn("words", F.lit(1))).collect()}
    assert [got[1].n_words, got[2].n_words, got[3].n_words] == [0, 0, 0]
    assert not (got[1].kept or got[2].kept) and got[5].base_failed and got[5].n_repeat_words == 30_000
    assert (got[7].n_words, got[7].n_symbols, got[7].n_dup_lines, got[7].n_repeat_words) == (11, 9, 1, 6)
    assert got[8].n_repeat_words == 0
    assert quality_rules.keep(df).count() == 0
    with pytest.raises(ValueError, match="columns in the way"):
        quality_rules.judge(df.withColumn("n_words", F.lit(1)))
    assert quality_rules.judge(df.limit(0)).count() == 0


def test_automaton_against_search():
    rng = random.Random(1)
    for round_ in range(150):
        window = 3 if round_ % 2 else rng.choice([2, 13])
        items = [[rng.choice("abcd").encode() for _ in range(rng.randint(1, 8 if window < 13 else 30))] for _ in range(rng.randint(1, 5))]
        machine = dec.Automaton([dec.Piece(str(i), w, len(w) < window) for i, w in enumerate(items)], window)
        text = [rng.choice("abcde").encode() for _ in range(rng.randint(0, 60))] + items[0]
        hit, ids = [0] * len(text), set()
        for i, words in enumerate(items):
            for w in [words] if len(words) < window else [words[j : j + window] for j in range(len(words) - window + 1)]:
                for p in range(len(text) - len(w) + 1):
                    if text[p : p + len(w)] == w:
                        ids.add(str(i))
                        hit[p : p + len(w)] = [1] * len(w)
        _, spans, found = machine.match(text)
        got = [0] * len(text)
        for a, b in spans:
            got[a:b] = [1] * (b - a)
        assert (got, found) == (hit, ids)


def test_decontamination_in_blocks(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(5, 40)))) for i in range(12)] + [(None, "Null id here"), (99, None), (3, "")]
    docs = [*ODD, *[(10 + i, " ".join(rng.choice(words) for _ in range(200)) + "! " + items[i % 12][1].upper()) for i in range(20)]]
    d, b = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id long, text string")
    one = sorted(map(repr, dec.find_hits(d, b).collect()))
    assert one == sorted(map(repr, dec.find_hits(d, b, block_words=40).collect()))
    assert all(r.n_hit > 0 for r in dec.find_hits(d, b).filter("doc_id >= 10").collect())
    assert dec.decontaminate(d, b).filter("doc_id < 10 OR doc_id IS NULL").count() == len(ODD)
    assert dec.find_hits(d, b.limit(0)).agg(F.sum("n_hit")).first()[0] == 0


def test_pieces_round_trip_and_distribution(spark):
    v = piece_sampling.read_vocabulary(f"{TOKENIZERS}/piece_bpe_32k.model")
    texts = [t.encode() for t in ("", "a", "  ", " x  y ", "▁", "a▁b", "\n\n", "é ✓ 漢 𝒳 \x00", "x" * 3000, "a\tb")]
    flat, first = piece_sampling.encode(v, texts, list(range(len(texts))))
    assert [piece_sampling.decode(v.pieces, flat[a:b].tolist()) for a, b in zip(first[:-1], first[1:])] == texts
    for i, t in enumerate(texts):  # alone as in a batch
        alone, _ = piece_sampling.encode(v, [t], [i], piece_sampling.Known())
        assert alone.tolist() == flat[first[i] : first[i + 1]].tolist()
    by_text = {p: i for i, p in enumerate(v.pieces) if i >= v.first_byte + 256}

    def ways(s):
        if not s:
            yield 0.0
        for n in range(1, len(s) + 1):
            if s[:n].encode() in by_text:
                for rest in ways(s[n:]):
                    yield v.weight[by_text[s[:n].encode()]] + rest

    import math

    best = math.exp(v.weight[by_text[b" the"]] + v.weight[by_text[b"re"]]) / sum(map(math.exp, ways(" there")))
    n = 20_000
    flat, first = piece_sampling.encode(v, [b"there"] * n, [(i * 7919 + 13) * 2654435761 for i in range(n)])
    seen = sum(flat[a:b].tolist() == [by_text[b" the"], by_text[b"re"]] for a, b in zip(first[:-1], first[1:]))
    assert abs(seen / n - best) < 0.02
    df = spark.createDataFrame(ODD, SCHEMA)
    rows = piece_sampling.decode_pieces(piece_sampling.sample_pieces(df, f"{TOKENIZERS}/piece_bpe_32k.model"), f"{TOKENIZERS}/piece_bpe_32k.model").collect()
    assert all(r.lossless and r.decoded == (r.text or "") for r in rows)


def components(rows):
    sets = {}
    for i, t in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and find(a) != find(b):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_jaccard_components(spark):
    rows = [*made(5), *[r for r in ODD if r[0]]]
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.similar_components(spark.createDataFrame([*rows, (None, "no id here")], SCHEMA)).collect()}
    assert found.pop(None) == (1, None)
    assert found == components(dict(rows).items())
    assert jaccard_join.similar_components(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_list_has_one_head_whatever_the_batches(spark, monkeypatch):
    """Long lists that end with a batch, and whose successor is long too."""
    monkeypatch.setattr(jaccard_join, "LONG_LIST", 4)
    rows = [(t, 1000 * t + i, (i << 32) + 10) for t, size in enumerate([8, 8, 1, 16, 12, 2, 4, 30]) for i in range(size)]
    entries = spark.createDataFrame(rows, "token long, sid long, n_pos long").repartition(1)
    for size in (1, 2, 3, 4, 5, 8, 100):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(size))
        found = jaccard_join.heads_and_lists(entries).filter("kind = 1").collect()
        heads = {}
        for r in found:
            heads.setdefault(r.sid // 1000, set()).add(r.head)
        assert heads == {t: {1000 * t} for t in (0, 1, 3, 4, 6, 7)}
        assert len({(r.list, r.sid) for r in found}) == 8 + 8 + 16 + 12 + 4 + 30
        assert len({r.list for r in found}) == 6


def test_no_link_is_lost_in_long_lists(spark, monkeypatch):
    """Many sets share a passage of rare words; lists are long and dealt in blocks."""
    monkeypatch.setattr(jaccard_join, "LONG_LIST", 6)
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 5)
    monkeypatch.setattr(jaccard_join, "GROUP", 4)
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(25)]
    rows = []
    for i in range(60):
        family = rng.randrange(9)
        own = [f"f{family}w{j}" for j in range(rng.choice([4, 12, 30, 90]))]
        if rng.random() < 0.6:
            own[rng.randrange(len(own))] = f"x{rng.randrange(5)}"
        rows.append((i, " ".join(passage + own)))
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.similar_components(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    assert found == components(rows)


def repeats(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    count = {}
    for _, b in texts:
        for p in range(len(b) - length + 1):
            count[b[p : p + length]] = count.get(b[p : p + length], 0) + 1
    out = []
    for i, b in texts:
        covered = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if count[b[p : p + length]] > 1:
                covered[p : p + length] = b"\1" * length
        kept = bytes(x for x, m in zip(b, covered) if not m)
        runs = sum(covered[k] and (k == 0 or not covered[k - 1]) for k in range(len(b)))
        out.append((i, len(b), len(b) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("length", "gram", "block"), [(40, 13, 4096), (24, 9, 2)])
def test_repeats(spark, monkeypatch, length, gram, block):
    monkeypatch.setattr(suffix_dedup, "BLOCK", block)
    rng = random.Random(7)
    parts = ["".join(rng.choice("abé ") for _ in range(rng.randint(10, 90))) for _ in range(8)]
    rows = [(k, "".join(rng.choice([rng.choice(parts), "".join(rng.choice("abc") for _ in range(rng.randint(0, 25)))]) for _ in range(rng.randint(0, 9)))) for k in range(150)]
    rows += [(1000, None), (1001, ""), (1002, "a" * 500), (1003, "ab" * 200), (None, "a" * 30 + parts[0]), rows[5]]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, SCHEMA), length=length, gram=gram).collect()
    assert sorted(map(tuple, got), key=repr) == repeats(rows, length)
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        total = sum(2 * int(c) - 9 * (int(c) > 4) if i % 2 else int(c) for i, c in enumerate(reversed(digits)))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def test_base_spans(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("aA9.%+-@ 1234567890é()𝒳") for _ in range(rng.randint(0, 120))) for _ in range(600)]
    texts += ["", None, "a@b.c@d.e a@b.c%d@e.f", "4111 1111 1111 1111 " * 50, "+49 (30) 123-4567 1.2.3.4.5.6.7.8 0001.2.3.255", "9" * 5000, "a." * 3000 + "@b.c", "1.2.3.4 " * 300]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    for r in pii_sanitise.detect(df).select("id", pii_sanitise.base_spans().alias("b")).collect():
        want = [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, texts[r.id] or "") if valid(k, m.group())]
        assert [tuple(x) for x in r.b] == want


def test_terms_that_give_an_entity_away(spark):
    rng = random.Random(4)
    plain = [f"plain{i}" for i in range(40)]
    say = lambda n: " ".join(rng.choice(plain) for _ in range(n))
    rows = [(i, f"{say(20)} Zorblatt {say(2)} zed@example.org {say(20)}") for i in range(6)] + [(10 + i, say(300)) for i in range(30)] + [(99, None), (98, "")]
    got = {r.doc_id: r for r in pii_sanitise.sanitise(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert "Zorblatt" not in got[0].sanitised and "[EMAIL]" in got[0].sanitised
    assert {s.kind for s in got[0].spans} == {"email", "term"}
    assert got[10].sanitised == rows[6][1] and got[10].spans == [] and got[99].sanitised is None and got[98].sanitised == ""


def test_a_text_copied_most_of_the_time_hides_no_language(spark):
    rng = random.Random(11)
    english = [f"the {rng.choice(['cat', 'dog', 'house'])} was {rng.choice(['under', 'over'])} the {i} bridges of this town" for i in range(30)]
    german = [f"die {rng.choice(['Katze', 'Maus'])} war {rng.choice(['unter', 'auf'])} den {i} Brücken dieser Stadt" for i in range(30)]
    copied = "there is one text that has been copied again and again"
    rows = [(e, "en") for e in english] + [(g, "de") for g in german]
    copies = spark.range(200_000).select(F.lit(copied).alias("text"), F.lit("en").alias("lang"))
    learned = spark.createDataFrame(rows, "text string, lang string").unionByName(copies)
    found = language_id.fit(learned, sample_docs=16)
    assert set(found) == {"de", "en"} and found["en"].count(b"\n") > 10
    asked = spark.createDataFrame([(1, "the bridges were under the house"), (2, "die Brücken waren unter der Stadt")], SCHEMA)
    assert [r.lang_pred for r in language_id.predict(asked, found).orderBy("doc_id").collect()] == ["en", "de"]


def test_language_edges(spark):
    df = spark.createDataFrame([*ODD, (9, "123 !?")], SCHEMA)
    learned = spark.createDataFrame([("the cat and the dog", "en"), ("die Katze und der Hund", "de"), (None, "xx"), ("le chat", None)], "text string, lang string")
    got = {r.doc_id: r for r in language_id.predict(df, language_id.fit(learned)).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3, 9)] == ["und"] * 4 and got[5].lang_pred in ("en", "de")
    assert {r.lang_pred for r in language_id.predict(df, {}).collect()} == {"und"}
    assert language_id.fit(learned.limit(0)) == {}


def test_contexts_are_the_nearest_words(spark):
    card = "4111 1111 1111 1111"
    long = "ж" * 900
    texts = [
        f"one 2027 two 12 30 {card} three 55 four 2028 five",  # plain numbers are failed matches of a card
        "a b c x@y.org d z@y.org e f +4930123456789 g +4930123456780 h",
        f"{long} x@y.org {long}ende tail",
        f"no{card} after",
        "x@y.org",
    ] + [" ".join(random.Random(i).choice(["w%d" % (i % 7), "x@y.org", card, "1.2.3.4", "77", "+49 30 1234567", "é"]) for i in range(200 * j, 200 * j + 90)) for j in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = sorted((r.text_key, r.entity, sorted(r.terms)) for r in pii_sanitise.entity_contexts(pii_sanitise.detect(df), "text", 3).collect())
    want = []
    for text in texts:
        spans = [(k, m.start(), m.end(), m.group()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if valid(k, m.group())]
        words = [(m.group().lower(), m.start(), m.end()) for m in re.finditer(pii_sanitise.WORD, text)]
        words = [w for w in words if not any(s <= w[1] and w[2] <= e for _, s, e, _ in spans)]
        for k, s, _, match in spans:
            near = [w for w, at, _ in words if at < s][-3:] + [w for w, at, _ in words if at >= s][:3]
            entity = f"{k}:{match.lower() if k in ('email', 'ip') else re.sub('[^0-9]', '', match)}"
            want.append((hashlib.md5(text.encode()).hexdigest(), entity, sorted(set(near))))
    assert got == sorted(want)


def test_terms_of_copies_and_brute_force(spark):
    rng = random.Random(11)
    say = lambda n: " ".join(rng.choice(["lorem", "ipsum", "dolor", "sit", "amet", "org"]) for _ in range(n))
    copies = [f"{say(30)} Sign{i} zed{i}@example.org {say(30)}" for i in range(3)]
    texts = copies[:1] * 300 + copies[1:] * 40 + [f"{say(10)} Rare{i % 5} mail a{i % 2}@b.org a{i % 2}@b.org Odd x +49 30 12345{i % 3}7 {say(9)} Rare{i % 4}" for i in range(30)]
    texts += [say(300) for _ in range(60)] + [None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    got = {r.doc_id: r for r in pii_sanitise.sanitise(df).collect()}
    for i in (0, 299, 300, 301):
        assert "Sign" not in got[i].sanitised and "[EMAIL]" in got[i].sanitised and "lorem" in got[i].sanitised
    near, all_words, spans_of = {}, {}, {}
    for text in filter(None, texts):
        spans = [(k, m.start(), m.end(), m.group()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if valid(k, m.group())]
        words = [(m.group().lower(), m.start(), m.end()) for m in re.finditer(pii_sanitise.WORD, text)]
        words = [w for w in words if not any(s <= w[1] and w[2] <= e for _, s, e, _ in spans)]
        for w in words:
            all_words[w[0]] = all_words.get(w[0], 0) + 1
        places = {}
        for k, s, _, match in spans:
            entity = f"{k}:{match.lower() if k in ('email', 'ip') else re.sub('[^0-9]', '', match)}"
            spans_of[entity] = spans_of.get(entity, 0) + 1
            p = sum(w[1] < s for w in words)
            places.setdefault(entity, set()).update(range(max(p - 8, 0), min(p + 8, len(words))))
        for entity, at in places.items():
            for i in at:
                near.setdefault(entity, {}).setdefault(words[i][0], []).append(1)
    n, want = sum(all_words.values()), {}
    for entity, terms in near.items():
        p_entity = sum(map(len, terms.values())) / n
        for term, found in terms.items():
            score = math.log(len(found) / all_words[term] / p_entity) / -math.log(p_entity)
            if len(found) >= 3 and spans_of[entity] >= 3 and score >= 0.8:
                want[entity, term] = score
    contexts = pii_sanitise.entity_contexts(pii_sanitise.detect(df), "text", 8)
    told = {(r.entity, r.term): r.disclosure for r in pii_sanitise.revealing_terms(contexts, df, "text").collect()}
    assert told == pytest.approx(want) and ("email:zed0@example.org", "sign0") in told


@pytest.mark.parametrize("bound", [1 << 25, 0])
def test_marked_terms_go_from_every_text(spark, monkeypatch, bound):
    monkeypatch.setattr(pii_sanitise, "BROADCAST_BYTES", bound)
    rng = random.Random(5)
    say = lambda n: " ".join(rng.choice([f"plain{i}" for i in range(40)]) for _ in range(n))
    rows = [(i, f"{say(20)} Zorblatt {say(2)} zed@example.org {say(20)}") for i in range(60)] + [(100 + i, say(300)) for i in range(30)]
    rows += [(200, "plain1 zorblatt, plain2"), (201, "plain1 zorblatt, plain2"), (202, "Zorblatts"), (203, None)]
    got = {r.doc_id: r for r in pii_sanitise.sanitise(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == len(rows) and got[200].sanitised == got[201].sanitised == "plain1 , plain2"
    assert [tuple(x) for x in got[200].spans] == [("term", 7, 15)] and got[200].n_email == 0
    assert got[202].sanitised == "Zorblatts" and got[203].sanitised is None and got[100].sanitised == rows[60][1]


def test_spans_of_rows_that_repeat_are_held_once(spark):
    rng = random.Random(21)
    text = "".join(rng.choice("abcdefgh ") for _ in range(1500))
    rows = [(1, text)] * 300 + [(None, text)] * 200 + [(2, text[:700])]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    keyed = docs.select(F.coalesce("doc_id", F.lit(-1)).alias("id"), F.xxhash64("text", F.lit(1)).alias("hash"), "text")
    spans = suffix_dedup.repeated_spans(keyed, 64, 33).collect()
    assert max(len(r.spans) for r in spans) < 200  # of one text, not of all its copies
    out = suffix_dedup.remove_repeats(docs, length=64, gram=33)
    assert {(r.doc_id, r.n_removed) for r in out.collect()} == {(1, 1500), (None, 1500), (2, 700)}


class Rows:
    """Takes the place of a DataFrame: hands out the function that its tasks run."""

    def __getattr__(self, name):
        return (lambda function, schema: function) if name == "mapInArrow" else lambda *columns: self


def test_memory_of_repeat_search_is_bounded():
    rng = random.Random(31)
    say = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    texts = [say(100_000) for _ in range(30)] + [say(3 << 20)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(31)), pa.array(range(31)), pa.array(texts)], names=["id", "hash", "text"])
    parts = [(k // 2, 0, False, k, say(143).encode(), say(143).encode()) for k in range(3_000)]
    parts += [(3_000, 0, True, k, say(143).encode(), say(143).encode()) for k in range(1_500)]
    cut = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*parts, strict=True)], names=["anchor", "part", "split", "around", "before", "after"])
    for function, rows in ((suffix_dedup.anchors(Rows(), 400, 257), batch), (suffix_dedup.sorted_windows(Rows(), 400, 257), cut)):
        tracemalloc.start()
        try:
            for _ in function(iter([rows])):
                pass
            assert tracemalloc.get_traced_memory()[1] < 56 << 20
        finally:
            tracemalloc.stop()


def test_repeats_in_texts_of_many_pieces(spark):
    rng = random.Random(32)
    say = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    size, shared = suffix_dedup.SLICE_BYTES, [say(300) for _ in range(4)]
    first = say(size - 100) + shared[0] + say(2_000) + shared[1] + say(size - 2_400) + "xyz" * 200 + say(500)
    second = say(70) + shared[1] + say(size - 400) + shared[0] + say(20) + shared[2]
    rows = [(1, first), (2, second), (3, say(500) + shared[2]), (4, "é" * (size // 2 + 40)), (5, shared[3])]
    data = np.frombuffer(first.encode(), np.uint8)
    ends = np.full(len(data), len(data))
    want = suffix_dedup._placed(data, np.zeros_like(ends), ends, ends - np.arange(len(data)) >= 64, 64, 33)
    got = zip(*suffix_dedup._placed_in_pieces(first.encode(), 64, 33), strict=True)
    assert all((np.concatenate(g) == w).all() for g, w in zip(got, want, strict=True))
    out = suffix_dedup.remove_repeats(spark.createDataFrame(rows, SCHEMA), length=64, gram=33)
    assert sorted(map(tuple, out.collect()), key=repr) == repeats(rows, 64)


def test_copies_of_an_item_are_dealt_once(spark, monkeypatch):
    """A text that is most of the benchmark neither fills a block nor goes to the driver more than once."""
    words = [" ".join(f"{c}{i}" for i in range(30)) for c in "abcd"]
    items = [(i, words[0].upper() if i % 2 else words[0]) for i in range(400)] + [(1000 + i, w) for i, w in enumerate(words)] + [(None, words[1])]
    sizes = []
    made = dec.Automaton.__init__
    monkeypatch.setattr(dec.Automaton, "__init__", lambda self, pieces, window: (sizes.append(len(pieces)), made(self, pieces, window))[1])
    docs = spark.createDataFrame([(1, "x " + words[0] + " y"), (2, words[1]), (3, "nothing"), (4, words[2] + " " + words[3])], SCHEMA)
    b = spark.createDataFrame(items, "item_id long, text string").repartition(3)
    for block_words in (250_000, 40):
        sizes.clear()
        got = {r.doc_id: (r.n_hit, r.item_ids) for r in dec.find_hits(docs, b, block_words=block_words).collect()}
        assert got == {1: (30, sorted([*map(str, range(400)), "1000"])), 2: (30, ["1001"]), 3: (0, []), 4: (60, ["1002", "1003"])}
        assert sum(sizes) == 4
