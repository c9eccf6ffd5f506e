"""Registered queries against SQL, and their edge cases through small tables."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="no test tables here")


def test_each_operator_has_a_query():
    assert {int(n[2:].split("_")[0]) for n in contract.LLM_QUERIES if n != "pipeline"} == set(set(range(1, 14)))
    assert "pipeline" in contract.queries()


@pytest.mark.parametrize("name", sorted(contract.LLM_ORACLES))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found = contract.queries()[name](spark, SF)
    cursor = con.execute(contract.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(found.columns)
    want = sorted(repr(r) for r in cursor.fetchall())
    assert sorted(repr(tuple(r)) for r in found.select(*names).collect()) == want


def test_language_held_out_accuracy(spark):
    rows = contract.queries()["op10_language_id"](spark, SF).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    judged = [r for r in rows if r.held_out and docs[r.doc_id].lang and len(docs[r.doc_id].text) > 50]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in judged) >= 0.95 * len(judged)
    assert all(0 <= r.score <= 1 for r in rows)


def test_pipeline_matches_its_parts(spark):
    import corpus_pipeline as p

    out = {r.doc_id: r for r in p.run(spark, SF).collect()}
    kept = {r.doc_id for r in contract.queries()["op2_quality_rules"](spark, SF).collect() if r.kept}
    dirty = {r.doc_id for r in contract.queries()["op3_benchmark_decontamination"](spark, SF).collect() if r.contaminated}
    assert set(out) <= kept - dirty
    linked = {r.doc_id: r.component_id for r in contract.queries()["op7_jaccard_join"](spark, SF).collect()}
    # Only documents of a component with another survivor of the rules may have gone.
    for d in kept - dirty - set(out):
        assert any(linked[o] == linked[d] and o != d for o in kept)
    assert len({linked[d] for d in out}) == len(out)
    assert all(r.lossless for r in out.values())


def test_one_row_of_each_component_stays(spark):
    import corpus_pipeline as p

    text, near, other = (" ".join(f"{x}{i}" for i in range(60)) for x in "aab")
    near += " tail"
    rows = [(7, text, 1), (7, text, 1), (7, text, 1), (7, other, 2), (None, near, 3), (9, near, 4)]  # repeated id, one id with two texts
    rows += [(None, " ".join(f"c{i}" for i in range(60)), 5)] * 40 + [(None, "", 6), (None, None, 7)]  # no id at all
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars int").repartition(5)
    got = sorted((r.n_chars, r.doc_id, r.text) for r in p.near_duplicates(spark, docs, "").collect())
    assert got == [(1, 7, text), (2, 7, other), (5, None, rows[6][1]), (6, None, ""), (7, None, None)]


def test_token_counts_against_brute_force(spark):
    from siltstone.llm.q_documents import token_counts
    from siltstone.llm.registry import TOKENIZERS
    from siltstone.llm.token_counts import coder

    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("toxic = 1").collect()}
    want = {}
    for version in ("byte_bpe_50k", "byte_bpe_multi_50k"):
        encode = coder(f"{TOKENIZERS}/{version}.tiktoken").encode_ordinary
        for d in docs:
            n, revised = len(encode(d.text or "")), len(encode(re.sub(r"[\x20\x09-\x0D]+", " ", d.text or "")))
            row = want.setdefault((d.source, d.lang, version), [0] * 6)
            changes = [(1, n), (-1, n)] if d.doc_id in toxic else [(1, n)] if version != "byte_bpe_50k" else [(1, n), (-1, n), (1, revised)]
            for sign, tokens in changes:
                row[0] += sign
                row[1] += sign * tokens
                row[2 if sign > 0 else 4] += 1
                row[3 if sign > 0 else 5] += tokens
    names = ("docs", "tokens", "inserted_docs", "inserted_tokens", "deleted_docs", "deleted_tokens")
    got = {(r.source, r.lang, r.tokenizer): [r[n] for n in names] for r in token_counts(spark, SF).collect()}
    assert got == want
