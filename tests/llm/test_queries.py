"""Registered queries on the smallest tables, against plain Python over every document."""

import brute
import corpus_pipeline
import pytest

import __spark_entry__ as entry
from meterlake.llm import decontaminate, simhash_dups
from meterlake.llm.common import read

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in read(spark, SF, "documents").collect()}


def test_every_operator_and_the_pipeline_are_registered():
    names = entry.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5


def rows(spark, name):
    return entry.queries()[name](spark, SF).collect()


def test_rules(spark, texts):
    got = rows(spark, "op1_quality_rules")
    assert {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
            for r in got} == {i: brute.quality(t) for i, t in texts.items()}
    got = rows(spark, "op3_pii")
    assert {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got} == {
        i: brute.pii(t) for i, t in texts.items()}
    got = rows(spark, "op10_secret_scan")
    assert {r.doc_id: (r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got} == {
        i: brute.secrets(t) for i, t in texts.items()}


def test_groups(spark, texts):
    assert sorted(map(tuple, rows(spark, "op9_simhash_dedup")), key=repr) == brute.simhash(texts.items())
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows(spark, "op7_suffix_dedup")}
    assert got == dict(zip(texts, brute.repeats([(t or "").encode() for t in texts.values()]), strict=True))


def test_leaks_hold_every_exact_copy(spark, texts):
    got = {(r.doc_id, r.item_id) for r in rows(spark, "op2_decontamination")}
    for item in read(spark, SF, "benchmark").collect():
        words = " ".join(decontaminate.tokens(item.text))
        for doc, text in texts.items():
            if f" {words} " in f" {' '.join(decontaminate.tokens(text))} ":
                assert (doc, item.item_id) in got


def test_one_row_per_document(spark, texts):
    for name in ("op4_toxicity", "op5_mixing", "op6_hilbert_shards", "op8_lm_scores"):
        assert sorted(r.doc_id for r in rows(spark, name)) == sorted(texts)


def test_pipeline_follows_its_stages(spark, texts):
    docs = read(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        docs = stage(spark, docs, SF)
        after = {r.doc_id for r in docs.select("doc_id").collect()}
        assert after <= set(before)
        if name == "simhash_dedup":
            assert after == {c for _, _, c in brute.simhash(before.items())}
        if name == "sharding":
            assert after == set(before)
        else:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()} == after
    assert simhash_dups.near_duplicates(docs).count() == len(after)
