"""Queries without an SQL twin, by their registered names, over whole tables and against brute force."""

import re
import zlib
from html import unescape

import brute
import pytest
from columns_of import word_column
from conftest import SF_SMALL

from cardlens.llm import language_model, quality_classifier
from cardlens.llm.registry import llm_queries


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()


def rows_of(spark, name):
    return llm_queries()[name](spark, SF_SMALL).collect()


def test_op2(spark, docs):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    want = brute.leaks([(r.doc_id, r.text) for r in docs], items)
    assert {(r.doc_id, r.item_id): (r.n_shared, r.n_shingles) for r in rows_of(spark, "op2_decontaminate")} == want and want


def test_op3(spark, docs):
    texts = {r.doc_id: r for r in docs}
    rows = rows_of(spark, "op3_quality_rules")
    assert len(rows) == len(docs)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute.quality_counts(texts[r.doc_id].text)
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
    from cardlens.llm.quality_rules import measure

    measured = measure(spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "lang", "text")).collect()
    want = dict(zip((r.doc_id for r in measured), brute.rules_kept([(r.lang, r.measures) for r in measured])))
    assert {r.doc_id: r.kept for r in rows} == want and 0 < sum(want.values()) < len(want)


def test_op5(spark, docs):
    rows = rows_of(spark, "op5_language_model")
    learnt = [r.text for r in docs if zlib.crc32(str(r.doc_id).encode()) % 7 != 2]
    model = brute.Bigrams(learnt)
    _, fitted = language_model.score_texts(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), language_model.learns_from())
    texts = {r.doc_id: r.text for r in docs}
    assert len(rows) == len(docs)
    for r in rows:
        t = texts[r.doc_id]
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2) and r.train_tokens == model.total
        assert (r.n_tokens, r.n_known) == (len(model.tokens(t)), model.known(t))
        assert r.base_score == pytest.approx(model.base(t)) and r.score == pytest.approx(model.score(t, fitted.weights))


def test_op7(spark):
    want = []
    for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(unescape(re.sub(r"</?b>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        text = "\n\n".join(b for b in blocks if b)
        want.append((r.page_id, r.url, text, len(text)))
    assert sorted((r.page_id, r.url, r.text, r.n_chars) for r in rows_of(spark, "op7_html_text")) == sorted(want)


def test_op8(spark, docs):
    ordered = sorted((r.doc_id, r.text) for r in docs)
    prints = [brute.fingerprint(t) for _, t in ordered]
    want = {d: (f"{p:016x}", ordered[g][0]) for (d, _), p, g in zip(ordered, prints, brute.groups(prints))}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows_of(spark, "op8_simhash")} == want


def test_op10(spark, docs):
    rows = {r.doc_id: r for r in rows_of(spark, "op10_quality_classifier")}
    model = quality_classifier.fit(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    assert len(rows) == len(docs)
    for r in docs:
        got = rows[r.doc_id]
        assert got.score == pytest.approx(brute.classifier_score(model, r.text, word_column), abs=1e-6)
        assert got.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and got.predicted == int(got.score >= 0.5)
