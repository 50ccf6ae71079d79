"""The pipeline stage by stage against plain versions, and on an empty table."""

import corpus_pipeline
import pytest

from evalspark.llm import common, decontam

from .conftest import ITEMS
from .test_queries import brute_edits, brute_spans, shingles

COLUMNS = 5


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "decontamination", "pii", "packing"]


def test_empty(spark, empty):
    assert corpus_pipeline.run(spark, empty).collect() == []


def test_stages(spark, odd):
    docs = common.documents(spark, odd)
    columns = docs.columns
    kept = stage("language_id")(spark, docs, odd)
    assert kept.columns == columns
    before, rows = docs.collect(), kept.collect()
    assert {r.doc_id for r in before} - {r.doc_id for r in rows} == {110, 111, 112, 113}
    assert all(any(c.isalpha() for c in r.text) for r in rows)

    kept = common.stored(kept)
    out = stage("near_duplicates")(spark, kept, odd)
    assert out.columns == columns
    unique = out.collect()
    assert {101, 100, 102, 103, 116} & {r.doc_id for r in unique} == set() and {5, 115} <= {r.doc_id for r in unique}
    sets = [(r.doc_id, shingles(r.text)) for r in unique]
    for x, (_, a) in enumerate(sets):
        assert not any(a and 100 * len(a & b) >= 75 * len(a | b) for _, b in sets[:x])
    gone = [r for r in rows if r.doc_id not in {u.doc_id for u in unique}]
    assert all(any(100 * len(shingles(g.text) & b) >= 75 * len(shingles(g.text) | b) for _, b in [(r.doc_id, shingles(r.text)) for r in rows
                                                                                               if r.doc_id != g.doc_id]) for g in gone)

    kept = common.stored(out)
    out = stage("decontamination")(spark, kept, odd)
    assert out.columns == columns
    held = set()
    for r in unique:
        words = decontam.words_of(r.text)
        for _, text in ITEMS:
            own = decontam.words_of(text)
            if own and len(words) < 5000 and brute_edits(own, words) <= decontam.most_edits(len(own), 75):
                held.add(r.doc_id)
    clean = out.collect()
    assert held == {140} == {r.doc_id for r in unique} - {r.doc_id for r in clean}

    kept = common.stored(out)
    out = stage("pii")(spark, kept, odd)
    assert out.columns == columns and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    masked = out.collect()
    assert len(masked) == len(clean)
    assert all(not brute_spans(r.text) and r.n_chars == len(r.text) for r in masked)

    packed = stage("packing")(spark, common.stored(out), odd).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in masked}


@pytest.mark.parametrize("lang", [None, "en"])
def test_no_language_to_learn_from(spark, odd, lang):
    docs = spark.createDataFrame([(1, "a b c", lang, "s", 5), (2, None, lang, "s", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    assert stage("language_id")(spark, docs, odd).count() == (2 if lang is None else 1)


@pytest.mark.parametrize("n_langs", [1, 8])
def test_rejection_does_not_depend_on_languages(spark, odd, n_langs):
    """A word that all languages share stays, a script that none has goes, whatever their number."""
    docs = [(i, "alpha beta gamma" + f" own{'abcdefgh'[i % n_langs]}", f"l{i % n_langs}") for i in range(40)]
    docs += [(100, "alpha beta", None), (101, "語 言", None)]
    kept = stage("language_id")(spark, spark.createDataFrame(docs, "doc_id long, text string, lang string"), odd)
    assert {r.doc_id for r in kept.collect()} == {*range(40), 100}


def test_one_id_with_several_texts(spark, odd):
    a, b, c = ("one two three four five six seven", "red green blue white black grey pink", "oak ash elm fir yew box bay")
    rows = [(7, a), (7, b), (9, a), (12, b), (20, c), (20, c), (30, "sun moon star sky sea sand"), (30, "tin iron gold lead zinc neon")]
    kept = stage("near_duplicates")(spark, spark.createDataFrame(rows, "doc_id long, text string"), odd).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted([(9, a), (12, b), (20, c), *rows[6:]])
