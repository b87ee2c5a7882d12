"""Held-out accuracy, mixtures of known proportions, odd rows."""

import zlib

import numpy as np

from tollgate.llm import language_id as L
from tollgate.llm.language_id_query import op4_language_mixture


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    rows = op4_language_mixture(spark, sf).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_trigrams_by_word():
    grams, starts = L.trigrams("Ab c éé 12 a_b")
    assert len(starts) == 5
    alone = [L.trigrams(w)[0] for w in ("ab", "c", "éé", "a", "b")]
    assert [x.tolist() for x in np.split(grams, starts[1:])] == [x.tolist() for x in alone]


def test_mixture_finds_the_set():
    rng = np.random.default_rng(0)
    true = rng.choice(3, 400, p=[0.6, 0.4, 0.0])
    words = np.full((400, 3), -9.0)
    words[np.arange(400), true] = -3.0
    chosen, weights = L.mixture(words, 2.0)
    assert sorted(chosen) == [0, 1]
    assert abs(weights[chosen.index(0)] - (true == 0).mean()) < 0.02
    assert L.mixture(words[true == 0], 2.0)[0] == [0]


def test_odd_rows(spark):
    rows = [(1, "the cat the dog", "en"), (2, "le chat le chien", "fr"), (3, None, "en"), (4, "", None), (5, "123 _ !", "en"), (None, "the the", None),
            (1, "the cat the dog", "en"), (6, "the " * 30000, "en"), (8, "le le le", "fr"), (9, "ß", None)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, score int")
    got = L.identify(df).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    assert [by[i].lang_pred for i in (3, 4, 5)] == ["und"] * 3 and by[4].score == 0
    assert L.identify(df.limit(0)).count() == 0
    nothing = L.identify(df.selectExpr("doc_id", "text", "cast(null as string) as lang"))
    assert {r.lang_pred for r in nothing.collect()} == {"und"}


def test_letters_are_letters():
    import sys
    import unicodedata

    every = [chr(c) for c in range(sys.maxunicode + 1)]
    assert set("".join(L.letters_of(" ".join(every)))) == {c for c in every if unicodedata.category(c)[0] == "L"}


def test_numbers_alone_are_und(spark):
    rows = [(1, "the cat", "en"), (2, "le chat", "fr"), (4, "\u00b2\u00b3 \u00bd \u2167", "en"), (5, "\u00b2 the", "en")]
    got = {r.doc_id: r.lang_pred for r in L.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert got[4] == "und" and got[5] != "und"


def test_blocks_of_words(monkeypatch):
    rng = np.random.default_rng(1)
    table = rng.normal(size=(L.BUCKETS, 3)).astype(np.float32)
    grams, starts = L.trigrams("some words of a text in blocks " * 300)
    whole = L.word_scores(table, grams, starts)
    monkeypatch.setattr(L, "WORDS", 7)
    assert np.array_equal(whole, L.word_scores(table, grams, starts))
    assert np.allclose(whole[1], table[grams[starts[1]:starts[2]]].sum(axis=0), atol=1e-5)
