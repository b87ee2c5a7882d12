"""Held-out quality, the normal equations and calibration, odd rows."""

import zlib

import numpy as np

from tollgate.llm import quality_classifier as Q
from tollgate.llm.quality_classifier_query import op7_quality_classifier


def test_held_out(spark):
    sf = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = op7_quality_classifier(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [(r.score, r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    score, predicted, y = map(np.array, zip(*held))
    good, bad = score[y == 1], score[y == 0]
    auc = ((good[:, None] > bad).mean() + 0.5 * (good[:, None] == bad).mean())
    assert auc >= 0.95
    assert (predicted == y).mean() >= 0.95
    assert abs(score.mean() - y.mean()) < 0.05
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_normal_equations_and_isotonic(spark):
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(200, len(Q.STATISTICS))), rng.integers(0, 2, 200).astype(float)
    df = spark.createDataFrame([(r.tolist(), float(v)) for r, v in zip(x, y)], "x array<double>, y double").repartition(3)
    f = Q.Fourier(np.zeros(len(Q.STATISTICS)), np.ones(len(Q.STATISTICS)), 16, 2.0, 1)
    a, b = Q.normal_equations(df, f)
    z = f(x)
    assert np.allclose(a, z.T @ z) and np.allclose(b, z.T @ y)
    assert Q.isotonic(np.array([1.0, 1, 2, 1]), np.array([0.0, 1, 0, 1])).tolist() == [0, 1 / 3, 1 / 3, 1]


def test_odd_rows(spark):
    docs = spark.createDataFrame([(i, t, 9) for i, t in [(1, "a b c."), (2, None), (3, ""), (None, "x y"), (4, "!! !!"), (4, "!! !!"), (5, "w " * 50000)]], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (4, 0), (5, None), (9, 1), (None, 1), (4, 7)], "doc_id long, quality int")
    got = Q.classify(docs, labels).collect()
    assert len(got) == 7 and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in Q.classify(docs, labels.limit(0)).collect()} == {0.5}
    assert Q.classify(docs.limit(0), labels).count() == 0
