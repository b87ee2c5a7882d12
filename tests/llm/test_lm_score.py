"""Counts and base scores against plain ones; probabilities sum to one; the
model beats the base score on held-out documents."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tollgate.llm import lm_score as S


def plain(docs):
    tok = {i: re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) + [" "] for i, (_, t) in enumerate(docs)}
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1 for d, _ in docs]
    c = Counter(w for i, ws in tok.items() if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    return [(d, held[i], len(tok[i]), sum(c[w] > 0 for w in tok[i]), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tok[i])) for i, (d, _) in enumerate(docs)]


def close(got, want):
    key = lambda r: (str(r[0]), r[2], r[3], round(r[5], 4))
    got, want = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in got], [r[5] for r in want])


def test_query(spark):
    from tollgate.llm.lm_score_query import op2_lm_score

    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = op2_lm_score(spark, sf).collect()
    close(got, plain(docs))
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


@pytest.mark.parametrize("chunk", [1 << 20, 30])
def test_odd_rows(spark, chunk):
    docs = [(1, "A b c"), (2, None), (3, ""), (None, "x"), (4, "a b a b"), (4, "a b a b"), (5, "é " * 40000), (9, " \t\n"), (10, "new words"), (11, "q r"), (12, "q é")]
    df = spark.createDataFrame([(a, b, 1) for a, b in docs], "doc_id long, text string, score int")
    got = S.score(df, chunk_bytes=chunk).collect()
    close(got, plain(docs))
    assert all(r.score < 0 for r in got)
    assert S.score(df.limit(0)).count() == 0
    held = df.filter("crc32(cast(cast(doc_id as string) as binary)) % 5 = 1")
    assert all(r.train_tokens == 0 for r in S.score(held).collect())


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(0)
    m = S.Model.start(rng.integers(0, 100, S.CLASSES))
    prefix = rng.integers(0, S.CLASSES, 9).astype(np.uint8)
    docs = [np.r_[prefix, np.uint8(k)] for k in range(S.CLASSES)]
    p = np.exp(S.log_probabilities(m, docs)).reshape(-1, 10)
    assert abs(p[:, -1].sum() - 1) < 1e-5
    assert np.allclose(p[:, :-1], p[0, :-1])


def test_training_learns():
    rng = np.random.default_rng(1)
    docs = [np.tile(rng.integers(0, 2, 1) * 10 + np.arange(10), 30).astype(np.uint8) for _ in range(200)]
    c = np.bincount(np.concatenate(docs), minlength=S.CLASSES).astype(float)
    m = S.Model.start(c)
    before = S.log_probabilities(m, docs[:20]).mean()
    noise = (c + 0.5) / (c + 0.5).sum()
    for _ in range(3):
        S.train(m, S.grouped(iter(docs)), noise)
    assert S.log_probabilities(m, docs[:20]).mean() > before + 1.0


def test_a_long_text_takes_steps_of_bounded_memory():
    import tracemalloc

    rng = np.random.default_rng(2)
    m = S.Model.start(np.ones(S.CLASSES))
    doc = rng.integers(0, S.CLASSES, 600_000).astype(np.uint8)
    noise = np.full(S.CLASSES, 1 / S.CLASSES)
    for run in (lambda: S.train(S.Model(m.flat.copy()), S.grouped(iter([doc])), noise), lambda: S.document_scores(m, [doc])):
        tracemalloc.start()
        run()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 30e6  # a float32 vector for each token is 58 MB


def test_steps_carry_the_history():
    rng = np.random.default_rng(3)
    m = S.Model.start(rng.integers(0, 100, S.CLASSES))
    docs = [rng.integers(0, S.CLASSES, n).astype(np.uint8) for n in (3, 50, 1, 20, 7)]
    for d in docs:
        parts = [np.zeros((len(d), S.DIMENSIONS)) for _ in range(3)]
        for t in range(len(d)):
            for k in (1, 2):
                if t >= k:
                    parts[k - 1][t] = m.context[d[t - k]]
            if t:
                parts[2][t] = m.context[d[:t]].mean(axis=0)
        s = sum(w * p for w, p in zip(m.weight, parts)) @ m.target.T + m.bias
        want = s[np.arange(len(d)), d] - np.log(np.exp(s).sum(axis=1))
        assert np.allclose(S.log_probabilities(m, [d]), want, atol=1e-4)
    whole = np.concatenate([S.step_log_probabilities(m, s) for s in S.steps(docs, 1000)])
    for size in (1, 2, 3, 8):
        assert np.allclose(np.concatenate([S.step_log_probabilities(m, s) for s in S.steps(docs, size)]), whole, atol=1e-4)
    ends = np.cumsum([len(d) for d in docs])
    assert np.allclose(S.document_scores(m, docs), [x.sum() for x in np.split(whole, ends[:-1])], atol=1e-3)


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(4)
    m = S.Model.start(rng.integers(0, 100, S.CLASSES))
    m.weight[2] = 3.0
    noise = rng.random(S.CLASSES)
    noise /= noise.sum()
    drawn = rng.choice(S.CLASSES, S.NOISE, p=noise)
    docs = [rng.integers(0, 12, n).astype(np.uint8) for n in (5, 90, 1, 30)]

    def loss(flat, step):
        x = S.Model(flat)
        h = sum(w * p for w, p in zip(x.weight, step.parts(x.context))).astype(np.float64)
        offset = np.log(noise) + np.log(S.NOISE)
        y = step.classes
        good = (h * x.target[y]).sum(axis=1) + (x.bias - offset)[y]
        bad = h @ x.target[drawn].T + (x.bias - offset)[drawn]
        return (np.logaddexp(0, -good) + np.logaddexp(0, bad).sum(axis=1)).mean()

    for step in S.steps(docs, 40):  # the second step begins inside a document
        g = S.gradient(m, step, noise, drawn).flat.astype(float)
        for part in range(len(S.Model.SHAPES)):
            at = sum(int(np.prod(s)) for s in S.Model.SHAPES[:part])
            own = slice(at, at + int(np.prod(S.Model.SHAPES[part])))
            d = np.zeros(S.Model.SIZE)
            d[own] = g[own] / np.linalg.norm(g[own])
            slope = (loss(m.flat + 0.01 * d, step) - loss(m.flat - 0.01 * d, step)) / 0.02
            assert np.isclose(slope, g @ d, rtol=0.01)


def test_runs_are_equal(spark):
    """Rounds follow from the ids: two runs score alike."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    a, b = ({r.doc_id: r.score for r in S.score(df, chunk_bytes=20_000).collect()} for _ in range(2))
    assert a.keys() == b.keys() and max(abs(a[i] - b[i]) for i in a) < 1e-6
