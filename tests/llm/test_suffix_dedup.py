"""Merged transforms against sorted suffixes; removal against plain counting."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tollgate.llm import bwt, suffix_dedup as S


def plain(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[i:i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for t in raw:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        runs = bytes(gone).split(b"\0")
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((len(t), sum(gone), sum(1 for r in runs if r), hashlib.sha256(kept).hexdigest()))
    return out


def test_merge_equals_sorted_suffixes():
    rng = np.random.default_rng(3)
    for depth in (1, 3, 6):
        strings = [rng.integers(1, 4, rng.integers(0, 12)).tolist() for _ in range(60)]
        text = np.array([x for s in strings for x in [*s, 0]], np.uint16)
        ends = np.cumsum([len(s) + 1 for s in strings])
        got = set(bwt.repeated(text, ends[9::10].tolist(), depth).tolist())
        starts = ends - [len(s) + 1 for s in strings]
        sub = {int(a) + i: tuple(s[i:i + depth]) for a, s in zip(starts, strings) for i in range(len(s) - depth + 1)}
        n = Counter(sub.values())
        assert got == {p for p, x in sub.items() if n[x] > 1}


def corpus(seed, length):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(length // 2) for _ in range(6)]
    out = [None, "", "x", "ab" * length, "a" * (3 * length), text(2), "a" * length, "a" * (length - 1)]
    for _ in range(40):
        out.append(text(rng.randint(0, length)) + " " + rng.choice(shared) + " " + text(rng.randint(0, length)))
    base = text(3 * length).split(" ")
    for _ in range(15):  # near copies
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = word()
        out.append(" ".join(w))
    return out + out[20:24] + [out[20]] * 3


@pytest.mark.parametrize("length,kw", [(20, {}), (20, {"group": 3}), (60, {"unit": 8, "shard": 4, "piece": 7}), (33, {"gram": 3, "piece": 33, "shard": 1})])
def test_equals_plain_counting(spark, length, kw):
    texts = corpus(length, length)
    df = spark.createDataFrame([(i if i % 9 else None, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, spans int").repartition(5)
    got = S.dedup(df, length=length, **kw).collect()
    want = plain(texts, length)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(
        (str(i if i % 9 else None), *w) for i, w in enumerate(want))


def test_hot_core_split_by_adaptive_execution(spark):
    """Skewed joins are split from the first bytes on; all pieces of a core still meet."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    text = lambda n: " ".join(word() for _ in range(n))
    hot, planted = text(40), [text(12) for _ in range(40)]
    texts = [f"{text(4)} {hot[rng.randrange(8):]} {text(4)}" for _ in range(400)] + [f"{text(9)} {p} {text(9)}" for p in planted * 2] + [text(30) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = S.dedup(df, length=60).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == [(i, *w) for i, w in enumerate(plain(texts, 60))]


def test_segments_and_empty(spark, monkeypatch):
    monkeypatch.setattr(S, "SEGMENT", 50)
    a = S.Anchors(20, 3)
    text = corpus(1, 20)[30].encode() * 3
    lo = [x for _, l, h, _ in a(text) for l, h in zip(l.tolist(), h.tolist()) for x in range(l, h + 1)]
    assert lo == list(range(len(text) - 19))
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.dedup(df).count() == 0 and S.without_repeats(df).count() == 0


def test_without_repeats_keeps_columns(spark):
    texts = corpus(5, 20)
    df = spark.createDataFrame([(i, t, "s", 7) for i, t in enumerate(texts)], "doc_id long, text string, t string, digest int")
    got = S.without_repeats(df, length=20)
    assert got.columns == df.columns
    kept = {r.doc_id: r.text for r in got.collect()}
    assert kept[0] is None
    for i, (t, (_, n, _, sha)) in enumerate(zip(texts, plain(texts, 20))):
        if not n:
            assert kept[i] == t


def test_query_equals_plain_counting(spark):
    from tollgate.llm.suffix_dedup_query import op1_suffix_dedup

    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = op1_suffix_dedup(spark, sf).collect()
    assert sorted(map(tuple, got)) == sorted((i, *w) for (i, _), w in zip(docs, plain([t for _, t in docs], 400)))
