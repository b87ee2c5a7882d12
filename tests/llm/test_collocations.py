"""Collocations against plain counting; chunks; op11's SQL."""

import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from tollgate.llm import collocations as C
from tollgate.tools.compare import compare


def plain(docs, top, min_count, cover):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang, text = lang or "und", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    found = {p: a for p, a in f.items() if len(p) > 2 and a >= min_count}
    out = {lang: [] for lang in n}
    for (lang, *w), a in found.items():
        if len(w) == 2 and any(100 * b >= cover * a for (o, *v), b in found.items() if o == lang and len(v) == 3 and w in (v[:2], v[1:])):
            continue
        cuts = [(1000000 * a * a // (f[lang, *w[:k]] * f[lang, *w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out[lang].append((-score, -a, " ".join(w).encode(), f[lang, *w[:k]], f[lang, *w[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for lang, rows in out.items() for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top]))


def corpus(seed, n=120):
    rng = random.Random(seed)
    words = ["a", "B", "the", "New", "york", "cité", "é", "x-1", "\x00z", "of", " "] + [f"w{i}" for i in range(12)]
    weights = [1 / (i + 1) for i in range(len(words))]
    fixed = ["new york city", "of the", "cité é", "B b B b", "zz yy xx", "zz yy xx ww"]
    docs = []
    for _ in range(n):
        parts = [rng.choice(fixed) if rng.random() < 0.25 else rng.choices(words, weights)[0] for _ in range(rng.randint(0, 40))]
        docs.append((rng.choice(["en", "en", "de", None, "und"]), "".join(p + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n"]) for p in parts)))
    return docs + [("en", None), (None, ""), ("fr", " .,\n"), ("fr", "solo")] + docs[:5] * 4


@pytest.mark.parametrize("seed,top,min_count,kw", [
    (1, 2000, 10, {}), (2, 5, 4, {"first": 1, "wider": 2}), (3, 12, 2, {"chunk": 7, "bits": 4, "first": 1}), (4, 1, 3, {"chunk": 1, "cover": 70}), (5, 40, 2, {"bits": 16, "cover": 100})])
def test_equals_plain(spark, seed, top, min_count, kw):
    docs = corpus(seed)
    df = spark.createDataFrame([(*d, 1, b"z") for d in docs], "lang string, text string, n int, w1 binary").repartition(3)
    got = C.collocations(df, top=top, min_count=min_count, **{"cover": 50, **kw})
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = plain(docs, top, min_count, kw.get("cover", 50))
    assert sorted(map(tuple, got.collect())) == want and want


def test_search_stops_before_all_is_grown(spark, monkeypatch):
    """With high bounds settled, prefixes below them are not grown."""
    rng = random.Random(9)
    docs = [("en", f"pair{i} mate{i}. ") for i in range(30) for _ in range(4)]
    docs += [("en", " ".join(rng.choices(["u", "v", "w"], k=30))) for _ in range(20)]
    df = spark.createDataFrame(docs, "lang string, text string")
    steps, grown = [], []
    real = C.count_triples
    monkeypatch.setattr(C, "count_triples", lambda f, grow, done, bits: (steps.append(done is None), grown.append(int(sum(bin(x).count("1") for x in grow[0].tobytes()))), real(f, grow, done, bits))[2])
    got = C.collocations(df, top=10, min_count=3, first=2)
    assert sorted(map(tuple, got.collect())) == plain(docs, 10, 3, 50)
    assert steps == [True] and grown == [30]  # the pairs of u, v and w were never grown


def test_long_texts_span_blocks_and_chunks(spark, monkeypatch):
    text = "".join(f"Alpha beta{i % 3}\tgamma{'. ' if i % 7 == 0 else ' '}" for i in range(300)) + "y" * 500 + " end"
    batch = pa.RecordBatch.from_pydict({"lang": ["en", "en", "de"], "t": [text.encode(), b"x. y", b"x"]})
    whole = list(C.tokenise(1 << 20)(iter([batch])))
    monkeypatch.setattr(C, "BLOCK", 40)

    def counts(chunks, k):
        out = Counter()
        for lang, lead, ids, words in C._chunk_rows(chunks):
            ids = ids.tolist()
            out.update((lang, *(words[i] for i in ids[p:p + k])) for p in range(len(ids) - k + 1) if p + k > lead and 0 not in ids[p:p + k])
        return out

    for size in (1, 2, 50):
        parts = list(C.tokenise(size)(iter([batch])))
        assert len(parts) > len(whole)
        for k in (1, 2, 3):
            assert counts(parts, k) == counts(whole, k)


def test_empty(spark):
    df = spark.createDataFrame([], "lang string, text string")
    assert C.collocations(df).collect() == []
    assert C.collocations(spark.createDataFrame([(None, None), ("en", "a b c")], df.schema)).collect() == []


def test_scores_beyond_64_bits(spark):
    df = spark.createDataFrame([(10 ** 12, 3 * 10 ** 12, 10 ** 12 + 1)], "a long, l long, r long")
    want = 1000000 * 10 ** 24 // (3 * 10 ** 12 * (10 ** 12 + 1))
    assert df.select(C._lowest_cut([("l", "r")]).alias("c")).first().c.score == want


def test_sql(spark):
    res = compare(spark, "/root/testdata/sf0.001", ["op11_collocations"], verbose=False)
    assert res["op11_collocations"].get("ok"), res
