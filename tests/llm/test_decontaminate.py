"""The index search against plain windows over word lists."""

import hashlib
import re

import pytest

from tollgate.llm import decontaminate as D


def words(t):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain(docs, items, size):
    out = []
    for doc_id, t in docs:
        w, hit, names = words(t), set(), set()
        for item_id, it in items:
            x = words(it)
            for i in range(max(1, len(x) - size + 1)) if x else ():
                win = x[i:i + size]
                for p in range(len(w) - len(win) + 1):
                    if w[p:p + len(win)] == win:
                        hit |= set(range(p, p + len(win)))
                        names.add(item_id)
        ids = sorted(str(x) for x in names if x is not None)
        out.append((doc_id, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


ITEMS = [(1, "a b c d e f"), (2, "C d, e; F"), (10, "only"), (3, None), (4, ""), (5, "éa ü b"), (5, "éa ü b"), (None, "q r s t"), (6, "a a a a a")]
DOCS = [(1, "x a B c-d e f y"), (2, "a b c"), (3, None), (4, "..."), (5, "zz only zz only"), (6, "ÉA ü b éa Ü b éa ü b"), (6, "ÉA ü b éa Ü b éa ü b"),
        (None, "q r s t"), (7, "d e f"), (8, "a " * 30000), (9, "q r s"), (11, "t")]


@pytest.mark.parametrize("chunk", [1 << 20, 10])
def test_equals_plain_windows(spark, chunk):
    docs = spark.createDataFrame([(a, b, 1) for a, b in DOCS], "doc_id long, text string, items int")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = D.digest(D.matches(docs, items, size=4, chunk_bytes=chunk))
    assert sorted(map(tuple, got.collect()), key=str) == plain(DOCS, ITEMS, 4)


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "a x b c"), (2, "b a c"), (3, "a y y y b c"), (4, "c b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    near = {r.doc_id for r in D.matches(docs, items, size=3, slop=1).filter("n_hit > 0").collect()}
    assert near == {1, 2}


def test_clean_documents_and_empty(spark):
    docs = spark.createDataFrame([(a, b, 1) for a, b in DOCS], "doc_id long, text string, _bad int")
    items = spark.createDataFrame(ITEMS[:2], "item_id long, text string")
    kept = D.clean_documents(docs.drop("_bad"), items)
    assert kept.columns == ["doc_id", "text"]
    assert 1 not in {r.doc_id for r in kept.collect()} and kept.count() == len(DOCS) - 1
    assert D.matches(docs.limit(0), items).count() == 0
    assert D.matches(docs, items.limit(0)).filter("n_hit > 0").count() == 0


@pytest.mark.parametrize("chunk", [1 << 20, 10])
def test_clean_rows_stay_whatever_ids_they_share(spark, chunk):
    rows = [(None, "x a b c d y", 1), (None, "clean", 2), (None, None, 3), (7, "a b c d", 4), (7, "a b c", 5), (7, "a b c", 6), (8, "zz", 7), (8, "B c D, e", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row int")
    items = spark.createDataFrame([(1, "a b c d e"), (2, "q r s t u")], "item_id long, text string")
    kept = D.clean_documents(docs, items, size=4, chunk_bytes=chunk)
    assert kept.columns == docs.columns
    assert sorted(r["_row"] for r in kept.collect()) == [2, 3, 5, 6, 7]


def test_shared_windows_and_long_texts(spark):
    """Many items of one window; one of another; a text of over a million characters."""
    items = [(i, "w x y z") for i in range(500)] + [(None, "w x y z"), (900, "k l m n"), (901, "w x y z k l")]
    long = "p q r " * 200_000
    docs = [(1, "a w x y z b"), (2, "k l m n"), (3, "w x y z k l"), (4, long + "K L m, N"), (5, long), (6, "x" * 1_000_000)]
    got = D.digest(D.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), size=4))
    named = {1: list(range(500)) + [901], 2: [900], 3: list(range(500)) + [901], 4: [900], 5: [], 6: []}
    hits = {1: 4, 2: 4, 3: 6, 4: 4, 5: 0, 6: 0}
    for r in got.collect():
        ids = sorted(map(str, named[r.doc_id]))
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == (len(words(dict(docs)[r.doc_id])), hits[r.doc_id], len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest())
