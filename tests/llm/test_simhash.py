"""Fingerprints against a plain version, BK-tree links against all pairs."""

import numpy as np
import pytest
import xxhash

from tollgate.llm import simhash as S


def plain_fingerprint(text, k=3):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    sh = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(ids, fps, radius=2):
    comp = list(range(len(fps)))

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= radius:
                comp[find(a)] = find(b)
    best = {}
    for i, d in enumerate(ids):
        r = find(i)
        if d is not None:
            best[r] = min(best.get(r, d), d)
    return [best.get(find(i)) for i in range(len(ids))]


@pytest.mark.parametrize("tree", [4096, 7])
def test_links_equal_all_pairs(spark, tree):
    rng = np.random.default_rng(5)
    base = [int(x) for x in rng.integers(0, 2**63, 40)]
    fps = set(base)
    hot = base[0]
    for b in base[:10] + [hot] * 150:
        x = b
        for bit in rng.integers(0, 64, rng.integers(1, 6)):
            x ^= 1 << int(bit)
        fps.add(x)
    fps = sorted(fps)
    signed = [int(np.uint64(x).astype(np.int64)) for x in fps]
    df = spark.createDataFrame([(x, i) for i, x in enumerate(signed)], "fp long, least long")
    got = {r.fp: r.least for r in S.group_fingerprints(df, 2, tree).collect()}
    want = plain_components(list(range(len(fps))), fps)
    assert got == dict(zip(signed, want))


def test_documents_with_odd_cases(spark):
    rows = [(1, "A b c d e f g"), (2, "a b c d e f g"), (3, None), (4, ""), (5, " \t\n"), (6, "one"), (7, "ONE"),
            (None, "a b c d e f g"), (8, "xé yü   z w"), (8, "xé yü   z w"), (9, "w " * 70000)]
    df = spark.createDataFrame([(a, b, "x") for a, b in rows], "doc_id long, text string, fingerprint string")
    got = sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in S.near_duplicates(df).collect())
    fps = [plain_fingerprint(t) for _, t in rows]
    comp = plain_components([a for a, _ in rows], fps)
    assert got == sorted((str(a), f"{f:016x}", c) for (a, _), f, c in zip(rows, fps, comp))
    kept = S.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 6, 8, 9]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.near_duplicates(df).count() == 0
    assert S.keep_one(df).count() == 0


def test_query_equals_brute_force(spark):
    from tollgate.llm.simhash_query import op10_simhash

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    fps = [plain_fingerprint(r.text) for r in docs]
    comp = plain_components([r.doc_id for r in docs], fps)
    want = sorted((r.doc_id, f"{f:016x}", c) for r, f, c in zip(docs, fps, comp))
    got = op10_simhash(spark, sf)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, got.collect())) == want
