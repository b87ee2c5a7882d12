"""The hash tree against a plain version; movement under changed weights; slots; op12's SQL."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tollgate.llm import sharding as S
from tollgate.tools.compare import compare

TREES = [S.Tree.uniform(2, 2, 3), S.Tree((((1.0, 2.0), (0.5,)), ((3.0, 0.0, 1.0),))), S.Tree((((0.0,), (0.0, 0.0)), ((1.0,),)))]


def plain(tree, key):
    total = lambda x: x if isinstance(x, (int, float)) else sum(map(total, x))
    node, path = tree.regions, []
    while not isinstance(node, (int, float)):
        draws = []
        for i, c in enumerate(node):
            if total(c) > 0:
                h = hashlib.md5(f"{key}|{'/'.join(map(str, path))}/{i}".encode()).hexdigest()
                draws.append((-math.log((int(h[:13], 16) + 0.5) / 16 ** 13) / total(c), i))
        path.append(min(draws)[1])
        node = node[path[-1]]
    leaves = [(i, j, k) for i, r in enumerate(tree.regions) for j, a in enumerate(r) for k in range(len(a))]
    return leaves.index(tuple(path))


def placed(spark, tree, n=3000):
    return {r.id: r.s for r in S.place(spark.range(n), tree, F.col("id"), "s").collect()}


@pytest.mark.parametrize("tree", TREES)
def test_equals_plain_descent(spark, tree):
    assert placed(spark, tree, 400) == {i: plain(tree, i) for i in range(400)}


def test_shares_follow_weights(spark):
    n = Counter(placed(spark, TREES[1], 6000).values())
    want = {0: 1, 1: 2, 2: 0.5, 3: 3, 5: 1}
    assert set(n) == set(want)
    for k, w in want.items():
        assert abs(n[k] - 6000 * w / 7.5) < 5 * math.sqrt(6000 * w / 7.5)


def test_movement_stays_in_changed_subtrees(spark):
    tree = S.Tree.uniform(3, 2, 2)
    before = placed(spark, tree)
    new = placed(spark, tree.with_region([[1.0]]))
    moved = [k for k in before if before[k] != new[k]]
    assert moved and {new[k] for k in moved} == {12}
    assert abs(len(moved) - 3000 / 13) < 5 * math.sqrt(3000 / 13)
    # A shard's weight rises in region 0, rack 1 (shards 2 and 3).
    heavier = placed(spark, S.Tree((((1.0, 1.0), (1.0, 3.0)), *tree.regions[1:])))
    for k, s in before.items():
        if heavier[k] != s:
            assert heavier[k] in range(4)  # into region 0 only, or inside it
            if s in range(4):
                assert heavier[k] in (2, 3)  # inside region 0 only into the rack
                if s in (2, 3):
                    assert heavier[k] == 3  # inside the rack only into the shard


def test_odd_rows_and_slots(spark):
    rows = [(None, "a")] * 300 + [(None, None)] * 3 + [(7, "dupe")] * 50 + [(i, "é" * (i % 5)) for i in range(200)] + [(5, ""), (6, "x" * 200_000)]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, shard int, _tie string").repartition(7)
    tree = S.Tree.uniform(2, 2, 2)
    got = S.shard_documents(df, tree, tree.with_region([[1.0]])).collect()
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == sorted(
        (str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    slots = defaultdict(list)
    for r in got:
        assert r.shard == plain(tree, "null:" if r.doc_id is None else r.doc_id) and r.law == "key"
        assert r.grown_shard in (r.shard, 8)
        slots[r.shard].append((r.slot, (r.doc_id is not None, r.doc_id or 0, r.size, r.text_crc32)))
    for v in slots.values():
        v.sort()
        assert [s for s, _ in v] == list(range(len(v)))
        assert [k for _, k in v] == sorted(k for _, k in v)
    assert S.shard_documents(df.limit(0), tree, tree).count() == 0
    total = sum(r.n_rows for r in S.moves(spark.createDataFrame(got)).collect())
    assert total == sum(r.shard != r.grown_shard for r in got)


def test_bad_weights():
    for regions in ((((0.0,),),), (((-1.0, 2.0),),), ()):
        with pytest.raises(ValueError):
            S.Tree(regions)


def test_sql(spark):
    res = compare(spark, "/root/testdata/sf0.001", ["op12_shard_tree"], verbose=False)
    assert res["op12_shard_tree"].get("ok"), res
