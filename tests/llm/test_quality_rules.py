"""The ledger's policies and ablations against plain counts; op5's and op6's SQL."""

import pytest

from tollgate.llm import quality_rules as Q
from tollgate.tools.compare import compare

ROWS = [(1, None), (2, ""), (None, "a b c"), (3, "a b c"), (3, "a b c"), (4, "x y z " * 40), (5, " ".join(f"word{i}" for i in range(60))),
        (6, " ".join(f"w{i} #" for i in range(60))), (7, "\n".join(["same line"] * 40)), (8, " ".join(f"WORD{'ABCDEFGHIJ'[i % 10]}{i}" for i in range(60)))]


@pytest.mark.parametrize("policy", list(Q.POLICIES))
def test_policies_and_ablations(spark, policy):
    docs = spark.createDataFrame([(a, b, 0) for a, b in ROWS], "doc_id long, text string, n_words int")
    led = Q.ledger(docs)
    bits = [r.failed_bits for r in led.collect()]
    assert len(bits) == len(ROWS)
    names = Q.POLICIES[policy]
    failed = [{n for n in names if b >> Q.BIT[n] & 1} for b in bits]
    kept = sum(not f for f in failed)
    want = {(n, sum(n in f for f in failed), sum(f == {n} for f in failed), len(ROWS), kept) for n in names}
    assert {tuple(r) for r in Q.ablations(led, policy).collect()} == want
    base = {n for n in Q.POLICIES["base"]}
    assert sum(r.kept for r in Q.apply_policy(led, policy).collect()) == sum(not any(b >> Q.BIT[n] & 1 for n in base | set(names)) for b in bits)


def test_sql_of_op5_and_op6(spark):
    res = compare(spark, "/root/testdata/sf0.001", ["op5_quality_rules", "op6_decontaminate"], verbose=False)
    assert len(res) == 2 and all(v.get("ok") for v in res.values()), res
