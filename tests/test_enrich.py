"""Ordered enrichment against a plain version, for several cuts into micro-batches."""

import random

import pytest

from tollgate.session import work_dir
from tollgate.streaming import enrich as E
from tollgate.streaming.queries import _order_by_name, _until_done

SCHEMA = "kind string, arrival long, id string, value double, note string"


def feed(seed):
    rnd = random.Random(seed)
    rows = [("request", rnd.randrange(0, 1000, 10), f"i{n:03d}", None, f"n{n}") for n in range(60)]
    for _, at, i, _, _ in rows:
        if rnd.random() < 0.8:  # some before the request, some within the timeout, some after
            rows = [*rows, ("lookup", max(0, at + rnd.randrange(-50, 200)), i, float(rnd.randrange(9)), None)]
    rows += [("lookup", 5, "i000", 99.0, None), ("tick", 5000, None, None, None)]
    return sorted(rows, key=lambda r: (r[1], r[0], str(r[2])))


def plain(rows, timeout):
    looks = {}
    for k, at, i, v, _ in rows:
        if k == "lookup":
            looks[i] = min(looks.get(i, (at, v)), (at, v))
    out = []
    for at, i, note in sorted((at, i, note) for k, at, i, _, note in rows if k == "request"):
        hit = i in looks and looks[i][0] <= at + timeout
        out.append((len(out) + 1, i, note, looks[i][1] if hit else None, "FOUND" if hit else E.LOOKUP_TIMEOUT))
    return out


@pytest.mark.parametrize("files", [1, 7])
def test_order_retries_and_timeouts(spark, files):
    rows, timeout = feed(files), 100
    src, state, out, ck, table = (work_dir(spark, f"enrich-{n}") for n in ("src", "state", "out", "ck", "table"))
    size = -(-len(rows) // files)
    for n in range(files):
        spark.createDataFrame(rows[n * size:(n + 1) * size], SCHEMA).coalesce(1).write.parquet(f"{src}/b{n}")
    _order_by_name(spark, src)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(src)
    _until_done(E.enrich_in_order(stream, E.lookup_table(spark, table, 4), state, out, ck, timeout, trigger={"availableNow": True}))
    got = spark.read.parquet(out)
    assert sorted(tuple(r) for r in got.select("position", "id", "note", "value", "outcome").collect()) == plain(rows, timeout)
    # what went out in an earlier micro-batch arrived earlier
    sent = sorted((r.batch_id, r.position) for r in got.collect())
    assert [p for _, p in sent] == sorted(p for _, p in sent)


def test_waiting_rows_hold_back_later_ones(spark):
    asked = spark.createDataFrame([(10, "a"), (20, "b"), (30, "c")], "arrival long, id string")
    lookups = spark.createDataFrame([("b", 15, 1.0), ("c", 200, 2.0)], E.LOOKUPS)
    got = {r.id: (r.value, r.outcome) for r in E.decide(asked, lookups, now=40, timeout_ms=50).collect()}
    assert got == {"a": (None, None), "b": (1.0, "FOUND"), "c": (None, E.LOOKUP_TIMEOUT)}
    assert {r.id: r.outcome for r in E.decide(asked, lookups, now=61, timeout_ms=50).collect()}["a"] == E.LOOKUP_TIMEOUT
