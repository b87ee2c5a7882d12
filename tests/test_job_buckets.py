"""The validation job keeps a state row a bucket of senders, not one a sender."""

from pyspark.sql import functions as F

from tollgate.schema import TRANSFER
from tollgate.session import work_dir
from tollgate.streaming import job as J

SENDERS, BUCKETS = 600, 256


def test_both_halves_keep_state_of_buckets(spark):
    src, ledger, errors, accepted, late, ck1, ck2 = (work_dir(spark, f"job-buckets-{n}") for n in ("src", "ledger", "errors", "accepted", "late", "ck1", "ck2"))
    # Of a sender's three requests the second comes within the cooldown.
    rows = [(f"{s}-{k}", f"s{s}", "t", "coro", "easy", 1.0, 1_000 + at) for k, at in enumerate((0, 4_000, 9_000)) for s in range(SENDERS)]
    spark.createDataFrame(rows, TRANSFER).write.mode("overwrite").parquet(src)
    requests = lambda: spark.readStream.schema(TRANSFER).parquet(src)
    totals = lambda s: s.createDataFrame([("t", None, 5)], "account string, sent int, received int").select("account", *[F.col(c).cast("decimal(38,15)") for c in ("sent", "received")])
    rules = lambda s: s.createDataFrame([("easy", 0.0, 1)], "pool_type string, min_balance double, seq long")
    once = {"availableNow": True}
    J.validate(requests(), rules, totals, ledger, errors, ck1, cooldown_ms=5_000, trigger=once).awaitTermination()
    ids = lambda s: s.createDataFrame([(f"{s}-0",) for s in range(SENDERS)], "id string")
    J.check_in_sync(requests(), ids, accepted, late, ck2, trigger=once).awaitTermination()

    def requests_of(path):
        return sorted(r.id for r in spark.read.parquet(path).select(F.get_json_object("value", "$.id").alias("id")).collect())

    assert requests_of(ledger) == sorted(r[0] for r in rows if not r[0].endswith("-1"))
    assert spark.read.parquet(errors).count() == SENDERS
    assert requests_of(accepted) == sorted(r[0] for r in rows if not r[0].endswith("-2"))
    assert spark.read.parquet(late).count() == SENDERS
    for ck in (ck1, ck2):
        assert 0 < spark.read.format("statestore").load(ck).select("key.*").distinct().count() <= BUCKETS
