"""Rows that a later micro-batch adds to an open segment are found at once."""

import uuid

from tollgate.session import work_dir
from tollgate.sinks.ledger_segments import LedgerSegments
from tollgate.streaming import driver as D
from tollgate.streaming.queries import _order_by_name


def test_open_segment_after_several_micro_batches(spark):
    src, place, bad, ck = (work_dir(spark, f"t-reread-{n}") for n in ("src", "place", "bad", "ck"))
    for b in range(3):
        rows = [("k", f'{{"id":"{i}","fromId":"a","toId":"b","poolId":"p","poolType":"easy","amount":1.0,"timestamp":{1000 + i}}}', "t", 0, i, None) for i in range(b * 10, b * 10 + 10)]
        spark.createDataFrame(rows, "key string, value string, topic string, partition int, offset long, timestamp timestamp").coalesce(1).write.parquet(f"{src}/b{b}")
    _order_by_name(spark, src)
    table = LedgerSegments(spark, f"t_reread_{uuid.uuid4().hex[:8]}", place, flush_rows=1000)
    D.ledger_ingest_segments(spark, src, table, bad, ck, fmt="parquet", options={"recursiveFileLookup": "true"}, trigger={"availableNow": True}, max_per_trigger=1).awaitTermination()
    assert sorted(int(r.id) for r in table.read().collect()) == list(range(30))
    spark.sql(f"DROP TABLE {table.name}")
