"""Registered streaming queries. Each stages transfers derived from the
driver's ``events`` table as files (one file per day), runs the streaming
job to completion (``availableNow``, four day files per micro-batch) and returns
what the job wrote."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.functions.columns import transfer_json
from tollgate.session import work_dir
from tollgate.staging.change_events import change_events, with_faults
from tollgate.sources import events as EV
from tollgate.sources.messages import parse_transfers, quarantine, transfer_messages
from tollgate.schema import DEFAULT_RULES
from tollgate.sinks.ledger_segments import LedgerSegments
from tollgate.sinks.messages import ledger_records
from tollgate.sources.rules import read_rules, rules_table
from tollgate.streaming import driver as D
from tollgate.streaming import change_state as C
from tollgate.streaming import enrich as E
from tollgate.streaming import in_order as I
from tollgate.streaming import job as J
from tollgate.streaming import passthrough as P
from tollgate.streaming import rule_updates as U
from tollgate.streaming.stateful import last_request_with_state, throttle_with_state

COOLDOWN_MS = 6 * 3_600_000


def _stage_days(df: DataFrame, path: str) -> None:
    """Write rows as JSON-lines text, one file per day of ``timestamp``.

    The file source hands files to micro-batches in modification-time order,
    and parallel writers finish in any order; so the day files get their
    modification times set in day order, as files arriving day by day would
    have them (otherwise a later day could come first, and its senders'
    earlier requests would be late)."""
    day = F.to_date(F.timestamp_millis("timestamp")).cast("string")
    body = df.select(transfer_json().alias("value"), day.alias("day"))
    body.repartition("day").write.mode("overwrite").partitionBy("day").text(path)
    _order_by_name(df.sparkSession, path)


def _order_by_name(spark: SparkSession, path: str) -> int:
    """Modification times in the order of the files' names; how many files there are."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    it = fs.listFiles(root, True)
    files = []
    while it.hasNext():
        st = it.next()
        name = st.getPath().getName()
        if not name.startswith(("_", ".")):
            files.append((st.getPath().toString(), st.getPath()))
    t0 = 1_000_000_000_000
    for i, (_, p) in enumerate(sorted(files, key=lambda f: f[0])):
        fs.setTimes(p, t0 + i * 1000, -1)
    return len(files)


def _request_stream(spark: SparkSession, d: str, requests: DataFrame | None = None) -> DataFrame:
    src = work_dir(spark, "stream-requests")
    _stage_days(EV.transfers(spark, d) if requests is None else requests, src)
    s = spark.readStream.schema("value string, day string").option("maxFilesPerTrigger", 4).text(src)
    # the text source gives ``value``: parse it like a message value; what is
    # staged here has no malformed lines
    return quarantine(parse_transfers(s))[0]


@contextmanager
def rocksdb_state(spark: SparkSession):
    """The session with the RocksDB state store, for queries started within."""
    name = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(name, None)
    spark.conf.set(name, I.ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(name, old) if old is not None else spark.conf.unset(name)


def _until_done(*queries) -> None:
    """Wait for queries to end; a failure is raised at once."""
    for q in queries:
        q.awaitTermination()


def _to_parquet(stream: DataFrame, out: str, ck: str):
    return (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
            .outputMode("append").trigger(availableNow=True).start())


def q_ledger_ingest(spark: SparkSession, d: str) -> DataFrame:
    src, sink, ck = work_dir(spark, "topic-twin"), work_dir(spark, "ledger"), work_dir(spark, "ingest-ckpt")
    transfer_messages(EV.transfers(spark, d)).write.mode("overwrite").json(src)
    _until_done(*D.ledger_ingest(spark, src, sink, ck, fmt="json", trigger={"availableNow": True}))
    return spark.read.parquet(sink)


def q_ledger_ingest_quarantine(spark: SparkSession, d: str) -> DataFrame:
    """Some messages are malformed: what the ledger has, and what is set apart."""
    from tollgate.plans.catalog import _with_malformed

    src, sink, ck, bad = (work_dir(spark, n) for n in ("topic-twin", "ledger", "ingest-ckpt", "ingest-bad"))
    _with_malformed(transfer_messages(EV.transfers(spark, d))).write.mode("overwrite").json(src)
    _until_done(*D.ledger_ingest(spark, src, sink, ck, fmt="json", trigger={"availableNow": True}, quarantine=bad))
    return spark.read.parquet(sink).select("id", F.lit(None).cast("string").alias("malformed")).unionByName(
        spark.read.schema("value string").parquet(bad).select(F.lit(None).cast("string").alias("id"), F.col("value").alias("malformed")))


def q_ledger_segments_stream(spark: SparkSession, d: str) -> DataFrame:
    """Messages, some of them malformed, into day partitions whose segments close
    at 100 rows; the ledger with its days, and what is set apart."""
    from tollgate.plans.catalog import _with_malformed

    src, place, ck, bad = (work_dir(spark, f"segments-{n}") for n in ("topic", "ledger", "ckpt", "bad"))
    _stage_in_order(spark, _with_malformed(transfer_messages(EV.transfers(spark, d))), "offset", src, 6)
    table = LedgerSegments(spark, "ledger_segments_" + place[-12:], place, flush_rows=100)
    _until_done(D.ledger_ingest_segments(spark, src, table, bad, ck, fmt="parquet", trigger={"availableNow": True}, max_per_trigger=2))
    apart = spark.read.schema("value string").parquet(bad).select(F.col("value").alias("malformed"))
    return table.read().unionByName(apart, allowMissingColumns=True)


def _message_stream(spark: SparkSession, path: str) -> DataFrame:
    """Requests of a topic's twin, as a stream."""
    return quarantine(parse_transfers(spark.readStream.schema("key string, value string, topic string").parquet(f"{path}/*")))[0]


def q_throttle_stream(spark: SparkSession, d: str) -> DataFrame:
    """The throttle over a topic's twin. State does not expire here: Spark runs
    batches for wall-clock timeouts for ever, so such a query never ends."""
    topic, out, ck = (work_dir(spark, n) for n in ("throttle-topic", "throttle-out", "throttle-ckpt"))
    requests = _request_stream(spark, d)
    records = requests.select(F.col("from_id").alias("key"), transfer_json().alias("value"), F.lit("requests").alias("topic"))
    _until_done(_to_parquet(records, f"{topic}/batch_id=0", work_dir(spark, "topic-ckpt")))
    _until_done(_to_parquet(throttle_with_state(_message_stream(spark, topic), COOLDOWN_MS), out, ck))
    return spark.read.parquet(out).select("id", "from_id", "timestamp", "allowed")


def q_last_request_stream(spark: SparkSession, d: str) -> DataFrame:
    """Previous requests, from a topic's twin that holds one day a file."""
    topic, out, ck = (work_dir(spark, n) for n in ("last-topic", "last-out", "last-ckpt"))
    _until_done(_to_parquet(_request_stream(spark, d).select(F.col("from_id").alias("key"), transfer_json().alias("value"), F.lit("requests").alias("topic")), f"{topic}/batch_id=0", work_dir(spark, "topic-ckpt")))
    _until_done(_to_parquet(last_request_with_state(_message_stream(spark, topic)), out, ck))
    return spark.read.parquet(out).select("id", "from_id", "last_id")


def _errors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("key string, value string, topic string").parquet(path).select("key", "value", "topic")


def _run_job(spark: SparkSession, d: str, rules=rules_table) -> dict[str, str]:
    """The whole job over files: the ledger side first, which then stands still,
    then the requests. Returns the folders of the topics' twins."""
    at = {n: work_dir(spark, f"job-{n}") for n in ("base", "totals", "ledger", "errors", "accepted", "late", "ck1", "ck2")}
    once = {"availableNow": True}
    ledger_records(EV.ledger(spark, d)).write.mode("overwrite").parquet(f"{at['base']}/batch_id=0")
    _until_done(J.keep_totals(_message_stream(spark, at["base"]), at["totals"], once))
    _until_done(J.validate(
        _request_stream(spark, d, EV.requests(spark, d)), rules, lambda s: J.read_totals(s, at["totals"]),
        at["ledger"], at["errors"], at["ck1"], cooldown_ms=COOLDOWN_MS, trigger=once))
    ids = lambda s: EV.ledger(s, d).select("id")
    _until_done(J.check_in_sync(_message_stream(spark, at["ledger"]), ids, at["accepted"], at["late"], at["ck2"], trigger=once))
    return at


def q_transfer_pipeline_stream(spark: SparkSession, d: str) -> DataFrame:
    """Every message that the job wrote to its topics."""
    at = _run_job(spark, d)
    out = _errors(spark, at["accepted"])
    for name in ("ledger", "errors", "late"):
        out = out.unionByName(_errors(spark, at[name]))
    return out


def q_rules_latest_stream(spark: SparkSession, d: str) -> DataFrame:
    """The rules change while the stream runs: from the third micro-batch on no
    pool lets anything through. The ledger topic's messages."""
    src = work_dir(spark, "rules-requests")
    _stage_days(EV.requests(spark, d), src)
    stream = spark.readStream.schema("value string, day string").option("maxFilesPerTrigger", 4).text(src)
    requests = quarantine(parse_transfers(stream))[0]
    stored, ledger, errors, ck = (work_dir(spark, f"rules-{n}") for n in ("stored", "ledger", "errors", "ck"))
    rules_table(spark).write.parquet(f"{stored}/write=0")
    calls = []

    def rules(s: SparkSession) -> DataFrame:
        calls.append(1)
        if len(calls) == 3:
            rules_table(s, [(p, 1e12) for p, _ in DEFAULT_RULES]).selectExpr("pool_type", "min_balance", "seq + 100 as seq").write.parquet(f"{stored}/write=1")
        return read_rules(s, stored)

    none = spark.createDataFrame([], "account string, sent decimal(28,15), received decimal(28,15)")
    _until_done(J.validate(requests, rules, lambda s: none, ledger, errors, ck, cooldown_ms=COOLDOWN_MS, trigger={"availableNow": True}))
    return _errors(spark, ledger)


def q_throttle_stateful_stream(spark: SparkSession, d: str) -> DataFrame:
    out, ck = work_dir(spark, "stateful-out"), work_dir(spark, "stateful-ckpt")
    s = throttle_with_state(_request_stream(spark, d), COOLDOWN_MS)
    _until_done(_to_parquet(s, out, ck))
    return spark.read.parquet(out).select("id", "from_id", "timestamp", "allowed")


def q_last_request_stateful_stream(spark: SparkSession, d: str) -> DataFrame:
    out, ck = work_dir(spark, "stateful-last-out"), work_dir(spark, "stateful-last-ckpt")
    s = last_request_with_state(_request_stream(spark, d))
    _until_done(_to_parquet(s, out, ck))
    return spark.read.parquet(out).select("id", "from_id", "last_id")


def _stage_in_order(spark: SparkSession, df: DataFrame, by: str, path: str, parts: int) -> None:
    """Rows as Parquet files by ranges of ``by``; the file source takes them in that order."""
    df.repartitionByRange(parts, by).write.mode("overwrite").parquet(path)
    _order_by_name(spark, path)


#: How far a request may come after its time in the queries below.
LATENESS_MS = 2 * 86_400_000


def _late_requests(spark: SparkSession, d: str) -> DataFrame:
    """All transfers as a stream in which each comes up to two days after its
    time (by a hash of its id), two files a micro-batch, and a clock tick last."""
    t, src = EV.transfers(spark, d), work_dir(spark, "late-requests")
    end = t.agg(F.max("timestamp").alias("m")).select((F.col("m") + 3 * LATENESS_MS + 40 * 86_400_000).alias("timestamp"))
    tick = end.select(*[F.lit(None).cast(f.dataType).alias(f.name) if f.name not in ("timestamp", "from_id") else (F.col("timestamp") if f.name == "timestamp" else F.lit("").alias("from_id")) for f in t.schema])
    arrival = F.col("timestamp") + F.pmod(F.xxhash64("id"), F.lit(LATENESS_MS))
    _stage_in_order(spark, t.unionByName(tick).withColumn("arrival", F.when(F.col("id").isNull(), F.col("timestamp")).otherwise(arrival)), "arrival", src, 12)
    return spark.readStream.schema(t.schema).option("maxFilesPerTrigger", 2).parquet(src)


def q_throttle_in_order_stream(spark: SparkSession, d: str) -> DataFrame:
    """The throttle in order of event time over late requests; state ends by timers."""
    out, ck = work_dir(spark, "in-order-out"), work_dir(spark, "in-order-ckpt")
    with rocksdb_state(spark):
        _until_done(_to_parquet(I.throttle_in_order(_late_requests(spark, d), COOLDOWN_MS, delay=f"{LATENESS_MS} milliseconds"), out, ck))
    return spark.read.parquet(out).select("id", "from_id", "timestamp", "allowed")


def q_last_request_in_order_stream(spark: SparkSession, d: str) -> DataFrame:
    """Previous requests in order of event time over late requests."""
    out, ck = work_dir(spark, "in-order-last-out"), work_dir(spark, "in-order-last-ckpt")
    with rocksdb_state(spark):
        _until_done(_to_parquet(I.last_request_in_order(_late_requests(spark, d), delay=f"{LATENESS_MS} milliseconds"), out, ck))
    return spark.read.parquet(out).select("id", "from_id", "last_id")


def q_once_each_stream(spark: SparkSession, d: str) -> DataFrame:
    """A stream in which every third request comes again, up to two days later."""
    src, out, ck = (work_dir(spark, f"repeats-{n}") for n in ("src", "out", "ck"))
    t = EV.transfers(spark, d)
    again = t.filter(F.pmod(F.xxhash64("id"), F.lit(3)) == 0).withColumn("arrival", F.col("timestamp") + F.pmod(F.xxhash64("id"), F.lit(LATENESS_MS)))
    _stage_in_order(spark, t.withColumn("arrival", F.col("timestamp")).unionByName(again), "arrival", src, 12)
    stream = spark.readStream.schema(t.schema).option("maxFilesPerTrigger", 2).parquet(src)
    _until_done(_to_parquet(D.once_each(stream, delay=f"{LATENESS_MS} milliseconds"), out, ck))
    return spark.read.schema(t.schema).parquet(out)


def q_rule_passthrough_stream(spark: SparkSession, d: str) -> DataFrame:
    """Rules pass through and are counted: (micro-batch, rules), from the
    metrics that a listener sees. Rule updates of a day are a file, four a
    micro-batch."""
    src, out, ck = (work_dir(spark, f"passthrough-{n}") for n in ("src", "out", "ck"))
    updates = rule_updates(EV.requests(spark, d)).withColumn("day", F.floor(F.col("arrival") / 86_400_000))
    updates.repartition("day").write.mode("overwrite").partitionBy("day").parquet(src)  # a row a pool type and day
    _order_by_name(spark, src)
    stream = spark.readStream.schema("pool_type string, arrival long, min_balance double, day long").option("maxFilesPerTrigger", 4).parquet(src)
    counts = P.RuleCounts()
    spark.streams.addListener(counts)
    try:
        q = _to_parquet(P.counted(stream), out, ck)
        _until_done(q)
        return spark.createDataFrame(counts.of(q), "batch_id long, n_rules long")
    finally:
        spark.streams.removeListener(counts)


LOOKUP_TIMEOUT_MS = 12 * 3_600_000


def q_enrich_ordered_stream(spark: SparkSession, d: str) -> DataFrame:
    """Requests enriched, in order, by their ledger rows, which come up to a day
    after them (by their id); those beyond twelve hours are too late."""
    src, state, out, ck, table = (work_dir(spark, f"enrich-{n}") for n in ("src", "state", "out", "ck", "table"))
    requests = EV.requests(spark, d)
    delay = F.col("id").cast("long") % 24 * 3_600_000
    asked = requests.select(F.lit("request").alias("kind"), F.col("timestamp").alias("arrival"), "id", F.lit(None).cast("double").alias("value"))
    rows = requests.select(F.lit("lookup").alias("kind"), (F.col("timestamp") + delay).alias("arrival"), "id", F.col("amount").alias("value"))
    end = requests.agg((F.max("timestamp") + 2 * LATENESS_MS).alias("arrival")).select(
        F.lit("tick").alias("kind"), "arrival", F.lit(None).cast("string").alias("id"), F.lit(None).cast("double").alias("value"))
    both = asked.unionByName(rows).unionByName(end)
    _stage_in_order(spark, both, "arrival", src, 9)
    stream = spark.readStream.schema(both.schema).option("maxFilesPerTrigger", 3).parquet(src)
    _until_done(E.enrich_in_order(stream, E.lookup_table(spark, table), state, out, ck, LOOKUP_TIMEOUT_MS, trigger={"availableNow": True}))
    return spark.read.parquet(out).select("position", "id", "value", "outcome")


def rule_updates(requests: DataFrame) -> DataFrame:
    """Rule updates made from requests: at noon of each day, each pool type's
    least amount of that day becomes its minimum balance."""
    day = F.floor(F.col("timestamp") / 86_400_000).cast("long")
    least = requests.groupBy(day.alias("day"), "pool_type").agg(F.min("amount").alias("min_balance"))
    return least.select("pool_type", (F.col("day") * 86_400_000 + 43_200_000).alias("arrival"), "min_balance")


def q_rule_updates_stream(spark: SparkSession, d: str) -> DataFrame:
    """Rules and requests on one stream by arrival: a rule holds from the next
    request on, within a micro-batch too."""
    from tollgate.operators.ledger import balance_per_request

    src, out, stored, ck = (work_dir(spark, f"rule-updates-{n}") for n in ("src", "out", "state", "ck"))
    requests, ledger = EV.requests(spark, d), EV.ledger(spark, d)
    both = requests.withColumns({"arrival": F.col("timestamp"), "min_balance": F.lit(None).cast("double")}).unionByName(rule_updates(requests), allowMissingColumns=True)
    schema = both.schema
    _stage_in_order(spark, both, "arrival", src, 9)
    state = U.rule_state(spark, stored)
    state.merge(rules_table(spark).select("pool_type", F.lit(-1).cast("long").alias("arrival"), "min_balance"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 3).parquet(src)
    _until_done(U.enforce_rules(stream, state, out, ck, lambda r: balance_per_request(r, ledger), trigger={"availableNow": True}))
    return spark.read.parquet(out).select("id", "pool_type", "balance", "min_balance", "error")


def _fold_changes(spark: SparkSession, d: str):
    """Change events, with faulty ones, in any order over the micro-batches."""
    src, stored, bad, ck = (work_dir(spark, f"changes-{n}") for n in ("src", "state", "bad", "ck"))
    # Spread by size before events are made of the rows, so that tasks and files
    # grow in number and not in size; each micro-batch takes a third of them.
    t = EV.transfers(spark, d).hint("rebalance", "id")
    events = with_faults(change_events(t), t).withColumn("turn", F.pmod(F.xxhash64("value"), F.lit(3)).cast("int"))
    events.write.mode("overwrite").partitionBy("turn").parquet(src)
    files = _order_by_name(spark, src)
    state = C.change_state(spark, stored, buckets=8)
    stream = spark.readStream.schema("value string, turn int").option("maxFilesPerTrigger", max(1, -(-files // 3))).parquet(src).select("value")
    _until_done(C.keep_current_state(stream, state, bad, ck, trigger={"availableNow": True}))
    return state, bad


def q_cdc_state_stream(spark: SparkSession, d: str) -> DataFrame:
    return C.read_current_state(_fold_changes(spark, d)[0])


def q_cdc_malformed_stream(spark: SparkSession, d: str) -> DataFrame:
    """What the fold set apart."""
    return spark.read.parquet(_fold_changes(spark, d)[1]).select(F.col("_corrupt").alias("malformed"))
