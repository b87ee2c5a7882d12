"""Per-sender request throttle with a cooldown.

Semantics: per sender, in ``(timestamp, id)`` order, a request is allowed iff
no allowed request of that sender lies less than ``cooldown_ms`` before it
(a gap of exactly the cooldown is allowed). A refused request does not extend
the cooldown. Among requests with equal timestamps the smallest id is the
only candidate.

This is a greedy chain, not a window function. One path, whatever the sizes:

1. One row per distinct ``(sender, timestamp)`` ("point", with its smallest
   id), pre-aggregated, so any number of requests at one time is one point.
2. Points are range-partitioned by (sender, time) and sorted, then written once
   to the shared checkpoint folder with their partition's number. A sender's
   points are a run within a partition; only a partition's first run can go on
   from the one before, so a sender of any size is cut into stretches as large
   as a partition.
3. Each partition folds its first and last runs into a map from the last
   allowed time before the run to the last allowed time in it: a step function,
   kept as one row a step. Only entries within a cooldown of the run's start
   make steps; what comes later finds the run free.
4. Maps are composed, not gathered: the exit of a step leads to one step of a
   later stretch, which an as-of window inside (sender, range) finds
   (:func:`_next_steps`). These links compose with themselves, so that after n
   rounds they span 2^n stretches, and each round doubles the steps known to lie
   on the sender's chain (:func:`_on_chain`). A cooldown over many partitions
   makes as many steps as points, but no row or task with more than a range's.
5. Each partition walks its runs from their entry times, at most one a
   partition. The allowed points are joined back to the requests.

Shuffles do not depend on how long a chain is, but for one more round each time
the stretches of a sender double. Building the plan runs all but the last step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tollgate.operators.chain import allowed_points, edge_stretches
from tollgate.operators.filters import split_flag
from tollgate.schema import DEFAULT_COOLDOWN_MS, TOO_MANY_REQUESTS


def throttle(
    df: DataFrame,
    cooldown_ms: int = DEFAULT_COOLDOWN_MS,
    key: str = "from_id",
    ts: str = "timestamp",
    id_col: str = "id",
    out_col: str = "allowed",
    seeds: DataFrame | None = None,
) -> DataFrame:
    """Attach boolean ``allowed`` to every request.

    ``seeds`` (columns ``key`` and ``ts``): last allowed time per sender from
    earlier micro-batches; it acts as an allowed request that sorts first at
    its time, so requests at or before it within the cooldown are refused.
    """
    c = int(cooldown_ms)
    if c <= 0:
        return df.withColumn(out_col, F.lit(True))

    teff = ts
    if seeds is not None:
        # one seed per sender; a request older than its seed counts as at the
        # seed's time (and so is refused)
        seed_t = seeds.groupBy(F.col(key).alias("_sk")).agg(F.max(ts).alias("_seed_t"))
        df = df.join(seed_t, F.col(key) == F.col("_sk"), "left").drop("_sk")
        df = df.withColumn("_teff", F.greatest(F.col(ts), F.col("_seed_t"))).drop("_seed_t")
        teff = "_teff"

    base = df.select(F.col(key).alias("_k"), F.col(teff).alias("_t"), F.col(id_col).alias("_id"), F.lit(False).alias("_seed"))
    if seeds is not None:
        base = base.unionByName(
            seeds.select(F.col(key).alias("_k"), F.col(ts).alias("_t"), F.lit(None).cast(df.schema[id_col].dataType).alias("_id"), F.lit(True).alias("_seed"))
        )
    # a seed at a time leaves no candidate among requests there
    pts = base.groupBy("_k", "_t").agg(
        F.when(F.max(F.col("_seed").cast("int")) == 1, F.lit(None)).otherwise(F.min("_id")).alias("_win")
    )
    dealt = pts.repartitionByRange("_k", "_t").sortWithinPartitions("_k", "_t")
    pts = dealt.withColumn("_r", F.spark_partition_id().cast("long")).checkpoint(eager=True)

    kind = pts.schema["_k"].dataType.simpleString()
    steps = pts.select("_k", "_r", "_t").mapInArrow(edge_stretches(c), f"_k {kind}, _r long, upto long, last long").checkpoint(eager=True)
    entry = {r["_r"]: r["entry"] for r in _entries(steps, c).collect()}  # one a partition at most
    allowed = pts.mapInArrow(allowed_points(c, entry), f"_k {kind}, _t long, _win {pts.schema['_win'].dataType.simpleString()}")

    winners = allowed.filter(F.col("_win").isNotNull()).select(
        F.col("_k").alias(key + "__k"), F.col("_t").alias(ts + "__t"), F.col("_win").alias("_win")
    )
    out = df.join(winners, (F.col(key) == F.col(key + "__k")) & (F.col(teff) == F.col(ts + "__t")), "left")
    out = out.withColumn(out_col, F.coalesce(F.col(id_col) == F.col("_win"), F.lit(False)))
    return out.drop(key + "__k", ts + "__t", "_win", "_teff")


def _next_steps(steps: DataFrame, c: int) -> DataFrame:
    """(_k, upto, next): for each step the step of a later stretch in which its
    chain goes on, the sender's first one that takes entries from last + c on.
    No row where the chain ends.

    An as-of join by union: steps and the times asked for are range-partitioned
    together and filled within (sender, range); what a range cannot answer comes
    from a table of one row for each sender and range."""
    asked = F.col("last") + F.lit(c)
    both = steps.select("_k", F.col("upto").alias("t"), F.lit(1).alias("kind"), "upto").unionByName(
        steps.select("_k", asked.alias("t"), F.lit(0).alias("kind"), "upto"))
    dealt = both.repartitionByRange("_k", "t", "kind").withColumn("_p", F.spark_partition_id()).checkpoint(eager=True)
    step = F.when(F.col("kind") == 1, F.col("t"))
    after = Window.partitionBy("_k", "_p").orderBy(F.desc("t"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    later = Window.partitionBy("_k").orderBy(F.desc("_p")).rowsBetween(Window.unboundedPreceding, -1)
    heads = dealt.groupBy("_k", "_p").agg(F.min(step).alias("head")).select("_k", "_p", F.last("head", ignorenulls=True).over(later).alias("head")).checkpoint(eager=True)
    filled = dealt.withColumn("found", F.last(step, ignorenulls=True).over(after)).filter("kind = 0")
    h = heads.select(F.col("_k").alias("hk"), F.col("_p").alias("hp"), "head")
    out = filled.join(h, F.col("_k").eqNullSafe(F.col("hk")) & (F.col("_p") == F.col("hp")), "left")
    return out.select("_k", "upto", F.coalesce("found", "head").alias("next")).filter("next is not null")


def _on_chain(starts: DataFrame, links: DataFrame) -> DataFrame:
    """(_k, upto): the steps reached from ``starts`` by links, these included."""
    seen, links = starts.checkpoint(eager=True), links.checkpoint(eager=True)
    while True:
        to = links.select(F.col("_k").alias("lk"), F.col("upto").alias("at"), F.col("next").alias("to"))
        new = seen.join(to, F.col("_k").eqNullSafe(F.col("lk")) & (F.col("upto") == F.col("at"))).select("_k", F.col("to").alias("upto")).checkpoint(eager=True)
        if new.isEmpty():
            return seen
        seen = seen.unionByName(new).checkpoint(eager=True)
        links = links.join(to, F.col("_k").eqNullSafe(F.col("lk")) & (F.col("next") == F.col("at"))).select("_k", "upto", F.col("to").alias("next")).checkpoint(eager=True)


def _entries(steps: DataFrame, c: int) -> DataFrame:
    """(_r, entry): the last allowed time before each range's first run, for
    senders that lie in several ranges."""
    runs = steps.groupBy("_k", "_r").agg(F.min("upto").alias("first")).checkpoint(eager=True)  # two a partition at most
    long_runs = runs.groupBy(F.col("_k").alias("sk")).agg(F.count(F.lit(1)).alias("n"), F.min("first").alias("start")).filter("n > 1").checkpoint(eager=True)
    several = steps.join(long_runs.select("sk"), F.col("_k").eqNullSafe(F.col("sk")), "left_semi")
    chain = _on_chain(long_runs.select(F.col("sk").alias("_k"), F.col("start").alias("upto")), _next_steps(several, c))
    chain = chain.select(F.col("_k").alias("ck"), F.col("upto").alias("cu"))
    exits = several.join(chain, F.col("_k").eqNullSafe(F.col("ck")) & (F.col("upto") == F.col("cu")), "left_semi").select(F.col("_k").alias("ek"), F.col("_r").alias("er"), "last")
    before = Window.partitionBy("_k").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    placed = runs.join(long_runs.select("sk"), F.col("_k").eqNullSafe(F.col("sk")), "left_semi").join(exits, F.col("_k").eqNullSafe(F.col("ek")) & (F.col("_r") == F.col("er")), "left")
    return placed.select("_r", F.last("last", ignorenulls=True).over(before).alias("entry")).filter("entry is not null")


def throttle_split(df: DataFrame, cooldown_ms: int = DEFAULT_COOLDOWN_MS, error_col: str = "error", **kw) -> DataFrame:
    """Throttle, then route: refused -> ``TOO_MANY_REQUESTS``."""
    t = throttle(df, cooldown_ms, **kw)
    return split_flag(t, "allowed", TOO_MANY_REQUESTS, error_col)
