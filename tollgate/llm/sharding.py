"""Placement by a weighted hash tree (DataFrame functions only).

A tree has regions, racks and shards. A row descends it by one weighted hash
draw a level: every child of the node gets an exponential variate, -ln(u) /
weight, with u from md5 of the row's key and the child's path, and the least
variate wins (equal ones: the lower index). A child's weight is the sum of the
weights below it, so that a shard takes rows in proportion to its weight.

A draw looks at one child's path and weight alone. Where weights change, all
other children keep their variates: a row moves only into or out of a subtree
whose weight changed, and inside subtrees without a change no row moves. A shard
that is added as a region of its own (:meth:`Tree.with_region`) takes rows only
into itself, whatever its weight; one that is added to a rack also moves rows
between the shards of that region.

Defined cases: a null key is drawn as one key of its own, so all such rows share
a shard; equal keys share a shard (a key that holds a third of all rows makes
its shard that large: key and tree alone decide); a null text counts no bytes;
an empty table gives no rows; children without weight take no rows; very long
texts are read once, for their size and checksum, and not carried on; extra
columns are left out.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollgate.llm.common import Written, text_bytes

#: Hex digits of md5 that make a draw: 13 are 52 bits, exact in a double.
DIGITS = 13


@dataclass(frozen=True)
class Tree:
    """``regions[i][j][k]`` is the weight of shard k in rack j of region i.
    Shards are numbered from 0 in that order."""

    regions: tuple[tuple[tuple[float, ...], ...], ...]

    def __post_init__(self):
        if any(w < 0 for region in self.regions for rack in region for w in rack) or not self.weights(()):
            raise ValueError("weights are at least 0, and one is above 0")

    @classmethod
    def uniform(cls, regions: int, racks: int, shards: int) -> Tree:
        return cls((((1.0,) * shards,) * racks,) * regions)

    def with_region(self, racks: Sequence[Sequence[float]]) -> Tree:
        """The tree with one more region; the numbers of all shards stay."""
        return Tree((*self.regions, tuple(tuple(r) for r in racks)))

    def weights(self, path: tuple[int, ...]) -> list[float]:
        """Weights of the children of a node; of the root for the empty path."""
        total = lambda x: x if isinstance(x, (int, float)) else sum(map(total, x))
        node = self.regions
        for i in path:
            node = node[i]
        out = [float(total(c)) for c in node]
        return out if any(out) else []

    def first_shards(self) -> list[list[int]]:
        """Number of the first shard of every rack."""
        out, n = [], 0
        for region in self.regions:
            out.append([])
            for rack in region:
                out[-1].append(n)
                n += len(rack)
        return out


def _draw(key: Column, path: Column, children: Column) -> Column:
    """Index of the winning child; ``children`` is an array of weights."""
    u = lambda i: (F.conv(F.substring(F.md5(F.concat(key, F.lit("|"), path, F.lit("/"), i.cast("string")).cast("binary")), 1, DIGITS), 16, 10)
                   .cast("double") + 0.5) / float(16 ** DIGITS)
    draws = F.transform(children, lambda w, i: F.when(w > 0, F.struct((-F.ln(u(i)) / w).alias("e"), i.alias("i"))))
    return F.array_min(F.filter(draws, lambda d: d.isNotNull()))["i"]


def _nested(values, kind: str) -> Column:
    """A nested Python list as an array literal."""
    if not isinstance(values, list):
        return F.lit(values).cast(kind)
    return F.array(*[_nested(v, kind) for v in values]) if values else F.array().cast(f"array<{kind}>")


def place(df: DataFrame, tree: Tree, key: Column, out: str) -> DataFrame:
    """Add ``out``, the shard of each row's key."""
    key = F.coalesce(key.cast("string"), F.lit("null:"))
    r, a = f"_{out}_region", f"_{out}_rack"
    regions = range(len(tree.regions))
    racks = _nested([tree.weights((i,)) for i in regions], "double")
    shards = _nested([[tree.weights((i, j)) for j in range(len(tree.regions[i]))] for i in regions], "double")
    first = _nested(tree.first_shards(), "int")
    path = lambda *cols: F.concat_ws("/", *[F.col(c).cast("string") for c in cols])
    df = df.withColumn(r, _draw(key, F.lit(""), _nested(tree.weights(()), "double")))
    df = df.withColumn(a, _draw(key, path(r), F.get(racks, F.col(r))))
    shard = F.get(F.get(first, F.col(r)), F.col(a)) + _draw(key, path(r, a), F.get(F.get(shards, F.col(r)), F.col(a)))
    return df.withColumn(out, shard.cast("int")).drop(r, a)


def with_slots(df: DataFrame, shard: str, order: Sequence[str], out: str = "slot") -> DataFrame:
    """Add ``out``, a number from 0 without gaps within each shard, in the order
    of the columns ``order`` (nulls first, rows equal in all of them in any order).

    No shard is gathered in one task. Rows are dealt by ranges of the order,
    equal ones too (a row number breaks ties), and each range is written sorted
    by shard with a running number; what comes before a shard's rows in earlier
    ranges is a sum over one row for each range and shard.
    """
    tied = Written(df.withColumn("_tie", F.monotonically_increasing_id()), "shard-rows")
    by = [F.col(c).asc_nulls_first() for c in (*order, "_tie")]
    dealt = tied.df.repartitionByRange(*by).sortWithinPartitions(F.col(shard), *by)
    dealt = dealt.withColumns({"_range": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}).drop("_tie")
    ranged = Written(dealt, "shard-ranges")
    tied.drop()
    before = Window.partitionBy(shard).orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = ranged.df.groupBy(shard, "_range").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    runs = runs.select(shard, "_range", (F.sum("_n").over(before) - F.col("_n") - F.col("_first")).alias("_shift"))
    runs = Written(runs, "shard-runs").df
    return ranged.df.join(runs, [shard, "_range"]).withColumn(out, F.col("_at") + F.col("_shift")).drop("_range", "_at", "_shift")


def shard_documents(docs: DataFrame, tree: Tree, grown: Tree, id_col: str = "doc_id", text_col: str = "text", overhead: int = 16) -> DataFrame:
    """One row per document: doc_id, size (text bytes and ``overhead``),
    text_crc32, law (``key``: id and tree decide), shard in ``tree``, slot in
    the shard (by doc_id, size, text_crc32), grown_shard in ``grown``."""
    t = text_bytes(text_col)
    d = docs.select(F.col(f"`{id_col}`").alias("doc_id"), (F.octet_length(t) + overhead).cast("long").alias("size"), F.crc32(t).alias("text_crc32"))
    d = place(place(d, tree, F.col("doc_id"), "shard"), grown, F.col("doc_id"), "grown_shard")
    out = with_slots(d, "shard", ["doc_id", "size", "text_crc32"])
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), "grown_shard")


def moves(placed: DataFrame, before: str = "shard", after: str = "grown_shard") -> DataFrame:
    """Rows and bytes that go from shard to shard between two trees."""
    moved = placed.filter(F.col(before) != F.col(after))
    return moved.groupBy(before, after).agg(F.count("*").alias("n_rows"), F.sum("size").alias("n_bytes"))
