"""SimHash near-duplicates, linked through BK-trees.

1. Fingerprint every whole text (Arrow batches; xxHash64 of word shingles).
2. Equal fingerprints become one row by a pre-aggregated group.
3. Shards: a fingerprint of four 16-bit blocks goes to one shard for each pair
   of blocks. Two fingerprints that differ in at most ``radius`` = 2 bits agree
   on at least two blocks, so every link lies inside some shard.
4. In each shard a BK-tree is built: children are keyed by the integer Hamming
   distance to their parent. Every fingerprint of the shard searches the tree
   and follows only edges within the radius of its distance to the node.
   A shard of more than ``TREE`` fingerprints is cut into trees of that bound,
   and each tree is sent to every slice of the shard's queries, so no task
   holds more than two slices and no pair is left out.
5. Each search keeps one link to the smallest fingerprint that it is connected
   to there; connected components over those links give the groups.

A tree of all fingerprints would have to be broadcast in a number of shards
that grows with the data; sending a tree only to the fingerprints that can have
a match in it keeps each broadcast bounded and the search exact.

Defined cases: null or empty texts (and texts of white space) have no words and
fingerprint zero, linked like any other; texts of fewer words than a shingle
are one shingle; a null id never becomes a component's id unless the whole
component has none; repeated rows give one result row each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import Written, by_groups, components, text_bytes

#: Most fingerprints in one BK-tree.
TREE = 4096
#: Most (query, node) pairs that one search step holds.
FRONTIER = 1 << 22
#: Words of a long text whose bit counts are summed at a time.
SLICE = 1 << 16

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of a text's word shingles, repeats included."""
    words = text.translate(LOWER).split()  # ASCII white space only, as bytes
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    ends = ends[min(shingle, len(words)) - 1:]
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, SLICE):
        spans = zip(starts[at:min(at + SLICE, n)].tolist(), ends[at:at + SLICE].tolist())
        h = np.array([digest(joined[s:e], seed) for s, e in spans], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > n, bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprint_udf(shingle: int, seed: int = 42):
    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(bytes(t), shingle, seed) for t in texts], np.uint64).view(np.int64))

    return fp


# --- BK-trees, many small ones at a time ---------------------------------------

def build_trees(fp: np.ndarray, tree: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """BK-trees of the fingerprints, one for each run of equal ``tree`` values.

    Returns (root of each row's tree, edge keys ``parent * 65 + distance`` in
    order, child of each edge). Levels are built together: all rows that reach
    a node at one distance meet there, the first becomes the child, the others
    go down to it.
    """
    n = len(fp)
    first = np.flatnonzero(np.r_[True, tree[1:] != tree[:-1]])
    root = np.repeat(first, np.diff(np.r_[first, n]))
    at, todo = root.copy(), np.flatnonzero(root != np.arange(n))
    keys, children = [], []
    while todo.size:
        key = at[todo] * 65 + np.bitwise_count(fp[todo] ^ fp[at[todo]])
        order = np.argsort(key, kind="stable")
        key, todo = key[order], todo[order]
        head = np.r_[True, key[1:] != key[:-1]]
        keys.append(key[head])
        children.append(todo[head])
        at[todo] = todo[head][np.cumsum(head) - 1]
        todo = todo[~head]
    if not keys:
        return root, np.empty(0, np.int64), np.empty(0, np.int64)
    keys, children = np.concatenate(keys), np.concatenate(children)
    order = np.argsort(keys)
    return root, keys[order], children[order]


def search_trees(fp, root, keys, children, query, start, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Matches of the queries (row ``i`` of ``query`` starts at node ``start[i]``;
    negative: no tree) within the radius, as (query index, node) arrays."""
    live = np.flatnonzero(start >= 0)
    q, node = live, start[live]
    while q.size:
        d = np.bitwise_count(query[q] ^ fp[node]).astype(np.int64)
        hit = d <= radius
        if hit.any():
            yield q[hit], node[hit]
        lo = np.searchsorted(keys, node * 65 + np.maximum(d - radius, 0), "left")
        hi = np.searchsorted(keys, node * 65 + np.minimum(d + radius, 64), "right")
        n = hi - lo
        q = np.repeat(q, n)
        node = children[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())]


def connect(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the components of a[i] and b[i]; labels point to each component's smallest row."""
    while True:
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            return
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def link_shards(radius: int):
    """Arrow function over rows (shard, i, j, role, fp) sorted by those columns:
    role 0 are a tree's fingerprints, role 1 queries of another slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in by_groups(batches, ["shard", "i", "j"], 1 << 16):
            shard, i, j, role = (t.column(c).to_numpy() for c in ("shard", "i", "j", "role"))
            fp = t.column("fp").to_numpy().view(np.uint64)
            new = np.r_[True, (shard[1:] != shard[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])]
            group = np.cumsum(new) - 1
            first, size = np.flatnonzero(new), np.bincount(group)
            member = np.flatnonzero(role == 0)
            roots, keys, children = build_trees(fp[member], group[member])
            keys = member[keys // 65] * 65 + keys % 65 if keys.size else keys
            children = member[children]
            start = np.full(len(size), -1, np.int64)
            start[group[member]] = member[roots]
            label = np.arange(len(fp))
            # Queries go in slices whose trees' sizes sum to a bound.
            cost = np.cumsum(size[group])
            at = 0
            while at < len(fp):
                to = max(at + 1, int(np.searchsorted(cost, (cost[at - 1] if at else 0) + FRONTIER, "right")))
                for q, node in search_trees(fp, roots, keys, children, fp[at:to], start[group[at:to]], radius):
                    connect(label, q + at, node)
                at = to
            del first
            linked = label != np.arange(len(fp))
            a, b = fp[linked], fp[label[linked]]
            differ = a != b
            if differ.any():
                yield pa.RecordBatch.from_arrays([pa.array(a[differ].view(np.int64)), pa.array(b[differ].view(np.int64))], ["a", "b"])

    return run


def links(fps: DataFrame, radius: int = 2, tree: int = TREE) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints (column ``fp``)
    within ``radius`` bits, through others if need be; radius 0 to 2."""
    if not 0 <= radius <= 2:
        raise ValueError("four blocks taken in pairs find links of up to 2 bits")
    block = [F.shiftrightunsigned("fp", 16 * k).bitwiseAND(F.lit(0xFFFF)) for k in range(4)]
    pairs = [(x, y) for x in range(4) for y in range(x)]
    shards = F.array(*(F.lit(k << 32) + block[x] * 65536 + block[y] for k, (x, y) in enumerate(pairs)))
    members = fps.select("fp", F.explode(shards).alias("shard"))
    sizes = Written(members.groupBy("shard").agg(F.count("*").alias("n")).filter("n > 1"), "shards").df
    cuts = F.ceil(F.col("n") / tree).cast("int")
    rows = (
        members.join(sizes, "shard")
        .withColumn("c", cuts)
        .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("c")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("c") - 1)))
        .select(
            "shard", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
            (F.col("own") > F.col("other")).cast("int").alias("role"), "fp",
        )
    )
    keys = ["shard", "i", "j"]
    dealt = rows.repartition(*keys).sortWithinPartitions(*keys, "role", "fp")
    return dealt.mapInArrow(link_shards(radius), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    radius: int = 2, tree: int = TREE) -> DataFrame:
    """Rows (doc_id, fingerprint, component_id), one for each input row."""
    d = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_bytes(text_col).alias("t"))
    marked = Written(d.select("doc_id", fingerprint_udf(shingle)("t").alias("fp")), "fingerprints").df
    groups = group_fingerprints(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), radius, tree)
    return marked.join(groups, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("least").alias("component_id"))


def group_fingerprints(fps: DataFrame, radius: int, tree: int = TREE) -> DataFrame:
    """Replace ``least`` of each distinct ``fp`` by the smallest of its component."""
    fps = Written(fps, "distinct").df
    comp = components(links(fps.select("fp"), radius, tree), "simhash").df
    linked = comp.join(fps, comp.node == fps.fp).select("fp", "root", "least")
    whole = linked.groupBy("root").agg(F.min("least").alias("whole"))
    linked = linked.join(whole, "root").select("fp", "whole")
    groups = fps.join(linked, "fp", "left").select("fp", F.coalesce("whole", "least").alias("least"))
    # Written, so that a join of all rows with it can be split at hot fingerprints.
    return Written(groups, "groups").df


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
             radius: int = 2, tree: int = TREE) -> DataFrame:
    """One document of each component, with exactly the input's columns: that of
    the smallest id (nulls last), the first of repeated rows."""
    row = docs.select(F.struct("*").alias("_row"), F.col(f"`{id_col}`").alias("_id"), text_bytes(text_col).alias("_t"))
    rows = Written(row.select("_row", "_id", F.monotonically_increasing_id().alias("_rid"), fingerprint_udf(shingle)("_t").alias("fp")), "rows").df
    rank = F.struct(F.col("_id").isNull().alias("last"), F.col("_id").alias("id"), F.col("_rid").alias("rid"))
    groups = group_fingerprints(rows.groupBy("fp").agg(F.min(rank).alias("least")), radius, tree)
    winners = groups.select(F.col("least.rid").alias("_rid")).distinct()
    return rows.join(winners, "_rid", "left_semi").select("_row.*")
