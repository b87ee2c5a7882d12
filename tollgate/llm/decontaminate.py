"""Benchmark decontamination by a positional inverted index of the documents.

1. Queries: the benchmark's texts are cut into windows in Spark; equal windows
   become one row. Windows with the same items share a group, so that a hit
   carries one number however many items have the window.
2. Index: documents are read once into shards of bounded text. A shard stores,
   for every term, the sorted positions at which it stands (the posting list),
   and where each document begins. Positions are numbered through the shard with
   a gap between documents, so that no phrase crosses. A join with the distinct
   terms of the whole benchmark keeps the lists that some window needs.
3. Statistics: the frequency of each term over all shards orders the terms of
   every window from the rarest on; windows with a term that stands nowhere
   drop out.
4. Search: a window is sent to the shards that have its rarest term, and the
   shard's lists are read before its windows stream by. Lists are intersected,
   the rarest term's first, shifted by the term's offset in the window. With
   ``slop`` 0 the matches are exact phrases; with more, each term may stand up to
   that many places from its own (proximity).

No window and no document passes the driver. A task holds one shard's lists,
its matches and a batch of windows. Documents are never compared with each
other, and common passages are reported for each document that has them.

Defined cases: null or empty texts have no words: no window, no hit; items
that are repeated, or share windows, count each by its own id (items without an
id still mark words, but are not named); repeated document rows give one result
row each; a null doc_id stays null; extra columns are ignored; an empty
benchmark hits nothing, empty documents give no rows; ties among terms of one
frequency go to the earlier offset; a very long text is a shard of its own,
which one task holds (its words, and four bytes a word of lists).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import CHUNK_BYTES, Written, text_bytes

#: Bytes of words: digits, letters and everything beyond ASCII; A-Z lower-cased.
WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORDS).split()


def windows_of(words: list[bytes], size: int) -> Iterator[tuple[bytes, ...]]:
    if words:
        for i in range(max(1, len(words) - size + 1)):
            yield tuple(words[i:i + size])


def runs_of(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Maximal runs covered by the intervals [start, end), as an (n, 2) array."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.flatnonzero(np.r_[True, starts[1:] > reach[:-1]])
    return np.stack([starts[new], np.r_[reach[new[1:] - 1], reach[-1:]]], axis=1)


def pack_runs(runs: np.ndarray) -> bytes:
    return runs.astype("<i4").tobytes()


def unpack_runs(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<i4").reshape(-1, 2)


# --- queries ---------------------------------------------------------------------

def cut_windows(size: int):
    """Arrow function: (item, t) to the different windows of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for item, t in zip(b.column("item").to_pylist(), b.column("t")):
                own = list(set(windows_of(words_of(t.as_py()), size)))
                for i in range(0, len(own), 1 << 13):
                    part = own[i:i + (1 << 13)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item] * len(part), pa.int64()), pa.array([list(w) for w in part], pa.list_(pa.binary()))], ["item", "window"])

    return run


def query_windows(benchmark: DataFrame, item_col: str, text_col: str, size: int) -> tuple[DataFrame, DataFrame]:
    """(windows, items): rows (window, group), one for each different window, and
    rows (group, item) for the items that have the windows of a group."""
    rows = benchmark.select(F.col(f"`{item_col}`").cast("long").alias("item"), text_bytes(text_col).alias("t"))
    owned = Written(rows.mapInArrow(cut_windows(size), "item long, window array<binary>").distinct(), "owned-windows").df
    # A set of items is known by its size and two sums of hashes, so that no row
    # holds the items of a common window.
    mark = [F.sum(F.xxhash64(F.lit(k), "item").cast("decimal(38,0)")).alias(f"s{k}") for k in (1, 2)]
    windows = owned.groupBy("window").agg(F.count("*").alias("n"), *mark).withColumn("w", F.monotonically_increasing_id())
    windows = Written(windows, "windows").df
    groups = windows.groupBy("n", "s1", "s2").agg(F.min("w").alias("group"))
    windows = Written(windows.join(groups, ["n", "s1", "s2"]).select("window", "w", "group"), "grouped-windows").df
    items = owned.filter("item is not null").join(windows.filter(F.col("w") == F.col("group")), "window").select("group", "item")
    return windows.select("window", "group"), items


# --- index -----------------------------------------------------------------------

INDEX = "shard string, term binary, n long, postings binary, ids array<long>, keys array<long>"
INDEX_ARROW = pa.schema([("shard", pa.string()), ("term", pa.binary()), ("n", pa.int64()), ("postings", pa.binary()),
                         ("ids", pa.list_(pa.int64())), ("keys", pa.list_(pa.int64()))])
#: The row of a shard that lists its documents has the term that no word is.
NO_TERM, DOCUMENTS = b"", -1


class Codes(dict):
    """Term -> number, in order of appearance."""

    def __missing__(self, term: bytes) -> int:
        out = self[term] = len(self)
        return out


def shard_rows(shard: str, terms: list[bytes], codes: list[np.ndarray], ids: list, keys: list, starts: list[int], ends: list[int]) -> Iterator[pa.RecordBatch]:
    """A shard's index: a row for each term with its posting list, and one row
    with the documents and (as postings) their bounds."""
    codes = np.concatenate(codes)
    at = np.flatnonzero(codes >= 0)
    order = at[np.argsort(codes[at], kind="stable")].astype("<i4")
    n = np.bincount(codes[at], minlength=len(terms))
    offsets = np.r_[0, np.cumsum(n)].tolist()
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(([shard], [NO_TERM], [len(ids)], [np.array([starts, ends], "<i8").tobytes()], [ids], [keys]), INDEX_ARROW)], schema=INDEX_ARROW)
    for i in range(0, len(terms), 1 << 13):
        part = terms[i:i + (1 << 13)]
        lists = [order[offsets[k]:offsets[k + 1]].tobytes() for k in range(i, i + len(part))]
        columns = ([shard] * len(part), part, n[i:i + len(part)], lists, [None] * len(part), [None] * len(part))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, INDEX_ARROW)], schema=INDEX_ARROW)


def index_shards(gap: int, chunk_bytes: int):
    """Arrow function: documents (doc_id, key, t) to index rows. Shards are named
    by task and number, so that another attempt of a task gives the same ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        code, codes, ids, keys, starts, ends, size, at = Codes(), [], [], [], [], [], 0, 0
        for b in batches:
            for doc_id, key, t in zip(b.column("doc_id").to_pylist(), b.column("key").to_pylist(), b.column("t")):
                t = t.as_py()
                words = words_of(t)
                own = np.full(len(words) + gap, -1, np.int32)
                own[:len(words)] = np.fromiter(map(code.__getitem__, words), np.int32, len(words))
                codes.append(own)
                ids.append(doc_id)
                keys.append(key)
                starts.append(at)
                ends.append(at + len(words))
                at += len(own)
                size += len(t)
                if size >= chunk_bytes:
                    yield from shard_rows(f"{task}-{number}", list(code), codes, ids, keys, starts, ends)
                    number += 1
                    code, codes, ids, keys, starts, ends, size, at = Codes(), [], [], [], [], [], 0, 0
        if ids:
            yield from shard_rows(f"{task}-{number}", list(code), codes, ids, keys, starts, ends)

    return run


# --- search ----------------------------------------------------------------------

def intersect(lists: dict[int, np.ndarray], terms: list[int], offsets: list[int], slop: int) -> np.ndarray:
    """Starts of a window's matches: the posting lists of ``terms`` (the rarest
    first), each shifted by its offset in the window. With slop, a start counts
    if every term stands within ``slop`` places of its own."""
    found = None
    for term, k in zip(terms, offsets):
        own = lists[term]
        if found is None:
            found = own.astype(np.int64) - k
            if slop:
                found = np.unique((found[:, None] + np.arange(-slop, slop + 1)).ravel())
        else:
            at = np.searchsorted(own, found + (k - slop))
            ok = at < len(own)
            ok[ok] = own[at[ok]] <= found[ok] + (k + slop)
            found = found[ok]
        if not found.size:
            break
    return found


RESULT = "doc_id long, key long, n_words long, spans binary, groups array<long>"


class Shard:
    """One shard while its rows stream by: documents, posting lists, windows."""

    def __init__(self, slop: int):
        self.slop, self.lists, self.hits = slop, {}, []

    def add(self, t: pa.RecordBatch) -> None:
        kinds = t.column("kind").to_numpy()
        first, last = np.searchsorted(kinds, [1, 2])  # rows are sorted by kind
        for r in t.slice(0, first).to_pylist():
            self.starts, self.ends = np.frombuffer(r["postings"], "<i8").reshape(2, -1)
            self.ids, self.keys = r["ids"], r["keys"]
        lists = t.slice(first, last - first)
        for term, raw in zip(lists.column("code").to_pylist(), lists.column("postings").to_pylist()):
            self.lists[term] = np.frombuffer(raw, "<i4")
        windows = t.slice(last)
        for terms, offsets, group in zip(windows.column("terms").to_pylist(), windows.column("offsets").to_pylist(), windows.column("code").to_pylist()):
            if all(k in self.lists for k in terms):
                found = intersect(self.lists, terms, offsets, self.slop)
                if found.size:
                    self.match(found, len(terms), group)

    def match(self, found: np.ndarray, size: int, group: int) -> None:
        doc = np.searchsorted(self.starts, found + self.slop, "right") - 1
        begin = np.maximum(found - self.starts[doc], 0)
        end = np.minimum(found + size, self.ends[doc]) - self.starts[doc]
        self.hits.append(np.stack([doc, begin, end, np.full(len(doc), group)]))

    def result(self) -> pa.RecordBatch:
        n = len(self.ids)
        spans, groups = [b""] * n, [[]] * n
        if self.hits:
            hits = np.concatenate(self.hits, axis=1)
            hits = hits[:, np.argsort(hits[0], kind="stable")]
            for part in np.split(hits, np.flatnonzero(np.diff(hits[0])) + 1, axis=1):
                d = int(part[0, 0])
                spans[d] = pack_runs(runs_of(part[1], part[2]))
                groups[d] = np.unique(part[3]).tolist()
        return pa.RecordBatch.from_arrays(
            [pa.array(self.ids, pa.int64()), pa.array(self.keys, pa.int64()), pa.array(self.ends - self.starts, pa.int64()), pa.array(spans, pa.binary()), pa.array(groups, pa.list_(pa.int64()))],
            ["doc_id", "key", "n_words", "spans", "groups"])


def search_shards(slop: int):
    """Arrow function: rows of the index and windows, sorted by shard and kind, to
    a row for each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, shard = None, None
        for b in batches:
            names = b.column("shard").to_pylist()
            cuts = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1]), len(names)]
            for x, y in zip(cuts, cuts[1:]):
                if x == y:
                    continue
                if names[x] != name:
                    if shard:
                        yield shard.result()
                    name, shard = names[x], Shard(slop)
                shard.add(b.slice(x, y - x))
        if shard:
            yield shard.result()

    return run


def search(docs: DataFrame, windows: DataFrame, size: int, slop: int, chunk_bytes: int) -> DataFrame:
    """Index documents (doc_id, key, t), search the windows (window, group)."""
    spark = docs.sparkSession
    terms = windows.select(F.explode("window").alias("term")).distinct().withColumn("code", F.monotonically_increasing_id())
    terms = Written(terms.unionByName(spark.range(1).select(F.lit(NO_TERM).alias("term"), F.lit(DOCUMENTS).cast("long").alias("code"))), "terms").df
    index = docs.mapInArrow(index_shards(size + 2 * slop, chunk_bytes), INDEX).join(terms, "term").drop("term")
    index = Written(index, "postings").df
    frequency = index.filter(F.col("code") != DOCUMENTS).groupBy("code").agg(F.sum("n").alias("n"))
    known = terms.join(frequency, "code")
    placed = windows.withColumn("w", F.monotonically_increasing_id()).select("w", "group", F.size("window").alias("size"), F.posexplode("window").alias("k", "term"))
    # At most one entry a place of the window; a window short of one stands nowhere.
    ordered = placed.join(known, "term").groupBy("w", "group", "size").agg(F.sort_array(F.collect_list(F.struct("n", "k", "code"))).alias("p")).filter(F.size("p") == F.col("size"))
    ordered = Written(ordered.select("group", F.col("p.code").alias("terms"), F.col("p.k").alias("offsets"), F.col("p")[0]["code"].alias("rarest")), "ordered-windows").df
    none = lambda kind: F.lit(None).cast(kind)
    lists = index.select("shard", F.when(F.col("code") == DOCUMENTS, 0).otherwise(1).alias("kind"), "code", "postings", "ids", "keys",
                         none("array<long>").alias("terms"), none("array<int>").alias("offsets"))
    sent = index.select("shard", F.col("code").alias("rarest")).join(ordered, "rarest").select(
        "shard", F.lit(2).alias("kind"), F.col("group").alias("code"), none("binary").alias("postings"), none("array<long>").alias("ids"), none("array<long>").alias("keys"), "terms", "offsets")
    dealt = lists.unionByName(sent).repartition("shard").sortWithinPartitions("shard", "kind")
    found = dealt.mapInArrow(search_shards(slop), RESULT)

    @F.pandas_udf("long")
    def covered(spans: pd.Series) -> pd.Series:
        return pd.Series([int(np.diff(unpack_runs(bytes(x)), axis=1).sum()) for x in spans], dtype="int64")

    return found.withColumn("n_hit", covered("spans"))


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
            item_text_col: str = "text", size: int = 10, slop: int = 0, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Rows (doc_id, n_words, spans, items, n_hit), one for each document:
    ``spans`` the runs of hit words (little-endian int32 pairs), ``items`` the
    benchmark items with a window in the document."""
    d = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_bytes(text_col).alias("t"), F.lit(None).cast("long").alias("key"))
    windows, items = query_windows(benchmark, item_col, item_text_col, size)
    found = Written(search(d, windows, size, slop, chunk_bytes).withColumn("key", F.monotonically_increasing_id()), "found").df
    named = found.select("key", F.explode("groups").alias("group")).join(items, "group").groupBy("key").agg(F.collect_set("item").alias("items"))
    named = Written(named, "named").df
    return found.join(named, "key", "left").select("doc_id", "n_words", "spans", F.coalesce("items", F.array().cast("array<long>")).alias("items"), "n_hit")


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns."""
    joined = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(joined.cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                    item_text_col: str = "text", size: int = 10, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The documents without any benchmark window, with the input's columns.
    Each row is judged by its own text, whatever ids it shares; the input is
    written once with a row number, by which contaminated rows go."""
    key = "_row"
    while key in docs.columns:
        key += "_"
    numbered = Written(docs.withColumn(key, F.monotonically_increasing_id()), "numbered").df
    d = numbered.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_bytes(text_col).alias("t"), F.col(key).alias("key"))
    windows, _ = query_windows(benchmark, item_col, item_text_col, size)
    bad = search(d, windows, size, 0, chunk_bytes).filter("n_hit > 0").select(F.col("key").alias(key))
    return numbered.join(bad, key, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
