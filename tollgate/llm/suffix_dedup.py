"""Removal of every long byte string that stands elsewhere too.

A window is a string of ``length`` bytes; every byte covered by a window that
starts at two or more places (any documents, the same one included) goes.

1. Anchors. Each window is filed under its anchor: the ``gram``-byte string in
   it with the least hash (leftmost of equals). The anchor depends on the
   window's bytes alone, so equal windows have equal anchors at equal offsets.
   A span is the stretch of windows that share one anchor; a document of n
   bytes has about 2 n / (length - gram) of them.
2. Spans whose anchor stands nowhere else are unique and drop out. Identical
   spans become one row with a count (pre-aggregated): where the count is over
   one, all their windows repeat.
3. Where an anchor has several different spans, the spans' texts are fetched
   once and cut into pieces: runs of ``PIECE`` windows by their offset to the
   anchor. All windows of a piece hold the same core, which becomes one symbol;
   what is left are the few bytes before and after it. Windows can only be
   equal within one core, so pieces are grouped by core (and offset), and cores
   that stand alone drop out.
4. Groups of pieces are cut into shards. Each shard's Burrows-Wheeler transform
   is built once; the transforms are merged by interleave refinement, which
   yields the common prefixes of neighbours. Where a prefix is as long as a
   window (``PIECE`` symbols: its other bytes and the core), the window repeats.
   A core with more than ``GROUP`` different pieces is not gathered in one
   task: its windows are counted by hash, with map-side combination.
5. Repeated windows go back to all documents that have their span, by joins
   that adaptive execution can split, and each text is cut once.

Hashes that decide equality have 128 bits.

Defined cases: a null or empty text has no bytes and nothing is removed; texts
under ``length`` bytes have no window; repeated rows are copies of each other,
so that texts of at least ``length`` bytes go entirely; null ids are kept; extra
columns are carried by :func:`without_repeats` and left out otherwise.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.bwt import repeated
from tollgate.llm.common import Written, by_groups, text_bytes
from tollgate.llm.decontaminate import runs_of

#: Windows whose offsets to the anchor form one piece.
PIECE = 32
#: Different pieces of one core that meet in a task.
GROUP = 20_000
#: Pieces that are merged at a time, and pieces of one shard.
UNIT, SHARD = 1 << 14, 1 << 11
#: Bytes of a text that are hashed at a time.
SEGMENT = 1 << 17


def wrapping_powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


class Anchors:
    """Anchors of all windows of a text."""

    def __init__(self, length: int, gram: int):
        self.length, self.gram = length, gram
        rng = np.random.Generator(np.random.PCG64(20240229))
        self.values = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        base = 0x9E3779B97F4A7C15
        size = SEGMENT + length + 1
        self.powers = wrapping_powers(base, size)
        self.inverse = wrapping_powers(pow(base, -1, 1 << 64), size)

    def hashes(self, x: np.ndarray) -> np.ndarray:
        """A 64-bit hash of the gram at every position, from prefix sums."""
        n, g = len(x), self.gram
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.values[x] * self.powers[:n], out=sums[1:])
        h = (sums[g:] - sums[:-g]) * self.inverse[:n - g + 1]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        return h

    def __call__(self, text: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(anchor, first window, last window, anchor's hash) arrays."""
        x = np.frombuffer(text, np.uint8)
        width = self.length - self.gram + 1
        place = np.uint64((1 << 24) - 1)
        for at in range(0, len(x) - self.length + 1, SEGMENT):
            h = self.hashes(x[at:at + SEGMENT + self.length - 1])
            key = (h & ~place) | np.arange(len(h), dtype=np.uint64)
            least = (sliding_min(key, width) & place).astype(np.int64)
            new = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
            last = np.r_[new[1:], len(least)] - 1
            yield least[new] + at, new + at, last + at, h[least[new]]


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, from minima within blocks."""
    n = len(v)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = v
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n - width + 1], left[width - 1:n])


SPANS = "digest binary, doc_id string, a int, lo int, hi int, gram long, span binary"


def find_spans(length: int, gram: int):
    """Arrow function: (digest, doc_id, t) to a row for each span."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(length, gram)
        digest = xxhash.xxh3_128_digest
        for b in batches:
            for key, doc_id, t in zip(b.column("digest").to_pylist(), b.column("doc_id").to_pylist(), b.column("t")):
                t = t.as_py()
                for a, lo, hi, h in anchors(t):
                    spans = [digest(t[x:y + length] + (k - x).to_bytes(4, "little")) for k, x, y in zip(a.tolist(), lo.tolist(), hi.tolist())]
                    n = len(a)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key] * n, pa.binary()), pa.array([doc_id] * n, pa.string()), *(pa.array(v.astype(np.int32)) for v in (a, lo, hi)),
                         pa.array(h.view(np.int64)), pa.array(spans, pa.binary())],
                        ["digest", "doc_id", "a", "lo", "hi", "gram", "span"])

    def gathered(batches):
        held, rows = [], 0
        for b in run(batches):
            held.append(b)
            rows += b.num_rows
            if rows >= 1 << 15:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, rows = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return gathered


PIECES = "core binary, gram long, span binary, base int, lead binary, tail binary"


def cut_pieces(length: int, piece: int):
    """Arrow function: (t, spans: list of (gram, span, a, lo, hi)) to pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        types = (pa.binary(), pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.binary())
        names = ["core", "gram", "span", "base", "lead", "tail"]
        for b in batches:
            rows = []
            for t, spans in zip(b.column("t"), b.column("spans")):
                t = t.as_py()
                for s in spans.as_py():
                    a, far, near = s["a"], s["a"] - s["lo"], s["a"] - s["hi"]
                    for base in range(near // piece * piece, far + 1, piece):
                        top, low = min(far, base + piece - 1), max(near, base)
                        begin, end = a - base, a - base - piece + 1 + length
                        core = digest(t[begin:end] + base.to_bytes(4, "little"))
                        rows.append((core, s["gram"], s["span"], base, t[a - top:begin], t[end:a - low + length]))
                if len(rows) >= 1 << 14:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), types)], names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), types)], names)

    return run


RANGES = "gram long, span binary, near int, far int"


def merge_pieces(piece: int, unit: int, shard: int):
    """Arrow function: pieces sorted by core to the ranges of offsets (window
    start to anchor, ``near`` to ``far``) whose windows repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in by_groups(batches, ["core"], unit):
            cores = t.column("core").to_pylist()
            number: dict[bytes, int] = {}
            strings = []
            for core, lead, tail in zip(cores, t.column("lead").to_pylist(), t.column("tail").to_pylist()):
                k = number.setdefault(core, len(number))
                strings.append((lead, k, tail))
            # The bytes are 1 to 256, the cores follow, the sentinel is 0. With
            # more cores than symbols (a unit has fewer), wider symbols serve.
            kind = np.uint16 if len(number) + 257 < 1 << 16 else np.uint32
            n_lead = np.array([len(s[0]) for s in strings])
            n_tail = np.array([len(s[2]) for s in strings])
            ends = np.cumsum(n_lead + n_tail + 2)
            starts = ends - (n_lead + n_tail + 2)
            text = np.frombuffer(b"".join(s[0] + b"\0" + s[2] + b"\0" for s in strings), np.uint8).astype(kind) + kind(1)
            text[starts + n_lead] = np.array([s[1] for s in strings], kind) + kind(257)
            text[ends - 1] = 0
            cuts = sorted({*ends[shard - 1::shard].tolist(), int(ends[-1])})
            found = np.sort(repeated(text, cuts, piece))
            own = np.searchsorted(ends, found, "right")
            lead = n_lead[own] - (found - starts[own])  # bytes before the core
            own, lead = own[lead >= 0], lead[lead >= 0]
            if not own.size:
                continue
            new = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (lead[1:] != lead[:-1] - 1)])
            last = np.r_[new[1:], len(own)] - 1
            base = t.column("base").to_numpy()
            take = t.select(["gram", "span"]).take(pa.array(own[new]))
            yield from pa.Table.from_arrays(
                [take.column("gram"), take.column("span"), pa.array((base[own[new]] + lead[last]).astype(np.int32)), pa.array((base[own[new]] + lead[new]).astype(np.int32))],
                ["gram", "span", "near", "far"]).combine_chunks().to_batches()

    return run


def hash_windows(piece: int):
    """Arrow function: pieces to a row for each window, with its 128-bit hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for b in batches:
            rows = []
            for r in b.to_pylist():
                lead, tail = r["lead"], r["tail"]
                for k in range(max(0, piece - 1 - len(tail)), len(lead) + 1):
                    window = r["core"] + bytes([k]) + lead[len(lead) - k:] + tail[:piece - 1 - k]
                    rows.append((digest(window), r["gram"], r["span"], r["base"] + k))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.binary(), pa.int64(), pa.binary(), pa.int32()))], ["window", "gram", "span", "near"])

    return run


def repeated_bytes(texts: DataFrame, length: int, gram: int, piece: int, group: int, unit: int, shard: int) -> DataFrame:
    """From rows (digest, doc_id, t): (digest, spans) for every text with bytes
    to remove; ``spans`` is an array of (begin, end), which may overlap."""
    raw = Written(texts.filter(F.length("t") >= length).mapInArrow(find_spans(length, gram), SPANS), "spans")
    # A join side that is itself an aggregate is written first: with an exchange
    # right below both sides, adaptive execution can split hot keys.
    shared = Written(raw.df.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1").select("gram"), "shared-grams").df
    kept = Written(raw.df.join(shared, "gram", "left_semi"), "shared-spans")
    raw.drop()
    key = ["gram", "span"]
    first = F.min(F.struct("digest", "doc_id", "a", "lo", "hi")).alias("rep")
    spans = Written(kept.df.groupBy(*key).agg(F.count("*").alias("n"), first), "distinct-spans").df
    several = Written(spans.groupBy("gram").agg(F.count("*").alias("k")).filter("k > 1").select("gram"), "mixed-grams").df
    mixed = spans.join(several, "gram", "left_semi")
    by_text = mixed.groupBy(F.col("rep.digest").alias("d"), F.col("rep.doc_id").alias("i")).agg(
        F.collect_list(F.struct("gram", "span", "rep.a", "rep.lo", "rep.hi")).alias("spans"))
    fetched = texts.join(by_text, (F.col("digest") == F.col("d")) & F.col("doc_id").eqNullSafe(F.col("i"))).select("t", "spans")
    pieces = Written(fetched.mapInArrow(cut_pieces(length, piece), PIECES), "pieces").df
    sizes = Written(pieces.groupBy("core").agg(F.count("*").alias("n")).filter("n > 1"), "cores").df
    # Written before it is dealt out by core: the join's own partitioning, under
    # which Spark would leave out the exchange, may be split at a hot core.
    grouped = Written(pieces.join(sizes, "core"), "grouped-pieces").df
    dealt = grouped.filter(F.col("n") <= group).drop("n").repartition("core").sortWithinPartitions("core")
    ranges = dealt.mapInArrow(merge_pieces(piece, unit, shard), RANGES)
    windows = grouped.filter(F.col("n") > group).drop("n").mapInArrow(hash_windows(piece), "window binary, gram long, span binary, near int")
    common = windows.groupBy("window").agg(F.count("*").alias("n")).filter("n > 1").select("window")
    single = windows.join(common, "window", "left_semi").select("gram", "span", "near", F.col("near").alias("far"))
    whole = spans.filter("n > 1").select("gram", "span", F.lit(0).alias("near"), F.lit(length).alias("far"))
    found = whole.unionByName(ranges).unionByName(single).groupBy(*key).agg(F.collect_list(F.struct("near", "far")).alias("ranges"))
    found = Written(found, "ranges").df
    placed = kept.df.join(found, key).select("digest", "a", "lo", "hi", F.explode("ranges").alias("r")).select(
        "digest",
        (F.col("a") - F.least("r.far", F.col("a") - F.col("lo"))).alias("begin"),
        (F.col("a") - F.greatest("r.near", F.col("a") - F.col("hi")) + length).alias("end"))
    # Written for the same reason as the other sides: all copies of a text join it.
    return Written(placed.groupBy("digest").agg(F.collect_set(F.struct("begin", "end")).alias("spans")), "removed").df


def removed_runs(spans) -> np.ndarray:
    """Maximal runs of removed bytes, as an (n, 2) array."""
    if spans is None or not len(spans):
        return np.empty((0, 2), np.int64)
    return runs_of(*np.array([(s["begin"], s["end"]) for s in spans], np.int64).T)


def cut_out(text: bytes, runs: np.ndarray) -> bytes:
    at, kept = 0, []
    for a, b in runs.tolist():
        kept.append(text[at:a])
        at = b
    kept.append(text[at:])
    return b"".join(kept)


def _defaults(length: int, gram: int | None, piece: int | None) -> tuple[int, int]:
    return gram or max(1, length * 4 // 25), piece or max(1, min(PIECE, length // 2))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400, gram: int | None = None,
          piece: int | None = None, group: int = GROUP, unit: int = UNIT, shard: int = SHARD) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans (maximal
    removed runs), kept_sha256, and ``spans``, the runs themselves."""
    gram, piece = _defaults(length, gram, piece)
    d = docs.select(F.col(f"`{id_col}`").alias("_id"), text_bytes(text_col).alias("t"))
    d = d.select("_id", F.col("_id").cast("string").alias("doc_id"), F.unhex(F.md5("t")).alias("digest"), "t")
    found = repeated_bytes(d.drop("_id"), length, gram, piece, group, unit, shard).withColumnRenamed("digest", "_d")

    @F.pandas_udf("n_removed long, n_spans long, kept_sha256 string, spans array<struct<begin:long,end:long>>")
    def outcome(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        rows = []
        for t, s in zip(texts, spans):
            runs = removed_runs(s)
            rows.append((int((runs[:, 1] - runs[:, 0]).sum()), len(runs), hashlib.sha256(cut_out(bytes(t), runs)).hexdigest(),
                         [{"begin": a, "end": b} for a, b in runs.tolist()]))
        return pd.DataFrame(rows, columns=["n_removed", "n_spans", "kept_sha256", "spans"])

    joined = d.join(found, d.digest == found._d, "left")
    return joined.select(F.col("_id").alias("doc_id"), F.length("t").cast("long").alias("n_bytes"), outcome("t", "spans").alias("o")).select("doc_id", "n_bytes", "o.*")


def without_repeats(docs: DataFrame, text_col: str = "text", length: int = 400) -> DataFrame:
    """The documents with repeated strings cut out of their texts, with the
    input's columns. Bytes of a character that is cut through go with it; a null
    text stays null."""
    gram, piece = _defaults(length, None, None)
    d = docs.select(F.struct("*").alias("_row"), text_bytes(text_col).alias("t"))
    d = d.select("_row", F.unhex(F.md5("t")).alias("digest"), "t")
    found = repeated_bytes(d.select("digest", F.lit("").alias("doc_id"), "t"), length, gram, piece, GROUP, UNIT, SHARD).withColumnRenamed("digest", "_d")

    @F.pandas_udf("string")
    def kept(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([cut_out(bytes(t), removed_runs(s)).decode("utf-8", "ignore") for t, s in zip(texts, spans)])

    joined = d.join(found, d.digest == found._d, "left")
    new = F.when(F.col("spans").isNotNull(), kept("t", "spans")).otherwise(F.col("_row").getField(text_col))
    return joined.select("_row", new.alias("_new")).select(F.col("_row").withField(f"`{text_col}`", F.col("_new")).alias("_row")).select("_row.*")
