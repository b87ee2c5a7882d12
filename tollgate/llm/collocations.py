"""Collocations of two and three words by best-first branch-and-bound growth.

Everything is counted for each language. A phrase of a occurrences that is cut
into a first part of l and a rest of r occurrences scores
floor(1000000 * a * a / (l * r)); the lowest-scoring cut counts.

Phrases grow to the right, from a word to pairs to triples, and only from
prefixes that may still matter:

- A word with fewer than ``min_count`` occurrences begins and ends no candidate.
- No triple with prefix (u, v) has more occurrences than the prefix, and its
  rest has at least as many as itself, so that cutting after u scores at most
  floor(1000000 * f(u v) / f(u)). That is the prefix's bound.

The frontier is settled in steps of falling scores, for each language apart.
In a step with threshold t, all prefixes with a bound of at least t are grown.
So are the triples that end in a pair which itself scores t or more, since they
decide whether that pair is dropped. After the step every candidate of score t
or more is known, and whether a longer candidate drops it. Once ``top``
survivors score t or more, the last of them and all its ties are settled, and
prefixes with a lower bound are never grown. Otherwise t falls; with t = 0
everything has been grown.

Texts are tokenised once, into chunks of word numbers with the chunk's own
vocabulary. Counting passes sum up within a chunk by numpy before Spark's
partial aggregation. Sets of words and pairs to grow go to the tasks as hashed
bit sets of a fixed size; a chance hit costs a count that is not needed and
changes no result. Nothing else is sent, and per language the driver learns
whether the search goes on (a count of languages).

Defined cases: a null or empty text has no words; a null language is ``und`` and
joins rows whose language is that text; repeated rows count each time; ties at
the last score are cut by the order (score and a falling, phrase rising by
bytes); a very long text is tokenised in blocks and may span chunks, its words
and pieces being the same as without (a chunk begins with the two words before
it, which are not counted again); one word longer than a block is held whole;
an empty table gives no rows; extra columns are left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollgate.llm.common import Written

#: Characters between pieces; tab and space stand between words.
SEPARATORS = b".,;:!?\n\x0b\x0c\r"
#: Lower-cases A-Z, makes every separator a full stop and a tab a space.
TABLE = bytes.maketrans(bytes(range(65, 91)) + SEPARATORS + b"\t", bytes(range(97, 123)) + b"." * len(SEPARATORS) + b" ")
BOUNDARY = re.compile(rb"[ \t.,;:!?\n-\r]")
#: Words of a chunk, bytes of a text that are tokenised at a time.
CHUNK, BLOCK = 1 << 19, 1 << 20
#: Bits of a set; 2 ** 23 are one megabyte.
BITS = 23
#: Candidates above the first threshold for each result wanted, and the factor from step to step.
FIRST, WIDER = 2, 8


class Numbers(dict):
    """Numbers words as they come; 0 is the boundary between pieces."""

    def __init__(self):
        super().__init__({b".": 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def blocks(text: bytes) -> Iterator[bytes]:
    """The text in blocks that end at a boundary."""
    at = 0
    while len(text) - at > BLOCK:
        end = max(text.rfind(bytes([c]), at, at + BLOCK) for c in SEPARATORS + b" \t") + 1
        if end <= at:
            found = BOUNDARY.search(text, at + BLOCK)
            end = found.end() if found else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


CHUNKS = "lang string, lead int, ids binary, n_ids int, words binary, n_words int"
#: Codec of a chunk's numbers and words, which are handed about whole.
CODEC = "zstd"


class Chunk:
    def __init__(self, context: list[bytes] = ()):
        self.numbers, self.n, self.parts = Numbers(), 0, []
        self.lead = len(context)
        if context:
            self.add(context)
        self.n = 0

    def add(self, words: list[bytes]) -> None:
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
        self.n += len(words)

    def row(self, lang: str) -> tuple:
        ids, words = np.concatenate(self.parts).tobytes(), b" ".join(self.numbers)  # no word has a space
        return lang, self.lead, pa.compress(ids, CODEC, asbytes=True), len(ids), pa.compress(words, CODEC, asbytes=True), len(words)


def tokenise(chunk: int):
    """Arrow function: (lang, t) to chunks of word numbers."""

    def batch(rows):
        types = pa.string(), pa.int32(), pa.binary(), pa.int32(), pa.binary(), pa.int32()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), types)], ["lang", "lead", "ids", "n_ids", "words", "n_words"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[str, Chunk] = {}
        for b in batches:
            for lang, t in zip(b.column("lang").to_pylist(), b.column("t")):
                t = t.as_py()
                if lang not in open_:
                    open_[lang] = Chunk()
                for block in blocks(t):
                    words = block.translate(TABLE).replace(b".", b" . ").split()
                    for at in range(0, len(words), chunk):
                        part = words[at:at + chunk]
                        c = open_[lang]
                        c.add(part)
                        if c.n >= chunk:
                            yield batch([c.row(lang)])
                            before = list(c.numbers)
                            tail = np.concatenate(c.parts[-2:])[-2:]
                            open_[lang] = Chunk([before[i] for i in tail])
                open_[lang].parts.append(np.zeros(1, np.int32))
            if sum(c.n for c in open_.values()) >= chunk:
                yield from (batch([c.row(lang)]) for lang, c in open_.items() if c.n)
                open_ = {}
        yield from (batch([c.row(lang)]) for lang, c in open_.items() if c.n)

    return run


def _rotated(h: np.ndarray) -> np.ndarray:
    return (h << np.uint64(21)) | (h >> np.uint64(43))


def _hashes(lang: str, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word after its language's, and of each word alone."""
    alone = np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in words), np.uint64, len(words))
    return _rotated(np.full(len(words), xxhash.xxh64_intdigest(lang.encode(), 42), np.uint64)) ^ alone, alone


def _place(words: list[str], bits: int) -> Column:
    """The same hash as a column expression: the place of (lang, words) in a bit set."""
    h = F.xxhash64(F.col("lang"))
    for w in words:
        h = F.shiftleft(h, 21).bitwiseOR(F.shiftrightunsigned(h, 43)).bitwiseXOR(F.xxhash64(F.col(w)))
    return h.bitwiseAND(F.lit((1 << bits) - 1))


def bit_set(df: DataFrame, words: list[str], bits: int) -> np.ndarray:
    """The (lang, words) of ``df`` as a set of 2 ** bits bits, whatever their number."""
    place = _place(words, bits) + 1  # Spark numbers places from 1, 32,768 a bucket
    rows = df.groupBy(F.bitmap_bucket_number(place).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("m")).collect()
    out = np.zeros(max(1 << bits, 1 << 15) // 8, np.uint8)
    for r in rows:
        out[(r.b - 1) * 4096:r.b * 4096] = np.frombuffer(bytes(r.m), np.uint8)
    return out


def _within(members: np.ndarray, places: np.ndarray, bits: int) -> np.ndarray:
    p = places & np.uint64((1 << bits) - 1)
    return (members[(p >> np.uint64(3)).astype(np.int64)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _chunk_rows(batches: Iterator[pa.RecordBatch]):
    """(language, words before the chunk, numbers, words) of each chunk."""
    for b in batches:
        for i in range(b.num_rows):
            lang, lead, ids, n_ids, words, n_words = (c[i].as_py() for c in b.columns)
            yield lang, lead, np.frombuffer(pa.decompress(ids, n_ids, CODEC), np.int32), pa.decompress(words, n_words, CODEC, asbytes=True).split(b" ")


def _counted(lang: str, columns: list[np.ndarray], words, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    names, words = ["w1", "w2", "w3"][:len(columns)], pa.array(words, pa.binary())
    for at in range(0, len(n), 1 << 15):
        part = [words.take(pa.array(c[at:at + (1 << 15)])) for c in columns]
        k = n[at:at + (1 << 15)]
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(k), pa.string()), *part, pa.array(k.astype(np.int64))], ["lang", *names, "n"])


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow function: chunks to (lang, w1, n)."""
    for lang, lead, ids, words in _chunk_rows(batches):
        n = np.bincount(ids[lead:], minlength=len(words))
        n[0] = 0
        some = np.flatnonzero(n)
        yield from _counted(lang, [some], words, n[some])


def _runs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys and their counts; sorts ``key`` in place."""
    key.sort()
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
    return key[start], np.diff(np.r_[start, len(key)])


def _frequent_places(ids: np.ndarray, after: np.ndarray, frequent: np.ndarray, bits: int) -> np.ndarray:
    """For each place, whether a frequent word stands there."""
    good = _within(frequent, after, bits)
    good[0] = False
    return good[ids]


def count_pairs(frequent: np.ndarray, bits: int):
    """Arrow function: chunks to (lang, w1, w2, n) of pairs of frequent words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, lead, ids, words in _chunk_rows(batches):
            ids = ids[max(0, lead - 1):]  # a pair of the two words before the chunk is counted there
            after, _ = _hashes(lang, words)
            ok = _frequent_places(ids, after, frequent, bits)
            at = np.flatnonzero(ok[:-1] & ok[1:])
            key = ids[at].astype(np.int64)
            key *= len(words)
            key += ids[at + 1]
            k, n = _runs(key)
            yield from _counted(lang, [k // len(words), k % len(words)], words, n)

    return run


def count_triples(frequent: np.ndarray, grow: tuple[np.ndarray, np.ndarray], grown: tuple[np.ndarray, np.ndarray] | None, bits: int):
    """Arrow function: chunks to (lang, w1, w2, w3, n) of triples whose first
    pair is in the first set of ``grow`` or last pair in the second, and that
    ``grown`` did not hold likewise."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, _, ids, words in _chunk_rows(batches):
            after, alone = _hashes(lang, words)
            ok = _frequent_places(ids, after, frequent, bits)
            take = ok[:-2] & ok[1:-1] & ok[2:]
            pair = _rotated(after)[ids[:-1]]
            pair ^= alone[ids[1:]]
            within = lambda s: _within(s[0], pair[:-1], bits) | _within(s[1], pair[1:], bits)
            take &= within(grow)
            if grown is not None:
                take &= ~within(grown)
            at = np.flatnonzero(take)
            pairs = ids[at].astype(np.int64) * len(words) + ids[at + 1]
            k, _ = _runs(pairs.copy())  # numbered, so that a triple's key stays within 64 bits
            key = np.searchsorted(k, pairs) * len(words) + ids[at + 2]
            t, n = _runs(key)
            p = k[t // len(words)] if len(t) else t
            yield from _counted(lang, [p // len(words), p % len(words), t % len(words)], words, n)

    return run


def _score(a: str, left: str, right: str) -> Column:
    big = lambda c: f"cast({c} as decimal(38,0))"
    return F.expr(f"{big(1000000)} * {big(a)} * {big(a)} div ({big(left)} * {big(right)})")


def _lowest_cut(cuts: list[tuple[str, str]]) -> Column:
    """Struct (score, k, l, r) of the cut with the lowest score, then lowest k."""
    return F.least(*[F.struct(_score("a", left, right).alias("score"), F.lit(k).alias("k"), F.col(left).alias("l"), F.col(right).alias("r"))
                     for k, (left, right) in enumerate(cuts, 1)]) if len(cuts) > 1 else F.struct(
        _score("a", *cuts[0]).alias("score"), F.lit(1).alias("k"), F.col(cuts[0][0]).alias("l"), F.col(cuts[0][1]).alias("r"))


def _named(df: DataFrame, **names: str) -> DataFrame:
    return df.select(*[F.col(old).alias(new) for new, old in names.items()])


def _thresholds(two: DataFrame, wanted: int, settled: DataFrame | None) -> DataFrame:
    """(lang, t): a score that about ``wanted`` pairs reach, 0 with fewer pairs.
    From a histogram of scores, so no language is sorted; a settled one keeps its t."""
    bins = two.groupBy("lang", F.floor(F.log2(F.col("score") + 1) * 16).alias("bin")).agg(F.count("*").alias("n"), F.min("score").alias("low"))
    above = F.sum("n").over(Window.partitionBy("lang").orderBy(F.desc("bin")))
    t = bins.withColumn("above", above).groupBy("lang").agg(F.coalesce(F.max(F.when(F.col("above") >= wanted, F.col("low"))), F.lit(0)).alias("t"))
    if settled is None:
        return t
    return t.join(_named(settled, l="lang", s="t"), F.col("lang") == F.col("l"), "left").select("lang", F.coalesce("s", "t").alias("t"))


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", top: int = 2000, min_count: int = 10, cover: int = 50,
                 bits: int = BITS, chunk: int = CHUNK, first: int = FIRST, wider: int = WIDER) -> DataFrame:
    """Each language's first ``top`` phrases of two or three words with at least
    ``min_count`` occurrences, without those whose words stand in a longer
    candidate with at least ``cover`` percent of their count: lang, rank, phrase,
    a, l, r, n, score. Building the plan runs the search."""
    texts = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text_col}`").cast("binary").alias("t"))
    chunks = Written(texts.filter(F.length("t") > 0).mapInArrow(tokenise(chunk), CHUNKS), "chunks").df
    words = Written(chunks.mapInArrow(count_words, "lang string, w1 binary, n long").groupBy("lang", "w1").agg(F.sum("n").alias("n")), "words").df
    sizes = Written(words.groupBy("lang").agg(F.sum("n").alias("n")), "sizes").df
    frequent = words.filter(F.col("n") >= min_count)
    word_set = bit_set(frequent, ["w1"], bits)
    pairs = chunks.mapInArrow(count_pairs(word_set, bits), "lang string, w1 binary, w2 binary, n long")
    pairs = Written(pairs.groupBy("lang", "w1", "w2").agg(F.sum("n").alias("a")).filter(F.col("a") >= min_count), "pairs").df
    two = pairs.join(_named(frequent, lang="lang", w1="w1", f1="n"), ["lang", "w1"]).join(_named(frequent, lang="lang", w2="w1", f2="n"), ["lang", "w2"])
    bound = F.expr("1000000 * cast(a as decimal(38,0)) div cast(f1 as decimal(38,0))")
    two = Written(two.withColumn("cut", _lowest_cut([("f1", "f2")])).select("lang", "w1", "w2", "a", "cut", F.col("cut.score").alias("score"), bound.alias("bound")), "scored-pairs").df
    counted, grown, settled, wanted = [], None, None, first * top
    while True:
        t = Written(_thresholds(two, wanted, settled), "thresholds").df
        active = two.join(t, "lang")
        grow = bit_set(active.filter("bound >= t"), ["w1", "w2"], bits), bit_set(active.filter("score >= t"), ["w1", "w2"], bits)
        new = chunks.mapInArrow(count_triples(word_set, grow, grown, bits), "lang string, w1 binary, w2 binary, w3 binary, n long")
        new = Written(new.groupBy("lang", "w1", "w2", "w3").agg(F.sum("n").alias("a")).filter(F.col("a") >= min_count), "triples").df
        counted.append(new)
        three = reduce(DataFrame.unionByName, counted)
        best = Written(_best(three, pairs, frequent, two, t, top, cover), "best").df
        have = best.groupBy("lang").agg(F.count("*").alias("have"))
        state = Written(t.join(have, "lang", "left").withColumn("open", (F.coalesce("have", F.lit(0)) < top) & (F.col("t") > 0)), "state").df
        if not state.filter("open").count():
            break
        settled, grown, wanted = state.filter(~F.col("open")).select("lang", "t"), grow, wanted * wider
    return best.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _best(three: DataFrame, pairs: DataFrame, frequent: DataFrame, two: DataFrame, t: DataFrame, top: int, cover: int) -> DataFrame:
    """The first ``top`` survivors of score t or more of each language."""
    three = Written(
        three.join(_named(frequent, lang="lang", w1="w1", f1="n"), ["lang", "w1"])
        .join(_named(frequent, lang="lang", w3="w1", f3="n"), ["lang", "w3"])
        .join(_named(pairs, lang="lang", w1="w1", w2="w2", f12="a"), ["lang", "w1", "w2"])
        .join(_named(pairs, lang="lang", w2="w1", w3="w2", f23="a"), ["lang", "w2", "w3"])
        .withColumn("cut", _lowest_cut([("f1", "f23"), ("f12", "f3")])), "scored-triples").df
    inside = _named(three, lang="lang", w1="w1", w2="w2", a="a").unionByName(_named(three, lang="lang", w1="w2", w2="w3", a="a"))
    inside = Written(inside.groupBy("lang", "w1", "w2").agg(F.max("a").alias("longest")), "inside").df
    space = F.lit(b" ")
    phrase = lambda *w: F.concat(*[x for c in w for x in (space, F.col(c))][1:]).cast("string")
    alive = two.join(inside, ["lang", "w1", "w2"], "left").filter(F.col("longest").isNull() | (100 * F.col("longest") < cover * F.col("a")))
    alive = alive.select("lang", phrase("w1", "w2").alias("phrase"), "a", "cut").unionByName(three.select("lang", phrase("w1", "w2", "w3").alias("phrase"), "a", "cut"))
    alive = alive.join(t, "lang").filter("cut.score >= t")
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    return alive.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "cut.score")
