"""Best-two-fit packing of tokenised documents into fixed-length sequences.

Documents are tokenised in Arrow batches; those over the capacity are cut into
whole pieces, the first of which may be shorter. Pieces shorter than the
capacity are dealt by a hash to bins of a bounded number of pieces, each packed
on its own: that costs at most about one open sequence for each deal. Within a
deal: pieces fill a sequence greedily, the longest that fits first; then the
sequence's smallest piece is taken out and the two unpacked pieces that fill
the larger gap best are put in, if that leaves less room than before.

Defined cases: a null or empty text is the end id alone; a null doc_id stays
null; repeated rows are packed each; an empty table has no sequences; extra
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import Written

#: Pieces that one packing task gets, about.
DEAL = 100_000


#: Fixed value: how byte-level BPE cuts a text before it merges bytes.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Encoder:
    """Token ids (little-endian uint32 bytes) of texts, as ``tokenizers`` gives
    them for the file, without added special tokens.

    Where the file is plain byte-level BPE whose merges are numbered in order
    (checked on loading), the same vocabulary runs in ``tiktoken``, which takes
    half the time; texts with a special token's string, texts that ``tiktoken``
    refuses (its regex backtracks, and gives up on about a million white-space
    characters in a row), and files of any other kind, go through ``tokenizers``.
    """

    def __init__(self, path: str):
        import json
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as f:
            self.fast = self.byte_level(json.load(f))

    @staticmethod
    def byte_level(spec: dict):
        """A tiktoken encoding equal to the file, or None."""
        import tiktoken

        model, split = spec["model"], spec["pre_tokenizer"] or {}
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges") if model.get(k)]
        if model["type"] != "BPE" or odd or spec["normalizer"] or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
            return None
        # Byte-level vocabularies write printable bytes as themselves and the others from U+0100 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letter = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in shown)}
        special = {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(letter[c] for c in piece): i for piece, i in model["vocab"].items() if piece not in special}
        merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if merged != sorted(merged) or len(ranks) != 256 + len(merged):
            return None
        return tiktoken.Encoding("file", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> bytes:
        if self.fast and not any(x in text for x in self.special):
            try:
                return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()
            except ValueError:  # the regex gave up on the text
                pass
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(path: str, capacity: int, end_id: int):
    """Arrow function: (doc_id, t) to piece rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(path)
        end = np.array([end_id], "<u4").tobytes()
        for b in batches:
            rows = []
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("t")):
                raw = encode(text.as_py()) + end
                n = len(raw) // 4
                start, length, k = 0, n if n <= capacity else n % capacity or capacity, 0
                while start < n:
                    rows.append((doc_id, k, start, length, zlib.crc32(raw[4 * start:4 * (start + length)])))
                    start, length, k = start + length, capacity, k + 1
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


class Stock:
    """Unpacked pieces by length, with the lengths present as a bit set."""

    def __init__(self, lengths: np.ndarray, capacity: int):
        order = np.argsort(lengths, kind="stable")
        bounds = np.searchsorted(lengths[order], np.arange(capacity + 2))
        self.pieces = [order[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
        self.present = sum(1 << k for k, p in enumerate(self.pieces) if p)

    def longest(self, room: int) -> int:
        """The greatest length present up to ``room``; 0 if none."""
        return (self.present & ((2 << room) - 1)).bit_length() - 1 if room > 0 and self.present & ((2 << room) - 1) else 0

    def take(self, length: int) -> int:
        piece = self.pieces[length].pop()
        if not self.pieces[length]:
            self.present ^= 1 << length
        return piece

    def put(self, piece: int, length: int) -> None:
        self.pieces[length].append(piece)
        self.present |= 1 << length

    def best_two(self, room: int, more_than: int) -> tuple[int, int] | None:
        """Two lengths of unpacked pieces with the greatest sum up to ``room``
        and over ``more_than``; of equal sums, that with the longest piece."""
        best, pair = more_than, None
        long = self.longest(room - 1)
        while long * 2 > best:
            short = self.longest(min(long, room - long))
            if short == long and len(self.pieces[long]) < 2:
                short = self.longest(long - 1)
            if short and long + short > best:
                best, pair = long + short, (long, short)
                if best == room:
                    break
            long = self.longest(long - 1)
        return pair


def best_two_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of every piece."""
    stock = Stock(lengths, capacity)
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    n = 0
    while stock.present:
        packed, room = [], capacity
        while size := stock.longest(room):
            packed.append((stock.take(size), size))
            room -= size
        if room and stock.present:
            piece, least = packed[-1]  # greedy takes lengths in falling order
            if pair := stock.best_two(room + least, least):
                packed[-1:] = [(stock.take(x), x) for x in pair]
                stock.put(piece, least)
        at = 0
        for piece, size in packed:
            sequence[piece], offset[piece] = n, at
            at += size
        n += 1
    return sequence, offset


PACKED = PIECE + ", sequence_id long, offset long"


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048,
         end_id: int = 0, deal: int = DEAL) -> DataFrame:
    """One row for each piece, with its sequence and its place there."""
    d = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("t"))
    pieces = Written(d.mapInArrow(cut(tokenizer_path, capacity, end_id), PIECE).withColumn("rid", F.monotonically_increasing_id()), "pieces").df
    whole = pieces.filter(F.col("length") == capacity)
    short = pieces.filter(F.col("length") < capacity)
    deals = max(1, -(-short.count() // deal))

    def pack_deal(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rid", ignore_index=True)
        sequence, offset = best_two_fit(pdf["length"].to_numpy(), capacity)
        # Odd numbers, apart for each deal; whole pieces have even ones.
        return pdf.assign(sequence_id=2 * (sequence * deals + key[0]) + 1, offset=offset).drop(columns=["rid", "deal"])

    dealt = short.withColumn("deal", F.pmod(F.xxhash64("rid"), F.lit(deals)).cast("long"))
    packed = dealt.groupBy("deal").applyInPandas(pack_deal, PACKED)
    alone = whole.withColumn("sequence_id", F.col("rid") * 2).withColumn("offset", F.lit(0).cast("long")).drop("rid")
    return packed.unionByName(alone)
