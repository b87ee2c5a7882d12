"""Language identification with mixtures: each document is a blend of languages.

Learning: byte trigrams of lower-cased words (with a space on either side) are
hashed to ``BUCKETS`` and counted for each language over all training texts, in
the tasks first, then by a grouped sum. Only the languages times buckets table
comes to the driver, whatever the number of documents.

Prediction: the likelihood of each word under each language is the product of
its trigrams'. Expectation-maximisation over the document's words estimates the
languages' proportions; the set of languages is chosen by penalised likelihood
(each language beyond the first must raise the log-likelihood by
``penalty * log(words)``), adding the language that gains most while it pays.
The likelihood of all languages together bounds that of any set: where it beats
the best single language by less than one penalty, no other set is tried.

Defined cases: ``und`` with score 0 for texts without a letter (null and empty
ones too) and where nothing was learnt; texts without a lang are not learnt
from; of equal proportions the language that sorts first wins; repeated rows
are judged each; extra columns are ignored; an empty table gives no rows. Digits,
number forms, fractions and marks are no letters. A very long text is scored in
blocks of words; its task holds its trigrams' numbers and a row of scores a word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import crc_bucket

BUCKETS = 1 << 15
#: More languages than this are refused: the model is sent to every task.
MOST_LANGUAGES = 512
#: Words that are scored at a time.
WORDS = 1 << 15
#: Word characters but for digits and the underscore: letters, and some numbers.
RUNS = re.compile(r"[^\W\d_]+")


def letters_of(text: str) -> list[str]:
    """Runs of letters (general categories L*)."""
    runs = RUNS.findall(text)
    if all(map(str.isalpha, runs)):
        return runs
    return [w for run in runs for w in (run if run.isalpha() else "".join(c if c.isalpha() else " " for c in run)).split()]


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of a text's words, and where each word's begin."""
    words = letters_of(text.lower())
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    raw = np.frombuffer((" " + " ".join(words) + " ").encode("utf-8", "replace"), np.uint8).astype(np.uint32)
    h = (raw[:-2] * np.uint32(0x9E3779B1) ^ raw[1:-1] * np.uint32(0x85EBCA77) ^ raw[2:] * np.uint32(0xC2B2AE3D)) * np.uint32(0x27D4EB2F)
    inside = raw[1:-1] != 32  # trigrams around a space between words belong to none
    first = np.flatnonzero(raw[:-1] == 32)
    starts = np.cumsum(inside)[first] - 1  # the trigram at a word's leading space is its first
    return (h >> np.uint32(17)).astype(np.int64)[inside], starts


def word_scores(table: np.ndarray, grams: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Log-likelihoods by word and language, a block of words at a time."""
    ends = np.r_[starts[1:], len(grams)]
    out = np.empty((len(starts), table.shape[1]))
    for a in range(0, len(starts), WORDS):
        lo, hi = starts[a], ends[min(a + WORDS, len(ends)) - 1]
        out[a:a + WORDS] = np.add.reduceat(table[grams[lo:hi]], starts[a:a + WORDS] - lo, axis=0)
    return out


def em(likelihood: np.ndarray, weights: np.ndarray, rounds: int = 60, tolerance: float = 1e-6) -> tuple[np.ndarray, float]:
    """Proportions of the columns and the log-likelihood that they give."""
    last = -np.inf
    for _ in range(rounds):
        total = likelihood @ weights
        now = float(np.log(total).sum())
        weights = weights * (likelihood / total[:, None]).mean(axis=0)
        if now - last < tolerance * max(1.0, abs(now)):
            break
        last = now
    return weights, float(np.log(likelihood @ weights).sum())


def mixture(words: np.ndarray, penalty: float) -> tuple[list[int], np.ndarray]:
    """The chosen languages and their proportions, from log-likelihoods by word
    and language."""
    top = words.max(axis=1, keepdims=True)
    likelihood = np.maximum(np.exp(words - top), 1e-30)
    n, k = likelihood.shape
    price = penalty * np.log(max(n, 2))
    single = np.log(likelihood).sum(axis=0)
    chosen = [int(single.argmax())]
    weights, best = np.ones(1), float(single.max())
    if k > 1 and em(likelihood, np.full(k, 1 / k))[1] - best > price:
        while len(chosen) < k:
            tried = []
            for extra in set(range(k)) - set(chosen):
                own = [*chosen, extra]
                w, value = em(likelihood[:, own], np.full(len(own), 1 / len(own)))
                tried.append((value, -extra, own, w))
            value, _, own, w = max(tried)
            if value - best <= price:
                break
            chosen, weights, best = own, w, value
    return chosen, weights


def learn(docs: DataFrame, lang_col: str, text_col: str) -> tuple[list[str], np.ndarray]:
    """Languages in order and the log-probability of every bucket in each."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, t in zip(b.column("lang").to_pylist(), b.column("t")):
                grams, _ = trigrams(t.as_py())
                if lang not in sums:
                    sums[lang] = np.zeros(BUCKETS, np.int64)
                sums[lang] += np.bincount(grams, minlength=BUCKETS)
        for lang, c in sums.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(c[at])], ["lang", "bucket", "n"])

    d = docs.filter(F.col(f"`{lang_col}`").isNotNull() & F.col(f"`{text_col}`").isNotNull())
    d = d.select(F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").alias("t"))
    if d.select("lang").distinct().count() > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    rows = d.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names = rows.column("lang").combine_chunks().dictionary_encode()  # at most MOST_LANGUAGES * BUCKETS rows
    if isinstance(names, pa.ChunkedArray):
        names = names.combine_chunks()
    languages = sorted(names.dictionary.to_pylist())
    at = np.array([languages.index(x) for x in names.dictionary.to_pylist()], np.int64)
    table = np.full((BUCKETS, len(languages)), 0.5)
    if languages:
        table[rows.column("bucket").to_numpy(), at[names.indices.to_numpy()]] += rows.column("n").to_numpy()
    return languages, np.log(table / table.sum(axis=0)).astype(np.float32) if languages else table.astype(np.float32)


PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double, languages array<struct<lang:string,share:double>>"


def predict(docs: DataFrame, languages: list[str], table: np.ndarray, penalty: float = 2.0) -> DataFrame:
    """From rows (doc_id, held_out, t)."""
    sent = docs.sparkSession.sparkContext.broadcast(table)  # at most MOST_LANGUAGES * BUCKETS floats

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        for b in batches:
            rows = []
            for t in b.column("t"):
                grams, starts = trigrams(t.as_py())
                if not len(starts) or not languages:
                    rows.append(("und", 0.0, []))
                    continue
                chosen, weights = mixture(word_scores(table, grams, starts), penalty)
                order = sorted(range(len(chosen)), key=lambda i: (-weights[i], chosen[i]))
                shares = [{"lang": languages[chosen[i]], "share": float(weights[i])} for i in order]
                rows.append((shares[0]["lang"], min(1.0, shares[0]["share"]), shares))
            pred, score, shares = zip(*rows) if rows else ((), (), ())
            kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(shares, kind)],
                ["doc_id", "held_out", "lang_pred", "score", "languages"])

    return docs.mapInArrow(run, PREDICTED)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", penalty: float = 2.0) -> DataFrame:
    """Learn from documents outside the held-out third, predict all."""
    held_out = crc_bucket(id_col, 3) == 1
    languages, table = learn(docs.filter(~held_out), lang_col, text_col)
    d = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), held_out.alias("held_out"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("t"))
    return predict(d, languages, table, penalty)
