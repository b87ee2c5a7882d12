"""Quality classifier: ridge regression on random Fourier features.

Documents become a few statistics of their whole text. Standardised, they pass
through ``features`` random cosines, which approximate a Gaussian kernel; a
ridge fit on the labels needs only the normal equations, summed in each
partition and then by a grouped sum, so the driver gets one matrix of a fixed
size from any number of rows. The raw scores are calibrated by isotonic
regression over ``BINS`` equal bins of the training scores (counts and label
sums of all training rows), so scores are frequencies of label 1.

All labelled training rows are used. Random numbers come from a fixed seed.

Defined cases: null or empty texts have the statistics of no words and get the
score that such documents earn; labels that are null or not 0 or 1 are left
out, and several labels of a document count each; with no usable label every
score is 0.5; repeated rows are scored each; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import Written, crc_bucket, text_bytes

FEATURES = 256
BINS = 4096
RIDGE = 1e-3
SEED = 7

_BYTES = np.arange(256)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_LETTER = _UPPER | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_SPACE = (_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13))
_MARK = ~(_LETTER | _DIGIT | _SPACE)
_SYMBOL = np.isin(_BYTES, list(b"#*$%&|<>"))
_STOP = np.isin(_BYTES, list(b".,;:"))

STATISTICS = ("words", "word_bytes", "upper", "digits", "marks", "symbols", "stops", "wide", "lines", "distinct", "repeated", "pairs", "equal_lines", "end_marks", "longest")


def statistics(text: bytes) -> list[float]:
    """The statistics of a text, in the order of STATISTICS; shares are of all
    bytes or words."""
    n = max(1, len(text))
    hist = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    words = text.split()
    w = max(1, len(words))
    lines = [x for x in text.split(b"\n") if x.strip()]
    pairs = list(zip(words, words[1:]))
    p = max(1, len(pairs))
    return [
        float(np.log1p(len(words))), float(np.log1p((n - hist[_SPACE].sum()) / w)), hist[_UPPER].sum() / n, hist[_DIGIT].sum() / n, hist[_MARK].sum() / n,
        float(np.log1p(hist[_SYMBOL].sum() / w)), hist[_STOP].sum() / w, hist[128:].sum() / n, float(np.log1p(w / max(1, len(lines)))),
        len(set(words)) / w, sum(a == b for a, b in pairs) / p, len(set(pairs)) / p, (len(lines) - len(set(lines))) / max(1, len(lines)),
        sum(x[-1:] in b".,!?" for x in words) / w, float(np.log1p(max(map(len, words), default=0))),
    ]


def add_statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [statistics(t.as_py()) for t in b.column("t")]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(rows, pa.list_(pa.float64()))], ["doc_id", "held_out", "x"])


class Fourier:
    """Random Fourier features of standardised statistics, a constant last."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, features: int, width: float, seed: int):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        self.w = rng.normal(size=(len(mean), features)) / width
        self.b = rng.uniform(0, 2 * np.pi, features)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8) @ self.w + self.b
        return np.column_stack([np.sqrt(2 / len(self.b)) * np.cos(z), np.ones(len(x))])


def normal_equations(labelled: DataFrame, fourier: Fourier) -> tuple[np.ndarray, np.ndarray]:
    """Sums of z z' and z y over rows (x, y)."""
    size = len(fourier.b) + 1

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        for b in batches:
            if b.num_rows:
                z = fourier(np.array(b.column("x").to_pylist()))
                total += z.T @ np.column_stack([z, b.column("y").to_numpy()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["i", "v"])

    rows = labelled.select("x", "y").mapInArrow(sums, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).toPandas()
    total = np.zeros(size * (size + 1))
    total[rows["i"].to_numpy()] = rows["v"].to_numpy()
    total = total.reshape(size, size + 1)
    return total[:, :size], total[:, size]


def isotonic(weight: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: the non-decreasing fit of bin means."""
    pooled: list[list[float]] = []
    for w, v in zip(weight.tolist(), value.tolist()):
        pooled.append([w, v, 1])
        while len(pooled) > 1 and pooled[-2][1] * pooled[-1][0] >= pooled[-1][1] * pooled[-2][0]:
            w2, v2, n2 = pooled.pop()
            pooled[-1] = [pooled[-1][0] + w2, pooled[-1][1] + v2, pooled[-1][2] + n2]
    return np.concatenate([np.full(int(n), v / w) for w, v, n in pooled])


class Model:
    """Ridge weights and the calibration of their scores."""

    def __init__(self, fourier: Fourier | None, beta: np.ndarray | None = None):
        self.fourier, self.beta = fourier, beta
        self.centres, self.levels = np.array([0.0]), np.array([0.5])

    def bins(self, x: np.ndarray) -> np.ndarray:
        """Raw scores, about 0 to 1, in bins from -0.5 to 1.5."""
        raw = self.fourier(x) @ self.beta
        return np.clip(((raw + 0.5) * (BINS / 2)).astype(np.int64), 0, BINS - 1)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.fourier is None:
            return np.full(len(x), 0.5)
        return np.clip(np.interp(self.bins(x), self.centres, self.levels), 0.0, 1.0)


def fit(labelled: DataFrame, features: int = FEATURES, ridge: float = RIDGE, width: float | None = None, seed: int = SEED) -> Model:
    """A model from rows (x, y)."""
    k = len(STATISTICS)
    x = [F.col("x")[i] for i in range(k)]
    got = labelled.agg(F.count("*").alias("n"), *(f(c).alias(f"{name}{i}") for i, c in enumerate(x) for name, f in (("m", F.avg), ("s", F.stddev_pop)))).first()
    if not got.n:
        return Model(None)
    mean, scale = (np.array([got[f"{name}{i}"] for i in range(k)]) for name in "ms")
    fourier = Fourier(mean, np.where(scale > 1e-9, scale, 1.0), features, width or np.sqrt(k), seed)
    a, b = normal_equations(labelled, fourier)
    model = Model(fourier, np.linalg.solve(a + ridge * got.n * np.eye(len(b)) / features, b))

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = np.zeros(BINS), np.zeros(BINS)
        for batch in batches:
            if batch.num_rows:
                at = model.bins(np.array(batch.column("x").to_pylist()))
                n += np.bincount(at, minlength=BINS)
                s += np.bincount(at, batch.column("y").to_numpy(), minlength=BINS)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at]), pa.array(s[at])], ["bin", "n", "s"])

    rows = labelled.select("x", "y").mapInArrow(binned, "bin long, n double, s double").groupBy("bin").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).toPandas().sort_values("bin")
    model.centres, model.levels = rows["bin"].to_numpy(np.float64), isotonic(rows["n"].to_numpy(), rows["s"].to_numpy())
    return model


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
             threshold: float = 0.3, features: int = FEATURES) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted) for all documents; labels of
    documents in the held-out fifth are not learnt from."""
    held_out = crc_bucket(id_col, 5) == 0
    d = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), held_out.alias("held_out"), text_bytes(text_col).alias("t"))
    stats = Written(d.mapInArrow(add_statistics, "doc_id long, held_out boolean, x array<double>"), "statistics").df
    y = labels.select(F.col(f"`{id_col}`").cast("long").alias("l"), F.col(f"`{label_col}`").cast("double").alias("y")).filter("y in (0, 1)")
    train = stats.filter("not held_out")
    labelled = Written(train.join(y, train.doc_id == y.l).select("x", "y"), "labelled").df
    model = fit(labelled, features)

    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array(x.tolist())) if len(x) else [], dtype="float64")

    return stats.select("doc_id", "held_out", score("x").alias("score")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
