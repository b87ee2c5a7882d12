"""Scoring by a log-bilinear language model trained with noise contrast.

Vocabulary. Every word is counted over the training documents: tasks count
within chunks of text, Spark sums the counts, and only totals come to the
driver. The words' dictionaries stay distributed: each chunk gets back the rows
of its own words by a join, so the vocabulary may grow with the corpus.

Classes. The model predicts one of ``CLASSES`` classes: the most frequent words
and the end token have a class of their own, the others share classes by their
last letters, and words seen once share one with the unknown word. A word's
probability is its class's, times its share of the class (counts plus a half).
The outcomes are the known words, the end and one unknown word, as in the base
score, and their probabilities sum to one.

Model. The context's vector is a sum of the class vectors of the two words
before, each weighted by dimension, and of the mean of all words before in the
document; a class scores by the product with its own vector plus a bias.
Training is noise-contrastive in numpy: each token's class is told from noise
classes drawn by frequency, so that no step sums over the classes. All training
tokens are used once, in ``ROUNDS`` rounds over disjoint parts of the corpus:
in each round every task trains on its documents from the same start, and the
results are averaged, weighted by tokens, by a grouped sum. A document's round
follows from its id, and chunks are numbered by task, so that runs over the same
files give the same model (but for the last digits of sums); the number of tasks
does bear on it.

Scoring normalises exactly: batched matrix products give all classes' scores of
each token, and the log of their sum is taken off.

Defined cases: a null or empty text is the end alone; a null id counts as the
empty text for the split; repeated rows are counted and scored each; with no
training document every token is unknown and shares one outcome; very long
texts are trained on and scored in steps of tokens that carry the counts of the
classes before on; extra columns are ignored.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import CHUNK_BYTES, Written, crc_bucket, text_bytes

#: Classes: words of their own, shared by last letters, one for rare words.
OWN, SHARED = 160, 95
CLASSES = OWN + SHARED + 1
RARE = CLASSES - 1
DIMENSIONS = 24
ROUNDS = 3
#: Tokens of a training step, and noise classes drawn for it.
STEP, NOISE = 4096, 64
RATE = 0.05
#: Tokens that are scored at a time.
BATCH = 1 << 11
#: The end token, as a word: no word holds a space.
END = b" "

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


# --- vocabulary --------------------------------------------------------------------

class Codes(dict):
    """Word -> number, new words numbered on."""

    def __missing__(self, word: bytes) -> int:
        out = self[word] = len(self)
        return out


CHUNKS = "chunk string, doc_id long, held_out boolean, codes binary, words array<binary>, counts array<long>"
CHUNKS_ARROW = pa.schema([("chunk", pa.string()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("codes", pa.binary()),
                          ("words", pa.list_(pa.binary())), ("counts", pa.list_(pa.int64()))])


def code_chunks(chunk_bytes: int):
    """Arrow function: (doc_id, held_out, t) to document rows with the codes of
    their words (int32, the end last), and a row per chunk with its words by
    code and their counts in training documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def start():
            codes = Codes()
            codes[END]
            # The same on every attempt and every run over the same files.
            return f"{TaskContext.get().partitionId()}-{next(number)}", codes, np.zeros(1 << 16, np.int64), 0

        def dictionary():
            n = len(codes)
            return [(chunk, None, None, None, list(codes), counts[:n].tolist())]

        def table(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), CHUNKS_ARROW)], schema=CHUNKS_ARROW)

        number = itertools.count()
        chunk, codes, counts, size = start()
        for b in batches:
            rows = []
            for doc_id, held_out, t in zip(b.column("doc_id").to_pylist(), b.column("held_out").to_pylist(), b.column("t")):
                t = t.as_py()
                words = t.translate(LOWER).split()
                words.append(END)
                own = np.fromiter(map(codes.__getitem__, words), "<i4", len(words))
                if len(codes) > len(counts):
                    counts = np.concatenate([counts, np.zeros(max(len(counts), len(codes)), np.int64)])
                if not held_out:
                    np.add.at(counts, own, 1)
                rows.append((chunk, doc_id, held_out, own.tobytes(), None, None))
                size += len(t) + 8
                if size >= chunk_bytes:
                    yield table(rows + dictionary())
                    rows = []
                    chunk, codes, counts, size = start()
            if rows:
                yield table(rows)
        if size:
            yield table(dictionary())

    return run


def class_of(word, count, rank):
    """The class of a counted word, as Spark expressions over its bytes."""
    shared = F.lit(OWN) + F.pmod(F.xxhash64(F.substring(word, -2, 2)), F.lit(SHARED)).cast("int")
    return F.when(rank.isNotNull(), rank).when(count <= 1, F.lit(RARE)).otherwise(shared)


# --- the model ---------------------------------------------------------------------

class Model:
    """Class vectors (context and target side), biases, and the weights by
    dimension of the three context parts, in one flat array."""

    SHAPES = ((CLASSES, DIMENSIONS), (CLASSES, DIMENSIONS), (CLASSES,), (3, DIMENSIONS))
    SIZE = sum(int(np.prod(s)) for s in SHAPES)

    def __init__(self, flat: np.ndarray):
        self.flat = flat.astype(np.float32)
        parts, at = [], 0
        for s in self.SHAPES:
            n = int(np.prod(s))
            parts.append(self.flat[at:at + n].reshape(s))
            at += n
        self.context, self.target, self.bias, self.weight = parts

    @staticmethod
    def start(class_counts: np.ndarray) -> "Model":
        rng = np.random.default_rng(11)
        m = Model(np.zeros(Model.SIZE))
        m.context[:] = rng.normal(0, 0.3, m.context.shape)
        m.target[:] = rng.normal(0, 0.3, m.target.shape)
        p = class_counts + 0.5
        m.bias[:] = np.log(p / p.sum())
        m.weight[:] = 0.5
        return m


class Step:
    """At most ``size`` tokens of documents: classes, each one's document (by
    number), place there, and where that document begins and ends in the step.
    Of the document that was begun before the step it has the counts of the
    classes so far (``past``) and the last two classes (in ``around``)."""

    def __init__(self, classes: np.ndarray, ends: np.ndarray, at: int, stop: int, past: np.ndarray):
        where = np.arange(at, stop)
        self.classes, self.past = classes[at:stop], past
        self.doc = np.searchsorted(ends, where, "right")
        first = np.r_[0, ends][self.doc]
        self.place = where - first
        self.begin = np.maximum(first - at, 0)
        self.end = np.minimum(ends[self.doc], stop) - at
        lead = classes[max(at - 2, 0):at]
        self.around = np.concatenate([np.zeros(2 - len(lead), classes.dtype), lead, self.classes])
        self.open = int(self.end[0]) if self.place[0] else 0  # tokens of the document begun before

    def before(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The classes k places before, and where there is such a place."""
        return self.around[2 - k:len(self.around) - k], self.place >= k

    def parts(self, table: np.ndarray) -> list[np.ndarray]:
        """The three context parts of every token."""
        out = []
        padded = np.concatenate([table, np.zeros((1, table.shape[1]), table.dtype)])  # no such place: zeros
        for k in (1, 2):
            b, ok = self.before(k)
            out.append(padded.take(np.where(ok, b.astype(np.intp), len(table)), axis=0))
        sums = np.concatenate([np.zeros((1, table.shape[1])), np.cumsum(table[self.classes], axis=0, dtype=np.float64)])
        mean = sums[:-1] - sums[self.begin]
        if self.open:
            mean[:self.open] += self.past @ table
        out.append((mean / np.maximum(self.place, 1)[:, None]).astype(np.float32))
        return out


def steps(docs: list[np.ndarray], size: int) -> Iterator[Step]:
    """Documents' classes in steps of ``size`` tokens, the history carried on as
    counts of classes: a step's work and memory do not grow with a document."""
    classes = docs[0] if len(docs) == 1 else np.concatenate(docs)
    ends = np.cumsum([len(d) for d in docs])
    past = np.zeros(CLASSES)
    for at in range(0, len(classes), size):
        step = Step(classes, ends, at, min(at + size, len(classes)), past)
        yield step
        begin = int(step.begin[-1])
        past = np.bincount(step.classes[begin:], minlength=CLASSES) + (past if begin == 0 and step.open else 0)


def add_rows(table: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """table[at[i]] += rows[i], equal indices summed first."""
    if len(at):
        order = np.argsort(at, kind="stable")
        at = at[order]
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        table[at[first]] += np.add.reduceat(rows[order], first, axis=0)


def gradient(model: Model, step: Step, noise: np.ndarray, drawn: np.ndarray) -> Model:
    """Gradient of a step's mean noise-contrastive loss, against the noise
    classes ``drawn``. A class vector's part in the mean of all words before
    is followed to every word there, those before the step included."""
    offset = (model.bias - np.log(noise) - np.log(NOISE)).astype(np.float32)
    y, n = step.classes, len(step.classes)
    parts = step.parts(model.context)
    h = sum(w * p for w, p in zip(model.weight, parts))
    good = np.einsum("nd,nd->n", h, model.target[y]) + offset[y]
    e_good = (1 / (1 + np.exp(-np.clip(good, -30, 30))) - 1).astype(np.float32) / n
    e_bad = h @ -model.target[drawn].T  # one array, turned into probabilities in place
    e_bad -= offset[drawn]
    np.clip(e_bad, -30, 30, out=e_bad)
    np.exp(e_bad, out=e_bad)
    e_bad += 1
    np.divide(np.float32(1 / n), e_bad, out=e_bad)
    g = Model(np.zeros(Model.SIZE))
    np.add.at(g.target, drawn, e_bad.T @ h)
    g.bias += np.bincount(y, e_good, CLASSES)
    np.add.at(g.bias, drawn, e_bad.sum(axis=0))
    dh = e_good[:, None] * model.target[y] + e_bad @ model.target[drawn]
    for k in range(3):
        g.weight[k] = np.einsum("nd,nd->d", dh, parts[k])
    for k in (1, 2):
        b, ok = step.before(k)
        add_rows(g.context, b[ok], dh[ok] * model.weight[k - 1])
    # A word stands in the mean of all later places of its document.
    share = np.where((step.place > 0)[:, None], dh * model.weight[2] / np.maximum(step.place, 1)[:, None], 0)
    sums = np.concatenate([np.zeros((1, DIMENSIONS)), np.cumsum(share, axis=0, dtype=np.float64)])
    both = np.zeros((CLASSES, 2 * DIMENSIONS), np.float32)
    add_rows(both, y, np.concatenate([e_good[:, None] * h, sums[step.end] - sums[1:]], axis=1, dtype=np.float32, casting="same_kind"))
    g.target += both[:, :DIMENSIONS]
    g.context += both[:, DIMENSIONS:]
    if step.open:
        g.context += np.outer(step.past, sums[step.open])
    return g


def train(model: Model, docs: Iterator[list[np.ndarray]], noise: np.ndarray) -> int:
    """Noise-contrastive steps over documents' classes, in place; returns the
    number of tokens."""
    rng = np.random.default_rng(5)
    grad2 = np.full(Model.SIZE, 1e-6, np.float32)
    tokens = 0
    for group in docs:
        for step in steps(group, STEP):
            tokens += len(step.classes)
            g = gradient(model, step, noise, rng.choice(CLASSES, NOISE, p=noise))
            grad2 += g.flat ** 2
            model.flat -= RATE * g.flat / np.sqrt(grad2)
    return tokens


def step_log_probabilities(model: Model, step: Step) -> np.ndarray:
    """Natural logs of the normalised class probabilities of a step's tokens."""
    h = sum(w * p for w, p in zip(model.weight, step.parts(model.context)))
    s = h @ model.target.T
    s += model.bias
    own = s[np.arange(len(h)), step.classes].astype(np.float64)
    with np.errstate(over="ignore"):
        total = np.exp(s, out=s) @ np.ones(CLASSES, np.float32)
    far = ~((total > 1e-20) & (total < 1e30))  # beyond what single precision holds
    out = own - np.log(np.where(far, 1, total), dtype=np.float64)
    if far.any():
        s = (h[far] @ model.target.T + model.bias).astype(np.float64)
        top = s.max(axis=1)
        out[far] = own[far] - top - np.log(np.exp(s - top[:, None]).sum(axis=1))
    return out


def log_probabilities(model: Model, docs: list[np.ndarray]) -> np.ndarray:
    """Natural logs of the normalised class probabilities of every token."""
    return np.concatenate([step_log_probabilities(model, s) for s in steps(docs, BATCH)])


def document_scores(model: Model, docs: list[np.ndarray]) -> np.ndarray:
    """Sums of the documents' natural log class probabilities."""
    out = np.zeros(len(docs))
    for s in steps(docs, BATCH):
        lo = int(s.doc[0])
        sums = np.bincount(s.doc - lo, step_log_probabilities(model, s))
        out[lo:lo + len(sums)] += sums
    return out


def grouped(pairs: Iterator[np.ndarray], tokens: int = 1 << 14) -> Iterator[list[np.ndarray]]:
    """Documents in lists of about so many tokens."""
    held, n = [], 0
    for x in pairs:
        held.append(x)
        n += len(x)
        if n >= tokens:
            yield held
            held, n = [], 0
    if held:
        yield held


# --- Spark ---------------------------------------------------------------------------

CODED = "doc_id long, held_out boolean, part int, classes binary, n_tokens long, n_known long, base double, shares double"


def look_up(n: int, v: int, rounds: int):
    """Grouped function: a chunk's documents with its words' rows, to documents
    with classes (one byte a token) and sums of word log10 probabilities."""

    def run(key: tuple, docs: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        size = int(words["code"].max()) + 1 if len(words) else 1
        count = np.zeros(size, np.int64)
        kind = np.full(size, RARE, np.uint8)
        share = np.zeros(size)
        at = words["code"].to_numpy()
        count[at], kind[at], share[at] = words["c"].to_numpy(), words["class"].to_numpy(), words["share"].to_numpy()
        base = np.log10((count + 0.5) / (n + 0.5 * (v + 1)))
        rows = []
        docs = docs.sort_values(["doc_id", "codes"])
        for doc_id, held_out, raw in zip(docs["doc_id"], docs["held_out"], docs["codes"]):
            codes = np.frombuffer(raw, "<i4")
            # The id's checksum deals the rounds; its remainder by 5 deals what is held out.
            part = zlib.crc32(b"" if pd.isna(doc_id) else str(int(doc_id)).encode()) // 5 % rounds
            rows.append((doc_id, held_out, part, kind[codes].tobytes(), len(codes), int((count[codes] > 0).sum()), float(base[codes].sum()), float(share[codes].sum())))
        return pd.DataFrame(rows, columns=[c.split(" ")[0] for c in CODED.split(", ")])

    return run


def fit_round(coded: DataFrame, model: Model, noise: np.ndarray) -> Model:
    """One round: every task trains on its documents, the results are averaged."""
    start = model.flat.copy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(start.copy())
        tokens = train(own, grouped(np.frombuffer(x.as_py(), np.uint8) for b in batches for x in b.column("classes")), noise)
        if tokens:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(Model.SIZE)), pa.array(own.flat.astype(np.float64) * tokens), pa.array(np.full(Model.SIZE, float(tokens)))], ["i", "v", "n"])

    rows = coded.select("classes").mapInArrow(run, "i long, v double, n double").groupBy("i").agg((F.sum("v") / F.sum("n")).alias("v")).toPandas()
    if rows.empty:
        return model
    flat = np.empty(Model.SIZE)
    flat[rows["i"].to_numpy()] = rows["v"].to_numpy()
    return Model(flat)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score) for all documents; those of the held-out fifth are not learnt from."""
    held_out = crc_bucket(id_col, 5) == 1
    d = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), held_out.alias("held_out"), text_bytes(text_col).alias("t"))
    chunks = Written(d.mapInArrow(code_chunks(chunk_bytes), CHUNKS), "chunks").df
    words = chunks.filter("words is not null").select("chunk", F.posexplode(F.arrays_zip("words", "counts")).alias("code", "w")).select("chunk", "code", F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    counts = Written(words.filter("n > 0").groupBy("word").agg(F.sum("n").alias("c")), "counts").df
    total = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    n, v = total.n or 0, total.v

    top = [r.word for r in counts.filter(F.col("word") != F.lit(END)).orderBy(F.desc("c"), "word").limit(OWN - 1).collect()]  # the own classes
    ranks = counts.sparkSession.createDataFrame([(bytes(w), i) for i, w in enumerate([END, *top])], "word binary, rank int")
    ranked = counts.join(F.broadcast(ranks), "word", "left")  # OWN rows
    classed = Written(ranked.select("word", "c", class_of(F.col("word"), F.col("c"), F.col("rank")).cast("int").alias("class")), "classes").df
    sums = np.zeros(CLASSES)
    members = np.zeros(CLASSES)
    for r in classed.groupBy("class").agg(F.sum("c").alias("c"), F.count("*").alias("m")).collect():  # CLASSES rows
        sums[r["class"]], members[r["class"]] = r.c, r.m
    members[RARE] += 1  # the unknown word
    weight = np.log10(sums + 0.5 * members, out=np.zeros(CLASSES), where=members > 0)
    unknown = float(np.log10(0.5) - weight[RARE])

    of_class = F.array(*(F.lit(float(x)) for x in weight))
    known = classed.select("word", "c", "class", (F.log10(F.col("c") + 0.5) - F.get(of_class, F.col("class"))).alias("share"))
    looked = words.select("chunk", "code", "word").join(known, "word", "left").select(
        "chunk", "code", F.coalesce("c", F.lit(0)).alias("c"), F.coalesce("class", F.lit(RARE)).alias("class"), F.coalesce("share", F.lit(unknown)).alias("share"))
    texts = chunks.filter("codes is not null").select(F.col("chunk").alias("of"), "doc_id", "held_out", "codes")
    coded = texts.groupBy("of").cogroup(looked.groupBy("chunk")).applyInPandas(look_up(n, v, rounds), CODED)
    coded = Written(coded, "coded").df

    model = Model.start(sums)
    noise = (sums + 0.5 * np.maximum(members, 1)) / (sums + 0.5 * np.maximum(members, 1)).sum()
    for r in range(rounds):
        model = fit_round(coded.filter((~F.col("held_out")) & (F.col("part") == r)), model, noise)
    # A class that no word has (few distinct words) is no outcome.
    model.bias[members == 0] = -1e9
    flat = model.flat

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(flat)
        for b in batches:
            out = []
            for group in grouped(np.frombuffer(x.as_py(), np.uint8) for x in b.column("classes")):
                out.append(document_scores(own, group) / np.log(10))
            total = np.concatenate(out) if out else np.empty(0)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "held_out", "n_tokens", "n_known", "base")), pa.array(total + b.column("shares").to_numpy())],
                                             ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    scored = coded.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
