"""The pipeline against a plain version of all its stages."""

import re
from collections import Counter

import corpus_pipeline as C
from tests.llm.test_decontaminate import words
from tests.llm.test_packing import check
from tests.llm.test_simhash import plain_components, plain_fingerprint


def plain_keeps(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    n = len(w)
    tri = Counter(zip(w, w[1:], w[2:]))
    covered = {p for i, x in enumerate(zip(w, w[1:], w[2:])) if tri[x] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    chars = sum(map(len, w))
    fails = (n < 50, 100 * len(covered) > 50 * n, 10 * len(re.findall(r"[#*$%&|<>]", t)) > 3 * n, 10 * (len(lines) - len(set(lines))) > 8 * len(lines),
             n > 0 and not 2 * n <= chars <= 15 * n, 10 * len(re.findall("[A-Z]", t)) > 3 * chars)
    return not any(fails)


def plain_pipeline(docs, items):
    docs = [(i, t) for i, t in docs if plain_keeps(t)]
    comp = plain_components([i for i, _ in docs], [plain_fingerprint(t) for _, t in docs])
    docs = [d for d, c in zip(docs, comp) if d[0] == c]
    raw = [t.encode() for _, t in docs]
    n = C.REPEAT_BYTES
    seen = Counter(t[i:i + n] for t in raw for i in range(len(t) - n + 1))
    texts = []
    for t in raw:
        gone = bytearray(len(t))
        for i in range(len(t) - n + 1):
            if seen[t[i:i + n]] > 1:
                gone[i:i + n] = b"\1" * n
        texts.append(bytes(c for c, g in zip(t, gone) if not g).decode("utf-8", "ignore"))
    windows = set()
    for x in items:
        w = words(x)
        windows |= {tuple(w[i:i + 10]) for i in range(max(1, len(w) - 9)) if w}
    sizes = {len(x) for x in windows}
    out = []
    for (i, _), t in zip(docs, texts):
        w = words(t)
        if not any(tuple(w[p:p + n]) in windows for n in sizes for p in range(len(w) - n + 1)):
            out.append((i, t))
    return out


def test_pipeline_equals_plain_version(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = plain_pipeline(docs, items)
    assert 0 < len(want) < len(docs)
    check(C.run(spark, sf).collect(), want, C.SEQUENCE_TOKENS)


def test_stages_take_odd_rows(spark):
    """Nulls, empty and equal rows, extra columns; an empty table."""
    text = " ".join(f"word{i % 97}x{i % 89}" for i in range(400))
    rows = [(1, text, "en", "a", 1, 5), (1, text, "en", "a", 1, 5), (None, text, None, None, None, 5), (2, None, "en", "a", 0, 5), (3, "", None, "b", 0, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, fp long")
    for table in (df, df.limit(0)):
        docs = table
        for name, stage in C.STAGES:
            out = stage(spark, docs, "/root/testdata/sf0.001")
            rows = out.collect()
            if name != C.STAGES[-1][0]:
                assert out.columns == df.columns
                docs = spark.createDataFrame(rows, df.schema)
    one = C.near_duplicates(spark, df, "")
    assert sorted((r.doc_id for r in one.collect()), key=str) == [1, 2]
