"""Counts against the tokenizers library's unigram model."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from tollgate.llm import token_count as C

PATH = public_tokenizers.path("piece_bpe_32k.model")


def tokenizer(vocabulary, unk, fallback):
    t = Tokenizer(models.Unigram(vocabulary, unk_id=unk, byte_fallback=fallback))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement=C.MARK, prepend_scheme="always", split=True)
    return t


ODD = ["", " ", "  a", "a  b ", "\n\n x\ty", "日本語 テスト", "\U0001f600\U0001f600 ok", "<0x41> <unk> <s>", "▁▁a ▁", "é" * 50, "x" * 3000, "\x00\x01"]


def test_equals_tokenizer(spark):
    vocabulary = C.read_vocabulary(PATH)
    want = tokenizer(vocabulary, 0, True)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    rows += [(10_000 + i, t) for i, t in enumerate(ODD)] + [(None, None), (20_000, "a b"), (20_000, "a b")]
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, n_tokens int")
    got = sorted(((r.doc_id, r.n_chars, r.n_tokens) for r in C.count_tokens(df, PATH).collect()), key=str)
    assert got == sorted(((i, len(t or ""), len(want.encode(t or "").ids)) for i, t in rows), key=str)
    assert C.count_tokens(df.limit(0), PATH).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_ties_and_unknowns(seed):
    rng = random.Random(seed)
    pieces = {"<unk>": 0.0, C.MARK: -2.0}
    for _ in range(40):
        pieces["".join(rng.choice("ab" + C.MARK) for _ in range(rng.randint(1, 4)))] = -float(rng.randint(1, 4))
    pieces.pop("a" if seed % 2 else "b", None)
    vocabulary = list(pieces.items())
    want, counter = tokenizer(vocabulary, 0, False), C.Counter(vocabulary)
    for _ in range(400):
        text = "".join(rng.choice("abc  ") for _ in range(rng.randint(0, 14)))
        assert counter.text(text)[0] == len(want.encode(text).ids), text


def test_memory_is_bounded_in_characters(monkeypatch):
    monkeypatch.setattr(C, "MEMORY", 10_000)
    counter = C.Counter([("<unk>", 0.0), (C.MARK, -2.0), ("a", -1.0), ("ab", -1.5)])
    fresh = C.Counter([("<unk>", 0.0), (C.MARK, -2.0), ("a", -1.0), ("ab", -1.5)])
    rng = random.Random(1)
    words = ["".join(rng.choice("abc") for _ in range(rng.choice((3, 8, 60, 400)))) for _ in range(2000)]
    for w in words + words:
        assert counter[w] == fresh.count(w)
        assert sum(len(x) + C.WORD_COST for x in counter) == counter.held <= C.MEMORY + C.LONGEST + C.WORD_COST
    assert not [w for w in counter if len(w) > C.LONGEST]


def test_a_very_long_text_without_spaces(spark):
    want = tokenizer(C.read_vocabulary(PATH), 0, True)
    text = "日本語のテキスト。abc" * 40_000
    row = C.count_tokens(spark.createDataFrame([(1, text)], "doc_id long, text string"), PATH).first()
    part = text[: 13 * 300]
    assert row.n_chars == len(text)
    assert C.Counter(C.read_vocabulary(PATH)).text(part)[0] == len(want.encode(part).ids)
    assert row.n_tokens > 40_000
