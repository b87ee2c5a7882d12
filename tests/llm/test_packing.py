"""Ids against the tokenizer on whole texts; places; use of room."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tollgate.llm import packing as P

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check(rows, docs, capacity):
    tok = Tokenizer.from_file(PATH)
    ids = {d: tok.encode(t or "", add_special_tokens=False).ids + [0] for d, t in docs}
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(ids)
    for d, own in by_doc.items():
        own.sort(key=lambda r: r.piece)
        at = 0
        for k, r in enumerate(own):
            assert (r.piece, r.start) == (k, at)
            raw = np.array(ids[d][at:at + r.length], "<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(raw)
            at += r.length
            assert r.length == capacity or k == 0
        assert at == len(ids[d])
        assert len(own) == -(-len(ids[d]) // capacity)
    for own in by_seq.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(by_seq), sum(map(len, ids.values()))


def test_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    from tollgate.llm.packing_query import op9_best_two_fit

    n, tokens = check(op9_best_two_fit(spark, "/root/testdata/sf0.001").collect(), docs, 2048)
    assert n <= tokens / 2048 * 1.02 + 1


def test_odd_texts(spark):
    texts = [None, "", " ", "a  b", " lead", "trail ", "line\nbreak  x\n\n y", "don't we'll", "<|endoftext|> x", "é ü  \t z", "a b c　d", "x " * 9000, "12 3.4,5"]
    docs = list(enumerate(texts))
    df = spark.createDataFrame([(a, b, 0) for a, b in docs], "doc_id long, text string, piece int")
    check(P.pack(df, PATH, capacity=64, deal=5).collect(), docs, 64)
    assert P.pack(df.limit(0), PATH).count() == 0


def test_best_two_fit_swaps():
    # greedy: 6 + 3 leaves 1; two pieces of 2 fill the gap that 3 leaves
    sequence, offset = P.best_two_fit(np.array([6, 3, 2, 2]), 10)
    assert sequence[0] == sequence[2] == sequence[3] != sequence[1]
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 100, 3000)
    sequence, offset = P.best_two_fit(lengths, 128)
    used = np.bincount(sequence, lengths)
    assert used.max() <= 128 and used.sum() == lengths.sum()
    assert len(used) <= -(-lengths.sum() // 128) * 1.02 + 1


def test_fast_ids_equal_tokenizers(spark):
    encode, tok = P.Encoder(PATH), Tokenizer.from_file(PATH)
    assert encode.fast
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    texts += ["", " ", "a\u00a0b\u2003 c", "\u3000x \u200b y", "don't I'LL we've", "x\r\n\r\n y\t\t z  ", "\u0661\u0662 \u00b2 \u2167", "e\u0301 \u0928\u093f", "\U0001f600\U0001f468\u200d\U0001f469", "<|endoftext|>"]
    for t in texts:
        assert encode(t) == np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), t[:50]


@pytest.mark.parametrize("text", ["a" + " " * 1_200_000 + "b", "a" + "\n" * 1_200_000 + "b", "words " + " " * 1_200_000, "a" + " \t\n" * 400_000 + "b"])
def test_long_white_space_runs(text):
    encode, tok = P.Encoder(PATH), Tokenizer.from_file(PATH)
    with pytest.raises(ValueError):
        encode.fast.encode_to_numpy(text, disallowed_special=())
    assert encode(text) == np.array(tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_document_with_a_long_white_space_run(spark):
    docs = [(1, "a b"), (2, "x" + " " * 1_200_000 + "y"), (3, "c")]
    check(P.pack(spark.createDataFrame(docs, "doc_id long, text string"), PATH).collect(), docs, 2048)


def test_other_tokenizer_files():
    path = public_tokenizers.path("word_bpe_49k.json")
    encode = P.Encoder(path)
    assert encode.fast is None
    assert encode("Hello wide world") == np.array(Tokenizer.from_file(path).encode("Hello wide world", add_special_tokens=False).ids, "<u4").tobytes()
