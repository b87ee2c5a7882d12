"""Count-only Viterbi: numbers of unigram tokens without the tokens.

An Aho-Corasick automaton enumerates every vocabulary piece in a word; dynamic
programming over its ends carries the best score and the number of pieces of
the best path, nothing else. The tie rule is the tokenizer's: pieces are tried
from the earliest start on, and a later one must score strictly more. A
character without a piece of its own is unknown at the least score minus 10;
with byte fallback it counts as its UTF-8 bytes.

Vocabulary: the pieces and scores of a sentencepiece model file, read as a
unigram vocabulary (the file in use was made for another algorithm; its scores
order its pieces, and the counts are exactly those of a unigram tokenizer with
that vocabulary). Spaces become U+2581; a word begins at each, and a text gets
one in front unless it begins with one.

Defined cases: a null or empty text has no tokens; repeated words, rows and
ties are counted alike; a null id stays null; extra columns are ignored; an
empty table gives no rows; very long words take time and memory in proportion to
their length, and are not remembered.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: Characters of the words whose counts a task remembers, a fixed cost of each
#: word included, and the longest word that is remembered. In text without spaces
#: a word is a paragraph, which hardly comes again.
MEMORY, WORD_COST, LONGEST = 1 << 25, 32, 64
#: Added to the least score for an unknown character; a fixed value of the tokenizer.
UNKNOWN = -10.0


def read_vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) by id."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())]


class Counter(dict):
    """Word -> (pieces, unknown characters)."""

    def __init__(self, vocabulary: list[tuple[str, float]]):
        import ahocorasick

        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        pieces = dict(vocabulary)
        self.unknown = min(pieces.values()) + UNKNOWN
        self.single = {p for p in pieces if len(p) == 1}
        self.pieces = pieces
        self.bytes = all(f"<0x{b:02X}>" in pieces for b in range(256))
        self.held = 0

    def __missing__(self, word: str) -> tuple[int, int]:
        out = self.count(word)
        if len(word) <= LONGEST:
            if self.held > MEMORY:
                self.clear()
                self.held = 0
            self[word] = out
            self.held += len(word) + WORD_COST
        return out

    def count(self, word: str) -> tuple[int, int]:
        n = len(word)
        best: list[float | None] = [0.0] + [None] * n
        pieces, unknowns = [0] * (n + 1), [0] * (n + 1)
        run = [False] * (n + 1)  # whether the best path ends in an unknown character
        single, unknown = self.single, self.unknown
        done = 0

        def close(to: int) -> None:
            """Offer each end up to ``to`` its unknown character, the last start."""
            nonlocal done
            for end in range(done + 1, to + 1):
                c = word[end - 1]
                if c not in single:
                    score = best[end - 1] + unknown
                    if best[end] is None or score > best[end]:
                        best[end] = score
                        # A run of unknowns is one piece, unless it falls back to bytes.
                        add = len(c.encode("utf-8", "surrogatepass")) if self.bytes else 0 if run[end - 1] else 1
                        pieces[end], unknowns[end], run[end] = pieces[end - 1] + add, unknowns[end - 1] + 1, True
            done = max(done, to)

        for last, (length, value) in self.automaton.iter(word):
            end = last + 1
            if end - 1 > done:
                close(end - 1)
            start = end - length
            score = best[start] + value
            if best[end] is None or score > best[end]:  # matches of one end come longest first
                best[end], pieces[end], unknowns[end], run[end] = score, pieces[start] + 1, unknowns[start], False
        close(n)
        return pieces[n], unknowns[n]

    def text(self, text: str) -> tuple[int, int]:
        if not text:
            return 0, 0
        text = text.replace(" ", MARK)
        if text[0] == MARK:
            text = text[1:]
        got = [self[MARK + w] for w in text.split(MARK)]
        return sum(g[0] for g in got), sum(g[1] for g in got)


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_chars, n_tokens, n_unknown): the characters of the whole
    text, its tokens, and the characters that no piece covers."""
    vocabulary = read_vocabulary(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(vocabulary)
        for b in batches:
            texts = b.column("t").to_pylist()
            got = [counter.text(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.int64())],
                ["doc_id", "n_chars", "n_tokens", "n_unknown"])

    d = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("t"))
    return d.mapInArrow(run, "doc_id long, n_chars long, n_tokens long, n_unknown long")
