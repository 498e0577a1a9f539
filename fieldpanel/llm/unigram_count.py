"""Token counts under a unigram vocabulary: Viterbi that carries only score and count.

Spaces become the word mark; a text is cut before every mark, and each word is segmented
alone, as the tokenizer's own pre-tokenizer does. An Aho-Corasick automaton lists the
vocabulary's matches by their end, longest (earliest start) first. The best path to each
position keeps its score and its number of pieces, no back pointers. Tie rule: a later
candidate must be strictly better, so of equal scores the earliest start wins; scores are
double precision, added from the word's start. A character that is no piece costs the
least score minus 10 and counts one token per UTF-8 byte (byte fallback).

Defined results: null and empty texts have no tokens and score 0; words of any length are
segmented whole (short ones are memoised); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fieldpanel.shipping import ship

MODEL = "piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
MEMO_WORDS, MEMO_LENGTH = 300_000, 64


def read_pieces(path: str) -> list[tuple[str, float]]:
    """The ordinary pieces of a vocabulary file with their scores."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    special = (model.is_control, model.is_unknown, model.is_byte, model.is_unused)
    return [
        (model.id_to_piece(i), model.get_score(i))
        for i in range(model.get_piece_size())
        if not any(kind(i) for kind in special)
    ]


class Counter:
    """Counts tokens of texts under (piece, score) pairs."""

    def __init__(self, pieces: Sequence[tuple[str, float]]) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        self.words: dict[str, tuple[float, int]] = {}

    def word(self, word: str) -> tuple[float, int]:
        """(score, tokens) of one word."""
        n = len(word)
        score: list[float] = [0.0] + [float("-inf")] * n
        count = [0] * (n + 1)
        done = 0  # ends below this one are final

        def unknown(end: int) -> None:
            # the last character alone, if it is no piece: the latest start of all
            value = score[end - 1] + self.unknown
            if value > score[end]:
                score[end], count[end] = value, count[end - 1] + len(word[end - 1].encode())

        single = False
        for last, (length, value) in self.automaton.iter(word):
            end = last + 1
            if end > done:
                if done and not single:
                    unknown(done)
                for missed in range(done + 1, end):
                    unknown(missed)
                done, single = end, False
            single = single or length == 1
            value += score[end - length]
            if value > score[end]:
                score[end], count[end] = value, count[end - length] + 1
        if done and not single:
            unknown(done)
        for missed in range(done + 1, n + 1):
            unknown(missed)
        if n <= MEMO_LENGTH:
            if len(self.words) >= MEMO_WORDS:
                self.words.clear()
            self.words[word] = (score[n], count[n])
        return score[n], count[n]

    def text(self, text: str) -> tuple[float, int, int]:
        """(score, tokens, words) of a text."""
        if not text:
            return 0.0, 0, 0
        marked = text.replace(" ", MARK)
        words = marked.removeprefix(MARK).split(MARK)
        known, word = self.words.get, self.word
        found = [known(w) or word(w) for w in [MARK + w for w in words]]
        return sum(s for s, _ in found), sum(c for _, c in found), len(words)


@lru_cache(maxsize=2)
def counter(path: str | None = None) -> Counter:
    """One counter per Python worker; the default is the public vocabulary."""
    import public_tokenizers

    return Counter(read_pieces(path or public_tokenizers.path(MODEL)))


def count_tokens(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", path: str | None = None
) -> DataFrame:
    """Per document: doc_id, n_tokens, n_words, score of the best segmentation."""
    ship(docs.sparkSession)
    schema = "doc_id bigint, n_tokens bigint, n_words bigint, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from fieldpanel.llm.unigram_count import counter as made

        count = made(path).text
        for batch in batches:
            found = [count(value.as_py() or "") for value in batch.column(1)]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column(0),
                    "n_tokens": pa.array([f[1] for f in found], pa.int64()),
                    "n_words": pa.array([f[2] for f in found], pa.int64()),
                    "score": pa.array([f[0] for f in found], pa.float64()),
                }
            )

    columns = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return columns.mapInArrow(run, schema)
