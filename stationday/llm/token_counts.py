"""Token counts under a unigram vocabulary, without the tokens.

The text, with a space before it and every space written as the word mark, is
cut into the pieces of the vocabulary with the largest sum of scores. An
Aho-Corasick automaton gives all pieces that end at each place; dynamic
programming keeps for each place the best score and the number of pieces on its
path, nothing else. Ties are the tokenizer's: a later start replaces an earlier
one only if its score is larger, so of equal paths the longest last piece wins.
A character that is no piece itself costs the smallest score less ten; it counts
as its UTF-8 bytes where the vocabulary has byte pieces, and otherwise a run of
such characters counts as one.

No piece has a word mark after another character, so the best cut of a text is
made of the best cuts of its words, each worked out once per task as long as it
is among the words remembered (at most ``CACHE_WORDS``). A vocabulary with such
pieces is handled text by text. Scores whose sums are exact in floating point,
as whole numbers are, give the same ties either way.

The vocabulary is a file of a public tokenizer, read by the driver and sent to
the tasks; its size does not follow the corpus. One pass, no shuffle. NULL and
empty texts have no tokens. Rows are counted one by one; an empty table gives an
empty result. Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from stationday.llm.common import on_workers, table

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
CACHE_WORDS = 300_000


@dataclass
class Vocabulary:
    """Pieces with scores; byte_pieces: whether unknown characters become bytes;
    least: the smallest score of the whole vocabulary."""

    pieces: list[tuple[str, float]]
    byte_pieces: bool
    least: float


def load(path: str = VOCABULARY) -> Vocabulary:
    """The vocabulary of a sentencepiece model: its ordinary pieces."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(sp.get_piece_size())
    pieces = [(sp.id_to_piece(i), sp.get_score(i)) for i in ids if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    return Vocabulary(pieces, sum(sp.is_byte(i) for i in ids) == 256, min(sp.get_score(i) for i in ids))


class Counter:
    """Counts the pieces of texts; remembers words."""

    def __init__(self, v: Vocabulary):
        self.byte_pieces, self.unknown = v.byte_pieces, v.least - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for piece, score in v.pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {p for p, _ in v.pieces if len(p) == 1}
        known = set().union(*(p for p, _ in v.pieces)) if v.pieces else set()
        by_word = not any(MARK in p.lstrip(MARK) for p, _ in v.pieces)
        # a character of no piece is a place to cut as well, but only bytes add up
        apart = "".join(c for c in "\n\t\r" if c not in known) if v.byte_pieces else ""
        self.cut = re.compile(rf"{MARK}+[^{MARK}{apart}]*|[^{MARK}{apart}]+" + (f"|[{apart}]" if apart else "")) if by_word else re.compile(r"(?s).+")
        self.seen: dict[str, tuple[int, float]] = {}

    def segment(self, s: str) -> tuple[int, float]:
        """(pieces, score) of the best cut of s."""
        n = len(s)
        best, count, unknown = [0.0] + [float("-inf")] * n, [0] * (n + 1), [False] * (n + 1)
        done = 0  # places whose best is final

        def finish(e: int) -> None:
            c = s[e - 1]
            if c not in self.single and best[e - 1] + self.unknown > best[e]:
                best[e] = best[e - 1] + self.unknown
                run = unknown[e - 1] and not self.byte_pieces
                count[e] = count[e - 1] + (len(c.encode()) if self.byte_pieces else 0 if run else 1)
                unknown[e] = True

        for last, (length, score) in self.automaton.iter(s):
            e = last + 1
            while done < e - 1:
                done += 1
                finish(done)
            # all pieces that end here come one after the other, the longest first
            value = best[e - length] + score
            if value > best[e]:
                best[e], count[e] = value, count[e - length] + 1
        while done < n:
            done += 1
            finish(done)
        return count[n], best[n]

    def count(self, text: str | None) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        pieces, score, seen = 0, 0.0, self.seen
        for word in self.cut.findall(MARK + text.replace(" ", MARK)):
            found = seen.get(word)
            if found is None:
                if len(seen) >= CACHE_WORDS:
                    seen.clear()
                found = seen[word] = self.segment(word)
            pieces += found[0]
            score += found[1]
        return pieces, score


def token_counts(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, n_tokens, score), one row per row of docs; score is the sum of
    the scores of the best cut."""
    spark = docs.sparkSession
    on_workers(spark)
    shared = spark.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value)
        for batch in batches:
            found = [counter.count(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([n for n, _ in found], pa.int64()), pa.array([s for _, s in found], pa.float64())], names=["doc_id", "n_tokens", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, n_tokens bigint, score double")


def op6_token_counts(spark, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), load())
