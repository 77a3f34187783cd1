"""Language identification by words first, character n-grams second.

A word is a maximal run of letters, in lower case. A word that the model knows
counts with its log frequency in each language. An unseen word falls back to
its character n-grams (with ``^`` and ``$`` at its ends): the longest order of
which the model knows any, then the next shorter one, down to single
characters. A text's language has the largest sum over all its words.

The model is learned from a bounded sample of the labelled rows (``SAMPLE_DOCS``
texts, by a hash of their id, and of each language ``LANG_DOCS`` at least, or all
it has, so that a rare one is learned too) and holds every word and n-gram of the
sample, so its size follows the sample, not the corpus; counts are gathered on
the executors. What a language has not shown has one probability per order, the
same in all languages: ``SMOOTH`` of a single occurrence in the language with
most of them. Scoring is one pass over the texts, without a shuffle.

NULL texts and texts without a letter get ``und`` and score 0; so does every
text when there is nothing to learn from. Ties go to the language first in code
point order. Rows are judged one by one, so repeated rows agree; an empty table
gives an empty result. Columns other than doc_id, text and lang are not looked
at, and doc_id and lang only to choose the rows to learn from.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationday.llm.common import crc_mod, table, unit_hash

SAMPLE_DOCS = 3000
LANG_DOCS = 700
ORDERS = (4, 3, 2, 1)
SMOOTH = 0.5
CACHE_WORDS = 150_000
NONE = "und"

_RUN = re.compile(r"[^\W\d_]+")


def grams(word: str, n: int) -> list[str]:
    w = f"^{word}$" if n > 1 else word
    return [w[i : i + n] for i in range(len(w) - n + 1)]


def letters(run: str) -> str:
    """The run without the few number signs that the pattern lets through."""
    return run if run.isalpha() else "".join(c for c in run if c.isalpha())


def counted(docs: DataFrame) -> DataFrame:
    """(lang, n, gram, c) over docs(lang, text); n = 0 are words. Each task
    sends what it has counted once per batch, the rest is one aggregation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for run_, c in Counter(_RUN.findall(text.lower())).items():
                    if w := letters(run_):
                        found[lang, 0, w] += c
                        for n in ORDERS:
                            for g in grams(w, n):
                                found[lang, n, g] += c
            if found:
                lang, n, gram = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(n, pa.int32()), pa.array(gram, pa.string()), pa.array(list(found.values()), pa.int64())], names=["lang", "n", "gram", "c"])

    return docs.select("lang", "text").mapInArrow(run, "lang string, n int, gram string, c bigint").groupBy("lang", "n", "gram").agg(F.sum("c").alias("c"))


class Model:
    """Log frequencies of words and n-grams per language; scores texts. An order
    has the row number of each gram and one row of numbers for each."""

    def __init__(self, rows: list[tuple[str, int, str, int, int]]):
        """rows: language, order (0: words), gram, its count, all counts of that
        language and order."""
        lang, n, gram, c, total = zip(*rows) if rows else ((), (), (), (), ())
        self._learn(np.array(lang, object), np.array(n, np.int64), list(gram), np.array(c, np.float64), {(x, k): t for x, k, t in zip(lang, n, total)})

    @classmethod
    def of(cls, counts: pa.Table) -> Model:
        """From (lang, n, gram, c) as a table: no Python object for each row but
        the gram."""
        lang = counts.column("lang").combine_chunks().dictionary_encode()
        names, code = np.array(lang.dictionary.to_pylist(), object), lang.indices.to_numpy()
        n, c = counts.column("n").to_numpy(), counts.column("c").to_numpy().astype(np.float64)
        totals = {(names[x], k): c[(code == x) & (n == k)].sum() for x in range(len(names)) for k in np.unique(n).tolist()}
        out = cls([])
        out._learn(names[code] if len(names) else names, n, counts.column("gram").to_pylist(), c, totals)
        return out

    def _learn(self, lang: np.ndarray, n: np.ndarray, gram: list[str], c: np.ndarray, totals: dict[tuple[str, int], float]) -> None:
        self.langs = sorted(set(lang.tolist()))
        self.tables: dict[int, tuple[dict[str, int], np.ndarray]] = {}
        at = np.array([self.langs.index(x) for x in lang.tolist()], np.int64)
        for k in np.unique(n).tolist():
            own = np.flatnonzero(n == k)
            places: dict[str, int] = {}
            row = np.array([places.setdefault(gram[i], len(places)) for i in own.tolist()], np.int64)
            counts = np.zeros((len(places), len(self.langs)))
            counts[row, at[own]] = c[own]
            total = np.array([totals.get((x, k), 0.0) for x in self.langs])
            unseen = SMOOTH / total.max()
            self.tables[k] = places, np.log(counts / np.maximum(total, 1) + unseen).astype(np.float32)

    def word(self, w: str) -> np.ndarray:
        places, logs = self.tables.get(0, ({}, None))
        if (at := places.get(w)) is not None:
            return logs[at]
        for n in ORDERS:
            places, logs = self.tables.get(n, ({}, None))
            found = [at for g in grams(w, n) if (at := places.get(g)) is not None]
            if found:
                return logs[found].mean(axis=0)
        return np.zeros(len(self.langs))

    def judge(self, texts: Iterable[str | None], seen: _Seen | None = None) -> tuple[list[str], list[float]]:
        """Language and score of each text. ``seen`` keeps words from call to call."""
        seen = _Seen(self) if seen is None else seen
        out, scores = [], []
        for text in texts:
            if len(seen) > CACHE_WORDS:
                seen.forget()
            ids = list(map(seen.__getitem__, _RUN.findall(text.lower()))) if text and self.langs else []
            if not any(ids):
                out.append(NONE)
                scores.append(0.0)
                continue
            total = seen.matrix()[ids].sum(axis=0)
            best = int(np.argmax(total))
            out.append(self.langs[best])
            scores.append(float(1.0 / np.exp(np.minimum(total - total[best], 0.0)).sum()))
        return out, scores


class _Seen(dict):
    """Row number of each word met so far; row 0 is what has no letter."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.rows, self.filled = np.zeros((1024, len(self.model.langs))), 1

    def __missing__(self, run: str) -> int:
        w = letters(run)
        if not w:
            self[run] = 0
            return 0
        if self.filled == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[self.filled] = self.model.word(w)
        self[run] = self.filled
        self.filled += 1
        return self[run]

    def matrix(self) -> np.ndarray:
        return self.rows


def sampled(pool: DataFrame, sample_docs: int, lang_docs: int) -> DataFrame:
    """About sample_docs rows of pool(doc_id, lang, text), the same share of each
    language, but of none fewer than about lang_docs or all that it has."""
    sizes = {r["lang"]: r["count"] for r in pool.groupBy("lang").count().collect()}
    share = min(1.0, sample_docs / max(1, sum(sizes.values())))
    rare = {lang: own for lang, n in sizes.items() if (own := min(1.0, lang_docs / n)) > share}
    if share == 1.0:
        return pool
    least = F.lit(share)
    if rare:
        least = F.coalesce(F.create_map(*(F.lit(x) for pair in sorted(rare.items()) for x in pair))[F.col("lang")], least)
    return pool.filter(unit_hash(F.lit("language"), F.col("doc_id")) < least)


def train(docs: DataFrame, learn: Column, sample_docs: int = SAMPLE_DOCS, lang_docs: int = LANG_DOCS) -> Model:
    """A model from the rows that ``learn`` names, with a lang and a text."""
    pool = docs.filter(learn & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    pool = sampled(pool, sample_docs, lang_docs)
    return Model.of(counted(pool.select("lang", "text")).select("lang", "n", "gram", "c").toArrow())


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score), one row per row of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        seen = _Seen(m)
        for batch in batches:
            langs, scores = m.judge((x.as_py() for x in batch.column(1)), seen)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, lang_pred string, score double")


def accepted(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The rows of docs whose language is recognised with ``least`` or more,
    with all their columns."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        seen = _Seen(m)
        for batch in batches:
            langs, scores = m.judge((x.as_py() for x in batch.column(at)), seen)
            yield batch.filter(pa.array([x != NONE and s >= least for x, s in zip(langs, scores)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def training_rows(doc_id: Column) -> Column:
    return crc_mod(doc_id, 3) != 1


def op9_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, training_rows(F.col("doc_id")))
    out = identify(docs, model)
    return out.select("doc_id", (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score")
