"""A quality classifier from compressed sizes.

Two zstandard dictionaries are trained, one on good and one on bad text. A text
is cut into blocks of ``BLOCK`` bytes, each block is compressed with either
dictionary, and the text's difference is ``(bad - good) / (bad + good)`` over
the summed sizes: positive when the good dictionary explains it better. Platt
scaling on labelled rows that the dictionaries have not seen turns the
difference into a probability of label 1.

The classifier is fitted on a bounded sample of labelled rows: up to
``SAMPLE_DOCS`` texts of each label for the dictionaries and as many for the
calibration, chosen by a hash of the id and fewer where they would be more than
about ``SAMPLE_BYTES`` together. Texts of any length can be in it. Scoring covers
every whole text in one pass without a shuffle.

NULL and empty texts have no blocks, hence difference 0 and one fixed score.
With only one label to learn from, or none, every text gets the share of label
1 (0.5 without labels). Rows are judged one by one; an empty table gives an
empty result. Of docs only doc_id and text are looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationday.llm.common import crc_mod, table, unit_hash

SAMPLE_DOCS = 1500
SAMPLE_BYTES = 32 << 20  # of all sampled texts of a label, as expected from the mean length
DICTIONARY = 112_640
BLOCK = 1024
LEVEL = 3
THRESHOLD = 0.7


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, per_label: int, most_bytes: int, seed: str) -> list[tuple[int, str]]:
    """(label, text) rows, of each label about ``per_label`` and about
    ``most_bytes`` of text at most, by a hash of the id, so that the sample does not
    depend on the order of rows. Texts of any length take part."""
    y = labels.filter(learn & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    texts = docs.filter(F.octet_length("text") > 0).select("doc_id", "text")
    n = {r["y"]: r["n"] for r in y.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not n:
        return []
    mean = texts.agg(F.avg(F.octet_length("text"))).first()[0] or 1.0
    most = min(per_label, most_bytes / mean)
    share = F.when(F.col("y") == 1, min(1.0, most / max(n.get(1, 0), 1))).otherwise(min(1.0, most / max(n.get(0, 0), 1)))
    y = y.filter(unit_hash(F.lit(seed), F.col("doc_id")) < share)
    # the sample's ids are as many as it has rows: bounded, so the texts need not move
    rows = texts.join(F.broadcast(y), "doc_id").select("y", "text", unit_hash(F.lit(seed), F.lit(1), F.col("doc_id")).alias("u")).collect()
    return [(r["y"], r["text"]) for r in sorted(rows, key=lambda r: (r["u"], r["text"]))]


def platt(x: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and intercept of P(1 | x), by Newton's method with Platt's targets."""
    n1, n0 = y.sum(), len(y) - y.sum()
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 0.0, math.log((n1 + 1) / (n0 + 1))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -35, 35)))
        w = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((p - t) * x).sum() + 1e-6 * a, (p - t).sum()])
        h = np.array([[(w * x * x).sum() + 1e-6, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-9]])
        da, db = np.linalg.solve(h, g)
        a, b = a - da, b - db
        if abs(da) + abs(db) < 1e-9 * (1 + abs(a) + abs(b)):
            break
    return float(a), float(b)


@dataclass
class Model:
    """Raw dictionaries and the calibration; without dictionaries, a constant."""

    good: bytes | None
    bad: bytes | None
    slope: float
    intercept: float

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        out = []
        for raw in (self.good, self.bad):
            d = zstandard.ZstdCompressionDict(raw)
            d.precompute_compress(LEVEL)
            out.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))
        return out

    def differences(self, texts: list[str | None]) -> np.ndarray:
        if self.good is None or self.bad is None:
            return np.zeros(len(texts))
        good, bad = self.compressors()
        out = np.zeros(len(texts))
        for i, text in enumerate(texts):
            raw = memoryview((text or "").encode())
            g = b = 0
            for k in range(0, len(raw), BLOCK):
                block = raw[k : k + BLOCK]
                g += len(good.compress(block))
                b += len(bad.compress(block))
            out[i] = (b - g) / (b + g) if b + g else 0.0
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.differences(texts) + self.intercept, -35, 35)))


def fit(rows: list[tuple[int, str]], dictionary: int = DICTIONARY) -> Model:
    """Dictionaries from every other row of each label, calibration from the
    rest (from all rows where a label has one only). A label without any text
    leaves nothing to compare: a constant by the number of rows."""
    by = {y: [t for l, t in rows if l == y] for y in (0, 1)}
    if not by[0] or not by[1]:
        n1, n = len(by[1]), len(rows)
        return Model(None, None, 0.0, math.log((n1 + 1) / (n - n1 + 1)))
    raw = {}
    for y in (0, 1):
        texts = [t.encode() for t in by[y][::2]]
        try:
            raw[y] = zstandard.train_dictionary(min(dictionary, max(1024, sum(map(len, texts)) // 4)), texts).as_bytes()
        except zstandard.ZstdError:  # too little text for training: its end is the dictionary
            raw[y] = b"".join(texts)[-dictionary:]
    model = Model(raw[1], raw[0], 0.0, 0.0)
    rest = [(y, t) for y in (0, 1) for t in by[y][1::2] or by[y]]
    model.slope, model.intercept = platt(model.differences([t for _, t in rest]), np.array([y for y, _ in rest]))
    return model


def prior_shift(model: Model, sample: list[tuple[int, str]], share: float) -> Model:
    """The intercept for labels of which ``share`` are 1, not as in the sample."""
    n1 = sum(y for y, _ in sample)
    if model.good is None or not 0 < n1 < len(sample) or not 0 < share < 1:
        return model
    model.intercept += math.log(share / (1 - share)) - math.log(n1 / (len(sample) - n1))
    return model


def score_quality(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score), one row per row of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(m.scores(batch.column(1).to_pylist()), pa.float64())], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, score double")


def train(docs: DataFrame, labels: DataFrame, learn: Column, sample_docs: int = SAMPLE_DOCS) -> Model:
    rows = labelled_sample(docs, labels, "quality", learn, 2 * sample_docs, SAMPLE_BYTES, "quality")
    share = labels.filter(learn & F.col("quality").isin(0, 1)).agg(F.avg("quality")).first()[0]
    model = fit(rows)
    return prior_shift(model, rows, float(share)) if share is not None else model


def training_rows(doc_id: Column) -> Column:
    return crc_mod(doc_id, 4) != 2


def op8_quality(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = score_quality(docs, train(docs, labels, training_rows(F.col("doc_id"))))
    return out.select("doc_id", (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
