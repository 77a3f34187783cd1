"""Distinct rows, distinct keys and keyed dedupe."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_rows(df: DataFrame) -> DataFrame:
    """A5."""
    return df.distinct()


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A7."""
    return df.select(*keys).distinct()


def dedupe_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = (),
                  tiebreak: Sequence[str] = ()) -> DataFrame:
    """One row per key: the greatest by ``order``, then ``tiebreak``, then the rest.

    Implemented as ``max(struct(order..., tiebreak..., rest...))`` per key.
    The aggregate runs partially before the shuffle, so a key that holds a
    large share of all rows sends at most one row per map task across the
    network: a hot key never lands whole in one task. Including every
    non-key column in the ordering makes the survivor fully determined.
    NULL orders below any value.
    """
    keys = list(keys)
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    named = {o for o in order if isinstance(o, str)}
    rest = [c for c in df.columns if c not in keys and c not in tiebreak and c not in named]
    fields = [c if isinstance(o, str) else c.alias(f"__o{i}") for i, (o, c) in enumerate(zip(order, order_cols))]
    fields += [F.col(c) for c in tiebreak] + [F.col(c) for c in rest]
    best = F.max(F.struct(*fields)).alias("__best")
    out = df.groupBy(*keys).agg(best)
    return out.select(*[F.col(c) if c in keys else F.col(f"__best.{c}").alias(c) for c in df.columns])


def dedupe_by_row_number(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Same survivor rule as a window; kept for plan comparisons only.

    Every row of a key is shuffled to one task before ranking, so a hot
    key is not split: prefer :func:`dedupe_latest`.
    """
    from pyspark.sql import Window

    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")
