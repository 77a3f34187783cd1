"""Several grains in one pass, distinct counts that roll up, and snapshot differences."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def by_grouping_sets(df: DataFrame, sets: Sequence[Sequence[str]], measures: Mapping[str, Column]) -> DataFrame:
    """The measures for every grouping set, with ``grouping_id`` (a bit for each
    column, in order of first mention, 1 where it is summed over).

    One Expand feeds one aggregate: rows are aggregated partially before the
    shuffle, so a set with few groups ships few rows, and a NULL that stands
    for "all" is told from a NULL of the data by its id.
    """
    cols = list(dict.fromkeys(c for s in sets for c in s))
    grouped = df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in cols])
    return grouped.agg(F.grouping_id(*cols).cast("long").alias("grouping_id"), *[m.alias(n) for n, m in measures.items()])


def sketch(df: DataFrame, keys: Sequence[str], column: str, bits: int = 14) -> DataFrame:
    """(keys, rows, sketch): a HyperLogLog sketch of the distinct values per key,
    of fixed size (2**bits buckets), to be stored and merged."""
    return df.groupBy(*keys).agg(F.count(F.col(column)).alias("n_values"), F.hll_sketch_agg(column, F.lit(bits)).alias("sketch"))


def merged(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, n_values, approx_distinct) of stored sketches rolled up to coarser keys;
    no value is read again. The relative error is about 0.8 / sqrt(2**bits)."""
    out = sketches.groupBy(*keys).agg(F.sum("n_values").alias("n_values"), F.hll_union_agg("sketch").alias("sketch"))
    return out.select(*keys, "n_values", F.hll_sketch_estimate("sketch").alias("approx_distinct"))


def snapshot_diff(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What turns ``before`` into ``after``: (keys, change, copies, other columns
    of both). Rows are bags: ``copies`` says how many more of them there are.

    ``change`` is ``insert`` or ``delete``, or ``update`` for a key that has
    exactly one row lost and one gained; an update gives the new row, with the
    old values in ``old_`` columns. NULLs compare as equal. One aggregation over whole
    rows, partial before the shuffle, leaves the differing rows; only those
    are grouped by key.
    """
    keys = list(keys)
    cols = before.columns
    tagged = before.withColumn("_n", F.lit(-1)).unionByName(after.select(*cols).withColumn("_n", F.lit(1)))
    moved = tagged.groupBy(*cols).agg(F.sum("_n").alias("_n")).filter("_n != 0")
    rest = [c for c in cols if c not in keys]
    row = F.struct(*rest) if rest else F.struct(F.lit(True).alias("_none"))
    # all differing rows of a key are needed only to see whether there are two
    per_key = moved.groupBy(*keys).agg(F.count(F.lit(1)).alias("_k"), F.sum("_n").alias("_sum"), F.sum(F.abs("_n")).alias("_abs"),
                                       F.max(F.when(F.col("_n") < 0, row)).alias("_old"), F.max(F.when(F.col("_n") > 0, row)).alias("_new"))
    one = (F.col("_k") == 2) & (F.col("_sum") == 0) & (F.col("_abs") == 2)
    updates = per_key.filter(one).select(*keys, F.lit("update").alias("change"), F.lit(1).cast("long").alias("copies"),
                                         *[F.col(f"_new.{c}").alias(c) for c in rest], *[F.col(f"_old.{c}").alias(f"old_{c}") for c in rest])
    same = [F.col(f"m.{k}").eqNullSafe(F.col(f"u.{k}")) for k in keys]
    on = same[0]
    for s in same[1:]:
        on = on & s
    others = moved.alias("m").join(per_key.filter(one).select(*keys).alias("u"), on, "left_anti")
    others = others.select(*keys, F.when(F.col("_n") > 0, "insert").otherwise("delete").alias("change"), F.abs("_n").alias("copies"),
                           *[F.col(c) for c in rest], *[F.lit(None).cast(before.schema[c].dataType).alias(f"old_{c}") for c in rest])
    return updates.unionByName(others)
