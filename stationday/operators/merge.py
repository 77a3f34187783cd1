"""Keyed upsert on plain Parquet tables.

``merge_frames`` is the pure part: a full outer join of target and source
on the keys, and per column the value a ``MERGE ... WHEN MATCHED UPDATE /
WHEN NOT MATCHED INSERT`` would leave. ``merge_into`` applies it to a
partitioned table and rewrites only the partitions the source touches:

1. touched = distinct partition values of the source, kept as a small table in
   the work folder: a narrow, map-side-aggregated scan of the key columns that
   also counts rows and NULL keys. No value of it comes to the driver;
2. the target is semi-joined with it, and dynamic partition pruning keeps
   untouched partitions out of the scan; they keep their files;
3. merged rows replace exactly those partitions (dynamic partition
   overwrite), and the target's old files stay in place until job commit,
   so a lost executor's tasks are rerun against them.

Keys are compared with ``=``, as in SQL: a NULL key never matches. Such
source rows are inserted (``null_keys="insert"``) or dropped
(``null_keys="drop"``); target rows with NULL keys are kept. Partition values
are never NULL (rows without a date have a partition of their own), so they
compare with ``=``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stationday.config import fresh_dir
from stationday.operators.dedupe import dedupe_latest
from stationday.schemas import TableSpec
from stationday.sources.tables import overwrite_partitions

# an update expression gets two accessors, src(c) and tgt(c), and returns a Column
UpdateExpr = Callable[[Callable[[str], Column], Callable[[str], Column]], Column]


def set_from_source(c: str) -> UpdateExpr:
    return lambda src, tgt: src(c)


def coalesce_source_target(c: str) -> UpdateExpr:
    """A NULL in the source never erases the target's value."""
    return lambda src, tgt: F.coalesce(src(c), tgt(c))


def _src(c: str) -> Column:
    return F.col(f"__s_{c}")


def _tgt(c: str) -> Column:
    return F.col(f"__t_{c}")


def key_condition(keys: Sequence[str]) -> Column:
    """Conjunction of equalities on 1..n keys."""
    cond = None
    for k in keys:
        e = _tgt(k) == _src(k)
        cond = e if cond is None else cond & e
    return cond


def merge_frames(target: DataFrame, source: DataFrame, keys: Sequence[str],
                 update: Mapping[str, UpdateExpr | str], insert: Sequence[str] | None = None,
                 columns: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``target`` after merging ``source`` into it.

    ``update`` maps a column to its new value for matched rows (``"source"``
    is shorthand for the source's value); unlisted columns keep the target's
    value. ``insert`` lists the columns an unmatched source row fills
    (all by default); the others are NULL.
    """
    columns = list(columns or target.columns)
    insert = set(columns if insert is None else insert)
    ttypes = {f.name: f.dataType for f in target.schema.fields}
    stypes = {f.name: f.dataType for f in source.schema.fields}
    t = target.select(*[F.col(c).alias(f"__t_{c}") for c in columns], F.lit(True).alias("__t"))
    s = source.select(*[F.col(c).alias(f"__s_{c}") for c in columns], F.lit(True).alias("__s"))
    j = t.join(s, key_condition(keys), "full_outer")
    in_t, in_s = F.col("__t").isNotNull(), F.col("__s").isNotNull()
    matched = in_t & in_s
    out = []
    for c in columns:
        if c in keys:
            out.append(F.when(in_t, _tgt(c)).otherwise(_src(c)).alias(c))
            continue
        u = update.get(c)
        if u == "source":
            u = set_from_source(c)
        upd = u(_src, _tgt) if u is not None else _tgt(c)
        ins = _src(c) if c in insert else F.lit(None)
        v = F.when(matched, upd).when(in_t, _tgt(c)).otherwise(ins)
        if ttypes[c] != stypes.get(c):  # same types on both sides (the usual case) need no cast
            v = v.cast(ttypes[c].simpleString())
        out.append(v.alias(c))
    return j.select(*out)


@dataclass(frozen=True)
class MergeResult:
    table: str
    source_rows: int  # rows offered, before the source was made unique
    touched: DataFrame | None  # partition values rewritten; None: the whole table
    dropped_null_keys: int = 0


def prepare_source(source: DataFrame, keys: Sequence[str], on_duplicate: str = "latest",
                   order: Sequence[str | Column] = (), tiebreak: Sequence[str] = ()) -> DataFrame:
    """Make source keys unique as declared.

    ``"latest"`` keeps the greatest row per key (see ``dedupe_latest``);
    ``"distinct"`` drops exact duplicates only, as ``SELECT DISTINCT``;
    ``"error"`` raises if a key occurs twice; ``"none"`` trusts the caller
    (the source is an aggregate grouped by the keys).
    """
    if on_duplicate == "none":
        return source
    if on_duplicate == "latest":
        return dedupe_latest(source, keys, order, tiebreak)
    if on_duplicate == "distinct":
        return source.distinct()
    if on_duplicate == "error":
        dup = source.groupBy(*keys).count().filter("count > 1")
        if not dup.isEmpty():
            raise ValueError(f"duplicate source keys on {list(keys)}")
        return source
    raise ValueError(f"unknown on_duplicate {on_duplicate!r}")


def kept_values(df: DataFrame, kind: str) -> DataFrame:
    """``df`` written once to the work folder and read back under a filter on
    the run's mark. A join with it on a partition column prunes the other side's
    partitions at run time, which needs a selective filter on this one."""
    mark = uuid.uuid4().hex
    path = f"{fresh_dir(df.sparkSession, kind)}"
    df.withColumn("__mark", F.lit(mark)).write.parquet(path)
    return df.sparkSession.read.parquet(path).filter(F.col("__mark") == mark).drop("__mark")


def in_partitions(df: DataFrame, col: str, touched: DataFrame | None) -> DataFrame:
    """Rows of the given partitions only (all when None)."""
    return df if touched is None else df.join(touched.select(col).distinct(), col, "left_semi").select(*df.columns)


def touched_partitions(source: DataFrame, spec: TableSpec) -> DataFrame:
    """(partition, has_null_key, n) of a source: the partition of a row depends
    on its keys only, so this reads no other column."""
    has_null = F.lit(False)
    for k in spec.keys:
        has_null = has_null | F.col(k).isNull()
    part = spec.partition_expr().cast(spec.partition_type).alias(spec.partition_col)
    counts = source.select(part, has_null.alias("null_key")).groupBy(spec.partition_col, "null_key")
    return kept_values(counts.agg(F.count(F.lit(1)).alias("n")), "touched")


def merge_into(spark: SparkSession, table: str, spec: TableSpec, source: DataFrame,
               update: Mapping[str, UpdateExpr | str], insert: Sequence[str] | None = None,
               on_duplicate: str = "latest", order: Sequence[str | Column] = (),
               tiebreak: Sequence[str] = (), null_keys: str = "insert",
               periods: DataFrame | None = None, whole: bool = False) -> MergeResult:
    """Upsert ``source`` into the partitioned table ``table`` (M1).

    ``periods`` (a frame with the partition column): when the caller knows
    which partitions the source's rows fall in, as a stage that recomputes
    given periods does, the source is computed only once, by the write.
    ``whole``: the source covers the whole table.
    """
    keys = list(spec.keys)
    if null_keys not in ("insert", "drop"):
        raise ValueError("null_keys must be 'insert' or 'drop'")
    src, dropped, n_src, seen = source, 0, None, None
    touched = periods
    if null_keys == "drop" or not (whole or periods is not None):
        counts = touched_partitions(source, spec)
        total = counts.agg(F.sum("n"), F.sum(F.when(F.col("null_key"), F.col("n")).otherwise(0))).first()
        n_src, nulls = total[0] or 0, total[1] or 0
        if null_keys == "drop":
            dropped, n_src = nulls, n_src - nulls
            counts = counts.filter(~F.col("null_key"))
            src = src.dropna("any", subset=keys)
        if n_src == 0:
            return MergeResult(table, 0, counts.select(spec.partition_col), dropped)
        if touched is None and not whole:
            touched = counts.select(spec.partition_col)
    else:
        seen = Observation()
        src = src.observe(seen, F.count(F.lit(1)).alias("n"))
    # dedupe, join and write are one plan: the source is not cached, so a
    # refresh-sized source never has to fit in executor storage
    prepared = spec.logical(spec.with_partition(prepare_source(src, keys, on_duplicate, order, tiebreak)))
    target = in_partitions(spark.table(table), spec.partition_col, touched)
    merged = merge_frames(spec.logical(target), prepared, keys, update, insert, spec.columns)
    overwrite_partitions(spec.with_partition(merged), table)
    return MergeResult(table, seen.get["n"] if seen is not None else n_src, touched, dropped)
