"""Request planning of the fetcher, re-aimed as table operators."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the source's request planning.
DEFAULT_START = "2020-01-01"  # default first day of the date window
PAGE_SIZE = 1000              # records per page of the remote service


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def yearly_chunk_starts(start, end, include_last_day: bool = False) -> Column:
    """Starts of the at-most-one-year chunks covering [start, end).

    The first start is ``start``; the next is one year later, where a
    29 February steps to 28 February and stays on the 28th. A start must be
    before ``end`` (or equal to it with ``include_last_day``), so a range
    with ``start == end`` has no chunk, as in the source loop.
    """
    a, b = _c(start).cast("date"), _c(end).cast("date")
    n = F.greatest(F.year(b) - F.year(a), F.lit(0))
    later = F.transform(F.sequence(F.lit(0), n), lambda k: F.add_months(F.add_months(a, 12), k * 12))
    starts = F.concat(F.array(a), later)
    keep = (lambda x: x <= b) if include_last_day else (lambda x: x < b)
    return F.filter(starts, keep)


def split_yearly(df: DataFrame, start: str, end: str, include_last_day: bool = False,
                 start_name: str = "chunk_start", end_name: str = "chunk_end") -> DataFrame:
    """One row per chunk of each row's [start, end] range.

    The chunk end is the day before the next start, capped at ``end``.
    By default the day equal to ``end`` is left out when a chunk ends just
    before it, as the source loop does; ``include_last_day`` covers it.
    """
    b = F.col(end).cast("date")
    out = df.withColumn(start_name, F.explode(yearly_chunk_starts(start, end, include_last_day)))
    return out.withColumn(end_name, F.least(F.date_sub(F.add_months(F.col(start_name), 12), 1), b))


def page_offsets(count, page_size: int = PAGE_SIZE) -> Column:
    """1, 1 + page_size, ... while the offset is at most ``count``; at least one."""
    return F.sequence(F.lit(1).cast("bigint"), F.greatest(_c(count).cast("bigint"), F.lit(1).cast("bigint")),
                      F.lit(page_size).cast("bigint"))


def page_plan(df: DataFrame, count: str, page_size: int = PAGE_SIZE, name: str = "page_offset") -> DataFrame:
    """One row per page to request for each row's result count (R2)."""
    return df.withColumn(name, F.explode(page_offsets(count, page_size)))


def missing_dimension(fact_keys: DataFrame, dimension: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Distinct fact keys that have no dimension row (R3): a left anti join."""
    dim_key = dim_key or key
    keys = fact_keys.select(key).distinct()
    dim = dimension.select(F.col(dim_key).alias("__k")).distinct()
    return keys.join(dim, keys[key] == dim["__k"], "left_anti")


def filter_window(df: DataFrame, date_col: str, start: str | None = None, end: str | None = None,
                  kinds: Sequence[str] | None = None, kind_col: str = "datatype",
                  places: Sequence[str] | None = None, place_col: str = "zip_code") -> DataFrame:
    """Rows in a date window with both ends included, of some kinds and places.

    The start defaults to 2020-01-01 and the end to today. Every predicate
    is a plain comparison or ``IN`` that Catalyst pushes to the scan.
    """
    lo = F.to_date(F.lit(start or DEFAULT_START))
    hi = F.to_date(F.lit(end)) if end else F.lit(dt.date.today())
    d = F.col(date_col)
    if isinstance(df.schema[date_col].dataType, (T.TimestampNTZType, T.TimestampType)):
        # a range on the raw timestamp, so that min/max statistics prune row groups
        ts = df.schema[date_col].dataType.simpleString()
        cond = (d >= lo.cast(ts)) & (d < F.date_add(hi, 1).cast(ts))
    else:
        cond = d.cast("date").between(lo, hi)
    if kinds is not None:
        cond = cond & F.col(kind_col).isin(list(kinds))
    if places is not None:
        cond = cond & F.col(place_col).isin(list(places))
    return df.filter(cond)


def union_tagged(parts: dict, tag: str) -> DataFrame:
    """Union by name of several inputs, each tagged with its name."""
    out = None
    for name, df in parts.items():
        t = df.withColumn(tag, F.lit(name))
        out = t if out is None else out.unionByName(t, allowMissingColumns=True)
    return out
