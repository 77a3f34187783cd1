"""Joins by time: as-of (latest earlier record) and interval (record inside a period).

Neither compares every pair of a key. The as-of join is a union of both
sides' distinct times and a carry-forward in time order; the interval join
is an equi-join on time buckets that are sized by the periods' own lengths.
A key with a third of all rows is split by time in both.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY = 86_400


def _seconds(time: Column) -> Column:
    """A date, timestamp or timestamp_ntz as seconds since 1970 in the session's
    own clock, with a fraction."""
    whole = F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), time.cast("timestamp_ntz"))
    return whole.cast("long")


def _no_null(cols: Sequence[str]) -> Column:
    out = F.lit(True)
    for c in cols:
        out = out & F.col(c).isNotNull()
    return out


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], time: str, values: Sequence[str],
              prefix: str = "asof_", tiebreak: Sequence[str] = (), strict: bool = False,
              tolerance: int | None = None, span: int = 7 * DAY) -> DataFrame:
    """``left`` with the latest row of ``right`` per key whose time is not later.

    Adds ``prefix + time`` and ``prefix + value`` for each value, NULL where
    there is no earlier row. ``strict`` excludes rows of the same time;
    ``tolerance`` (seconds) leaves out matches that are older. Of right rows
    with equal key and time the greatest ``tiebreak``, then the greatest
    values, is taken. Rows of ``left`` with a NULL key or time match nothing
    and stay; such rows of ``right`` never match.

    Only distinct (key, time) pairs are ordered, so equal rows cost nothing,
    and they are ordered within buckets of ``span`` seconds. What is latest in
    a bucket is carried to later ones as one row per key and bucket. So a
    window holds a key's distinct times of one ``span``, however hot the key.
    The rows of ``left`` meet their match in an equi-join, which AQE splits on
    skew or broadcasts by size.
    """
    keys, values = list(keys), list(values)
    bucket = F.floor(_seconds(F.col(time)) / F.lit(span))
    match = F.struct(F.col(time).alias("t"), *[F.col(c) for c in (*tiebreak, *values) if c not in keys])
    best = right.filter(_no_null([*keys, time])).groupBy(*keys, time).agg(F.max(match).alias("_m"))
    points = left.filter(_no_null([*keys, time])).select(*keys, time).distinct()
    # at equal times the right row comes first unless it must be earlier
    side = (1, 0) if strict else (0, 1)
    both = best.select(*keys, time, F.lit(side[0]).alias("_side"), "_m").unionByName(
        points.select(*keys, time, F.lit(side[1]).alias("_side"), F.lit(None).cast(best.schema["_m"].dataType).alias("_m")))
    both = both.withColumn("_bucket", bucket)
    inside = Window.partitionBy(*keys, "_bucket").orderBy(time, "_side").rowsBetween(Window.unboundedPreceding, 0)
    here = both.withColumn("_here", F.last("_m", ignorenulls=True).over(inside)).filter(F.col("_side") == side[1])
    # the last row of each bucket, carried over the buckets of its key
    ends = both.groupBy(*keys, "_bucket").agg(F.max("_m").alias("_end"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("_carried", F.last("_end", ignorenulls=True).over(before)).select(*keys, "_bucket", "_carried")
    found = here.join(carried, [*keys, "_bucket"], "left").withColumn("_m", F.coalesce("_here", "_carried"))
    if tolerance is not None:
        near = _seconds(F.col(time)) - _seconds(F.col("_m.t")) <= F.lit(tolerance)
        found = found.withColumn("_m", F.when(near, F.col("_m")))
    found = found.select(*keys, time, F.col("_m.t").alias(prefix + time),
                         *[F.col(c if c in keys else f"_m.{c}").alias(prefix + c) for c in values])
    return left.join(found, [*keys, time], "left").select(*[left[c] for c in left.columns],
                                                         prefix + time, *[prefix + c for c in values])


LEVEL_FACTOR = 4


def interval_join(points: DataFrame, periods: DataFrame, keys: Sequence[str], time: str, start: str, end: str,
                  closed: bool = True, base: int = DAY) -> DataFrame:
    """Pairs of a point and a period of the same key with ``start <= time <= end``
    (``time < end`` unless ``closed``). Columns: those of ``points``, then those
    of ``periods`` but the keys; other names must differ.

    A period goes to the level of buckets (``base * 4**level`` seconds) of
    which it overlaps five at most, so it becomes five rows at most, however
    long it is. A point becomes one row for each level that periods have, of
    which there are at most 18 from a day to the longest interval of dates. Both sides meet in an
    equi-join on (key, level, bucket) with the exact test as its residual;
    AQE splits it on skew. Rows with a NULL key or time, and empty periods
    (end before start), match nothing.
    """
    keys = list(keys)
    s, e = _seconds(F.col(start)), _seconds(F.col(end))
    periods = periods.filter(_no_null([*keys, start, end]) & (F.col(start) <= F.col(end)))
    level = F.greatest(F.lit(0), F.ceil(F.log(float(LEVEL_FACTOR), (e - s + 1) / F.lit(LEVEL_FACTOR * base)))).cast("int")
    width = F.pow(F.lit(float(LEVEL_FACTOR)), F.col("_level")).cast("long") * F.lit(base)
    placed = periods.withColumn("_level", level)
    rows = placed.withColumn("_bucket", F.explode(F.sequence(F.floor(s / width), F.floor(e / width))))
    # a few numbers, whatever the data's size
    levels = sorted(r["_level"] for r in placed.select("_level").distinct().collect())
    at = points.filter(_no_null([*keys, time])).withColumn("_level", F.explode(F.array(*[F.lit(x) for x in levels]).cast("array<int>")))
    at = at.withColumn("_bucket", F.floor(_seconds(F.col(time)) / width))
    joined = at.join(rows, [*keys, "_level", "_bucket"])
    upper = F.col(time) <= F.col(end) if closed else F.col(time) < F.col(end)
    rest = [c for c in periods.columns if c not in keys]
    return joined.filter((F.col(start) <= F.col(time)) & upper).select(*points.columns, *rest)
