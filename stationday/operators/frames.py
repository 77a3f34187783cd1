"""Rolling frames and runs of days per key, with hot keys split by period."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PERIOD = 128  # days that a window partition holds, besides its halo


def _day(date: str) -> Column:
    return F.datediff(F.col(date).cast("date"), F.lit("1970-01-01").cast("date"))


def rolling(df: DataFrame, keys: Sequence[str], date: str, days: int, measures: Mapping[str, Column],
            period: int = PERIOD) -> DataFrame:
    """``df`` with an aggregate over the last ``days`` days of its key for every
    measure (name -> aggregate column), the row's own day included.

    The frame is a range of dates, so missing days count as missing and rows
    of one day see each other. A window partition is a key and a period: each
    row is in its own period and, if it is within ``days - 1`` days of the
    end, also in the next ones that look back to it, as a halo row that only
    feeds frames. So one exchange does it and no partition follows the key's
    whole history. Rows with a NULL date get NULL measures.
    """
    keys = list(keys)
    day = F.col("_day")
    own = F.floor(day / F.lit(period))
    last = F.floor((day + F.lit(days - 1)) / F.lit(period))
    dated = df.withColumn("_day", _day(date))
    spread = dated.filter(F.col("_day").isNotNull()).withColumn("_own", own).withColumn("_period", F.explode(F.sequence(own, last)))
    frame = Window.partitionBy(*keys, "_period").orderBy("_day").rangeBetween(-(days - 1), 0)
    out = spread.select("*", *[m.over(frame).alias(name) for name, m in measures.items()])
    out = out.filter(F.col("_period") == F.col("_own")).select(*df.columns, *measures)
    types = {name: out.schema[name].dataType for name in measures}
    rest = dated.filter(F.col("_day").isNull()).select(*df.columns, *[F.lit(None).cast(t).alias(n) for n, t in types.items()])
    return out.unionByName(rest)


def runs(df: DataFrame, keys: Sequence[str], date: str, flag: Column, period: int = PERIOD) -> DataFrame:
    """Runs of consecutive days on which ``flag`` holds: (keys, run_start,
    run_end, run_days), one row per run.

    A day counts once, however many rows it has (distinct days are aggregated
    before the shuffle). Runs are found within periods first; pieces that
    touch across a period's border are then joined, over one row per piece.
    Rows whose flag or date is NULL belong to no run.
    """
    keys = list(keys)
    days = df.filter(flag & F.col(date).isNotNull()).select(*keys, _day(date).alias("_day")).distinct()
    days = days.withColumn("_period", F.floor(F.col("_day") / F.lit(period)))
    order = Window.partitionBy(*keys, "_period").orderBy("_day")
    # consecutive days less their rank are equal
    piece = days.withColumn("_run", F.col("_day") - F.row_number().over(order))
    piece = piece.groupBy(*keys, "_period", "_run").agg(F.min("_day").alias("_s"), F.max("_day").alias("_e"))
    per_key = Window.partitionBy(*keys).orderBy("_s")
    starts = piece.withColumn("_new", (F.col("_s") != F.lag("_e", 1).over(per_key) + 1).cast("int"))
    number = F.sum(F.coalesce("_new", F.lit(1))).over(per_key.rowsBetween(Window.unboundedPreceding, 0))
    joined = starts.withColumn("_n", number).groupBy(*keys, "_n").agg(F.min("_s").alias("_s"), F.max("_e").alias("_e"))
    at = lambda c: F.date_add(F.lit("1970-01-01").cast("date"), F.col(c))
    return joined.select(*keys, at("_s").alias("run_start"), at("_e").alias("run_end"), (F.col("_e") - F.col("_s") + 1).cast("long").alias("run_days"))
