"""Event-time windows over arriving observations, with late rows kept aside.

Spark's own stateful aggregation does the work: ``withWatermark`` bounds the
state, a window is written once when the watermark passes its end, and the
checkpoint carries state and watermark over restarts. Rows that come after
their window was written are dropped by the aggregation; ``late_rows`` finds
exactly those, so that nothing is lost unseen: windows and late rows together
hold every row with a time.

Both write a folder per micro-batch and overwrite it when a batch is replayed,
so each row has its effect once. They read the same landing folder with a
checkpoint each; run them over the same arrivals (one run of each per arrival,
or the same ``max_files_per_trigger``) and they see the same batches.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: State that outgrows an executor's heap: kept in RocksDB, on local disk and in the checkpoint.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _write(path: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write


def _run(stream: DataFrame, checkpoint: str, fn: Callable[[DataFrame, int], None]) -> None:
    q = (stream.writeStream.outputMode("append").foreachBatch(fn)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def landed(spark: SparkSession, landing: str, schema: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The JSON Lines files that arrive in ``landing``, as a stream."""
    r = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("mode", "FAILFAST")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.json(landing)


def windowed(stream: DataFrame, time: str, delay: str, window: Column, keys: Sequence[str],
             measures: Mapping[str, Column]) -> DataFrame:
    """Closed windows as a stream: (window_start, window_end, keys, measures).

    ``window`` is ``F.window(...)`` or ``F.session_window(...)`` over ``time``;
    ``delay`` is how long after the latest time seen rows are still waited for.
    Each window and key is one row of state; rows are aggregated partially
    before the shuffle, so a hot key ships one row per task. Rows without a time
    belong to no window.
    """
    out = stream.filter(F.col(time).isNotNull()).withWatermark(time, delay).groupBy(window.alias("_w"), *keys).agg(*[m.alias(n) for n, m in measures.items()])
    return out.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *keys, *measures)


def close_windows(spark: SparkSession, stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process what has arrived; append the windows that closed to ``path``."""
    own = {"spark.sql.streaming.stateStore.providerClass": STATE_STORE}
    before = {k: spark.conf.get(k, None) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        _run(stream, checkpoint, _write(path))
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def keep_late_rows(spark: SparkSession, stream: DataFrame, time: str, delay: str, window_end: Callable[[Column], Column],
                   path: str, checkpoint: str) -> None:
    """Process what has arrived; write the rows that come too late for their
    window to ``path``: those whose ``window_end(time)`` is not after the latest
    time of earlier batches less ``delay``.

    The latest time of a batch is one number, written beside the batch's rows
    before they count as done, and read again after a restart.
    """

    def split(batch: DataFrame, number: int) -> None:
        marks = f"{path}_times"
        batch.agg(F.max(F.unix_micros(time)).alias("latest"), F.lit(number).alias("number")).write.mode("overwrite").parquet(f"{marks}/batch={number}")
        latest = spark.read.parquet(marks).filter(F.col("number") < number).agg(F.max("latest")).first()[0]
        if latest is None:
            late = F.lit(False)
        else:
            late = window_end(F.col(time)) <= F.timestamp_micros(F.lit(latest)) - F.expr(f"INTERVAL {delay}")
        _write(path)(batch.filter(late), number)

    _run(stream, checkpoint, split)
