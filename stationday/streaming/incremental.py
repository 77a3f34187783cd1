"""Incremental upsert from newly arrived files.

The reference consumes a change feed on its staging table. Here the feed
is the landing folder itself: a Structured Streaming file source lists it,
the checkpoint remembers which files were consumed, and each micro-batch
is parsed once, into a staging partition of its own, and deduped and upserted
into the observations table from there, inside ``foreachBatch``.
``trigger(availableNow=True)`` processes what has arrived and stops; an idle
run starts no batch at all.

Exactly-once effect: a batch's load id follows from its checkpoint and
number, its staging partition is overwritten and its upsert is idempotent (same
keys, same values), so a batch replayed after a failure before its commit
changes nothing. The batch is recorded like a batch load
(``plans/progress.py``): daily temps and analytics are recomputed once per run,
for all loads that have not had them, also those of a run that stopped before.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationday.config import PipelineConfig
from stationday.operators.parse import parse_observations
from stationday.plans import progress
from stationday.plans.pipeline import run_downstream
from stationday.plans.stages import StageResult, Tables, require_table, upsert_observations
from stationday.schemas import LOAD_ID
from stationday.sources.tables import append_table, overwrite_partitions


def observation_stream(spark: SparkSession, landing: str, column: str = "weather_json", kind: str = "lines",
                       max_files_per_trigger: int | None = None, clean_source: str = "off",
                       archive_dir: str | None = None, max_file_age: str | None = None) -> DataFrame:
    """Streaming rows of the files that arrive in ``landing``, one VARIANT each.

    ``max_files_per_trigger`` bounds a micro-batch. On a long-lived landing
    folder, ``clean_source="archive"`` (with ``archive_dir``) or ``"delete"``
    moves consumed files away and ``max_file_age`` lets the source forget
    old entries, so neither the listing nor the source's file log grows
    without bound.
    """
    # files may land in sub-folders (one per drop or day)
    r = spark.readStream.option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if clean_source != "off":
        r = r.option("cleanSource", clean_source)
        if archive_dir:
            r = r.option("sourceArchiveDir", archive_dir)
    if max_file_age:
        r = r.option("maxFileAge", max_file_age)
    meta = [F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_modification_time").alias("_mtime")]
    if kind == "lines":
        df = r.format("json").option("singleVariantColumn", column).option("mode", "FAILFAST").load(landing)
        return df.select(F.col(column), *meta, F.lit(None).cast("bigint").alias("_pos"))
    if kind == "array":
        df = r.format("text").option("wholetext", True).load(landing)
        arr = F.from_json(F.col("value"), "array<variant>", {"mode": "FAILFAST"})
        staged = df.select(arr.alias("_arr"), *meta)
        return staged.select(F.posexplode("_arr").alias("_p", column), "_file", "_mtime").select(
            column, "_file", "_mtime", F.col("_p").cast("bigint").alias("_pos"))
    raise ValueError(f"unknown JSON file kind {kind!r}")


@dataclass
class IncrementalRun:
    batches: list[int] = field(default_factory=list)
    source_rows: int = 0
    dropped_null_keys: int = 0
    results: list[StageResult] = field(default_factory=list)


def _run(spark: SparkSession, stream: DataFrame, checkpoint: str, fn: Callable[[DataFrame, int], None]) -> None:
    q = (stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:  # pragma: no cover - surfaced by awaitTermination already
        raise q.exception()


def skip_existing_files(spark: SparkSession, landing: str, checkpoint: str, kind: str = "lines",
                        column: str = "weather_json") -> None:
    """Mark the files already in ``landing`` as consumed without reading them
    (the feed shows no initial rows)."""
    _run(spark, observation_stream(spark, landing, column, kind), checkpoint, lambda df, i: None)


def incremental_upsert(spark: SparkSession, cfg: PipelineConfig, landing: str, checkpoint: str,
                       kind: str = "lines", parse_mode: str = "strict", downstream: bool = False,
                       max_files_per_trigger: int | None = None, clean_source: str = "off",
                       archive_dir: str | None = None, max_file_age: str | None = None) -> IncrementalRun:
    """Upsert every newly arrived file of ``landing`` into observations.

    With ``downstream`` the daily temps and analytics of all unfinished loads
    are recomputed once, after the last batch.
    """
    t = Tables(cfg)
    require_table(spark, t.name("observations"))
    run = IncrementalRun()
    feed = uuid.uuid5(uuid.NAMESPACE_URL, checkpoint).hex[:12]
    staging, log = t.name("observation_staging"), t.name("load_log")

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        load_id = f"stream-{feed}-{batch_id:012d}"
        overwrite_partitions(batch.select("weather_json", "_file", "_mtime", "_pos", F.lit(load_id).alias(LOAD_ID)), staging)
        rows = spark.table(staging).filter(F.col(LOAD_ID) == load_id)
        parsed = parse_observations(rows, mode=parse_mode, sequence_field=cfg.sequence_field)
        n, dropped = upsert_observations(spark, t, parsed, "drop", load_id)
        # committed last: until then no batch run takes these rows for its own
        progress.mark(spark, t, [load_id], "stations", "observations")
        files = rows.select("_file", "_mtime").distinct()
        append_table(files.select(F.lit(staging).alias("staging_table"), "_file", "_mtime",
                                  F.lit(load_id).alias(LOAD_ID)), log)
        run.batches.append(batch_id)
        run.source_rows += n
        run.dropped_null_keys += dropped

    stream = observation_stream(spark, landing, "weather_json", kind, max_files_per_trigger,
                                clean_source, archive_dir, max_file_age)
    _run(spark, stream, checkpoint, on_batch)
    if downstream:
        run.results = run_downstream(spark, t)
    return run
