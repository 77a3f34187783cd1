"""Load JSON records as rows with one VARIANT column.

Two file kinds are read:

* **array files** -- the whole file is one JSON array and every element
  becomes a row (the outer array is stripped). A file is
  read whole by one task, so land many files for large volumes. Parsing
  runs in FAILFAST mode: a truncated or malformed file raises instead of
  silently loading zero rows.
* **JSON Lines** -- one record per line; splittable, so one large file is
  read by many tasks. This is the form to use at scale.

The compression codec is taken from the file extension (``.gz``, ``.bz2``,
...). Every row keeps the file it came from, the file's modification time
and, for array files, its position in the array; the dedupe uses them to
make "the latest record wins" deterministic.
"""

from __future__ import annotations

import datetime as dt
import math
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationday.config import fresh_dir
from stationday.schemas import LOAD_ID
from stationday.sources.tables import append_table, comment_table


#: Files of one committed batch of a load, about: what the driver names at a time.
BATCH_FILES = 10_000


def literal_path(path: str) -> str:
    """A path that names just itself: pattern characters escaped."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def _ingest_cols(pos=None):
    return [
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_modification_time").alias("_mtime"),
        (pos if pos is not None else F.lit(None)).cast("bigint").alias("_pos"),
    ]


def read_json_array_files(spark: SparkSession, path, column: str) -> DataFrame:
    """One row per element of the outer array of each file."""
    raw = spark.read.option("wholetext", True).text(path)
    # FAILFAST raises on anything that is not an array
    parsed = F.from_json(F.col("value"), "array<variant>", {"mode": "FAILFAST"})
    staged = raw.select(parsed.alias("_arr"), *_ingest_cols(F.lit(None)))
    return staged.select(
        F.posexplode("_arr").alias("_p", column), "_file", "_mtime"
    ).select(column, "_file", "_mtime", F.col("_p").cast("bigint").alias("_pos"))


def read_json_lines(spark: SparkSession, path, column: str, mode: str = "FAILFAST") -> DataFrame:
    """One row per line; each line kept whole as a VARIANT."""
    df = spark.read.format("json").option("singleVariantColumn", column).option("mode", mode).load(path)
    return df.select(F.col(column), *_ingest_cols())


def read_json_rows(spark: SparkSession, path, column: str, kind: str = "array") -> DataFrame:
    if kind == "array":
        return read_json_array_files(spark, path, column)
    if kind == "lines":
        return read_json_lines(spark, path, column)
    raise ValueError(f"unknown JSON file kind {kind!r}")


def new_load_id() -> str:
    return f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"


def listed_files(spark: SparkSession, path) -> DataFrame:
    """(path, _file, _mtime) of the files of ``path``: a listing, no content is read."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", F.col("_metadata.file_path").alias("_file"),
                        F.col("_metadata.file_modification_time").alias("_mtime"))


def load_json_rows(spark: SparkSession, path, table: str, column: str, kind: str = "array",
                   comment: str | None = None, load_id: str | None = None, log_table: str | None = None) -> int:
    """Append the records of the files of ``path`` to the staging ``table``
    (S1, S12); returns how many files were loaded.

    Like a bulk copy with load history, a file already loaded (same path and
    modification time) is not loaded again; a rewritten file is. The listing
    is compared with the load log, one row per file, and only new files are
    opened. Their rows go to a new partition named by ``load_id``.

    The new files are a table, cut by a hash of their names into batches of
    about ``BATCH_FILES``; the driver holds the names of one batch. Each batch
    is a load of its own (the first has ``load_id``, later ones a number behind
    it) and is committed by its rows in the log, written last from that table:
    readers take committed loads only (``committed``), so a load that failed
    before leaves rows that nobody sees, its files are loaded again by the next
    run, and batches done before stay done. Without a log the staged rows
    themselves are the history.
    """
    load_id = load_id or new_load_id()
    if log_table:
        loaded = spark.table(log_table).filter(F.col("staging_table") == table).select("_file", "_mtime")
    else:
        loaded = spark.table(table).select("_file", "_mtime").distinct()
    listing = fresh_dir(spark, "new-files")
    listed_files(spark, path).join(loaded, ["_file", "_mtime"], "left_anti").write.parquet(listing)
    new = spark.read.schema("_file string, _mtime timestamp, path string").parquet(listing)
    n = new.count()
    batches = math.ceil(n / BATCH_FILES)
    number = F.pmod(F.xxhash64("path"), F.lit(batches))
    for b in range(batches):
        own = new.filter(number == b)
        names = [literal_path(r["path"]) for r in own.select("path").collect()]
        if not names:
            continue
        own_id = F.lit(f"{load_id}-{b:06d}" if b else load_id).alias(LOAD_ID)
        rows = read_json_rows(spark, names, column, kind)
        append_table(rows.select(column, "_file", "_mtime", "_pos", own_id), table)
        if log_table:
            append_table(own.coalesce(1).select(F.lit(table).alias("staging_table"), "_file", "_mtime", own_id), log_table)
    if comment is not None:
        comment_table(spark, table, comment)
    return n


def committed(spark: SparkSession, table: str, log_table: str) -> DataFrame:
    """Rows of a staging table that belong to a load in the log."""
    loads = spark.table(log_table).filter(F.col("staging_table") == table).select(LOAD_ID).distinct()
    staged = spark.table(table)
    return staged.join(loads, LOAD_ID, "left_semi").select(*staged.columns)


def tag_from_path(df: DataFrame, name: str, pattern: str, group: int = 1) -> DataFrame:
    """Add a column taken from each row's file path, e.g. the zip code of
    ``.../zip=02128/part-0.json`` with ``pattern=r"zip=([^/]+)"`` (P14)."""
    return df.withColumn(name, F.regexp_extract(F.col("_file"), pattern, group))


@dataclass(frozen=True)
class LoadSpec:
    """One staging table and where its files are."""

    path: str
    table: str
    column: str
    kind: str = "array"


def load_all(spark: SparkSession, specs: dict[str, LoadSpec], comment: str | None = None,
             load_id: str | None = None, log_table: str | None = None) -> int:
    """Load every declared staging table under one load id; how many files."""
    load_id = load_id or new_load_id()
    return sum(load_json_rows(spark, s.path, s.table, s.column, s.kind, comment, load_id=load_id, log_table=log_table)
               for s in specs.values())
