"""Typed Parquet tables in the session catalog."""

from __future__ import annotations

import threading
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stationday.schemas import LOAD_ID, PERIOD_COL, STATION_BUCKET, TableSpec


@contextmanager
def session_conf(spark: SparkSession, key: str, value: str):
    """Set a session setting for a block and restore it after. When it
    already has the value nothing is touched, so nested blocks (and writes
    running in threads inside an outer block) never reset it early."""
    old = spark.conf.get(key, None)
    if old is not None and old.lower() == value.lower():
        yield
        return
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


_conf = session_conf
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
# The overwrite mode is a session setting read when a write is planned:
# writes that depend on it hold this lock, so concurrent callers in one
# process (threads sharing a session) never see each other's mode.
_WRITE_LOCK = threading.RLock()


def ensure_database(spark: SparkSession, db: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`{loc}")


def table_exists(spark: SparkSession, full_name: str) -> bool:
    """Does the table exist (no data is read)."""
    return spark.catalog.tableExists(full_name)


def _folder_exists(spark: SparkSession, location: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def ensure_table(spark: SparkSession, full_name: str, spec: TableSpec, location: str | None = None) -> bool:
    """Create the table from its declared schema if missing (S8); True if created.

    A catalog that does not outlive its session creates the table anew over
    the files of earlier ones: their partitions are registered again, or the
    table would read as empty and the next upsert would replace them."""
    if table_exists(spark, full_name):
        return False
    part = f" PARTITIONED BY (`{spec.partition_col}`)" if spec.partition_col else ""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {full_name} ({spec.ddl()}) USING parquet{part}{loc}")
    if spec.partition_col and location and _folder_exists(spark, location):
        spark.sql(f"ALTER TABLE {full_name} RECOVER PARTITIONS")
    return True


def spread(df: DataFrame) -> DataFrame:
    """Rows of a partition brought together before a write, so that a period
    gets about one file and not one from every task; AQE splits large periods
    and joins small ones."""
    last = df.columns[-1]  # by declaration the partition column, where there is one
    return df.hint("rebalance", last) if last in (PERIOD_COL, STATION_BUCKET, LOAD_ID) else df


def append_table(df: DataFrame, full_name: str) -> None:
    spread(df).write.insertInto(full_name, overwrite=False)


def overwrite_table(df: DataFrame, full_name: str) -> None:
    """Replace all rows (S7). The plan must not read the same table."""
    with _WRITE_LOCK, _conf(df.sparkSession, OVERWRITE_MODE, "static"):
        spread(df).write.insertInto(full_name, overwrite=True)


def overwrite_partitions(df: DataFrame, full_name: str) -> None:
    """Replace only the partitions that ``df`` has rows for.

    Each task writes to a staging folder; the touched partition folders are
    swapped in at job commit, so a lost executor's task is simply rerun
    against the old files, which are still in place until then.
    """
    with _WRITE_LOCK, _conf(df.sparkSession, OVERWRITE_MODE, "dynamic"):
        spread(df).write.insertInto(full_name, overwrite=True)


def empty_like(spark: SparkSession, full_name: str) -> DataFrame:
    """No rows, same schema as the table."""
    return spark.table(full_name).limit(0)


def empty_from_schema(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows of a declared schema."""
    return spark.createDataFrame([], schema)


def comment_table(spark: SparkSession, full_name: str, text: str) -> None:
    """Attach a provenance tag to a table."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"COMMENT ON TABLE {full_name} IS '{escaped}'")


def drop_table(spark: SparkSession, full_name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {full_name}")
