"""Configuration and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession


def work_dir(spark: SparkSession) -> str:
    """Shared folder for tables, stream checkpoints and lineage cuts.

    On a cluster this is ``spark.checkpoint.dir`` (a shared filesystem the
    cluster names). Where it is unset a local session gets a fresh folder, set
    as its checkpoint dir; on a cluster, where every executor would write to a
    disk of its own, that is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: no SparkContext on the client
        sc = None
    d = None
    if sc is not None:
        d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        try:
            d = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:  # noqa: BLE001 - conf not readable on some clients
            d = None
    if not d:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="stationday-")
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def fresh_dir(spark: SparkSession, kind: str) -> str:
    """A new, never reused sub-folder of the work folder."""
    return f"{work_dir(spark)}/{kind}-{uuid.uuid4().hex[:12]}"


@dataclass(frozen=True)
class PipelineConfig:
    """Names and places of the three layers.

    ``root`` holds the table data (one folder per table); databases are the
    catalog namespaces of the raw, harmonized and analytics layers.
    """

    root: str
    raw_db: str = "raw"
    harmonized_db: str = "harmonized"
    analytics_db: str = "analytics"
    # outlier thresholds (Fahrenheit in the reference) of the SQL functions, see UF3
    tmax_range: tuple[float, float] = (68.0, 104.0)
    tmin_range: tuple[float, float] = (14.0, 59.0)
    # datatypes that become the two pivoted columns
    pivot_values: tuple[str, str] = ("TMAX", "TMIN")
    # number of hash buckets that partition the stations dimension
    station_buckets: int = 4
    # partition grain of the fact tables: "day", or "month" for small volumes
    fact_grain: str = "day"
    # optional JSON key holding a record's ingest sequence number; when set,
    # it decides "the latest record wins" before file time, name and position
    sequence_field: str | None = None
    # what a batch upsert does with observations that have a NULL in their key:
    # "insert" them (SQL's = never matches, so each merge of such a row adds one)
    # or "drop" them, as the stream does
    null_keys: str = "insert"

    @staticmethod
    def fresh(spark: SparkSession, prefix: str = "run", **kw) -> "PipelineConfig":
        """Config in a new folder of the work dir, with unique db names."""
        tag = uuid.uuid4().hex[:8]
        return PipelineConfig(
            root=fresh_dir(spark, prefix),
            raw_db=f"raw_{tag}",
            harmonized_db=f"harmonized_{tag}",
            analytics_db=f"analytics_{tag}",
            **kw,
        )

    @property
    def ingest_order(self) -> tuple[str, ...]:
        """Columns that order duplicates of a key, greatest wins."""
        base = ("_mtime", "_file", "_pos")
        return ("_seq",) + base if self.sequence_field else base

    def db_path(self, db: str) -> str:
        return f"{self.root.rstrip('/')}/{db}"

    def path(self, db: str, table: str) -> str:
        return f"{self.db_path(db)}/{table}"
