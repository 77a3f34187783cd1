"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationday.llm.words import row_slices

#: One word: the ASCII white space of the contracts separates, nothing else.
WORD = r"[^\x20\x09-\x0D]+"
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20


def on_workers(spark: SparkSession) -> None:
    """Let Python workers on this host import the package, wherever the driver
    was started; on other hosts it comes with ``--py-files``."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)


def bounded_batches(spark: SparkSession) -> None:
    """From now on a task's Arrow batch of texts holds about ``BATCH_BYTES``: the
    JVM and Python each hold a batch or two whole. A session's own setting stays."""
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    on_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(doc_id: Column, m: int) -> Column:
    """crc32 of the id written as text, modulo m; a NULL id is the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(m))


def unit_hash(*cols: Column) -> Column:
    """A number in [0, 1) that depends on the values of the columns only."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double") * F.lit(2.0**-53)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder named by spark.checkpoint.dir."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        import tempfile

        base = "file://" + tempfile.mkdtemp(prefix="stationday-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """The same rows, read from a Parquet table in the shared folder: the
    lineage ends here, and a lost executor costs no more than a re-read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.saved_path = path
    return out


def drop_saved(*frames: DataFrame) -> None:
    """Delete the tables of ``saved`` frames that nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.saved_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def map_texts(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, text: str = "text", limit: int | None = None) -> DataFrame:
    """mapInArrow in slices of whole rows with a bounded number of text bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            for lo, hi in row_slices(texts, limit) if limit else row_slices(texts):
                if (out := fn(batch.slice(lo, hi - lo))) is not None:
                    yield out

    return df.mapInArrow(run, schema)


def free_name(columns: list[str], name: str) -> str:
    """A column name from ``name`` that none of ``columns`` has, in any case."""
    taken, out = {c.lower() for c in columns}, f"_{name}"
    while out.lower() in taken:
        out = f"_{out}"
    return out


def null_safe(doc_id: Column) -> Column:
    """Orders NULL ids before all others, as ``min`` does not."""
    return F.struct(doc_id.isNotNull(), doc_id)
