"""From semi-structured rows to typed columns, and column helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The JSON keys of the source records (which must match its
# data), each with the column it becomes and that column's type.
OBSERVATION_FIELDS = (
    ("date", "observation_date", "timestamp_ntz"),
    ("datatype", "datatype", "string"),
    ("station", "station_id", "string"),
    ("attributes", "attributes", "string"),
    ("value", "obs_value", "double"),
)
STATION_FIELDS = (
    ("id", "station_id", "string"),
    ("name", "name", "string"),
    ("latitude", "latitude", "double"),
    ("longitude", "longitude", "double"),
    ("elevation", "elevation", "double"),
    ("elevationUnit", "elevation_unit", "string"),
    ("mindate", "min_date", "date"),
    ("maxdate", "max_date", "date"),
    ("datacoverage", "data_coverage", "double"),
)
INGEST = ("_file", "_mtime", "_pos")


def json_field(column, key: str, type_: str, mode: str = "strict") -> Column:
    """Field ``key`` of a VARIANT column cast to ``type_``.

    A missing key or a JSON null gives NULL. A value that cannot be cast
    raises in ``"strict"`` mode and gives NULL in ``"permissive"`` mode.
    """
    col = F.col(column) if isinstance(column, str) else column
    path = "$." + key if key.isidentifier() else f"$['{key}']"
    if mode == "strict":
        return F.variant_get(col, path, type_)
    if mode == "permissive":
        return F.try_variant_get(col, path, type_)
    raise ValueError(f"mode must be 'strict' or 'permissive', not {mode!r}")


def extract(df: DataFrame, column: str, fields, mode: str = "strict", keep: tuple[str, ...] = (),
            extra: tuple[Column, ...] = ()) -> DataFrame:
    cols = [json_field(column, k, t, mode).alias(name) for k, name, t in fields]
    return df.select(*cols, *[c for c in keep if c in df.columns], *extra)


def parse_observations(staging: DataFrame, column: str = "weather_json", mode: str = "strict",
                       keep_ingest: bool = True, sequence_field: str | None = None) -> DataFrame:
    """Typed observation rows from the observation staging rows.

    With ``sequence_field`` the record's own sequence number is kept as
    ``_seq`` (permissive: a missing or bad one is NULL, ordered first).
    """
    extra = (json_field(column, sequence_field, "bigint", "permissive").alias("_seq"),) if sequence_field else ()
    return extract(staging, column, OBSERVATION_FIELDS, mode, INGEST if keep_ingest else (), extra)


def parse_stations(staging: DataFrame, column: str = "station_json", mode: str = "strict",
                   keep_ingest: bool = True) -> DataFrame:
    """Typed station rows; the target's types are applied explicitly."""
    return extract(staging, column, STATION_FIELDS, mode, INGEST if keep_ingest else ())


def timestamp_to_date(df: DataFrame, column: str) -> DataFrame:
    """Replace a timestamp column by its date (P5)."""
    return df.withColumn(column, F.col(column).cast("date"))


def clean_name(name: str) -> str:
    return name.replace("'", "").replace('"', "").strip()


def clean_column_names(df: DataFrame) -> DataFrame:
    """Drop quote characters and surrounding blanks from every column name."""
    return df.toDF(*[clean_name(c) for c in df.columns])


def ensure_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in its order; a missing one becomes a typed NULL."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def rename_column(df: DataFrame, old: str, new: str) -> DataFrame:
    """P8."""
    return df.withColumnRenamed(old, new)


def drop_nulls(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Rows with no NULL in ``subset`` (all columns by default)."""
    return df.na.drop(how="any", subset=subset)


def tag_rows(df: DataFrame, name: str, value) -> DataFrame:
    """Add a column holding a constant or an expression per row."""
    return df.withColumn(name, value if isinstance(value, Column) else F.lit(value))
