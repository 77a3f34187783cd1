"""JSON sink (S14): records out as JSON Lines, readable again by the loader."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_json_lines(df: DataFrame, path: str, compression: str | None = None, mode: str = "errorifexists") -> str:
    """Write every row as one JSON object per line, many part files.

    The reference writes one array object per dataset from a single machine;
    here each task writes its own part, so nothing passes through the driver.
    """
    w = df.write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    w.json(path)
    return path
