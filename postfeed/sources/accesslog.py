"""The request log as JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame

from postfeed.operators.requests import log_lines


def write_access_log(records: DataFrame, path: str, mode: str = "append", **options: str) -> None:
    """One JSON object per line."""
    log_lines(records).select("line").write.mode(mode).options(**options).text(path)
