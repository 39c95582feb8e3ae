"""Request logs: client address, geo block and the nested record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postfeed.functions.requests import client_ip, geo_struct, is_private_ip, log_json, log_record
from postfeed.operators.keyed import HOT_ROWS, keyed_join
from postfeed.session import fits_broadcast

LOGGER = "postfeed"


def geo_enrich(
    log: DataFrame, geo_dim: DataFrame, ip: str = "client_ip", spread: str = "event_id", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``log`` with ``geo``: NULL for private, blank and unknown addresses and failed lookups.

    ``geo_dim`` holds one row per address. While its known size is below the broadcast threshold, the log
    is read once and not shuffled; beyond that its rows are shuffled, a busy address in several parts and
    private ones spread out.
    """
    keyed = log.withColumn("__ip", F.when(~is_private_ip(ip), F.col(ip)))
    known = geo_dim.select(F.col("ip").alias("__ip"), geo_struct().alias("geo")).where("geo IS NOT NULL")
    if fits_broadcast(known):
        return keyed.join(known, "__ip", "left").select(*log.columns, "geo")
    return keyed_join(keyed, known, "__ip", "left", spread=spread, hot_rows=hot_rows).select(*log.columns, "geo")


def request_records(
    log: DataFrame, geo_dim: DataFrame, mask: bool = True, spread: str = "event_id", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``event_id``, ``time`` and the nested ``record`` of each request."""
    addressed = log.withColumn("client_ip", client_ip("x_forwarded_for", "x_real_ip", "peer_ip"))
    placed = geo_enrich(addressed, geo_dim, spread=spread, hot_rows=hot_rows)
    logged_ms = F.call_function("div", F.col("ended_ns"), F.lit(1_000_000))
    return placed.select(spread, logged_ms.alias("time"), log_record(mask).alias("record"))


def log_lines(records: DataFrame, level: str = "INFO", logger: str = LOGGER, spread: str = "event_id") -> DataFrame:
    """Each record as the text of one JSON line."""
    return records.select(spread, log_json(F.col("record"), F.lit(level), F.lit(logger), F.col("time")).alias("line"))
