"""One row per partner key: the most recent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from postfeed.functions.keys import has_key, no_key
from postfeed.operators.keyed import key_rows


def recency() -> list[Column]:
    """Newest first by update, else creation time. Equal times keep the lowest id, rows without
    any time the highest; they come after all rows that have one."""
    ts = F.coalesce("updated_at", "created_at")
    return [ts.desc_nulls_last(), F.when(ts.isNull(), -F.col("id")).otherwise(F.col("id")).asc()]


def _newest(keyed: DataFrame) -> DataFrame:
    """One row per key. Spark cuts each key to one row per input partition before the shuffle,
    so a hot key does not fill a task."""
    window = W.partitionBy("partner_job_id").orderBy(*recency())
    return keyed.withColumn("__rank", F.row_number().over(window)).where("__rank = 1").drop("__rank")


def keep_latest(df: DataFrame) -> DataFrame:
    """The newest row per usable key and all rows with a blank key, which skip the shuffle."""
    return _newest(df.where(has_key())).unionByName(df.where(no_key()))


def duplicates_to_remove(df: DataFrame) -> DataFrame:
    """The rows ``keep_latest`` leaves out, found by unique id so that no task gets a whole key."""
    keyed = df.where(has_key())
    kept = _newest(keyed.select("id", "partner_job_id", "updated_at", "created_at")).select("id")
    return keyed.join(kept, "id", "left_anti")


def duplicate_groups(df: DataFrame) -> DataFrame:
    """Usable keys with more than one row, and how many."""
    return key_rows(df).where("key IS NOT NULL AND n > 1").select(F.col("key").alias("partner_job_id"), "n")


def dedup_counts(df: DataFrame) -> DataFrame:
    """Rows in total, rows that stay and rows to remove, from counts per key alone."""
    kept = F.when(F.col("key").isNull(), F.col("n")).otherwise(1)
    sums = key_rows(df).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.coalesce(F.sum(kept), F.lit(0)).alias("kept")
    )
    return sums.withColumn("to_remove", F.col("total") - F.col("kept"))
