"""Joins on a partner key that hold when one key has a large share of the rows.

A few keys (one agency, one client address) can own a third of a table, and blank keys can
own another. A plain shuffle on the key sends each of them to one task. Here the rows of hot
keys are spread over several salts, the other side's entry for a hot key is repeated once per
salt, and rows without a key are spread by their id, as they match nothing. Every row is
still compared with every entry of its key, so the result is that of the plain join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postfeed.functions.keys import has_key, usable_key

# A key with more rows than a part of a shuffle task's fair share is hot, unless that part is below HOT_ROWS.
HOT_ROWS = 20_000
PARTS_OF_SHARE = 4

_KEY, _SALT, _SALTS, _SPREAD = "__key", "__salt", "__salts", 1 << 16


def key_rows(df: DataFrame, *aggregates: Column, key: str = "partner_job_id") -> DataFrame:
    """One row per usable key, plus one with a NULL key for all blank rows: ``key``, ``n`` and more.

    Rows are counted before the shuffle, so a hot key costs one row per input partition.
    """
    return df.groupBy(usable_key(key).alias("key")).agg(F.count(F.lit(1)).alias("n"), *aggregates)


def key_set(df: DataFrame, key: str = "partner_job_id") -> DataFrame:
    """Distinct usable keys, in a column of the key's own name."""
    return df.where(has_key(key)).select(key).distinct()


def hot_keys(rows: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more rows than a quarter of a shuffle task's fair share, and how many such parts each has.

    No more keys than four for each shuffle partition can exceed it, which bounds the list; no key that does
    is left out.
    """
    parts = PARTS_OF_SHARE * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = rows.where(has_key(key)).groupBy(F.col(key).alias(_KEY)).agg(F.count(F.lit(1)).alias("__n"))
    part = F.greatest(F.lit(hot_rows), F.ceil(counts.agg(F.sum("__n")).scalar() / parts))
    return counts.where(F.col("__n") > part).select(_KEY, F.ceil(F.col("__n") / part).cast("int").alias(_SALTS))


def keyed_join(
    rows: DataFrame, entries: DataFrame, key: str, how: str, spread: str = "id", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Join ``rows`` with ``entries`` on a usable key: left, left_semi or left_anti.

    ``entries`` holds each key at most once. ``spread`` is a column of ``rows`` with many values.
    """
    hot = hot_keys(rows, key, hot_rows)
    salts = F.when(F.col(_KEY).isNull(), _SPREAD).otherwise(F.coalesce(_SALTS, F.lit(1)))
    keyed = rows.withColumn(_KEY, usable_key(key))
    left = keyed.join(F.broadcast(hot), _KEY, "left").withColumn(_SALT, F.pmod(F.xxhash64(spread), salts))
    right = (
        entries.withColumnRenamed(key, _KEY)
        .join(F.broadcast(hot), _KEY, "left")
        .withColumn(_SALT, F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(_SALTS, F.lit(1)) - 1)))
        .drop(_SALTS)
    )
    return left.join(right, [_KEY, _SALT], how).drop(_KEY, _SALT, _SALTS)
