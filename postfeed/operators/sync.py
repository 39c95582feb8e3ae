"""Comparing a staging snapshot with the published one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postfeed.functions.keys import has_key
from postfeed.functions.text import NOT_AVAILABLE, ellipsis, or_not_available, percent
from postfeed.operators.keyed import HOT_ROWS, key_rows, key_set, keyed_join
from postfeed.operators.posting import sink_accepts

KEY = "partner_job_id"


def new_postings(
    staging: DataFrame, published: DataFrame, blank_keys: str = "new", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Staging rows whose key is not published. Rows with a blank key are always new, and
    rows that share a new key all pass; ``blank_keys='skip'`` leaves blank ones out."""
    if blank_keys not in ("new", "skip"):
        raise ValueError("blank_keys is 'new' or 'skip'")
    rows = staging if blank_keys == "new" else staging.where(has_key(KEY))
    return keyed_join(rows, key_set(published), KEY, "left_anti", hot_rows=hot_rows)


def already_published(staging: DataFrame, published: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Staging rows that ``new_postings`` leaves out."""
    rows = staging.where(has_key(KEY))
    return keyed_join(rows, key_set(published), KEY, "left_semi", hot_rows=hot_rows)


def expired_postings(published: DataFrame, staging: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Published rows with a usable key that staging lacks. With an empty staging nothing expires."""
    gone = keyed_join(published.where(has_key(KEY)), key_set(staging), KEY, "left_anti", hot_rows=hot_rows)
    return gone.where(staging.select(F.lit(1)).exists())


def missing_keys(staging: DataFrame, published: DataFrame) -> DataFrame:
    """Distinct usable staging keys that are not published."""
    return key_set(staging).join(key_set(published), KEY, "left_anti")


def published_flag(rows: DataFrame, published: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Each row with ``is_published``; false for a blank key."""
    known = key_set(published).withColumn("is_published", F.lit(True))
    flagged = keyed_join(rows, known, KEY, "left", hot_rows=hot_rows)
    return flagged.withColumn("is_published", F.coalesce("is_published", F.lit(False)))


def delete_rows(df: DataFrame, victims: DataFrame, on: str = "id") -> DataFrame:
    """The rows that are not listed in ``victims``; ids are unique, so no task gets more than its share."""
    return df.join(victims.select(on), on, "left_anti")


def _both_sides(staging: DataFrame, published: DataFrame) -> DataFrame:
    """One row per key on either side. Both inputs come aggregated by key, so no key is hot."""
    s = key_rows(staging, F.count_if(sink_accepts()).alias("n_accepted")).alias("s")
    p = key_rows(published).alias("p")
    return s.join(p, F.col("s.key") == F.col("p.key"), "full_outer").select(
        F.col("s.key").alias("s_key"),
        F.col("p.key").alias("p_key"),
        F.coalesce("s.n", F.lit(0)).alias("s_rows"),
        F.coalesce("s.n_accepted", F.lit(0)).alias("s_accepted"),
        F.coalesce("p.n", F.lit(0)).alias("p_rows"),
    )


def _total(value) -> F.Column:
    return F.coalesce(F.sum(value), F.lit(0))


def reconcile(staging: DataFrame, published: DataFrame) -> DataFrame:
    """Row and key counts of both sides, the missing keys, and whether all keys are published."""
    totals = _both_sides(staging, published).agg(
        _total("s_rows").alias("staging_rows"),
        _total("p_rows").alias("published_rows"),
        F.count("s_key").alias("staging_keys"),
        F.count("p_key").alias("published_keys"),
        F.count_if(F.col("s_key").isNotNull() & F.col("p_key").isNull()).alias("missing_keys"),
    )
    return totals.withColumn("all_published", F.col("missing_keys") == 0)


def sync_counts(staging: DataFrame, published: DataFrame) -> DataFrame:
    """Staging rows in total, those to skip and those that are new."""
    skipped = F.col("s_key").isNotNull() & F.col("p_key").isNotNull()
    return _both_sides(staging, published).agg(
        _total("s_rows").alias("total"),
        _total(F.when(skipped, F.col("s_rows")).otherwise(0)).alias("skipped"),
        _total(F.when(~skipped, F.col("s_rows")).otherwise(0)).alias("new"),
    )


def run_summary(staging: DataFrame, published: DataFrame) -> DataFrame:
    """What a sync run does: rows expired, new rows found, new rows the sink accepts."""
    is_new = F.col("s_key").isNull() | F.col("p_key").isNull()
    gone = F.col("p_key").isNotNull() & F.col("s_key").isNull()
    sums = _both_sides(staging, published).agg(
        _total("s_rows").alias("staging_rows"),
        _total(F.when(gone, F.col("p_rows")).otherwise(0)).alias("gone"),
        _total(F.when(is_new, F.col("s_rows")).otherwise(0)).alias("new_found"),
        _total(F.when(is_new, F.col("s_accepted")).otherwise(0)).alias("processed"),
    )
    expired = F.when(F.col("staging_rows") > 0, F.col("gone")).otherwise(0)
    return sums.select(expired.alias("expired"), "new_found", "processed")


def progress(staging: DataFrame, published: DataFrame) -> DataFrame:
    """Rows published against rows staged; over 100 % is possible. Reads row counts only."""
    sides = staging.select(F.lit(1).alias("s"), F.lit(0).alias("p")).unionAll(
        published.select(F.lit(0).alias("s"), F.lit(1).alias("p"))
    )
    counts = sides.agg(_total("p").alias("processed"), _total("s").alias("total"))
    done, total = F.col("processed"), F.col("total")
    return counts.select(
        "processed", "total", percent(done, total).alias("percentage"), ((done >= total) & (total > 0)).alias("complete")
    )


def expired_report(expired: DataFrame) -> DataFrame:
    """The table shown before expired rows go: long positions and companies are cut."""
    return expired.select(
        "id", KEY, ellipsis("position", 40).alias("position"), ellipsis("company", 20).alias("company")
    )


def examples(df: DataFrame, n: int = 5, order: str = "id") -> DataFrame:
    """The first rows of a list, for a report."""
    return df.orderBy(order).limit(n)


def expired_details(expired: DataFrame, n: int = 5) -> DataFrame:
    """The full entry of the first expired rows, with N/A for blanks and the number of rows left out."""
    more = F.greatest(expired.agg(F.count(F.lit(1))).scalar() - n, F.lit(0))
    return examples(expired, n).select(
        "id",
        KEY,
        *[or_not_available(c).alias(c) for c in ("position", "company", "location")],
        F.coalesce(F.col("created_at").cast("string"), F.lit(NOT_AVAILABLE)).alias("created_at"),
        more.alias("more"),
    )


def missing_examples(missing: DataFrame, n: int = 10) -> DataFrame:
    """The first missing keys, each with the number of missing keys left out of the list."""
    more = F.greatest(missing.agg(F.count(F.lit(1))).scalar() - n, F.lit(0))
    return examples(missing, n, KEY).withColumn("more", more)
