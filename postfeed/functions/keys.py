"""Partner keys. A blank key, NULL or '', means "no key" and never matches anything."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def usable_key(key: Column | str = "partner_job_id") -> Column:
    return F.nullif(_col(key), F.lit(""))


def has_key(key: Column | str = "partner_job_id") -> Column:
    """For filters: a plain comparison, which Parquet scans can use. NULL, not false, for NULL."""
    return _col(key) != ""


def no_key(key: Column | str = "partner_job_id") -> Column:
    return _col(key).isNull() | (_col(key) == "")


def feed_key(key: Column | str = "partner_job_id", id: Column | str = "id") -> Column:
    """The key shown in the feed: the partner key, else the row id, else ''."""
    return F.coalesce(usable_key(key), _col(id).cast("string"), F.lit(""))


def blank_default(value: Column | str) -> Column:
    return F.coalesce(_col(value), F.lit(""))


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
