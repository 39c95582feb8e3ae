"""Posting rows: schema revisions, what the published table accepts, staging to published."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postfeed.schema import MAX_BYTES, MAX_LENGTHS, PUBLISHED, STAGING


def conform_schema(df: DataFrame, staging: bool = False) -> DataFrame:
    """The rows of any schema revision in the columns of the latest; absent columns are NULL."""
    target = STAGING if staging else PUBLISHED
    have = set(df.columns)
    return df.select(
        *[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in target]
    )


def conform_all(snapshots: list[DataFrame], staging: bool = False) -> DataFrame:
    """Snapshots written under different revisions as one table."""
    return reduce(DataFrame.unionByName, [conform_schema(s, staging) for s in snapshots])


def _problems(text: str) -> dict[str, Column]:
    """By column, the reason the sink would reject a row; NULL if the column is fine."""
    widths = [(c, F.length(c), w, "") for c, w in MAX_LENGTHS.items()]
    widths += [(c, F.octet_length(c), MAX_BYTES[c], " bytes") for c in (text, "apply_url")]
    found = {c: F.when(size > width, F.lit(f"{c}: longer than {width}{unit}")) for c, size, width, unit in widths}
    found["position"] = F.when(F.col("position").isNull(), F.lit("position: missing")).otherwise(found["position"])
    return found


def rejections(text: str = "job_description") -> Column:
    """All reasons the sink would reject the row, as an array. ``text`` is the posting text's column."""
    return F.array_compact(F.array(*_problems(text).values()))


def sink_accepts(text: str = "job_description") -> Column:
    return reduce(Column.__and__, [problem.isNull() for problem in _problems(text).values()])


def fits_text(text: Column | str) -> Column:
    """Whether a posting text fits its column."""
    return F.octet_length(text) <= MAX_BYTES["description"]


def schema_violations(df: DataFrame) -> DataFrame:
    """One row per reason: ``id`` and ``problem``; for staging as for published rows."""
    text = "job_description" if "job_description" in df.columns else "description"
    return df.select("id", F.explode(rejections(text)).alias("problem"))


def staging_to_published(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Staging columns under their published names; the id goes, as the sink gives a new one."""
    names = [f.name for f in PUBLISHED if f.name != "id"]
    return df.withColumnRenamed("job_description", "description").select(*keep, *names)


def default_timestamps(df: DataFrame, run_ts: Column) -> DataFrame:
    """Rows without creation or update time get the load time."""
    return df.withColumns({c: F.coalesce(c, run_ts) for c in ("created_at", "updated_at")})


def available(df: DataFrame, predicate: Column | None = None) -> DataFrame:
    """The postings that may be published: all, or those that meet a predicate."""
    return df if predicate is None else df.where(predicate)


def sample_rows(df: DataFrame, n: int = 10) -> DataFrame:
    return df.orderBy("id").limit(n)
