"""Rewriting posting texts and loading new postings."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from postfeed.functions.keys import _col
from postfeed.functions.markup import format_posting
from postfeed.functions.text import or_not_available, strip, truncate_text
from postfeed.operators.keyed import HOT_ROWS
from postfeed.operators.keypass import EXPIRE, NEW, ids_of, row_actions
from postfeed.operators.numbering import assign_ids
from postfeed.operators.posting import default_timestamps, fits_text, rejections, sample_rows, sink_accepts, staging_to_published
from postfeed.operators.sync import delete_rows, new_postings
from postfeed.session import materialise

# Fixed value: the line between the instruction and the original text of a request.
REQUEST_LABEL = "Job description originale:"

# Builds, once per task, a function from an original text to a new one.
RewriterFactory = Callable[[], Callable[[str], str]]


def rewrite_request(description: Column | str, instruction: str) -> Column:
    """The request text for a remote rewriter; NULL for a blank description, which needs none."""
    text = F.nullif(_col(description), F.lit(""))
    return F.concat(F.lit(f"{instruction}\n\n{REQUEST_LABEL}\n\n"), text)


def rewriter_column(text: Column, rewriter: RewriterFactory, workers: int = 1) -> Column:
    """Texts through a plugged-in rewriter, original text where it raises.

    Only the text column travels to Python, in Arrow batches. The factory runs once per task;
    ``workers`` calls of a remote service may be open at a time.
    """

    @F.pandas_udf("string")
    def rewrite(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        improve = rewriter()

        def attempt(original):
            if not original:
                return None
            try:
                return improve(original).strip()
            except Exception:
                return original

        with ThreadPoolExecutor(workers) as pool:
            for batch in batches:
                yield pd.Series(list(pool.map(attempt, batch)), dtype=object)

    return rewrite.asNondeterministic()(text)


def rewrite_text(
    df: DataFrame, rewriter: RewriterFactory | None = None, column: str = "description", workers: int = 1
) -> DataFrame:
    """The text column rewritten: blank becomes NULL, the result is stripped.

    Without a rewriter the formatting rules apply, all inside the JVM.
    """
    if rewriter is not None:
        return df.withColumn(column, rewriter_column(F.col(column), rewriter, workers))
    given = df.withColumn(column, F.when(F.col(column) != "", F.col(column)))
    return format_posting(given, column).withColumn(column, strip(column))


def next_id(published: DataFrame) -> int:
    """The id after the highest published one; one number comes to the driver."""
    return (published.agg(F.max("id")).first()[0] or 0) + 1


def rejected_new(staging: DataFrame, published: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """New staging rows the sink would reject, with the ``reasons``."""
    bad = staging.where(~sink_accepts()).withColumn("reasons", rejections())
    return new_postings(bad, published, hot_rows=hot_rows)


def load_new(
    staging: DataFrame,
    published: DataFrame,
    run_ts: Column,
    start: int,
    rewriter: RewriterFactory | None = None,
    workers: int = 1,
    hot_rows: int = HOT_ROWS,
    new_ids: DataFrame | None = None,
    fresh: DataFrame | None = None,
) -> DataFrame:
    """The new postings as published rows, with ids from ``start`` in staging order.

    ``new_ids`` lists the staging rows that are new where that is known, ``fresh`` those of them that the sink accepts. Which rows are new and their ids are settled on ids and keys alone. The wide rows are then
    fetched by their unique id, so they move once and evenly, and a rewriter runs after the
    last shuffle: a lost executor repeats its own tasks and no others.
    """
    fit = staging.where(sink_accepts())
    if fresh is not None:
        pass
    elif new_ids is not None:
        fresh = fit.select("id").join(new_ids, "id", "left_semi")
    else:
        fresh = new_postings(fit.select("id", "partner_job_id"), published, hot_rows=hot_rows)
    # Written twice: sorting samples its input, and ids of a known size are not met by a shuffle of the wide rows while
    # they are few.
    ids = materialise(assign_ids(materialise(fresh.select("id"), "fresh-ids"), start), "new-ids")
    rows = staging_to_published(fit.join(ids, "id").drop("id").withColumnRenamed("new_id", "id"), keep=["id"])
    rewritten = rewrite_text(rows.withColumn("__given", F.col("description")), rewriter, workers=workers)
    # A rewritten text can be longer than its column; the given one fits.
    kept = F.when(fits_text("description") | F.col("description").isNull(), F.col("description")).otherwise(F.col("__given"))
    return default_timestamps(rewritten.withColumn("description", kept).drop("__given"), run_ts)


def sync(
    staging: DataFrame,
    published: DataFrame,
    run_ts: Column,
    start: int,
    rewriter: RewriterFactory | None = None,
    workers: int = 1,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The next published snapshot: what has not expired, and the new postings.

    Expiry takes only keys that staging lacks, so it cannot change which rows are new: one pass over the keys of
    both sides says what happens to every row.
    """
    actions = row_actions(staging, published, hot_rows).where(F.col("action").isin(NEW, EXPIRE))
    actions = materialise(actions.select("id", "action"), "actions")
    new = load_new(staging, published, run_ts, start, rewriter, workers, hot_rows, new_ids=ids_of(actions, NEW))
    return delete_rows(published, ids_of(actions, EXPIRE)).unionByName(new)


def preview_pairs(staging: DataFrame, n: int = 10, rewriter: RewriterFactory | None = None) -> DataFrame:
    """``n`` sample rows with the text before and after; in full for the first row only."""
    # The window sees the n sampled rows only.
    place = F.row_number().over(W.orderBy("id"))
    sample = sample_rows(staging, n).withColumns({"improved": F.col("job_description"), "place": place})
    pairs = rewrite_text(sample, rewriter, column="improved")

    def show(text: str) -> Column:
        return F.when(F.col("place") == 1, truncate_text(text, 2**31 - 1)).otherwise(truncate_text(text, 800))

    return pairs.select(
        "id",
        "position",
        or_not_available("company").alias("company"),
        or_not_available("location").alias("location"),
        show("job_description").alias("original"),
        show("improved").alias("improved"),
    )
