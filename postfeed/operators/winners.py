"""The latest row per key as a state that new rows update, instead of a choice among all rows.

A key's state is its winner in a form of which the greatest is the newest row, and how many rows it has had. States
merge by greatest and sum, so they can be taken of any pieces of a table, in any order, and merged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postfeed.functions.keys import has_key

KEY = "partner_job_id"


def standing() -> Column:
    """Greatest for the newest row: those with a time before those without, then by time; of equal times the lowest id,
    of rows without a time the highest. The order is that of ``dedup.recency``."""
    ts = F.coalesce("updated_at", "created_at")
    tie = F.when(ts.isNull(), F.col("id")).otherwise(-F.col("id"))
    return F.struct(ts.isNotNull().alias("timed"), ts.alias("ts"), tie.alias("tie"))


def winner_id(best: Column | str = "best") -> Column:
    best = F.col(best) if isinstance(best, str) else best
    return F.when(best["timed"], -best["tie"]).otherwise(best["tie"])


def winner_state(rows: DataFrame) -> DataFrame:
    """``partner_job_id``, ``best`` and ``n`` of every usable key of the rows. Rows are cut to one per key before the shuffle."""
    return rows.where(has_key(KEY)).groupBy(KEY).agg(F.max(standing()).alias("best"), F.count(F.lit(1)).alias("n"))


def merge_states(*states: DataFrame) -> DataFrame:
    """The state of all rows from the states of pieces of them."""
    both = states[0]
    for state in states[1:]:
        both = both.unionByName(state)
    return both.groupBy(KEY).agg(F.max("best").alias("best"), F.sum("n").alias("n"))


def superseded(before: DataFrame, delta: DataFrame, after: DataFrame) -> DataFrame:
    """``id`` and key of the rows that a delta makes superfluous: its own that lose, and winners that it beats.

    ``before`` and ``after`` are the states around the delta. A row is superseded in one delta only, and over all
    deltas these are the rows that ``duplicates_to_remove`` finds in all rows. Rows are told apart by id, so that the
    rows of one key are spread.
    """
    touched = delta.where(has_key(KEY)).select("id", KEY)
    # Of the old winners, only those of keys that the delta has can lose.
    old = before.join(touched.select(KEY).distinct(), KEY, "left_semi").select(winner_id().alias("id"), KEY)
    return touched.unionByName(old).join(after.select(winner_id().alias("id")), "id", "left_anti")


def winners(state: DataFrame) -> DataFrame:
    """``id`` and key of the row that stays of every key."""
    return state.select(winner_id().alias("id"), KEY)
