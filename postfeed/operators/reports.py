"""Reports on posting texts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postfeed.functions.markup import RULES, conformance, head_of, labels_of


def conformance_rows(df: DataFrame, before: str, after: str, id: str = "id", **options) -> DataFrame:
    """One row per posting with a column per formatting rule, and ``conforms`` if all hold."""
    texts = df.select(id, F.col(before).alias("before"), F.col(after).alias("after"))
    heads = texts.withColumns({"old_head": head_of("before"), "new_head": head_of("after")})
    bodies = heads.withColumns(
        {
            "old_body": F.substr("before", F.length("old_head") + 1),
            "new_body": F.substr("after", F.length("new_head") + 1),
        }
    )
    rules = conformance(*[F.col(c) for c in bodies.columns if c != id], **options)
    found = bodies.select(id, *[rule.alias(name) for name, rule in rules.items()])
    return found.withColumn("conforms", reduce(Column.__and__, [F.col(name) for name in rules]))


def conformance_report(rows: DataFrame, *by: Column | str) -> DataFrame:
    """How many postings there are and how many follow each rule, by group if one is given."""
    counts = [F.count_if(rule).cast("bigint").alias(rule) for rule in RULES]
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("postings"), *counts)


def label_counts(df: DataFrame, text: str, id: str = "id") -> DataFrame:
    """Per label: postings that hold it and times it occurs.

    Counted within the row first, so a label in a third of the rows costs no wide group.
    """
    found = df.select(labels_of(text).alias("labels"))
    per_row = found.select(F.explode(F.array_distinct("labels")).alias("label"), "labels")
    times = F.size(F.filter("labels", lambda each: each == F.col("label")))
    return per_row.groupBy("label").agg(F.count(F.lit(1)).alias("postings"), F.sum(times).alias("occurrences"))
