"""Gap-free numbering and running totals without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postfeed.session import scratch_path

# Consecutive batches whose running total one task computes.
BATCHES_PER_GROUP = 65_536


def row_numbers(df: DataFrame, order: str = "id", carry: Sequence[str] = ()) -> DataFrame:
    """``order``, the columns to ``carry`` and ``idx``, the 0-based position; ``order`` is unique.

    This acts at once: the rows are sorted and written before the result is asked for.
    Only these columns are range-partitioned, sorted and written to the scratch folder with
    its place in its partition. The written places do not change when an executor is lost.
    Adding up the rows of earlier partitions then needs one row per partition.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "row-numbers")
    slim = df.select(order, *carry)
    placed = slim.repartitionByRange(order).sortWithinPartitions(order)
    placed.withColumn("place", F.monotonically_increasing_id()).write.parquet(path)
    # monotonically_increasing_id holds the partition in its upper bits, the row in the lower 33.
    written = spark.read.schema(T.StructType([*slim.schema, T.StructField("place", T.LongType())])).parquet(path)
    parts = written.select(
        order, *carry, F.shiftright("place", 33).alias("part"), F.col("place").bitwiseAND((1 << 33) - 1).alias("row")
    )
    sizes = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    # One row per shuffle partition: spark.sql.shuffle.partitions bounds what is broadcast.
    return parts.join(F.broadcast(starts), "part").select(order, *carry, (F.col("start") + F.col("row")).alias("idx"))


def assign_ids(df: DataFrame, start: int, order: str = "id", name: str = "new_id") -> DataFrame:
    """``order`` and the id each row gets: ``start``, ``start + 1``, ... in that order."""
    return row_numbers(df, order).select(order, (F.col("idx") + start).alias(name))


def batch_no(df: DataFrame, size: int = 20, order: str = "id", carry: Sequence[str] = ()) -> DataFrame:
    """``order`` and the 1-based number of the batch of ``size`` rows it falls in."""
    return row_numbers(df, order, carry).select(order, *carry, F.expr(f"idx div {int(size)} + 1").alias("batch_no"))


def running_total(df: DataFrame, order: str, value: str, name: str) -> DataFrame:
    """``df`` with the running total of ``value``, for an ``order`` that counts 1, 2, 3, ...

    Totals run inside groups of consecutive numbers, and each group adds the sum of those before.
    """
    grouped = df.withColumn("__group", F.expr(f"({order} - 1) div {BATCHES_PER_GROUP}"))
    sums = grouped.groupBy("__group").agg(F.sum(value).alias("__sum"))
    before = W.orderBy("__group").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select("__group", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__start"))
    inside = W.partitionBy("__group").orderBy(order)
    return (
        grouped.withColumn("__inside", F.sum(value).over(inside))
        .join(starts, "__group")
        .withColumn(name, F.col("__start") + F.col("__inside"))
        .drop("__group", "__inside", "__start")
    )


def batch_outcomes(df: DataFrame, accepted: Column, size: int = 20) -> DataFrame:
    """Per batch: rows, rows the sink accepts, their running total, and the number of batches."""
    flags = df.select("id", accepted.alias("__ok"))
    numbered = batch_no(flags, size, carry=["__ok"]).groupBy("batch_no")
    per_batch = numbered.agg(F.count(F.lit(1)).alias("rows"), F.count_if("__ok").alias("inserted"))
    per_batch = per_batch.withColumn("batches", F.ceil(flags.agg(F.count(F.lit(1))).scalar() / size).cast("bigint"))
    return running_total(per_batch, "batch_no", "inserted", "total_inserted")
