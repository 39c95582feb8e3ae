"""Progress samples over time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def progress_delta(samples: DataFrame, run: str = "run_id", time: str = "sampled_at") -> DataFrame:
    """Each sample with the rows processed since the one before it in its run; the first counts from 0."""
    order = W.partitionBy(run).orderBy(time)
    return samples.withColumn("new_records", F.col("processed") - F.lag("processed", 1, 0).over(order))
