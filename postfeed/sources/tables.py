"""Posting tables as Parquet snapshots or over JDBC.

Parquet has no row updates, so a table is a series of snapshots: read one, write the next.
"""

from __future__ import annotations

from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postfeed.operators.keyed import key_set
from postfeed.operators.posting import conform_schema
from postfeed.schema import PUBLISHED, STAGING


def read_published(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PUBLISHED).parquet(path)


def read_staging(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STAGING).parquet(path)


def read_keys(df: DataFrame) -> DataFrame:
    """Distinct usable partner keys; only the key column is read."""
    return key_set(df)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    lower: int,
    upper: int,
    partitions: int,
    staging: bool = False,
    **options: str,
) -> DataFrame:
    """A posting table in a database, read in parallel id ranges between ``lower`` and ``upper``.

    Every use reads the database again. Write the rows as a snapshot before comparing or numbering them, so
    that all steps see the same.
    """
    df = spark.read.jdbc(
        url,
        table,
        column="id",
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties={"preferTimestampNTZ": "true", **options},
    )
    return conform_schema(df, staging)


def write_jdbc(df: DataFrame, url: str, table: str, batch_size: int = 1000, **options: str) -> None:
    """Append postings to a database table, which gives them their ids."""
    rows = df.drop("id")
    rows.write.jdbc(url, table, mode="append", properties={"batchsize": str(batch_size), **options})


def append_postings(df: DataFrame, path: str) -> None:
    conform_schema(df).write.mode("append").parquet(path)


def _root_paths(df: DataFrame) -> list[str]:
    """The folders and files that a DataFrame's file scans were given; not the files below them."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    found = []
    for leaf in (leaves.apply(i) for i in range(leaves.size())):
        if leaf.getClass().getSimpleName() == "LogicalRelation" and hasattr(leaf.relation(), "location"):
            roots = leaf.relation().location().rootPaths()
            found += [roots.apply(i).toString() for i in range(roots.size())]
    return found


def refuse_own_input(path: str, *sources: DataFrame) -> None:
    """Raise if a source reads at, below or around ``path``: overwriting it would lose rows half way."""
    spark = sources[0].sparkSession
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    target = urlparse(hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop_path).toString())
    for root in (urlparse(p) for source in sources for p in _root_paths(source)):
        same = root.scheme == target.scheme and root.netloc == target.netloc
        below, above = f"{root.path}/".startswith(f"{target.path}/"), f"{target.path}/".startswith(f"{root.path}/")
        if same and (below or above):
            raise ValueError(f"cannot overwrite {path}, it is being read")


def full_refresh(df: DataFrame, path: str) -> None:
    """Replace the whole table, which ``df`` must not read."""
    refuse_own_input(path, df)
    conform_schema(df).write.mode("overwrite").parquet(path)


def latest_build(df: DataFrame) -> DataFrame:
    """One row: the latest build date, NULL if no posting has one."""
    return df.agg(F.max("last_build_date").alias("last_build_date"))
