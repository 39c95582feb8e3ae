"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# The largest scan ``spread`` moves, in splits; at the default split size about 1 GB.
MAX_SPLITS = 8

_local_scratch: dict[str, str] = {}


def build_session(app: str = "postfeed", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the package's settings; cluster settings come from spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder. A cluster session
    without it is an error, as a folder on one machine would be lost with that machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app_id = spark.sparkContext.applicationId
    if app_id not in _local_scratch:
        _local_scratch[app_id] = tempfile.mkdtemp(prefix="postfeed-")
    return _local_scratch[app_id]


_scopes = threading.local()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the scratch folder."""
    path = f"{scratch_root(spark)}/postfeed/{name}-{uuid.uuid4().hex}"
    for taken in getattr(_scopes, "open", [])[-1:]:
        taken.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end the scratch folders that this thread has taken in it; nothing may read them later."""
    _scopes.open = [*getattr(_scopes, "open", []), []]
    try:
        yield
    finally:
        for path in _scopes.open.pop():
            drop_scratch(spark, path)


def spread(df: DataFrame) -> DataFrame:
    """A scan of a few splits over all cores; what is moved is at most MAX_SPLITS splits.

    One small file would otherwise keep one core busy with expensive text rules.
    """
    splits = df.rdd.getNumPartitions()
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if splits < min(cores, MAX_SPLITS + 1) else df


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the planner's size of the table is below the broadcast threshold."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size <= df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def bytes_read(df: DataFrame) -> int:
    """The planner's size of all tables that the plan reads; of rows that come from no table it is beyond any size."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Deletes a folder that this package made below the scratch folder."""
    if not path.startswith(f"{scratch_root(spark)}/postfeed/"):
        raise ValueError(f"{path} is not a scratch folder")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def materialise(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The DataFrame as a table in the scratch folder, written with the options given.

    It is computed once, outlives lost executors, and its file sizes are known to the planner,
    which then broadcasts it in later joins only if it is below the broadcast threshold.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
