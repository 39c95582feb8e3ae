"""Sync, request log and progress as Structured Streaming queries."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from threading import Event

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from postfeed.functions.keys import has_key
from postfeed.operators.keyed import HOT_ROWS, key_set
from postfeed.operators.posting import sink_accepts
from postfeed.operators.progress import progress_delta
from postfeed.operators.requests import log_lines, request_records
from postfeed.operators.rewrite import RewriterFactory, load_new, rejected_new
from postfeed.operators.sync import new_postings, progress
from postfeed.operators.winners import KEY, standing, winner_id
from postfeed.schema import PUBLISHED
from postfeed.session import materialise, path_exists, scratch_scope
from postfeed.sources.keyindex import KeyIndex
from postfeed.sources.tables import read_published
from postfeed.sources.versions import VersionedTable

WATCH_INTERVAL = "5 seconds"


def _start(stream: DataFrame, run_dir: str, handle: Callable, trigger: dict | None) -> StreamingQuery:
    writer = stream.writeStream.option("checkpointLocation", f"{run_dir}/checkpoint").foreachBatch(handle)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def _write_once(df: DataFrame, path: str) -> DataFrame:
    """The table at ``path``, written unless an earlier start of the run has done so."""
    spark = df.sparkSession
    if not path_exists(spark, f"{path}/_SUCCESS"):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stream_sync(
    staging: DataFrame,
    published: DataFrame,
    run_dir: str,
    run_ts: datetime,
    rewriter: RewriterFactory | None = None,
    workers: int = 1,
    hot_rows: int = HOT_ROWS,
    trigger: dict | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Append the new rows among arriving staging rows to ``run_dir``/postings.

    The published keys are frozen in an index when the run starts, so two rows with the same new key both
    pass, as in the batch job, and a restart with the same ``run_dir`` sees the same keys. ``prepare``
    may deal a batch of few files out over more tasks. A batch is scanned three times: what is decided on are ids and
    keys, and rows that the sink rejects, which are written first.
    """
    spark = staging.sparkSession
    keys = KeyIndex(spark, f"{run_dir}/published_keys")
    keys.add(key_set(published), "published")
    first = _write_once(
        published.agg((F.coalesce(F.max("id"), F.lit(0)) + 1).alias("id")), f"{run_dir}/first_id"
    ).first()[0]
    now = F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz")

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = prepare(batch) if prepare else batch
        with scratch_scope(spark):
            before = f"{run_dir}/next_id/batch_id={batch_id - 1}"
            start = spark.read.parquet(before).first()[0] if batch_id else first
            narrow = materialise(batch.select("id", KEY, sink_accepts().alias("fit")), "arrived")
            # The batch's keys are written first, as the index is asked in steps; it reads only buckets that may have one.
            asked = materialise(key_set(narrow), "asked")
            known = materialise(keys.known(asked), "known")
            target = f"{run_dir}/postings/batch_id={batch_id}"
            fresh = new_postings(narrow.where("fit").select("id", KEY), known, hot_rows=hot_rows)
            load_new(batch, known, now, start, rewriter, workers, hot_rows, fresh=fresh).write.mode("overwrite").parquet(target)
            refused = rejected_new(materialise(batch.where(~sink_accepts()), "unfit"), known, hot_rows)
            refused.write.mode("overwrite").parquet(f"{run_dir}/rejected/batch_id={batch_id}")
            after = read_published(spark, target).agg((F.count(F.lit(1)) + start).alias("id"))
            after.write.mode("overwrite").parquet(f"{run_dir}/next_id/batch_id={batch_id}")

    return _start(staging, run_dir, handle, trigger)


def read_stream_postings(spark: SparkSession, run_dir: str) -> DataFrame:
    """Everything a sync stream has appended so far, with its ``batch_id``."""
    schema = T.StructType([*PUBLISHED, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(schema).parquet(f"{run_dir}/postings")


def stream_latest(rows: DataFrame, run_dir: str, trigger: dict | None = None) -> StreamingQuery:
    """Keep the latest row per usable key of arriving rows: the winner of every key that a batch changes is written.

    What the stream remembers is one winner per key, in Spark's state store. A batch that is repeated writes the same.
    """
    state = rows.where(has_key(KEY)).groupBy(KEY).agg(F.max(standing()).alias("best"), F.count(F.lit(1)).alias("n"))

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{run_dir}/winners/batch_id={batch_id}")

    writer = state.writeStream.outputMode("update").option("checkpointLocation", f"{run_dir}/checkpoint").foreachBatch(handle)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def read_stream_latest(spark: SparkSession, run_dir: str) -> DataFrame:
    """``partner_job_id``, ``id`` of the row that is the latest so far, and ``n``, the rows that the key has had."""
    written = spark.read.parquet(f"{run_dir}/winners")
    # A later winner stands above every earlier one.
    return written.groupBy(KEY).agg(F.max("best").alias("best"), F.max("n").alias("n")).select(KEY, winner_id().alias("id"), "n")


def stream_access_log(
    requests: DataFrame,
    geo_dim: DataFrame,
    run_dir: str,
    mask: bool = True,
    hot_rows: int = HOT_ROWS,
    trigger: dict | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Write arriving requests as JSON lines to ``run_dir``/log."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        lines = log_lines(request_records(prepare(batch) if prepare else batch, geo_dim, mask, hot_rows=hot_rows)).select("line")
        lines.write.mode("overwrite").text(f"{run_dir}/log/batch_id={batch_id}")

    return _start(requests, run_dir, handle, trigger)


LOG_TABLE = T.StructType([T.StructField("time", T.StringType()), T.StructField("line", T.StringType())])


def stream_log_table(
    requests: DataFrame,
    geo_dim: DataFrame,
    table: VersionedTable,
    run_dir: str,
    name: str,
    rows_per_file: int,
    compact_every: int = 100,
    mask: bool = True,
    hot_rows: int = HOT_ROWS,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append arriving requests as JSON lines to a versioned table of LOG_TABLE, whose small files are put together
    by range of time after every ``compact_every`` batches.

    ``name`` tells the streams apart that write to the table: a batch that is repeated is not appended again.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        records = request_records(batch, geo_dim, mask, hot_rows=hot_rows)
        lines = log_lines(records).select(F.get_json_object("line", "$.time").alias("time"), "line")
        table.append(lines, f"{name}-{batch_id}")
        if (batch_id + 1) % compact_every == 0:
            table.compact(f"{name}-{batch_id}-compact", rows_per_file, order="time")

    return _start(requests, run_dir, handle, trigger)


def read_access_log(spark: SparkSession, run_dir: str) -> DataFrame:
    return spark.read.text(f"{run_dir}/log").select(F.col("value").alias("line"))


def stream_progress(
    ticks: DataFrame,
    staging: Callable[[], DataFrame],
    published: Callable[[], DataFrame],
    run_dir: str,
    run_id: str,
    trigger: dict | None = None,
    on_sample: Callable[[Row], None] | None = None,
) -> StreamingQuery:
    """Write a progress sample to ``run_dir``/samples for every micro-batch of ``ticks``.

    ``on_sample`` gets each sample, one row, once it is written.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        taken = F.lit(datetime.now(timezone.utc).replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")
        sample = progress(staging(), published()).select(
            F.lit(run_id).alias("run_id"), taken.alias("sampled_at"), "processed", "total", "percentage", "complete"
        )
        target = f"{run_dir}/samples/batch_id={batch_id}"
        sample.write.mode("overwrite").parquet(target)
        if on_sample:
            on_sample(spark.read.parquet(target).first())

    spark = ticks.sparkSession
    return _start(ticks, run_dir, handle, trigger or {"processingTime": WATCH_INTERVAL})


def read_progress(spark: SparkSession, run_dir: str) -> DataFrame:
    """The samples of a run with the rows processed since the previous sample."""
    return progress_delta(spark.read.parquet(f"{run_dir}/samples").drop("batch_id"))


def watch(
    spark: SparkSession,
    staging: Callable[[], DataFrame],
    published: Callable[[], DataFrame],
    run_dir: str,
    run_id: str,
    interval: str = WATCH_INTERVAL,
) -> None:
    """Sample the progress until all staged rows are published."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    done = Event()

    def stop_when_complete(sample: Row) -> None:
        if sample.complete:
            done.set()

    query = stream_progress(
        ticks, staging, published, run_dir, run_id, {"processingTime": interval}, on_sample=stop_when_complete
    )
    try:
        while not done.is_set() and not query.awaitTermination(1):
            pass
    finally:
        query.stop()
