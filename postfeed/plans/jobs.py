"""The sync, deduplication and feed jobs.

Each reads one snapshot and writes the next. What a job decides on (rows to remove, rows to
add) is a narrow table in the scratch folder, so the wide tables are read and moved once.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postfeed.operators.dedup import duplicates_to_remove
from postfeed.operators.keyed import HOT_ROWS
from postfeed.operators.keypass import EXPIRE, NEW, ids_of, row_actions
from postfeed.operators.posting import rejections, sink_accepts
from postfeed.operators.rewrite import RewriterFactory, load_new, next_id
from postfeed.operators.sync import delete_rows, reconcile, run_summary
from postfeed.session import materialise
from postfeed.sources.feed import write_feed
from postfeed.sources.tables import read_published, refuse_own_input
from postfeed.sources.versions import VersionedTable


@dataclass(frozen=True)
class SyncResult:
    expired: int
    new_found: int
    processed: int
    rejected: int
    all_published: bool
    missing_keys: int


@dataclass(frozen=True)
class DedupResult:
    total: int
    kept: int
    removed: int
    remaining: int

    @property
    def verified(self) -> bool:
        return self.remaining == self.kept


def _decided(staging: DataFrame, published: DataFrame, hot_rows: int) -> tuple[DataFrame, DataFrame]:
    """Ids of the new staging rows and of the expired published ones, as written tables."""
    actions = row_actions(staging, published, hot_rows).where(F.col("action").isin(NEW, EXPIRE)).select("id", "action")
    actions = materialise(actions, "actions")
    return ids_of(actions, NEW), ids_of(actions, EXPIRE)


def run_sync(
    spark: SparkSession,
    staging: DataFrame,
    published: DataFrame,
    out: str,
    run_ts: datetime,
    rejected_out: str | None = None,
    rewriter: RewriterFactory | None = None,
    workers: int = 1,
    hot_rows: int = HOT_ROWS,
) -> SyncResult:
    """Write the snapshot after ``published`` to ``out`` and check it against staging."""
    refuse_own_input(out, staging, published)
    now = F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz")
    new_ids, gone = _decided(staging, published, hot_rows)
    listed = materialise(staging.where(~sink_accepts()).select("id").join(new_ids, "id", "left_semi"), "rejected")
    new = load_new(staging, published, now, next_id(published), rewriter, workers, hot_rows, new_ids)
    delete_rows(published, gone).unionByName(new).write.mode("overwrite").parquet(out)
    if rejected_out:
        staging.join(listed, "id").withColumn("reasons", rejections()).write.mode("overwrite").parquet(rejected_out)
    result = read_published(spark, out)
    check = reconcile(staging, result).first()
    expired, rejected = gone.count(), listed.count()
    processed = check.published_rows - (published.count() - expired)
    return SyncResult(expired, processed + rejected, processed, rejected, check.all_published, check.missing_keys)


def run_dedup(spark: SparkSession, published: DataFrame, out: str) -> DedupResult:
    """Write ``published`` with one row per key to ``out`` and check the row count."""
    refuse_own_input(out, published)
    victims = materialise(duplicates_to_remove(published).select("id"), "duplicates")
    total, removed = published.count(), victims.count()
    delete_rows(published, victims).write.mode("overwrite").parquet(out)
    return DedupResult(total, total - removed, removed, read_published(spark, out).count())


def run_feed(published: DataFrame, out: str, now: datetime, ordered: bool = True, **options: str) -> None:
    write_feed(published, out, now, ordered, **options)


def sync_table(
    table: VersionedTable,
    staging: DataFrame,
    run_ts: datetime,
    commit: str,
    rewriter: RewriterFactory | None = None,
    workers: int = 1,
    hot_rows: int = HOT_ROWS,
) -> SyncResult:
    """One version further: expired rows go, new ones come, in one step that readers see whole or not at all.

    Only files that hold an expired row are written again. A run that broke off is repeated with the same commit
    id; if its version is there already, it is only checked.
    """
    done = table.applied(commit)
    before = table.read(done - 1 if done else None)
    if done:
        # Nothing is decided again: counts per key say what the commit did.
        did = run_summary(staging, before).first()
        expired, rejected = did.expired, did.new_found - did.processed
    else:
        now = F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz")
        new_ids, gone = _decided(staging, before, hot_rows)
        found = materialise(staging.select("id", sink_accepts().alias("fit")).join(new_ids, "id", "left_semi"), "found")
        new = load_new(staging, before, now, next_id(before), rewriter, workers, hot_rows, fresh=found.where("fit"))
        done = table.commit(commit, append=new, delete=gone).version
        expired, rejected = gone.count(), found.where("NOT fit").count()
    check = reconcile(staging, table.read(done)).first()
    processed = check.published_rows - (before.count() - expired)
    return SyncResult(expired, processed + rejected, processed, rejected, check.all_published, check.missing_keys)


def dedup_table(table: VersionedTable, commit: str) -> DedupResult:
    """One version further, with one row per key; only files that hold a row to remove are written again."""
    done = table.applied(commit)
    before = table.read(done - 1 if done else None)
    victims = materialise(duplicates_to_remove(before).select("id"), "duplicates")
    entry = table.commit(commit, delete=victims)
    total, removed = before.count(), victims.count()
    return DedupResult(total, total - removed, removed, entry.rows)
