from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from postfeed.operators import dedup, numbering
from postfeed.operators.progress import progress_delta

D1, D2 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def test_which_duplicate_stays(published):
    rows = published(
        {"id": 1, "partner_job_id": "tie", "updated_at": D1},
        {"id": 2, "partner_job_id": "tie", "updated_at": D1},
        {"id": 3, "partner_job_id": "no time"},
        {"id": 4, "partner_job_id": "no time"},
        {"id": 5, "partner_job_id": "created", "created_at": D2},
        {"id": 6, "partner_job_id": "created", "updated_at": D1, "created_at": D2},
        {"id": 7, "partner_job_id": "mixed"},
        {"id": 8, "partner_job_id": "mixed", "updated_at": D1},
        {"id": 9, "partner_job_id": ""},
        {"id": 10, "partner_job_id": ""},
        {"id": 11},
        {"id": 12, "partner_job_id": "single"},
    )
    kept = {r.id for r in dedup.keep_latest(rows).collect()}
    removed = {r.id for r in dedup.duplicates_to_remove(rows).collect()}
    assert kept == {1, 4, 5, 8, 9, 10, 11, 12}
    assert kept | removed == set(range(1, 13)) and not kept & removed
    assert dedup.dedup_counts(rows).first().asDict() == {"total": 12, "kept": 8, "to_remove": 4}
    assert {(r.partner_job_id, r.n) for r in dedup.duplicate_groups(rows).collect()} == {
        ("tie", 2), ("no time", 2), ("created", 2), ("mixed", 2),
    }


def test_a_key_is_cut_to_one_row_per_partition_before_the_shuffle(published):
    rows = published({"id": 1, "partner_job_id": "a"})
    plan = dedup.keep_latest(rows)._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in before_shuffle


@pytest.mark.parametrize("n, expected", [(0, 0), (1, 1), (20, 1), (21, 2)])
def test_batches(spark, n, expected):
    assert numbering.batch_no(spark.range(n), 20).select("batch_no").distinct().count() == expected


def test_ids_have_no_gaps_over_many_partitions(spark):
    rows = spark.range(50_000).select((F.col("id") * 7919 % 1_000_003).alias("id")).repartition(11)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = numbering.assign_ids(rows, start=10)
        parts = numbering.row_numbers(rows).count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    ordered = [r.new_id for r in got.orderBy("id").collect()]
    assert ordered == list(range(10, 50_010)) and parts == 50_000


def test_running_total_across_groups(spark, monkeypatch):
    monkeypatch.setattr(numbering, "BATCHES_PER_GROUP", 7)
    rows = spark.range(1, 101).select(F.col("id").alias("n"), (F.col("id") % 5).alias("v"))
    got = {r.n: r.t for r in numbering.running_total(rows, "n", "v", "t").collect()}
    total, want = 0, {}
    for n in range(1, 101):
        total += n % 5
        want[n] = total
    assert got == want


def test_batch_outcomes_count_rejected_rows(spark):
    rows = spark.range(45)
    got = numbering.batch_outcomes(rows, F.col("id") != 3, 20).orderBy("batch_no").collect()
    assert [tuple(r) for r in got] == [(1, 20, 19, 3, 19), (2, 20, 20, 3, 39), (3, 5, 5, 3, 44)]


def test_progress_delta_starts_from_zero_in_each_run(spark):
    samples = spark.createDataFrame([("r1", 1, 5), ("r1", 2, 9), ("r2", 1, 4)], "run_id string, sampled_at int, processed long")
    got = {(r.run_id, r.sampled_at): r.new_records for r in progress_delta(samples).collect()}
    assert got == {("r1", 1): 5, ("r1", 2): 4, ("r2", 1): 4}
