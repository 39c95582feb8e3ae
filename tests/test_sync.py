from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from postfeed.operators import sync
from postfeed.functions.text import percent
from postfeed.operators.keyed import hot_keys, key_set, keyed_join


def ids(df):
    return sorted(row.id for row in df.select("id").collect())


@pytest.fixture(scope="module")
def sides(staging, published):
    keys = [None, "", "a", "A", " a", "b", "b", "only-staging", "only-staging"]
    s = staging(*[{"id": i, "partner_job_id": k} for i, k in enumerate(keys)])
    p = published(*[{"id": 100 + i, "partner_job_id": k} for i, k in enumerate([None, "", "a", "b", "gone", "GONE"])])
    return s, p


def test_blank_keys_are_new_and_case_and_spaces_matter(sides):
    s, p = sides
    assert ids(sync.new_postings(s, p)) == [0, 1, 3, 4, 7, 8]
    assert ids(sync.already_published(s, p)) == [2, 5, 6]
    assert ids(sync.new_postings(s, p, blank_keys="skip")) == [3, 4, 7, 8]


def test_expiry(sides, staging):
    s, p = sides
    assert ids(sync.expired_postings(p, s)) == [104, 105]
    assert ids(sync.expired_postings(p, staging())) == []
    blank_only = staging({"id": 1, "partner_job_id": ""}, {"id": 2})
    assert ids(sync.expired_postings(p, blank_only)) == [102, 103, 104, 105]


def test_counts_agree_with_the_rows(sides, staging, published):
    s, p = sides
    assert sync.sync_counts(s, p).first().asDict() == {"total": 9, "skipped": 3, "new": 6}
    assert sync.run_summary(s, p).first().asDict() == {"expired": 2, "new_found": 6, "processed": 6}
    check = sync.reconcile(s, p).first()
    assert (check.staging_keys, check.published_keys, check.missing_keys, check.all_published) == (5, 4, 3, False)
    empty = sync.run_summary(staging(), p).first()
    assert empty.asDict() == {"expired": 0, "new_found": 0, "processed": 0}
    assert sync.reconcile(staging(), published()).first().all_published


def test_flag(sides):
    s, p = sides
    flags = {row.id: row.is_published for row in sync.published_flag(s, p).collect()}
    assert [i for i, flag in flags.items() if flag] and {i for i, flag in flags.items() if flag} == {2, 5, 6}


def test_progress(staging, published):
    row = {"id": 1}
    assert sync.progress(staging(), published()).first().asDict() == {
        "processed": 0, "total": 0, "percentage": 0.0, "complete": False,
    }
    over = sync.progress(staging(row, row), published(row, row, row)).first()
    assert (over.percentage, over.complete) == (150.0, True)
    eighth = sync.progress(staging(*[row] * 400), published(*[row] * 49)).first()
    assert eighth.percentage == 12.2  # 12.25, half to even


def test_percent_is_what_formatting_to_one_decimal_gives(spark):
    ratios = [(i, n) for n in (7, 160, 400, 2000) for i in range(0, n + 3)] + [(5, 0), (30_000, 7)]
    df = spark.createDataFrame(ratios, "i long, n long").select("i", "n", percent(F.col("i"), F.col("n")).alias("p"))
    assert [(r.i, r.n) for r in df.collect() if r.p != (float(f"{r.i / r.n * 100:.1f}") if r.n else 0.0)] == []


def test_expired_examples_say_how_many_more(published, staging):
    rows = published(*[{"id": i, "partner_job_id": f"k{i}"} for i in range(8)])
    shown = sync.expired_details(sync.expired_postings(rows, staging({"id": 1, "partner_job_id": "x"}))).collect()
    assert [(r.id, r.more) for r in shown] == [(i, 3) for i in range(5)]


def test_every_one_of_many_hot_keys_is_salted(spark):
    rows = spark.range(60_000).select("id", (F.col("id") % 3000).cast("string").alias("k"))
    spark.conf.set("spark.sql.shuffle.partitions", "1000")
    try:
        assert hot_keys(rows, "k", hot_rows=10).where("__salts > 1").count() == 3000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_missing_examples(staging, published):
    s = staging(*[{"id": i, "partner_job_id": f"k{i:02d}"} for i in range(13)])
    shown = sync.missing_examples(sync.missing_keys(s, published())).collect()
    assert [row.partner_job_id for row in shown] == [f"k{i:02d}" for i in range(10)]
    assert {row.more for row in shown} == {3}


def test_report_widths(published):
    p = published(
        {"id": 1, "position": "x" * 40, "company": "y" * 20, "partner_job_id": "a"},
        {"id": 2, "position": "x" * 41, "company": "y" * 21, "partner_job_id": "b"},
        {"id": 3, "position": "", "company": None, "partner_job_id": "c"},
    )
    rows = {r.id: (r.position, r.company) for r in sync.expired_report(p).collect()}
    assert rows == {1: ("x" * 40, "y" * 20), 2: ("x" * 38 + "..", "y" * 18 + ".."), 3: ("N/A", "N/A")}


@pytest.mark.parametrize("how", ["left_semi", "left_anti", "left"])
def test_hot_keys_do_not_change_the_result_and_are_spread(spark, how):
    # A third of the rows has one key, another third none.
    rows = spark.range(30_000).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, "").otherwise(
            F.concat(F.lit("k"), (F.col("id") % 500).cast("string"))
        ).alias("k"),
    )
    entries = key_set(rows.where("k = 'hot' OR k < 'k3'"), "k").withColumn("found", F.lit(1))
    plain = rows.withColumn("k", F.nullif("k", F.lit(""))).join(entries, "k", how)
    spread = keyed_join(rows, entries, "k", how, hot_rows=500)
    columns = sorted(set(spread.columns) - {"k"})
    assert sorted(map(str, spread.select(columns).collect())) == sorted(map(str, plain.select(columns).collect()))
    # Without broadcasting the entries, no task of the join gets a large share of the rows.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        sizes = keyed_join(rows, entries, "k", "left", hot_rows=500).groupBy(F.spark_partition_id()).count()
        assert max(r["count"] for r in sizes.collect()) < 30_000 / 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
