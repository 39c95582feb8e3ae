"""Reading any feed document, feeds kept up to date and logs with few files."""

from __future__ import annotations

import os
import random
import xml.etree.ElementTree as ET

import pytest
from fixed import NOW
from pyspark.sql import functions as F

from postfeed.catalog.queries import all_queries
from postfeed.session import scratch_path
from postfeed.sources import feed, feedread
from postfeed.sources.versions import VersionedTable

HEAD = '<?xml version="1.0" encoding="UTF-8"?>\n<source>\n <lastBuildDate> x </lastBuildDate>\n'


def job(i, description="x", end="title"):
    return (
        f" <job>\n  <partnerJobId><![CDATA[{i}]]></partnerJobId>\n  <title><![CDATA[t{i}]]></{end}>\n"
        f"  <description><![CDATA[{description}]]></description>\n  <companyId> <![CDATA[9]]></companyId>\n </job>\n"
    )


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "600")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def read(spark, folder):
    jobs, aside = feedread.read_document(spark, str(folder))
    return {r.partnerJobId: r for r in jobs.collect()}, sorted(aside.collect(), key=lambda r: (r.file, r.offset))


def test_one_document_over_many_splits(spark, tmp_path, small_splits):
    texts = {i: ["plain", "a </job> b <job> c " * (i % 6), "è" * i, "", "]]]]><![CDATA[>"][i % 5] for i in range(60)}
    document = HEAD + "".join(job(i, texts[i], "tile" if i in (3, 17, 40) else "title") for i in texts)
    # A CDATA section without an end takes the next job's start along; that job is read all the same.
    document = document.replace("<![CDATA[t30]]>", "<![CDATA[t30") + "</source>\n"
    raw = document.encode()
    (tmp_path / "feed.xml").write_bytes(raw)
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 5
    jobs, aside = read(spark, tmp_path)
    assert set(jobs) == {str(i) for i in texts} - {"3", "17", "30", "40"}
    for i, text in texts.items():
        if str(i) in jobs:
            assert jobs[str(i)].description == text.replace("]]]]><![CDATA[>", "]]>") and jobs[str(i)].companyId == "9"
    assert len(aside) == 4
    for r in aside:
        assert raw[r.offset : r.offset + len(r.text.encode())] == r.text.encode() and any(f"[{i}]" in r.text for i in (3, 17, 30, 40))


@pytest.mark.parametrize("seed", range(3))
def test_documents_read_as_a_parser_reads_them(spark, tmp_path, small_splits, seed):
    rng = random.Random(seed)
    bits = ["</job>", "<job>", "]]", "&amp;", "<p>", "é漢", "\n", "word "]
    for f in range(3):
        body = "".join(job(f * 100 + i, "".join(rng.choices(bits, k=rng.randrange(12)))) for i in range(rng.randrange(25)))
        (tmp_path / f"{f}.xml").write_text(HEAD + body + "</source>", encoding="utf-8")
    want = {j.find("partnerJobId").text: j.find("description").text or "" for f in range(3) for j in ET.parse(tmp_path / f"{f}.xml").getroot().iter("job")}
    jobs, aside = read(spark, tmp_path)
    assert {k: r.description for k, r in jobs.items()} == want and aside == []


def test_a_document_that_ends_in_a_job(spark, tmp_path):
    (tmp_path / "a.xml").write_text(HEAD + job(1) + " <job>\n <partnerJobId>2")
    (tmp_path / "b.xml").write_text(HEAD + job(3) + " nothing of a job </job>" + job(4))
    (tmp_path / "c.xml").write_text("")
    jobs, aside = read(spark, tmp_path)
    assert set(jobs) == {"1", "3", "4"} and [r.text.split()[-1] for r in aside] == ["<partnerJobId>2", "job"]


# ---- feeds kept up to date ----


def parts(path):
    found = {}
    for folder, _, names in os.walk(path):
        found |= {f"{folder}/{n}": os.stat(f"{folder}/{n}").st_mtime_ns for n in names if n.startswith("part-") and "_digests" not in folder}
    return found


def document(path):
    return "".join(open(p, encoding="utf-8").read() for p in sorted(parts(path)))


def test_only_changed_ranges_are_rendered(spark, published, tmp_path):
    rows = published(*[{"id": i, "position": f"p{i}", "partner_job_id": f"k{i}"} for i in range(100)])
    path, whole = str(tmp_path / "f"), str(tmp_path / "whole")
    assert feed.refresh_feed(rows, path, NOW, range_ids=10) == 10
    before = parts(path)
    assert feed.refresh_feed(rows, path, NOW, range_ids=10) == 0
    changed = rows.withColumn("position", F.when(F.col("id") == 42, "other").otherwise(F.col("position")))
    assert feed.refresh_feed(changed, path, NOW, range_ids=10) == 1
    after = parts(path)
    jobs = lambda found: {p: t for p, t in found.items() if "1-jobs" in p}
    assert len(set(jobs(before).items()) & set(jobs(after).items())) == 9
    feed.write_feed(changed, whole, NOW)
    assert document(path) == document(whole)
    # What is not shown does not count; rows that go, come and move do.
    assert feed.refresh_feed(changed.withColumn("updated_at", F.lit(NOW).cast("timestamp_ntz")), path, NOW, range_ids=10) == 0
    moved = changed.where("id NOT BETWEEN 20 AND 29").unionByName(published({"id": 250, "position": "far"}))
    assert feed.refresh_feed(moved, path, NOW, range_ids=10) == 1
    feed.write_feed(moved, whole, NOW)
    assert document(path) == document(whole)


def test_a_refresh_that_broke_off_is_done_again(spark, published, tmp_path, monkeypatch):
    rows, path = published({"id": 1, "position": "a"}, {"id": 25, "position": "b"}), str(tmp_path / "f")
    feed.refresh_feed(rows, path, NOW, range_ids=10)
    changed = rows.withColumn("position", F.lit("c"))
    monkeypatch.setattr(feed, "feed_build_date", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        feed.refresh_feed(changed.where("id = 1"), path, NOW, range_ids=10)
    monkeypatch.undo()
    assert feed.refresh_feed(changed, path, NOW, range_ids=10) == 2
    assert document(path).count("[c]") == 2


# ---- files of a table that many commits fill ----


def test_compaction_bounds_the_files_and_keeps_the_rows(spark):
    table = VersionedTable(spark, scratch_path(spark, "log"), spark.range(1).schema)
    for i in range(12):
        table.append(spark.range(i * 10, i * 10 + 10).repartition(3), f"batch-{i}")
    table.append(spark.range(1000, 1200).repartition(1), "big")
    pinned, big = table.read(), {r.file for r in table.files().where("n = 200").collect()}
    assert table.version().files == 37
    entry = table.compact("tidy", rows_per_file=60, order="id")
    assert entry.files <= 1 + 2 * 2 + 1 and entry.rows == 320 and big <= {r.file for r in table.files().collect()}
    assert sorted(r.id for r in table.read().collect()) == [*range(120), *range(1000, 1200)] and pinned.count() == 320
    assert table.compact("tidy", rows_per_file=60) == entry
    # Nothing small is left, so nothing is done.
    assert table.compact("again", rows_per_file=60).version == entry.version


def test_compaction_keeps_commits_that_come_between(spark, monkeypatch):
    table = VersionedTable(spark, scratch_path(spark, "log"), spark.range(1).schema)
    for i in range(4):
        table.append(spark.range(i * 10, i * 10 + 10).repartition(1), f"batch-{i}")
    real, raced = VersionedTable._publish, []

    def publish(self, entry):
        if not raced:
            raced.append(entry)
            other = VersionedTable(spark, table.path, table.schema)
            other.commit("other", append=spark.range(900, 905), delete=spark.range(3, 4))
        real(self, entry)

    monkeypatch.setattr(VersionedTable, "_publish", publish)
    table.compact("tidy", rows_per_file=100)
    assert sorted(r.id for r in table.read().collect()) == sorted({*range(40), *range(900, 905)} - {3})


def test_the_log_stream_fills_a_table_once(spark):
    from postfeed.catalog.views import view, view_stream
    from postfeed.streaming import streams

    sf, run_dir = "/root/testdata/sf0.001", scratch_path(spark, "log-stream")
    table = VersionedTable(spark, f"{run_dir}/log", streams.LOG_TABLE)
    for run in ("a", "b"):
        # The second start has lost its progress and sends the same batches again.
        arriving = view_stream(spark, sf, "requests", "events", "event_id")
        streams.stream_log_table(arriving, view(spark, sf, "geo_dim"), table, f"{run_dir}/{run}", "requests", 10_000, compact_every=3).awaitTermination()
    assert table.read().count() == spark.read.parquet(f"{sf}/events.parquet").count()
    assert table.read().where("time IS NULL").count() == 0 and table.version().files == 1


def test_scratch_of_a_scope_goes_with_it(spark):
    from postfeed.session import materialise, path_exists, scratch_scope

    kept = scratch_path(spark, "kept")
    spark.range(3).write.parquet(kept)
    with scratch_scope(spark):
        inner = materialise(spark.range(5), "inner")
        path = inner.inputFiles()[0].rsplit("/", 1)[0]
        assert inner.count() == 5
    assert not path_exists(spark, path) and path_exists(spark, kept)


def test_refreshed_postings_are_joined_once(spark, tmp_path, monkeypatch):
    ids = spark.range(200)
    ids.selectExpr("id AS doc_id", "concat('text ', id) AS text", "'web' AS source", "'en' AS lang").write.parquet(str(tmp_path / "documents.parquet"))
    ids.selectExpr("id AS o_orderkey", "id AS o_custkey", "'1-URGENT' AS o_orderpriority", "CAST('2024-01-01' AS timestamp_ntz) AS o_orderdate").write.parquet(str(tmp_path / "orders.parquet"))
    ids.selectExpr("id AS c_custkey", "concat('c', id) AS c_name", "1L AS c_nationkey", "'m' AS c_mktsegment").write.parquet(str(tmp_path / "customer.parquet"))
    plans, refresh = [], feed.refresh_feed
    seen = lambda df, *args, **kw: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or refresh(df, *args, **kw)
    monkeypatch.setattr(feed, "refresh_feed", seen)
    read = all_queries()["feed_refreshed"](spark, str(tmp_path))
    assert len(plans) == 2 and not any("Join" in plan for plan in plans)
    assert read.count() == 200
