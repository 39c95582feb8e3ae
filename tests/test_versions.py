"""Versions of a table: deletion by file, commits that break off, race or repeat."""

from __future__ import annotations

import os

import pytest
from fixed import NOW
from pyspark.sql import functions as F

from postfeed.plans import jobs
from postfeed.plans.jobs import dedup_table, sync_table
from postfeed.schema import PUBLISHED
from postfeed.session import scratch_path
from postfeed.sources.versions import Conflict, VersionedTable

SCHEMA = "id long, name string"


@pytest.fixture
def made(spark):
    """A table of 100 rows in ten files by range of id, under commit 'first'."""
    rows = spark.range(100).select("id", F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"))
    table = VersionedTable(spark, scratch_path(spark, "versions"), rows.schema)
    table.append(rows.repartitionByRange(10, "id"), "first")
    return table


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def names(table, version=None):
    return {r.file for r in table.files(version).collect()}


def victims(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "id long")


def test_a_deletion_rewrites_only_files_with_victims(spark, made):
    before = names(made)
    entry = made.delete(victims(spark, 3, 5, 41, 1000, None, 5), "second")
    after = names(made)
    assert ids(made.read()) == sorted(set(range(100)) - {3, 5, 41})
    assert len(before) == 10 and len(before & after) == 8 and entry.removed == 2 and entry.rows == 97
    # Files carried over are the same files, not copies.
    assert {f for f in before & after if os.path.exists(f"{made.path}/{f}".removeprefix("file:"))} == before & after


def test_a_file_whose_rows_all_go_is_dropped(spark, made):
    low = sorted(r.id for r in made.read().where("id < 10").collect())
    held = {r.file for r in made.read().where(F.col("id").isin(low)).select(made._file().alias("file")).distinct().collect()}
    inside = made._rows(sorted(held)).select("id")
    entry = made.delete(inside, "gone")
    assert entry.files == 10 - len(held) and entry.added == 0 and entry.removed == len(held)


def test_nothing_to_delete_carries_all_files_over(spark, made):
    before = names(made)
    for i, who in enumerate((victims(spark, -1, 200), victims(spark), victims(spark, None))):
        entry = made.delete(who, f"none-{i}")
        assert names(made) == before and entry.added == entry.removed == 0


def test_delete_and_append_are_one_version(spark, made):
    entry = made.commit("both", append=spark.createDataFrame([(3, "again"), (None, "no id")], SCHEMA), delete=victims(spark, 3))
    rows = made.read().where("id = 3 OR id IS NULL").collect()
    assert sorted(r.name for r in rows) == ["again", "no id"] and entry.version == 2 and made.read().count() == 101


def test_a_repeated_commit_happens_once(spark, made):
    more = spark.createDataFrame([(500, "x")], SCHEMA)
    first = made.append(more, "more")
    made.append(spark.createDataFrame([(501, "y")], SCHEMA), "other")
    assert made.append(more, "more") == first and made.append(more, "first").version == 1
    assert ids(made.read())[-2:] == [500, 501] and made.versions() == [1, 2, 3]


def test_readers_stay_with_their_version(spark, made):
    before = made.read()
    made.delete(victims(spark, *range(50)), "half")
    made.replace(spark.createDataFrame([(1, "only")], SCHEMA), "new")
    assert before.count() == 100 and made.read(2).count() == 50 and ids(made.read()) == [1] and made.read(1).count() == 100


def test_a_table_can_be_replaced_by_rows_of_its_own(made):
    made.replace(made.read().where("id % 2 = 0"), "even")
    assert ids(made.read()) == list(range(0, 100, 2))


@pytest.mark.parametrize("step", ["_publish", "_listed"])
def test_a_commit_that_breaks_off_leaves_the_old_rows(spark, made, monkeypatch, step):
    """The job dies after the files are written, before the version is."""
    monkeypatch.setattr(VersionedTable, step, lambda *_: (_ for _ in ()).throw(OSError("lost")))
    more = spark.createDataFrame([(500, "x")], SCHEMA)
    with pytest.raises(OSError):
        made.commit("more", append=more, delete=victims(spark, 1))
    monkeypatch.undo()
    assert ids(made.read()) == list(range(100)) and made.applied("more") is None
    made.commit("more", append=more, delete=victims(spark, 1))
    assert ids(made.read()) == sorted({*range(100), 500} - {1})


def test_a_commit_that_dies_before_its_mark_is_known(spark, made, monkeypatch):
    """The version is there, the mark is not: the commit has happened, also after later ones."""
    real, more = VersionedTable._write_text, spark.createDataFrame([(500, "x")], SCHEMA)

    def dies(self, path, text):
        if path.startswith("applied/") and text == "2":
            raise OSError("lost")
        real(self, path, text)

    monkeypatch.setattr(VersionedTable, "_write_text", dies)
    with pytest.raises(OSError):
        made.append(more, "more")
    monkeypatch.undo()
    assert made.append(more, "more").version == 2 and made.read().count() == 101
    made.append(spark.createDataFrame([(501, "y")], SCHEMA), "next")
    assert made.append(more, "more").version == 2 and made.read().count() == 102


def test_commits_that_race_both_count(spark, made, monkeypatch):
    """Another writer takes the version while a deletion is under way; the deletion sees its rows."""
    real, raced = VersionedTable._publish, []

    def publish(self, entry):
        if not raced:
            raced.append(entry)
            VersionedTable(spark, made.path, made.schema).append(spark.createDataFrame([(7, "twin"), (600, "z")], SCHEMA), "other")
        real(self, entry)

    monkeypatch.setattr(VersionedTable, "_publish", publish)
    entry = made.delete(victims(spark, 7), "mine")
    assert entry.version == 3 and ids(made.read()) == sorted({*range(100), 600} - {7})


def test_a_version_cannot_be_taken_twice(made):
    with pytest.raises(Conflict):
        made._publish(made.version(1))
    assert made.versions() == [1]


def test_old_files_go_but_not_those_in_use(spark, made):
    made.delete(victims(spark, 3), "a")
    made.replace(spark.createDataFrame([(1, "only")], SCHEMA), "b")
    assert made.vacuum(keep=1) == 0 and made.versions() == [3]
    assert made.vacuum(keep=1, older_than_s=-60) == 4
    assert ids(made.read()) == [1] and made.applied("first") == 1


def test_an_empty_table(spark):
    table = VersionedTable(spark, scratch_path(spark, "versions"), spark.createDataFrame([], SCHEMA).schema)
    assert table.version() is None and table.read().count() == 0 and table.history().count() == 0
    table.delete(victims(spark, 1), "nothing")
    table.append(spark.createDataFrame([], SCHEMA), "no rows")
    assert table.read().count() == 0 and [r.commit for r in table.history().orderBy("version").collect()] == ["nothing", "no rows"]


def test_columns_have_to_be_those_of_the_table(spark, made):
    with pytest.raises(ValueError):
        made.append(spark.createDataFrame([(1, "x", 2)], SCHEMA + ", more int"), "wrong")


def test_sync_and_dedup_of_a_table(spark, published, staging):
    table = VersionedTable(spark, scratch_path(spark, "versions"), PUBLISHED)
    rows = published({"id": 1, "partner_job_id": "a"}, {"id": 2, "partner_job_id": "b"}, {"id": 3, "partner_job_id": "b"}, {"id": 4})
    table.append(rows.repartitionByRange(4, "id"), "load")
    arriving = staging({"id": 1, "partner_job_id": "b"}, {"id": 2, "partner_job_id": "c", "job_description": "<p>x</p>"}, {"id": 3, "position": None, "partner_job_id": "d"})
    for _ in range(2):
        result = sync_table(table, arriving, NOW, "sync-1")
        assert (result.expired, result.processed, result.rejected, result.missing_keys) == (1, 1, 1, 1)
    assert [(r.id, r.partner_job_id) for r in table.read().orderBy("id").collect()] == [(2, "b"), (3, "b"), (4, None), (5, "c")]
    for _ in range(2):
        cleaned = dedup_table(table, "dedup-1")
        assert (cleaned.total, cleaned.kept, cleaned.removed) == (4, 3, 1) and cleaned.verified
    assert ids(table.read()) == [3, 4, 5] and ids(table.read(1)) == [1, 2, 3, 4]


def test_a_repeated_sync_is_checked_and_not_decided_again(spark, staging, published, monkeypatch):
    table = VersionedTable(spark, scratch_path(spark, "versions"), PUBLISHED)
    table.append(published(*[{"id": i, "partner_job_id": k} for i, k in enumerate(["a", "a", "b", "", None], 1)]), "load")
    arriving = staging(*[{"id": i, "partner_job_id": k} for i, k in enumerate(["b", "b", "c", "c", "", None], 1)], {"id": 9, "position": None, "partner_job_id": "d"})
    first = sync_table(table, arriving, NOW, "sync-1")
    assert (first.expired, first.new_found, first.processed, first.rejected) == (2, 5, 4, 1)
    monkeypatch.setattr(jobs, "_decided", lambda *_: pytest.fail("decided again"))
    assert sync_table(table, arriving, NOW, "sync-1") == first
