"""Key index, one key pass, winners of deltas and digests of snapshots: against plain recomputation."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from postfeed.operators import dedup, keypass, rowdigest, sync, winners
from postfeed.operators.keyed import key_set
from postfeed.session import scratch_path
from postfeed.sources.keyindex import KeyIndex
from postfeed.streaming import streams

DAY = datetime(2024, 1, 1)


def ids(df):
    return sorted(row.id for row in df.select("id").collect())


def keys(df):
    return sorted(row.partner_job_id for row in df.collect())


# ---- key index ----


def numbered(spark, *ranges):
    parts = [spark.range(a, b) for a, b in ranges]
    df = parts[0]
    for part in parts[1:]:
        df = df.unionAll(part)
    return df.select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("partner_job_id"))


@pytest.fixture(scope="module")
def index(spark):
    made = KeyIndex(spark, scratch_path(spark, "index"))
    made.add(numbered(spark, (0, 20_000), (0, 50)), "one", bucket_keys=400)
    made.add(numbered(spark, (20_000, 20_300)), "two", bucket_keys=100)
    return made


def test_the_index_knows_its_keys_and_no_others(spark, index):
    assert index.parts()["one"][0] == 50 and index.parts()["two"][0] == 3
    asked = numbered(spark, (19_990, 20_010), (20_295, 20_400), (0, 3), (0, 3)).unionAll(spark.sql("SELECT CAST(NULL AS STRING)"))
    assert keys(index.known(asked)) == sorted(f"k{i}" for i in [*range(19_990, 20_010), *range(20_295, 20_300), 0, 1, 2])
    assert index.known(numbered(spark, (50_000, 60_000))).count() == 0
    assert index.known(asked.limit(0)).count() == 0


def test_what_is_read_grows_with_the_keys_asked(spark, index):
    few = index.buckets_to_read(numbered(spark, (5, 7)), "one")
    assert 1 <= len(few) <= 3
    assert len(index.buckets_to_read(numbered(spark, (0, 20_000)), "one")) == 50
    # Filters keep most absent keys from opening a bucket.
    absent = numbered(spark, (100_000, 102_000))
    assert index.candidates(absent, "one").count() < 100
    files = index._read("keys", "one", few, "partner_job_id string").inputFiles()
    assert len(files) == len(few)


def test_filters_lose_no_key(spark, index):
    assert index.candidates(numbered(spark, (0, 20_000)), "one").count() == 20_000


def test_a_part_is_added_once(spark, index):
    index.add(numbered(spark, (700_000, 700_010)), "two")
    assert index.known(numbered(spark, (700_000, 700_010))).count() == 0


def test_an_empty_index(spark):
    made = KeyIndex(spark, scratch_path(spark, "index"))
    assert made.known(numbered(spark, (0, 5))).count() == 0
    made.add(numbered(spark, (0, 0)), "none")
    assert made.known(numbered(spark, (0, 5))).count() == 0


def test_a_part_that_broke_off_is_not_there(spark, monkeypatch):
    made = KeyIndex(spark, scratch_path(spark, "index"))
    monkeypatch.setattr(type(spark), "createDataFrame", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        made.add(numbered(spark, (0, 5)), "one")
    monkeypatch.undo()
    assert made.parts() == {}
    made.add(numbered(spark, (3, 9)), "one")
    assert keys(made.known(numbered(spark, (0, 5)))) == ["k3", "k4"]


# ---- one pass over the keys ----


@pytest.fixture(scope="module")
def sides(spark, staging, published):
    rng = random.Random(5)
    pick = lambda: rng.choice([None, "", "hot", "hot", "hot-s", "hot-p", *[f"k{rng.randrange(60)}" for _ in range(5)]])
    s = staging(*[{"id": i, "partner_job_id": k} for i in range(300) if (k := pick()) != "hot-p"])
    p = published(*[{"id": i, "partner_job_id": k} for i in range(300) if (k := pick()) != "hot-s"])
    return s, p


@pytest.mark.parametrize("broadcast", ["-1", "10m"])
def test_actions_are_those_of_the_single_questions(spark, sides, monkeypatch, broadcast):
    s, p = sides
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        done = keypass.row_actions(s, p, hot_rows=5)
        of = {a: ids(keypass.ids_of(done, a)) for a in (keypass.NEW, keypass.SKIP, keypass.KEEP, keypass.EXPIRE)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert of["new"] == ids(sync.new_postings(s, p)) and of["skip"] == ids(sync.already_published(s, p))
    gone = ids(sync.expired_postings(p, s))
    assert of["expire"] == gone and of["keep"] == sorted(set(range(0, 300)) & set(ids(p)) - set(gone))


def test_nothing_expires_without_staging(sides, staging):
    _, p = sides
    done = keypass.row_actions(staging(), p)
    assert {r.action for r in done.collect()} == {"keep"} and done.count() == p.count()


def test_both_sides_share_one_exchange_of_keys(sides):
    plan = keypass.key_pass(*sides)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


# ---- winners ----


def rows_of(published, seed, n=200):
    rng = random.Random(seed)
    time = lambda: rng.choice([None, DAY, DAY + timedelta(days=rng.randrange(3))])
    return published(*[{"id": i, "partner_job_id": rng.choice([None, "", "a", "b", "c", f"k{rng.randrange(40)}"]), "updated_at": time(), "created_at": time()} for i in range(n)])


@pytest.mark.parametrize("seed", range(3))
def test_deltas_give_what_all_rows_give(published, seed):
    rows = rows_of(published, seed).cache()
    deltas = [rows.where(f"pmod(xxhash64(id, {seed}), 3) = {i}") for i in range(3)]
    state, gone = winners.winner_state(rows.limit(0)), []
    for delta in deltas:
        after = winners.merge_states(state, winners.winner_state(delta)).cache()
        gone += ids(winners.superseded(state, delta, after))
        state = after
    blank = ids(rows.where("partner_job_id IS NULL OR partner_job_id = ''"))
    assert sorted(ids(winners.winners(state)) + blank) == ids(dedup.keep_latest(rows))
    # Each row is superseded once.
    assert sorted(gone) == ids(dedup.duplicates_to_remove(rows))
    counts = {r.partner_job_id: r.n for r in state.collect()}
    assert counts == {r.partner_job_id: r.n for r in winners.winner_state(rows).collect()}


def test_states_merge_in_any_order(published):
    rows = rows_of(published, 9)
    a, b, c = (winners.winner_state(rows.where(f"id % 3 = {i}")) for i in range(3))
    one, other = winners.merge_states(winners.merge_states(a, b), c), winners.merge_states(c, winners.merge_states(b, a))
    assert sorted(map(str, one.collect())) == sorted(map(str, other.collect()))


def test_the_stream_keeps_the_latest(spark, published):
    rows, folder = rows_of(published, 4), scratch_path(spark, "latest")
    for i in range(3):
        rows.where(f"id % 3 = {i}").coalesce(1).write.mode("append").parquet(f"{folder}/in")
    arriving = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    for _ in range(2):
        streams.stream_latest(arriving, f"{folder}/run").awaitTermination()
    got = streams.read_stream_latest(spark, f"{folder}/run")
    want = winners.winner_state(rows)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select("partner_job_id", winners.winner_id().alias("id"), "n").collect()))


# ---- digests ----


def test_equal_tables_have_equal_digests(published):
    rows = rows_of(published, 1)
    other = rows.repartition(3).select(*reversed(rows.columns))
    assert rowdigest.differing_buckets(rowdigest.digests(rows), rowdigest.digests(other)).count() == 0
    assert rowdigest.differing_buckets(rowdigest.digests(rows.limit(0)), rowdigest.digests(rows.limit(0))).count() == 0


def found(intended, table):
    buckets = rowdigest.differing_buckets(rowdigest.digests(intended), rowdigest.digests(table))
    return buckets, sorted(map(tuple, rowdigest.differing_rows(intended, table, buckets).collect()))


def test_one_changed_text_is_reported(published):
    rows = rows_of(published, 2)
    changed = rows.withColumn("description", F.when(F.col("id") == 77, "x").otherwise(F.col("description")))
    buckets, off = found(rows, changed)
    assert off == [(77, 1, 1)] and [(r.missing,) for r in buckets.collect()] == [(0,)]


def test_lost_repeated_and_swapped_rows_are_reported(published):
    rows = rows_of(published, 3)
    table = rows.where("id <> 5").unionByName(rows.where("id = 9"))
    # Two rows that have changed places in one column.
    table = table.withColumn("company", F.when(F.col("id") == 20, "b").when(F.col("id") == 21, "a"))
    intended = rows.withColumn("company", F.when(F.col("id") == 20, "a").when(F.col("id") == 21, "b"))
    assert found(intended, table)[1] == [(5, 1, 0), (9, 0, 1), (20, 1, 1), (21, 1, 1)]


def test_nulls_in_different_columns_differ(spark):
    a, b = (spark.createDataFrame([(1, *v)], "id long, x string, y string") for v in (("v", None), (None, "v")))
    assert found(a, b)[1] == [(1, 1, 1)]


def test_what_is_meant_follows_from_the_parts(published):
    rows = rows_of(published, 6)
    gone, new = rows.where("id % 7 = 0"), rows.where("id < 30").withColumn("id", F.col("id") + 1000)
    meant = rowdigest.added_up(rowdigest.digests(rows), rowdigest.digests(gone, sign=-1), rowdigest.digests(new))
    written = rows.where("id % 7 <> 0").unionByName(new)
    assert rowdigest.differing_buckets(meant, rowdigest.digests(written)).count() == 0
    assert rowdigest.differing_buckets(meant, rowdigest.digests(written.where("id <> 1003"))).count() == 1


def test_key_set_is_what_an_index_takes(spark, published):
    made = KeyIndex(spark, scratch_path(spark, "index"))
    made.add(key_set(rows_of(published, 1)), "all")
    assert keys(made.known(key_set(rows_of(published, 1)))) == keys(key_set(rows_of(published, 1)))
