from __future__ import annotations

import json
from datetime import datetime

import pytest
from fixed import NOW
from pyspark.sql import functions as F

from postfeed.functions import requests as fr
from postfeed.operators import requests
from postfeed.plans.jobs import run_dedup, run_feed, run_sync
from postfeed.schema import GEO_DIM, PUBLISHED
from postfeed.session import scratch_root
from postfeed.sources import accesslog, tables
from postfeed.streaming import streams

CHROME = "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) Chrome/120.0.1 Safari/537.36"


@pytest.mark.parametrize(
    "forwarded, real, peer, expected",
    [
        (" 1.2.3.4 , 10.0.0.1", "9.9.9.9", "8.8.8.8", "1.2.3.4"),
        ("", "9.9.9.9", "8.8.8.8", "9.9.9.9"),
        (", 1.2.3.4", "9.9.9.9", "8.8.8.8", ""),
        (None, "", "8.8.8.8", "8.8.8.8"),
        (None, None, None, None),
    ],
)
def test_client_ip(one, forwarded, real, peer, expected):
    assert one(fr.client_ip("f", "r", "p"), f=forwarded, r=real, p=peer) == expected


@pytest.mark.parametrize(
    "ip, expected",
    [
        (None, True), ("", True), ("127.0.0.1", True), ("::1", True), ("::12", False), ("10.1.1.1", True), ("100.1.1.1", False),
        ("192.168.1.1", True), ("192.169.1.1", False), ("172.15.1.1", False), ("172.16.1.1", True), ("172.31.1.1", True),
        ("172.32.1.1", False), ("172.x.1.1", False), ("172.16", True), ("172.", False), ("172.160.1.1", False),
        ("172.016.1.1", True), ("1721.16.1.1", False), ("8.8.8.8", False),
    ],
)
def test_private_ip(one, ip, expected):
    assert one(fr.is_private_ip("v"), v=ip) is expected


@pytest.mark.parametrize(
    "ua, name, version, os, device",
    [
        (CHROME, "Chrome", "120.0.1", "Mac OS X", "Mac"),
        ("Version/17.0 Safari/605.1", "Safari", None, None, None),
        ("(Windows NT 10.0) Firefox/121.0", "Firefox", "121.0", "Windows", "PC"),
        ("(X11; Linux) Chrome/1", "Unknown", None, "Linux", None),
        ("Firefox/", "Firefox", None, None, None),
        ("Chrome/ Safari/", "Chrome", None, None, None),
    ],
)
def test_user_agent(one, ua, name, version, os, device):
    got = one(fr.parse_user_agent("v"), v=ua)
    assert (got.name, got.version, got.os and got.os.name, got.device and got.device.name) == (name, version, os, device)


def test_blank_user_agent(one):
    assert one(fr.parse_user_agent("v"), v="") is None and one(fr.parse_user_agent("v"), v=None) is None


@pytest.fixture(scope="module")
def log(spark):
    columns = (
        "event_id long, method string, url_path string, url_scheme string, url_domain string, origin string, user_agent string,"
        " authorization string, x_forwarded_for string, x_real_ip string, peer_ip string, status_code int, started_ns long,"
        " ended_ns long, response_headers map<string,string>"
    )
    base = ("GET", "/x", "https", None, None)
    rows = [
        (1, *base, CHROME, "Bearer t", "5.5.5.5", None, None, 200, 1_000_000_000, 1_001_999_999, {"Access-Control-Allow-ORIGIN": "*", "Vary": "x"}),
        (2, *base, "", "", None, None, "10.0.0.1", 200, 0, 999_999, {}),
        (3, *base, None, None, None, "6.6.6.6", None, 500, 0, 5_000_000, None),
        (4, *base, None, None, None, "7.7.7.7", None, 200, 0, 0, {}),
        (5, *base, None, None, None, "9.9.9.9", None, 200, 0, 0, {}),
    ]
    return spark.createDataFrame(rows, columns)


@pytest.fixture(scope="module")
def geo(spark):
    rows = [
        ("5.5.5.5", None, "LZ", "Europe", None, "IT", "Italy", "Lazio", 41.5, 12.0),
        ("6.6.6.6", True, "LZ", "Europe", "Rome", "IT", "Italy", "Lazio", 41.5, None),
        ("7.7.7.7", False, "LZ", "Europe", "Rome", "IT", "Italy", "Lazio", 41.5, 12.0),
        ("10.0.0.1", True, "LZ", "Europe", "Rome", "IT", "Italy", "Lazio", 41.5, 12.0),
    ]
    return spark.createDataFrame(rows, GEO_DIM)


def test_geo_of_a_large_dimension_is_the_same(spark, log, geo, tmp_path):
    geo.write.parquet(f"{tmp_path}/geo")
    geo = spark.read.schema(geo.schema).parquet(f"{tmp_path}/geo")
    addressed = log.select("event_id", requests.client_ip("x_forwarded_for", "x_real_ip", "peer_ip").alias("client_ip"))
    near = requests.geo_enrich(addressed, geo)
    assert near._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        far = requests.geo_enrich(addressed, geo, hot_rows=1)
        assert far._jdf.queryExecution().optimizedPlan().toString().count("Join") > 1
        assert sorted(map(str, far.collect())) == sorted(map(str, near.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_records_and_lines(spark, log, geo, tmp_path):
    records = requests.request_records(log, geo, mask=False)
    accesslog.write_access_log(records, str(tmp_path / "log"))
    lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "log")).collect()]
    first, second, third, fourth, fifth = sorted(lines, key=lambda e: (e["destination"]["ip"] != "5.5.5.5", e["destination"]["ip"]))
    assert first == {
        "level": "INFO", "logger": "postfeed", "time": 1001,
        "request": {
            "authorization": "Bearer t", "method": "GET", "origin": None,
            "url": {"path": "/x", "original": "/x", "scheme": "https", "domain": None},
            "user_agent": {"original": CHROME, "name": "Chrome", "version": "120.0.1", "os": {"name": "Mac OS X"}, "device": {"name": "Mac"}},
        },
        "response": {"status_code": 200, "time": 1, "access-control-allow-origin": "*"},
        "destination": {"ip": "5.5.5.5", "geo": {
            "region_iso_code": "LZ", "continent_name": "Europe", "city_name": None, "country_iso_code": "IT", "country_name": "Italy",
            "location": {"lon": 12.0, "lat": 41.5}, "region_name": "Lazio"}},
    }
    assert "authorization" not in second["request"] and second["request"]["user_agent"] == {}
    assert second["destination"] == {"ip": "10.0.0.1"} and second["response"] == {"status_code": 200, "time": 0}
    assert "location" not in third["destination"]["geo"]
    assert "geo" not in fourth["destination"] and "geo" not in fifth["destination"]


def test_authorization_is_masked_by_default(log, geo):
    got = {r.event_id: r.record.request.authorization for r in requests.request_records(log, geo).collect()}
    assert len(got[1]) == 64 and got[2] is None


def test_tables(spark, published, tmp_path):
    path = str(tmp_path / "t")
    tables.append_postings(published({"id": 1}).select("id", "position"), path)
    tables.append_postings(published({"id": 2, "partner_job_id": "k"}), path)
    table = tables.read_published(spark, path)
    assert sorted(r.id for r in table.collect()) == [1, 2]
    assert [r.partner_job_id for r in tables.read_keys(table).collect()] == ["k"]
    with pytest.raises(ValueError, match="being read"):
        tables.full_refresh(table.where("id > 0"), path)
    with pytest.raises(ValueError, match="being read"):
        run_dedup(spark, table, path)
    assert table.count() == 2
    tables.full_refresh(published({"id": 3}), path)
    assert [r.id for r in tables.read_published(spark, path).collect()] == [3]


def test_jdbc_reads_id_ranges(published):
    """No database is at hand: this checks the arguments only."""
    calls = []

    class Reader:
        def jdbc(self, *args, **options):
            calls.append((args, options))
            return published({"id": 1}).drop("description", "company")

    class Session:
        read = Reader()

    table = tables.read_jdbc(Session(), "jdbc:x:y", "postings", 1, 900, 8, user="u")
    assert table.columns == PUBLISHED.names and table.first().company is None
    (args, options), = calls
    assert args == ("jdbc:x:y", "postings")
    assert (options["column"], options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("id", 1, 900, 8)
    assert options["properties"]["user"] == "u"


def test_key_filter_and_columns_reach_the_scan(spark, published, tmp_path):
    path = str(tmp_path / "t")
    tables.append_postings(published({"id": 1, "partner_job_id": "k", "description": "long"}), path)
    plan = tables.read_keys(tables.read_published(spark, path))._jdf.queryExecution().executedPlan().toString()
    assert "Not(EqualTo(partner_job_id,))" in plan and "ReadSchema: struct<partner_job_id:string>" in plan


def test_sync_job(spark, staging, published, tmp_path):
    s = staging(
        {"id": 1, "partner_job_id": "a"}, {"id": 2, "partner_job_id": "n"}, {"id": 3}, {"id": 4, "partner_job_id": "r", "position": None}
    )
    p = published({"id": 10, "partner_job_id": "a"}, {"id": 11, "partner_job_id": "gone"})
    out, refused = str(tmp_path / "v2"), str(tmp_path / "rejected")
    result = run_sync(spark, s, p, out, NOW, refused)
    assert (result.expired, result.new_found, result.processed, result.rejected) == (1, 3, 2, 1)
    assert (result.all_published, result.missing_keys) == (False, 1)
    assert sorted(r.id for r in tables.read_published(spark, out).collect()) == [10, 12, 13]
    assert [r.id for r in spark.read.parquet(refused).collect()] == [4]


def test_dedup_and_feed_jobs(spark, published, tmp_path):
    p = published(*[{"id": i, "partner_job_id": "hot" if i % 3 else None, "updated_at": datetime(2024, 1, i)} for i in range(1, 10)])
    result = run_dedup(spark, p, str(tmp_path / "v2"))
    assert (result.total, result.kept, result.removed, result.verified) == (9, 4, 5, True)
    kept = tables.read_published(spark, str(tmp_path / "v2"))
    assert sorted(r.id for r in kept.collect()) == [3, 6, 8, 9]
    run_feed(kept, str(tmp_path / "feed"), NOW)
    assert spark.read.text(str(tmp_path / "feed" / "1-jobs")).count() == 4 * 12


def _arrive(df, path, parts):
    for part in range(parts):
        df.where(F.col("id") % parts == part).coalesce(1).write.mode("append").parquet(path)


def test_sync_stream_equals_the_batch_job(spark, staging, published, tmp_path):
    s = staging(*[{"id": i, "partner_job_id": f"k{i % 7}" if i % 4 else None, "job_description": f"<h1>{i}</h1>"} for i in range(60)])
    p = published({"id": 5, "partner_job_id": "k1"}, {"id": 6, "partner_job_id": "k2"})
    _arrive(s, str(tmp_path / "in"), 3)
    source = spark.readStream.schema(s.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    run_dir = str(tmp_path / "run")
    streams.stream_sync(source, p, run_dir, NOW).awaitTermination()
    got = streams.read_stream_postings(spark, run_dir)
    from postfeed.operators.rewrite import load_new

    want = load_new(s, p, F.lit(NOW).cast("timestamp_ntz"), 7)
    shown = ["partner_job_id", "description", "created_at"]
    assert sorted(map(str, got.select(shown).collect())) == sorted(map(str, want.select(shown).collect()))
    assert sorted(r.id for r in got.collect()) == list(range(7, 7 + want.count()))
    assert got.select("batch_id").distinct().count() == 3
    # A restart finds nothing new and leaves the output as it is.
    streams.stream_sync(source, p, run_dir, NOW).awaitTermination()
    assert streams.read_stream_postings(spark, run_dir).count() == want.count()


def test_a_sync_batch_is_decided_on_ids_and_keys(spark, staging, published, tmp_path, monkeypatch):
    rows = staging(*[{"id": i, "partner_job_id": k, "job_description": "<p>x</p>"} for i, k in enumerate(["a", "b", "b", "", None], 1)], {"id": 6, "position": None, "partner_job_id": "c"})
    rows.write.parquet(str(tmp_path / "in"))
    seen, load = [], streams.load_new

    def spied(batch, *args, fresh, **options):
        seen.append((fresh._jdf.queryExecution().analyzed().toString(), batch.storageLevel.useMemory))
        return load(batch, *args, fresh=fresh, **options)

    monkeypatch.setattr(streams, "load_new", spied)
    source = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    streams.stream_sync(source, published({"id": 3, "partner_job_id": "a"}), str(tmp_path / "run"), NOW).awaitTermination()
    assert len(seen) == 1 and "job_description" not in seen[0][0] and not seen[0][1]
    got = streams.read_stream_postings(spark, str(tmp_path / "run")).orderBy("id").collect()
    assert [(r.id, r.partner_job_id) for r in got] == [(4, "b"), (5, "b"), (6, ""), (7, None)]
    refused = spark.read.parquet(str(tmp_path / "run" / "rejected")).collect()
    assert [(r.id, r.reasons) for r in refused] == [(6, ["position: missing"])]


def test_log_stream_equals_the_batch_log(spark, log, geo, tmp_path):
    log.repartition(2).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    streams.stream_access_log(source, geo, str(tmp_path / "run")).awaitTermination()
    want = requests.log_lines(requests.request_records(log, geo)).select("line")
    got = streams.read_access_log(spark, str(tmp_path / "run"))
    assert sorted(r.line for r in got.collect()) == sorted(r.line for r in want.collect())


def test_watch_stops_when_all_is_published(spark, staging, published, tmp_path):
    seen = {"n": 0}

    def now_published():
        seen["n"] += 2
        return published(*[{"id": i} for i in range(min(seen["n"], 5))])

    run_dir = str(tmp_path / "run")
    streams.watch(spark, lambda: staging(*[{"id": i} for i in range(5)]), now_published, run_dir, "r", interval="1 second")
    samples = streams.read_progress(spark, run_dir).orderBy("sampled_at").collect()
    assert [s.processed for s in samples][:3] == [2, 4, 5] and [s.new_records for s in samples][:3] == [2, 2, 1]
    assert samples[2].complete and not samples[0].complete


def test_scratch_folder_is_the_clusters(spark):
    assert scratch_root(spark) == (spark.conf.get("spark.checkpoint.dir", None) or scratch_root(spark)).rstrip("/")
