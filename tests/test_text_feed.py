from __future__ import annotations

import glob
import xml.etree.ElementTree as ET
from datetime import datetime
from email.utils import format_datetime

import pytest
from fixed import NOW
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postfeed.functions import keys, text
from postfeed.sources import feed


def document(path):
    parts = sorted(glob.glob(f"{path}/*/part-*"))
    return "".join(open(part, encoding="utf-8", newline="").read() for part in parts)


@pytest.mark.parametrize(
    "given_text, expected",
    [
        ("a]]>b", "a]]]]><![CDATA[>b"),
        ("]]\x01>", "]]]]><![CDATA[>"),
        ("\t\r\n", "\t\r\n"),
        ("\x7fx\x0b\x0c\x1f", "x"),
        (None, ""),
        ("]]>]]>", "]]]]><![CDATA[>]]]]><![CDATA[>"),
    ],
)
def test_cdata(one, given_text, expected):
    assert one(text.escape_cdata("v"), v=given_text) == expected


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.binary(max_size=12), min_size=1, max_size=40))
def test_bytes_are_repaired_as_python_does(spark, values):
    df = spark.createDataFrame([(i, bytearray(v)) for i, v in enumerate(values)], "i int, b binary")
    got = {r.i: r.s for r in df.select("i", text.clean_utf8("b").alias("s")).collect()}
    assert got == {i: v.decode("utf-8", errors="replace") for i, v in enumerate(values)}


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="a \t\n\x0b\x0c\r\x1c\x1f\x85\xa0 　b", max_size=8), min_size=1, max_size=40))
def test_strip_is_pythons(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, s string")
    got = {r.i: r.s for r in df.select("i", text.strip("s").alias("s")).collect()}
    assert got == {i: v.strip() for i, v in enumerate(values)}


def test_truncation(one):
    assert one(text.truncate_text("v"), v="x" * 500) == "x" * 500
    assert one(text.truncate_text("v"), v="x" * 501) == "x" * 500 + "... [troncato]"
    assert one(text.truncate_text("v"), v="") == one(text.truncate_text("v"), v=None) == "(vuoto)"


def test_rfc_date_in_any_session_zone(spark):
    moments = [NOW, datetime(2021, 3, 28, 2, 30, 0), datetime(1999, 12, 31, 23, 59, 59, 999999)]
    df = spark.createDataFrame([(m,) for m in moments], "t timestamp_ntz")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "Europe/Rome"):
            spark.conf.set("spark.sql.session.timeZone", name)
            got = [r[0] for r in df.select(text.rfc_date("t")).collect()]
            assert got == [format_datetime(m) for m in moments]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_feed_key(published):
    rows = published({"id": 7, "partner_job_id": "k"}, {"id": 8, "partner_job_id": ""}, {"id": 0}, {"id": None})
    assert [r[0] for r in rows.select(keys.feed_key()).collect()] == ["k", "8", "0", ""]


def test_empty_feed(spark, published, tmp_path):
    feed.write_feed(published(), str(tmp_path / "f"), NOW)
    assert document(tmp_path / "f") == (
        '<?xml version="1.0" encoding="UTF-8"?>\n<source>\n'
        " <lastBuildDate> Mon, 08 Jan 2024 11:34:23 +0000 </lastBuildDate>\n</source>\n"
    )


def test_two_jobs(spark, published, tmp_path):
    rows = published({"id": 1, "position": "Software Engineer"}, {"id": 2, "position": "Data Scientist", "company_id": "9"})
    feed.write_feed(rows, str(tmp_path / "f"), NOW)
    whole = document(tmp_path / "f")
    assert whole.count(" <job>\n") == 2
    assert "  <partnerJobId><![CDATA[1]]></partnerJobId>\n  <company><![CDATA[]]></company>\n" in whole
    assert "  <title><![CDATA[Data Scientist]]></title>\n" in whole
    assert "  <companyId> <![CDATA[9]]></companyId>\n" in whole


@pytest.mark.parametrize("ordered", [False, True])
def test_parts_make_one_document_that_reads_back(spark, published, tmp_path, ordered):
    hazards = ["a]]>b", "<p>&amp;</p>", "x\x01y", "  padded  ", "", None, "è\n]]\x02>", "line\r\nend"]
    rows = published(
        *[
            {"id": i, "position": f"p{i}", "description": hazards[i % len(hazards)], "company_id": "5", "last_build_date": NOW}
            for i in range(200)
        ]
    ).repartition(5)
    path = str(tmp_path / "f")
    feed.write_feed(rows, path, datetime(2030, 1, 1), ordered=ordered)
    root = ET.fromstring(document(path))
    assert root.find("lastBuildDate").text == " Mon, 08 Jan 2024 11:34:23 -0000 "
    titles = [job.find("title").text for job in root.iter("job")]
    assert sorted(titles) == sorted(f"p{i}" for i in range(200))
    if ordered:
        assert titles == [f"p{i}" for i in range(200)]
    back = {r.title: (r.description, r.companyId) for r in feed.read_feed(spark, path).collect()}
    clean = text.strip_control(F.coalesce("description", F.lit("")))
    want = {r.position: (r.d, "5") for r in rows.select("position", clean.alias("d")).collect()}
    # XML reads every line end as LF.
    want = {k: (d.replace("\r\n", "\n"), c) for k, (d, c) in want.items()}
    assert back == want


def test_a_feed_in_scan_order_shuffles_no_jobs(published):
    plan = feed.feed_rows(published({"id": 1}))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
