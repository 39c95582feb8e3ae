from __future__ import annotations

import random
import re
import time

import pytest
from fixed import NOW
from pyspark.sql import functions as F

from postfeed.functions import markup
from postfeed.operators import reports, rewrite
from postfeed.operators.posting import conform_schema, schema_violations, sink_accepts
from postfeed.operators.sync import missing_keys
from postfeed.schema import PUBLISHED, STAGING, revision_columns

HEAD = (
    "<p><strong>Questa posizione è in ACME</strong><p><br>"
    "<p><strong>Riassunto dell'opportunità da parte della <i>Feed AI</i>:</strong> Un <b>ruolo</b></p><br><br>"
    "<br><p><em>Il processo di selezione sarà interamente gestito da ACME.</em></p>"
    "<br><br><p><em>Questa opportunità è disponibile su Roma</em></p>"
)


@pytest.mark.parametrize(
    "html, expected",
    [
        ('<p class="x">a</p>', "<p>a</p>"),
        ("<span>a</span><br/><BR>", "a<br><BR>"),
        ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
        ("<pre>a</pre><body>b</body><b>c</b>", "ab<b>c</b>"),
        ("<!doctype html>a", "a"),
    ],
)
def test_allow_tags(one, html, expected):
    assert one(markup.allow_tags("v"), v=html) == expected


@pytest.mark.parametrize(
    "html, expected",
    [
        ("<h1 id='a'>T</h1>", "<p><strong>T</strong></p>"),
        ("<ol start=2><li>x</li></ol>", "<ul><li>x</li></ul>"),
        ("<div>a</div><section>b</section>", "<p>a</p><p>b</p>"),
        ("a<script>if (1<2) x()</script><style>p{}</style><!-- <p> -->b", "ab"),
        ("<header>h</header>", "h"),
    ],
)
def test_map_tags(one, html, expected):
    assert one(markup.map_tags("v"), v=html) == expected


@pytest.mark.parametrize(
    "html, expected",
    [
        ('<a href="http://x.y">go</a>', "go"),
        ("see https://x.y/z?q=1 now", "see  now"),
        ("<a>http://x.y</a>more", "more"),
        ("<abbr>a</abbr>", "<abbr>a</abbr>"),
        ("<!-- http://x.y-->kept", "<!-- -->kept"),
    ],
)
def test_remove_links(one, html, expected):
    assert one(markup.remove_links("v"), v=html) == expected


def test_paragraph_breaks(one):
    rule = markup.paragraph_breaks("v")
    assert one(rule, v="<p>a</p><p>b</p> <br>\n<br/> <br><p>c</p>") == "<p>a</p><br><br><p>b</p><br><br><p>c</p>"
    assert one(rule, v="<p>a</p><ul><li>b</li></ul>") == "<p>a</p><ul><li>b</li></ul>"


def test_end_labels(one):
    rule = markup.end_labels("v")
    assert one(rule, v="a [#J-ONE] b [#J-MIN]\n") == "a  b [#J-ONE] [#J-MIN]"
    assert one(rule, v="[#J-ONE]") == "[#J-ONE]"
    assert one(rule, v="a [#J-OTHER] ") == "a [#J-OTHER] "


def test_parts_and_head(spark, one):
    df = spark.createDataFrame([(HEAD + "<p>corpo</p>[#J-ONE]",), ("<p>corpo</p>",), (None,)], "v string")
    first, second, third = [r.p for r in df.select(markup.posting_parts("v").alias("p")).collect()]
    assert first.asDict() == {
        "company": "ACME", "summary": "Un <b>ruolo</b>", "closing_company": "ACME", "places": "Roma",
        "body": "<p>corpo</p>", "labels": ["[#J-ONE]"],
    }
    assert (second.company, second.body, second.labels) == (None, "<p>corpo</p>", [])
    assert third.body is None
    built = one(markup.intro_wrap("c", "s", "l", "b", "Feed AI"), c="ACME", s=" Un <b>ruolo</b>", l="Roma", b="")
    assert built == HEAD


def test_the_default_rewriter_keeps_the_rules_and_is_idempotent(spark):
    texts = [
        HEAD + '<h2>T</h2><div>see <a href="http://x">x</a> http://y.z </div><p>a</p><p>b</p> [#J-ONE] <i>c</i>',
        "<html><body><ol><li>1</li></ol>[#J-MIN] tail</body></html>",
        "plain",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, description string")
    new = rewrite.rewrite_text(df)
    rows = {r.id: r.description for r in new.collect()}
    assert rows[0].startswith(HEAD + "<p><strong>T</strong></p><br><br><p>see x") and rows[0].endswith("<i>c</i> [#J-ONE]")
    again = {r.id: r.description for r in rewrite.rewrite_text(new).collect()}
    assert again == rows
    pairs = df.join(new.withColumnRenamed("description", "improved"), "id")
    checks = reports.conformance_rows(pairs, "description", "improved")
    assert checks.where("NOT conforms").count() == 0
    raw = reports.conformance_rows(df.withColumn("improved", F.col("description")), "description", "improved")
    broken = {r.id: r for r in raw.collect()}
    assert not broken[0].tags_ok and not broken[0].links_ok and not broken[0].breaks_ok and not broken[0].labels_last
    assert broken[2].conforms
    head_needed = reports.conformance_rows(pairs, "description", "improved", head_required=True)
    assert {r.id: r.head_ok for r in head_needed.collect()} == {0: True, 1: False, 2: False}


def test_conformance_finds_lost_text_and_long_summaries(spark):
    before = HEAD + "<p>uno due</p>[#J-ONE]"
    after = HEAD.replace("Un <b>ruolo</b>", "x" * 451) + "<p>uno</p>"
    df = spark.createDataFrame([(1, before, after)], "id int, a string, b string")
    row = reports.conformance_rows(df, "a", "b").first()
    assert (row.text_ok, row.summary_ok, row.labels_ok, row.head_ok) == (False, False, False, True)


def test_plugged_rewriter(spark):
    def factory():
        def improve(text):
            if text == "bad":
                raise RuntimeError("no answer")
            return f"  {text.upper()}\n"

        return improve

    df = spark.createDataFrame([(1, None), (2, ""), (3, "bad"), (4, "good")], "id int, description string")
    got = {r.id: r.description for r in rewrite.rewrite_text(df, factory, workers=3).collect()}
    assert got == {1: None, 2: None, 3: "bad", 4: "GOOD"}


def test_request(one):
    assert one(rewrite.rewrite_request("v", "Do it."), v="text") == "Do it.\n\nJob description originale:\n\ntext"
    assert one(rewrite.rewrite_request("v", "Do it."), v="") is None


def test_label_counts(spark):
    df = spark.createDataFrame([(1, "[#J-ONE][#J-ONE]"), (2, "[#J-ONE] [#J-MIN]"), (3, "")], "id int, t string")
    got = {r.label: (r.postings, r.occurrences) for r in reports.label_counts(df, "t").collect()}
    assert got == {"[#J-ONE]": (2, 3), "[#J-MIN]": (1, 1)}


def test_violations(staging):
    rows = staging(
        {"id": 1},
        {"id": 2, "position": None, "company": "x" * 256},
        {"id": 3, "position": "x" * 256, "jobtype": "y" * 50},
        {"id": 4, "jobtype": "y" * 51, "partner_job_id": "è" * 255},
        {"id": 5, "job_description": "è" * 32_768, "apply_url": "u" * 65_535},
        {"id": 6, "job_description": "x" * 65_535, "apply_url": "u" * 65_536},
    )
    got = sorted((r.id, r.problem) for r in schema_violations(rows).collect())
    assert got == [
        (2, "company: longer than 255"), (2, "position: missing"), (3, "position: longer than 255"),
        (4, "jobtype: longer than 50"), (5, "job_description: longer than 65535 bytes"), (6, "apply_url: longer than 65535 bytes"),
    ]
    assert [r.id for r in rows.where(sink_accepts()).collect()] == [1]


@pytest.mark.parametrize("revision", [1, 2, 3, 4, 5])
def test_revisions(spark, published, revision):
    columns = revision_columns(revision)
    old = published({"id": 1, "description": "d", "partner_job_id": "k", "created_at": NOW}).select(columns)
    new = conform_schema(old)
    assert [(f.name, f.dataType) for f in new.schema] == [(f.name, f.dataType) for f in PUBLISHED]
    row = new.first()
    assert row.description == ("d" if revision >= 2 else None)
    assert row.partner_job_id == ("k" if revision >= 4 else None)
    assert [f.name for f in conform_schema(old, staging=True).schema] == STAGING.names


def test_sync_leaves_nothing_missing(staging, published):
    s = staging(
        {"id": 5, "partner_job_id": "new", "job_description": "<h1>x</h1>"},
        {"id": 6, "partner_job_id": "new", "job_description": ""},
        {"id": 7, "partner_job_id": "kept"},
        {"id": 8, "job_description": "no key"},
        {"id": 9, "partner_job_id": "bad", "position": None},
    )
    p = published({"id": 1, "partner_job_id": "kept"}, {"id": 2, "partner_job_id": "gone"}, {"id": 3})
    result = rewrite.sync(s, p, F.lit(NOW).cast("timestamp_ntz"), rewrite.next_id(p))
    rows = {r.id: r for r in result.collect()}
    assert sorted(rows) == [1, 3, 4, 5, 6]
    assert rows[4].description == "<p><strong>x</strong></p>" and rows[5].description is None
    assert rows[4].created_at == NOW and rows[4].partner_job_id == "new"
    assert [r.partner_job_id for r in missing_keys(s, result).collect()] == ["bad"]
    assert [(r.id, r.reasons) for r in rewrite.rejected_new(s, p).collect()] == [(9, ["position: missing"])]


def test_preview_shows_the_first_row_in_full(staging):
    rows = staging(*[{"id": i, "job_description": "x" * 900} for i in range(1, 13)])
    shown = {r.id: r for r in rewrite.preview_pairs(rows).collect()}
    assert len(shown) == 10 and len(shown[1].original) == 900
    assert shown[2].improved == "x" * 800 + "... [troncato]" and shown[2].company == "N/A"


@pytest.mark.parametrize(
    "html, expected",
    [
        ("a<br><br><br><br>b", "a<br><br>b"),
        ("a<br>b", "a<br>b"),
        ("<p>a</p><br><BR/><br >text", "<p>a</p><br><br>text"),
        ("<p>a</p> <br>text", "<p>a</p> <br><br>text"),
        ("text<br> <p>a</p>", "text<br><br> <p>a</p>"),
        ("<p>a</p><p>b</p>", "<p>a</p><br><br><p>b</p>"),
    ],
)
def test_every_run_of_breaks(one, html, expected):
    assert one(markup.paragraph_breaks("v"), v=html) == expected
    assert one(markup.paragraph_breaks("v"), v=expected) == expected
    assert one(markup.breaks_ok("v"), v=expected)
    assert one(markup.breaks_ok("v"), v=html) == (html == expected)


@pytest.mark.parametrize(
    "html, expected",
    [
        ("a<script>b", "a<script>b"),
        ("<!-- <script> --> x </script> <script>y</script>z<!-- open", " x </script> z<!-- open"),
        ("<STYLE a>p</Style ><script>1<!--</script>-->", "-->"),
    ],
)
def test_hidden_parts_that_stay_open(one, html, expected):
    assert one(markup.drop_hidden("v"), v=html) == expected


def test_a_text_that_formatting_makes_too_long_stays_as_given(staging, published):
    text = "<h1>" * 10_000
    loaded = rewrite.load_new(staging({"id": 1, "job_description": text}), published(), F.lit("2024-01-08").cast("timestamp_ntz"), 1)
    assert loaded.first().description == text


def test_no_text_ends_or_stops_a_job(spark, tmp_path, staging, published):
    """Long runs of what once took the stack or squared time, read from files, through every rule."""
    parts = ["<br>", "<script>", "<!--", "<style>", "Questa opportunità è disponibile su ", "Riassunto dell'opportunità da parte della <i>"]
    texts = [part * (800_000 // len(part)) for part in parts] + ["<script>" * 50_000 + "-->" + "<!--" * 50_000 + "</script"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    df.write.parquet(f"{tmp_path}/rows")
    given = spark.read.schema(df.schema).parquet(f"{tmp_path}/rows")
    started = time.monotonic()
    rewrite.rewrite_text(given, column="t").write.parquet(f"{tmp_path}/new")
    new = spark.read.schema(df.schema).parquet(f"{tmp_path}/new")
    assert new.where("t IS NOT NULL").count() == len(texts)
    pairs = given.withColumnRenamed("t", "before").join(new.withColumnRenamed("t", "after"), "id")
    assert {r.breaks_ok for r in reports.conformance_rows(pairs, "before", "after").collect()} == {True}
    assert given.select(markup.posting_parts("t").alias("p")).where("p.company IS NULL").count() == len(texts)
    assert time.monotonic() - started < 2 * 3 * len(texts) + 20
    breaks = staging({"id": 1, "job_description": "<br>" * 16_000}, {"id": 2, "job_description": "</p>" + "<br>" * 16_000})
    loaded = rewrite.load_new(breaks, published(), F.lit(NOW.isoformat(sep=" ")).cast("timestamp_ntz"), 1)
    assert sorted(r.description for r in loaded.collect()) == ["</p><br><br>", "<br><br>"]


def balanced(text):
    """Tag by tag, with a list as the stack."""
    out, stack = [], []

    def close_to(i):
        while len(stack) > i:
            out.append(f"</{stack.pop()}>")

    for token in re.findall(r"(?i)</?(?:b|strong|u|i|br|p|ul|li|em)>|[^<]+|<", text):
        m = re.fullmatch(r"(?i)<(/?)(b|strong|u|i|p|ul|li|em)>", token)
        if not m:
            out.append(token)
            continue
        name = m[2].lower()
        at = max((i for i, n in enumerate(stack) if n == name), default=None)
        if m[1]:
            if at is not None:
                close_to(at)
            continue
        if name == "p" and at is not None:
            close_to(at)
        if name == "li":
            group = max((i for i, n in enumerate(stack) if n == "ul"), default=-1)
            if at is not None and at > group:
                close_to(at)
            if "ul" not in stack:
                stack.append("ul")
                out.append("<ul>")
        stack.append(name)
        out.append(f"<{name}>")
    close_to(0)
    return "".join(out)


def test_tags_are_balanced(spark):
    rng = random.Random(7)
    bits = ["<p>", "</p>", "<ul>", "</ul>", "<li>", "</li>", "<b>", "</b>", "<i>", "</I>", "<EM>", "</em>", "<br>", "text", " < ", "è", "<u>", "</strong>"]
    texts = ["".join(rng.choices(bits, k=rng.randrange(25))) for _ in range(300)] + ["", None, "<li>a<li>b", "<p>a<p>b", "</p></p>x", "<ul><li>a<ul><li>b</ul>c"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    got = df.select("id", "t", markup.balance_tags("t").alias("b"), markup.tags_balanced("t").alias("was")).collect()
    for r in got:
        want = None if r.t is None else balanced(r.t)
        assert r.b == want and r.was == (None if r.t is None else want == r.t), r.t
    again = df.select("id", markup.balance_tags(markup.balance_tags("t")).alias("b"))
    assert {r.id: r.b for r in again.collect()} == {r.id: r.b for r in got}
    shown = dict(zip(texts[-4:], [r.b for r in got][-4:]))
    assert shown["<li>a<li>b"] == "<ul><li>a</li><li>b</li></ul>" and shown["<p>a<p>b"] == "<p>a</p><p>b</p>" and shown["</p></p>x"] == "x"
