"""Postings, texts and requests derived from the given tables.

Every view keeps all rows of its tables. The text runs unchanged in Spark and in the checking
engine; ``{orders}`` and the like stand for the tables. One key owns a fifth of the staging
rows, another a fifth of the published ones, and blank keys a tenth of both.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postfeed.session import scratch_path, spread

RUN_TS = datetime(2024, 1, 8, 11, 34, 23)
BRAND = "Feed AI"
INSTRUCTION = "Format the posting below. Keep its language and its text."

# Rows for which a file of a stream's source is worth while.
FILE_ROWS = 1000

TABLES = ["orders", "customer", "documents", "pages", "events"]

_POSTING_HEAD = (
    "concat('<p><strong>Questa posizione è in ', {name}, '</strong><p><br>',"
    " '<p><strong>Riassunto dell''opportunità da parte della <i>Feed AI</i>:</strong> Un ruolo per <b>', {name}, '</b>.',"
    " '</p><br><br>', '<br><p><em>Il processo di selezione sarà interamente gestito da ', {name}, '.</em></p>',"
    " '<br><br><p><em>Questa opportunità è disponibile su Roma, Milano</em></p>')"
)

_ORDER_TEXT = f"""
  CASE WHEN o_orderkey % 1009 = 0 THEN repeat('è', 33000) WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderkey % 23 = 0 THEN ''
       ELSE concat(
         CASE WHEN o_orderstatus = 'P' THEN {_POSTING_HEAD.format(name="o_orderpriority")} ELSE '' END,
         '  <h2>', o_orderpriority, '</h2><div class="x">Offer ', CAST(o_orderkey AS STRING),
         ' [#J-ONE] see <A href="https://jobs.example.com/', CAST(o_custkey AS STRING),
         '">details</A> or https://jobs.example.com/all now</div><ol><li>one</li></ol><p>a</p> <br/> <p>b</p>',
         CASE WHEN o_orderkey % 5 = 0 THEN '[#J-REMOTE] [#J-MIN]' ELSE '  ' END) END"""


def _order_postings(position: str, text: str, keys: str) -> str:
    return f"""
SELECT o_orderkey AS id,
  {position} AS position,
  {_ORDER_TEXT} AS {text},
  CASE WHEN o_custkey % 11 = 0 THEN NULL
       ELSE concat('Customer ', lpad(CAST(o_custkey AS STRING), 9, '0'),
                   CASE WHEN o_orderkey % 97 = 0 THEN repeat(' and sons', 40) WHEN o_custkey % 3 = 0 THEN ' Ltd.' ELSE '' END)
       END AS company,
  concat('https://jobs.example.com/', CAST(o_orderkey AS STRING)) AS apply_url,
  CAST(o_custkey AS STRING) AS company_id,
  CASE o_orderstatus WHEN 'F' THEN 'Roma' WHEN 'O' THEN 'Milano' ELSE '' END AS location,
  CASE o_orderstatus WHEN 'F' THEN 'On-site' WHEN 'O' THEN 'Remote' ELSE NULL END AS workplace_types,
  CASE WHEN o_orderkey % 89 = 0 THEN repeat('senior ', 9) ELSE 'Internship' END AS experience_level,
  'Full Time' AS jobtype,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 17 = 0 THEN ''
       {keys} ELSE concat('pj', CAST(o_custkey AS STRING)) END AS partner_job_id,
  o_orderdate AS last_build_date,
  CASE WHEN o_orderkey % 14 = 0 THEN NULL ELSE o_orderdate END AS created_at,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderdate END AS updated_at
FROM {{orders}}"""


_LONG_POSITION = (
    "CASE WHEN o_orderstatus = 'O' THEN concat(o_orderpriority, ' planner for regional routes and depots')"
    " ELSE o_orderpriority END"
)

VIEWS = {
    "staging": _order_postings(
        f"CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE {_LONG_POSITION} END",
        "job_description",
        "WHEN o_orderpriority = '1-URGENT' THEN 'agency-1' WHEN o_orderpriority = '2-HIGH' THEN 'agency-2'"
        " WHEN o_custkey % 4 = 0 THEN concat('up', CAST(o_custkey AS STRING))",
    ),
    "published": _order_postings(
        _LONG_POSITION,
        "description",
        "WHEN o_orderpriority = '1-URGENT' THEN 'agency-1' WHEN o_orderpriority = '2-HIGH' THEN 'agency-3'"
        " WHEN o_custkey % 5 = 0 THEN concat('old', CAST(o_custkey AS STRING))",
    ),
    # Documents as published postings. The marks are what a feed must not pass on as they are.
    "doc_postings": """
SELECT d.doc_id AS id, concat(d.source, ' ', d.lang) AS position,
  concat(d.text,
         CASE WHEN d.doc_id % 5 = 0 THEN concat(']]', chr(1), '>') ELSE '' END,
         CASE WHEN d.doc_id % 7 = 0 THEN concat(chr(11), chr(127), chr(9)) ELSE '' END) AS description,
  c.c_name AS company, concat('https://jobs.example.com/?a=1&b=', CAST(d.doc_id AS STRING)) AS apply_url,
  CAST(c.c_nationkey AS STRING) AS company_id, c.c_mktsegment AS location,
  CASE WHEN d.doc_id % 3 = 0 THEN NULL ELSE 'Remote' END AS workplace_types,
  o.o_orderpriority AS experience_level, '' AS jobtype,
  CASE WHEN d.doc_id % 13 = 0 THEN NULL WHEN d.doc_id % 17 = 0 THEN ''
       ELSE concat('pj', CAST(o.o_custkey AS STRING)) END AS partner_job_id,
  o.o_orderdate AS last_build_date, o.o_orderdate AS created_at, o.o_orderdate AS updated_at
FROM {documents} d
LEFT JOIN {orders} o ON o.o_orderkey = d.doc_id
LEFT JOIN {customer} c ON c.c_custkey = d.doc_id""",
    # Pages as posting texts, with labels, bare addresses and, for some, the fixed head.
    "page_postings": f"""
SELECT page_id AS id, url, split_part(url, '/', 3) AS company,
  CASE WHEN page_id % 41 = 40 THEN ''
       ELSE concat(
         CASE WHEN page_id % 4 = 0 THEN {_POSTING_HEAD.format(name="split_part(url, '/', 3)")} ELSE '' END,
         replace(html, '</article>',
                 concat('<ol><li>See ', url, ' now</li></ol><p>x</p> <br> <br/><p>y</p></article>')),
         CASE page_id % 8 WHEN 3 THEN 'a<br><BR/><br ><br>b<br>c' WHEN 4 THEN '<p>d</p><br><br> <br>e' WHEN 5 THEN 'f<br><p>g</p>'
              WHEN 6 THEN '<p>h</p> <br>i' WHEN 7 THEN '<p>j</p><br><br><p>k</p>' ELSE '' END,
         CASE page_id % 3 WHEN 0 THEN ' [#J-REMOTE] [#J-MCITY]' WHEN 1 THEN '[#J-ONE]<p>last</p>' ELSE '' END) END AS html
FROM {{pages}}""",
    "requests": """
SELECT event_id, ts, user_id,
  CASE WHEN event_type = 'error' THEN ' 8.0.8.7 , 10.0.0.1'
       WHEN event_id % 5 = 0 THEN concat(CASE WHEN user_id % 9 = 0 THEN '9.' ELSE '8.' END,
            CAST(CAST((user_id - user_id % 256) / 256 AS BIGINT) AS STRING), '.', CAST(user_id % 256 AS STRING), '.7, 10.1.1.1')
       WHEN event_id % 5 = 1 THEN '' WHEN event_id % 5 = 2 THEN ', 1.2.3.4' ELSE NULL END AS x_forwarded_for,
  CASE WHEN event_id % 3 = 0 THEN concat('172.', CAST(event_id % 40 AS STRING), '.1.9') ELSE NULL END AS x_real_ip,
  CASE event_id % 4 WHEN 0 THEN concat('192.168.0.', CAST(user_id % 200 AS STRING)) WHEN 1 THEN '::1'
       WHEN 2 THEN '172.x.1.1' ELSE NULL END AS peer_ip,
  CASE event_id % 8
    WHEN 0 THEN 'Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) Chrome/120.0.1 Safari/537.36'
    WHEN 1 THEN 'Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) Version/17.0 Safari/605.1'
    WHEN 2 THEN 'Mozilla/5.0 (Windows NT 10.0) Firefox/121.0'
    WHEN 3 THEN 'Mozilla/5.0 (X11; Linux x86_64) Chrome/119.0 Safari/537.36'
    WHEN 4 THEN 'curl/8.0' WHEN 5 THEN 'Chrome/1' WHEN 6 THEN '' ELSE NULL END AS user_agent,
  CASE event_type WHEN 'error' THEN 500 ELSE 200 END AS status_code,
  CASE event_type WHEN 'purchase' THEN 'POST' ELSE 'GET' END AS method,
  concat('/', event_type) AS url_path, 'https' AS url_scheme,
  CASE WHEN user_id % 10 = 0 THEN NULL ELSE 'feed.example.com' END AS url_domain,
  CASE WHEN event_id % 3 = 1 THEN 'http://localhost:3000' ELSE NULL END AS origin,
  CASE event_id % 5 WHEN 3 THEN concat('Bearer ', CAST(user_id AS STRING)) WHEN 4 THEN '' ELSE NULL END AS authorization,
  1704067200000000000 + event_id * 1000000007 AS started_ns,
  1704067200000000000 + event_id * 1000000007 + user_id * 12345678 + event_id AS ended_ns
FROM {events}""",
    "geo_dim": """
SELECT concat('8.', CAST(CAST((user_id - user_id % 256) / 256 AS BIGINT) AS STRING), '.', CAST(user_id % 256 AS STRING), '.7') AS ip,
  CASE WHEN user_id % 11 = 0 THEN FALSE WHEN user_id % 7 = 0 THEN NULL ELSE TRUE END AS success,
  concat('R', CAST(user_id % 20 AS STRING)) AS region_code, 'Europe' AS continent,
  CASE WHEN user_id % 6 = 0 THEN NULL ELSE concat('City ', CAST(user_id AS STRING)) END AS city,
  'IT' AS country_code, 'Italy' AS country, concat('Region ', CAST(user_id % 20 AS STRING)) AS region,
  CASE WHEN user_id % 5 = 0 THEN NULL ELSE CAST(user_id AS DOUBLE) / 2 END AS latitude,
  CASE WHEN user_id % 8 = 0 THEN NULL ELSE CAST(user_id AS DOUBLE) / 4 END AS longitude
FROM (SELECT DISTINCT user_id FROM {events}) e""",
    # Rows published per day, added up over the days of a month: one run per month.
    "samples": """
SELECT CAST(run_id AS STRING) AS run_id, sampled_at,
  CAST(sum(n) OVER (PARTITION BY run_id ORDER BY sampled_at) AS BIGINT) AS processed
FROM (SELECT extract(YEAR FROM o_orderdate) * 100 + extract(MONTH FROM o_orderdate) AS run_id,
             o_orderdate AS sampled_at, count(*) AS n
      FROM {orders} GROUP BY o_orderdate) days""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str, key: str, batches: int = 3) -> DataFrame:
    """The table as a stream of ``batches`` micro-batches: files of rising ranges of ``key``, one range after the other.

    A range is dealt out over as many files as there are cores, so its scan passes over the others' row groups and
    no task writes it alone. Every range has rows enough for that, or the stream has less files.
    """
    rows, folder = table(spark, sf_dir, name), scratch_path(spark, f"arriving-{name}")
    low, high, n = rows.agg(F.min(key), F.max(key), F.count(F.lit(1))).first()
    step = (high - low) // batches + 1
    files = max(1, min(spark.sparkContext.defaultParallelism, n // (batches * FILE_ROWS)))
    for i in range(batches):
        part = rows.where(F.col(key).between(low + i * step, low + (i + 1) * step - 1))
        part.repartition(files).write.mode("append").parquet(folder)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(folder)


def _from(view: str, tables: dict[str, DataFrame], spark: SparkSession) -> DataFrame:
    return _with_headers(view, spark.sql(VIEWS[view], **tables))


def _with_headers(view: str, df: DataFrame) -> DataFrame:
    """Requests also carry a header map; its key spelling varies as on the wire."""
    if view != "requests":
        return df
    headers = F.create_map(
        F.lit("Content-Type"),
        F.lit("application/xml"),
        F.lit("Access-Control-Allow-Origin"),
        F.col("origin"),
        F.lit("ACCESS-CONTROL-ALLOW-CREDENTIALS"),
        F.when(F.col("method") == "POST", F.lit("true")),
        F.lit("access-control-allow-methods"),
        F.concat(F.col("method"), F.lit(", OPTIONS")),
    )
    return df.withColumn("response_headers", F.map_filter(headers, lambda _, value: value.isNotNull()))


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    used = [t for t in TABLES if "{" + t + "}" in VIEWS[name]]
    return _from(name, {t: spread(table(spark, sf_dir, t)) for t in used}, spark)


def view_stream(spark: SparkSession, sf_dir: str, name: str, source: str, key: str) -> DataFrame:
    """A view over one table read as a stream of a few batches."""
    return _from(name, {source: table_stream(spark, sf_dir, source, key)}, spark)


def view_sql(name: str) -> str:
    return VIEWS[name].format(**{t: t for t in TABLES})
