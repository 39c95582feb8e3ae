"""The partner feed: one XML document in text parts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postfeed.functions.feedxml import JOB_CHILDREN, feed_head, feed_tail, job_element
from postfeed.functions.text import rfc_date
from postfeed.operators import rowdigest
from postfeed.session import materialise, path_exists
from postfeed.sources.tables import latest_build

HEAD, JOBS, TAIL = 0, 1, 2
_FOLDERS = {HEAD: "0-head", JOBS: "1-jobs", TAIL: "2-tail"}
FEED_JOB = T.StructType([T.StructField(tag, T.StringType()) for tag, _, _ in JOB_CHILDREN])


def feed_build_date(df: DataFrame, now: datetime) -> DataFrame:
    """One row, ``build_date``: the latest build date of the postings, else ``now`` (UTC)."""
    found = rfc_date("last_build_date", "-0000")
    default = rfc_date(F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz"), "+0000")
    return latest_build(df).select(F.coalesce(found, default).alias("build_date"))


def feed_rows(df: DataFrame) -> DataFrame:
    """``id`` and the ``<job>`` element of each posting."""
    return df.select("id", job_element().alias("xml"))


def feed_lines(df: DataFrame, now: datetime) -> DataFrame:
    """The whole feed: ``section`` (head, jobs, tail), ``id`` for jobs, and ``xml``.

    The document is the ``xml`` values in order of section and id.
    """
    spark = df.sparkSession
    no_id = F.lit(None).cast("bigint").alias("id")
    head = feed_build_date(df, now).select(F.lit(HEAD).alias("section"), no_id, feed_head(F.col("build_date")).alias("xml"))
    jobs = feed_rows(df).select(F.lit(JOBS).alias("section"), "id", "xml")
    tail = spark.range(1).select(F.lit(TAIL).alias("section"), no_id, feed_tail().alias("xml"))
    return head.unionAll(jobs).unionAll(tail)


def write_feed(df: DataFrame, path: str, now: datetime, ordered: bool = True, **options: str) -> None:
    """Write the feed below ``path``: its parts in path order are the document.

    Jobs are in order of id: the raw columns are range-partitioned first and rendered after, as rendered
    text is larger and sampling the ranges would render it twice. Without ``ordered`` nothing is shuffled and
    jobs stand as they are scanned, which is not the order of the table's files.
    """
    spark = df.sparkSession
    head = feed_build_date(df, now).select(feed_head(F.col("build_date")))
    tail = spark.range(1).select(feed_tail())
    jobs = df
    if ordered:
        shown = ["id", "partner_job_id", *dict.fromkeys(c for _, c, _ in JOB_CHILDREN if c != "feed_key")]
        jobs = df.select(*shown).repartitionByRange("id").sortWithinPartitions("id")
    for section, part in ((HEAD, head), (JOBS, feed_rows(jobs).select("xml")), (TAIL, tail)):
        part.write.mode("overwrite").options(**options).text(f"{path}/{_FOLDERS[section]}")


def feed_order(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """``place`` in the document, from 1, and ``found``, what the pattern's group matches once in each job.

    Parts are read whole, in the order of their names; only their sizes meet in one task.
    """
    parts = spark.read.text(f"{path}/{_FOLDERS[JOBS]}", wholetext=True)
    found = parts.select(F.col("_metadata.file_name").alias("part"), F.posexplode(F.regexp_extract_all("value", F.lit(pattern), F.lit(1))).alias("pos", "found"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    sizes = found.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return found.join(starts, "part").select((F.col("start") + F.col("pos") + 1).alias("place"), "found")


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """The jobs of a written feed, one text column per child element."""
    jobs = (
        spark.read.format("xml")
        .option("rowTag", "job")
        # A part holds many jobs and no root element, which only this parser reads to the end.
        .option("useLegacyXMLParser", "true")
        .option("ignoreSurroundingSpaces", "false")
        .schema(FEED_JOB)
        .load(f"{path}/{_FOLDERS[JOBS]}")
    )
    return jobs.select(*job_values())


def job_values(parent: str = "") -> list[Column]:
    """The text of each child of a job, as read from XML."""
    # An empty element and the gap before a CDATA section are markup, not part of the value.
    values = []
    for tag, _, gap in JOB_CHILDREN:
        text = F.coalesce(f"{parent}{tag}", F.lit(""))
        values.append((F.regexp_replace(text, f"^{gap}", "") if gap else text).alias(tag))
    return values


# Ids whose jobs are one part of a feed that is kept up to date.
RANGE_IDS = 100_000


def refresh_feed(df: DataFrame, path: str, now: datetime, range_ids: int = RANGE_IDS) -> int:
    """Bring the feed below ``path`` up to date and return how many ranges of ids were rendered.

    Jobs stand in order of id in one part for each ``range_ids`` ids. A digest of what is shown of a range is kept
    with the feed; only ranges whose digest has changed are rendered and replaced, those without rows are removed.
    The digests are written last: a run that broke off is done again by the next one. Ids are not negative. The document
    is ``0-head``, ``1-jobs`` and ``2-tail``, each in path order.
    """
    spark = df.sparkSession
    shown = ["id", "partner_job_id", *dict.fromkeys(c for _, c, _ in JOB_CHILDREN if c != "feed_key")]
    rows = df.select(*shown).withColumn("range", F.lpad(F.expr(f"id div {int(range_ids)}").cast("string"), 15, "0"))
    digests = materialise(rowdigest.digests(rows.drop("range"), columns=shown, bucket=F.lpad(F.expr(f"id div {int(range_ids)}").cast("string"), 15, "0")), "feed-digests")
    kept = f"{path}/_digests"
    before = spark.read.schema(digests.schema).parquet(kept) if path_exists(spark, f"{kept}/_SUCCESS") else digests.limit(0)
    changed = materialise(rowdigest.differing_buckets(digests, before).select(F.col("bucket").alias("range")), "changed-ranges")
    gone = [r.range for r in changed.join(digests, F.col("range") == F.col("bucket"), "left_anti").collect()]
    jobs = rows.join(changed, "range", "left_semi").repartition("range").sortWithinPartitions("range", "id")
    jobs = jobs.select("range", job_element().alias("xml"))
    out = jobs.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("range")
    out.text(f"{path}/{_FOLDERS[JOBS]}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    for name in gone:
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{_FOLDERS[JOBS]}/range={name}"), True)
    head = feed_build_date(df, now).select(feed_head(F.col("build_date")))
    for section, part in ((HEAD, head), (TAIL, spark.range(1).select(feed_tail()))):
        part.write.mode("overwrite").text(f"{path}/{_FOLDERS[section]}")
    digests.write.mode("overwrite").parquet(kept)
    return changed.count() - len(gone)
