"""Reading feed documents of any size, with broken jobs set aside.

A document is read in splits, cut at every ``</job>``. Most pieces hold one job and are parsed where they lie. Two kinds
need their neighbours: where the closing tag stands inside a CDATA section, pieces belong together, and what comes
after the last tag is no job. These are found from the lengths and the last CDATA mark of every piece.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postfeed.session import materialise
from postfeed.sources.feed import FEED_JOB, job_values

OPEN, CLOSE = "<job>", "</job>"
_BAD = "malformed"


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """Text between closing tags, with its file, split and place in the scan. Two scans give the same places."""
    text = spark.read.option("lineSep", CLOSE).option("recursiveFileLookup", "true").text(path)
    return text.select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"), F.monotonically_increasing_id().alias("at"),
    )


def _open_after() -> Column:
    """Whether the piece ends inside a CDATA section; null if it has no mark and so ends as it began."""
    whole = F.length("value")
    begun, ended = (F.length(F.substring_index("value", mark, -1)) for mark in ("<![CDATA[", "]]>"))
    return F.when((begun == whole) & (ended == whole), F.lit(None)).otherwise(begun < ended)


def _places(pieces: DataFrame) -> DataFrame:
    """Per piece: ``offset`` of its first byte, ``head``, the offset at which its job's pieces begin, and what is special.

    Windows see the pieces of one split, without their text, and the splits of one file.
    """
    narrow = materialise(pieces.select("file", "block", "size", "at", F.octet_length("value").cast("long").alias("bytes"), _open_after().alias("open")), "pieces")
    split = W.partitionBy("file", "block").orderBy("at")
    earlier, so_far = split.rowsBetween(W.unboundedPreceding, -1), split.rowsBetween(W.unboundedPreceding, 0)
    splits = narrow.groupBy("file", "block").agg(F.sum(F.col("bytes") + len(CLOSE)).alias("length"), F.max_by("open", F.when(F.col("open").isNotNull(), F.col("at"))).alias("last"))
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    starts = splits.select("file", "block", F.coalesce(F.sum("length").over(before), F.lit(0)).alias("start"), F.coalesce(F.last("last", True).over(before), F.lit(False)).alias("carried"))
    placed = narrow.join(starts, ["file", "block"]).withColumns({
        "offset": F.col("start") + F.coalesce(F.sum(F.col("bytes") + len(CLOSE)).over(earlier), F.lit(0)),
        "inside": F.coalesce(F.last("open", True).over(earlier), "carried"),
        "inside_after": F.coalesce(F.last("open", True).over(so_far), "carried"),
    })
    placed = placed.withColumn("own", F.when(~F.col("inside"), F.col("offset")))
    heads = placed.groupBy("file", "block").agg(F.max("own").alias("own"))
    heads = heads.select("file", "block", F.last("own", True).over(before).alias("head_before"))
    return placed.join(heads, ["file", "block"]).select(
        "file", "at", "offset", F.coalesce(F.last("own", True).over(so_far), "head_before", "offset").alias("head"),
        (F.col("offset") + F.col("bytes") == F.col("size")).alias("unended"), (F.col("inside") | F.col("inside_after")).alias("joined"))


def _parsed(text: Column) -> Column:
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD, "ignoreSurroundingSpaces": "false"}
    return F.from_xml(text, T.StructType([*FEED_JOB, T.StructField(_BAD, T.StringType())]).simpleString(), options)


def read_document(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The jobs of all documents below ``path``, one text column per child, and what was set aside.

    A document is one file with one root, or a part of one. Set aside are ``file``, ``offset`` and ``text`` of every
    piece up to a closing tag that is no well-formed job, and of a job that the file ends in. If such a piece
    holds a further opening tag from which on it is well-formed, that job is read and only the rest is set aside. A
    closing tag inside a CDATA section is text. Tags of jobs have no attributes and no white space.
    """
    pieces = _pieces(spark, path)
    places = materialise(_places(pieces), "places")
    special = materialise(places.where("joined OR unended"), "special-pieces")
    # Special pieces are few: an end for each file and what has a closing tag in its text.
    plain = pieces.join(special.select("at"), "at", "left_anti").select("file", "at", "value", F.lit(False).alias("unended"))
    met = pieces.select("at", "value").join(special, "at").groupBy("file", "head").agg(
        F.sort_array(F.collect_list(F.struct("offset", "value", "at", "unended"))).alias("parts"))
    merged = met.select("file", F.col("parts")[0]["at"].alias("at"), F.array_join(F.transform("parts", lambda p: p["value"]), CLOSE).alias("value"), F.element_at("parts", -1)["unended"].alias("unended"))
    # What follows the last job is no job.
    texts = plain.unionByName(merged).where(~F.col("unended") | F.contains("value", F.lit(OPEN)))
    opened = F.instr("value", OPEN)
    first = F.when((opened > 0) & ~F.col("unended"), F.concat(F.expr("substring(value, instr(value, '<job>'))"), F.lit(CLOSE)))
    tried = texts.withColumn("job", _parsed(first))
    good = F.col("job").isNotNull() & F.col(f"job.{_BAD}").isNull()
    bad = tried.where(~good).drop("job")
    # The text after the last opening tag may be a job that a broken one stands before.
    rest = F.substring_index("value", OPEN, -1)
    again = F.when((F.length("value") - F.length(F.replace(F.col("value"), F.lit(OPEN), F.lit(""))) > len(OPEN)) & ~F.col("unended"), F.concat(F.lit(OPEN), rest, F.lit(CLOSE)))
    bad = materialise(bad.withColumn("job", _parsed(again)), "broken-jobs")
    jobs = tried.where(good).select(*job_values("job.")).unionByName(bad.where(good).select(*job_values("job.")))
    cut = F.when(good, F.expr("left(value, length(value) - length(substring_index(value, '<job>', -1)) - 5)")).otherwise(F.col("value"))
    aside = bad.select("at", cut.alias("text")).join(places.select("file", "at", "offset"), "at").select("file", "offset", "text")
    return jobs, aside
