"""Exact duplicates by distributed most-significant-digit radix partitioning."""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postfeed.llm.common import few, slices, written

# Bytes of the first digit, and how many times longer each next digit is.
FIRST_DIGIT = 64
DIGIT_GROWTH = 32

# Stands for a null id, which is smaller than any other.
NO_ID = -(1 << 63)

# Text bytes of one task after which it forgets what it has seen; the radix levels join the parts again.
LOCAL_BYTES = 64 << 20

_LOCAL = "row long, doc_id long, head long, sha binary, text binary, n long, best long, best_row long"


def normalised(text: str | None) -> bytes:
    """The text with A-Z lower-cased, as UTF-8; null is empty."""
    return (text or "").encode("utf-8", "surrogatepass").lower()


def _folded(rows, texts, count, best):
    """The task's rows as a batch; the first row of a text, its head, carries the text and the sums."""
    table = [
        (row, doc_id, head, sha, *((texts[head], count[head], best[head][1] if best[head][0] else None, best[head][2]) if head == row else (None,) * 4))
        for row, doc_id, head, sha in rows
    ]
    long, binary = pa.int64(), pa.binary()
    names = ["row", "doc_id", "head", "sha", "text", "n", "best", "best_row"]
    kinds = [long, long, long, binary, binary, long, long, long]
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*table), kinds)], names=names)


def _fold(batches):
    """Folds the equal texts that one task reads."""
    rows, heads, texts, count, best, size = [], {}, {}, {}, {}, 0
    for part in slices(batches):
        for text, doc_id, row in zip(*(part.column(i).to_pylist() for i in range(3))):
            key = normalised(text)
            head = heads.setdefault(key, row)
            if head == row:
                texts[head], count[head], best[head] = key, 0, (False, 0, -1)
                size += len(key)
            count[head] += 1
            best[head] = max(best[head], (doc_id is not None, doc_id or 0, row))
            rows.append((row, doc_id, head, hashlib.sha256(key).digest()))
        if size > LOCAL_BYTES:
            yield _folded(rows, texts, count, best)
            rows, heads, texts, count, best, size = [], {}, {}, {}, {}, 0
    if rows:
        yield _folded(rows, texts, count, best)


def exact_duplicates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """One row per row of ``documents``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are identical after lower-casing A-Z; null counts as empty. The row with
    the largest id stays. A null id is smaller than any other, and of several rows with the largest id
    one stays. An empty table gives an empty result; other columns are not looked at. ``row_col`` names a
    column of unique longs that comes first in the result, to find the rows again.

    Every task first folds the equal texts it reads, so a text sends one row per task however often it
    occurs. The heads are split by their first bytes, and those that are not alone by ever longer
    digits, until a group has one row or has ended. Only bytes decide; the digest is a result column.
    """
    source = documents.select(F.col(text_col).cast("string").alias("text"), F.col(id_col).cast("long").alias("doc_id"), (F.monotonically_increasing_id() if row_col is None else F.col(row_col)).alias("row"))
    keep = [] if row_col is None else [F.col("row").alias(row_col)]
    rows = written(source.mapInArrow(_fold, _LOCAL), "fold")
    heads = rows.where("n IS NOT NULL").select("head", "text", "n", "best", "best_row")

    digit = F.substring("text", 1, FIRST_DIGIT).alias("digit")
    state = heads.select("head", F.lit(0).cast("long").alias("gid"), digit, "n", "best", "best_row")
    width, done, rest, key = FIRST_DIGIT, [], [], ["gid", "digit", "ended"]
    while True:
        ended = state.withColumn("ended", F.length("digit") < width)
        # Counted before the shuffle as well; a digit that many heads share is a key of a join that Spark may split.
        groups = ended.groupBy(*key).agg(
            F.count(F.lit(1)).alias("g_rows"), F.sum("n").alias("g_n"), F.min("head").alias("g_id"), F.max("best").alias("g_best"),
            F.max_by("best_row", F.coalesce("best", F.lit(NO_ID))).alias("g_row"),
        )
        split = ended.join(groups, key).withColumn("settled", F.expr("ended OR g_rows = 1"))
        split = written(few(split.drop(*key, "g_rows")), "radix")
        # Groups of one head, or whose texts have ended, are settled.
        done.append(split.where("settled").select("head", F.col("g_n").alias("group_size"), "g_best", "g_row"))
        left = split.where("NOT settled")
        if left.isEmpty():
            break
        if not rest:
            # Only now the texts of heads that are not alone are fetched.
            rest = [heads.select("head", F.expr(f"substring(text, {width + 1})").alias("rest"))]
            left = left.join(rest[0], "head")
        width *= DIGIT_GROWTH
        digit, after = F.expr(f"substring(rest, 1, {width})"), F.expr(f"substring(rest, {width + 1})")
        state = left.select("head", F.col("g_id").alias("gid"), digit.alias("digit"), after.alias("rest"), "n", "best", "best_row")
    groups = reduce(DataFrame.unionAll, done)
    joined = rows.select("row", "doc_id", "head", "sha").join(groups, "head")
    return joined.select(
        *keep, "doc_id", F.col("g_best").alias("keep_id"), "group_size",
        (F.col("row") == F.col("g_row")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"),
    )
