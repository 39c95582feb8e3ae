"""Whether a written table has the rows it should have, and which rows differ if not.

A row has a 128-bit digest, a bucket of keys the sums of its rows' digests. Sums do not depend on the order of
rows, and what was meant to be written is a sum too: the former rows, less those removed, plus those added. So a
lost, added, repeated or changed row is found by comparing a few thousand sums, and only the rows of buckets that
differ are compared one by one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096

# Sums of 32-bit words: 2 ** 31 rows of a bucket cannot overflow them.
WORDS = ("w0", "w1", "w2", "w3")


def row_hashes(columns: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes of the values; which of them are null counts too."""
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    return [F.xxhash64(F.lit(seed), nulls, *columns) for seed in (0, 1)]


def key_bucket(key: str, buckets: int = BUCKETS) -> Column:
    """Rows without a key are dealt out by null, as one bucket."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def digests(df: DataFrame, key: str = "id", columns: Sequence[str] | None = None, buckets: int = BUCKETS, sign: int = 1, bucket: Column | None = None) -> DataFrame:
    """Per bucket of keys, or per value of ``bucket``: rows and the sums of their digests, added up before the shuffle."""
    first, second = row_hashes(sorted(columns or df.columns))
    words = df.select((key_bucket(key, buckets) if bucket is None else bucket).alias("bucket"), first.alias("a"), second.alias("b"))
    parts = [F.shiftrightunsigned("a", 32), F.col("a").bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned("b", 32), F.col("b").bitwiseAND(0xFFFFFFFF)]
    return words.groupBy("bucket").agg((F.count(F.lit(1)) * sign).alias("n"), *[(F.sum(p) * sign).alias(w) for w, p in zip(WORDS, parts)])


def added_up(*parts: DataFrame) -> DataFrame:
    """Digests of tables put together; with ``sign=-1`` in ``digests`` rows are taken off."""
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part)
    return both.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in ("n", *WORDS)])


def differing_buckets(intended: DataFrame, found: DataFrame) -> DataFrame:
    """``bucket``, ``missing`` (rows fewer than intended, negative if more) of the buckets whose sums differ."""
    less = found.select("bucket", *[(-F.col(c)).alias(c) for c in ("n", *WORDS)])
    left = added_up(intended, less)
    off = F.greatest(*[F.abs(c) for c in ("n", *WORDS)]) > 0
    return left.where(off).select("bucket", F.col("n").alias("missing"))


def differing_rows(intended: DataFrame, found: DataFrame, buckets: DataFrame, key: str = "id", n_buckets: int = BUCKETS) -> DataFrame:
    """The key, ``missing`` and ``surplus`` rows of the keys that differ, among the buckets given.

    A changed row is one missing and one surplus. Rows of other buckets are dropped as they are scanned, as there
    are at most ``n_buckets`` buckets.
    """
    columns = sorted(intended.columns)

    def hashed(df: DataFrame, sign: int) -> DataFrame:
        first, second = row_hashes(columns)
        named = df.withColumn("__bucket", key_bucket(key, n_buckets)).join(F.broadcast(buckets.select(F.col("bucket").alias("__bucket"))), "__bucket", "left_semi")
        return named.select(F.col(key), first.alias("a"), second.alias("b"), F.lit(sign).alias("sign"))

    counted = hashed(intended, 1).unionAll(hashed(found.select(intended.columns), -1)).groupBy(key, "a", "b").agg(F.sum("sign").alias("left"))
    sums = counted.where("left <> 0").groupBy(key).agg(F.sum(F.greatest("left", F.lit(0))).alias("missing"), F.sum(F.greatest(-F.col("left"), F.lit(0))).alias("surplus"))
    return sums
