"""A persisted index of keys, so that a few keys can be looked up without reading all.

Keys are dealt out to buckets by hash, one folder each. A key also has a place in its bucket's filter: a word of 64
bits and four bits in it. A look-up reads the filters of the buckets that the asked keys fall in, and then only
those buckets in which a filter lets a key through. Filters never lose a key, and a key that passes is compared, so
the answer is exact. What is read grows with the keys asked for, not with the index.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postfeed.session import materialise, path_exists

# Keys in a bucket, most buckets, filter bits for a key and the bits that a key sets in its word.
BUCKET_KEYS, MOST_BUCKETS, KEY_BITS, SET_BITS = 250_000, 65_536, 16, 4


class KeyIndex:
    """Keys in one column, ``key``, below ``path``; kept in parts, one for every ``add``."""

    def __init__(self, spark: SparkSession, path: str, key: str = "partner_job_id"):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key

    def _place(self, buckets: int | Column, words: int | Column) -> list[Column]:
        key, mask = F.col(self.key), F.lit(0).cast("long")
        for i in range(SET_BITS):
            bit = F.shiftright(F.xxhash64(F.lit(2), key), 6 * i).bitwiseAND(63).cast("int")
            mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
        return [key, F.pmod(F.xxhash64(F.lit(0), key), F.lit(buckets)).alias("bucket"), F.pmod(F.xxhash64(F.lit(1), key), F.lit(words)).alias("word"), mask.alias("mask")]

    def parts(self) -> dict[str, tuple[int, int]]:
        """The finished parts with their numbers of buckets and of words in a bucket's filter."""
        if not path_exists(self.spark, f"{self.path}/parts"):
            return {}
        rows = self.spark.read.schema("buckets long, words long, part string").parquet(f"{self.path}/parts").collect()
        return {r.part: (r.buckets, r.words) for r in rows}

    def add(self, keys: DataFrame, part: str, bucket_keys: int = BUCKET_KEYS) -> None:
        """The keys as a further part of the index; ``part`` is a name, and a part that is there already is left as it is.

        Null keys are left out. A part counts once its entry is written, after its keys and filters.
        """
        if part in self.parts():
            return
        keys = materialise(keys.select(self.key).where(F.col(self.key).isNotNull()).distinct(), "index-keys")
        n = keys.count()
        buckets = min(MOST_BUCKETS, max(1, -(-n // bucket_keys)))
        words = max(1, -(-n * KEY_BITS // (64 * buckets)))
        placed = keys.select(*self._place(buckets, words))
        dealt = placed.select("bucket", self.key).repartition("bucket").sortWithinPartitions("bucket", self.key)
        dealt.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/keys/part={part}")
        filters = placed.groupBy("bucket", "word").agg(F.bit_or("mask").alias("bits"))
        filters.repartition("bucket").sortWithinPartitions("bucket", "word").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/filters/part={part}")
        entry = self.spark.createDataFrame([(buckets, words)], "buckets long, words long")
        entry.write.mode("overwrite").parquet(f"{self.path}/parts/part={part}")

    def _read(self, kind: str, part: str, buckets: list[int], schema: str) -> DataFrame:
        base = f"{self.path}/{kind}/part={part}"
        return self.spark.read.schema(f"{schema}, bucket long").option("basePath", base).parquet(*[f"{base}/bucket={b}" for b in buckets])

    def _buckets_of(self, part: str, df: DataFrame) -> list[int]:
        """The distinct buckets of the rows, at most MOST_BUCKETS numbers, that the part has."""
        wanted = [r.bucket for r in df.select("bucket").distinct().collect()]
        fs = self.spark._jvm.org.apache.hadoop.fs.Path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())
        base = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/keys/part={part}")
        there = {int(s.getPath().getName().removeprefix("bucket=")) for s in fs.listStatus(base) if s.getPath().getName().startswith("bucket=")}
        return sorted(b for b in wanted if b in there)

    def candidates(self, asked: DataFrame, part: str) -> DataFrame:
        """The asked keys that the part's filters let through, with their buckets."""
        placed = asked.select(*self._place(*self.parts()[part]))
        buckets = self._buckets_of(part, placed)
        if not buckets:
            return placed.select(self.key, "bucket").limit(0)
        filters = self._read("filters", part, buckets, "word long, bits long")
        return placed.join(filters, ["bucket", "word"]).where("bits & mask = mask").select(self.key, "bucket")

    def buckets_to_read(self, asked: DataFrame, part: str) -> list[int]:
        return self._buckets_of(part, self.candidates(asked, part))

    def known(self, asked: DataFrame) -> DataFrame:
        """The distinct keys of ``asked`` that the index has; ``asked`` is read once for every part and step.

        Null keys are not known. While the candidates are few they are broadcast to the buckets that are read.
        """
        asked = asked.select(self.key).where(F.col(self.key).isNotNull()).distinct()
        found = asked.limit(0)
        for part in self.parts():
            passed = materialise(self.candidates(asked, part), "candidates")
            buckets = self._buckets_of(part, passed)
            if buckets:
                keys = self._read("keys", part, buckets, f"`{self.key}` string")
                found = found.unionByName(keys.join(passed, ["bucket", self.key], "left_semi").select(self.key))
        return found.distinct()
