"""What a sync does with every row, from one pass over the keys of both tables.

Keys of both sides are counted in one aggregation. Only keys that one side lacks decide anything: staging rows
with such a key are new, published ones expire. The counts also say which keys are hot, so nothing is counted again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postfeed.functions.keys import has_key, no_key, usable_key
from postfeed.operators.keyed import HOT_ROWS, PARTS_OF_SHARE
from postfeed.session import fits_broadcast, materialise

KEY = "partner_job_id"
NEW, SKIP, KEEP, EXPIRE = "new", "skip", "keep", "expire"
STAGING, PUBLISHED = "staging", "published"


def key_pass(staging: DataFrame, published: DataFrame) -> DataFrame:
    """``key``, ``s_rows`` and ``p_rows`` of every usable key of either side, and a row with a NULL key for blank ones."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    sides = staging.select(usable_key(KEY).alias("key"), one.alias("s"), none.alias("p")).unionAll(
        published.select(usable_key(KEY).alias("key"), none.alias("s"), one.alias("p"))
    )
    return sides.groupBy("key").agg(F.sum("s").alias("s_rows"), F.sum("p").alias("p_rows"))


def row_actions(staging: DataFrame, published: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``side``, ``id``, ``action`` of every row of both tables, whose ids are unique on their side.

    Staging rows are new or to skip, published rows to keep or to expire. Rows with a blank key are new or kept;
    with an empty staging nothing expires. This acts at once: the counts per key are written first.
    """
    spark = staging.sparkSession
    counts = materialise(key_pass(staging, published), "key-pass")
    totals = counts.agg(F.coalesce(F.sum("s_rows"), F.lit(0)).alias("s"), F.coalesce(F.sum("p_rows"), F.lit(0)).alias("p")).first()
    sided = counts.where("key IS NOT NULL AND (s_rows = 0 OR p_rows = 0)").withColumn("n", F.col("s_rows") + F.col("p_rows"))
    alone = materialise(sided.select("key", "n"), "one-sided-keys")
    narrow = lambda df, side: df.select(F.lit(side).alias("side"), "id", KEY)
    rows = narrow(staging, STAGING).unionAll(narrow(published, PUBLISHED))
    keyed, blank = rows.where(has_key(KEY)), rows.where(no_key(KEY)).withColumn("alone", F.lit(False))
    if fits_broadcast(alone):
        met = keyed.join(F.broadcast(alone.select(F.col("key").alias(KEY), F.lit(True).alias("alone"))), KEY, "left")
    else:
        # No more keys than parts can have more rows than a part, which bounds the list of hot ones.
        part = max(hot_rows, -(-(totals.s + totals.p) // (PARTS_OF_SHARE * int(spark.conf.get("spark.sql.shuffle.partitions")))))
        hot = counts.where((F.col("s_rows") + F.col("p_rows") > part) & F.col("key").isNotNull())
        hot = F.broadcast(hot.select(F.col("key").alias(KEY), F.ceil((F.col("s_rows") + F.col("p_rows")) / part).cast("int").alias("salts")))
        salts = F.coalesce("salts", F.lit(1))
        left = keyed.join(hot, KEY, "left").withColumn("salt", F.pmod(F.xxhash64("id"), salts)).drop("salts")
        times = F.greatest(F.lit(1), F.ceil(F.col("n") / part).cast("int"))
        repeated = F.explode(F.sequence(F.lit(0).cast("long"), F.when(F.col("n") > part, times).otherwise(1).cast("long") - 1))
        right = alone.select(F.col("key").alias(KEY), repeated.alias("salt"), F.lit(True).alias("alone"))
        met = left.join(right, [KEY, "salt"], "left")
    met = met.select("side", "id", F.coalesce("alone", F.lit(False)).alias("alone")).unionAll(blank.select("side", "id", "alone").where(F.col("side") == PUBLISHED))
    staged = F.when(F.col("alone"), NEW).otherwise(SKIP)
    kept = F.when(F.col("alone") & F.lit(totals.s > 0), EXPIRE).otherwise(KEEP)
    found = met.select("side", "id", F.when(F.col("side") == STAGING, staged).otherwise(kept).alias("action"))
    return found.unionAll(blank.where(F.col("side") == STAGING).select("side", "id", F.lit(NEW).alias("action")))


def ids_of(actions: DataFrame, action: str) -> DataFrame:
    return actions.where(F.col("action") == action).select("id")
