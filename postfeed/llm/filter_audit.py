"""What each of a few filters removes, in every order in which they can be applied.

A document is reduced to the mask of the filters that it fails. In lexicographic order of permutations, those
that begin alike stand together: a beginning of k filters covers (n - k)! consecutive ranks. A mask is removed at
step k in exactly those orders whose beginning meets its first failed filter at place k, so its removals are a
few intervals of ranks. Counts per mask are added where an interval starts and taken off where it ends; running
sums over the ranks then give what each step of every order removes. Documents are only counted, once each.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from postfeed.llm.common import written

# White space between words, and the failure conditions of the registered query.
GAP = r"[\x20\x09-\x0D]+"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 50, 65, 5
MARKS = r"[#$%&*|]"

# n filters have n! orders; each part of the result has a row per order and step.
MOST_FILTERS = 6


def orders(letters: str) -> list[str]:
    """All orders of the letters, by rank."""
    return ["".join(p) for p in permutations(sorted(letters))]


def intervals(letters: str) -> list[tuple[int, int, int, int]]:
    """Mask, step, first rank and the rank after the last of every run of orders in which the mask is removed there.

    Bit i of a mask is the i-th letter in alphabetical order.
    """
    letters, found = sorted(letters), []
    n = len(letters)

    def descend(begun: list[int], rank: int):
        rest = [i for i in range(n) if i not in begun]
        width = factorial(n - len(begun) - 1) if rest else 0
        for place, i in enumerate(rest):
            start = rank + place * width
            # Masks with letter i and none of those begun with: any choice among the other letters.
            free = [j for j in rest if j != i]
            for choice in range(1 << len(free)):
                mask = 1 << i | sum(1 << j for b, j in enumerate(free) if choice >> b & 1)
                found.append((mask, len(begun) + 1, start, start + width))
            if free:
                descend([*begun, i], start)

    descend([], 0)
    return found


def text_masks(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """Per row: id, part, digest of the text and the mask of the conditions A to D (bits 0 to 3). Null text is empty.

    A: under 50 words. B: distinct words are under 65 % of words. C: A-Z are over 5 % of the characters.
    D: holds one of # $ % & * |.
    """
    rows = documents.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    split = rows.withColumn("words", F.array_remove(F.split("text", GAP), ""))
    sized = split.select("id", "part", "text", F.size("words").cast("long").alias("n"), F.size(F.array_distinct("words")).cast("long").alias("different"))
    capitals = F.length("text") - F.length(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    fails = [F.col("n") < LEAST_WORDS, 100 * F.col("different") < LEAST_DISTINCT * F.col("n"),
             100 * capitals.cast("long") > MOST_CAPITALS * F.length("text").cast("long"), F.col("text").rlike(MARKS)]
    mask = sum((F.when(fail, 1 << i).otherwise(0) for i, fail in enumerate(fails)), F.lit(0))
    return sized.select("id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), mask.cast("int").alias("mask"))


def with_repeats(rows: DataFrame, bit: int) -> DataFrame:
    """``rows`` (id, digest, mask, ...) with ``bit`` set in the mask of those whose text a smaller id has too.

    The smallest id of each text is found first; a row is a repeat unless it is that row. Both the text and the id
    are keys of the join, so a text that many rows share is spread. A null id is not smaller than any, and
    no id is smaller than it.
    """
    firsts = rows.groupBy("digest").agg(F.min("id").alias("id")).withColumn("__first", F.lit(True))
    met = rows.join(firsts, ["digest", "id"], "left")
    repeat = F.col("id").isNotNull() & F.col("__first").isNull()
    return met.withColumn("mask", F.when(repeat, F.col("mask").bitwiseOR(1 << bit)).otherwise(F.col("mask"))).drop("__first", "digest")


def audit(masks: DataFrame, letters: str, losses: tuple[str, ...] = ()) -> DataFrame:
    """Counts of every step of every order, from rows of ``part``, ``mask``, ``n`` and a count per loss.

    ``n`` rows of the part have the mask; of these, a loss column says how many have a property that is watched.
    Returns part, filter_order, step, kept, removed, redundant, unique_fails, a column per loss of those removed
    at the step, and shapley. Rows may repeat a part and mask; they are added. A part whose rows fail nothing has
    all its rows too; without rows the result is empty.
    """
    if not 1 <= len(set(letters)) == len(letters) <= MOST_FILTERS:
        raise ValueError(f"1 to {MOST_FILTERS} different letters")
    spark, n = masks.sparkSession, len(letters)
    ranks, counted = factorial(n), ["removed", *losses]
    # A few hundred rows: at most (orders of the letters) * (masks).
    covered = spark.createDataFrame(intervals(letters), "mask int, step int, start int, stop int")
    sums = masks.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", *losses)])
    edges = sums.join(F.broadcast(covered), "mask").select("part", "step", *[F.col(c).alias("removed" if c == "n" else c) for c in ("n", *losses)], F.explode(
        F.array(F.struct(F.col("start").alias("rank"), F.lit(1).alias("sign")), F.struct(F.col("stop").alias("rank"), F.lit(-1).alias("sign")))).alias("edge"))
    edges = edges.where(F.col("edge.rank") < ranks).select("part", "step", "edge.rank", *[(F.col(c) * F.col("edge.sign")).alias(c) for c in counted])
    # Every part has a row per rank and step to start from; totals of the part go with them.
    fails = [F.sum(F.when(F.col("mask").bitwiseAND(1 << i) != 0, F.col("n")).otherwise(0)) for i in range(n)]
    only = [F.sum(F.when(F.col("mask") == 1 << i, F.col("n")).otherwise(0)) for i in range(n)]
    parts = sums.groupBy("part").agg(F.sum("n").alias("rows"), F.array(*fails).alias("fails"), F.array(*only).alias("only"))
    empty = parts.select("part", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step")).select("part", "step", F.explode(F.sequence(F.lit(0), F.lit(ranks - 1))).alias("rank"), *[F.lit(0).cast("long").alias(c) for c in counted])
    steps = edges.unionByName(empty).groupBy("part", "step", "rank").agg(*[F.sum(c).alias(c) for c in counted])
    # n! rows per part and step.
    along = W.partitionBy("part", "step").orderBy("rank").rowsBetween(W.unboundedPreceding, W.currentRow)
    steps = steps.select("part", "step", "rank", *[F.sum(c).over(along).alias(c) for c in counted])
    named = F.broadcast(spark.createDataFrame(list(enumerate(orders(letters))), "rank int, filter_order string"))
    at = F.instr(F.lit("".join(sorted(letters))), F.substring("filter_order", F.col("step"), F.lit(1)))
    steps = steps.join(named, "rank").withColumn("at", at).join(parts, "part")
    gone = F.sum("removed").over(W.partitionBy("part", "rank").orderBy("step"))
    whole = F.sum("removed").over(W.partitionBy("part", "at"))
    return steps.select(
        "part", "filter_order", "step", (F.col("rows") - gone).alias("kept"), "removed", (F.element_at("fails", F.col("at")) - F.col("removed")).alias("redundant"),
        F.element_at("only", F.col("at")).alias("unique_fails"), *losses, whole.alias("shapley"),
    )


def audit_documents(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """The audit of conditions A to E, E being a text that a smaller id of the whole table has too.

    good_lost and toxic_lost are the removed rows whose id has a label quality = 1 or toxic = 1. Null text is the
    empty text and fails A only, and E if it repeats; a null part is the empty part. Rows that repeat count each;
    of rows with one text, those with its smallest id pass E, a null id passes too and has no label. If the labels
    repeat an id, any label counts. Texts of any length are read whole. Empty documents give no rows. Other columns
    are not looked at.
    """
    said = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id")).agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good_lost"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic_lost"))
    rows = with_repeats(text_masks(documents, id_col, text_col, part_col), 4).join(said, "id", "left")
    masks = rows.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("good_lost", "toxic_lost")])
    # A row per part and mask, so that the texts are read once.
    return audit(written(masks, "masks"), "ABCDE", ("good_lost", "toxic_lost"))
