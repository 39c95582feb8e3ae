"""A Merkle manifest of a dataset: a tree of digests per group of rows, and one over the groups.

Nodes are rows (group, index, size of the level, digest). On every level a node finds its siblings by joins of the
level with itself: their indices follow from its own, by XOR where runs have two nodes, else by the slot's offset.
Rows of slot zero, which then know their whole run, emit the parents. Going down again, each node adds its own
siblings to the steps of its parent, so that a leaf ends up with its inclusion proof. All joins are on group and
index, so a group with most of the rows is spread like any other, and nothing but one number and the root comes to
the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from postfeed.llm.common import written
from postfeed.operators.numbering import row_numbers

# Nodes in a run, and the columns that make a leaf, in order.
ARITY = 3
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

_STEPS = "array<struct<left: binary, right: binary>>"
_NONE = b""


def leaf_digest(*columns: Column) -> Column:
    """SHA-256 of the values, each ``-`` if null, else its length in UTF-8 bytes, ``:`` and the value."""
    framed = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in (c.cast("string") for c in columns)]
    return F.unhex(F.sha2(F.concat(*framed), 256))


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _parent(run: Column) -> Column:
    """Digest of a run of digests, which are concatenated as hex text."""
    return F.unhex(F.sha2(_hex(run), 256))


def group_key(group: Column) -> Column:
    """A text that orders like the group's UTF-8 bytes with null before all."""
    return F.when(group.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), group.cast("string")))


def placed(leaves: DataFrame) -> DataFrame:
    """``leaves`` (key, id, digest, ...) with g, the number of the key in order, idx, the place in the group, and n, its size.

    Rows of a group ascend by id, null first; rows that share an id by digest. The rows are range-partitioned by
    key and id and written with their place in the partition; then sizes per partition and key are added up.
    """
    order = ["key", "id", "digest", "tie"]
    # Equal rows stand in the order in which they were scanned, so that many of them can be split between tasks.
    ranged = leaves.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")
    rows = written(ranged.withColumn("at", F.monotonically_increasing_id()), "leaves").withColumn("part", F.shiftright("at", 33))
    sizes = rows.groupBy("key", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("here"))
    # A row per key and partition that has it.
    of_key = W.partitionBy("key")
    before = of_key.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("key", "part", (F.coalesce(F.sum("here").over(before), F.lit(0)) - F.col("first")).alias("shift"), F.sum("here").over(of_key).alias("n"))
    starts = written(starts, "starts")
    numbers = row_numbers(starts.select("key").distinct(), "key").withColumnRenamed("idx", "g")
    starts = written(starts.join(numbers, "key"), "starts")
    return rows.join(starts, ["key", "part"]).withColumn("idx", F.col("at") + F.col("shift")).drop("key", "part", "at", "shift")


def with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """Nodes with the digests of the run's other nodes before (``left``) and after (``right``) their own, concatenated."""
    slot = F.col("idx") % arity
    met, there = nodes, nodes.select("g", F.col("idx").alias("at"), "digest")
    for offset in range(1, arity):
        at = F.col("idx").bitwiseXOR(F.lit(1)) if arity == 2 else F.col("idx") - slot + (slot + offset) % arity
        other = there.withColumnRenamed("digest", f"other_{offset}")
        met = met.withColumn("at", at).join(other, ["g", "at"], "left").drop("at")

    def of_slot(t: int) -> Column:
        return F.coalesce(*[F.when((slot + o) % arity == t, F.col(f"other_{o}")) for o in range(1, arity)], F.lit(_NONE))

    left = F.concat(*[F.when(slot > t, of_slot(t)).otherwise(_NONE) for t in range(arity - 1)])
    right = F.concat(*[F.when(slot < t, of_slot(t)).otherwise(_NONE) for t in range(1, arity)])
    return met.withColumns({"left": left, "right": right}).drop(*[f"other_{o}" for o in range(1, arity)])


def height(n: int, arity: int) -> int:
    """Levels above the leaves until one node remains."""
    levels = 0
    while n > 1:
        n, levels = -(-n // arity), levels + 1
    return levels


def climb(nodes: DataFrame, most: int, arity: int) -> list[DataFrame]:
    """The levels from the nodes up, each a written table with siblings; ``most`` is the size of the largest group."""
    levels = [written(with_siblings(nodes, arity), "level-0")]
    for k in range(height(most, arity)):
        zero = levels[-1].where((F.col("n") > 1) & (F.col("idx") % arity == 0))
        parents = zero.select(
            "g", F.expr(f"idx div {arity}").alias("idx"), F.expr(f"(n + {arity - 1}) div {arity}").alias("n"),
            _parent(F.concat("digest", "right")).alias("digest"))
        levels.append(written(with_siblings(parents, arity), f"level-{k + 1}"))
    return levels


def tops(levels: list[DataFrame]) -> DataFrame:
    """g and digest of what remains of each group."""
    last = [level.where("n = 1").select("g", "digest") for level in levels]
    out = last[0]
    for level in last[1:]:
        out = out.unionByName(level)
    return out


def descend(levels: list[DataFrame], above: DataFrame, arity: int) -> DataFrame:
    """The leaves with the steps of their proof, bottom up; ``above`` has, per g, what its last node starts with.

    That is ``steps`` and any columns that all leaves of the group are to carry.
    """
    known = None
    for k in reversed(range(len(levels))):
        level = levels[k]
        carried = [c for c in level.columns if c not in ("n", "digest", "left", "right")] if k else [c for c in level.columns if c not in ("n", "left", "right")]
        down = level.where("n = 1").select(*carried).join(above, "g")
        if known is not None:
            own = F.array(F.struct("left", "right"))
            inner = level.where("n > 1").select(*carried, own.alias("own"), F.expr(f"idx div {arity}").alias("up"))
            inner = inner.join(known.withColumnRenamed("idx", "up"), ["g", "up"]).withColumn("steps", F.concat("own", "steps")).drop("own", "up")
            down = down.unionByName(inner.select(*down.columns))
        known = written(down, f"steps-{k}") if k else down
    return known


def fold(leaf: Column, steps: Column) -> Column:
    """The root, as lower-case hex, that a leaf and the steps of its proof give."""
    return F.aggregate(steps, _hex(leaf), lambda acc, s: F.sha2(F.concat(_hex(s["left"]), acc, _hex(s["right"])), 256))


def proof_text(steps: Column) -> Column:
    """All siblings of a proof as hex text, level by level, left to right."""
    return F.array_join(F.transform(steps, lambda s: _hex(F.concat(s["left"], s["right"]))), "")


@dataclass
class Manifest:
    """The root, what remains of each group (key, subroot) and, per leaf, its columns with g, idx, subroot and steps."""

    root: str | None
    groups: DataFrame
    leaves: DataFrame


def manifest(leaves: DataFrame, arity: int = ARITY) -> Manifest:
    """The trees over ``leaves``: key (of ``group_key``), id, digest and any columns to carry along.

    Groups stand in order of key. Rows that repeat are leaves of their own. Without leaves there is no root and
    no row. ``arity`` is 2 or more.
    """
    if arity < 2:
        raise ValueError("a run has two nodes at least")
    leaves = written(leaves, "digests")
    nodes = placed(leaves)
    # One number.
    most = nodes.agg(F.max("n")).first()[0] or 0
    levels = climb(nodes.select("g", "idx", "n", "digest", *[c for c in leaves.columns if c not in ("key", "digest")]), most, arity)
    subroots = written(tops(levels), "subroots")
    n = subroots.count()
    over = climb(subroots.select(F.lit(0).cast("long").alias("g"), F.col("g").alias("idx"), F.lit(n).cast("long").alias("n"), "digest"), n, arity)
    root = tops(over).select(_hex(F.col("digest"))).first()
    start = leaves.sparkSession.createDataFrame([(0, [])], f"g long, steps {_STEPS}")
    above = descend(over, start, arity).select(F.col("idx").alias("g"), F.col("digest").alias("subroot"), "steps")
    above = written(above, "above")
    return Manifest(root[0] if root else None, subroots, descend(levels, above, arity))


def verified_documents(documents: DataFrame, arity: int = ARITY) -> DataFrame:
    """Per row of ``documents`` its leaf, subroot, root, proof and whether the row, tampered with or not, still verifies.

    Rows whose id's crc32 is even lose the line feeds of their text before they are hashed again. A null value
    of any column is hashed as ``-`` and an empty text as such; a null id stands first in its source and is not
    tampered with; null sources are the first group. Rows that repeat are leaves of their own, rows that share an
    id stand in order of their digests. No rows give an empty result. Other columns are not looked at.
    """
    value = {c: F.col(c) for c in LEAF_COLUMNS}
    doc_id = F.col("doc_id").cast("long")
    tampered = F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0
    changed = F.when(tampered, F.translate("text", "\n", "")).otherwise(F.col("text"))
    leaves = documents.select(
        group_key(F.col("source")).alias("key"), doc_id.alias("id"), leaf_digest(*value.values()).alias("digest"),
        # Hashed again only where the text changes.
        F.when(tampered & F.contains("text", F.lit("\n")), leaf_digest(*(value | {"text": changed}).values())).alias("again"),
    )
    made = manifest(leaves, arity)
    rows, root = made.leaves, F.lit(made.root).cast("string")
    folded = fold(F.coalesce("again", "digest"), F.col("steps"))
    out = rows.select(
        F.col("id").alias("doc_id"), _hex(F.col("digest")).alias("leaf"), _hex(F.col("subroot")).alias("subroot"), root.alias("root"),
        F.sha2(proof_text(F.col("steps")), 256).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
