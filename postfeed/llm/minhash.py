"""MinHash near-duplicates by an inverted join over signature coordinates.

Documents are posted under each value of their first coordinates. A value that one document has alone
meets nothing and goes; what is left of a document is merged from its rarest lists only, as pairs with
enough collisions meet there. Each list is led by one of its documents, and the documents of a
leader form a family, within which collisions are counted over the whole signature. Pairs above the match
threshold are confirmed on the full shingle sets, unless they are joined already.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postfeed.llm.common import SIMILARITY, binary, few, fingerprint, grouped, lower_words, ragged_binary, settled, shingle_sets, slices, word_hashes, written
from postfeed.llm.graph import components

# Coordinates of a signature, and how many must agree for a pair to be confirmed. A pair of similarity
# 0.75 falls below with probability 5e-6, a more similar one with less.
COORDINATES, MATCHES = 128, 75

# Coordinates under which documents are posted, and how many must collide; missed with probability 2e-7.
POSTED, COLLISIONS = 32, 11

PAYLOAD = "node long, sign binary, shingles binary"

# Documents that are compared with one another in one step.
BLOCK = 1024

# Blocks so small are compared without a look at the signatures.
SMALL = 6

_RNG = np.random.default_rng(20240229)
_A = _RNG.integers(1, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)


def signatures(offsets: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The signature of each non-empty set: per coordinate the smallest 32-bit hash of its shingles."""
    out = np.empty((len(offsets) - 1, COORDINATES), dtype=np.uint32)
    if len(out):
        for k in range(COORDINATES):
            out[:, k] = np.minimum.reduceat(((values * _A[k] + _B[k]) >> np.uint64(32)).astype(np.uint32), offsets[:-1])
    return out


def _sets(part: pa.RecordBatch, column: str = "text"):
    """Offsets and values of the texts' shingle sets."""
    offsets, codes, words = lower_words(part.column(column))
    return shingle_sets(offsets, word_hashes(words)[codes] if len(codes) else np.empty(0, np.uint64))


def _signed(batches):
    """Per row the size and fingerprint of its set; the first row of a set in a task carries the signature."""
    seen: set[bytes] = set()
    for part in slices(batches):
        offsets, values = _sets(part)
        sizes = np.diff(offsets)
        prints = [fingerprint(values[a:b]) if b > a else None for a, b in zip(offsets, offsets[1:])]
        new = []
        for i, (key, doc_id) in enumerate(zip(prints, part.column(0).to_pylist())):
            if key is not None and doc_id is not None and key not in seen:
                seen.add(key)
                new.append(i)
        if len(seen) > 1_000_000:
            seen.clear()
        signs: list[bytes | None] = [None] * len(prints)
        if new:
            lengths = sizes[new]
            at = np.concatenate([values[offsets[i] : offsets[i + 1]] for i in new])
            for i, sign in zip(new, signatures(np.concatenate([[0], np.cumsum(lengths)]), at)):
                signs[i] = sign.tobytes()
        arrays = [part.column("row"), part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), pa.array(signs, pa.binary())]
        yield pa.record_batch(arrays, names=["row", "doc_id", "n_shingles", "print", "sign"])


def _post(batches):
    """(key, node) for the posted coordinates; the key is the coordinate and its value."""
    for batch in batches:
        signs = np.frombuffer(b"".join(batch.column("sign").to_pylist()), dtype=np.uint32).reshape(-1, COORDINATES)[:, :POSTED]
        keys = signs.astype(np.int64) + (np.arange(POSTED, dtype=np.int64) << 32)
        nodes = np.repeat(batch.column("node").to_numpy(zero_copy_only=False), POSTED)
        yield pa.record_batch({"key": keys.ravel(), "node": nodes})


def _payload(batches):
    """Signature and sorted set of each candidate, from its whole text."""
    for part in slices(batches):
        offsets, values = _sets(part)
        full = np.flatnonzero(np.diff(offsets))
        if not len(full):
            continue
        starts = np.concatenate([offsets[full], offsets[-1:]])
        yield pa.record_batch([part.column(0).take(pa.array(full)), binary(signatures(starts, values)), ragged_binary(starts, values)], names=["node", "sign", "shingles"])


def _similar(a: np.ndarray, b: np.ndarray) -> bool:
    if SIMILARITY * max(len(a), len(b)) > 100 * min(len(a), len(b)):
        return False
    merged = np.sort(np.concatenate([a, b]), kind="stable")
    both = int((merged[1:] == merged[:-1]).sum())
    return 100 * both >= SIMILARITY * (len(a) + len(b) - both)


def join_block(nodes, signs, sets, tags, rows, first) -> np.ndarray:
    """Tags of one block after its links: pairs of ``rows`` with all are joined where their sets are similar.

    ``tags`` are what is joined already, as the index of a member; ``first`` is compared before the others.
    """
    tags = tags.copy()

    def join(pairs):
        for i, j in pairs:
            if tags[i] != tags[j] and _similar(sets[i], sets[j]):
                low, high = sorted((tags[i], tags[j]))
                tags[tags == high] = low

    n = len(nodes)
    if n <= SMALL:
        join((int(i), j) for i in rows for j in range(n))
        return tags
    if first is not None:
        enough = np.flatnonzero((signs == signs[first]).sum(axis=1) >= MATCHES)
        join((first, int(j)) for j in enough)
    for at in range(0, len(rows), 32):
        part = rows[at : at + 32]
        part = part[[bool((tags != tags[i]).any()) for i in part]]
        if not len(part):
            continue
        # Skip what is joined; a first look at a quarter of the coordinates rules out most of the rest.
        open_pairs = tags[part][:, None] != tags[None, :]
        i, j = np.nonzero(open_pairs & ((signs[part][:, None, :32] == signs[None, :, :32]).sum(axis=2, dtype=np.uint8) >= 8))
        counts = np.empty(len(i), dtype=np.int64)
        for k in range(0, len(i), 4096):
            counts[k : k + 4096] = (signs[part[i[k : k + 4096]]] == signs[j[k : k + 4096]]).sum(axis=1)
        enough = np.flatnonzero(counts >= MATCHES)
        order = enough[np.argsort(-counts[enough], kind="stable")]
        join((int(part[i[k]]), int(j[k])) for k in order)
    return tags


def _block_arrays(table):
    signs = np.frombuffer(b"".join(table.column("sign").to_pylist()), dtype=np.uint32).reshape(-1, COORDINATES)
    return table.column("node").to_numpy(), signs, [np.frombuffer(s, dtype=np.uint64) for s in table.column("shingles").to_pylist()]


def _first_pass(table):
    """One block of a family, its leader included."""
    leader = table.column("leader")[0].as_py()
    nodes, signs, sets = _block_arrays(table)
    lead = np.flatnonzero(nodes == leader)
    tags = join_block(nodes, signs, sets, np.arange(len(nodes)), np.arange(len(nodes)), int(lead[0]) if len(lead) else None)
    with_leader = tags == tags[lead[0]] if len(lead) else np.zeros(len(nodes), bool)
    return pa.table({"leader": np.full(len(nodes), leader), "node": nodes, "root": nodes[tags], "with_leader": with_leader})


def _second_pass(table):
    """Documents not joined with their leader against one block of the family."""
    opened = table.column("open").to_numpy()
    nodes = table.column("node").to_numpy()
    # A document of this block that asks itself is there twice, the asking row last.
    last = np.concatenate([nodes[1:] != nodes[:-1], [True]])
    table, opened = table.filter(pa.array(last)), opened[last]
    nodes, signs, sets = _block_arrays(table)
    _, tags = np.unique(table.column("root").to_numpy(), return_inverse=True)
    firsts = np.full(tags.max() + 1, len(tags))
    np.minimum.at(firsts, tags, np.arange(len(tags)))
    before = firsts[tags]
    after = join_block(nodes, signs, sets, before, np.flatnonzero(opened), None)
    moved = np.flatnonzero(after != before)
    return pa.table({"a": nodes[moved], "b": nodes[after[moved]]})


def near_duplicates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK, row_col: str | None = None) -> DataFrame:
    """One row per row of ``documents``: doc_id, n_shingles, component_id, kept.

    Words are runs of bytes other than ASCII white space, A-Z lower-cased; a text's set is its distinct
    5-word shingles, with fewer words the whole sequence as one. Texts are linked if 100 times the size of
    the intersection is at least 75 times that of the union; component_id is the smallest id reachable.
    Null and empty texts, and texts without words, have no shingle, are linked with nothing and stay.
    Rows with a null id stay, with a null component_id. Rows that share an id are placed by their own texts;
    two sets whose smallest id is the same are one node. An empty table gives an empty result, and other
    columns are not looked at; ``row_col`` names a column of longs that comes first in the result.

    Texts of one set are one class before anything is compared. Every class meets every other it could be
    linked with; nothing is capped. A large family is compared in blocks: all with the leader first, then
    only what that did not join with each block.
    """
    row = F.lit(None) if row_col is None else F.col(row_col)
    numbered = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), row.cast("long").alias("row"))
    source = numbered.select("doc_id", "text")
    rows = written(numbered.mapInArrow(_signed, "row long, doc_id long, n_shingles long, print binary, sign binary"), "signed")
    keyed = rows.where("doc_id IS NOT NULL AND print IS NOT NULL")
    ids = keyed.groupBy("print").agg(F.min("doc_id").alias("node"))
    signs = keyed.where("sign IS NOT NULL").groupBy("print").agg(F.max("sign").alias("sign"))
    classes = written(few(ids.join(signs, "print")), "classes")
    root = settled(documents.sparkSession, "roots", lambda: few(components(class_links(classes, source, block))))
    root = root.withColumnRenamed("root", "component")
    named = classes.select("print", "node").join(root, "node", "left").select("print", F.coalesce("component", "node").alias("component"))
    out = rows.select("row", "doc_id", "n_shingles", "print").join(named, "print", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    out = out.select(*([] if row_col is None else [F.col("row").alias(row_col)]), "doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def class_links(classes: DataFrame, source: DataFrame, block: int = BLOCK) -> DataFrame:
    """Links (a, b) whose components are those of the similar classes."""
    postings = written(classes.select("node", "sign").mapInArrow(_post, "key long, node long"), "postings")
    shared = postings.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # Values a class has alone come first in the order of rarity, so they shorten the prefix that is merged.
    lists = postings.join(shared, "key").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("n", "key"))).alias("keys"))
    prefix = lists.where(F.size("keys") >= COLLISIONS).select("node", F.explode(F.expr(f"slice(keys, 1, size(keys) - {COLLISIONS - 1})")).alias("k"))
    prefix = written(few(prefix.select("node", "k.key")), "prefix")
    leaders = prefix.groupBy("key").agg(F.min(F.struct(F.xxhash64("node"), F.col("node"))).alias("lead"), F.count(F.lit(1)).alias("n"))
    leaders = leaders.where("n > 1").select("key", F.col("lead.node").alias("leader"))
    family = written(few(prefix.join(leaders, "key").select("leader", "node").distinct()), "family")
    wanted = family.select(F.col("node").alias("doc_id")).distinct()
    # The list of candidates grows with the input, so it is merged with the texts at every size.
    payload = source.where("doc_id IS NOT NULL").join(wanted.hint("merge"), "doc_id", "left_semi").mapInArrow(_payload, PAYLOAD)
    return family_links(family, written(few(payload), "payload"), block)


def family_links(family: DataFrame, payload: DataFrame, block: int = BLOCK) -> DataFrame:
    """Links (a, b) whose components are those of the similar members of each family.

    ``family`` (leader, node) holds the leader as a member too; ``payload`` has node, sign and shingles.
    """
    sizes = family.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks")).where("blocks > 0")
    members = family.join(sizes, "leader")
    spot = F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int")
    # The leader goes to every block of its family.
    every = F.when(F.col("node") == F.col("leader"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(spot))
    placed = members.select("leader", "node", "blocks", F.explode(every).alias("block"))
    placed = placed.join(payload, "node").select("leader", "block", "node", "sign", "shingles")
    first = grouped(placed, ["leader", "block"], ["node"], _first_pass, "leader long, node long, root long, with_leader boolean")
    first = written(few(first), "first-pass")
    links = first.select(F.col("node").alias("a"), F.col("root").alias("b"))
    large = sizes.where("blocks > 1")
    if large.isEmpty():
        return links
    state = first.join(large, "leader").where("node != leader OR with_leader").dropDuplicates(["leader", "node"])
    state = written(few(state.withColumn("block", spot)), "large")
    rest = state.where("NOT with_leader")
    groups = rest.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("groups"))
    part = F.pmod(F.xxhash64("node", F.lit(2)), F.col("groups")).cast("int")
    asks = rest.join(groups, "leader").select("leader", "node", "root", part.alias("part"), F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"), F.lit(True).alias("open"))
    gives = state.join(groups, "leader").select("leader", "node", "root", F.explode(F.expr("sequence(0, groups - 1)")).alias("part"), "block", F.lit(False).alias("open"))
    both = asks.unionByName(gives).join(payload, "node")
    second = grouped(both, ["leader", "part", "block"], ["node", "open"], _second_pass, "a long, b long")
    return links.unionByName(second)
