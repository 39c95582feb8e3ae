"""Near-duplicate vectors: spherical k-means cells, blocked cosine products, one representative per group."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postfeed.llm.common import forget, grouped, min_labels, settled, written, written_at
from postfeed.llm.graph import components
from postfeed.session import bytes_read

# Cosine from which two vectors are linked.
COSINE = 0.95

# Vectors the cells are fitted on at most, vectors wanted in a cell, and cells at most. Every vector is assigned.
SAMPLE, CELL, MAX_CELLS, SWEEPS = 16_384, 512, 1024, 8

# By what a border may be nearer than rounding says, and by what a product of single precision may be too small.
ROUNDING, SINGLE = 1e-9, 1e-5

# Vectors in a block, and bytes of them in double precision at most.
BLOCK, BLOCK_BYTES = 2048, 4 << 20

# Main axes on which two vectors are compared first.
AXES = 16

# Vectors whose cells are looked for at a time, that are compared with a block at a time, and rows sent at a time.
ROWS, STRIP, SENT = 2048, 128, 1 << 16

# Blocks in a file, bytes of blocks that a task takes on each side, and blocks that it keeps unpacked.
FILE_BLOCKS, SIDE_BYTES, KEPT = 32, 64 << 20, 32

# Links a task gathers before it thins them.
LINKS = 1 << 20

_KEYED = "vec_id long, digest binary, width int, key binary"
_CELLS = "home long, node long, size long, vector binary"
_BLOCKS = "block long, turn int, cells array<long>, seen array<long>, homes binary, nodes binary, sizes binary, vectors binary"
_COMPARED = ("block", "homes", "nodes", "sizes", "vectors")


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows at length 1, scaled first so that no square overflows."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def spherical_kmeans(units: np.ndarray, cells: int, sweeps: int = SWEEPS) -> np.ndarray:
    """Centres on the sphere; each starts at one of the vectors, evenly picked."""
    centres = units[np.linspace(0, len(units) - 1, cells).astype(int)].copy()
    for _ in range(sweeps):
        near = (units @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, units)
        length = np.sqrt((sums * sums).sum(axis=1))
        full = length > 1e-9
        centres[full] = sums[full] / length[full, None]
    return centres


def axes_of(units: np.ndarray) -> np.ndarray:
    """The AXES directions in which some of the vectors, evenly picked, spread most, as columns."""
    return np.linalg.svd(units[:: -(-len(units) // 512)], full_matrices=False)[2][:AXES].T


def visits(units: np.ndarray, home: np.ndarray, centres: np.ndarray, cells: np.ndarray, cosine: float = COSINE) -> np.ndarray:
    """A mask of those of ``cells`` that each vector visits, its own among them; ``home`` is the number of its own.

    The border of two cells is a plane through the origin. A linked vector is at most arccos(cosine) away on the
    sphere, so it can only be behind a border whose distance is at most the sine of that. No link crosses another.
    """
    reach = np.sqrt(1 - cosine * cosine) + ROUNDING if cosine > 0 else np.inf
    homes, index = np.unique(home, return_inverse=True)
    gaps = np.sqrt(np.maximum(2 - 2 * centres[homes] @ centres[cells].T, 1e-18))[index]
    away = (np.einsum("ij,ij->i", units, centres[home])[:, None] - units @ centres[cells].T) / gaps
    return (away <= reach) | (home[:, None] == cells)


def _keyed(batches):
    """The components of each vector as bytes, in single precision where that loses nothing; null where it links with nothing."""
    for batch in batches:
        lists = batch.column(1)
        lengths = np.diff(lists.offsets.to_numpy()) * lists.is_valid().to_numpy(zero_copy_only=False)
        values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        ends = np.cumsum(lengths)
        with np.errstate(over="ignore", invalid="ignore"):
            short = values.astype(np.float32)
            # Running counts of what is not finite, not zero, and not the same in single precision.
            odd, full, lost = (np.concatenate([[0], np.cumsum(x)]) for x in (~np.isfinite(values), values != 0, short != values))
        of = lambda sums: sums[ends] - sums[ends - lengths]
        good = (of(odd) == 0) & (of(full) > 0) & batch.column(0).is_valid().to_numpy(zero_copy_only=False)
        exact, keys, digests = of(lost) == 0, [], []
        for k, (end, length) in enumerate(zip(ends.tolist(), lengths.tolist())):
            key = (short if exact[k] else values)[end - length : end].tobytes() if good[k] else None
            keys.append(key)
            digests.append(None if key is None else xxhash.xxh3_128_digest(key, seed=length))
        yield pa.record_batch({"vec_id": batch.column(0), "digest": pa.array(digests, pa.binary()), "width": pa.array(lengths, pa.int32()), "key": pa.array(keys, pa.binary())})


def doubles(keys: list[bytes], width: int) -> np.ndarray:
    """Vectors of one length in double precision."""
    narrow = np.array([len(x) == 4 * width for x in keys])
    out = np.empty((len(keys), width))
    for rows, kind in ((np.flatnonzero(narrow), np.float32), (np.flatnonzero(~narrow), np.float64)):
        out[rows] = np.frombuffer(b"".join(keys[i] for i in rows), dtype=kind).reshape(-1, width)
    return out


def _assigned(centres: dict[int, np.ndarray]):
    """The cell of each vector. Vectors of different lengths never share a cell."""

    def run(batches):
        for batch in batches:
            widths = batch.column("width").to_numpy()
            for width in np.unique(widths).tolist():
                rows = np.flatnonzero(widths == width)
                own = centres.get(width, np.eye(1, width))
                for at in range(0, len(rows), ROWS):
                    part = batch.take(pa.array(rows[at : at + ROWS]))
                    home = (unit(doubles(part.column("key").to_pylist(), width)) @ own.T).argmax(axis=1)
                    yield pa.record_batch([pa.array(home + width * MAX_CELLS), *(part.column(c) for c in ("node", "size", "key"))], names=["home", "node", "size", "vector"])

    return run


def most(cell: int, block: int) -> int:
    """Vectors in a block of the cell."""
    return max(1, min(block, BLOCK_BYTES // (8 * (cell // MAX_CELLS))))


def cell_groups(sizes: dict[int, int], block: int) -> dict[int, int]:
    """The group of each cell that is some vector's own: cells of one length in a row, up to a block of vectors of their own."""
    groups, held = {}, 0
    last = None
    for cell in sorted(sizes):
        if last is None or cell // MAX_CELLS != last // MAX_CELLS or held + sizes[cell] > most(cell, block):
            group, held = cell, 0
        groups[cell], last = group, cell
        held += sizes[cell]
    return groups


def _packed(centres: dict[int, np.ndarray], cosine: float):
    """A block as one row: its vectors, and the cells that are their own or that one of them visits."""

    def run(table):
        home = table.column("home").to_numpy()
        width = int(home[0]) // MAX_CELLS
        keys = table.column("vector").to_pylist()
        units, own = unit(doubles(keys, width)), centres.get(width, np.eye(1, width))
        seen = visits(units, home % MAX_CELLS, own, np.arange(len(own)), cosine).any(axis=0)
        short = all(len(x) == 4 * width for x in keys)
        block = (table.column("group")[0].as_py() << 24) + table.column("part")[0].as_py()
        return pa.table({
            "block": pa.array([block], pa.int64()), "turn": pa.array([xxhash.xxh32_intdigest(str(block)) % 2], pa.int32()),
            "cells": pa.array([np.unique(home)], pa.list_(pa.int64())), "seen": pa.array([np.flatnonzero(seen) + width * MAX_CELLS], pa.list_(pa.int64())),
            "homes": pa.array([home.tobytes()], pa.binary()), "nodes": pa.array([table.column("node").to_numpy().tobytes()], pa.binary()),
            "sizes": pa.array([table.column("size").to_numpy().tobytes()], pa.binary()),
            "vectors": pa.array([b"".join(keys) if short else doubles(keys, width).tobytes()], pa.binary()),
        })

    return run


class _Block:
    """A block in a task. ``flat`` holds its vectors on the main axes, and the length of what these leave out."""

    def __init__(self, batch, row: int, side: str, axes: dict[int, np.ndarray]):
        homes, self.nodes, self.sizes = (np.frombuffer(batch.column(side + c)[row].as_py(), dtype=np.int64) for c in ("homes", "nodes", "sizes"))
        self.width, self.home = int(homes[0]) // MAX_CELLS, homes % MAX_CELLS
        self.cells = np.unique(self.home)
        data = batch.column(side + "vectors")[row].as_py()
        kind = np.float32 if len(data) == 4 * self.width * len(homes) else np.float64
        self.units = unit(np.frombuffer(data, dtype=kind).astype(np.float64).reshape(-1, self.width))
        main = axes.get(self.width)
        flat = self.units[:, :AXES] if main is None else self.units @ main
        rest = np.sqrt(np.maximum(1 - (flat * flat).sum(axis=1, keepdims=True), 0))
        self.flat = np.concatenate([flat, rest], axis=1).astype(np.float32)


def linked(x: _Block, y: _Block, centres: dict[int, np.ndarray], cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """The positions in both blocks of all vectors whose cosine is at least ``cosine``.

    Only vectors that visit a cell of the other block are compared. The product on the main axes and that of what
    the axes leave out are together never below the cosine, so most pairs need no more than that.
    """
    own = centres.get(x.width, np.eye(1, x.width))
    rows, cols = (np.flatnonzero(visits(a.units, a.home, own, b.cells, cosine).any(axis=1)) for a, b in ((x, y), (y, x)))
    found = [(rows[:0], cols[:0])]
    flat, room = y.flat[cols].T, np.empty(STRIP * len(cols), dtype=np.float32)
    for at in range(0, len(rows), STRIP):
        part = rows[at : at + STRIP]
        said = np.matmul(x.flat[part], flat, out=room[: len(part) * len(cols)].reshape(len(part), len(cols)))
        near = np.flatnonzero(said.ravel() >= cosine - SINGLE)
        if len(near) > said.size // 16:
            i, j = np.nonzero(x.units[part] @ y.units[cols].T >= cosine)
        else:
            i, j = np.divmod(near, max(1, len(cols)))
            close = np.einsum("ij,ij->i", x.units[part[i]], y.units[cols[j]]) >= cosine
            i, j = i[close], j[close]
        found.append((part[i], cols[j]))
    i, j = (np.concatenate(n) for n in zip(*found))
    return i, j


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links thinned to one from each node to the smallest of its component."""
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = nodes[min_labels(len(nodes), index[: len(a)], index[len(a) :])] if len(nodes) else nodes
    return nodes[root != nodes], root[root != nodes]


def _products(centres: dict[int, np.ndarray], axes: dict[int, np.ndarray], cosine: float):
    """The links of all vectors of a task's pairs of blocks, and one row for each node that they join to another."""

    def run(batches):
        kept: dict[int, _Block] = {}
        counts: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        joins, held, limit, left = [], 0, LINKS, None

        def count(block, of, at, sizes):
            total = counts.setdefault(block, (of.nodes, np.zeros(len(of.nodes), np.int64)))[1]
            total += np.bincount(at, weights=sizes, minlength=len(total)).astype(np.int64)

        for batch in batches:
            for row in range(batch.num_rows):
                a, b = batch.column("a_block")[row].as_py(), batch.column("b_block")[row].as_py()
                if left is None or left[0] != a:
                    left = a, _Block(batch, row, "a_", axes)
                x, y = left[1], left[1] if a == b else kept.get(b)
                if y is None:
                    y = _Block(batch, row, "b_", axes)
                    if len(kept) < KEPT:
                        kept[b] = y
                i, j = linked(x, y, centres, cosine)
                other = x.nodes[i] != y.nodes[j]
                i, j = i[other], j[other]
                if not len(i):
                    continue
                count(a, x, i, y.sizes[j])
                if a != b:
                    count(b, y, j, x.sizes[i])
                # Numbers in the order of the nodes, so that the lowest is the smallest node.
                nodes, index = np.unique(np.concatenate([x.nodes, y.nodes]), return_inverse=True)
                root = min_labels(len(nodes), index[i], index[len(x.nodes) + j])
                moved = np.flatnonzero(root != np.arange(len(nodes)))
                joins.append((nodes[moved], nodes[root[moved]]))
                held += len(moved)
                if held > limit:
                    joins = [forest(*(np.concatenate(n) for n in zip(*joins)))]
                    held = len(joins[0][0])
                    limit = max(LINKS, 2 * held)
        out = [(nodes[total > 0], total[total > 0], nodes[total > 0]) for nodes, total in counts.values()]
        if joins:
            nodes, roots = forest(*(np.concatenate(n) for n in zip(*joins)))
            out.append((nodes, np.zeros(len(nodes), np.int64), roots))
        for columns in out:
            for at in range(0, len(columns[0]), SENT):
                yield pa.record_batch([pa.array(c[at : at + SENT]) for c in columns], names=["node", "links", "root"])

    return run


def _cells(classes: DataFrame, number: int):
    """The vectors of ``classes`` with their cells as a table, its path, the centres of the cells and the main axes, by length."""
    # Of the lowest hashes; most others are left out before any are sorted.
    low = F.xxhash64("digest")
    share = min(1.0, 1.25 * SAMPLE / max(1, number))
    picked = classes.where(low <= F.lit(min(2**63 - 1, int(share * 2**64) - 2**63))).orderBy(low, "digest").limit(SAMPLE).select("width", "key").collect()
    by_width: dict[int, list[bytes]] = {}
    for row in picked:
        by_width.setdefault(row["width"], []).append(bytes(row["key"]))
    cells = min(MAX_CELLS, max(1, number // CELL))
    centres, axes = {}, {}
    for width, keys in by_width.items():
        units = unit(doubles(keys, width))
        found = spherical_kmeans(units, min(cells, len(units)))
        # Neighbours on the main axis have neighbouring numbers, and blocks in common.
        centres[width] = found[np.argsort(found @ np.linalg.svd(found, full_matrices=False)[2][0], kind="stable")]
        axes[width] = axes_of(units)
    return *written_at(classes.mapInArrow(_assigned(centres), _CELLS), "cells"), centres, axes


def _blocks(assigned: DataFrame, centres: dict[int, np.ndarray], cosine: float, block: int) -> tuple[DataFrame, str]:
    """The vectors in blocks, each of one cell or of neighbouring ones, as a table, and its path."""
    spark = assigned.sparkSession
    # One row per cell: at most MAX_CELLS for each length of vector.
    sizes = {r["home"]: r["count"] for r in assigned.groupBy("home").count().collect()}
    groups = cell_groups(sizes, block)
    total: dict[int, int] = {}
    for cell, group in groups.items():
        total[group] = total.get(group, 0) + sizes[cell]
    parts = {group: -(-n // most(group, block)) for group, n in total.items()}
    places = spark.createDataFrame([(c, g, parts[g]) for c, g in groups.items()], "home long, group long, parts int")
    placed = assigned.join(F.broadcast(places), "home").withColumn("part", F.pmod(F.xxhash64("vector"), F.col("parts")).cast("int")).drop("parts")
    packed = grouped(placed, ["group", "part"], ["node"], _packed(centres, cosine), _BLOCKS)
    count = sum(parts.values())
    # So small that a task's share of the table is several files, and one file is little to unpack.
    return written_at(packed, "blocks", maxRecordsPerFile=str(max(1, min(FILE_BLOCKS, count // _sides(spark)))))


def _sides(spark: SparkSession) -> int:
    """Parts of a table so that pairs of parts are a few for each core."""
    return math.ceil(math.sqrt(3 * spark.sparkContext.defaultParallelism))


def near_vectors(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """One row per row of ``embeddings``: vec_id, n_links, component_id, kept.

    Vectors are linked if their cosine in double precision is at least ``cosine``; n_links counts the other
    rows linked directly, component_id is the smallest id reachable. Vectors that are null, empty or zero,
    or hold a null or a number that is not finite, link with nothing; so do rows with a null id, whose
    component_id is null, and vectors of different lengths with one another. Such rows stay. Rows that share an
    id and a vector are linked rows. An empty table gives an empty result; other columns are not looked at.

    Equal vectors are one class before anything is compared. A class is compared in its own cell and in every other
    behind whose border a linked vector can be, so no pair is missed. Each vector lies once in a block of about
    ``block`` vectors of a cell or of neighbouring ones; tasks read pairs of blocks, and send counts and a spanning forest.
    """
    source = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    return settled(embeddings.sparkSession, "near-vectors", lambda: _near_vectors(source, cosine, block))


def _near_vectors(source: DataFrame, cosine: float, block: int) -> DataFrame:
    spark = source.sparkSession
    # Whole vectors are held three times at most: tables and shuffles of them go as soon as the next table is written.
    keyed, path = written_at(source.mapInArrow(_keyed, _KEYED), "vectors")
    rows = written(keyed.select("vec_id", "digest"), "rows")
    classes = keyed.where("key IS NOT NULL").groupBy("digest", "width", "key").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("size"))
    classes, classes_path = written_at(classes, "vector-classes")
    forget(spark, path)
    ids = written(classes.select("digest", "node", "size"), "class-ids")
    assigned, path, centres, axes = _cells(classes, ids.count())
    forget(spark, classes_path)
    packed, blocks_path = _blocks(assigned, centres, cosine, block)
    forget(spark, path)
    sides = max(_sides(spark), -(-bytes_read(packed) // SIDE_BYTES))
    a, b = (packed.select(*(F.col(c).alias(f"{side}_{c}") for c in packed.columns)).coalesce(sides) for side in "ab")
    # Of two blocks one goes first, as often the lower as the higher; no block is shuffled.
    once = F.expr("a_block = b_block OR (a_block < b_block) = (a_turn = b_turn)")
    meet = F.expr("arrays_overlap(a_seen, b_cells) AND arrays_overlap(b_seen, a_cells)")
    pairs = a.join(b.hint("shuffle_replicate_nl"), once & meet).select(*(f"{side}_{c}" for side in "ab" for c in _COMPARED))
    found = written(pairs.mapInArrow(_products(centres, axes, cosine), "node long, links long, root long"), "products")
    forget(spark, blocks_path)
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.where("node != root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    named = ids.join(counts, "node", "left").join(roots, "node", "left").select(
        "digest", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("root", "node").alias("component_id")
    )
    out = rows.join(named, "digest", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
