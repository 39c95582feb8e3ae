"""Packing documents into sequences: hierarchical residual best-fit."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postfeed.llm.common import slices, written

# Tokens of a sequence, and free tokens up to which a bin counts as nearly full and is emitted.
SEQUENCE = 2048
SLACK = 8

# Underfull bins that meet in one task of a merge round, and items that one task packs at a time.
FAN_IN = 100_000
PACK_ITEMS = 200_000

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_BINS = "bin long, offset long, fill long"


def best_fit(lengths, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: bin and offset of each item, and the fill of each bin.

    Bins are kept by their free space, so each item takes the fullest bin it fits in.
    """
    order = np.argsort(-np.asarray(lengths), kind="stable")
    at, offset, fills = np.empty(len(order), np.int64), np.empty(len(order), np.int64), []
    free: dict[int, list[int]] = {}
    spaces: list[int] = []  # the distinct free spaces, sorted
    for i in order.tolist():
        size = int(lengths[i])
        k = bisect_left(spaces, size)
        if k == len(spaces):
            at[i], offset[i] = len(fills), 0
            fills.append(size)
        else:
            space = spaces[k]
            b = free[space].pop()
            if not free[space]:
                del free[space], spaces[k]
            at[i], offset[i] = b, fills[b]
            fills[b] += size
        left = capacity - fills[at[i]]
        if left > 0:
            if left not in free:
                free[left] = []
                insort(spaces, left)
            free[left].append(int(at[i]))
    return at, offset, np.array(fills, dtype=np.int64)


def pieces(documents: DataFrame, encoder, sequence: int = SEQUENCE, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The token pieces of each document: doc_id, piece, start, length, ids_crc32.

    ``encoder`` builds, once per task, a function from a text to its ids; ``end_id`` is added to each
    document. A document longer than a sequence is cut into whole sequences, the first piece being
    the shorter one. The checksum is over the piece's ids as little-endian unsigned 32-bit numbers.
    """

    def cut(batches):
        encode = encoder()
        for part in slices(batches):
            rows = []
            for doc_id, text in zip(*(part.column(i).to_pylist() for i in range(2))):
                ids = np.append(np.asarray(encode(text or ""), dtype="<u4"), np.uint32(end_id)).astype("<u4")
                first = len(ids) % sequence or min(sequence, len(ids))
                start = 0
                for n, stop in enumerate(range(first, len(ids) + 1, sequence)):
                    rows.append((doc_id, n, start, stop - start, zlib.crc32(ids[start:stop].tobytes())))
                    start = stop
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(cut, _PIECES)


def _packer(size_column: str, sequence: int):
    """Packs the rows of a task: adds each row's bin (numbered within the task), offset and the bin's fill."""

    def pack(batches):
        rows, n, base = [], 0, 0
        schema = None

        def packed():
            nonlocal base
            table = pa.Table.from_batches(rows)
            at, offset, fills = best_fit(table.column(size_column).to_numpy(), sequence)
            out = table.append_column("bin", pa.array(at + base)).append_column("offset", pa.array(offset)).append_column("fill", pa.array(fills[at]))
            base += len(fills)
            return out.to_batches()

        for batch in batches:
            schema = batch.schema
            rows.append(batch)
            n += batch.num_rows
            if n >= PACK_ITEMS:
                yield from packed()
                rows, n = [], 0
        if n:
            yield from packed()

    return pack


def _numbered(df: DataFrame, sizes: str, size_column: str, sequence: int, round_no: int, name: str) -> DataFrame:
    """Packs within tasks and numbers the bins uniquely: task and number in it, tagged with the round."""
    placed = df.mapInArrow(_packer(size_column, sequence), f"{sizes}, {_BINS}")
    part = F.spark_partition_id().cast("long")
    unique = F.shiftleft(F.lit(round_no).cast("long"), 58) + F.shiftleft(part, 34) + F.col("bin")
    return written(placed.withColumn("bin", unique), name)


def pack(items: DataFrame, sequence: int = SEQUENCE, slack: int = SLACK) -> DataFrame:
    """``items`` (doc_id, piece, start, length, ids_crc32) with ``sequence_id`` and ``offset``.

    Each task packs its items best-fit. Bins with at most ``slack`` free tokens are done; the others
    become items of their fill, meet in fewer tasks and are packed again, until a round has one task
    or joins nothing. Only the numbers of underfull bins move after the first round. A task packs at
    most PACK_ITEMS items at a time, in a merge round about FAN_IN bins, however large the input is.
    """
    schema = _PIECES
    first = _numbered(items, schema, "length", sequence, 0, "packed")
    open_bins = first.where(f"fill < {sequence - slack}").select("bin", "fill").distinct()
    moves, bins, round_no = None, written(open_bins.select(F.col("bin").alias("item"), F.col("fill").alias("size")), "open"), 0
    chain = []
    while True:
        count = bins.count()
        if count < 2 or round_no == 12:
            break
        round_no += 1
        tasks = max(1, -(-count // FAN_IN))
        merged = _numbered(bins.repartition(tasks, F.xxhash64("item", F.lit(round_no))), "item long, size long", "size", sequence, round_no, "merged")
        chain.append(merged.select("item", "bin", "offset"))
        after = merged.groupBy("bin").agg(F.max("fill").alias("fill"))
        left = written(after.where(f"fill < {sequence - slack}").select(F.col("bin").alias("item"), F.col("fill").alias("size")), "open")
        if tasks == 1 or merged.where("offset > 0").isEmpty():
            break
        bins = left
    # Composed from the last round down: where each underfull bin of the first round ends up.
    for step in reversed(chain):
        if moves is None:
            moves = step
            continue
        onward = moves.select(F.col("item").alias("bin"), F.col("bin").alias("top"), F.col("offset").alias("more"))
        composed = step.join(onward, "bin", "left")
        moves = composed.select("item", F.coalesce("top", "bin").alias("bin"), (F.col("offset") + F.coalesce("more", F.lit(0))).alias("offset"))
    if moves is None:
        return first.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("bin").alias("sequence_id"), "offset")
    final = moves.select(F.col("item").alias("bin"), F.col("bin").alias("top"), F.col("offset").alias("more"))
    joined = first.join(final, "bin", "left")
    return joined.select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.coalesce("top", "bin").alias("sequence_id"),
        (F.col("offset") + F.coalesce("more", F.lit(0))).alias("offset"),
    )


def pack_documents(documents: DataFrame, encoder, sequence: int = SEQUENCE, slack: int = SLACK, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents with the sequence and offset each gets.

    Null text is empty: one piece with the end id. Rows with a null or repeated id are packed like any
    other, each row on its own. An empty table gives an empty result. Whole pieces keep their order in
    the document by ``piece``; two pieces never overlap and a sequence has no gap.
    """
    return pack(pieces(documents, encoder, sequence, end_id, id_col, text_col), sequence, slack)
