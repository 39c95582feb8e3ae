"""Word, shingle and batch helpers that the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession

from postfeed.session import bytes_read, drop_scratch, scratch_path

# Words in a shingle, and the similarity from which texts count as near-duplicates, in hundredths.
SHINGLE_WORDS = 5
SIMILARITY = 75

# Text bytes that a task works on at a time; a single longer text is a slice of its own.
SLICE_BYTES = 4 << 20

_MUL = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Bytes read from tables for which there is a partition of a table in few files.
FILE_BYTES = 8 << 20

# Partitions from which a table's size says nothing, or needs no fewer.
MOST_FILES = 1 << 20


def few(df: DataFrame) -> DataFrame:
    """The rows in one partition a core, or one for every FILE_BYTES that the plan reads if these are more.

    However many partitions a shuffle has, a small table is then not written as as many files, each of which costs
    a task and calls to the file system. Not for plans that number rows by the task they are in.
    """
    wanted = max(df.sparkSession.sparkContext.defaultParallelism, -(-bytes_read(df) // FILE_BYTES))
    return df if wanted > MOST_FILES else df.coalesce(wanted)


# Scratch tables written while a result is settled, innermost last.
_open: list[list[str]] = []


def written_at(df: DataFrame, name: str, **options: str) -> tuple[DataFrame, str]:
    """The DataFrame as a table in the shared scratch folder, and the table's path."""
    path = scratch_path(df.sparkSession, name)
    if _open:
        _open[-1].append(path)
    df.write.option("compression", "zstd").options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def written(df: DataFrame, name: str) -> DataFrame:
    """The DataFrame as a table in the shared scratch folder: computed once, safe from lost executors."""
    return written_at(df, name)[0]


def forget(spark: SparkSession, *paths: str | None) -> None:
    """Deletes written tables, and has Spark delete the shuffle files of plans that nothing refers to any more."""
    for path in paths:
        if path:
            drop_scratch(spark, path)
    spark._jvm.System.gc()


def slices(batches: Iterable[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The rows in slices of at most SLICE_BYTES of text, or of one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        start = 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + SLICE_BYTES, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def settled(spark: SparkSession, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """What ``make`` returns as a written table; the scratch tables it took on the way are deleted."""
    _open.append([])
    try:
        result = make()
        path = scratch_path(spark, name)
        result.write.option("compression", "zstd").parquet(path)
    finally:
        taken = _open.pop()
    for table_path in taken:
        drop_scratch(spark, table_path)
    if _open:
        _open[-1].append(path)
    return spark.read.schema(result.schema).parquet(path)


class _Codes(dict):
    """Numbers keys in the order they are first asked for."""

    def __missing__(self, key):
        self[key] = code = len(self)
        return code


def lower_tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words of each text, A-Z lower-cased: offsets of the texts, code of each word, the coded words as binary.

    A word is a run of bytes other than blank, tab, line feed, vertical tab, form feed and
    carriage return. Null is the empty text.
    """
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    offsets, words = np.asarray(parts.offsets).astype(np.int64), parts.flatten().cast(pa.binary())
    offsets -= offsets[0]
    # Blanks at either end of a text leave an empty part there.
    full = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
    if not full.all():
        offsets = np.concatenate([[0], np.cumsum(full)])[offsets].astype(np.int64)
        words = words.filter(pa.array(full))
    coded = words.dictionary_encode()
    return offsets, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def joined_words(words: pa.Array) -> bytes:
    """Words without blanks, a blank between them."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), b" ")[0].as_py()


def split_words(joined: bytes) -> pa.Array:
    """The words that were joined."""
    return pc.split_pattern(pa.array([joined], pa.binary()), b" ").flatten() if joined else pa.array([], pa.binary())


def lower_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """The same with the coded words as a list."""
    offsets, codes, words = lower_tokens(texts)
    return offsets, codes, joined_words(words).split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that every bit of the result depends on every bit given."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _MIX1
        x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def run_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """The hash of every run of ``n`` consecutive values; shorter by n - 1."""
    if len(hashes) < n:
        return np.empty(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        out = np.full(len(hashes) - n + 1, n, dtype=np.uint64)
        for i in range(n):
            out = out * _MUL + hashes[i : len(hashes) - n + 1 + i]
    return mix(out)


def shingle_sets(offsets: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted: offsets and values.

    A text of fewer words than a shingle has its whole sequence as the one shingle, a text
    without words has none.
    """
    counts = np.diff(offsets)
    runs = run_hashes(hashes, SHINGLE_WORDS)
    n_runs = np.maximum(counts - SHINGLE_WORDS + 1, 0)
    owner = np.repeat(np.arange(len(counts)), n_runs)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(n_runs) - n_runs, n_runs) + np.repeat(offsets[:-1], n_runs)
    values = runs[at] if len(at) else np.empty(0, dtype=np.uint64)
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE_WORDS))
    if len(short):
        whole = [run_hashes(hashes[offsets[i] : offsets[i + 1]], int(counts[i]))[0] for i in short]
        owner, values = np.concatenate([owner, short]), np.concatenate([values, np.array(whole, dtype=np.uint64)])
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    if len(values):
        first = np.concatenate([[True], (owner[1:] != owner[:-1]) | (values[1:] != values[:-1])])
        owner, values = owner[first], values[first]
    return np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(counts)))]).astype(np.int64), values


def min_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Connected components of a small graph over 0..n-1: for each node the lowest node of its component."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    return label


def fingerprint(values: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(values.tobytes())


def grouped(df: DataFrame, keys: list[str], order: list[str], work, schema: str) -> DataFrame:
    """``work`` on each group's rows as one Arrow table, in ``order``; it returns a table of ``schema``.

    For many small groups: a task goes through its sorted rows, so a group costs no call of its own between
    Spark and Python. Only the rows of one group and one batch are held, and groups have to be bounded.
    """
    width = len(keys)

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            held = held.combine_chunks()
            columns = [held.column(i).to_numpy() for i in range(width)]
            change = np.zeros(max(0, held.num_rows - 1), bool)
            for column in columns:
                change |= column[1:] != column[:-1]
            cuts = [0, *(np.flatnonzero(change) + 1).tolist()]
            for a, b in zip(cuts, cuts[1:]):
                yield from work(held.slice(a, b - a)).to_batches()
            held = held.slice(cuts[-1])
        if held is not None and held.num_rows:
            yield from work(held).to_batches()

    rest = [c for c in df.columns if c not in keys]
    return df.select(*keys, *rest).repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def binary(array: np.ndarray) -> pa.Array:
    """Rows of a C-ordered 2-d array as fixed pieces of binary."""
    width = array.shape[1] * array.itemsize
    offsets = np.arange(len(array) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(array), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(array))])


def ragged_binary(offsets: np.ndarray, values: np.ndarray) -> pa.Array:
    """``values[offsets[i]:offsets[i + 1]]`` as binary."""
    ends = (offsets * values.itemsize).astype(np.int64)
    large = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values))])
    return large.cast(pa.binary())
