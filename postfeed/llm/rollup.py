"""Token counts as delta-maintained rollups.

Totals by source, language and tokenizer version are sums of signed deltas: an insert adds a
document and its tokens, a delete takes both away, a revised count takes away the old tokens and adds the
new ones. A batch is one version of a table of summed deltas: it is there as a whole or not at all, and committed
again under its id it changes nothing.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postfeed.llm.common import slices
from postfeed.sources.versions import VersionedTable

KEYS = ["source", "lang", "tokenizer"]
# Sums in a file that ``tidy`` writes.
FILE_ROWS = 1_000_000

_SCHEMA = "source string, lang string, tokenizer string, docs long, tokens long"


def token_counts(documents: DataFrame, encoders: dict[str, Callable], keep: tuple[str, ...] = ("doc_id", "source", "lang"), text_col: str = "text") -> DataFrame:
    """Columns ``keep`` and, for each tokenizer version, a column of token counts; null text has none.

    Texts are counted whole, in batches; only numbers leave the task. Columns of ``keep`` that the table
    lacks are null.
    """
    names = list(encoders)

    def run(batches):
        built = [make() for make in encoders.values()]
        for part in slices(batches, "__text"):
            texts = [t or "" for t in part.column("__text").to_pylist()]
            counts = [pa.array([len(encode(t)) for t in texts], pa.int64()) for encode in built]
            width = part.num_columns - 1
            yield pa.record_batch([*(part.column(i) for i in range(width)), *counts], names=[*part.schema.names[:width], *names])

    chosen = documents.select(*[F.col(c) if c in documents.columns else F.lit(None).cast("string").alias(c) for c in keep], F.col(text_col).cast("string").alias("__text"))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema[:-1]] + [f"`{n}` long" for n in names]
    return chosen.mapInArrow(run, ", ".join(kinds))


def inserts(counted: DataFrame, tokenizer: str, tokens: str) -> DataFrame:
    """Deltas of new documents: one document and its tokens each."""
    return _deltas(counted, tokenizer, F.lit(1), F.coalesce(tokens, F.lit(0)))


def deletes(counted: DataFrame, tokenizer: str, tokens: str) -> DataFrame:
    """Deltas of documents that go; they need the counts they came with."""
    return _deltas(counted, tokenizer, F.lit(-1), -F.coalesce(tokens, F.lit(0)))


def revisions(counted: DataFrame, tokenizer: str, old: str, new: str) -> DataFrame:
    """Deltas of documents whose count changes from ``old`` to ``new``."""
    return _deltas(counted, tokenizer, F.lit(0), F.coalesce(new, F.lit(0)) - F.coalesce(old, F.lit(0)))


def _deltas(counted, tokenizer, docs, tokens) -> DataFrame:
    return counted.select(
        F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), F.lit(tokenizer).alias("tokenizer"),
        docs.cast("long").alias("docs"), tokens.cast("long").alias("tokens"),
    )


class Rollup:
    """Totals kept below one shared path, a version of a table for each batch.

    Null sources and languages are groups of their own, and null texts count as documents without tokens. Empty batches
    and batches of deltas that cancel out are fine. Rows that repeat in a batch count as often. What a delete or
    a revision takes away is taken on trust: one committed under two ids counts twice and a delete of what was never
    inserted leaves negative totals. Texts are not looked at here, so their length does not matter. Totals that
    are all zero are left out.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.table = VersionedTable(spark, path, T.StructType.fromDDL(_SCHEMA))

    def commit(self, batch: str, deltas: DataFrame) -> None:
        """Adds the sums of a batch's deltas, unless the batch has been added; summed before the shuffle, so a hot source costs a row per task."""
        if not re.fullmatch(r"[A-Za-z0-9_-]+", batch):
            raise ValueError("a batch id has letters, digits, - and _ only")
        self.table.append(deltas.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")), batch)

    def tidy(self, commit: str, rows_per_file: int = FILE_ROWS) -> None:
        """Puts the small files of many batches together; the totals stay and batches stay known."""
        self.table.compact(commit, rows_per_file)

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, docs, tokens over all committed batches."""
        sums = self.table.read().groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return sums.where("docs != 0 OR tokens != 0")
