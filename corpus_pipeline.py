"""A corpus from raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again
as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postfeed.llm.common import few, settled, table, written
from postfeed.llm.exact_dedup import exact_duplicates
from postfeed.llm.minhash import near_duplicates
from postfeed.llm.packing import pack_documents
from postfeed.llm.quality import KEEP_FROM, score, train
from postfeed.llm.substring import without_repeats
from postfeed.llm.tokenizers_public import rank_encoder

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    A null text is scored as the empty one, which stays or goes by its score like any other; long texts are scored
    whole. Rows that repeat have the same score and stay or go together. Null ids and repeated ids are kept as they are.
    """
    model = train(docs, table(spark, sf_dir, "labels"))
    scored = score(docs, model, keep=tuple(COLUMNS))
    return scored.where(F.col("score") >= KEEP_FROM).select(*[F.col(f"__keep_{k}").alias(c) for k, c in enumerate(COLUMNS)])


def _numbered(docs: DataFrame) -> DataFrame:
    """The documents as a written table with a number for each row, as ids may be null or repeat."""
    return written(docs.select(*COLUMNS).withColumn("__row", F.monotonically_increasing_id()), "numbered")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id.

    Null and empty texts are equal, so one row of them stays. Of rows that share the largest id as well one stays; a
    null id is less than any.
    """
    rows = _numbered(docs)
    dropped = settled(spark, "dropped", lambda: few(exact_duplicates(rows, row_col="__row").where("NOT kept").select("__row")))
    return rows.join(dropped, "__row", "left_anti").select(*COLUMNS)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id.

    Null, empty and blank texts have no shingles, are alike to nothing and stay. Rows that share an id and a text stay or
    go together; long texts are compared whole.
    """
    # Rows that share an id and a text stay or go together, so a hash of the text tells rows of one id apart.
    rows = docs.select(*COLUMNS).withColumn("__text", F.xxhash64("text"))
    dropped = settled(spark, "dropped", lambda: few(near_duplicates(rows, row_col="__text").where("NOT kept").select("doc_id", "__text")))
    return rows.join(dropped, ["doc_id", "__text"], "left_anti").select(*COLUMNS)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier place has; n_chars follows the text.

    Every row stays, if with an empty text. Null and empty texts are left as they are; rows that repeat count as
    documents of their own, so the later ones lose what the first has. Rows without a removal keep their n_chars.
    """
    cut = without_repeats(docs, keep=("lang", "source", "n_chars"))
    n_chars = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("__keep_2"))
    return few(cut.select("doc_id", "text", F.col("__keep_0").alias("lang"), F.col("__keep_1").alias("source"), n_chars.alias("n_chars")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of the documents, each with its sequence and place.

    A null or empty text is one piece of its end token. Rows that repeat are packed as often; long texts are cut into
    pieces and no token is lost.
    """
    return pack_documents(docs, rank_encoder(added="byte_bpe_50k.json"))


STAGES = [("quality", quality), ("exact_dedup", exact), ("minhash", near), ("substring", substrings), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


# A learned classifier and a tokenizer are not expressible in SQL.
ORACLE_SQL = None
