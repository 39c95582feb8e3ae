"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postfeed.llm.bpe import prefix_encoder, round_trip
from postfeed.llm.brown import scores
from postfeed.llm.common import table, written
from postfeed.llm.exact_dedup import exact_duplicates
from postfeed.llm.filter_audit import audit_documents
from postfeed.llm.merkle import verified_documents
from postfeed.llm.minhash import near_duplicates
from postfeed.llm.packing import pack_documents
from postfeed.llm.quality import score, train
from postfeed.llm.rollup import Rollup, deletes, inserts, revisions, token_counts
from postfeed.llm.substring import without_repeats
from postfeed.llm.tokenizers_public import rank_encoder
from postfeed.llm.urls import filter_urls, path_of
from postfeed.llm.vectors import near_vectors
from postfeed.llm.warc import archived_pages
from postfeed.session import scratch_path


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page is labelled by the quality of the document whose number its path has."""
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    number = F.expr("try_cast(regexp_extract(path, '/([0-9]+)', 1) AS bigint)")
    shown = pages.select("url", path_of(F.col("url")).alias("path")).select("url", number.alias("doc_id"))
    return filter_urls(pages, shown.join(labels, "doc_id").select("url", F.col("quality").alias("label")))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), rank_encoder(added="byte_bpe_50k.json"))


def op3_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as public

    encoder = prefix_encoder(public.path("byte_bpe_50k.tiktoken"), public.PATTERN)
    return round_trip(table(spark, sf_dir, "documents"), encoder)


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return score(documents, train(documents, table(spark, sf_dir, "labels")))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents are loaded, counted anew by a second tokenizer version and without their outer white space,
    and toxic ones deleted; the first batch is committed twice."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    versions = {"byte_bpe_50k": rank_encoder(), "byte_bpe_multi_50k": rank_encoder("byte_bpe_multi_50k.tiktoken")}
    versions["stripped"] = rank_encoder(prepare=str.strip)
    counted = written(token_counts(documents, versions), "token-counts")
    toxic = counted.join(labels.where("toxic = 1").select("doc_id").distinct(), "doc_id", "left_semi")
    rollup = Rollup(spark, scratch_path(spark, "rollup"))
    for _ in range(2):
        rollup.commit("load", inserts(counted, "byte_bpe_50k", "byte_bpe_50k"))
    rollup.commit("second-version", inserts(counted, "byte_bpe_multi_50k", "byte_bpe_multi_50k"))
    rollup.commit("revised", revisions(counted, "byte_bpe_50k", "byte_bpe_50k", "stripped"))
    gone = deletes(toxic, "byte_bpe_50k", "stripped").unionByName(deletes(toxic, "byte_bpe_multi_50k", "byte_bpe_multi_50k"))
    rollup.commit("toxic-gone", gone)
    return rollup.totals()


def op9_brown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(table(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_pages(table(spark, sf_dir, "pages"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verified_documents(table(spark, sf_dir, "documents"))


QUERIES = (
    op1_url_filter, op2_packing, op3_near_vectors, op4_byte_bpe, op5_minhash, op6_quality, op7_exact_dedup,
    op8_token_counts, op9_brown, op10_substring_dedup, op11_warc, op12_filter_audit,
    op13_merkle,
)


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}
