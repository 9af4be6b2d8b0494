"""Training corpus in five stages, each working on all that its predecessor kept.

quality classifier (rejected documents go) -> exact dedup (one of equal texts stays) -> n-gram Jaccard join
(one document of each group of near copies stays) -> mixing of sources to target weights (documents are
drawn) -> best-fit packing (pieces with their sequences). All stages but the last return the columns of
``documents``. Rows are known by their place in stored files: a stage that is given another kind of frame writes it first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldleaf.llm.block_naming import exact_duplicates
from goldleaf.llm.common import free_name, row_numbered, stored, written
from goldleaf.llm.mixing import mix
from goldleaf.llm.ngram_join import similar_documents
from goldleaf.llm.packing import pack_documents
from goldleaf.llm.pu_quality import keep_accepted
from goldleaf.sources.retail_views import read_test_table


def _rows_of(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows of ``docs`` (stored) whose number is in ``chosen`` (``uid``), with the columns of ``docs``."""
    uid = free_name(docs, "_uid")
    numbered = row_numbered(docs, uid)
    return numbered.join(chosen.select(F.col("uid").alias(uid)), uid, "left_semi").select(*docs.columns)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts (score of at least 0.7)."""
    return keep_accepted(docs, read_test_table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased) the document with the largest doc_id."""
    docs = stored(docs)
    return _rows_of(docs, exact_duplicates(docs).where("kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by 0.8 Jaccard similarity of five-word shingles the smallest doc_id.

    Documents without words are linked with nothing and stay. Groups are told apart by their rows, not by
    doc_id: ids may be null or repeat. A group without any id keeps its first row.
    """
    docs = stored(docs)
    linked = similar_documents(docs)
    first = linked.where("n_shingles > 0").groupBy("component").agg(
        F.min(F.when(F.col("doc_id").eqNullSafe(F.col("component_id")), F.col("uid"))).alias("uid"))
    return _rows_of(docs, first.select("uid").unionByName(linked.where("n_shingles = 0").select("uid")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that sources, languages and topics meet their target weights."""
    return mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens."""
    return pack_documents(docs).drop("uid")


STAGES = [
    ("quality_classifier", keep_good),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack_sequences),
]

ORACLE_SQL = None  # trained, sampled and tokenised stages: tested against brute-force versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again by the next."""
    docs = read_test_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{name}")
    return docs
