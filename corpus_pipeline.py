"""A corpus pipeline of five stages, each an operator of ``weft.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet and hands what it reads back to the next.  All stages but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm import decontam, jaccard, language, packing, secret_scan
from weft.llm.common import fold, fresh, stored
from weft.llm.registry import tokenizer_file
from weft.sources.tables import table

MIN_LANGUAGE_SCORE = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: null or letterless texts, and
    those whose language the network can hardly tell."""
    net = language.train(docs, F.coalesce(fold("doc_id", 3) != 1, F.lit(False)))
    lang, score = fresh("lang_pred", docs.columns), fresh("score", docs.columns)
    told = language.with_language(docs, net, docs.columns, lang, score)
    known = (F.col(lang) != language.UNKNOWN) & (F.col(score) >= MIN_LANGUAGE_SCORE)
    return told.where(known).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each component of similar ones: the smallest
    doc_id.  Rows that share a doc_id, or lack one, are documents by their
    text and come after all others; of rows with equal doc_id and text the
    least one stays.  Rows without doc_id and words all stay."""
    node, shared, first = (fresh(c, docs.columns) for c in ("node", "shared", "first"))
    doc_id = F.col("doc_id").cast("long")

    def of_text(*key):  # from 2^62 up, above the doc_ids
        return F.xxhash64(*key).bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))

    repeated = stored(docs.where("doc_id is not null").groupBy(doc_id.alias(shared)).agg(F.count(F.lit(1)).alias("n"))
                      .where("n > 1").select(shared), "repeated-ids")
    rows, is_shared = docs, F.lit(False)
    if not repeated.isEmpty():  # else no join, and so no shuffle of texts
        rows, is_shared = docs.join(repeated, doc_id == F.col(shared), "left"), F.col(shared).isNotNull()
    worded = F.col("text").rlike(r"[^\x20\x09-\x0D]")
    rows = rows.select(*docs.columns, F.when(is_shared, of_text(doc_id, "text")).when(doc_id.isNotNull(), doc_id)
                       .when(worded, of_text("text")).alias(node))
    named = rows.where(F.col(node).isNotNull())
    kept = jaccard.components(named.select(F.col(node).alias("doc_id"), "text")).where(
        "component_id = doc_id").select(F.col("doc_id").alias(first)).distinct()
    kept = named.join(kept, F.col(node) == F.col(first), "left_semi")
    # nodes with an id of their own have one row; the others may have equal ones
    own = F.col(node) < (1 << 62)
    least = kept.where(~own).groupBy(node).agg(F.min(F.struct(*docs.columns)).alias(first)).select(f"{first}.*")
    return kept.where(own).select(*docs.columns).unionByName(least).unionByName(
        rows.where(F.col(node).isNull()).select(*docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of the benchmark."""
    return decontam.without_overlaps(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks secrets; every document stays."""
    return secret_scan.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    return packing.pack(docs, tokenizer_file("byte_bpe_50k.json"), end_id=0, capacity=2048)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]

# Trained models and a packing order cannot be told in SQL; the stages are
# tested against brute-force versions in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
