"""Registered queries of this folder: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm import (decontam, edit_counts, filter_audit, iblt, jaccard, language, lm, merkle, orc_ids, packing,
                      secret_scan, tool_calls, toxicity)
from weft.llm.common import fold
from weft.sources.tables import table


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 7) == 2
    got = lm.score(docs, F.coalesce(~held_out, F.lit(False)))
    return got.withColumn("held_out", F.coalesce(held_out, F.lit(False)))


def op2_edit_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, tokenizer = table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json")
    done = edit_counts.apply_edits(edit_counts.build_trees(docs, tokenizer, edit_counts.sample_edits()), tokenizer)
    return done.select("doc_id", "n_tokens", "edited_tokens", F.length("text").alias("edited_chars"),
                       F.size("leaf_chars").alias("leaves"), "encoded_chars")


def op3_iblt_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iblt.fingerprints(table(spark, sf_dir, "documents"))


def op4_forest_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "nth", "start", F.length("value").alias("n_chars"),
                        F.sha2("value", 256).alias("value_sha256"), "score", "is_secret")


def op5_byte_conv_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 3) == 1
    net = language.train(docs, ~held_out)
    got = language.with_language(docs, net, ["doc_id"])
    return got.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op6_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, tokenizer_file("byte_bpe_50k.json"), end_id=0, capacity=2048)


def op7_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = tool_calls.exchanges_of(table(spark, sf_dir, "conversations"))
    out = tool_calls.in_order(tool_calls.link(calls, results, tool_calls.SCHEMAS))
    return out.withColumn("errors", F.to_json("errors"))


def op8_orc_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return orc_ids.round_trip(docs, tokenizer_file("word_bpe_49k.json"), end_id=2)


def op9_spaced_seed_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_prefix_tree_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components(table(spark, sf_dir, "documents"))


def op11_lehmer_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_weak_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold("doc_id", 3) == 1
    got = toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                         F.coalesce(~held_out, F.lit(False)),
                         {"doc_id": F.col("doc_id"), "held_out": F.coalesce(held_out, F.lit(False))})
    return got.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op13_merkle_superblocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    grown = F.col("n_chars") + F.when(fold("doc_id", 7) == 0, 1).otherwise(0)
    return merkle.manifest(table(spark, sf_dir, "documents"), shown={"n_chars": grown}, proofs=False)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    return {"pipeline": corpus_pipeline.run} | {f.__name__: f for f in (
        op1_deleted_interpolation, op2_edit_token_counts, op3_iblt_fingerprints, op4_forest_secret_scan,
        op5_byte_conv_language, op6_sum_of_squares_packing, op7_tool_call_linking, op8_orc_token_ids, op9_spaced_seed_overlaps,
        op10_prefix_tree_join, op11_lehmer_filter_audit, op12_weak_toxicity, op13_merkle_superblocks)}


def oracle_sql() -> dict[str, str]:
    return {"op7_tool_call_linking": tool_calls.ORACLE_SQL, "op11_lehmer_filter_audit": filter_audit.ORACLE_SQL,
            "op13_merkle_superblocks": merkle.ORACLE_SQL}
