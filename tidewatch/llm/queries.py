"""The registered queries: each applies one operator, with production
parameters, to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import (chain_dedup, collocations, hamming_join, hamming_search, maxscore, mixing, paragraph_sketch,
                           sentence_pieces, skip_fim, suffix_dedup, toxicity, url_rules, warc)
from tidewatch.llm.common import table


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.tokenise(spark, table(spark, sf_dir, "documents"), keep=["doc_id"])


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), keep=["page_id"])


def op4_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chain_dedup.passages(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_texts(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return scored.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxscore.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming_search.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming_join.near_duplicates(table(spark, sf_dir, "documents"), k=2, percent=80)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = skip_fim.fill_in_middle(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(skip_fim.restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = paragraph_sketch.fingerprints(table(spark, sf_dir, "documents"))
    return made.select("doc_id", F.length("text").cast("long").alias("n_chars"),
                       F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                       "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {n: f for n, f in globals().items() if n.startswith("op") and callable(f)}
    return dict(sorted(own.items(), key=lambda x: int(x[0][2:].split("_")[0])))
