"""Corpus pipeline: toxicity filter, near-duplicate removal, passage removal,
mixing to source weights, tokenising.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and read again as the next
stage's documents.  All but the last return the columns of ``documents``.
No SQL statement expresses a trained classifier or a tokenizer, so
``ORACLE_SQL`` is None and the stages are tested against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import chain_dedup, hamming_join, mixing, sentence_pieces, toxicity
from tidewatch.llm.common import materialize, ship_code, table, whole_row

ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose whole text scores below one half.

    Null and empty texts have the score of a text without evidence, and stay.
    Rows are judged one by one: repeated rows and ids, null ids and further
    columns change nothing, and an empty table stays empty."""
    ship_code(spark)
    model = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    rows = docs.select(whole_row(docs).alias("row"), F.col("text").alias("text"))
    scored = toxicity.score_texts(rows, model, keep=["row"])
    return scored.where(F.col("score") < 0.5).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group that is linked by
    five-word shingles at a similarity of 0.8.

    Rows with a null id and texts without words (null and empty ones among
    them) stay.  Of rows of one id, each text is a document of its own, and of
    rows of the same id and text one stays, the smallest in all columns.  An
    empty table stays empty; further columns come along, whatever their names."""
    ship_code(spark)
    rows = docs.select(whole_row(docs).alias("row"), F.col("doc_id").cast("bigint").alias("id"),
                       hamming_join.text_key("text").alias("key"))
    judged = materialize(hamming_join.near_duplicates(docs, k=5, percent=80, texts=True).where("group is not null")
                         .select(F.col("doc_id").alias("id"), F.col("text_key").alias("key"), "group", "kept"))
    # An id may come with several texts, and a text several times.
    best = (judged.where("kept").groupBy("group").agg(F.min(F.struct("id", "key")).alias("best"))
            .select("best.*"))
    counts = judged.groupBy("id", "key").count()
    gone = counts.select("id", "key").join(best, ["id", "key"], "left_anti")
    repeated = materialize(counts.where("count > 1").select("id", "key").join(best, ["id", "key"], "left_semi"))
    single = rows.join(gone.unionByName(repeated), ["id", "key"], "left_anti").select("row")
    one = rows.join(repeated, ["id", "key"], "left_semi").groupBy("id", "key").agg(F.min("row").alias("row")).select("row")
    return single.unionByName(one).select("row.*")


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a document of smaller id has; see
    ``chain_dedup.drop_passages`` for nulls, repeats, empty tables and names."""
    ship_code(spark)
    return chain_dedup.drop_passages(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources at their target weights; see
    ``mixing.mix_documents`` for nulls, repeats, empty tables and names."""
    ship_code(spark)
    return mixing.mix_documents(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang and source of each row, its ids, their number and the text
    they spell; see ``sentence_pieces.tokenise`` for nulls and repeats."""
    ship_code(spark)
    return sentence_pieces.tokenise(spark, docs, keep=["doc_id", "lang", "source"])


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("passages", drop_passages),
    ("mixing", mix_sources),
    ("tokens", tokenise),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
