"""Mixing sources to target weights.

Every document gets a hash-random key.  Within its source the keys are
range-partitioned into buckets (the key's first three hex digits); bucket
sums and their running totals are the distributed prefix sums, and only the
one bucket in which a source's budget ends is sorted row by row, to cut at
the exact word.  Budgets above the source's size repeat whole epochs first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import materialize, whole_row
from tidewatch.session import bounded_broadcast

#: Regular expression of a word: a run of characters other than space, tab,
#: line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2.0
BUCKET_DIGITS = 3


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE,
                   max_epochs=MAX_EPOCHS) -> DataFrame:
    """(source, source_size, weight, target) from (source, source_size).

    One row per source, so the windows here see as many rows as there are
    sources.  Water-filling in closed form: with sources in order of
    cap / weight, the first ones are held at their cap; the level is the
    largest share of the rest that caps nobody further.
    """
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.col("position") - 1) % len(weights) + 1).cast("int"))
    order = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    s = (sizes.withColumn("position", F.row_number().over(order))
         .withColumn("weight", w)
         .withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
         .withColumn("ratio", F.col("cap") / F.col("weight")))
    whole = Window.partitionBy()
    up = Window.orderBy("ratio", "position").rowsBetween(Window.unboundedPreceding, -1)
    s = (s.withColumn("total", F.sum("source_size").over(whole) * F.lit(float(share)))
         .withColumn("before_cap", F.coalesce(F.sum("cap").over(up), F.lit(0.0)))
         .withColumn("left_weight", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(up), F.lit(0.0)))
         .withColumn("level", (F.col("total") - F.col("before_cap")) / F.col("left_weight"))
         .withColumn("level", F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(whole)))
    return s.select("source", "source_size", "weight",
                    F.when(F.col("level").isNull(), F.col("cap"))
                    .otherwise(F.least("cap", F.col("level") * F.col("weight"))).alias("target"))


def _row_key(id_col: str, text_col: str, source_col: str):
    """A key of a whole row's identity: id, source and text, null-safe."""
    text = F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary"))
    return F.md5(F.concat_ws("|", F.col(id_col).isNull().cast("string"), F.col(id_col).cast("string"),
                             F.col(source_col).isNull().cast("string"), F.col(source_col).cast("string"),
                             F.col(text_col).isNull().cast("string"), text).cast("binary"))


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source", weights=WEIGHTS, share=SHARE,
             max_epochs=MAX_EPOCHS, seed: str = "mix", row_key: bool = False) -> DataFrame:
    """One row per document: doc_id, size, source, source_size, target, taken.

    ``taken`` counts words of all epochs: each whole pass over the source
    takes the document once; the last, partial pass takes documents in key
    order and ends inside the document in which the budget is used up
    (targets are rounded down to whole words).  A null source is a source of
    its own (last in order), a null text has size 0, a null id has the key of
    the empty string.  Repeated rows are documents of their own; the order
    among equal keys is by id and size, so reruns agree.  Empty documents
    take 0 words; an empty table gives an empty plan.  Other columns are not
    read, so their names cannot clash.  ``row_key`` adds a key of the whole
    row (id, source, text), by which the rows of ``docs`` can be joined.
    """
    key = [_row_key(id_col, text_col, source_col).alias("row_key")] if row_key else []
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary")).alias("key"),
        *key)
    key = ["row_key"] if row_key else []
    rows = materialize(rows.withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS)))
    buckets = materialize(rows.groupBy("source", "bucket").agg(F.sum("size").alias("words")))
    sizes = buckets.groupBy("source").agg(F.sum("words").alias("source_size"))
    size, budget = F.col("source_size"), F.floor("target").cast("long")
    # Whole epochs, and the words left for the last pass.
    targets = materialize(source_targets(sizes, weights, share, max_epochs).select(
        F.col("source").alias("of"), "source_size", "target",
        F.when(size > 0, F.floor(budget / size)).otherwise(0).cast("long").alias("epochs"),
        F.when(size > 0, budget % size).otherwise(0).cast("long").alias("rest")))
    run = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    prefix = buckets.withColumn("start", F.coalesce(F.sum("words").over(run), F.lit(0)))
    cut = (prefix.join(targets, F.col("source").eqNullSafe(F.col("of")))
           .where((F.col("start") <= F.col("rest")) & (F.col("start") + F.col("words") > F.col("rest")))
           .select(F.col("source").alias("cut_source"), F.col("bucket").alias("cut"),
                   F.col("start").alias("cut_start")))
    # One row per source: shipped whole while it is small, so that a source
    # with a third of all documents is not gathered by a join.
    sources = bounded_broadcast(materialize(
        targets.join(cut, F.col("of").eqNullSafe(F.col("cut_source")), "left").drop("cut_source")))
    placed = rows.join(sources, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    plain = placed.where("cut is null or bucket <> cut").withColumn(
        "extra", F.when(F.col("bucket") < F.col("cut"), F.col("size")).otherwise(0))
    order = (Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size", *key)
             .rowsBetween(Window.unboundedPreceding, -1))
    inside = (placed.where("bucket = cut")
              .withColumn("at", F.col("cut_start") + F.coalesce(F.sum("size").over(order), F.lit(0)))
              .withColumn("extra", F.greatest(F.lit(0), F.least("size", F.col("rest") - F.col("at"))))
              .drop("at"))
    return plain.unionByName(inside).select(
        "doc_id", "size", "source", "source_size", "target",
        (F.col("epochs") * F.col("size") + F.col("extra")).cast("long").alias("taken"), *key)


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  source_col: str = "source", **options) -> DataFrame:
    """The mix itself, with the columns of ``docs``: each document once per
    whole epoch, and once more cut after its first words where the last pass
    ends inside it.  Documents without words are kept once.  Rows that agree
    in id, source and text share the words the plan gives to them.

    Other columns come along, whatever their names; ``n_chars`` counts the
    characters of a cut text.  Null sources, texts and ids, repeated rows and
    empty tables: see :func:`mix_plan`."""
    plan = (mix_plan(docs, id_col, text_col, source_col, row_key=True, **options)
            .groupBy("row_key", "size").agg(F.sum("taken").alias("taken"), F.count("*").alias("rows")))
    # Repeated rows fold into one; its copies are then all of theirs.
    once = Window.partitionBy("key").orderBy("key")
    joined = (docs.select(whole_row(docs, but=text_col).alias("row"), F.col(text_col).alias("text"),
                          _row_key(id_col, text_col, source_col).alias("key"))
              .join(plan, F.col("key") == F.col("row_key"))
              .withColumn("nth", F.row_number().over(once)).where("nth = 1"))
    whole = F.when(F.col("size") == 0, F.col("rows")).otherwise(F.floor(F.col("taken") / F.col("size")))
    rest = F.when(F.col("size") == 0, 0).otherwise(F.col("taken") % F.col("size"))
    head = F.regexp_substr(F.col("text"), F.concat(
        F.lit(r"^[\x20\x09-\x0D]*+(?:[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+){"),
        F.col("rest").cast("string"), F.lit("}+")))
    copies = joined.withColumn("whole", whole).withColumn("rest", rest).where("whole > 0 or rest > 0")
    copies = copies.withColumn("copy", F.explode(F.sequence(
        F.lit(1), (F.col("whole") + F.when(F.col("rest") > 0, 1).otherwise(0)).cast("int"))))
    is_whole = F.col("copy") <= F.col("whole")

    def column(name: str) -> Column:
        if name == text_col:
            return F.when(is_whole, F.col("text")).otherwise(head).alias(name)
        own = F.col("row").getField(name)
        if name == "n_chars":  # a cut text has fewer
            own = F.when(is_whole, own).otherwise(F.length(head)).cast(docs.schema[name].dataType)
        return own.alias(name)

    return copies.select(*[column(c) for c in docs.columns])
