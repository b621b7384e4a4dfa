"""Exact order statistics without a single-partition window.

``cumulative_counts`` is the shared building block of the chronological
split (F5), exact quantiles (E2/E9/E10), the ECDF of the KS test (I5) and
the mid-ranks of the Mann-Whitney test (I6):

1. pre-aggregate to distinct ``(group, value)`` with summed weights, so a
   hot value (even a third of all rows) collapses to one row;
2. cut every group's value range into ``n_blocks`` blocks at approximate
   quantiles (``percentile_approx`` - bounded memory; only balance depends
   on it, never correctness);
3. running sums inside ``(group, block)`` window partitions, plus the
   exact offset of each block from a window over the tiny
   ``groups x blocks`` totals frame.

The number of blocks follows from the counted distinct values: a block holds
about ``BLOCK_ROWS`` of the largest group.  A group that fits one block is
one window; NULL groups are groups like any other at every block count.

No task sorts more than about one block, and the result does not depend on
the number of blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Distinct values of a group that one window partition holds.
BLOCK_ROWS = 1_000_000
# Without grouping columns the window is partitioned by the block alone, so
# there are always a few.
MIN_UNGROUPED_BLOCKS = 8
# Position buckets per group for the quantile lookup join (see exact_quantiles).
QUANTILE_BUCKETS = 1024


def choose_blocks(df: DataFrame, group_cols: list[str], value_col: str, n_blocks: int | None,
                  block_rows: int | None = None) -> int:
    """Blocks so that the largest group has about ``block_rows`` distinct
    values in each.  Rows are counted first (for a written table, from its
    file footers); distinct values only if the rows exceed a block."""
    if n_blocks is not None:
        return n_blocks
    block_rows = block_rows or BLOCK_ROWS
    least = 1 if group_cols else MIN_UNGROUPED_BLOCKS
    if df.count() <= block_rows:
        return least
    keyed = df.select(*group_cols, value_col).distinct()
    largest = keyed.groupBy(*group_cols).count().agg(F.max("count")).first()[0] or 0
    return max(least, -(-largest // block_rows))


def _null_safe(left: DataFrame, right: DataFrame, cols: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match; the right side's keys are dropped."""
    other = right.select(*[F.col(c).alias(f"_r_{c}") if c in cols else F.col(c) for c in right.columns])
    cond = None
    for c in cols:
        one = F.col(c).eqNullSafe(F.col(f"_r_{c}"))
        cond = one if cond is None else cond & one
    return left.join(other, cond, how).drop(*[f"_r_{c}" for c in cols])


def cumulative_counts(df: DataFrame, group_cols: list[str], value_col: str,
                      weights: dict[str, Column] | None = None,
                      n_blocks: int | None = None, accuracy: int = 10000) -> DataFrame:
    """One row per distinct ``(group, value)`` with, for every weight ``w``:
    ``w`` (sum at that value), ``w_cum`` (running sum up to and including the
    value) and ``w_total`` (group total).  NULL values are dropped.

    ``weights`` maps output names to per-row expressions; default ``n = 1``.
    """
    weights = weights or {"n": F.lit(1)}
    # No grouping columns is handled natively: a literal key would be
    # constant-folded by the optimizer and turn the joins into cartesian
    # products.  The one row of bounds is attached as literals instead, and
    # the offset join keys on the block alone.
    src = df.where(F.col(value_col).isNotNull())
    keyed = src.groupBy(*group_cols, value_col).agg(
        *[F.sum(expr).cast("long").alias(name) for name, expr in weights.items()])
    names = list(weights)
    n_blocks = choose_blocks(df, group_cols, value_col, n_blocks)
    if n_blocks <= 1 and group_cols:
        # one block: one window partition per group
        wr = Window.partitionBy(*group_cols).orderBy(value_col).rowsBetween(
            Window.unboundedPreceding, 0)
        wt = Window.partitionBy(*group_cols)
        return keyed.select(*group_cols, value_col, *names,
                            *[F.sum(n).over(wr).alias(f"{n}_cum") for n in names],
                            *[F.sum(n).over(wt).alias(f"{n}_total") for n in names])

    probs = [i / n_blocks for i in range(1, n_blocks)]
    if probs and group_cols:
        bounds = keyed.groupBy(*group_cols).agg(
            F.percentile_approx(value_col, probs, accuracy).alias("_bounds"))
        # groups x blocks boundary values: small; AQE broadcasts it when the
        # measured size allows, otherwise it is a shuffled equi-join.
        blocked = _null_safe(keyed, bounds, group_cols)
    elif probs:
        # One row of n_blocks - 1 boundary values (one small job): attached
        # as literals, so no join is needed.  They only balance the blocks;
        # the running sums stay exact whatever they are.
        row = keyed.agg(F.percentile_approx(value_col, probs, accuracy).alias("_b")).first()
        bvals = [v for v in (row["_b"] or []) if v is not None]
        blocked = keyed.withColumn("_bounds", F.array(*[F.lit(v) for v in bvals])) if bvals \
            else keyed.withColumn("_bounds", F.array(F.col(value_col))).withColumn(
                "_bounds", F.filter("_bounds", lambda b: F.lit(False)))
    if probs:
        blocked = blocked.withColumn(
            "_block", F.size(F.filter("_bounds", lambda b: b < F.col(value_col)))).drop("_bounds")
    else:
        blocked = keyed.withColumn("_block", F.lit(0))

    totals = blocked.groupBy(*group_cols, "_block").agg(
        *[F.sum(n).alias(f"_bt_{n}") for n in names])
    if group_cols:
        wb = Window.partitionBy(*group_cols).orderBy("_block")
        offsets = totals.select(
            *group_cols, "_block",
            *[F.coalesce(F.sum(f"_bt_{n}").over(wb.rowsBetween(Window.unboundedPreceding, -1)),
                         F.lit(0)).alias(f"_off_{n}") for n in names],
            *[F.sum(f"_bt_{n}").over(Window.partitionBy(*group_cols)).alias(f"{n}_total")
              for n in names])
    else:
        # one short array of n_blocks totals instead of a window over all
        parts = totals.agg(F.array_sort(F.collect_list(F.struct(
            "_block", *[f"_bt_{n}" for n in names]))).alias("_all"))
        running = lambda upto, n: F.aggregate(
            upto, F.lit(0).cast("long"), lambda acc, x: acc + x[f"_bt_{n}"])
        before = lambda x: F.filter("_all", lambda y: y["_block"] < x["_block"])
        offsets = parts.select(F.explode(F.transform("_all", lambda x: F.struct(
            x["_block"].alias("_block"),
            *[running(before(x), n).alias(f"_off_{n}") for n in names],
            *[running(F.col("_all"), n).alias(f"{n}_total") for n in names]))).alias("_o")).select("_o.*")
    wl = Window.partitionBy(*group_cols, "_block").orderBy(value_col).rowsBetween(
        Window.unboundedPreceding, 0)
    local = blocked.select(*group_cols, "_block", value_col, *names,
                           *[F.sum(n).over(wl).alias(f"_loc_{n}") for n in names])
    out = _null_safe(local, offsets, [*group_cols, "_block"])
    return out.select(*group_cols, value_col, *names,
                      *[(F.col(f"_loc_{n}") + F.col(f"_off_{n}")).alias(f"{n}_cum") for n in names],
                      *[F.col(f"{n}_total") for n in names])


def dense_rank_of(df: DataFrame, group_cols: list[str], value_col: str,
                  n_blocks: int | None = None) -> DataFrame:
    """``(group, value, rank, n_distinct)``: 1-based rank among the distinct
    values of each group (e.g. the position of a date in the calendar)."""
    cum = cumulative_counts(df.select(*group_cols, value_col).distinct(), group_cols,
                            value_col, n_blocks=n_blocks)
    return cum.select(*group_cols, value_col, F.col("n_cum").alias("rank"),
                      F.col("n_total").alias("n_distinct"))


def exact_quantiles(df: DataFrame, group_cols: list[str], value_col: str,
                    probs: list[float], n_blocks: int | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (pandas ``quantile``,
    DuckDB ``quantile_cont``, Spark ``percentile``), computed without
    gathering any group into one buffer.

    Returns ``(group..., p, q)``.  For rank h = (n-1)p the two neighbouring
    order statistics are found by range-matching the cumulative counts.
    """
    cum = cumulative_counts(df, group_cols, value_col, n_blocks=n_blocks)
    cum = cum.withColumn("_before", F.col("n_cum") - F.col("n"))
    # Positions 0..n-1 of each group are cut into at most QUANTILE_BUCKETS
    # buckets of width w.  A cumulative row (positions [_before, n_cum)) is
    # copied into every bucket it overlaps - at most rows + buckets copies
    # per group, even for one hot value - and each target position goes to
    # its one bucket, so the lookup is an equi-join on (group, bucket) plus
    # a range filter: no cartesian or nested-loop join, no group in one task.
    width = F.greatest(F.lit(1), F.ceil(F.col("n_total") / F.lit(QUANTILE_BUCKETS))).cast("long")
    cum = cum.withColumn("_bk", F.explode(F.sequence(
        F.floor(F.col("_before") / width).cast("long"),
        F.floor((F.col("n_cum") - 1) / width).cast("long"))))
    p_arr = F.array(*[F.lit(float(p)) for p in probs])
    # targets: two rows per (group, p) - the neighbouring order statistics
    tot = cum.groupBy(*group_cols).agg(F.max("n_total").alias("_n"))
    tgt = (tot.select(*[F.col(g).alias(f"_t_{g}") for g in group_cols], "_n",
                      F.explode(p_arr).alias("p"))
           .withColumn("_h", (F.col("_n") - 1) * F.col("p"))
           .withColumn("_frac", F.col("_h") - F.floor("_h"))
           .select("*", F.explode(F.array(
               F.struct(F.lit("lo").alias("_which"), F.floor("_h").cast("long").alias("_pos")),
               F.struct(F.lit("hi").alias("_which"), F.ceil("_h").cast("long").alias("_pos"))))
               .alias("_t"))
           .select(*[f"_t_{g}" for g in group_cols], "p", "_frac", "_t._which", "_t._pos",
                   (F.floor(F.col("_t._pos") / F.greatest(F.lit(1), F.ceil(
                       F.col("_n") / F.lit(QUANTILE_BUCKETS)))).cast("long")).alias("_t_bk")))
    cond = [F.col(g).eqNullSafe(F.col(f"_t_{g}")) for g in group_cols]
    cond.append(F.col("_bk") == F.col("_t_bk"))
    cond_all = cond[0]
    for c in cond[1:]:
        cond_all = cond_all & c
    hit = (F.col("_before") <= F.col("_pos")) & (F.col("_pos") < F.col("n_cum"))
    joined = cum.join(tgt, cond_all & hit)
    agg = joined.groupBy(*group_cols, "p").agg(
        F.max(F.when(F.col("_which") == "lo", F.col(value_col))).alias("_vlo"),
        F.max(F.when(F.col("_which") == "hi", F.col(value_col))).alias("_vhi"),
        F.first("_frac").alias("_frac"))
    return agg.select(*group_cols, "p",
                      (F.col("_vlo") + F.col("_frac") * (F.col("_vhi") - F.col("_vlo"))).alias("q"))
