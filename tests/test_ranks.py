"""Exact distributed order statistics against brute force; partition-count
invariance."""
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import drift as D
from tidewatch.operators.ranks import cumulative_counts, dense_rank_of, exact_quantiles


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(7)
    rows = [("a" if i % 3 else "b", float(rnd.randint(0, 40))) for i in range(700)]
    return rows, spark.createDataFrame(rows, "g string, v double")


@pytest.mark.parametrize("parts", [1, 8])
def test_exact_quantiles_match_numpy(spark, data, parts):
    rows, df = data
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
    got = exact_quantiles(df.repartition(parts), ["g"], "v", probs, n_blocks=5).collect()
    for r in got:
        vals = np.array([v for g, v in rows if g == r.g])
        assert math.isclose(r.q, float(np.quantile(vals, r.p)), rel_tol=1e-12, abs_tol=1e-12)


def test_cumulative_counts_match_brute_force(spark, data):
    rows, df = data
    cum = cumulative_counts(df, ["g"], "v", n_blocks=4).collect()
    for r in cum:
        vals = [v for g, v in rows if g == r.g]
        assert r.n_cum == sum(1 for v in vals if v <= r.v)
        assert r.n_total == len(vals)


def test_dense_rank_without_group(spark):
    df = spark.createDataFrame([(x,) for x in [5, 3, 3, 9, 1, 5]], "t int")
    got = {r.t: r.rank for r in dense_rank_of(df, [], "t", n_blocks=3).collect()}
    assert got == {1: 1, 3: 2, 5: 3, 9: 4}


def test_ks_and_mann_whitney_statistics_brute_force(spark):
    rnd = random.Random(3)
    ref = [float(rnd.randint(0, 12)) for _ in range(60)]
    cur = [float(rnd.randint(2, 14)) for _ in range(45)]
    rows = [("f", "ref", v) for v in ref] + [("f", "cur", v) for v in cur]
    long = spark.createDataFrame(rows, "feature string, side string, value double")
    st = D.numeric_drift_stats(long).first()
    grid = sorted(set(ref + cur))
    d = max(abs(sum(x <= g for x in ref) / 60 - sum(x <= g for x in cur) / 45) for g in grid)
    assert math.isclose(st.ks_statistic, d, rel_tol=1e-12)
    pooled = sorted(ref + cur)
    rank = {}
    for v in set(pooled):
        idx = [i + 1 for i, x in enumerate(pooled) if x == v]
        rank[v] = sum(idx) / len(idx)
    u1 = sum(rank[v] for v in ref) - 60 * 61 / 2
    assert math.isclose(st.mw_statistic, u1, rel_tol=1e-12)
    ties = sum(pooled.count(v) ** 3 - pooled.count(v) for v in set(pooled))
    assert st.tie_term == ties
    m1, m2 = np.mean(ref), np.mean(cur)
    sp = math.sqrt((59 * np.var(ref, ddof=1) + 44 * np.var(cur, ddof=1)) / 103)
    assert math.isclose(st.cohens_d, (m2 - m1) / sp, rel_tol=1e-9)


def test_single_window_path_equals_blocked(spark, data):
    rows, df = data
    auto = {(r.g, r.v): (r.n_cum, r.n_total) for r in cumulative_counts(df, ["g"], "v").collect()}
    blocked = {(r.g, r.v): (r.n_cum, r.n_total)
               for r in cumulative_counts(df, ["g"], "v", n_blocks=6).collect()}
    assert auto == blocked


def test_features_invariant_to_partitioning(spark):
    from tidewatch.operators.features import series_features
    rnd = random.Random(11)
    rows = [(s, d, None if rnd.random() < 0.2 else float(rnd.randint(1, 50)))
            for s in "abc" for d in range(80)]
    df = spark.createDataFrame(rows, "symbol string, ts int, price double")
    one = {(r.symbol, r.ts): (r.ret_pct, r.ma7, r.ma30)
           for r in series_features(df.repartition(1)).collect()}
    many = {(r.symbol, r.ts): (r.ret_pct, r.ma7, r.ma30)
            for r in series_features(df.repartition(8, "ts")).collect()}
    assert one == many


@pytest.mark.parametrize("buckets", [1, 7, 1024])
def test_quantiles_hot_value_and_no_group_use_equi_join(spark, buckets, monkeypatch):
    """A value holding a third of the rows spans many position buckets; the
    ungrouped lookup is an equi-join (no cartesian or nested-loop join)."""
    from tidewatch.operators import ranks
    monkeypatch.setattr(ranks, "QUANTILE_BUCKETS", buckets)
    rnd = random.Random(3)
    vals = [5.0 if i % 3 == 0 else float(rnd.randint(0, 60)) for i in range(900)]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    probs = [0.0, 0.1, 0.33, 0.5, 0.9, 1.0]
    q = exact_quantiles(df, [], "v", probs)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    got = {r.p: r.q for r in q.collect()}
    for p in probs:
        assert math.isclose(got[p], float(np.quantile(np.array(vals), p)), rel_tol=1e-12,
                            abs_tol=1e-12)
