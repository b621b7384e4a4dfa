"""Plan checks: column pruning, pushed filters, partition pruning, and no
single-partition exchange on the raw-data path."""
from pyspark.sql import functions as F

from conftest import SF01
from tidewatch.operators.features import build_feature_set
from tidewatch.operators.panel import list_symbols
from tidewatch.sources.tables import daily_panel, events_series


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_panel_scan_prunes_columns(spark):
    import re
    plan = _plan(daily_panel(spark, SF01))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    fields = [sorted(f.split(":")[0] for f in s.split(",")) for s in schemas]
    assert ["o_custkey", "o_orderdate", "o_totalprice"] in fields
    assert ["c_custkey", "c_mktsegment"] in fields


def test_filter_pushed_into_scan(spark):
    ev = events_series(spark, SF01).where(F.col("symbol") == "click")
    plan = _plan(ev)
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,click)]" in plan


def test_features_have_no_single_partition_exchange_on_raw_path(spark):
    p = daily_panel(spark, SF01)
    fs = build_feature_set(p, "v3", symbols=list_symbols(p))
    main = fs.df._jdf.queryExecution().executedPlan().toString()
    # the only SinglePartition exchanges allowed are inside one-row
    # scalar-subquery aggregates (thresholds), never under a Window
    for line in main.splitlines():
        if "Exchange SinglePartition" in line:
            assert "Window" not in line
    assert "Exchange hashpartitioning(symbol" in main or "hashpartitioning(symbol" in main


def test_feature_store_load_prunes_partitions(spark, tmp_path):
    from tidewatch.plans.store import FeatureStore
    store = FeatureStore(spark, str(tmp_path / "fs"))
    p = daily_panel(spark, "/root/testdata/sf0.001")
    store.save(build_feature_set(p, "v1"), name="a")
    store.save(build_feature_set(p, "v2"), name="b")
    fs = store.load("b")
    files = fs.df.inputFiles()
    assert files and all("set_name=b" in f for f in files)
    assert fs.df.count() == p.select("ts").distinct().count()


def test_bounded_broadcast_only_below_the_bound(spark):
    from tidewatch.session import bounded_broadcast
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ev = events_series(spark, SF01)
        ref = ev.groupBy("symbol").agg(F.avg("value").alias("m"))
        small = _plan(ev.join(bounded_broadcast(ref, max_rows=100), "symbol"))
        big = _plan(ev.join(bounded_broadcast(ref, max_rows=2), "symbol"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in small
    assert "BroadcastHashJoin" not in big and "SortMergeJoin" in big


def test_counted_rows_decide_the_blocks(spark, monkeypatch):
    """Blocks follow from counted rows, and the rows are the same at every
    block count - NULL groups, NULL time stamps and ties included - on
    Parquet input and in memory."""
    import uuid
    from tidewatch.operators import features, ranks
    rows = [(s, t, v) for s in ("a", "b", None) for t, v in
            [(None, 5.0), *((i, None if i % 9 == 4 else float(i * 7 % 13)) for i in range(120))]]
    df = spark.createDataFrame(rows, "symbol string, ts int, price double")
    path = f"/tmp/tidewatch-checkpoints/test-{uuid.uuid4().hex}"
    df.repartition(4).write.parquet(path)
    stored = spark.read.parquet(path)
    assert ranks.choose_blocks(stored, ["symbol"], "price", None) == 1
    assert ranks.choose_blocks(stored, ["symbol"], "ts", None, block_rows=50) == 3

    def same(f):
        key = lambda r: str([x if not isinstance(x, float) else round(x, 9) for x in r])
        out = [sorted(map(key, f(stored, n).collect())) for n in (1, 2, 7)]
        assert out[0] == out[1] == out[2]
        return out[0]

    cum = same(lambda d, n: ranks.cumulative_counts(d, ["symbol"], "price", n_blocks=n))
    assert any(c.startswith("[None") for c in cum)
    same(lambda d, n: ranks.cumulative_counts(d, [], "price", n_blocks=n))
    same(lambda d, n: ranks.exact_quantiles(d, ["symbol"], "price", [0.25, 0.5, 0.9], n_blocks=n))
    one = features.series_features(stored)
    many = features.series_features(stored, block_rows=40)
    assert "_blk" not in _plan(one) and "_blk" in _plan(many)
    key = lambda r: str([round(x, 9) if isinstance(x, float) else x for x in r])
    assert sorted(map(key, one.collect())) == sorted(map(key, many.collect()))
    assert one.count() == len(rows)


def test_no_window_gathers_all_rows(spark):
    """No window of the ungrouped paths stands on a single-partition exchange."""
    from tidewatch.operators.ranks import cumulative_counts
    from tidewatch.operators.split import chronological_split
    df = spark.range(500).select(F.col("id").alias("ts"))
    for out in (cumulative_counts(df, [], "ts"), chronological_split(df, "ts")):
        lines = _plan(out).splitlines()
        for i, line in enumerate(lines):
            if "Window " in line:
                assert not any("Exchange SinglePartition" in x for x in lines[i:i + 4]), "\n".join(lines)


def test_ungrouped_rank_paths_have_no_cartesian_join(spark):
    """Blocked prefix sums, dense ranks and the chronological split without
    a grouping column: boundaries come from a scalar subquery and every join
    has an equi-key (a literal key would be folded into a cartesian join)."""
    from tidewatch.operators.ranks import cumulative_counts, dense_rank_of
    from tidewatch.operators.split import chronological_split, three_way_split
    df = spark.range(2000).select((F.col("id") % 97).cast("double").alias("v"),
                                  F.col("id").alias("ts"))
    for out in (cumulative_counts(df, [], "v", n_blocks=8),
                dense_rank_of(df, [], "v", n_blocks=8),
                chronological_split(df, "ts"),
                three_way_split(df, "ts")):
        plan = _plan(out)
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    got = {r.v: (r.n_cum, r.n_total) for r in cumulative_counts(df, [], "v", n_blocks=8).collect()}
    assert got[0.0] == (21, 2000) and got[96.0] == (2000, 2000)
