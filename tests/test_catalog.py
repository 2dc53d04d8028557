"""Driver contract: entry(), queries() and oracle_sql() line up."""

import __spark_entry__ as E


def test_oracles_cover_queries():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 40


def test_entry_runs(spark):
    df = E.entry(spark)
    assert set(df.columns) == {"fn", "series", "window_end_ns", "value", "key", "line"}
    assert df.count() > 0


def test_queries_build_plans(spark):
    # every batch query must analyse (schema resolution) at sf0.001
    for name, fn in E.queries().items():
        if name.endswith("_stream") or name == "agg_stream_closed":
            continue
        df = fn(spark, "/root/testdata/sf0.001")
        assert df.columns, name


def test_single_scan_plans(spark):
    """The router, the one-pass aggregate and the mixed-kind snapshot query read events once."""
    for name in ("route_all", "agg_multi", "spark_points", "explode_fields", "stage_counts"):
        df = E.queries()[name](spark, "/root/testdata/sf0.001")
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == 1, name
