"""Physical-plan properties: pushdown, pruning, broadcast only when measured."""

from climark.plans import catalog
from tests.conftest import SF_MID

catalog.load_all()


def plan(spark, name):
    df = catalog.QUERIES[name](spark, SF_MID)
    return df._jdf.queryExecution().executedPlan().toString()


def test_station_filter_applied_on_broadcast_side(spark):
    # the station predicate reaches the measured supplier->station relation, so
    # rows of other stations are dropped at the join, before the shuffle
    p = plan(spark, "scan_station")
    assert "BroadcastHashJoin" in p and "= 3)" in p
    assert p.index("BroadcastHashJoin") > p.index("Exchange hashpartitioning")


def test_nothing_stays_cached_after_a_query(spark):
    before = set(spark.sparkContext._jsc.getPersistentRDDs())
    for name in ("boxplot_stats", "find_duplicates"):
        catalog.QUERIES[name](spark, SF_MID).count()
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) <= before


def test_lineitem_scan_is_pruned(spark):
    p = plan(spark, "monthly_climatology")
    scan = [line for line in p.split("\n") if "FileScan parquet" in line and "lineitem" in line][0]
    for unused in ("l_orderkey", "l_partkey", "l_returnflag", "l_linestatus", "l_linenumber"):
        assert unused not in scan


def test_batch_time_range_pushed_into_scan(spark):
    p = plan(spark, "find_duplicates")
    assert "GreaterThan(l_shipdate" in p or "GreaterThanOrEqual(l_shipdate" in p


def test_bridge_join_is_broadcast_after_size_check(spark):
    p = plan(spark, "monthly_climatology")
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_no_python_udf_in_sql_queries(spark):
    for name in ("correlation_matrix", "supervised_windows", "kde_curve", "boxplot_stats"):
        p = plan(spark, name)
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_duplicate_search_shuffles_two_columns_at_most(spark):
    import re
    for name in ("find_duplicates", "insert_guard"):
        for line in plan(spark, name).split("\n"):
            keys = re.search(r"Exchange hashpartitioning\(([^)]*)", line)
            if keys and "ENSURE_REQUIREMENTS" in line:
                columns = [c for c in keys.group(1).split(", ") if "#" in c]
                assert len(columns) <= 2, line


def test_integrity_report_reads_each_table_at_most_twice(spark):
    from climark.operators.integrity import constraint_violations
    from climark.schemas import TABLES
    from climark.session import scratch_path
    from climark.sources import tables as tb
    base = scratch_path(spark, "integrity-plan")
    tb.bootstrap_tables(spark, base)
    frames = [tb.read_table(spark, base, n) for n in TABLES]
    p = constraint_violations(*frames)._jdf.queryExecution().executedPlan().toString()
    for name in TABLES:
        assert 1 <= sum("FileScan" in line and f"/{name}]" in line for line in p.split("\n")) <= 2, name
    assert all(r.violations == 0 for r in constraint_violations(*frames).collect())
    assert constraint_violations(*frames).count() == 11
