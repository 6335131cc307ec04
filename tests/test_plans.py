"""Physical plans: broadcast of the checked dimension, pruning, partial aggregation."""

from logtide.plans.catalog import QUERIES
from logtide.session import new_work_dir
from logtide.streaming.sinks import read_by_type, write_by_type


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_clean_join_is_broadcast_left_outer(spark, sf001):
    p = plan(QUERIES["clean_flatten_enrich"](spark, sf001))
    assert "BroadcastHashJoin" in p and "LeftOuter" in p


def test_report_scan_reads_only_needed_columns_and_combines_map_side(spark, sf001):
    df = QUERIES["report_30m"](spark, sf001)
    p = plan(df)
    scan = [line for line in p.splitlines() if "events.parquet" in line or "FileScan parquet" in line]
    assert scan and all("value" not in line.split("ReadSchema")[-1] for line in scan if "ReadSchema" in line)
    assert p.count("HashAggregate") >= 2  # partial + final


def test_store_by_type_read_prunes_partitions_and_keeps_types(spark):
    rows = [("a", 1), ("01", 2), ("a", 3), ("1", 4), ("", 5), (None, 6)]
    path = new_work_dir(spark, "test-store")
    write_by_type(spark.createDataFrame(rows, "type string, v int"), path)
    read = read_by_type(spark, path, "a")
    assert "PartitionFilters: [isnotnull(type_folder" in plan(read)
    for t in {t for t, _ in rows}:
        got = sorted((r.type, r.v) for r in read_by_type(spark, path, t).collect())
        assert got == sorted((x, v) for x, v in rows if x == t)


def test_lateness_rows_meet_schedule_in_broadcast_join(spark, sf001):
    p = plan(QUERIES["late_rows"](spark, sf001))
    assert "SortMergeJoin" not in p
    assert "BroadcastHashJoin [window_end_ms" in p


def test_version_join_has_no_range_condition_and_no_window(spark, sf001):
    p = plan(QUERIES["area_as_of_version"](spark, sf001))
    assert "BroadcastHashJoin [batch_id" in p and "BroadcastHashJoin [_version" in p
    assert "Window" not in p and "NestedLoop" not in p and "Cartesian" not in p
