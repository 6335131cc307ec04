"""Watermark ledger, late split and firings against hand-made and random cases."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logtide.operators import lateness
from replay_model import replay

T0 = 1_704_067_200_000  # 2024-01-01 00:00:00 UTC
MIN = 60_000
HALF_HOUR = 30 * MIN


def rows_df(spark, rows):
    data = [(str(i), b, t, "gate", k) for i, (b, t, k) in enumerate(rows)]
    return spark.createDataFrame(data, "key string, batch_id long, time_ms long, type string, area string")


def hms(h, m, s):
    return T0 + ((h * 60 + m) * 60 + s) * 1000


HAND_MADE = [
    (0, hms(0, 0, 5), "A"), (0, hms(0, 29, 0), "A"),
    (1, hms(0, 30, 20), "A"),
    (2, hms(0, 10, 0), "A"), (2, hms(0, 30, 41), "A"),
    (3, hms(0, 20, 0), "A"), (3, hms(0, 31, 0), "A"),
    (4, hms(1, 2, 0), "A"),
]


def test_hand_made_case(spark):
    cls = lateness.classify(rows_df(spark, HAND_MADE), HALF_HOUR)
    late = [r.time_ms for r in lateness.late_rows(cls).collect()]
    assert late == [hms(0, 20, 0)]
    fir = sorted((r.window_start_ms, r.fire_batch, r["count"], r.time) for r in lateness.firings(cls).collect())
    assert fir == [
        (hms(0, 0, 0), 1, 2, "2024-01-01 00:29:00"),
        (hms(0, 0, 0), 2, 3, "2024-01-01 00:29:00"),
        (hms(0, 30, 0), 4, 3, "2024-01-01 00:31:00"),
    ]
    final = sorted((r.window_start_ms, r["count"]) for r in lateness.final_report(cls).collect())
    assert final == [(hms(0, 0, 0), 3), (hms(0, 30, 0), 3)]  # 01:00 window stays open
    docs = sorted((r.doc_id, r["count"]) for r in lateness.firing_documents(lateness.firings(cls)).collect())
    assert docs == [("2024-01-01_00:29:00-gate-A", 3), ("2024-01-01_00:31:00-gate-A", 3)]


def test_ledger_watermarks(spark):
    led = {r.batch_id: (r.wm_before, r.wm_after) for r in lateness.ledger(rows_df(spark, HAND_MADE)).collect()}
    assert led[0] == (-10_000, hms(0, 28, 50))
    assert led[1] == (hms(0, 28, 50), hms(0, 30, 10))
    assert led[3] == (hms(0, 30, 31), hms(0, 30, 50))


row_strategy = st.lists(
    st.tuples(st.integers(0, 5), st.integers(0, 240).map(lambda s: T0 + s * 1000), st.sampled_from(["A", "B"])),
    min_size=1, max_size=40)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=row_strategy)
def test_matches_record_by_record_replay(spark, rows):
    size = 30_000
    want_late, want_fire = replay(rows, size)
    cls = lateness.classify(rows_df(spark, rows), size)
    got_late = {int(r.key) for r in lateness.late_rows(cls).collect()}
    assert got_late == want_late
    acc = lateness.on_time(cls).count()
    assert acc + len(got_late) == len(rows)
    got_fire = sorted((r.window_start_ms, r.area, r.fire_batch, r["count"]) for r in lateness.firings(cls).collect())
    assert got_fire == sorted((ws, k, b, n) for ws, k, b, n, _ in want_fire)
    # the group-level path gives the same firings and accepted report
    grp = lateness.classify_groups(rows_df(spark, rows), size)
    got_grp = sorted((r.window_start_ms, r.area, r.fire_batch, r["count"]) for r in lateness.firings(grp).collect())
    assert got_grp == got_fire
    acc_rows = sorted(tuple(r) for r in lateness.accepted_report(cls).collect())
    assert sorted(tuple(r) for r in lateness.accepted_report(grp).collect()) == acc_rows
    # cumulative counts never shrink within a window
    by_win = {}
    for ws, k, b, n in got_fire:
        assert n >= by_win.get((ws, k), 0)
        by_win[(ws, k)] = n


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=row_strategy, inputs=st.lists(st.integers(0, 2), min_size=60, max_size=60), idle=st.integers(0, 3))
def test_inputs_match_record_by_record_replay(spark, rows, inputs, idle):
    inputs = inputs[:len(rows)]
    want_late, want_fire = replay(rows, 30_000, inputs=inputs, idle=idle)
    df = rows_df(spark, rows).join(spark.createDataFrame([(str(i), x) for i, x in enumerate(inputs)], "key string, input int"), "key")
    cls = lateness.classify(df, 30_000, input_col="input", idle_batches=idle)
    assert {int(r.key) for r in lateness.late_rows(cls).collect()} == want_late
    grp = lateness.classify_groups(df, 30_000, input_col="input", idle_batches=idle)
    got = sorted((r.window_start_ms, r.area, r.fire_batch, r["count"]) for r in lateness.firings(grp).collect())
    assert got == sorted((ws, k, b, n) for ws, k, b, n, _ in want_fire)


def test_late_line_prints_null_like_java(spark):
    df = spark.createDataFrame([(5, None, "A")], "time_ms long, type string, area string")
    from logtide.functions.text import late_line

    (r,) = df.select(late_line(F.col("time_ms"), F.col("type"), F.col("area")).alias("l")).collect()
    assert r.l == "5\tnull\tA"


def test_compressed_fixture_counts(spark, sf001):
    """Row classes, firings, finals and documents of the compressed audit log at sf0.001."""
    from logtide.plans.catalog import _compressed_classified

    cls = _compressed_classified(spark, sf001)
    assert cls.count() == 1000
    assert lateness.late_rows(cls).count() == 71
    assert cls.where(~F.col("is_late") & (F.col("batch_id") > F.col("close_batch"))).count() == 82
    fir = lateness.firings(cls)
    assert fir.count() == 599
    assert lateness.final_report(cls).count() == 537
    assert lateness.firing_documents(fir).count() == 560
