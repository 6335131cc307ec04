"""Audit parse, bad-time filter and rejects (golden cases)."""

from logtide.operators import audit as audit_ops
from logtide.operators import report as report_ops


def parse(spark, values):
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "key string, value string")
    return audit_ops.parse_audit(df)


def test_time_parse_and_failures(spark):
    vals = [
        '{"dt":"2022-03-04 05:06:07","type":"listed","username":"u","area":"AREA_NORTH"}',
        '{"dt":"bad","type":"listed","area":"AREA_NORTH"}',
        '{"type":"listed","area":"AREA_NORTH"}',  # D3 missing dt
        '{"dt":"2019-1-1 1:1:1","type":"listed","area":"AREA_NORTH"}',  # D7 lenient
        '{"dt":"2019-13-01 00:00:00","type":"listed","area":"AREA_NORTH"}',  # D7 month 13
        '{"dt":"2019-01-01 00:00:00 trailing","type":"listed","area":"AREA_NORTH"}',
        "",
        '{"dt":"1969-12-31 23:59:59","type":"listed","area":"AREA_NORTH"}',  # pre-1970: kept
        '{"dt":"2022-03-04 05:06:07","type":null,"area":"AREA_NORTH"}',  # D4
    ]
    rows = {r.key: r for r in parse(spark, vals).collect()}
    assert rows["0"].time_ms == 1646370367000 and rows["0"].type == "listed"
    assert [rows[k].time_ms for k in "123456"] == [0] * 6
    assert rows["7"].time_ms == -1000
    acc = {r.key for r in audit_ops.accepted(parse(spark, vals)).collect()}
    assert acc == {"0", "7"}
    rej = {r.key: r.reason for r in audit_ops.rejects(parse(spark, vals)).collect()}
    assert rej == {"1": "bad_time", "2": "bad_time", "3": "bad_time", "4": "bad_time", "5": "bad_time",
                   "6": "empty", "8": "null_key"}


def test_messages_that_are_no_object_keep_their_text(spark):
    good = '{"dt":"2022-03-04 05:06:07","type":"t","area":"A"}'
    vals = [good, good[:-1], f"[{good}]", good + " x", good + good, "", None, "  ", "7", f" {good} "]
    rej = {r.key: (r.reason, r.value) for r in audit_ops.rejects(parse(spark, vals)).collect()}
    assert rej == {**{str(i): ("malformed", vals[i]) for i in (1, 2, 3, 4, 8)}, **{str(i): ("empty", vals[i]) for i in (5, 6, 7)}}
    assert {r.key for r in audit_ops.accepted(parse(spark, vals)).collect()} == {"0", "9"}


def test_report_time_is_max_event_time_not_window_bound(spark):
    vals = ['{"dt":"2022-03-04 05:06:07","type":"listed","area":"A"}',
            '{"dt":"2022-03-04 05:29:59","type":"listed","area":"A"}',
            '{"dt":"2022-03-04 05:30:00","type":"listed","area":"A"}']
    rep = report_ops.tumbling_report(audit_ops.accepted(parse(spark, vals)), 30 * 60 * 1000)
    got = sorted((r.time, r["count"]) for r in rep.collect())
    assert got == [("2022-03-04 05:29:59", 2), ("2022-03-04 05:30:00", 1)]
    docs = report_ops.documents(rep).orderBy("doc_id").collect()
    assert docs[0].doc_id == "2022-03-04_05:29:59-listed-A"
    assert docs[0].doc == '{"time":"2022-03-04 05:29:59","type":"listed","area":"A","count":2}'
