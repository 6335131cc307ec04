"""One key holding a third of all rows: results stay whole and exact."""

import random

from pyspark.sql import functions as F

from logtide.operators import area as area_ops
from logtide.operators import clean as clean_ops
from logtide.operators import lateness
from replay_model import replay
from test_lateness import T0


def test_hot_key_lateness_matches_replay(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(1500):
        hot = i % 3 == 0
        b = i // 25 + (4 if i % 37 == 0 else 0)
        t = T0 + i * 400 + rnd.randint(0, 300)
        rows.append((b, t, "HOT" if hot else f"K{rnd.randint(0, 40)}"))
    want_late, want_fire = replay(rows, 30_000)
    df = spark.createDataFrame([(str(i), b, t, "gate", k) for i, (b, t, k) in enumerate(rows)],
                               "key string, batch_id long, time_ms long, type string, area string")
    cls = lateness.classify(df, 30_000)
    assert {int(r.key) for r in lateness.late_rows(cls).collect()} == want_late
    got = sorted((r.window_start_ms, r.area, r.fire_batch, r["count"]) for r in lateness.firings(cls).collect())
    assert got == sorted((ws, k, b, n) for ws, k, b, n, _ in want_fire)
    hot_final = lateness.final_report(cls).where(F.col("area") == "HOT").agg(F.sum("count")).first()[0]
    fired_hot = sum(n for ws, k, b, n, _ in want_fire if k == "HOT" and
                    b == max(b2 for ws2, k2, b2, _, _ in want_fire if (ws2, k2) == (ws, k)))
    assert hot_final == fired_hot


def test_hot_country_clean_keeps_every_item(spark):
    n = 3000
    vals = [(str(i), '{"dt":"d","countryCode":"%s","data":[{"type":"s"},{"type":"t"}]}'
             % ("US" if i % 3 == 0 else "TW")) for i in range(n)]
    msgs = spark.createDataFrame(vals, "key string, value string").repartition(8)
    mapping = area_ops.invert_mapping(spark.createDataFrame(
        [("AREA_NORTH", "US"), ("AREA_EAST", "TW,MN")], "area string, countries string"))
    out = clean_ops.clean_records(msgs, mapping)
    counts = {r.area: r["count"] for r in out.groupBy("area").count().collect()}
    assert counts == {"AREA_NORTH": 2 * (n // 3), "AREA_EAST": 2 * (n - n // 3)}
