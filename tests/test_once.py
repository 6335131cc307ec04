"""Costly columns are worked out once per row, sources read once per batch, staged files stay small."""

import json
import os

from pyspark.sql import functions as F

from logtide.functions.json_items import one_json_value
from logtide.operators import area as area_ops
from logtide.operators import audit as audit_ops
from logtide.operators import clean as clean_ops
from logtide.plans import catalog
from logtide.session import new_work_dir
from logtide.sources import topics
from logtide.sources.snapshots import read_snapshots
from logtide.streaming import jobs
from test_plans import plan

ROWS = "key string, value string"


def stored(spark, values):
    path = new_work_dir(spark, "test-once")
    spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], ROWS).write.parquet(path)
    return spark.read.parquet(path)


def mapping(spark):
    return area_ops.invert_mapping(spark.createDataFrame([("AREA_NORTH", "US")], "area string, countries string"))


def test_raw_log_is_parsed_once(spark):
    msgs = stored(spark, ['{"dt":"d","countryCode":"US","data":[{"type":"s"}]}', "{"])
    parsed = clean_ops.parse_messages(msgs)
    for df in (clean_ops.clean_records(msgs, mapping(spark)), clean_ops.quarantine(parsed)):
        p = plan(df)
        assert p.count("from_json(") == 1 and p.count("jsonObjectKeys") <= 2
        assert df.count() == 1


def test_audit_message_is_parsed_once(spark):
    msgs = stored(spark, ['{"dt":"2024-01-01 00:00:00","type":"s","area":"a"}', "{"])
    parsed = audit_ops.parse_audit(msgs)
    for df in (audit_ops.accepted(parsed), audit_ops.rejects(parsed)):
        p = plan(df)
        assert p.count("from_json(") == 1 and p.count("RLIKE(_") <= 1
        assert df.count() == 1


def test_records_are_read_back_in_one_parse(spark):
    msgs = stored(spark, ['{"dt":"d","countryCode":"US","data":[{"type":"s","score":1.5,"level":"A"}]}'])
    df = catalog._reread(clean_ops.clean_records(msgs, mapping(spark)))
    assert plan(df).count("from_json(") == 2  # message and record
    row = df.first()
    assert (row.type, row.score, row.level, row.area, row.dt, row.keys) == ("s", 1.5, "A", "AREA_NORTH", "d", "area,dt,level,score,type")


def one_value(text):
    try:
        json.loads(text)
    except ValueError:
        return False
    return True


def test_one_json_value_of_odd_texts(spark):
    heads = ['{"a":1}', '{"a":[1,2]}', '{"a":{"b":{}}}', "[1]", "[]", "{}", "1", '"x"', '"]}"', '{"a":"}}"}', '{"a":"]"}', ' {"a":[{}]} ', "[{}]", ""]
    tails = ["", " ", "]", "}", " }", "} x", "] x", "}}", "]]", "]}", "}]", "}] x", ']}"', ",1", ',"e":1} x', ',"e":1}] x', ",{}] x", " {}", "x", "]\n}", "\n}\n]"]
    texts = [h + t for h in heads for t in tails]
    got = {r.value: r.ok for r in stored(spark, texts).select("value", one_json_value(F.col("value")).alias("ok")).collect()}
    assert got == {t: one_value(t) for t in texts}


def test_staged_files_are_compressed_and_limited(spark, monkeypatch):
    monkeypatch.setattr(topics, "RECORDS_PER_FILE", 10)
    path = new_work_dir(spark, "test-staged")
    topics.stage(spark.createDataFrame([(str(i), "v" * 50) for i in range(25)], ROWS).coalesce(1), path)
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(files) == 3 and all(f.endswith(".json.gz") for f in files)
    assert spark.read.schema(ROWS).json(path).count() == 25


def test_connected_job_reads_its_sources_once_per_batch(spark):
    work = new_work_dir(spark, "test-connected")
    spark.createDataFrame([("AREA_NORTH", "US")], "area string, countries string").write.parquet(f"{work}/snapshots/version=0")
    topics.stage(stored(spark, ['{"dt":"d","countryCode":"US","data":[{"type":"s"}]}'] * 3), f"{work}/src")
    q = jobs.connected_clean_job(topics.read_staged(spark, f"{work}/src"), read_snapshots(spark, f"{work}/snapshots"),
                                 f"{work}/out", f"{work}/ckpt", {"availableNow": True})
    q.awaitTermination()
    files = [s for p in q.recentProgress for s in p["sources"] if "File" in s["description"]]
    assert q.exception() is None and sum(s["numInputRows"] for s in files) == 3
