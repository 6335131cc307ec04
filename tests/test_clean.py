"""Clean job: parse, quarantine, flatten, enrich, JSON record (golden cases)."""

import json


from logtide.operators import area as area_ops
from logtide.operators import clean as clean_ops

MAPPING = [("AREA_NORTH", "US"), ("AREA_EAST", "TW,MN"), ("AREA_SOUTH", "PE,CL,UY"), ("AREA_WEST", "PT")]


def mapping(spark, rows=MAPPING):
    return area_ops.invert_mapping(spark.createDataFrame(rows, "area string, countries string"))


def messages(spark, values):
    return spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "key string, value string")


def test_invert_mapping_lists_every_country_once(spark):
    got = {tuple(r) for r in mapping(spark).collect()}
    assert got == {("US", "AREA_NORTH"), ("TW", "AREA_EAST"), ("MN", "AREA_EAST"), ("PE", "AREA_SOUTH"),
                   ("CL", "AREA_SOUTH"), ("UY", "AREA_SOUTH"), ("PT", "AREA_WEST")}


def test_split_drops_empty_pieces_and_duplicate_country_takes_max(spark):
    m = mapping(spark, [("AREA_B", "FR,,DE,"), ("AREA_A", "DE")])
    assert {tuple(r) for r in m.collect()} == {("FR", "AREA_B"), ("DE", "AREA_B")}


def test_message_flattens_to_one_record_per_item(spark):
    raw = ('{"dt":"2021-06-05 04:03:02","countryCode":"PE","data":[{"type":"red","score":1.25,"level":"hi"},'
           '{"type":"blue","score":0.75,"level":"lo"}]}')
    out = clean_ops.clean_records(messages(spark, [raw]), mapping(spark)).orderBy("item_pos").collect()
    assert [json.loads(r.record) for r in out] == [
        {"type": "red", "score": 1.25, "level": "hi", "area": "AREA_SOUTH", "dt": "2021-06-05 04:03:02"},
        {"type": "blue", "score": 0.75, "level": "lo", "area": "AREA_SOUTH", "dt": "2021-06-05 04:03:02"},
    ]
    assert [(r.type, r.score, r.level) for r in out] == [("red", 1.25, "hi"), ("blue", 0.75, "lo")]


def test_overwrite_keep_extra_and_drop_null_keys(spark):
    raw = ('{"dt":"d1","countryCode":"TW","data":[{"type":"s1","area":"old","dt":"old","x":{"y":[1,2]},'
           '"n":null}]}')
    (r,) = clean_ops.clean_records(messages(spark, [raw]), mapping(spark)).collect()
    assert json.loads(r.record) == {"type": "s1", "x": {"y": [1, 2]}, "area": "AREA_EAST", "dt": "d1"}


def test_unknown_country_keeps_row_and_omits_area_key(spark):
    raw = '{"dt":"d1","countryCode":"ZZ","data":[{"type":"s1"}]}'
    (r,) = clean_ops.clean_records(messages(spark, [raw]), mapping(spark)).collect()
    assert r.area is None and json.loads(r.record) == {"type": "s1", "dt": "d1"}


def test_empty_array_emits_nothing(spark):
    raw = '{"dt":"d1","countryCode":"US","data":[]}'
    parsed = clean_ops.parse_messages(messages(spark, [raw]))
    assert clean_ops.flatten(parsed).count() == 0
    assert clean_ops.quarantine(parsed).count() == 0


def test_quarantine_reasons(spark):
    vals = [
        '{"dt":"d","countryCode":"US","data":[{"type":"s1"}',  # D1 truncated
        '{"dt":"d","countryCode":"US"}',  # D2 no data
        '{"dt":"d","countryCode":"US","data":5}',  # wrongly typed data
        '{"dt":"d","countryCode":"US","data":[{"a":1,"a":2}]}',  # D12 duplicate key
        '{"dt":"d","countryCode":"US","data":[null,{"type":"s1"}]}',  # D14 null element
        '{"dt":"d","countryCode":"US","data":[1]}',  # D14 non-object element
        "",  # D15 empty text
        None,  # D15 null text
        "[1,2]",  # not an object
        '{"dt":"d","countryCode":"US","data":[{"type":"ok"}]}',  # clean
        '{"dt":"d","countryCode":"US","data":[{"type":"ok"}]} junk',  # text after the object
        '{"dt":"d","countryCode":"US","data":[]}{"dt":"e"}',  # two objects
        '{"dt":"d","countryCode":"US","data":[{"type":"ok"}]}] junk',  # tails that close a wrapping
        '{"dt":"d","countryCode":"US","data":[{"type":"ok"}]},"e":1} x',
        '{"dt":"d","countryCode":"US","data":[{"type":"ok"}]},"v":1} x',
        '{"dt":"d","countryCode":"US","data":[{"type":"ok"}]}]]',
        '{"dt":"d","countryCode":"US","data":[{"type":"ok"}]},{"a":1}',
        ' {"dt":"d","countryCode":"US","data":[{"type":"ok"}]}\n',  # blanks around it are fine
    ]
    parsed = clean_ops.parse_messages(messages(spark, vals))
    got = {r.key: r.reason for r in clean_ops.quarantine(parsed).collect()}
    assert got == {"0": "malformed", "1": "missing_data", "2": "malformed",
                   "4": "null_item", "5": "malformed", "6": "empty", "7": "empty", "8": "malformed",
                   **{str(i): "malformed" for i in range(10, 17)}}
    assert clean_ops.finish(area_ops.enrich_area(clean_ops.flatten(parsed), mapping(spark))).count() == 3


def test_null_keys_are_left_out_at_every_depth(spark):
    item = {"type": "t", "gone": None, "in": {"first": None, "x": [None, {"deep": None, "k": 1}], "last": None},
            "text": 'a,"b":null,"c" \\ {,"d":null}', "all": {"p": None, "q": None}, "long": '\\"' * 20_000}
    raw = json.dumps({"dt": "d", "countryCode": "US", "data": [item]})
    out = clean_ops.clean_records(messages(spark, [raw]), mapping(spark)).collect()
    assert [json.loads(r.record) for r in out] == [
        {"type": "t", "in": {"x": [None, {"k": 1}]}, "text": item["text"], "all": {}, "long": item["long"], "area": "AREA_NORTH", "dt": "d"}]


def test_last_value_of_a_repeated_key_wins(spark):
    raw = '{"dt":"d","countryCode":"US","data":[{"a":1,"type":"x","a":{"b":2},"type":"y"},{"type":"z"}]}'
    out = clean_ops.clean_records(messages(spark, [raw]), mapping(spark)).orderBy("item_pos").collect()
    assert [json.loads(r.record) for r in out] == [
        {"a": {"b": 2}, "type": "y", "area": "AREA_NORTH", "dt": "d"}, {"type": "z", "area": "AREA_NORTH", "dt": "d"}]


def test_thousands_of_versions_are_met_in_equi_joins(spark):
    n = 3000
    versions = spark.createDataFrame([(v, f"AREA_{v}" if v % 7 else None, "US" if v % 7 else None) for v in range(1, n)],
                                     "version int, area string, countries string")
    recs = spark.createDataFrame([(b, "US") for b in range(0, n, 50)], "batch_id int, country_code string")
    df = area_ops.enrich_area_as_of(recs, versions)
    got = {r.batch_id: r.area for r in df.collect()}
    assert got == {b: (f"AREA_{b if b % 7 else b - 1}" if b else None) for b in range(0, n, 50)}


def test_numbers_as_strings_in_string_fields(spark):
    raw = '{"dt":7,"countryCode":"US","data":[{"type":5,"score":"0.5"}]}'
    (r,) = clean_ops.clean_records(messages(spark, [raw]), mapping(spark)).collect()
    assert (r.dt, r.type) == ("7", "5")


def test_as_of_version_uses_latest_nonempty_snapshot(spark):
    versions = spark.createDataFrame(
        [(0, "AREA_A", "US"), (2, "AREA_B", "US"), (3, None, None), (5, "AREA_C", "TW")],
        "version int, area string, countries string")
    recs = spark.createDataFrame(
        [(str(b), b, '{"dt":"d","countryCode":"US","data":[{"type":"s"}]}') for b in range(7)],
        "key string, batch_id int, value string")
    got = {r.batch_id: r.area for r in clean_ops.clean_records_as_of(recs, versions).collect()}
    # batch 3's snapshot is empty, so batch 3 and 4 keep version 2; version 5 drops US.
    assert got == {0: "AREA_A", 1: "AREA_A", 2: "AREA_B", 3: "AREA_B", 4: "AREA_B", 5: None, 6: None}


def test_latest_nonempty_version_for_one_batch(spark):
    versions = spark.createDataFrame(
        [(0, "AREA_A", "US"), (3, None, None)], "version int, area string, countries string")
    got = [tuple(r) for r in area_ops.latest_nonempty_version(versions, 4).collect()]
    assert got == [("US", "AREA_A")]


def test_no_nonempty_snapshot_yet_leaves_area_null(spark):
    versions = spark.createDataFrame([(0, None, None), (5, "AREA_A", "US")],
                                     "version int, area string, countries string")
    assert area_ops.latest_nonempty_version(versions, 3).count() == 0
    recs = spark.createDataFrame([("k", 3, '{"dt":"d","countryCode":"US","data":[{"type":"s"}]}')],
                                 "key string, batch_id int, value string")
    (r,) = clean_ops.clean_records_as_of(recs, versions).collect()
    assert r.area is None


def test_topic_source_without_connector_says_so(spark):
    import pytest

    from logtide.sources.topics import read_topic

    with pytest.raises(RuntimeError, match="connector"):
        read_topic(spark, "broker.example:1", "messages")
