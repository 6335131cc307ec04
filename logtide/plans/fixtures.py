"""Log inputs derived from the driver's tables, so their size follows the tables.

* raw log: nested JSON messages of up to two line numbers of an order; items are its line items.
* dirty raw log: the same with injected faults, chosen by ``o_orderkey % 101``.
* area mapping (and a versioned history of it) from region and nation.
* audit log: one flat JSON message per event; dirty variant by ``event_id % 97``.
* late and compressed audit logs: the audit log with an arrival batch per row.

Every message is built with ``concat`` so no JSON writer sits next to the parser.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logtide.operators.joins import join_dimension
from logtide.schemas import AREA_PREFIX, TIME_PATTERN
from logtide.sources.tables import read_table

# Audit-log user names are this prefix followed by 1..5.
USER_PREFIX = "user"

DIRTY_MOD = 101
# Line numbers that share a raw-log message.
LINES_PER_MESSAGE = 2
AUDIT_DIRTY_MOD = 97
# Publish batch of each mapping snapshot; 3 is the empty one.
VERSION_BATCHES = (0, 2, 3, 4, 6)
EMPTY_VERSION = 3
FIRST_ORDER_YEAR = 1995


def _q(c: Column) -> Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def _item_text(it: Column, dirty: bool) -> Column:
    """JSON text of one line item (a struct); dirty cases 5, 7 and 8 of its order change it."""
    case = F.col("l_orderkey") % DIRTY_MOD
    level = _q(it["l_linestatus"])
    if dirty:
        level = F.when(case == 8, F.lit("null")).otherwise(level)
    extra = F.lit("")
    if dirty:
        extra = (F.when(case == 5, F.lit(',"area":"stale","dt":"stale"'))
                 .when(case == 7, F.concat(F.lit(',"meta":{"line":'), it["l_linenumber"].cast("string"),
                                           F.lit(',"none":null,"tags":["a",null,"\\\\",":null,"],"deep":{"x":null,"y":null}}')))
                 .otherwise(F.lit("")))
    return F.concat(
        F.lit('{"type":'), _q(it["l_returnflag"]),
        F.lit(',"score":'), it["l_discount"].cast("string"),
        F.lit(',"level":'), level, extra, F.lit("}"))


def raw_log(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    """Raw nested logs: (key, value, batch_id); batch = order year - 1995.

    One rule for orders of every size: a message holds the items of two
    neighbouring line numbers, keyed ``order-part``; an order without items is
    one message (part 0) with an empty list. The parts of a large order are
    grouped in different tasks.
    """
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag",
                    "l_discount", "l_linestatus")
    part = F.floor((F.col("l_linenumber") - 1) / LINES_PER_MESSAGE).cast("long")
    # Line numbers may repeat; the other fields break the tie, and items equal in all are identical.
    items = li.select("l_orderkey", part.alias("_part"), F.struct(
        "l_linenumber", "l_returnflag", "l_discount", "l_linestatus").alias("it"))
    # Fields are shuffled and sorted, texts are made of the sorted groups.
    per_order = items.groupBy("l_orderkey", "_part").agg(F.array_sort(F.collect_list("it")).alias("its")).select(
        "l_orderkey", "_part", F.array_join(F.transform("its", lambda it: _item_text(it, dirty)), ",").alias("items"))
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    customer = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    o = orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
    o = join_dimension(o, nation, o.c_nationkey == nation.n_nationkey, "left")
    o = o.join(per_order, F.col("o_orderkey") == per_order.l_orderkey, "left")
    dt = F.date_format(F.col("o_orderdate"), TIME_PATTERN)
    head = F.concat(F.lit('{"dt":'), _q(dt), F.lit(',"countryCode":'), _q(F.col("n_name")))
    data = F.coalesce(F.col("items"), F.lit(""))
    value = F.concat(head, F.lit(',"data":['), data, F.lit("]}"))
    if dirty:
        case = F.col("o_orderkey") % DIRTY_MOD

        def plus(extra: str) -> Column:
            return F.concat(head, F.lit(',"data":['), F.concat_ws(",", F.col("items"), F.lit(extra)), F.lit("]}"))

        value = (
            F.when(case == 1, F.expr("substring(v, 1, length(v) - 2)"))
            .when(case == 2, F.concat(head, F.lit("}")))
            .when(case == 3, F.concat(head, F.lit(',"data":42}')))
            .when(case == 4, F.concat(head, F.lit(',"data":[]}')))
            .when(case == 6, plus('{"type":"D","type":"E"}'))
            .when(case == 9, plus("null"))
            .when(case == 10, F.lit(""))
            .when(case == 11, plus("1"))
            .when(case == 12, F.concat(F.col("v"), F.lit(" trailing")))
            .when(case == 13, F.concat(F.col("v"), F.col("v")))
            .when(case == 14, F.concat(F.col("v"), F.lit("] junk")))
            .when(case == 15, F.concat(F.col("v"), F.lit(',"e":1} x')))
            .when(case == 16, F.concat(F.col("v"), F.lit("]]")))
            .otherwise(F.col("v"))
        )
        o = o.withColumn("v", F.concat(head, F.lit(',"data":['), data, F.lit("]}")))
    key = F.concat_ws("-", F.col("o_orderkey").cast("string"), F.coalesce(F.col("_part"), F.lit(0)).cast("string"))
    return o.select(
        key.alias("key"),
        value.alias("value"),
        (F.year("o_orderdate") - F.lit(FIRST_ORDER_YEAR)).cast("int").alias("batch_id"),
    )


def _region_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    return join_dimension(nation, region, nation.n_regionkey == region.r_regionkey, "inner")


def _group_mapping(pairs: DataFrame) -> DataFrame:
    """(area, country) pairs -> (area, "C1,C2,...") sorted by country."""
    return pairs.groupBy("area").agg(F.array_join(F.array_sort(F.collect_list("country")), ",").alias("countries"))


def area_mapping(spark: SparkSession, sf_dir: str, drop_region: int | None = None,
                 quirks: bool = False) -> DataFrame:
    """Area hash rows (area, countries) built from region and nation.

    drop_region leaves one region out (its countries become unmapped).
    quirks adds a trailing comma to even regions and lists nation 0 under the
    next region as well (a country under two areas).
    """
    rn = _region_nation(spark, sf_dir)
    if drop_region is not None:
        rn = rn.where(F.col("r_regionkey") != drop_region)
    pairs = rn.select(F.concat(F.lit(AREA_PREFIX), "r_name").alias("area"), F.col("n_name").alias("country"),
                      F.col("r_regionkey"))
    if not quirks:
        return _group_mapping(pairs)
    region = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    twice = join_dimension(nation.where("n_nationkey = 0"), region,
                           (F.col("n_regionkey") + 1) % 5 == F.col("r_regionkey"), "inner").select(
        F.concat(F.lit(AREA_PREFIX), "r_name").alias("area"), F.col("n_name").alias("country"), "r_regionkey")
    pairs = pairs.unionByName(twice)
    even = pairs.groupBy("area").agg(F.min("r_regionkey").alias("rk"))
    g = _group_mapping(pairs.select("area", "country")).join(even, "area")
    return g.select("area", F.when(F.col("rk") % 2 == 0, F.concat("countries", F.lit(",")))
                    .otherwise(F.col("countries")).alias("countries"))


def mapping_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot history (version, area, countries); version = publish batch.

    0: full; 2: nation 1 moved to the next region; 3: empty (one row with no
    area); 4: nation 2 removed; 6: full again. Built in one pass: every nation
    is repeated per non-empty version, the version's rule is applied, then
    one grouping per (version, area).
    """
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    full = [v for v in VERSION_BATCHES if v != EMPTY_VERSION]
    per_version = nation.select("*", F.explode(F.array(*[F.lit(v) for v in full])).alias("version"))
    v, key = F.col("version"), F.col("n_nationkey")
    rk = F.when((v == 2) & (key == 1), (F.col("n_regionkey") + 1) % 5).otherwise(F.col("n_regionkey"))
    kept = per_version.where(~((v == 4) & (key == 2))).withColumn("rk", rk)
    pairs = join_dimension(kept, region, F.col("rk") == F.col("r_regionkey"), "inner")
    g = pairs.groupBy("version", F.concat(F.lit(AREA_PREFIX), "r_name").alias("area")).agg(
        F.array_join(F.array_sort(F.collect_list("n_name")), ",").alias("countries"))
    empty = spark.createDataFrame([(EMPTY_VERSION, None, None)], "version int, area string, countries string")
    return g.select(v.cast("int").alias("version"), "area", "countries").unionByName(empty)


def _audit_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type")
    region = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    ev = join_dimension(events, region, (events.user_id % 5) == region.r_regionkey, "left")
    return ev.select(
        "event_id",
        F.date_format("ts", TIME_PATTERN).alias("dt"),
        F.col("event_type").alias("type"),
        F.concat(F.lit(USER_PREFIX), (F.col("user_id") % 5 + 1).cast("string")).alias("username"),
        F.concat(F.lit(AREA_PREFIX), "r_name").alias("area"),
    )


def _audit_text(dt: Column, type_: Column, username: Column, area: Column, with_dt: Column | None = None) -> Column:
    dt_part = F.concat(F.lit('"dt":'), _q(dt), F.lit(","))
    if with_dt is not None:
        dt_part = F.when(with_dt, dt_part).otherwise(F.lit(""))
    type_part = F.when(type_.isNull(), F.lit("null")).otherwise(_q(type_))
    return F.concat(F.lit("{"), dt_part, F.lit('"type":'), type_part, F.lit(',"username":'), _q(username),
                    F.lit(',"area":'), _q(area), F.lit("}"))


def audit_log(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    """Audit messages (key, value) per event; dirty cases by event_id % 97:
    1 bad dt, 2 empty message, 3 no dt, 4 lenient dt, 5 month 13, 6 null type,
    7 the epoch instant (parses to 0), 8 truncated, 9 an array, 10 text after the object, 11 to 13 the same with closing brackets."""
    a = _audit_fields(spark, sf_dir)
    if not dirty:
        value = _audit_text(F.col("dt"), F.col("type"), F.col("username"), F.col("area"))
    else:
        case = F.col("event_id") % AUDIT_DIRTY_MOD
        dt = (F.when(case == 1, F.lit("bad")).when(case == 4, F.lit("2019-1-1 1:1:1"))
              .when(case == 5, F.lit("2019-13-01 00:00:00")).when(case == 7, F.lit("1970-01-01 00:00:00"))
              .otherwise(F.col("dt")))
        type_ = F.when(case == 6, F.lit(None).cast("string")).otherwise(F.col("type"))
        text = _audit_text(dt, type_, F.col("username"), F.col("area"), with_dt=case != 3)
        value = (F.when(case == 2, F.lit("")).when(case == 8, F.substr(text, F.lit(1), F.length(text) - 1))
                 .when(case == 9, F.concat(F.lit("["), text, F.lit("]"))).when(case == 10, F.concat(text, F.lit(" x")))
                 .when(case == 11, F.concat(text, F.lit("] junk"))).when(case == 12, F.concat(text, F.lit(',"e":1} x')))
                 .when(case == 13, F.concat(text, F.lit("]]")))
                 .otherwise(text))
    return a.select(F.col("event_id").cast("string").alias("key"), value.alias("value"), "event_id")


def late_audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit log with arrival batches: every 50th event arrives 250 events late."""
    a = audit_log(spark, sf_dir)
    delay = F.when(F.col("event_id") % 50 == 0, F.lit(250)).otherwise(F.lit(0))
    return a.withColumn("batch_id", F.floor((F.col("event_id") + delay) / 100).cast("long"))


COMPRESSED_EPOCH_MS = 1_704_067_200_000  # 2024-01-01 00:00:00 UTC


def compressed_audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event per second from 2024-01-01; some rows arrive 45 or 90 events late."""
    events = read_table(spark, sf_dir, "events", "event_id", "user_id", "event_type")
    t = F.lit(COMPRESSED_EPOCH_MS) + F.col("event_id") * 1000
    dt = F.date_format(F.timestamp_millis(t), TIME_PATTERN)
    area = F.concat(F.lit(AREA_PREFIX), (F.col("user_id") % 5).cast("string"))
    user = F.concat(F.lit(USER_PREFIX), (F.col("user_id") % 5 + 1).cast("string"))
    delay = F.when(F.col("event_id") % 11 == 0, 45).when(F.col("event_id") % 13 == 0, 90).otherwise(0)
    return events.select(
        F.col("event_id").cast("string").alias("key"),
        _audit_text(dt, F.col("event_type"), user, area).alias("value"),
        F.floor((F.col("event_id") + delay) / 7).cast("long").alias("batch_id"),
    )


def multi_input_audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The compressed audit log from three inputs: runs of five events each; input 2 is silent in every other
    run of 20 batches (its events come from input 0 then), and input 1 brings its events two batches later."""
    a = compressed_audit_log(spark, sf_dir)
    run = F.floor(F.col("key").cast("long") / 5) % 3
    silent = (run == 2) & (F.floor(F.col("batch_id") / 20) % 2 == 1)
    a = a.withColumn("input", F.when(silent, F.lit(0)).otherwise(run).cast("int"))
    return a.withColumn("batch_id", F.col("batch_id") + F.when(F.col("input") == 1, 2).otherwise(0))


def stream_audit_log(spark: SparkSession, sf_dir: str, n_batches: int = 8) -> DataFrame:
    """Audit log cut into ``n_batches`` arrival batches by event id; every 50th
    event arrives one and a half batches late (clamped to the last batch).

    The number of batches is fixed, so a micro-batch grows with the table: a
    shape of this fixture, not of the job, whose batches a trigger cuts."""
    a = audit_log(spark, sf_dir)
    top = read_table(spark, sf_dir, "events", "event_id").agg(F.max("event_id")).first()[0]
    span = max(1, -(-(int(top) + 1) // n_batches))
    delay = F.when(F.col("event_id") % 50 == 0, F.lit(span + span // 2)).otherwise(F.lit(0))
    batch = F.least(F.lit(n_batches - 1).cast("long"), F.floor((F.col("event_id") + delay) / span).cast("long"))
    return a.withColumn("batch_id", batch)
