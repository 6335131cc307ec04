"""Registered queries against their DuckDB oracles on the smallest driver tables."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from logtide.plans.catalog import ORACLES, QUERIES

TABLES = "region nation customer orders lineitem events".split()


def _norm(v):
    return round(v, 9) if isinstance(v, float) and not math.isnan(v) else v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con(sf001):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, sf001, con, name):
    df = QUERIES[name](spark, sf001)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLES[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _bag(df.columns, rows) == _bag(ocols, cur.fetchall())


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_order_of_thousands_of_items_matches_oracles(spark, sf001, tmp_path):
    """Messages follow one rule for every size: one order here holds 5,000 items."""
    for t in ("region", "nation", "customer", "events"):
        (tmp_path / f"{t}.parquet").symlink_to(f"{sf001}/{t}.parquet")
    c = duckdb.connect()
    c.execute(f"COPY (SELECT * FROM read_parquet('{sf001}/orders.parquet') LIMIT 200) TO '{tmp_path}/orders.parquet'")
    c.execute(f"""COPY (SELECT * REPLACE (CASE WHEN l_orderkey % 3 = 0 THEN (SELECT min(o_orderkey) FROM '{tmp_path}/orders.parquet')
        ELSE l_orderkey END AS l_orderkey, CAST(CASE WHEN l_orderkey % 3 = 0 THEN row_number() OVER () ELSE l_linenumber END AS BIGINT)
        AS l_linenumber) FROM read_parquet('{sf001}/lineitem.parquet')) TO '{tmp_path}/lineitem.parquet'""")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet')")
    for name in ("clean_flatten_enrich", "clean_quarantine"):
        df = QUERIES[name](spark, str(tmp_path))
        cur = c.execute(ORACLES[name])
        assert _bag(df.columns, [tuple(r) for r in df.collect()]) == _bag([d[0] for d in cur.description], cur.fetchall())


def test_entry_smoke(spark, sf001):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["key", "item_pos", "dt", "country_code", "area", "type", "score", "level"]
