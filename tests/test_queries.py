"""Every query with SQL gives the rows of its SQL; every other one runs and has named columns."""

import datetime as dt
import decimal
import math

import pytest

from movelane import plans

duckdb = pytest.importorskip("duckdb")
TABLES = "orders lineitem sources firms raw_items fetches extracted_moves pair_scores role_parts pipeline_runs ref_values documents mix_targets".split()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    if isinstance(v, dict):
        return tuple(sorted((str(k), plain(x)) for k, x in v.items()))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v.isoformat() if isinstance(v, dt.date) else v


def ordered(rows):
    return sorted(rows, key=lambda row: [(x is not None, str(type(x)), str(x)) for x in row])


@pytest.fixture(scope="module")
def oracle(small):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{small}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(plans.queries()))
def test_query(spark, small, oracle, name):
    frame = plans.queries()[name](spark, small)
    columns = sorted(frame.columns)
    assert len(set(columns)) == len(columns)
    got = [tuple(plain(row[c]) for c in columns) for row in frame.collect()]
    sql = plans.oracle_sql().get(name)
    if sql:
        answer = oracle.execute(sql)
        at = {d[0]: i for i, d in enumerate(answer.description)}
        assert sorted(at) == columns
        assert ordered(got) == ordered([tuple(plain(row[at[c]]) for c in columns) for row in answer.fetchall()])
