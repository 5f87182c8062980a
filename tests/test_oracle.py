"""Every registered query with an oracle equals DuckDB on the same tables."""

import datetime
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from ferrite.oracle import SQL
from ferrite.queries import REGISTRY
from tests.conftest import SF_SMALL

TABLES = ["events"]


def _norm(v):
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6) + 0.0
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def _key(row):
    return tuple((x is None, str(x)) for x in row)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    df = REGISTRY[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=_key)
    rel = duck.sql(SQL[name])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=_key)
    assert len(got) == len(want)
    if got != want:
        # Summation order differs between engines; a value may round to the
        # other side of a 6th-decimal boundary.  Compare floats within 1.5e-6.
        got_s = sorted(got, key=lambda r: tuple(str(x) if not isinstance(x, float) else "" for x in r))
        want_s = sorted(want, key=lambda r: tuple(str(x) if not isinstance(x, float) else "" for x in r))
        for a, b in zip(got_s, want_s):
            for x, y in zip(a, b):
                if isinstance(x, float) and isinstance(y, float):
                    assert x == pytest.approx(y, abs=1.5e-6)
                else:
                    assert x == y


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(SQL) <= set(REGISTRY) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["machine_type", "n_rows", "n_failures", "failure_rate", "sensor_null_share"]
