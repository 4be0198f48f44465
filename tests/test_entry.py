"""Driver contract: every registered query agrees with its SQL oracle."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tastes.schemas import REPORT_COLUMNS

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(
    not Path(SF).is_dir(), reason="driver test data not available"
)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    yield con
    con.close()


def normalised(records, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = []
    for r in records:
        out.append(
            tuple(round(r[i], 9) if isinstance(r[i], float) and not math.isnan(r[i]) else r[i] for i in order)
        )
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_every_query_has_an_oracle():
    assert set(entry.taste_queries()) == set(entry.taste_oracle_sql())


def test_entry_flagship(spark):
    df = entry.entry(spark)
    assert tuple(df.columns) == REPORT_COLUMNS
    assert df.count() == 25


@pytest.mark.parametrize("name", sorted(entry.taste_queries()))
def test_query_matches_oracle(spark, duck, name):
    df = entry.taste_queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(entry.taste_oracle_sql()[name])
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert normalised(got, df.columns) == normalised(want, cols)
