"""Every query runs at the smallest scale, and agrees with its SQL there."""

import glob
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

DIR = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()


def plain(df: pd.DataFrame) -> pd.DataFrame:
    def value(x):
        if pd.api.types.is_scalar(x) and pd.isna(x):
            return "-"
        if isinstance(x, bool) or not pd.api.types.is_number(x):
            return str(x)
        return str(round(float(x), 9))

    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        df[c] = [value(x) for x in df[c].astype(object)]
    return df.sort_values(list(df.columns)).reset_index(drop=True)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in glob.glob(f"{DIR}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    got = entry.queries()[name](spark, DIR)
    assert len(set(got.columns)) == len(got.columns)
    got = got.toPandas()
    if name in ORACLES:
        want = duck.execute(ORACLES[name]).fetchdf()
        assert sorted(want.columns) == sorted(got.columns)
        pd.testing.assert_frame_equal(plain(got), plain(want), check_dtype=False)


def test_every_sql_has_its_query():
    assert set(ORACLES) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
