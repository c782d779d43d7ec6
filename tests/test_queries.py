"""Every registered query against its SQL, run by another engine over the same files."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tideline.plans.catalogue import ORACLES, QUERIES

DATA = Path("/root/testdata")


@pytest.fixture(scope="module")
def engines():
    made = {}
    for sf in ("sf0.001", "sf0.01"):
        made[sf] = duckdb.connect()
        for file in (DATA / sf).glob("*.parquet"):
            made[sf].execute(f"create view {file.stem} as select * from '{file}'")
    return made


def comparable(frame):
    frame = frame[sorted(frame.columns)].copy()
    for name in frame.columns:
        if str(frame[name].dtype).startswith("datetime"):
            frame[name] = frame[name].astype("datetime64[us]")
    frame = frame.astype(object).where(frame.notna(), None)
    return sorted(
        map(tuple, frame.itertuples(index=False)), key=lambda r: [(x is None, str(x)) for x in r]
    )


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_oracle(spark, engines, name):
    sf = "sf0.001" if name.startswith("stream_") else "sf0.01"
    mine = QUERIES[name](spark, str(DATA / sf)).toPandas()
    expected = engines[sf].execute(ORACLES[name]).df()
    assert sorted(mine.columns) == sorted(expected.columns)
    assert comparable(mine) == comparable(expected)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


def test_entry_has_all_queries():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_flagship(spark):
    assert entry.entry(spark).columns == ["driver", "total", "window_end"]
