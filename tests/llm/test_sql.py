"""Queries with SQL against another engine over the same files."""

import duckdb
import pytest

from tideline.llm import queries

DATA = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_oracle(spark, name):
    other = duckdb.connect()
    for name_of in ("documents", "embeddings"):
        other.execute(f"create view {name_of} as select * from '{DATA}/{name_of}.parquet'")
    mine = queries.QUERIES[name](spark, DATA).toPandas()
    expected = other.execute(queries.ORACLES[name]).df()
    columns = sorted(expected.columns)
    assert sorted(mine.columns) == columns

    def rows(frame):
        frame = frame[columns].astype(object)
        return sorted(map(str, frame.where(frame.notna(), None).itertuples(index=False, name=None)))

    assert rows(mine) == rows(expected)
