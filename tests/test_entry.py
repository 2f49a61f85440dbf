"""Registered queries against DuckDB on the small tables."""

import os
from pathlib import Path

import pandas as pd
import pytest

import __spark_entry__ as entry
from marlstone.plans.queries import QUERIES
from marlstone.plans.sql import ORACLE_SQL

DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables here")


def flat(frame):
    frame = frame[sorted(frame.columns)]
    show = lambda v: "null" if v is None or v is pd.NA or v != v else f"{v:.9g}" if isinstance(v, float) else str(v)
    return sorted(tuple(map(show, row)) for row in frame.itertuples(index=False))


@needs_data
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for f in Path(DATA).glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    ours, theirs = QUERIES[name](spark, DATA).toPandas(), con.execute(ORACLE_SQL[name]).fetchdf()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert flat(ours) == flat(theirs)


@needs_data
def test_inserted_are_those_of_status_new(spark):
    new = QUERIES["lead_status"](spark, DATA).where("status = 'nuevo'").select("telefono").collect()
    assert sorted(r.telefono for r in QUERIES["lead_insert_set"](spark, DATA).select("telefono").collect()) == sorted(r.telefono for r in new)


@needs_data
def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
