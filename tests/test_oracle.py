"""Every registered query beside its SQL, run by DuckDB on the same files."""

import datetime
import os
import sys
from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")
sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as spark_entry  # noqa: E402
from agrolume.checks import ORACLE, QUERIES  # noqa: E402

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in Path(FOLDER).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def text(v):
    return v.isoformat() if isinstance(v, (datetime.date, datetime.datetime)) else repr(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted(tuple(text(r[c]) for c in columns) for r in df.collect())
    sql = ORACLE.get(name)
    assert sql, "every query has SQL"
    cursor = duck.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    place = [names.index(c) for c in columns]
    assert got == sorted(tuple(text(r[i]) for i in place) for r in cursor.fetchall())


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0
