"""Every query with a SQL twin gives the twin's rows; every other one gives rows."""

import importlib.util
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parents[1]
SF = "/root/testdata/sf0.001"


def _module(path):
    spec = importlib.util.spec_from_file_location(path.stem, path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


check = _module(ROOT / "tools" / "check_queries.py")
entry = check.entry
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in check.TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cursor = duck.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert check.rows_of(df.columns, df.collect()) == check.rows_of(columns, cursor.fetchall())


@pytest.mark.parametrize("name", ["nb_gaussian", "kmeans_assign", "feature_importance", "score_submission"])
def test_query_gives_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry_is_stable(spark):
    df = entry.entry(spark)
    assert df.columns == ["p_brand", "total_quantity"] and df.count() == 25


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
