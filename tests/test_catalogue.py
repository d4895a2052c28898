"""Oracle test: every catalogue query equals its DuckDB SQL on the sf0.001 tables."""

import os
import sys
from collections import Counter

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, norm  # noqa: E402
from shardfold.plans import catalogue  # noqa: E402

SF = os.environ.get("SHARDFOLD_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_oracle():
    assert set(catalogue.QUERIES) == set(catalogue.ORACLE)
    assert set(catalogue.QUERIES) <= set(E.queries()) and len(catalogue.QUERIES) >= 50


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = df.columns
    got = Counter(tuple(norm(r[c]) for c in cols) for r in df.collect())
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(ocols)
    idx = [ocols.index(c) for c in cols]
    want = Counter(tuple(norm(r[i]) for i in idx) for r in res.fetchall())
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["zone_id", "c_mktsegment", "revenue", "n_lines"]
    assert df.count() > 0


DUCK_TO_SPARK = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
                 "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean", "DATE": "date"}


def test_column_types_match_oracle(spark, con):
    bad = {}
    for name, fn in ((n, E.queries()[n]) for n in catalogue.QUERIES):
        st = dict(fn(spark, SF).dtypes)
        rel = con.sql(E.oracle_sql()[name])
        ot = {c: DUCK_TO_SPARK.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
        if st != ot:
            bad[name] = (st, ot)
    assert not bad
