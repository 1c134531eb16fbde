"""Every query that has a DuckDB oracle agrees with it on the smoke tables."""
import math

import duckdb
import pytest

import __spark_entry__ as E

SMOKE = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9) + 0.0)
    if isinstance(v, (list, tuple)):
        return repr([_norm(x) for x in v])
    return repr(v)


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records)


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_duckdb(spark, con, name):
    df = E.queries()[name](spark, SMOKE)
    rel = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(dcols)
    dtypes = {d[0]: str(d[1]) for d in rel.description}
    for f in df.schema.fields:
        assert SPARK_TO_DUCK.get(f.dataType.simpleString()) == dtypes[f.name], (f.name, f.dataType, dtypes[f.name])
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(dcols, rel.fetchall())
