import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E

from conftest import SF_SMALL

TABLES = ["documents", "labels", "conversations", "embeddings"]


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, bool):
        return str(int(v))
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.md5("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["label", "class", "metric", "value"]


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


#: Iterative estimators have their own module, which runs last.
ITERATIVE = ("lr_cv", "svm_cv", "mlp_word2vec", "mlp_weighted", "mlp_embeddings", "word2vec_docs")


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) - set(ITERATIVE)))
def test_query_matches_oracle_sf0001(spark, duck, name):
    check(spark, duck, name)


def check(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _digest(sdf.columns, srows) == _digest(dcols, drows)
