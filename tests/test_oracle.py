"""Every registered query with an oracle: Spark result == DuckDB result (rows, columns,
order-insensitive values), on the smallest test tables."""

import math

import pytest

import __spark_entry__ as entry
from review_paths import SMALL
from reviewlab.plans import catalog

SQL = catalog.oracle_sql()
QUERIES = catalog.queries()


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "∅" if math.isnan(v) else repr(round(v, 6) + 0.0)
    return str(v)


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con(duck):
    return duck(SMALL)


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(SQL[key])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _bag(df.columns, rows) == _bag(rel.columns, rel.fetchall())


def test_every_query_has_sql_or_is_listed_rows_only():
    rows_only = set(QUERIES) - set(SQL)
    # trained-tree outputs, the SVD projection and the text domain classifier are not SQL-expressible
    assert rows_only == {"rf_predict", "gbt_predict", "model_comparison", "svd_projection", "drift_text_auc",
                         "gbt_training_loss", "experiment_runs"}


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["label", "rank", "word", "count"]
    assert df.count() > 0
