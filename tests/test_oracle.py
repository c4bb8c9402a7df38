"""A sample of registered views against their DuckDB oracle on the smallest tables."""
import hashlib
import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
NAMES = ["clean_rows", "weekly_true_sales", "breakdown_media_type", "reconciliation", "efficiency_all_dims",
         "correlation_matrix", "describe_metrics", "quality_summary", "fanout_evidence", "model_dataset",
         "time_split", "recursive_forecast", "insight_facts"]


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, float):
            return repr(round(v, 9))
        return "NULL" if v is None else str(v)
    return hashlib.sha1("\n".join(sorted("|".join(norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")
@pytest.mark.parametrize("name", NAMES)
def test_view_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    rel = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _digest(df.columns, srows) == _digest(dcols, drows)


def test_every_view_has_a_builder():
    q, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(q)
    assert len(q) >= 60
