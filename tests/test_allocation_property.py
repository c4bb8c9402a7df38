"""Allocation on random fact tables: per-week reconciliation and shares in [0, 1]."""
import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mixlens.operators.allocate import allocate_sales

row = st.tuples(st.integers(0, 3),                                  # week index
                st.one_of(st.just(0.0), st.floats(0.01, 1e6)),      # spend
                st.integers(0, 10_000),                             # impressions
                st.integers(0, 50),                                 # hh_grps_tv
                st.one_of(st.none(), st.just(0.0), st.floats(1.0, 1e7)))  # target copy


@settings(max_examples=10, deadline=None)
@given(st.lists(row, min_size=1, max_size=40))
def test_allocation_reconciles(spark, rows):
    start = dt.date(2024, 1, 7)
    data = [(start + dt.timedelta(days=7 * w), s, i, h, t) for w, s, i, h, t in rows]
    df = spark.createDataFrame(data, "week date, spend double, impressions bigint, hh_grps_tv bigint, "
                                     "base_amount double")
    out = allocate_sales(df)
    wk = out.groupBy("week").agg(F.sum("estimated_sales").alias("a"),
                                 F.min(F.when(F.col("base_amount") > 0, F.col("base_amount"))).alias("t"),
                                 F.min("activity_weight").alias("wmin"), F.max("activity_weight").alias("wmax"))
    for r in wk.collect():
        if r.t is None:
            assert r.a == 0.0
        else:
            assert abs(r.a - r.t) <= 1e-9 * r.t
        assert 0.0 < r.wmin <= r.wmax <= 1.0
