"""Edge rows of the cleaning chain, repair and allocation (in-line frames)."""
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from mixlens.functions.exprs import align_sunday, safe_corr, safe_div
from mixlens.operators.allocate import allocate_sales
from mixlens.operators.clean import clean, date_parts, parse_dates
from mixlens.operators.measure import weekly_true_sales

SCHEMA = ("activity_date string, sub_channel string, site string, device string, channel string, "
          "spend string, impressions bigint, base_amount decimal(18,2)")


def _raw(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_align_sunday(spark):
    days = [dt.date(2024, 11, 17) + dt.timedelta(days=i) for i in range(9)]
    got = spark.createDataFrame([(d,) for d in days], "d date").select(align_sunday("d").alias("s")).collect()
    expect = [d + dt.timedelta(days=(6 - d.weekday()) % 7) for d in days]
    assert [r.s for r in got] == expect


def test_mixed_formats_align_to_same_sunday(spark):
    df = spark.createDataFrame([("2024-11-21",), ("11/21/2024",), ("garbage",)], "activity_date string")
    got = parse_dates(df, "activity_date").select(align_sunday("activity_date").alias("w")).collect()
    assert [r.w for r in got] == [dt.date(2024, 11, 24), dt.date(2024, 11, 24), None]


def test_trim_typo_fill_credit_coerce(spark):
    rows = [
        ("2024-11-24", "\tVIdeo\n", None, None, None, "-5", 10, Decimal("100.00")),
        ("2024-11-24", "VIDEO", "  ", "D", "X", None, None, None),
        ("2024-11-24", "Display", "S", "D", "X", "abc", 5, Decimal("0")),
    ]
    out = clean(_raw(spark, rows)).orderBy("impressions").collect()
    by_imp = {r.impressions: r for r in out}
    a = by_imp[10]
    assert a.sub_channel == "Video" and a.site == "Unknown" and a.device == "Not Tracked"
    assert a.channel is None                     # non-structural NULL stays NULL
    assert a.spend_is_credit is True and a.spend == 0.0
    b = by_imp[0]
    assert b.sub_channel == "VIDEO"              # case-sensitive typo map
    assert b.site == ""                          # whitespace-only -> "" (not filled)
    assert b.spend_is_credit is False and b.spend == 0.0
    c = by_imp[5]
    assert c.spend == 0.0                        # bad number -> 0


def test_duplicates_after_trim_collapse(spark):
    rows = [("2024-11-24", "A ", "S", "D", "X", "1", 1, Decimal("1")),
            ("2024-11-24", "A", "S", "D", "X", "1", 1, Decimal("1"))]
    assert clean(_raw(spark, rows)).count() == 1


def test_week_without_positive_target_is_null(spark):
    rows = [("2024-11-24", "A", "S", "D", "X", "1", 1, Decimal("0")),
            ("2024-11-24", "B", "S", "D", "X", "1", 1, None),
            ("2024-12-01", "B", "S", "D", "X", "1", 1, Decimal("30")),
            ("2024-12-01", "C", "S", "D", "X", "1", 1, Decimal("10"))]
    got = {r.week: r.total_sales for r in weekly_true_sales(clean(_raw(spark, rows))).collect()}
    assert got[dt.date(2024, 11, 24)] is None
    assert got[dt.date(2024, 12, 1)] == Decimal("10.00")


def test_weight_priority_fallback_and_unknown_week(spark):
    schema = "week date, spend double, impressions bigint, hh_grps_tv bigint, base_amount double"
    w1, w2 = dt.date(2024, 1, 7), dt.date(2024, 1, 14)
    rows = [(w1, 0.0, 50, 0, 10.0), (w1, 0.0, 100, 0, 20.0), (w1, 0.0, 0, 0, 10.0),
            (w2, 0.0, 0, 0, None)]
    out = allocate_sales(spark.createDataFrame(rows, schema)).orderBy("week", "impressions").collect()
    w = [r.activity_weight for r in out]
    assert w[:3] == [1.0, 0.5, 1.0]              # fallback 1.0, then 50/100, 100/100
    assert abs(sum(r.estimated_sales for r in out[:3]) - 10.0) < 1e-9
    assert out[3].estimated_sales == 0.0         # unknown week -> 0


def test_zero_denominator_and_constant_corr(spark):
    df = spark.createDataFrame([(1.0, 0.0, 1.0), (2.0, 0.0, 1.0), (3.0, 0.0, 1.0)], "a double, b double, c double")
    assert df.select(safe_div("a", "b").alias("r")).first().r is None
    row = df.agg(safe_corr("a", "c").alias("r"), safe_corr("a", "a").alias("s")).first()
    assert row.r is None and abs(row.s - 1.0) < 1e-12


def test_iso_week_at_year_end(spark):
    df = spark.createDataFrame([(dt.date(2023, 1, 1),), (dt.date(2024, 12, 30),)], "week date")
    assert [r.week_number for r in date_parts(df).collect()] == [52, 1]


def test_severity_limits(spark):
    from mixlens.operators.quality import missing_detailed
    # 50.0 % missing -> Moderate (not High); 10.0 % -> Low
    rows = [(None if i < 5 else 1, None if i < 1 else 1) for i in range(10)]
    df = spark.createDataFrame(rows, "site int, clicks int")
    got = {r.column: r.severity for r in missing_detailed(df).collect()}
    assert got == {"site": "Moderate", "clicks": "Low"}


def test_no_nan_or_inf_in_ratios(spark):
    from mixlens.operators.efficiency import row_ratios
    df = spark.createDataFrame([(0.0, 0, 0, 0, 0, 0, 0.0)], "spend double, impressions bigint, clicks bigint, "
                               "engagements bigint, video_starts bigint, video_completes bigint, "
                               "estimated_sales double")
    r = row_ratios(df).first().asDict()
    assert all(r[k] is None for k in ["ctr", "cpc", "cpm", "cost_per_sale", "engagement_rate"])
    assert F is not None


def test_candidate_with_zero_max_is_skipped(spark):
    schema = "week date, spend double, impressions bigint, hh_grps_tv bigint, engagements bigint, base_amount double"
    w = dt.date(2024, 1, 7)
    rows = [(w, 0.0, 0, 0, 4, 10.0), (w, 0.0, 0, 0, 2, 10.0)]       # spend/impressions/GRPs max 0
    out = sorted(r.activity_weight for r in allocate_sales(spark.createDataFrame(rows, schema)).collect())
    assert out == [0.5, 1.0]                                          # engagements / max(engagements)


def test_forecast_diff_is_zero_when_lag2_is_zero(spark):
    from mixlens.operators.forecast import step_features
    row = spark.createDataFrame([([5.0, 0.0, 7.0],)], "hist array<double>").select(
        *[c.alias(n) for n, c in step_features(F.col("hist")).items()]).first()
    assert row.sales_lag_1 == 7.0 and row.sales_lag_2 == 0.0 and row.sales_diff_1 == 0.0
    assert row.sales_lag_4 == 0.0                                     # before the start -> 0
    assert row.sales_ratio_to_mean_8 == 7.0 / 4.0


def test_duplicates_with_colliding_digests_and_a_full_filter(spark):
    from mixlens.operators.clean import count_duplicates, drop_exact_duplicates
    rows = [(i % 7, None if i % 3 else "x", float(i % 2)) for i in range(60)] + [(99, "alone", 0.0), (None, None, None)]
    df = spark.createDataFrame(rows, "a int, b string, c double")
    want = sorted(map(str, set(rows)))

    def same(d):                                                      # every row has the same digest
        return F.lit(1).cast("long"), F.lit(1).cast("long")

    def halves(d):                                                    # and here one of two
        return F.coalesce(F.col("a") % 2, F.lit(0)).cast("long"), F.lit(5).cast("long")

    from mixlens.operators.clean import row_digest
    for digest in (row_digest, same, halves):
        assert sorted(str(tuple(r)) for r in drop_exact_duplicates(df, digest).collect()) == want
        assert count_duplicates(df, digest).first()["duplicates"] == len(rows) - len(set(rows))
    # NULL equals NULL, and a NULL in another column is another row
    pair = spark.createDataFrame([("x", None), (None, "x"), (None, "x")], "a string, b string")
    assert drop_exact_duplicates(pair).count() == 2
    assert drop_exact_duplicates(df.limit(0)).count() == 0 and count_duplicates(df.limit(0)).first()["duplicates"] == 0


def test_a_week_with_a_third_of_the_rows(spark):
    rows = [(dt.date(2024, 1, 7) + dt.timedelta(weeks=0 if i % 3 == 0 else i % 50 + 1), float(i % 11), 100.0) for i in range(3000)]
    df = spark.createDataFrame(rows, "week date, spend double, base_amount double").repartition(8)
    for threshold in ("10m", "-1"):                                   # with and without a broadcast
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            got = allocate_sales(df).groupBy("week").agg(F.sum("estimated_sales").alias("s"), F.count("*").alias("n")).collect()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert len(got) == 51 and sum(r.n for r in got) == 3000
        assert all(abs(r.s - 100.0) < 1e-9 for r in got)


def test_absent_columns_are_left_out(spark):
    """Every metric dropped in turn: no view of sums and ratios raises, and what is left agrees."""
    from mixlens.operators.eda import kpi_summary, top_creatives
    from mixlens.operators.efficiency import efficiency_all_dims, efficiency_by, row_ratios
    w = dt.date(2024, 1, 7)
    cols = "week date, channel string, creative string, spend double, impressions bigint, clicks bigint, engagements bigint, " \
           "video_starts bigint, video_completes bigint, base_amount double, estimated_sales double"
    df = spark.createDataFrame([(w, "a", "c1", 2.0, 10, 4, 5, 6, 3, 9.0, 3.0), (w, "b", None, 1.0, 20, 2, 1, 0, 0, 9.0, 6.0)], cols)
    views = {"ratios": row_ratios, "by": lambda d: efficiency_by(d, "channel"), "dims": lambda d: efficiency_all_dims(d, ["channel", "creative"]),
             "kpi": kpi_summary, "top": top_creatives}
    full = {k: v(df) for k, v in views.items()}
    for gone in ["spend", "impressions", "clicks", "engagements", "video_starts", "video_completes"]:
        for k, view in views.items():
            out = view(df.drop(gone))
            assert gone not in out.columns and set(out.columns) < set(full[k].columns) | {"x"}
            keep = out.columns
            assert sorted(map(str, out.collect())) == sorted(map(str, full[k].select(*keep).collect()))
    assert efficiency_all_dims(df.drop("creative"), ["channel", "creative"]).count() == 2


def test_rows_dealt_once_compare_like_digests_first(spark):
    """Pieces, ranges of a column, crowded slots and equal digests: the same rows as a plain distinct."""
    from mixlens.operators.clean import count_duplicates, drop_duplicates_dealt, drop_exact_duplicates, row_digest
    rows = [(i % 7, None if i % 3 else "x", float(i % 2)) for i in range(60)] + [(99, "alone", 0.0), (None, None, None)] + [(5, "hot", 1.0)] * 50
    df = spark.createDataFrame(rows, "a int, b string, c double").repartition(5)
    want = sorted(map(str, set(rows)))

    def same(d):
        return F.lit(1).cast("long"), F.lit(1).cast("long")

    for digest in (row_digest, same):
        for hot in (2, 40, 1000):
            for by in (None, F.col("a")):
                got = drop_duplicates_dealt(df, 3, by, digest, slots=64, hot=hot)
                assert got.columns == df.columns and sorted(str(tuple(r)) for r in got.collect()) == want
            assert sorted(str(tuple(r)) for r in drop_exact_duplicates(df, digest, 64, hot).collect()) == want
            assert count_duplicates(df, digest, 64, hot).first()["duplicates"] == len(rows) - len(set(rows))
    assert drop_duplicates_dealt(df.limit(0), 3).count() == 0


def test_cleaning_counts_are_those_of_the_two_steps(spark):
    from mixlens.operators.clean import cleaning_counts, count_duplicates
    rows = [("2024-11-24", "A ", "S", "D", "X", "1", 1, Decimal("1")), ("11/24/2024", "A", "S", "D", "X", "1", 1, Decimal("1")),
            ("2024-11-24", "A ", "S", "D", "X", "1", 1, Decimal("1")), (None, None, None, None, None, None, None, None),
            (None, None, None, None, None, None, None, None), ("2024-11-23", "A", "S", "D", "X", "1", 1, Decimal("1")),
            ("2024-11-24", "B", "S", "D", "X", "x", 1, Decimal("1"))]
    raw = _raw(spark, rows)
    for hot in (1, 3, 1000):
        got = cleaning_counts(raw, 3, hot=hot).first()
        assert (got["duplicates"], got["clean_rows"]) == (2, 3)
    assert count_duplicates(raw).first()["duplicates"] == 2 and clean(raw).count() == 3 and clean(raw, pieces=2).count() == 3
    assert tuple(cleaning_counts(raw.limit(0), 1).first()) == (0, 0)
