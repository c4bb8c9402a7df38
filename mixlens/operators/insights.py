"""Templated insights (K1-K9) as rows: (section, seq, rule_id, subject, value, text).

Every number comes from a Spark aggregate over the analysed tables; only the sentence
templates are fixed text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SECTIONS = ["Marketing Insights", "Media Recommendations", "Optimization Suggestions"]

# advice that depends on no number
EXTERNAL_REGRESSORS = (
    "Media activity alone explains little of weekly sales here. Bring in what the file lacks (prices and "
    "promotions, distribution, competitors, holidays) before spending more effort on model settings.")
RERUN_DEDUP = (
    "Repeat the sales repair check on every new extract: copies of one weekly total across rows come from "
    "the way the file is produced, and that way may change.")
INCREMENTALITY = (
    "Correlation does not show what media adds. Run controlled tests, by region or by matched markets, on the "
    "two channels with the highest spend before moving budget on the allocated figures.")


def _money(c):
    return F.concat(F.lit("$"), F.format_number(c, 0))


def facts(rows: DataFrame, weekly: DataFrame, dim: str = "channel", eff_dim: str = "channel",
          corr_cols=None) -> DataFrame:
    """Numeric facts behind K1, K2, K4, K5 and K6 as (rule_id, subject, value)."""
    from .eda import corr_with_target
    from .efficiency import efficiency_by
    share = rows.groupBy(dim).agg(F.sum("estimated_sales").alias("v"))
    tot = share.agg(F.sum("v").alias("t"), F.min_by(dim, F.struct(-F.col("v"), F.col(dim))).alias("top"),
                    F.min_by(dim, F.struct("v", F.col(dim))).alias("bottom"),
                    F.max("v").alias("top_v"), F.min("v").alias("bottom_v"), F.count("*").alias("n"))
    def fact(rule, subject, value, share):
        return F.struct(F.lit(rule).alias("rule_id"), subject.cast("string").alias("subject"),
                        value.cast("double").alias("value"), share.cast("double").alias("share"))
    k1 = tot.select(F.inline(F.array(
        fact("K1_top", F.col("top"), F.col("top_v"), F.try_divide("top_v", "t")),
        fact("K1_bottom", F.col("bottom"), F.col("bottom_v"), F.try_divide("bottom_v", "t")),
        fact("K5_categories", F.lit(dim), F.col("n"), F.lit(None)))))
    cw = corr_with_target(weekly, corr_cols or ["spend", "impressions", "clicks", "engagements", "reach",
                                                "video_starts", "video_completes", "hh_grps_tv", "likes",
                                                "comments"])
    k2 = cw.where(F.col("r").isNotNull()).agg(F.max_by(F.struct("feature", "r"), F.abs("r")).alias("b")) \
           .select(F.lit("K2_strongest_corr").alias("rule_id"), F.col("b.feature").alias("subject"),
                   F.col("b.r").alias("value"), F.lit(None).cast("double").alias("share"))
    eff = efficiency_by(rows, eff_dim)
    paid = eff.where(F.col("cpc").isNotNull() & (F.col("spend") > 0))
    k4 = paid.agg(F.min_by(F.struct(F.col(eff_dim).alias("d"), F.col("cpc").alias("c")),
                           F.struct("cpc", F.col(eff_dim))).alias("b")) \
             .where(F.col("b").isNotNull()) \
             .select(F.lit("K4_best_cpc").alias("rule_id"), F.col("b.d").cast("string").alias("subject"),
                     F.col("b.c").alias("value"), F.lit(None).cast("double").alias("share"))
    gaps = eff.where((F.col("spend") == 0) & (F.col("impressions") > 0)) \
              .select(F.lit("K6_spend_gap").alias("rule_id"), F.col(eff_dim).cast("string").alias("subject"),
                      F.col("impressions").cast("double").alias("value"),
                      F.lit(None).cast("double").alias("share"))
    return k1.unionByName(k2).unionByName(k4).unionByName(gaps)


def generate(spark: SparkSession, fact_rows: DataFrame, champion: dict | None, top_shap: str | None,
             test_weeks: int = 12) -> DataFrame:
    """K9: assemble the three sections; K3/K7 use the SHAP ranking and the leaderboard."""
    f = fact_rows
    pct = F.format_string("%.1f%%", F.col("share") * 100)
    txt = (
        F.when(F.col("rule_id") == "K1_top", F.concat(
            F.lit("Largest contributor: **"), F.col("subject"), F.lit("** with "), pct,
            F.lit(" of allocated sales, "), _money(F.col("value")), F.lit(" in all.")))
        .when(F.col("rule_id") == "K1_bottom", F.concat(
            F.lit("Smallest contributor: **"), F.col("subject"), F.lit("** with "), _money(F.col("value")),
            F.lit("; a small planned budget test would show whether it can grow.")))
        .when(F.col("rule_id") == "K2_strongest_corr", F.concat(
            F.lit("**"), F.col("subject"), F.lit("** moves most closely with weekly sales, "),
            F.when(F.col("value") > 0, F.lit("in the same direction")).otherwise(F.lit("in the opposite direction")),
            F.format_string(" (r = %.2f).", F.col("value"))))
        .when(F.col("rule_id") == "K4_best_cpc", F.concat(
            F.lit("Cheapest paid clicks: **"), F.col("subject"), F.lit("** at "), _money(F.col("value")),
            F.lit(" a click.")))
        .when(F.col("rule_id") == "K6_spend_gap", F.concat(
            F.lit("**"), F.col("subject"), F.lit("** has impressions but no recorded spend; find the missing cost."))))
    section = F.when(F.col("rule_id").startswith("K1") | F.col("rule_id").startswith("K2"), SECTIONS[0]) \
               .otherwise(SECTIONS[1])
    base = f.where(F.col("rule_id") != "K5_categories").select(
        section.alias("section"), "rule_id", "subject", "value", txt.alias("text"))
    k5 = f.where((F.col("rule_id") == "K5_categories") & (F.col("value") > 1)).select(
        F.lit(SECTIONS[1]).alias("section"), F.lit("K5_incrementality").alias("rule_id"), "subject", "value",
        F.lit(INCREMENTALITY).alias("text"))
    extra = []
    if top_shap:
        extra.append((SECTIONS[0], "K3_top_shap", top_shap, None,
                      f"**{top_shap}** has the largest mean SHAP value in the chosen model."))
    if champion:
        extra.append((SECTIONS[2], "K7_champion", champion["model"], float(champion["rmse"]),
                      f"Over the last {test_weeks} known weeks **{champion['model']}** errs least: RMSE "
                      f"${champion['rmse']:,.0f}, MAPE {champion['mape_pct']:.1f}%."))
    extra += [(SECTIONS[2], "K8_regressors", None, None, EXTERNAL_REGRESSORS),
              (SECTIONS[2], "K8_rerun_dedup", None, None, RERUN_DEDUP)]
    lit = spark.createDataFrame(extra, "section string, rule_id string, subject string, value double, text string")
    out = base.unionByName(k5).unionByName(lit)
    order = F.array_position(F.array(*[F.lit(s) for s in SECTIONS]), F.col("section"))
    # a handful of rows by construction: one per rule, K6 at most one per category
    inside = Window.partitionBy("section").orderBy("rule_id", F.col("subject").asc_nulls_last())
    return (out.withColumn("seq", F.row_number().over(inside)).withColumn("section_order", order)
            .select("section_order", "section", "seq", "rule_id", "subject", "value", "text"))
