"""Data-quality views (D19-D21, D25, D26). Each is a few global aggregates over the raw rows;
several one-row results are combined without a join (``merge_rows``). Duplicates are counted
digest first, so no step moves whole rows but those whose digest repeats."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.joins import merge_rows
from ..spec import DEFAULT_SPEC, MediaSpec
from .clean import cleaning_counts, count_duplicates

# Severity limits (percent) and the action text per structurally filled
# column, as shown by the analysed workflow.
SEVERITY_HIGH = 50
SEVERITY_MODERATE = 10
ACTIONS = {
    "site": "Filled → 'Unknown' (structural)",
    "device": "Filled → 'Not Tracked' (structural)",
    "platform_type": "Filled → 'Unknown' (structural)",
    "partner_type": "Filled → 'Not Applicable' (structural)",
    "audience": "Filled → 'Not Applicable' (structural)",
    "creative": "Filled → 'Unspecified Creative' (structural)",
}
DEFAULT_ACTION = "Left as NaN (metric — zero-fill)"
# The labels of the cleaning impact's steps and of the flow's nodes, in their order.
WATERFALL_STEPS = ["Raw Data Issues", "Structural NAs Filled", "Typos Corrected", "Duplicates Removed",
                   "Negative Spend Flagged", "Metric NAs (zero-filled)", "Remaining Issues"]
FLOW_NODES = ["Raw Data", "Missing Cells", "Text Cleaning", "Structural NA Fill", "Duplicate Check",
              "Spend Flagging", "Clean Data"]


def missing_report(raw: DataFrame) -> DataFrame:
    """NULL count and percent (2 dp, half-even) per column with any NULL."""
    cols = raw.columns
    row = raw.agg(F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("missing_count")) for c in cols])
    out = row.select("_n", F.inline(entries))
    return (out.where(F.col("missing_count") > 0)
               .withColumn("missing_pct", F.bround(F.col("missing_count") / F.col("_n") * 100, 2))
               .drop("_n"))


def missing_detailed(raw: DataFrame, spec: MediaSpec = DEFAULT_SPEC) -> DataFrame:
    """D19 + severity (> 50 High, > 10 Moderate, else Low), action and category."""
    pct = F.col("missing_pct")
    action = F.element_at(F.create_map(*[F.lit(x) for kv in ACTIONS.items() for x in kv]), F.col("column"))
    return missing_report(raw).withColumns({
        "severity": F.when(pct > SEVERITY_HIGH, "High").when(pct > SEVERITY_MODERATE, "Moderate")
                     .otherwise("Low"),
        "action_taken": F.coalesce(F.when(F.col("column").isin(list(ACTIONS)), action), F.lit(DEFAULT_ACTION)),
        "category": F.when(F.col("column").isin(list(spec.fills)), "Structural").otherwise("Metric"),
    })


def quality_summary(raw: DataFrame, clean_rows: DataFrame, spec: MediaSpec = DEFAULT_SPEC,
                    clean_columns: int | None = None, pieces: int | None = None) -> DataFrame:
    """Eleven numbers. Duplicates are counted on raw rows, distinct weeks on the
    unaligned dates, typos after trimming. ``clean_columns`` is the width of the published
    row-level table (defaults to the width of ``clean_rows``). With ``pieces`` the duplicates and the cleaned rows
    are counted in one dealing of the raw rows."""
    from ..functions.exprs import trim_ws
    cols = raw.columns
    n_cols = len(cols)
    missing = sum((F.col(c).isNull().cast("bigint") for c in cols), F.lit(0).cast("bigint"))
    fills = [c for c in spec.fills if c in cols]
    filled = sum((F.col(c).isNull().cast("bigint") for c in fills), F.lit(0).cast("bigint"))
    typo_cols = [c for c in spec.typos if c in cols]
    typo = F.lit(False)
    for c in typo_cols:
        for bad in spec.typos[c]:
            typo = typo | (trim_ws(F.col(c).cast("string")) == bad)
    neg = F.expr(f"try_cast(`{spec.spend_col}` as double)") < 0 if spec.spend_col in cols else F.lit(False)
    raw_stats = raw.agg(
        F.count("*").alias("total_rows"),
        F.sum(missing).alias("total_missing_cells"),
        F.coalesce(F.sum(typo.cast("bigint")), F.lit(0)).alias("typos_fixed"),
        F.sum(filled).alias("structural_nas_filled"),
        F.coalesce(F.sum(neg.cast("bigint")), F.lit(0)).alias("negative_spend_rows"))
    weeks = raw.select(spec.date_col).distinct().agg(F.count(spec.date_col).alias("distinct_weeks"))
    counts = [cleaning_counts(raw, pieces, spec)] if pieces else \
        [count_duplicates(raw), clean_rows.agg(F.count("*").alias("clean_rows"))]
    m = merge_rows(raw_stats, weeks, *counts)
    total_cells = F.col("total_rows") * F.lit(n_cols)
    return m.select(
        "total_rows",
        F.lit(n_cols).alias("total_columns"),
        F.coalesce(F.col("total_missing_cells"), F.lit(0)).alias("total_missing_cells"),
        F.when(total_cells > 0, F.bround(F.col("total_missing_cells") / total_cells * 100, 2))
         .otherwise(F.lit(0.0)).alias("missing_pct"),
        F.col("duplicates").alias("duplicates_dropped"),
        "typos_fixed",
        F.coalesce(F.col("structural_nas_filled"), F.lit(0)).alias("structural_nas_filled"),
        "negative_spend_rows",
        "distinct_weeks",
        "clean_rows",
        F.lit(clean_columns if clean_columns is not None else len(clean_rows.columns)).alias("clean_columns"))


def cleaning_waterfall(summary: DataFrame) -> DataFrame:
    """Signed steps of the cleaning impact; relative steps only when positive."""
    s = {c: F.col(c) for c in summary.columns}
    remaining = (s["total_missing_cells"] - s["structural_nas_filled"] - s["typos_fixed"]
                 - s["duplicates_dropped"] - s["negative_spend_rows"])
    steps = [
        (s["total_missing_cells"], "absolute", F.lit(True)),
        (-s["structural_nas_filled"], "relative", s["structural_nas_filled"] > 0),
        (-s["typos_fixed"], "relative", s["typos_fixed"] > 0),
        (-s["duplicates_dropped"], "relative", s["duplicates_dropped"] > 0),
        (-s["negative_spend_rows"], "relative", s["negative_spend_rows"] > 0),
        (-remaining, "relative", remaining > 0),
        (F.lit(0).cast("bigint"), "total", F.lit(True)),
    ]
    arr = F.array(*[F.struct(F.lit(i).alias("seq"), F.lit(n).alias("step"),
                             v.cast("bigint").alias("value"), F.lit(m).alias("measure"),
                             keep.alias("_keep")) for i, (n, (v, m, keep)) in enumerate(zip(WATERFALL_STEPS, steps))])
    return summary.select(F.inline(arr)).where("_keep").drop("_keep")


def cleaning_flow_edges(summary: DataFrame) -> DataFrame:
    """Flow edges raw -> checks -> clean with every value floored at 1."""
    s = {c: F.col(c) for c in summary.columns}
    one = F.lit(1)
    edges = [
        (0, 1, s["total_missing_cells"]),
        (0, 2, F.greatest(s["typos_fixed"], one)),
        (0, 3, F.greatest(s["structural_nas_filled"], one)),
        (0, 4, F.greatest(s["duplicates_dropped"], one)),
        (0, 5, F.greatest(s["negative_spend_rows"], one)),
        (1, 6, F.greatest(s["total_missing_cells"] - s["structural_nas_filled"], one)),
        (2, 6, F.greatest(s["typos_fixed"], one)),
        (3, 6, F.greatest(s["structural_nas_filled"], one)),
        (4, 6, F.greatest(s["duplicates_dropped"], one)),
        (5, 6, F.greatest(s["negative_spend_rows"], one)),
    ]
    arr = F.array(*[F.struct(F.lit(FLOW_NODES[a]).alias("source"), F.lit(FLOW_NODES[b]).alias("target"),
                             v.cast("bigint").alias("value")) for a, b, v in edges])
    return summary.select(F.inline(arr))
