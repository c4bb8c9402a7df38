"""Batch entry point: the whole analysis as one Spark application.

    spark-submit -m mixlens.cli --tables /data/tpch --out /data/mixlens-out
    spark-submit -m mixlens.cli --export /data/media.csv --format csv --out /data/mixlens-out

Writes the row-level, weekly, weekly-sales and raw tables (Parquet, row level partitioned by
year), the executive and breakdown views, the model leaderboard, the champion's forecast
with its band (Parquet and CSV), the SHAP ranking, the weekly correlations and the insights.
Every output is produced by the registered views of ``mixlens.plans.catalog``.
"""

from __future__ import annotations

import argparse
import json
import sys

from .plans.catalog import QUERIES, suite
from .plans.context import context
from .session import get_session
from .sources.io import save_fit, save_table, save_table_set

OUTPUT_VIEWS = [
    "kpi_summary", "breakdown_media_type", "breakdown_all_dims", "top_creatives", "efficiency_all_dims",
    "correlation_matrix", "corr_with_sales", "missing_detailed", "quality_summary", "leaderboard",
    "shap_global", "insights",
]


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="mixlens", description=__doc__.split("\n\n")[0])
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--tables", help="folder of TPC-H-style Parquet tables")
    src.add_argument("--export", help="a media export with spreadsheet headers")
    ap.add_argument("--format", default="parquet", help="format of --export (parquet or csv)")
    ap.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
    ap.add_argument("--master", default=None, help="Spark master; leave unset under spark-submit")
    ap.add_argument("--boost-rounds", type=int, default=None,
                    help="boosting rounds for the boosted-tree, Huber and stacking models "
                         "(default: the analysed workflow's 500)")
    args = ap.parse_args(argv)

    spark = get_session(args.master)
    source = args.tables or f"export:{args.format}:{args.export}"
    ctx = context(spark, source)
    out = args.out.rstrip("/")
    save_table_set({"row_level": ctx.row_level(), "weekly": ctx.weekly(), "weekly_sales": ctx.weekly_sales(),
                    "raw": ctx.raw()}, out)
    summary = {}
    models = suite(spark, source, rounds=args.boost_rounds)      # the views below use these fits
    for name in OUTPUT_VIEWS:
        df = QUERIES[name](spark, source)
        save_table(df, f"{out}/{name}")
        summary[name] = f"{out}/{name}"
    fc = QUERIES["champion_forecast"](spark, source)
    save_table(fc, f"{out}/forecast")
    save_table(fc, f"{out}/forecast_csv", fmt="csv")
    summary["forecast"] = f"{out}/forecast"
    # the leaderboard has fitted all six models once; they are saved with their feature list and caps
    for key in ("ridge", "arx", "forest", "gbt", "huber", "stack"):
        save_fit(spark, models.fit(key), f"{out}/models/{key}", models.feats, models.caps)
        summary[f"models/{key}"] = f"{out}/models/{key}"
    print(json.dumps(summary, indent=1))
    return 0


if __name__ == "__main__":
    sys.exit(main())
