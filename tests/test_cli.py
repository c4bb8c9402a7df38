"""The batch entry point writes every output it names."""
import json
import os
import tempfile

import pytest

from mixlens.session import ensure_checkpoint_dir

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")
def test_cli_writes_all_outputs(spark, capsys):
    from mixlens import cli
    from mixlens.plans.context import context
    out = tempfile.mkdtemp(dir=ensure_checkpoint_dir(spark).replace("file:", ""))
    ctx = context(spark, SF)
    kept, ctx._suite = getattr(ctx, "_suite", None), None
    try:
        assert cli.main(["--tables", SF, "--out", out, "--boost-rounds", "3"]) == 0
        assert ctx._suite.rounds == 3 and len(ctx._suite.fit("huber").trees) == 3
    finally:
        ctx._suite = kept
    written = json.loads(capsys.readouterr().out)
    for name in [*cli.OUTPUT_VIEWS, "forecast"]:
        assert spark.read.parquet(written[name]).count() > 0, name
    for table in ["row_level", "weekly", "weekly_sales", "raw"]:
        assert spark.read.parquet(f"{out}/{table}").count() > 0
    assert len(spark.read.option("header", True).csv(f"{out}/forecast_csv").collect()) == 12
    from mixlens.sources.io import load_fit
    for key in ["ridge", "arx", "forest", "gbt", "huber", "stack"]:
        assert load_fit(spark, written[f"models/{key}"])[1]
