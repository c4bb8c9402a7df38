"""The streaming weekly KPI equals the batch weekly aggregate after draining all files."""
import datetime as dt
import tempfile
import time
from decimal import Decimal

from mixlens.operators.measure import weekly_metrics
from mixlens.session import ensure_checkpoint_dir
from mixlens.streaming import run_weekly_kpi


def test_stream_equals_batch(spark):
    root = tempfile.mkdtemp(dir=ensure_checkpoint_dir(spark).replace("file:", ""))
    schema = "week date, spend decimal(18,2), impressions bigint, base_amount decimal(18,2)"
    w1, w2 = dt.date(2024, 1, 7), dt.date(2024, 1, 14)
    batches = [
        [(w1, Decimal("5.00"), 10, Decimal("30.00")), (w2, Decimal("1.00"), 2, Decimal("0"))],
        [(w1, Decimal("2.00"), 3, Decimal("10.00"))],               # late row for an old week
        [(w2, Decimal("4.00"), 1, Decimal("7.00")), (None, Decimal("9.00"), 9, Decimal("1.00"))],
    ]
    for i, b in enumerate(batches):
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(f"{root}/src")
    out = run_weekly_kpi(spark, f"{root}/src", f"{root}/out", spark.read.parquet(f"{root}/src").schema,
                         files_per_trigger=1, checkpoint=f"{root}/ck")
    batch = weekly_metrics(spark.read.parquet(f"{root}/src"))
    cols = ["week", "spend", "impressions", "total_sales"]
    assert sorted(map(tuple, out.select(*cols).collect())) == sorted(map(tuple, batch.select(*cols).collect()))
    got = {r.week: r.total_sales for r in out.collect()}
    assert got[w1] == Decimal("10.00") and got[w2] == Decimal("7.00")


def test_watermarked_weeks_are_final_once(spark):
    from mixlens.streaming import run_weekly_kpi_final
    root = tempfile.mkdtemp(dir=ensure_checkpoint_dir(spark).replace("file:", ""))
    schema = "week date, spend decimal(18,2), impressions bigint, base_amount decimal(18,2)"
    w = [dt.date(2024, 1, 7) + dt.timedelta(days=7 * i) for i in range(8)]
    batches = [
        [(w[0], Decimal("1.00"), 1, Decimal("20.00"))],
        [(w[0], Decimal("1.00"), 1, Decimal("10.00")), (w[1], Decimal("2.00"), 2, Decimal("5.00"))],  # late, in time
        [(w[6], Decimal("3.00"), 3, Decimal("7.00"))],          # moves the watermark past w0, w1
        [(w[6], Decimal("1.00"), 1, Decimal("9.00"))],          # late rows are judged by the previous
        [(w[0], Decimal("9.00"), 9, Decimal("1.00"))],          # batch's watermark: too late, dropped
        [(w[7], Decimal("1.00"), 1, Decimal("8.00"))],
    ]
    for b in batches:
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(f"{root}/src")
        time.sleep(1.1)          # the file source orders new files by modification time
    out = run_weekly_kpi_final(spark, f"{root}/src", f"{root}/out", spark.read.parquet(f"{root}/src").schema,
                               late_weeks=2, files_per_trigger=1, checkpoint=f"{root}/ck")
    got = {r.week: (r.spend, r.total_sales) for r in out.collect()}
    assert got[w[0]] == (Decimal("2.00"), Decimal("10.00"))   # late-but-allowed row counted, too-late row not
    assert got[w[1]] == (Decimal("2.00"), Decimal("5.00"))
    assert w[7] not in got                                   # still open: not final yet
