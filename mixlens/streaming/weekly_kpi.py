"""Incremental weekly KPI repair on a stream of media rows (D1 + D2 as Structured
Streaming).

New row files arrive in a folder (or any streaming source); the weekly aggregate keeps,
per week, the minimum positive KPI copy and the additive sums. Both are mergeable, so
Spark's state store holds one small row per week and late rows for an old week simply
update it. Each micro-batch's full result (one row per week, bounded by the calendar)
replaces a Parquet table through ``foreachBatch``.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.measure import true_kpi_expr
from ..session import ensure_checkpoint_dir
from ..spec import DEFAULT_SPEC, MediaSpec


def weekly_kpi_stream(rows: DataFrame, spec: MediaSpec = DEFAULT_SPEC) -> DataFrame:
    """Streaming aggregate: (week, additive sums, total_sales)."""
    add = spec.present(rows, spec.additive)
    return (rows.where(F.col(spec.week_col).isNotNull())
                .groupBy(spec.week_col)
                .agg(*[F.sum(c).alias(c) for c in add], true_kpi_expr(spec.target_col).alias("total_sales")))


def _digest(path: str) -> str:
    """The same folder name for a path in every process, so a restart finds its checkpoint."""
    return hashlib.sha256(path.encode()).hexdigest()[:16]


def run_weekly_kpi(spark: SparkSession, source_path: str, out_path: str, schema,
                   spec: MediaSpec = DEFAULT_SPEC, files_per_trigger: int = 1,
                   checkpoint: str | None = None) -> DataFrame:
    """Drain ``source_path`` (Parquet rows) through the streaming aggregate and return the
    table it maintains at ``out_path``. The query checkpoint lives in the session's
    checkpoint folder, so a restarted job resumes where it stopped."""
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
                   .option("basePath", source_path).parquet(source_path))
    agg = weekly_kpi_stream(stream, spec)

    def write(batch: DataFrame, epoch: int):
        batch.write.mode("overwrite").parquet(out_path)

    ck = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/mixlens-stream/{_digest(out_path)}"
    q = (agg.writeStream.outputMode("complete").foreachBatch(write)
            .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out_path)


def run_weekly_kpi_final(spark: SparkSession, source_path: str, out_path: str, schema, late_weeks: int = 4,
                         spec: MediaSpec = DEFAULT_SPEC, files_per_trigger: int = 1,
                         checkpoint: str | None = None) -> DataFrame:
    """Append-mode variant for unbounded streams: a week's KPI is final (and written once)
    when the event-time watermark is ``late_weeks`` past it. Rows arriving later than that
    are dropped by the watermark; until then, late rows still update the week. State holds
    only the open weeks."""
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
                   .option("basePath", source_path).parquet(source_path))
    ts = F.col(spec.week_col).cast("timestamp")
    add = spec.present(stream, spec.additive)
    agg = (stream.where(F.col(spec.week_col).isNotNull())
                 .withColumn("_week_ts", ts)
                 .withWatermark("_week_ts", f"{7 * late_weeks} days")
                 .groupBy("_week_ts")
                 .agg(*[F.sum(c).alias(c) for c in add], true_kpi_expr(spec.target_col).alias("total_sales"))
                 .withColumn(spec.week_col, F.to_date("_week_ts")).drop("_week_ts"))
    ck = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/mixlens-stream-final/{_digest(out_path)}"
    q = (agg.writeStream.outputMode("append").format("parquet").option("path", out_path)
            .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out_path)
