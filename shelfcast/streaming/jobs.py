"""Incremental monitoring of an event stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfcast.operators import monitor
from shelfcast.session import fresh_path


def read_events(
    spark: SparkSession, folder: str, pattern: str = "events.parquet", files_per_trigger: int = 1000
) -> DataFrame:
    """Event files as a stream, ``ts`` as a real timestamp so that it can carry a watermark."""
    columns = spark.read.parquet(f"{folder}/{pattern}").schema
    stream = (
        spark.readStream.schema(columns)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(folder)
    )
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def windowed_profile(events: DataFrame, width: str = "1 day", delay: str = "2 hours") -> DataFrame:
    """Count, mean, deviation and error rate per tumbling window; events later than the
    watermark are dropped. The same code runs on a stream and on a table."""
    source = events.withWatermark("ts", delay) if events.isStreaming else events
    return (
        source.groupBy(F.window("ts", width).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("value").alias("mean_value"),
            F.stddev_samp("value").alias("std_value"),
            F.avg((F.col("event_type") == "error").cast("double")).alias("error_rate"),
        )
        .select(F.col("w.start").alias("window_start"), "n", "mean_value", "std_value", "error_rate")
    )


def run_to_table(stream: DataFrame, label: str) -> DataFrame:
    """Process everything available, write finished rows to a new table, read it back."""
    spark = stream.sparkSession
    target, marks = fresh_path(spark, label), fresh_path(spark, f"{label}-progress")
    query = (
        stream.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", marks)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(target)


def drift_alerts(
    events: DataFrame,
    baseline: monitor.Baseline,
    numeric: Sequence[str],
    categorical: Sequence[str],
    model: str,
    target: str,
    progress: str,
) -> StreamingQuery:
    """Compare every micro-batch with the baseline and store its alert.

    A batch writes its own ``batch_id`` folder with overwrite, so a batch that is
    repeated after a failure replaces its alert instead of adding another.
    """

    def check(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            num = monitor.numeric_drift(baseline.numeric, baseline.values, kept, numeric)
            cat = monitor.categorical_drift(baseline.categorical, kept, categorical)
            score = monitor.drift_score(num, cat, len(numeric) + len(categorical))
            facts = kept.agg(F.count(F.lit(1)).alias("n_rows"), F.max("ts").alias("at"))
            moment = facts.first()["at"]
            alert = monitor.data_alert(
                score, num, cat, facts.select("n_rows"), model, F.lit(moment).cast("timestamp")
            )
            alert.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")
        finally:
            kept.unpersist()

    return (
        events.writeStream.foreachBatch(check)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
