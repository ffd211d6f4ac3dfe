"""Streaming jobs run to completion over the event files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.operators import monitor
from shelfcast.plans.catalog.base import query, rd, rounded
from shelfcast.plans.catalog.monitoring import CATEGORICAL, NUMERIC, categories_sql, drift_sql, score_sql, split
from shelfcast.session import fresh_path
from shelfcast.sources.retail import Retail
from shelfcast.streaming import jobs


@query(
    "st_windowed_profile",
    f"""SELECT day, n, {rd('m')} AS mean_value, {rd('s')} AS std_value, {rd('e')} AS error_rate
FROM (SELECT CAST(ts AS DATE) AS day, count(*) AS n, avg(value) AS m, stddev_samp(value) AS s,
             avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END) AS e FROM events GROUP BY 1)
WHERE day + 1 <= (SELECT max(ts) FROM events) - INTERVAL 2 HOURS""",
)
def _(r: Retail) -> DataFrame:
    """Daily windows the watermark has closed."""
    profile = jobs.windowed_profile(jobs.read_events(r.spark, r.root))
    stored = jobs.run_to_table(profile, "profile")
    day = F.col("window_start").cast("date").alias("day")
    return rounded(stored.select(day, "n", "mean_value", "std_value", "error_rate"))


LOWER_SQL = (
    "(SELECT event_id, ts, user_id + 1000 AS user_id, value * 0.5::DOUBLE AS value, event_type FROM t_old)"
)
BATCH_SCORE_SQL = score_sql(
    " UNION ALL ".join(drift_sql(c, LOWER_SQL, "events") for c in NUMERIC), categories_sql(LOWER_SQL, "events")
)


@query(
    "st_drift_alerts",
    f"""SELECT CAST(0 AS BIGINT) AS batch_id, 'data_drift' AS type, (SELECT count(*) FROM events) AS n_rows,
  (SELECT overall_drift_score FROM ({BATCH_SCORE_SQL})) AS score""",
)
def _(r: Retail) -> DataFrame:
    """Alerts of the micro-batches against a baseline whose values were lower."""
    old = r.raw("events").where(F.col("ts") < split())
    lower = old.withColumn("value", F.col("value") * 0.5).withColumn("user_id", F.col("user_id") + 1000)
    metrics = old.agg(F.avg("value").alias("metric_value")).select(F.lit("level").alias("metric_name"), "metric_value")
    path = fresh_path(r.spark, "baseline")
    monitor.set_baseline(lower, metrics, ["event_id"], NUMERIC, CATEGORICAL).save(path)
    base = monitor.Baseline.load(r.spark, path)
    target = fresh_path(r.spark, "stream-alerts")
    run = jobs.drift_alerts(
        jobs.read_events(r.spark, r.root), base, NUMERIC, CATEGORICAL, "events", target,
        fresh_path(r.spark, "stream-progress"),
    )
    run.awaitTermination()
    stored = r.spark.read.parquet(target)
    return stored.select(
        F.col("batch_id").cast("bigint").alias("batch_id"), "type", F.col("data.n_rows").alias("n_rows"),
        F.col("data.overall_drift_score").alias("score"),
    )


