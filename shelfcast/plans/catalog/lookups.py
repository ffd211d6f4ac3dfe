"""Ordered lookups and top-k reports over the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.operators import monitor, report
from shelfcast.plans.catalog.base import query, rd, rds, rounded
from shelfcast.plans.catalog.scans import ALERTS_SQL, alert_documents
from shelfcast.session import fresh_path
from shelfcast.sources import sinks, tables
from shelfcast.sources.retail import MODEL, Retail


@query(
    "win_latest_prediction",
    f"""SELECT store_id, family_id, id, target_date, {rds('predicted_sales')} FROM (
  SELECT *, row_number() OVER (PARTITION BY store_id, family_id ORDER BY target_date DESC) AS rn FROM t_pred)
WHERE rn = 1""",
)
def _(r: Retail) -> DataFrame:
    newest = report.latest_prediction(r.predictions())
    return rounded(newest.select("store_id", "family_id", "id", "target_date", "predicted_sales"))


@query(
    "top_recent_predictions",
    f"""SELECT id, {rds('predicted_sales')}, sales AS actual_sales, {rd('predicted_sales - sales')} AS error,
  {rd('abs(predicted_sales - sales) / sales * 100')} AS percentage_error,
  {rd('greatest(0, 100 - abs(predicted_sales - sales) / sales * 100)')} AS accuracy
FROM (SELECT * FROM t_pred ORDER BY created_at DESC, id LIMIT 10) p JOIN t_facts a
  ON a.store_id = p.store_id AND a.family_id = p.family_id AND a.date = p.target_date""",
)
def _(r: Retail) -> DataFrame:
    sales = r.panel()
    newest = report.recent_predictions(r.predictions(sales), r.historical_sales(sales), 10)
    wanted = ("id", "predicted_sales", "actual_sales", "error", "percentage_error", "accuracy")
    return rounded(newest.select(*wanted), "predicted_sales", "error", "percentage_error", "accuracy")


@query(
    "top_recent_targets",
    f"""SELECT id, target_date, {rds('predicted_sales')} FROM t_pred
WHERE store_id = 4 AND target_date >= (SELECT max(date) FROM t_sales) - 365
ORDER BY target_date DESC, id LIMIT 100""",
)
def _(r: Retail) -> DataFrame:
    rows = report.recent_targets(r.predictions(), 365, 100, r.newest_day(), store_id=4)
    return rounded(rows.select("id", "target_date", "predicted_sales"))


@query(
    "srt_prediction_history",
    f"SELECT id, prediction_date, {rds('predicted_sales')} FROM t_pred WHERE store_id = 4 AND family_id = 1",
)
def _(r: Retail) -> DataFrame:
    history = report.prediction_history(r.predictions(), 4, 1)
    return rounded(history.select("id", "prediction_date", "predicted_sales"))


@query(
    "srt_sales_history",
    "SELECT date, sales, onpromotion FROM t_facts WHERE store_id = 4 AND family_id = 2 "
    "AND date >= (SELECT max(date) FROM t_sales) - 730",
)
def _(r: Retail) -> DataFrame:
    history = report.sales_history(r.historical_sales(), 4, 2, 730, r.newest_day())
    return history.select("date", "sales", "onpromotion")


@query(
    "srt_entity_list",
    "SELECT 'store' AS kind, CAST(store_nbr AS VARCHAR) AS name FROM t_stores UNION ALL "
    "SELECT 'family', name FROM t_families",
)
def _(r: Retail) -> DataFrame:
    stores = report.entities(r.stores(), "store_nbr")
    families = report.entities(r.families(), "name")
    return stores.select(F.lit("store").alias("kind"), F.col("store_nbr").cast("string").alias("name")).unionByName(
        families.select(F.lit("family").alias("kind"), "name")
    )


IMPORTANCE_SQL = """SELECT model_version, feature_name, arg_max(importance_value, timestamp) AS importance_value
FROM t_imp GROUP BY 1, 2"""


@query("srt_importance", f"SELECT model_version, feature_name, {rds('importance_value')} FROM ({IMPORTANCE_SQL})")
def _(r: Retail) -> DataFrame:
    return rounded(report.latest_importance(r.feature_importance(), MODEL))


@query(
    "top_importance",
    f"SELECT model_version, feature_name, {rds('importance_value')} FROM ({IMPORTANCE_SQL}) "
    "ORDER BY importance_value DESC, feature_name LIMIT 10",
)
def _(r: Retail) -> DataFrame:
    return rounded(report.top_importance(report.latest_importance(r.feature_importance(), MODEL), 10))


@query(
    "srt_metric_history",
    f"SELECT model_version, metric_name, timestamp, {rds('metric_value')} FROM t_metrics "
    "WHERE timestamp >= (SELECT max(timestamp) FROM t_metrics) - 365",
)
def _(r: Retail) -> DataFrame:
    history = report.metric_history(r.model_metrics(), MODEL, 365)
    return rounded(history.select("model_version", "metric_name", "timestamp", "metric_value"))


@query(
    "srt_drift_history",
    f"SELECT model_version, drift_metric, timestamp, {rds('drift_value threshold')}, exceeded_threshold FROM t_drift "
    "WHERE model_version = '2000' AND timestamp >= "
    "(SELECT max(timestamp) FROM t_drift WHERE model_version = '2000') - 90",
)
def _(r: Retail) -> DataFrame:
    history = report.drift_history(r.model_drift(), MODEL, 90, "2000")
    return rounded(history.drop("model_name"))


@query(
    "srt_recent_alerts",
    f"SELECT day AS timestamp, n AS n_rows, {rd('score')} AS score FROM ({ALERTS_SQL}) WHERE CAST(day AS DATE) >= "
    f"(SELECT max(CAST(day AS DATE)) FROM ({ALERTS_SQL})) - 30",
)
def _(r: Retail) -> DataFrame:
    """Alert documents of the last 30 days before the newest one."""
    folder = fresh_path(r.spark, "alerts")
    sinks.write_documents(alert_documents(r), folder)
    docs = tables.read_documents(r.spark, folder)
    newest = docs.agg(F.max(F.to_timestamp("timestamp"))).scalar()
    recent = monitor.recent_alerts(docs, newest, 30)
    return rounded(
        recent.select(
            "timestamp", F.col("data.n_rows").alias("n_rows"), F.col("data.overall_drift_score").alias("score")
        )
    )
