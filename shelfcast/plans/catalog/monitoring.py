"""Drift, alerts, decisions and digests over the event and model tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.numeric import scale_columns
from shelfcast.operators import evaluate, monitor
from shelfcast.plans.catalog.base import METRIC_COLUMNS, query, rd, rds, rounded
from shelfcast.plans.catalog.scans import ALERTS_SQL, alert_documents
from shelfcast.session import fresh_path, settle
from shelfcast.sources.retail import Retail

def split() -> Column:
    """The moment that separates baseline events from new ones."""
    return F.lit("2024-01-16").cast("timestamp_ntz")


NUMERIC = ["value", "user_id"]
CATEGORICAL = ["event_type"]


def halves(r: Retail) -> tuple[DataFrame, DataFrame]:
    events = r.raw("events")
    return events.where(F.col("ts") < split()), events.where(F.col("ts") >= split())


def shifted(new: DataFrame) -> DataFrame:
    """New events with values 30 % up and errors renamed, so that drift is there to be found."""
    kind = F.when(F.col("event_type") == "error", "crash").otherwise(F.col("event_type"))
    return scale_columns(new, 1.3, ["value"]).withColumn("event_type", kind)


SHIFTED_SQL = (
    "(SELECT event_id, ts, user_id, value * 1.3::DOUBLE AS value, "
    "CASE WHEN event_type = 'error' THEN 'crash' ELSE event_type END AS event_type FROM t_new)"
)
SAMPLE_SQL = "(SELECT * FROM t_old ORDER BY md5('42|' || event_id), event_id LIMIT 1000)"


def _ks_sql(column: str, old: str, new: str) -> str:
    both = f"(SELECT {column} AS v, 1 AS o FROM {old} UNION ALL SELECT {column}, 0 FROM {new})"
    return f"""(SELECT max(abs(a / ta - b / tb)) AS d, max(ta) AS n, max(tb) AS m FROM (
  SELECT CAST(sum(o) OVER w AS DOUBLE) AS a, CAST(sum(c - o) OVER w AS DOUBLE) AS b,
         CAST(sum(o) OVER () AS DOUBLE) AS ta, CAST(sum(c - o) OVER () AS DOUBLE) AS tb
  FROM (SELECT v, sum(o) AS o, count(*) AS c FROM {both} GROUP BY 1) WINDOW w AS (ORDER BY v)))"""


def drift_sql(column: str, old: str = "t_old", new: str = SHIFTED_SQL) -> str:
    terms = "(SELECT unnest(generate_series(1, 100)) AS k)"
    p = (
        f"(SELECT greatest(0, least(1, sum((CASE WHEN k % 2 = 1 THEN 2 ELSE -2 END) * "
        f"exp(-2 * k * k * d * d * n * m / (n + m))))) FROM {terms})"
    )
    return f"""SELECT '{column}' AS feature, d AS ks_statistic,
  CASE WHEN d * sqrt(n * m / (n + m)) < 0.2 THEN 1 ELSE {p} END AS p_value,
  abs(om - nm) AS mean_diff, abs(os - ns) AS std_diff, d > 0.1 AS drift_detected
FROM {_ks_sql(column, old, new)}, (SELECT avg({column}) AS om, stddev_samp({column}) AS os FROM {old}),
     (SELECT avg({column}) AS nm, stddev_samp({column}) AS ns FROM {new})"""


NUMERIC_SQL = " UNION ALL ".join(drift_sql(c) for c in NUMERIC)


def categories_sql(old: str = "t_old", new: str = SHIFTED_SQL) -> str:
    return f"""
SELECT 'event_type' AS feature, least(1, sum(abs(p - coalesce(q, 0))) / 2) AS js_divergence,
       least(1, sum(abs(p - coalesce(q, 0))) / 2) > 0.1 AS drift_detected
FROM (SELECT event_type, count(*) / CAST((SELECT count(*) FROM {old}) AS DOUBLE) AS p FROM {old} GROUP BY 1)
LEFT JOIN (SELECT event_type, count(*) / CAST((SELECT count(*) FROM {new}) AS DOUBLE) AS q FROM {new} GROUP BY 1)
USING (event_type)"""


def score_sql(numeric: str, categorical: str) -> str:
    return f"""
SELECT CAST(((SELECT count(*) FROM ({numeric}) WHERE drift_detected)
     + (SELECT count(*) FROM ({categorical}) WHERE drift_detected)) AS DOUBLE) / 3 AS overall_drift_score"""


CATEGORICAL_SQL = categories_sql()
SCORE_SQL = score_sql(NUMERIC_SQL, CATEGORICAL_SQL)


def _baseline(r: Retail, old: DataFrame) -> monitor.Baseline:
    metrics = old.agg(F.avg("value").alias("metric_value")).select(F.lit("level").alias("metric_name"), "metric_value")
    path = fresh_path(r.spark, "baseline")
    monitor.set_baseline(old, metrics, ["event_id"], NUMERIC, CATEGORICAL).save(path)
    return monitor.Baseline.load(r.spark, path)


@query(
    "mon_set_baseline",
    f"""SELECT 'value' AS feature, '' AS category, {rd('avg(value)')} AS amount FROM t_old
UNION ALL SELECT 'user_id', '', {rd('avg(user_id)')} FROM t_old
UNION ALL SELECT 'event_type', event_type, {rd('count(*) / CAST(sum(count(*)) OVER () AS DOUBLE)')} FROM t_old GROUP BY event_type
UNION ALL SELECT 'sample', 'rows', CAST(count(*) AS DOUBLE) FROM {SAMPLE_SQL}""",
)
def _(r: Retail) -> DataFrame:
    """Baseline tables saved, loaded, and shown as one list."""
    old, _ = halves(r)
    base = _baseline(r, old)
    shown = base.numeric.select("feature", F.lit("").alias("category"), F.col("mean").alias("amount"))
    shown = shown.unionByName(base.categorical.withColumnRenamed("prob", "amount"))
    rows = base.sample.agg(F.count(F.lit(1)).cast("double").alias("amount"))
    return rounded(
        shown.unionByName(rows.select(F.lit("sample").alias("feature"), F.lit("rows").alias("category"), "amount"))
    )


@query(
    "mon_numeric_drift",
    f"SELECT feature, {rd('ks_statistic', 9)} AS ks_statistic, {rds('p_value mean_diff std_diff')}, drift_detected "
    f"FROM ({NUMERIC_SQL})",
)
def _(r: Retail) -> DataFrame:
    old, new = halves(r)
    base = _baseline(r, old)
    drift = monitor.numeric_drift(base.numeric, base.values, shifted(new), NUMERIC)
    return rounded(rounded(drift, "ks_statistic", digits=9), "p_value", "mean_diff", "std_diff")


@query(
    "mon_mean_shift",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, {rd('d / greatest(os, 1e-6)')} AS ks_statistic,
  CAST(CASE WHEN d / greatest(os, 1e-6) > 2 THEN 0.05 ELSE 0.5 END AS DOUBLE) AS p_value, {rd('d')} AS mean_diff,
  {rd('abs(os - ns)')} AS std_diff, d / greatest(os, 1e-6) > 0.1 AS drift_detected
  FROM (SELECT abs((SELECT avg({c}) FROM t_old) - (SELECT avg({c}) FROM {SHIFTED_SQL})) AS d,
  (SELECT stddev_samp({c}) FROM t_old) AS os, (SELECT stddev_samp({c}) FROM {SHIFTED_SQL}) AS ns)"""
        for c in NUMERIC
    ),
)
def _(r: Retail) -> DataFrame:
    old, new = halves(r)
    return rounded(monitor.mean_shift(monitor.profile_numeric(old, NUMERIC), shifted(new), NUMERIC))


@query(
    "mon_categorical_drift",
    f"SELECT feature, {rd('js_divergence')} AS js_divergence, drift_detected FROM ({CATEGORICAL_SQL})",
)
def _(r: Retail) -> DataFrame:
    old, new = halves(r)
    base = monitor.profile_categorical(old, CATEGORICAL)
    return rounded(monitor.categorical_drift(base, shifted(new), CATEGORICAL))


_SHARES_SQL = "(SELECT event_type, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS {} FROM {} GROUP BY 1)"


@query(
    "mon_new_categories",
    f"""SELECT 'event_type' AS feature, {rd('least(1, sum(abs(coalesce(p, 0) - coalesce(q, 0))) / 2)')} AS js_divergence,
  least(1, sum(abs(coalesce(p, 0) - coalesce(q, 0))) / 2) > 0.1 AS drift_detected
FROM {_SHARES_SQL.format('p', 't_old')} FULL JOIN {_SHARES_SQL.format('q', SHIFTED_SQL)} USING (event_type)""",
)
def _(r: Retail) -> DataFrame:
    """Category drift that also counts the categories seen for the first time."""
    old, new = halves(r)
    base = monitor.profile_categorical(old, CATEGORICAL)
    return rounded(monitor.categorical_drift(base, shifted(new), CATEGORICAL, new_categories=True))


def _drift(r: Retail) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    old, new = halves(r)
    base, moved = _baseline(r, old), shifted(new)
    num = settle(monitor.numeric_drift(base.numeric, base.values, moved, NUMERIC), "drift")
    cat = settle(monitor.categorical_drift(base.categorical, moved, CATEGORICAL), "drift")
    return num, cat, monitor.drift_score(num, cat, 3), moved


@query(
    "mon_drift_score",
    f"SELECT {rds('overall_drift_score')}, overall_drift_score > 0.3 AS drift_detected FROM ({SCORE_SQL})",
)
def _(r: Retail) -> DataFrame:
    return rounded(_drift(r)[2])


VERSIONS_SQL = (
    f"SELECT * FROM (SELECT model_version, {METRIC_COLUMNS} FROM t_pairs GROUP BY 1) "
    "UNPIVOT (metric_value FOR metric_name IN (rmse, mae, mape))"
)


@query(
    "mon_performance_drift",
    f"""SELECT metric_name, {rds('baseline current abs_diff rel_diff')}, rel_diff > 0.1 AND current > baseline AS degraded
FROM (SELECT o.metric_name, o.metric_value AS baseline, n.metric_value AS current,
        abs(n.metric_value - o.metric_value) AS abs_diff,
        CASE WHEN o.metric_value <> 0 THEN abs(n.metric_value - o.metric_value) / abs(o.metric_value)
             ELSE abs(n.metric_value - o.metric_value) END AS rel_diff
      FROM ({VERSIONS_SQL}) o JOIN ({VERSIONS_SQL}) n ON n.metric_name = o.metric_name
      WHERE o.model_version = '1996' AND n.model_version = '2000')""",
)
def _(r: Retail) -> DataFrame:
    """Two model versions against each other."""
    wide = evaluate.model_metrics(r.pairs(), ["model_version"])
    long = wide.unpivot(["model_version"], ["rmse", "mae", "mape"], "metric_name", "metric_value")
    old, now = long.where("model_version = '1996'"), long.where("model_version = '2000'")
    return rounded(monitor.performance_drift(old, now))


def moment() -> Column:
    return F.lit("2024-02-01 00:00:00").cast("timestamp")



@query(
    "mon_alert",
    f"""SELECT 'data_drift' AS type, 'Data Drift detected for model events' AS message,
  (SELECT count(*) FROM t_new) AS n_rows, {rds('overall_drift_score')}, 3 AS features
FROM ({SCORE_SQL}) WHERE overall_drift_score > 0.3""",
)
def _(r: Retail) -> DataFrame:
    num, cat, score, moved = _drift(r)
    n_rows = moved.agg(F.count(F.lit(1)).alias("n_rows"))
    alert = monitor.data_alert(score, num, cat, n_rows, "events", moment())
    data = F.col("data")
    return rounded(
        alert.select(
            "type", "message", data["n_rows"].alias("n_rows"),
            data["overall_drift_score"].alias("overall_drift_score"), F.size(data["features"]).alias("features"),
        )
    )


RETRAIN_SQL = f"""SELECT score > 0.5 AS needs_retraining, CASE WHEN score > 0.5
  THEN printf('Severe data drift detected: %.2f', score) ELSE 'No significant issues detected' END AS reason
FROM (SELECT arg_max(score, day) AS score FROM ({ALERTS_SQL}))"""


@query(
    "mon_retrain_decision",
    RETRAIN_SQL,
)
def _(r: Retail) -> DataFrame:
    """The decision on the day of the newest alert."""
    alerts = alert_documents(r)
    newest = alerts.agg(F.max(F.to_timestamp("timestamp"))).scalar()
    return monitor.retrain_decision(alerts, newest)


@query(
    "mon_trend_status",
    f"""SELECT {rds('latest average lowest')}, CASE WHEN latest < 0.3 THEN 'CRITICAL'
  WHEN latest < 0.95 * average THEN 'DRIFT' ELSE 'STABLE' END AS status
FROM (SELECT arg_max(a, d) AS latest, avg(a) AS average, min(a) AS lowest
      FROM (SELECT target_date AS d, greatest(0, 100 - avg(abs(predicted - actual) / actual * 100)) / 100 AS a
            FROM t_pairs WHERE actual > 0 GROUP BY 1))""",
)
def _(r: Retail) -> DataFrame:
    return rounded(monitor.trend_status(evaluate.daily_accuracy(r.pairs()), threshold=0.3))


@query(
    "mon_health_check",
    f"""SELECT {rds('overall_drift_score')}, score_alerts AS alerts, overall_drift_score > 0.5 OR level > 0.1 AS needs_retraining
FROM (SELECT overall_drift_score, CAST((overall_drift_score > 0.3) AS INTEGER) + CAST(level > 0.1 AS INTEGER) AS score_alerts, level
      FROM ({SCORE_SQL}), (SELECT (SELECT avg(value) FROM {SHIFTED_SQL}) / (SELECT avg(value) FROM t_old) - 1 AS level))""",
)
def _(r: Retail) -> DataFrame:
    """One run over both halves of the events; the mean value serves as the error metric."""
    old, new = halves(r)
    moved = shifted(new)
    now = moved.agg(F.avg("value").alias("metric_value")).select(F.lit("level").alias("metric_name"), "metric_value")
    health = monitor.check_health(_baseline(r, old), moved, now, NUMERIC, CATEGORICAL, "events", moment())
    alerts = health["alerts"].agg(F.count(F.lit(1)).cast("int").alias("n"))
    decision = health["decision"].select("needs_retraining")
    return rounded(
        health["score"].select(
            "overall_drift_score", alerts.scalar().alias("alerts"), decision.scalar().alias("needs_retraining")
        )
    )


@query(
    "mon_perturb",
    f"SELECT event_id, event_type, {rd('value * 1.05')} AS value FROM events",
)
def _(r: Retail) -> DataFrame:
    rows = r.raw("events").select("event_id", "event_type", "value")
    return rounded(scale_columns(rows, 1.05, ["value"]))


def _density_sql(c: str) -> str:
    both = f"(SELECT 'baseline' AS side, {c} AS v FROM t_old UNION ALL SELECT 'current', {c} FROM t_new)"
    return f"""SELECT '{c}' AS feature, side, bin, {rd('count(*) / CAST(max(total) AS DOUBLE) / ((max(hi) - max(lo)) / 20)')} AS density
FROM (SELECT side, CAST(least(floor((v - lo) * 20 / (hi - lo)), 19) AS INTEGER) AS bin, lo, hi, total
      FROM (SELECT *, CAST(min(v) OVER () AS DOUBLE) AS lo, CAST(max(v) OVER () AS DOUBLE) AS hi,
                   count(*) OVER (PARTITION BY side) AS total FROM {both})) GROUP BY side, bin"""


@query("mon_density_compare", " UNION ALL ".join(_density_sql(c) for c in NUMERIC))
def _(r: Retail) -> DataFrame:
    old, new = halves(r)
    return rounded(monitor.density_compare(old, new, NUMERIC, 20))


_DIGEST_PARTS = " || '-' || ".join(
    f"CAST(sum(CAST(CAST('0x' || substring(d, {13 * i + 1}, 13) AS BIGINT) AS DECIMAL(38, 0))) AS VARCHAR)" for i in range(5)
)


#: A value with its length in front, null as \\N, as ``monitor.content_digest`` writes it.
_SIZED = "coalesce(length(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '\\N')"


@query(
    "mon_content_digest",
    f"""SELECT day, count(*) AS n_rows, {_DIGEST_PARTS} AS digest
FROM (SELECT CAST(ts AS DATE) AS day, sha256(concat_ws('|', {", ".join(_SIZED.format(x) for x in ("event_id", "user_id", "event_type", "CAST(round(value * 100) AS BIGINT)", "props"))})) AS d
FROM events) GROUP BY 1""",
)
def _(r: Retail) -> DataFrame:
    cents = F.round(F.col("value") * 100).cast("bigint")
    columns = [F.col("event_id"), F.col("user_id"), F.col("event_type"), cents, F.col("props")]
    return monitor.content_digest(r.raw("events"), F.col("ts").cast("date"), columns)


