"""Registered queries and the SQL each one must agree with."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.functions.numeric import round_to
from shelfcast.sources.retail import HOLIDAYS, MODEL, Retail

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under its operator name, with its SQL twin where one exists."""

    def keep(fn: Callable[[Retail], DataFrame]):
        def run(spark: SparkSession, root: str) -> DataFrame:
            return fn(Retail(spark, root))

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = expand(sql)
        return fn

    return keep


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round doubles before comparison (all of them unless named)."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: round_to(F.col(c), digits) for c in (columns or doubles)})


def rd(expr: str, digits: int = 6) -> str:
    """The SQL twin of ``rounded``; adding 0 turns -0.0 into 0.0."""
    return f"(round(CAST({expr} AS DOUBLE), {digits}) + CAST(0 AS DOUBLE))"


def rds(columns: Sequence[str] | str, digits: int = 6) -> str:
    names = columns.split() if isinstance(columns, str) else columns
    return ", ".join(f"{rd(c, digits)} AS {c}" for c in names)


_HOLIDAY_ROWS = ", ".join(
    f"(DATE '{d}', '{kind}', '{locale}', '{text}', {str(moved).lower()})"
    for d, kind, locale, text, moved in HOLIDAYS
)

METRIC_COLUMNS = """
    sqrt(avg((predicted - actual) * (predicted - actual))) AS rmse,
    avg(abs(predicted - actual)) AS mae,
    coalesce(avg(CASE WHEN actual > 0 THEN abs(predicted - actual) / actual * 100 END), 0) AS mape,
    1 - sum((actual - predicted) * (actual - predicted))
        / nullif(var_pop(actual) * count(actual), 0) AS r2"""

CTES: dict[str, str] = {
    "t_sales": """
SELECT s_nationkey AS store_nbr, p_type AS family, CAST(l_shipdate AS DATE) AS date,
       sum(l_quantity) AS sales, max(CASE WHEN l_discount >= 0.08 THEN 1 ELSE 0 END) AS onpromotion
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
GROUP BY 1, 2, 3""",
    "t_stores": """
SELECT n_nationkey + 1 AS id, n_nationkey AS store_nbr, n_name AS city, r_name AS state,
       chr(65 + n_nationkey % 5) AS type, n_nationkey % 17 AS cluster
FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "t_families": """
SELECT CAST(row_number() OVER (ORDER BY name) AS INTEGER) AS id, name
FROM (SELECT DISTINCT p_type AS name FROM part)""",
    "t_trans": """
SELECT CAST(o_orderdate AS DATE) AS date, c_nationkey AS store_nbr, count(*) AS transactions
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""",
    "t_oil": """
SELECT date, CASE WHEN day(date) % 10 <> 0 THEN round(total / n / 1000.0::DOUBLE, 4) END AS dcoilwtico
FROM (SELECT CAST(o_orderdate AS DATE) AS date,
             CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total, count(*) AS n
      FROM orders WHERE isodow(o_orderdate) <= 5 GROUP BY 1)""",
    "t_holidays": f"""
SELECT * FROM (VALUES {_HOLIDAY_ROWS}) AS h(date, type, locale, description, transferred)""",
    "t_active": "SELECT * FROM t_holidays WHERE NOT transferred",
    "t_cal": """
SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date
FROM t_sales""",
    "t_facts": """
SELECT s.id AS store_id, f.id AS family_id, date, sales, onpromotion
FROM t_sales JOIN t_stores s USING (store_nbr) JOIN t_families f ON f.name = family""",
    "t_scored": """
SELECT *, avg(sales) OVER w AS predicted_sales, stddev_samp(sales) OVER w AS spread FROM t_sales
WINDOW w AS (PARTITION BY store_nbr, family ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)""",
    "t_pred": """
SELECT store_nbr || '-' || family || '-' || strftime(date, '%Y-%m-%d') AS id,
       s.id AS store_id, f.id AS family_id, date - 1 AS prediction_date, date AS target_date,
       onpromotion, predicted_sales,
       predicted_sales - 1.96::DOUBLE * coalesce(spread, 0) AS prediction_interval_lower,
       predicted_sales + 1.96::DOUBLE * coalesce(spread, 0) AS prediction_interval_upper,
       CAST(year(date) AS VARCHAR) AS model_version, date - 1 AS created_at
FROM t_scored JOIN t_stores s USING (store_nbr) JOIN t_families f ON f.name = family
WHERE predicted_sales IS NOT NULL""",
    "t_pairs": """
SELECT p.*, p.predicted_sales AS predicted, a.sales AS actual
FROM t_pred p JOIN t_facts a
  ON a.store_id = p.store_id AND a.family_id = p.family_id AND a.date = p.target_date""",
    "t_metrics": f"""
SELECT '{MODEL}' AS model_name, model_version, timestamp, metric_name, metric_value
FROM (SELECT model_version, CAST(date_trunc('month', target_date) AS DATE) AS timestamp,
             {METRIC_COLUMNS} FROM t_pairs GROUP BY 1, 2)
UNPIVOT INCLUDE NULLS (metric_value FOR metric_name IN (rmse, mae, mape, r2))""",
    "t_drift": f"""
SELECT '{MODEL}' AS model_name, d.model_version, d.drift_metric, d.drift_value,
       l.level * 1.1::DOUBLE AS threshold, d.drift_value > l.level * 1.1::DOUBLE AS exceeded_threshold,
       d.target_date AS timestamp
FROM (SELECT * FROM (SELECT model_version, target_date, {METRIC_COLUMNS} FROM t_pairs GROUP BY 1, 2)
      UNPIVOT (drift_value FOR drift_metric IN (rmse, mae))) d
JOIN (SELECT * FROM (SELECT model_version, {METRIC_COLUMNS} FROM t_pairs GROUP BY 1)
      UNPIVOT (level FOR drift_metric IN (rmse, mae))) l
  ON l.model_version = d.model_version AND l.drift_metric = d.drift_metric""",
    "t_imp": f"""
SELECT '{MODEL}' AS model_name, model_version, timestamp, feature_name, importance_value
FROM (SELECT CAST(year(date) AS VARCHAR) AS model_version,
             CAST(date_trunc('quarter', date) AS DATE) AS timestamp,
             abs(corr(sales, onpromotion)) AS onpromotion, abs(corr(sales, store_nbr)) AS store_nbr,
             abs(corr(sales, isodow(date) - 1)) AS day_of_week, abs(corr(sales, month(date))) AS month
      FROM t_sales GROUP BY 1, 2)
UNPIVOT (importance_value FOR feature_name IN (onpromotion, store_nbr, day_of_week, month))
WHERE NOT isnan(importance_value)""",
    "t_epanel": """
SELECT CAST(user_id % 10 AS INTEGER) AS store_nbr, event_type AS family, CAST(ts AS DATE) AS date,
       CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS sales
FROM events GROUP BY 1, 2, 3""",
    "t_old": "SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-16'",
    "t_new": "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-16'",
}


def _needed(text: str) -> list[str]:
    used = [name for name in CTES if re.search(rf"\b{name}\b", text)]
    out: list[str] = []
    for name in used:
        out += [n for n in (*_needed(CTES[name]), name) if n not in out]
    return out


def expand(sql: str) -> str:
    """Put the table definitions a statement uses in front of it."""
    body = sql.strip()
    parts = [f"{name} AS ({CTES[name].strip()})" for name in _needed(body)]
    if not parts:
        return body
    if body.upper().startswith("WITH "):
        return f"WITH {', '.join(parts)}, {body[5:]}"
    return f"WITH {', '.join(parts)} {body}"
