"""Joins with dimensions, calendars, actuals and encodings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.operators import evaluate
from shelfcast.operators import features as B
from shelfcast.operators import report
from shelfcast.operators.sizing import value_of
from shelfcast.plans.catalog.base import query, rd, rds, rounded
from shelfcast.sources.retail import Retail
from shelfcast.sources.sinks import latest_rows

GRAIN = "store_nbr, family, date"

OIL_FILLED_SQL = """
SELECT date, p AS dcoilwtico, avg(p) OVER (ORDER BY date ROWS 6 PRECEDING) AS a7,
       avg(p) OVER (ORDER BY date ROWS 29 PRECEDING) AS a30
FROM (SELECT date, last_value(dcoilwtico IGNORE NULLS) OVER (ORDER BY date) AS p FROM t_oil)"""

# as-of join first, then the earliest known value for days before it
OIL_DAILY_SQL = f"""
SELECT c.date, coalesce(o.dcoilwtico, b.dcoilwtico) AS dcoilwtico, coalesce(o.a7, b.a7) AS oil_price_7d_avg,
       coalesce(o.a30, b.a30) AS oil_price_30d_avg
FROM t_cal c ASOF LEFT JOIN (SELECT * FROM ({OIL_FILLED_SQL}) WHERE dcoilwtico IS NOT NULL) o ON c.date >= o.date
CROSS JOIN (SELECT * FROM ({OIL_FILLED_SQL}) WHERE dcoilwtico IS NOT NULL ORDER BY date LIMIT 1) b"""

FLAGS_SQL = """
SELECT date, max(CAST(locale = 'National' AS INTEGER)) AS is_national_holiday,
       max(CAST(locale = 'Regional' AS INTEGER)) AS is_regional_holiday,
       max(CAST(locale = 'Local' AS INTEGER)) AS is_local_holiday
FROM t_active GROUP BY 1"""

FLAG_NAMES = ("is_national_holiday", "is_regional_holiday", "is_local_holiday")


@query("jn_store_dim", "SELECT t.*, s.* EXCLUDE (id, store_nbr) FROM t_sales t LEFT JOIN t_stores s USING (store_nbr)")
def _(r: Retail) -> DataFrame:
    return B.join_stores(r.sales(), r.stores().drop("id"))


@query(
    "jn_oil",
    f"SELECT s.*, {rds('dcoilwtico oil_price_7d_avg oil_price_30d_avg', 9)} "
    f"FROM t_sales s LEFT JOIN ({OIL_DAILY_SQL}) USING (date)",
)
def _(r: Retail) -> DataFrame:
    joined = B.join_oil(r.panel(), r.oil())
    return rounded(joined, "dcoilwtico", "oil_price_7d_avg", "oil_price_30d_avg", digits=9)


@query(
    "jn_holiday_flags",
    "SELECT s.*, "
    + ", ".join(f"coalesce({c}, 0) AS {c}" for c in FLAG_NAMES)
    + f" FROM t_sales s LEFT JOIN ({FLAGS_SQL}) USING (date)",
)
def _(r: Retail) -> DataFrame:
    return B.join_holiday_flags(r.sales(), r.holidays())


@query(
    "jn_transactions",
    "SELECT s.*, coalesce(transactions, 0) AS transactions FROM t_sales s "
    "LEFT JOIN t_trans USING (date, store_nbr)",
)
def _(r: Retail) -> DataFrame:
    return B.join_transactions(r.sales(), r.transactions())


@query(
    "jn_last_known",
    "SELECT s.*, coalesce(t.transactions, l.transactions) AS transactions FROM t_sales s "
    "LEFT JOIN t_trans t USING (date, store_nbr) LEFT JOIN "
    "(SELECT store_nbr, arg_max(transactions, date) AS transactions FROM t_trans GROUP BY 1) l USING (store_nbr)",
)
def _(r: Retail) -> DataFrame:
    return B.join_with_last_known(r.sales(), r.transactions())


@query(
    "jn_encoding",
    f"""SELECT s.*, {rd('coalesce(m, (SELECT avg(sales) FROM t_sales WHERE year(date) < 1998))')} AS family_sales_mean,
       coalesce(n, 0) AS family_count
FROM t_sales s LEFT JOIN (SELECT family, avg(sales) AS m, count(sales) AS n FROM t_sales
       WHERE year(date) < 1998 AND family <> 'PROMO' GROUP BY 1) USING (family)""",
)
def _(r: Retail) -> DataFrame:
    """A fitted encoding without one of the families, joined to all rows."""
    sales = r.panel()
    early = sales.where(F.year("date") < 1998)
    fitted = B.fit_target_encoding(early.where("family <> 'PROMO'"), "family")
    overall = value_of(early, F.avg("sales"))
    out = B.attach(sales, fitted, "family")
    out = out.withColumn("family_sales_mean", F.coalesce(F.col("family_sales_mean"), overall))
    return rounded(out.fillna(0, subset=["family_count"]), "family_sales_mean")


@query(
    "jn_star",
    f"""SELECT p.id, store_nbr, city, state, type, name AS family, target_date, {rds('predicted_sales')}
FROM t_pred p JOIN t_stores s ON s.id = store_id JOIN t_families f ON f.id = family_id
WHERE target_date >= (SELECT max(date) FROM t_sales) - 180""",
)
def _(r: Retail) -> DataFrame:
    recent = report.lookback(r.predictions(), "target_date", 180, r.newest_day())
    named = evaluate.label(recent, r.stores(), r.families())
    wanted = ("id", "store_nbr", "city", "state", "type", "family", "target_date", "predicted_sales")
    return rounded(named.select(*wanted))


@query(
    "jn_star_sales",
    """SELECT store_nbr, city, name AS family, date, sales, onpromotion
FROM t_facts JOIN t_stores s ON s.id = store_id JOIN t_families f ON f.id = family_id
WHERE family_id = 2 AND date >= (SELECT max(date) FROM t_sales) - 365""",
)
def _(r: Retail) -> DataFrame:
    facts = report.where_keys(r.historical_sales(), store_id=None, family_id=2)
    named = evaluate.label(report.lookback(facts, "date", 365, r.newest_day()), r.stores(), r.families())
    return named.select("store_nbr", "city", "family", "date", "sales", "onpromotion")


@query("jn_pred_actual", f"SELECT id, store_id, family_id, target_date, {rds('predicted')}, actual FROM t_pairs")
def _(r: Retail) -> DataFrame:
    joined = evaluate.pair(r.predictions(), r.historical_sales())
    pairs = joined.select("id", "store_id", "family_id", "target_date", "predicted", "actual")
    return rounded(pairs, "predicted")


@query(
    "jn_lookup_actual",
    f"""SELECT p.id, {rds('predicted_sales')}, a.sales AS actual_sales
FROM (SELECT * FROM t_pred ORDER BY created_at DESC, id LIMIT 500) p
LEFT JOIN (SELECT * FROM t_facts WHERE onpromotion = 0) a
  ON a.store_id = p.store_id AND a.family_id = p.family_id AND a.date = p.target_date""",
)
def _(r: Retail) -> DataFrame:
    """The newest forecasts against a sales table that lacks some of their days."""
    sales = r.panel()
    known = r.historical_sales(sales).where("onpromotion = 0")
    newest = report.recent_predictions(r.predictions(sales), known, 500)
    return rounded(newest.select("id", "predicted_sales", "actual_sales"), "predicted_sales")


@query(
    "jn_latest_self",
    f"""SELECT model_version, metric_name, timestamp, {rds('metric_value')} FROM t_metrics
JOIN (SELECT metric_name, model_version, max(timestamp) AS timestamp FROM t_metrics GROUP BY ALL)
USING (metric_name, model_version, timestamp)""",
)
def _(r: Retail) -> DataFrame:
    newest = latest_rows(r.model_metrics(), ["model_version", "metric_name"], "timestamp")
    return rounded(newest.select("model_version", "metric_name", "timestamp", "metric_value"))


@query("jn_semi_dates", "SELECT * FROM t_sales WHERE date IN (SELECT date FROM t_trans WHERE store_nbr = 3)")
def _(r: Retail) -> DataFrame:
    dates = r.transactions().where("store_nbr = 3").select("date").distinct()
    return r.sales().join(F.broadcast(dates), "date", "left_semi")  # one row per day


@query(
    "jn_exists_flag",
    "SELECT *, CAST(date IN (SELECT date FROM t_active WHERE locale = 'National') AS INTEGER) AS is_holiday "
    "FROM t_sales",
)
def _(r: Retail) -> DataFrame:
    return B.flag_dates(r.sales(), B.active_holidays(r.holidays(), "National"))


@query(
    "jn_anti_new",
    "SELECT * FROM t_facts f WHERE NOT EXISTS (SELECT 1 FROM t_pred p WHERE p.store_id = f.store_id "
    "AND p.family_id = f.family_id AND p.target_date = f.date)",
)
def _(r: Retail) -> DataFrame:
    """Sales that have no forecast yet."""
    sales = r.panel()
    done = r.predictions(sales).select("store_id", "family_id", F.col("target_date").alias("date"))
    return r.historical_sales(sales).join(done, ["store_id", "family_id", "date"], "left_anti")


@query("jn_asof_fill", f"SELECT date, {rds('dcoilwtico')} FROM ({OIL_DAILY_SQL})")
def _(r: Retail) -> DataFrame:
    days = B.calendar(r.sales())
    daily = B.as_of_daily(r.oil(), days)
    return rounded(daily.join(days, "date", "left_semi"))


@query(
    "jn_calendar",
    "SELECT c.date, coalesce(sum(sales), 0) AS sales FROM t_cal c LEFT JOIN t_sales USING (date) GROUP BY 1",
)
def _(r: Retail) -> DataFrame:
    sales = r.panel()
    daily = report.daily_total(sales)
    return B.calendar(sales).join(daily, "date", "left").fillna(0.0, subset=["sales"])


@query(
    "jn_panel_densify",
    """SELECT store_nbr, family, c.date, coalesce(s.sales, 0) AS sales, coalesce(s.onpromotion, 0) AS onpromotion
FROM (SELECT DISTINCT store_nbr, family FROM t_sales) CROSS JOIN t_cal c
LEFT JOIN t_sales s USING (store_nbr, family, date)""",
)
def _(r: Retail) -> DataFrame:
    return B.densify(r.panel())


@query("jn_common_columns", "SELECT store_nbr, date FROM t_trans UNION ALL SELECT store_nbr, date FROM t_sales")
def _(r: Retail) -> DataFrame:
    left, right = B.common_columns(r.transactions(), r.sales())
    return left.unionByName(right)
