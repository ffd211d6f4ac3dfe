"""Summaries, accuracy figures, profiles and fitted parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.numeric import correlation
from shelfcast.operators import distribution, evaluate, monitor, report
from shelfcast.operators import features as B
from shelfcast.operators.model import select_features
from shelfcast.plans.catalog.base import METRIC_COLUMNS, query, rd, rds, rounded
from shelfcast.plans.catalog.joins import OIL_DAILY_SQL
from shelfcast.sources.retail import MODEL, Retail

# --- exploration ----------------------------------------------------------------------------------


@query("agg_daily_total", "SELECT date, sum(sales) AS sales FROM t_sales GROUP BY 1")
def _(r: Retail) -> DataFrame:
    return report.daily_total(r.sales())


@query(
    "agg_weekday_mean",
    f"SELECT CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, dayname(date) AS day_name, "
    f"{rd('avg(sales)')} AS mean_sales FROM t_sales GROUP BY 1, 2",
)
def _(r: Retail) -> DataFrame:
    return rounded(report.weekday_mean(r.sales()))


@query("agg_promo_mean", f"SELECT onpromotion, {rd('avg(sales)')} AS mean_sales FROM t_sales GROUP BY 1")
def _(r: Retail) -> DataFrame:
    return rounded(report.promo_mean(r.sales()))


@query(
    "agg_family_mean_top",
    f"SELECT family, {rd('m')} AS mean_sales FROM (SELECT family, avg(sales) AS m FROM t_sales GROUP BY 1) "
    "ORDER BY m DESC, family LIMIT 15",
)
def _(r: Retail) -> DataFrame:
    return rounded(report.family_mean_top(r.sales(), 15))


STORE_MEANS_SQL = "SELECT store_nbr, avg(sales) AS m FROM t_sales GROUP BY 1"


@query(
    "agg_store_city_mean",
    f"SELECT city, {rd('m')} AS mean_sales FROM (SELECT city, avg(m) AS m FROM ({STORE_MEANS_SQL}) "
    "JOIN t_stores USING (store_nbr) GROUP BY 1) ORDER BY m DESC, city LIMIT 10",
)
def _(r: Retail) -> DataFrame:
    return rounded(report.city_mean_top(r.sales(), r.stores(), 10))


@query(
    "agg_box_stats",
    "SELECT type, "
    + ", ".join(
        f"{rd(f'quantile_cont(m, {p})')} AS {n}"
        for n, p in (("lowest", 0.0), ("q1", 0.25), ("median", 0.5), ("q3", 0.75), ("highest", 1.0))
    )
    + f" FROM ({STORE_MEANS_SQL}) JOIN t_stores USING (store_nbr) GROUP BY 1",
)
def _(r: Retail) -> DataFrame:
    return rounded(report.box_stats(r.panel(), r.stores()))


@query(
    "agg_holiday_impact",
    f"""SELECT CAST(date IN (SELECT date FROM t_active WHERE locale = 'National') AS INTEGER) AS is_holiday,
       {rd('avg(sales)')} AS mean_daily_sales, count(*) AS days
FROM (SELECT date, sum(sales) AS sales FROM t_sales GROUP BY 1) GROUP BY 1""",
)
def _(r: Retail) -> DataFrame:
    return rounded(report.holiday_impact(r.sales(), r.holidays()))


DAILY_OIL_SQL = (
    f"SELECT d.date, d.sales, o.dcoilwtico FROM (SELECT date, sum(sales) AS sales FROM t_sales GROUP BY 1) d "
    f"LEFT JOIN ({OIL_DAILY_SQL}) o USING (date)"
)


@query("agg_oil_relation", f"SELECT date, sales, {rds('dcoilwtico')} FROM ({DAILY_OIL_SQL})")
def _(r: Retail) -> DataFrame:
    return rounded(report.oil_relation(r.sales(), r.oil()), "dcoilwtico")


@query("agg_oil_correlation", f"SELECT {rd('corr(sales, dcoilwtico)')} AS correlation FROM ({DAILY_OIL_SQL})")
def _(r: Retail) -> DataFrame:
    relation = report.oil_relation(r.sales(), r.oil())
    return rounded(relation.agg(correlation(F.col("sales"), F.col("dcoilwtico")).alias("correlation")))


LINE_COLUMNS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _describe_sql(table: str, columns, names: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, "
        + ", ".join(
            (f"{e.format(c)} AS {n}" if n == "count" else f"{rd(e.format(c))} AS {n}") for n, e in names.items()
        )
        + f" FROM {table}"
        for c in columns
    )


STATS_SQL = {
    "count": "count({0})",
    "mean": "avg({0})",
    "std": "stddev_samp({0})",
    "min": "min({0})",
    "max": "max({0})",
    "p25": "quantile_cont({0}, 0.25)",
    "median": "quantile_cont({0}, 0.5)",
    "p75": "quantile_cont({0}, 0.75)",
}


@query("agg_describe", _describe_sql("lineitem", LINE_COLUMNS, STATS_SQL))
def _(r: Retail) -> DataFrame:
    return rounded(distribution.describe(r.raw("lineitem"), LINE_COLUMNS))


def _histogram_sql(expr: str, lo: str, hi: str, bins: int) -> str:
    return (
        f"SELECT CAST(least(floor((v - lo) * {bins} / (hi - lo)), {bins - 1}) AS INTEGER) AS bin, "
        f"count(*) AS count FROM (SELECT {expr} AS v, {lo} AS lo, {hi} AS hi FROM t_sales) GROUP BY 1"
    )


@query(
    "agg_histogram",
    "SELECT 'raw' AS scale, * FROM ("
    + _histogram_sql("sales", "min(sales) OVER ()", "max(sales) OVER ()", 50)
    + ") UNION ALL SELECT 'log', * FROM ("
    + _histogram_sql("ln(1 + sales)", "CAST(0 AS DOUBLE)", "CAST(8 AS DOUBLE)", 50)
    + ")",
)
def _(r: Retail) -> DataFrame:
    sales = r.panel()
    raw = distribution.histogram(sales, "sales", 50)
    logged = sales.select(F.log1p("sales").alias("log_sales"))
    log = distribution.histogram(logged, "log_sales", 50, 0.0, 8.0)
    return raw.withColumn("scale", F.lit("raw")).unionByName(log.withColumn("scale", F.lit("log")))


# --- encodings and parameters ---------------------------------------------------------------------


@query(
    "agg_target_encoding",
    f"""SELECT s.*, {rd('fm')} AS family_sales_mean, fc AS family_count, {rd('sm')} AS store_nbr_sales_mean,
       sc AS store_nbr_count
FROM t_sales s JOIN (SELECT family, avg(sales) AS fm, count(*) AS fc FROM t_sales GROUP BY 1) USING (family)
JOIN (SELECT store_nbr, avg(sales) AS sm, count(*) AS sc FROM t_sales GROUP BY 1) USING (store_nbr)""",
)
def _(r: Retail) -> DataFrame:
    coded = B.target_encode(r.panel(), ["family", "store_nbr"], with_count=True)
    return rounded(coded, "family_sales_mean", "store_nbr_sales_mean")


@query(
    "agg_target_encoding_train",
    f"""WITH tr AS (SELECT * FROM t_sales WHERE year(date) < 1998 AND store_nbr <> 3)
SELECT s.store_nbr, family, date, {rd('coalesce(m, (SELECT avg(sales) FROM tr))')} AS store_nbr_sales_mean
FROM t_sales s LEFT JOIN (SELECT store_nbr, avg(sales) AS m FROM tr GROUP BY 1) USING (store_nbr)""",
)
def _(r: Retail) -> DataFrame:
    """Encoding fitted on early rows that lack one store."""
    sales = r.panel()
    train = sales.where((F.year("date") < 1998) & (F.col("store_nbr") != 3))
    coded = B.target_encode(sales, ["store_nbr"], train=train)
    return rounded(coded.drop("sales", "onpromotion"))


@query(
    "agg_standardise_fit_apply",
    f"""WITH p AS (SELECT avg(sales) AS m, stddev_pop(sales) AS s, avg(store_nbr) AS m2, stddev_pop(store_nbr) AS s2
                   FROM t_sales WHERE year(date) < 1999)
SELECT family, date, {rd('(sales - m) / s')} AS sales, {rd('(store_nbr - m2) / s2')} AS store_nbr FROM t_sales, p""",
)
def _(r: Retail) -> DataFrame:
    sales = r.sales().drop("onpromotion")
    scaler = B.fit_scaler(sales.where(F.year("date") < 1999), ["sales", "store_nbr"])
    return rounded(B.apply_scaler(sales, scaler, ["sales", "store_nbr"]))


FEATURES = ("onpromotion", "store_nbr", "day_of_week", "month")
FEATURE_SQL = {
    "onpromotion": "onpromotion",
    "store_nbr": "store_nbr",
    "day_of_week": "isodow(date) - 1",
    "month": "month(date)",
}


def _with_parts(r: Retail) -> DataFrame:
    return r.sales().withColumns({"day_of_week": F.weekday("date"), "month": F.month("date")})


@query(
    "agg_correlation",
    " UNION ALL ".join(
        f"SELECT '{n}' AS feature, {rd(f'abs(corr(sales, {e}))')} AS abs_corr FROM t_sales"
        for n, e in FEATURE_SQL.items()
    ),
)
def _(r: Retail) -> DataFrame:
    return rounded(evaluate.correlation(_with_parts(r), FEATURES))


@query(
    "agg_variance_filter",
    " UNION ALL ".join(
        f"SELECT '{n}' AS feature, {rd(f'var_pop({e})')} AS score FROM t_sales HAVING var_pop({e}) > 1"
        for n, e in FEATURE_SQL.items()
    ),
)
def _(r: Retail) -> DataFrame:
    table = _with_parts(r).select("sales", *FEATURES)
    return rounded(select_features(table, "variance", threshold=1.0))


# --- performance ----------------------------------------------------------------------------------


@query(
    "agg_family_performance",
    f"SELECT name AS family, sum(sales) AS total_sales, {rd('avg(sales)')} AS avg_sales, count(*) AS transactions "
    "FROM t_facts JOIN t_families f ON f.id = family_id "
    "WHERE date >= (SELECT max(date) FROM t_sales) - 365 GROUP BY 1",
)
def _(r: Retail) -> DataFrame:
    recent = report.lookback(r.historical_sales(), "date", 365, r.newest_day())
    named = evaluate.label(recent, r.stores(), r.families())
    return rounded(report.performance(named, "family"), "avg_sales")


@query(
    "agg_store_comparison",
    f"SELECT store_nbr, sum(sales) AS total_sales, {rd('avg(sales)')} AS avg_sales, count(*) AS transactions "
    "FROM t_facts JOIN t_stores s ON s.id = store_id "
    "WHERE date >= (SELECT max(date) FROM t_sales) - 365 GROUP BY 1",
)
def _(r: Retail) -> DataFrame:
    recent = report.lookback(r.historical_sales(), "date", 365, r.newest_day())
    named = evaluate.label(recent, r.stores(), r.families())
    return rounded(report.performance(named, "store_nbr"), "avg_sales")


ACCURACY_SQL = "greatest(0, 100 - avg(abs(predicted - actual) / actual * 100))"


@query(
    "agg_store_top10",
    f"""SELECT store_nbr, sales, {rd('acc')} AS forecast_accuracy
FROM (SELECT store_id, sum(sales) AS sales FROM t_facts GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10)
LEFT JOIN (SELECT store_id, {ACCURACY_SQL} / 100 AS acc FROM t_pairs WHERE actual > 0 GROUP BY 1) USING (store_id)
JOIN t_stores s ON s.id = store_id""",
)
def store_top10(r: Retail) -> DataFrame:
    sales = r.panel()
    facts = r.historical_sales(sales)
    pairs = r.pairs()
    return rounded(report.store_top(facts, pairs, r.stores(), 10), "forecast_accuracy")


@query(
    "agg_growth",
    f"""SELECT family, recent_sales, earlier_sales,
  {rd('CASE WHEN earlier_sales > 0 THEN (recent_sales - earlier_sales) / earlier_sales ELSE 0.1 END')} AS growth
FROM (SELECT family, sum(CASE WHEN age <= 180 THEN sales ELSE 0 END) AS recent_sales,
             sum(CASE WHEN age > 180 THEN sales ELSE 0 END) AS earlier_sales
      FROM (SELECT *, (SELECT max(date) FROM t_sales) - date AS age FROM t_sales) WHERE age > 0 AND age <= 360
      GROUP BY 1)""",
)
def _(r: Retail) -> DataFrame:
    return rounded(report.growth(r.sales(), "family", 180, r.newest_day()), "growth")


@query(
    "agg_kpi_summary",
    f"""SELECT count(DISTINCT store_id) AS total_stores, count(DISTINCT family_id) AS total_families,
  {rd('avg(sales)')} AS avg_sales,
  (SELECT {rd(ACCURACY_SQL)} FROM t_pairs WHERE actual > 0) AS forecast_accuracy FROM t_facts""",
)
def _(r: Retail) -> DataFrame:
    sales = r.panel()
    facts = r.historical_sales(sales)
    return rounded(report.kpi_summary(facts, r.pairs()))


@query(
    "agg_table_counts",
    """SELECT (SELECT count(*) FROM t_stores) AS stores_count, (SELECT count(*) FROM t_families) AS families_count,
  (SELECT count(*) FROM t_facts) AS sales_records, (SELECT count(*) FROM t_pred) AS predictions_count,
  true AS has_enough_data""",
)
def _(r: Retail) -> DataFrame:
    sales = r.panel()
    return report.table_counts(
        {
            "stores_count": r.stores(),
            "families_count": r.families(),
            "sales_records": r.historical_sales(sales),
            "predictions_count": r.predictions(sales),
        }
    )


# --- accuracy -------------------------------------------------------------------------------------


@query(
    "agg_accuracy_summary",
    f"""SELECT count(*) AS count, {rd('avg(predicted - actual)')} AS mean_error,
  {rd('avg(abs(predicted - actual))')} AS mae, {rd('sqrt(avg((predicted - actual) ** 2))')} AS rmse,
  {rd('avg(abs(predicted - actual) / actual * 100)')} AS mape, {rd(ACCURACY_SQL)} AS forecast_accuracy
FROM t_pairs WHERE actual > 0""",
)
def _(r: Retail) -> DataFrame:
    return rounded(evaluate.accuracy_summary(r.pairs()))


@query(
    "agg_accuracy_detail",
    f"""SELECT id, {rd('predicted - actual')} AS error, {rd('abs(predicted - actual)')} AS absolute_error,
  {rd('abs(predicted - actual) / actual * 100')} AS percentage_error FROM t_pairs WHERE actual > 0""",
)
def _(r: Retail) -> DataFrame:
    detail = evaluate.accuracy_detail(r.pairs())
    return rounded(detail.select("id", "error", "absolute_error", "percentage_error"))


@query(
    "agg_model_metrics",
    f"SELECT model_version, count, {rds('rmse mae mape r2')} FROM "
    f"(SELECT model_version, count(*) AS count, {METRIC_COLUMNS} FROM t_pairs "
    "GROUP BY 1)",
)
def _(r: Retail) -> DataFrame:
    return rounded(evaluate.model_metrics(r.pairs(), ["model_version"]))


EVAL_SQL = (
    "count(*) AS count, sqrt(avg((p - actual) ** 2)) AS rmse, avg(abs(p - actual)) AS mae, "
    "avg(CASE WHEN actual <> 0 THEN abs((actual - p) / actual) * 100 END) AS mape"
)
# every forecast lowered by 20, so that the hold at 0 matters
LOWERED_SQL = "SELECT *, greatest(predicted - 20, 0) AS p FROM t_pairs"


def _lowered(r: Retail) -> DataFrame:
    return r.pairs().withColumn("predicted", F.col("predicted") - 20)


@query("agg_eval_metrics", f"SELECT count, {rds('rmse mae mape')} FROM (SELECT {EVAL_SQL} FROM ({LOWERED_SQL}))")
def _(r: Retail) -> DataFrame:
    return rounded(evaluate.evaluation_metrics(_lowered(r)))


@query(
    "agg_eval_by_group",
    f"SELECT family_id, count, {rds('rmse mae mape')} FROM "
    f"(SELECT family_id, {EVAL_SQL} FROM ({LOWERED_SQL}) GROUP BY 1)",
)
def _(r: Retail) -> DataFrame:
    return rounded(evaluate.evaluation_by_group(_lowered(r), ["family_id"]))


@query("agg_wape", f"SELECT {rd('avg(abs(predicted - actual)) / avg(actual) * 100')} AS wape FROM t_pairs")
def _(r: Retail) -> DataFrame:
    return rounded(evaluate.weighted_error(r.pairs()))


@query(
    "agg_bias_drift",
    f"""SELECT store_id, family_id, n, {rds('signed_err rel_signed_err')},
  CAST(abs(rel_signed_err) >= 0.1 AS INTEGER) AS flag
FROM (SELECT store_id, CASE WHEN family_id <> 2 THEN family_id END AS family_id, count(*) AS n,
             avg(predicted - actual) AS signed_err,
             avg((predicted - actual) / (abs(actual) + 1e-8)) AS rel_signed_err FROM t_pairs GROUP BY 1, 2)""",
)
def _(r: Retail) -> DataFrame:
    """Signed error per store and family, one family unknown."""
    family = F.when(F.col("family_id") != 2, F.col("family_id"))
    return rounded(evaluate.bias_drift(r.pairs().withColumn("family_id", family), ["store_id", "family_id"]))


def _score_sql(p: str, who: str) -> str:
    return (
        f"sqrt(avg(({p} - sales) ** 2)) AS {who}_rmse, avg(abs({p} - sales)) AS {who}_mae, "
        f"avg(abs((sales - {p}) / greatest(abs(sales), 1e-8))) AS {who}_mape"
    )


BASE_COLUMNS = "model_rmse model_mae model_mape baseline_rmse baseline_mae baseline_mape"


@query(
    "agg_baseline_compare",
    f"""SELECT {rds(BASE_COLUMNS)}, model_rmse > 1.5 * baseline_rmse AS rmse_outlier,
  model_mae > 1.5 * baseline_mae AS mae_outlier
FROM (SELECT {_score_sql('p', 'model')}, {_score_sql('b', 'baseline')}
      FROM (SELECT sales, coalesce(predicted_sales, sales) AS p, avg(sales) OVER (PARTITION BY store_nbr, family
              ORDER BY date ROWS 6 PRECEDING) AS b FROM t_scored))""",
)
def _(r: Retail) -> DataFrame:
    """The one-step forecast against the trailing mean that already knows the day."""
    from pyspark.sql import Window

    past = Window.partitionBy("store_nbr", "family").orderBy("date").rowsBetween(-7, -1)
    forecast = F.coalesce(F.avg("sales").over(past), F.col("sales"))
    return rounded(evaluate.baseline_comparison(r.sales().withColumn("predicted", forecast)))


@query(
    "agg_store_accuracy",
    f"SELECT store_id, {rd(f'{ACCURACY_SQL} / 100')} AS forecast_accuracy FROM t_pairs WHERE actual > 0 GROUP BY 1",
)
def _(r: Retail) -> DataFrame:
    return rounded(evaluate.store_accuracy(r.pairs()))


@query(
    "agg_error_distribution",
    f"SELECT {rd('avg(predicted - actual)')} AS mean_error, {rd('stddev_pop(predicted - actual)')} AS std_error "
    "FROM t_pairs",
)
def _(r: Retail) -> DataFrame:
    return rounded(evaluate.error_distribution(r.pairs()))


# --- stored metrics -------------------------------------------------------------------------------

DAILY_DRIFT_SQL = """
SELECT timestamp AS date, max(CASE WHEN drift_metric = 'rmse' THEN drift_value END) AS rmse,
       max(CASE WHEN drift_metric = 'mae' THEN drift_value END) AS mae,
       CAST(max(CAST(exceeded_threshold AS INTEGER)) AS INTEGER) AS drift_detected
FROM t_drift WHERE timestamp >= (SELECT max(timestamp) FROM t_drift) - 60
GROUP BY 1 ORDER BY 1 DESC LIMIT 60"""


@query("agg_daily_drift", f"SELECT date, {rds('rmse mae')}, drift_detected FROM ({DAILY_DRIFT_SQL})")
def _(r: Retail) -> DataFrame:
    return rounded(report.daily_drift(r.model_drift(), MODEL, 60))


@query(
    "agg_drift_arrays",
    f"""SELECT string_agg(strftime(date, '%Y-%m-%d'), ',' ORDER BY date DESC) AS dates,
  string_agg(CAST(CAST(round(rmse * 1000) AS BIGINT) AS VARCHAR), ',' ORDER BY date DESC) AS rmse,
  string_agg(CAST(CAST(round(mae * 1000) AS BIGINT) AS VARCHAR), ',' ORDER BY date DESC) AS mae,
  string_agg(CAST(drift_detected * 100 AS VARCHAR), ',' ORDER BY date DESC) AS drift_score
FROM ({DAILY_DRIFT_SQL})""",
)
def _(r: Retail) -> DataFrame:
    """Arrays turned into text for the comparison."""
    packed = report.drift_arrays(report.daily_drift(r.model_drift(), MODEL, 60))

    def text(name: str, scale: int):
        whole = F.transform(name, lambda v: F.round(v * scale).cast("bigint").cast("string"))
        return F.array_join(whole, ",").alias(name)

    return packed.select(
        F.array_join("dates", ",").alias("dates"), text("rmse", 1000), text("mae", 1000), text("drift_score", 1)
    )


LATEST_SQL = """SELECT {0}, metric_name, arg_max(metric_value, timestamp) AS v FROM t_metrics GROUP BY ALL"""


@query(
    "agg_metric_pivot",
    "SELECT model_version, "
    + ", ".join(f"{rd(f'''max(CASE WHEN metric_name = '{m}' THEN v END)''')} AS {m}" for m in report.METRIC_NAMES)
    + f" FROM ({LATEST_SQL.format('model_version')}) GROUP BY 1",
)
def _(r: Retail) -> DataFrame:
    return rounded(report.metrics_by_version(r.model_metrics(), MODEL))


@query(
    "agg_latest_metrics",
    "SELECT metric_name, " + rd("v") + f" AS metric_value FROM ({LATEST_SQL.format('model_name')})",
)
def _(r: Retail) -> DataFrame:
    packed = report.latest_metrics_map(r.model_metrics(), MODEL)
    return rounded(packed.select(F.explode("metrics").alias("metric_name", "metric_value")))


# --- profiles -------------------------------------------------------------------------------------

PROFILE_SQL = {k: v for k, v in STATS_SQL.items() if k != "count"}


@query("agg_profile_numeric", _describe_sql("t_old", ("value", "user_id"), PROFILE_SQL))
def _(r: Retail) -> DataFrame:
    old = r.raw("events").where(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))
    return rounded(monitor.profile_numeric(old, ["value", "user_id"]))


@query(
    "agg_profile_categorical",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {c} AS category, {rd(f'count(*) / CAST(sum(count(*)) OVER () AS DOUBLE)')} AS prob "
        f"FROM documents WHERE {c} IS NOT NULL GROUP BY {c}"
        for c in ("lang", "source")
    ),
)
def _(r: Retail) -> DataFrame:
    return rounded(monitor.profile_categorical(r.raw("documents"), ["lang", "source"]))


@query(
    "agg_explorer_stats",
    f"SELECT sum(sales) AS total, {rd('avg(sales)')} AS average, max(sales) AS maximum, min(sales) AS minimum "
    "FROM t_sales WHERE store_nbr = 3",
)
def _(r: Retail) -> DataFrame:
    return rounded(report.explorer_stats(report.where_keys(r.sales(), store_nbr=3)), "average")


@query(
    "agg_last_per_store",
    "SELECT store_nbr, arg_max(transactions, date) AS transactions FROM t_trans GROUP BY 1",
)
def _(r: Retail) -> DataFrame:
    return B.last_known(r.transactions(), "store_nbr", "transactions")


_BASELINES = ", ".join(f"('{k}', {v})" for k, v in B.FAMILY_BASELINES.items())


@query(
    "agg_cold_start",
    f"""SELECT store_nbr, family, {rd('coalesce(nullif(m, 0), b * (0.5 + (store_nbr % 10) * 0.15), 15 + h / 100.0 * 40)')}
       AS predicted_sales
FROM (SELECT DISTINCT store_nbr, family, CAST(list_sum(list_transform(string_split(family, ''), lambda c: ascii(c))) % 100 AS DOUBLE) AS h
      FROM (SELECT CAST(p_partkey % 25 AS INTEGER) AS store_nbr, CASE p_partkey % 4 WHEN 0 THEN p_type
              WHEN 1 THEN p_brand WHEN 2 THEN 'PRODUCE' ELSE 'BOOKS' END AS family FROM part))
LEFT JOIN (SELECT store_nbr, family, avg(sales) AS m FROM t_sales GROUP BY 1, 2) USING (store_nbr, family)
LEFT JOIN (SELECT family, CAST(b AS DOUBLE) AS b FROM (VALUES {_BASELINES}) v(family, b)) USING (family)""",
)
def _(r: Retail) -> DataFrame:
    """Requests for families with history, with a baseline only, and with neither."""
    kind, none = F.col("p_partkey") % 4, F.lit(None).cast("string")
    family = F.coalesce(
        F.when(kind == 0, F.col("p_type")).when(kind == 1, F.col("p_brand")).otherwise(none),
        F.when(kind == 2, "PRODUCE").otherwise("BOOKS"),
    )
    store = (F.col("p_partkey") % 25).cast("int").alias("store_nbr")
    requests = r.raw("part").select(store, family.alias("family")).distinct()
    return rounded(B.cold_start(requests, r.sales()))


@query("agg_history_bounds", "SELECT min(date) AS first_day, max(date) AS last_day FROM t_sales")
def _(r: Retail) -> DataFrame:
    return r.sales().agg(F.min("date").alias("first_day"), F.max("date").alias("last_day"))
