"""Whole compositions: feature tables, exploration, reports, training."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.operators import windows as V
from shelfcast.plans import flows
from shelfcast.plans.catalog.base import query, rd, rds, rounded
from shelfcast.plans.catalog.joins import FLAG_NAMES, FLAGS_SQL, OIL_DAILY_SQL
from shelfcast.plans.catalog.monitoring import RETRAIN_SQL
from shelfcast.plans.catalog.scalars import PARTS_SQL
from shelfcast.plans.catalog.windows import FN, SERIES_SQL
from shelfcast.sources.retail import Retail

CUT = dt.date(2001, 1, 1)
FIRST = dt.date(1995, 1, 30)


def retail_tables(r: Retail, cut: dt.date | None = None) -> dict[str, DataFrame]:
    """Raw tables; with ``cut`` the sales from that day on are test rows."""
    sales = r.panel()
    tables = {
        "train": sales,
        "stores": r.stores().drop("id"),
        "oil": r.oil(),
        "holidays_events": r.holidays(),
        "transactions": r.transactions(),
    }
    if cut is not None:
        tables["train"] = sales.where(F.col("date") < F.lit(cut))
        tables["test"] = sales.where(F.col("date") >= F.lit(cut)).drop("sales")
        known = tables["transactions"]
        tables["transactions"] = known.where(F.col("date") < F.lit(cut))
    return tables


def _windows_sql(panel: str) -> str:
    lag = ", ".join(f"coalesce(lag(sales, {k}) OVER w, 0) AS sales_lag_{k}" for k in V.LAGS)
    roll = ", ".join(
        f"coalesce({FN[s]}(sales) OVER (w ROWS {n - 1} PRECEDING), 0) AS sales_roll_{n}_{s}"
        for n in V.WINDOWS
        for s in V.STATS
    )
    return f"SELECT *, {lag}, {roll} FROM {panel} WINDOW w AS ({SERIES_SQL})"


ROLLS = [f"sales_roll_{n}_{s}" for n in V.WINDOWS for s in V.STATS]
LAG_NAMES = [f"sales_lag_{k}" for k in V.LAGS]
TRANS_LAGS = [f"transactions_lag_{k}" for k in V.LAGS]
_TRANS_SQL = (
    "SELECT *, "
    + ", ".join(f"lag(transactions, {k}) OVER (PARTITION BY store_nbr ORDER BY date) AS transactions_lag_{k}" for k in V.LAGS)
    + " FROM {0}"
)
OIL_NAMES = ("dcoilwtico", "oil_price_7d_avg", "oil_price_30d_avg")


# The stores of the test tables: one per nation, in five regions and five types; the first value of
# each, in sorted order, has no indicator.
INDICATORS_SQL = ", ".join(
    f"CAST({column} = '{value}' AS INTEGER) AS \"{column}_{value}\""
    for column, values in {
        "city": [f"NATION_{i}" for i in range(1, 25)],
        "state": ["AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"],
        "type": list("BCDE"),
    }.items()
    for value in values
)


def _features_sql(panel: str, train: str, trans: str, missing_trans: str, where: str, oil: str) -> str:
    return f"""SELECT p.store_nbr, p.family, p.date, p.sales, p.onpromotion, cluster, {PARTS_SQL.replace('date', 'p.date')},
  {INDICATORS_SQL}, {rds(OIL_NAMES, 9)}, {', '.join(f'coalesce({c}, 0) AS {c}' for c in FLAG_NAMES)},
  {missing_trans} AS transactions, {', '.join(f'coalesce({c}, 0) AS {c}' for c in TRANS_LAGS)},
  {', '.join(LAG_NAMES)}, {rds(ROLLS)},
  {rd('coalesce(fm, (SELECT avg(sales) FROM ' + train + '))')} AS family_sales_mean,
  {rd('coalesce(sm, (SELECT avg(sales) FROM ' + train + '))')} AS store_nbr_sales_mean
FROM ({_windows_sql(panel)}) p LEFT JOIN t_stores USING (store_nbr) LEFT JOIN ({oil}) USING (date)
LEFT JOIN ({FLAGS_SQL}) USING (date) LEFT JOIN ({_TRANS_SQL.format(trans)}) USING (store_nbr, date)
LEFT JOIN (SELECT store_nbr, arg_max(transactions, date) AS last_known FROM {trans} GROUP BY 1) USING (store_nbr)
LEFT JOIN (SELECT family, avg(sales) AS fm FROM {train} GROUP BY 1) USING (family)
LEFT JOIN (SELECT store_nbr, avg(sales) AS sm FROM {train} GROUP BY 1) USING (store_nbr)
WHERE {where}"""


def _comparable(df: DataFrame) -> DataFrame:
    """The wide table with its computed figures rounded."""
    return rounded(rounded(df, *OIL_NAMES, digits=9), *ROLLS, "family_sales_mean", "store_nbr_sales_mean")


@query(
    "pipe_train_features",
    _features_sql(
        "t_sales", "t_sales", "t_trans", "coalesce(transactions, 0)", f"p.date >= DATE '{FIRST}'", OIL_DAILY_SQL
    ),
)
def train_features(r: Retail) -> DataFrame:
    return _comparable(flows.train_features(retail_tables(r), FIRST))


@query(
    "pipe_test_features",
    f"""WITH tr AS (SELECT * FROM t_sales WHERE date < DATE '{CUT}'),
  tt AS (SELECT * FROM t_trans WHERE date < DATE '{CUT}'),
  panel AS (SELECT store_nbr, family, date, CASE WHEN date < DATE '{CUT}' THEN sales END AS sales, onpromotion FROM t_sales) """
    + _features_sql("panel", "tr", "tt", "coalesce(transactions, last_known)", f"p.date >= DATE '{CUT}'", OIL_DAILY_SQL),
)
def _(r: Retail) -> DataFrame:
    return _comparable(flows.test_features(retail_tables(r, CUT)))


def _listed(df: DataFrame, part: str, item, **figures) -> DataFrame:
    """A summary as rows of ``part, item, figure, amount``: one row per figure."""
    rows = [F.struct(F.lit(name).alias("figure"), column.cast("double").alias("amount")) for name, column in figures.items()]
    return df.select(F.lit(part).alias("part"), item.cast("string").alias("item"), F.inline(F.array(*rows)))


STORE_MEANS_SQL = "SELECT store_nbr, avg(sales) AS m FROM t_sales GROUP BY 1"


@query(
    "pipe_eda",
    f"""SELECT 'promo' AS part, CAST(onpromotion AS VARCHAR) AS item, 'mean' AS figure, {rd('avg(sales)')} AS amount
FROM t_sales GROUP BY onpromotion
UNION ALL SELECT 'weekday', dayname(date), 'mean', {rd('avg(sales)')} FROM t_sales GROUP BY 2
UNION ALL SELECT * FROM (SELECT 'family', family, 'mean', {rd('m')} FROM (SELECT family, avg(sales) AS m FROM t_sales
  GROUP BY 1) ORDER BY m DESC, family LIMIT 15)
UNION ALL SELECT 'day', CAST(date AS VARCHAR), 'total', {rd('sum(sales)')} FROM t_sales GROUP BY date
UNION ALL SELECT * FROM (SELECT 'city', city, 'mean', {rd('m')} FROM (SELECT city, avg(m) AS m FROM ({STORE_MEANS_SQL})
  JOIN t_stores USING (store_nbr) GROUP BY 1) ORDER BY m DESC, city LIMIT 10)
UNION ALL SELECT 'holiday', CAST(h AS VARCHAR), unnest(['mean', 'days']), unnest([m, n]) FROM (
  SELECT CAST(date IN (SELECT date FROM t_active WHERE locale = 'National') AS INTEGER) AS h, {rd('avg(sales)')} AS m,
  CAST(count(*) AS DOUBLE) AS n FROM (SELECT date, sum(sales) AS sales FROM t_sales GROUP BY 1) GROUP BY 1)
UNION ALL SELECT 'oil', CAST(date AS VARCHAR), unnest(['sales', 'price']), unnest([s, o]) FROM (
  SELECT date, {rd('d.sales')} AS s, {rd('o.dcoilwtico')} AS o
  FROM (SELECT date, sum(sales) AS sales FROM t_sales GROUP BY 1) d LEFT JOIN ({OIL_DAILY_SQL}) o USING (date))""",
)
def _(r: Retail) -> DataFrame:
    """All seven exploratory summaries as one list of figures."""
    made = flows.explore(r.panel(), r.stores(), r.holidays(), r.oil())
    parts = [
        _listed(made["promo_mean"], "promo", F.col("onpromotion"), mean=F.col("mean_sales")),
        _listed(made["weekday_mean"], "weekday", F.col("day_name"), mean=F.col("mean_sales")),
        _listed(made["family_mean"], "family", F.col("family"), mean=F.col("mean_sales")),
        _listed(made["daily_total"], "day", F.col("date"), total=F.col("sales")),
        _listed(made["city_mean"], "city", F.col("city"), mean=F.col("mean_sales")),
        _listed(
            made["holiday_impact"], "holiday", F.col("is_holiday"), mean=F.col("mean_daily_sales"), days=F.col("days")
        ),
        _listed(made["oil_relation"], "oil", F.col("date"), sales=F.col("sales"), price=F.col("dcoilwtico")),
    ]
    return rounded(reduce(DataFrame.unionByName, parts))


ACCURACY_SQL = """count(*) AS n, avg(p - a) AS mean_error, avg(abs(p - a)) AS mae, sqrt(avg((p - a) ** 2)) AS rmse,
  avg(abs(p - a) / a * 100) AS mape"""


@query(
    "pipe_report",
    f"""WITH ok AS (SELECT predicted AS p, actual AS a FROM t_pairs WHERE actual > 0),
  acc AS (SELECT {ACCURACY_SQL} FROM ok)
SELECT 'kpi' AS part, 'all' AS item, unnest(['avg_sales', 'stores']) AS figure,
  unnest([{rd('avg(sales)')}, CAST(count(DISTINCT store_id) AS DOUBLE)]) AS amount FROM t_facts
UNION ALL SELECT 'accuracy', 'all', unnest(['count', 'mean_error', 'mae', 'rmse', 'mape', 'forecast_accuracy']),
  unnest([CAST(n AS DOUBLE), {rd('mean_error')}, {rd('mae')}, {rd('rmse')}, {rd('mape')}, {rd('greatest(0, 100 - mape)')}])
FROM acc
UNION ALL SELECT 'family', name, 'total', sum(sales) FROM t_facts JOIN t_families f ON f.id = family_id GROUP BY 2
UNION ALL SELECT * FROM (SELECT 'store', CAST(store_id - 1 AS VARCHAR), 'sales', sum(sales) AS s FROM t_facts
                         GROUP BY 2, store_id ORDER BY s DESC, store_id LIMIT 10)""",
)
def _(r: Retail) -> DataFrame:
    """Key figures, all accuracy figures, and sales by family and for the top stores."""
    sales = r.panel()
    made = flows.business_report(r.historical_sales(sales), r.predictions(sales), r.stores(), r.families())
    accuracy = ("count", "mean_error", "mae", "rmse", "mape", "forecast_accuracy")
    every = F.lit("all")
    parts = [
        _listed(made["kpi"], "kpi", every, avg_sales=F.col("avg_sales"), stores=F.col("total_stores")),
        _listed(made["accuracy"], "accuracy", every, **{c: F.col(c) for c in accuracy}),
        _listed(made["families"], "family", F.col("family"), total=F.col("total_sales")),
        _listed(made["stores"], "store", F.col("store_nbr"), sales=F.col("sales")),
    ]
    return rounded(reduce(DataFrame.unionByName, parts))


@query(
    "pipe_training",
    f"""WITH t AS (SELECT count(*) AS n FROM t_sales WHERE date >= DATE '{FIRST}')
SELECT 'decision' AS part, 'retrain' AS item, CAST((SELECT needs_retraining FROM ({RETRAIN_SQL})) AS DOUBLE) AS figure
UNION ALL SELECT 'metrics', 'rows', n // 6 FROM t
UNION ALL SELECT 'folds', 'fold ' || k, 1 FROM (SELECT unnest([1, 2, 3, 4, 5]) AS k)
UNION ALL SELECT 'importance', 'total', 1 UNION ALL SELECT 'features', 'all ranked', 1
UNION ALL SELECT 'baseline', feature, {rd('figure')} FROM (
  SELECT 'sales' AS feature, avg(sales) AS figure FROM t_sales WHERE date >= DATE '{FIRST}'
  UNION ALL SELECT 'onpromotion', avg(onpromotion) FROM t_sales WHERE date >= DATE '{FIRST}')
UNION ALL SELECT 'baseline', 'family ' || family, {rd('count(*) / CAST((SELECT n FROM t) AS DOUBLE)')}
FROM t_sales WHERE date >= DATE '{FIRST}' GROUP BY family""",
)
def _(r: Retail) -> DataFrame:
    """Features, selection, five folds, training, evaluation, baseline and retraining check, as a list of
    figures: rows that validate, folds with an error, sum of importances, whether every chosen
    feature has one, baseline means and shares, and the decision."""
    from shelfcast.plans.catalog.scans import alert_documents

    table = flows.train_features(retail_tables(r), FIRST, exclude_current=True)
    alerts = alert_documents(r)
    newest = alerts.agg(F.max(F.to_timestamp("timestamp"))).scalar()
    run = flows.training_run(table, alerts, newest)

    def part(df: DataFrame, name: str, item, figure) -> DataFrame:
        return df.select(F.lit(name).alias("part"), item.alias("item"), figure.cast("double").alias("figure"))

    ranked = run.importance.agg(
        F.round(F.sum("importance_value"), 6).alias("total"), F.count(F.lit(1)).alias("n")
    )
    parts = [
        part(run.decision, "decision", F.lit("retrain"), F.col("needs_retraining").cast("int")),
        part(run.metrics, "metrics", F.lit("rows"), F.col("count")),
        part(run.fold_scores, "folds", F.concat(F.lit("fold "), "fold"), ((F.col("rmse") > 0) & (F.col("mae") > 0)).cast("int")),
        part(ranked, "importance", F.lit("total"), F.col("total")),
        part(ranked, "features", F.lit("all ranked"), (F.col("n") == len(run.features)).cast("int")),
        part(run.baseline.numeric, "baseline", F.col("feature"), F.col("mean")),
        part(run.baseline.categorical, "baseline", F.concat(F.lit("family "), "category"), F.col("prob")),
    ]
    return rounded(reduce(DataFrame.unionByName, parts))
