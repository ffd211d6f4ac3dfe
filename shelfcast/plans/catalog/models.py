"""Training, selection and scoring. SQL cannot grow trees, so the twins state facts about the results:
keys and rows, shares that add up, errors below those of the mean."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions import calendar as C
from shelfcast.operators import evaluate, model
from shelfcast.operators import windows as V
from shelfcast.plans.catalog.base import query, rd, rounded
from shelfcast.session import fresh_path, settle
from shelfcast.sources.retail import Retail

_MADE: dict[tuple, object] = {}


def once(r: Retail, name: str, make):
    """A table or model that several queries of one application use, made once per folder."""
    key = (r.spark.sparkContext.applicationId, r.root, name)
    if key not in _MADE:
        _MADE[key] = make()
    return _MADE[key]


def table(r: Retail) -> DataFrame:
    """Feature table without leakage: calendar, promotion, lags and past rolling means.

    Quantities of the test tables are noise, so the target is mostly a fixed function of promotion,
    store and weekday: something that a model can learn and a constant forecast cannot."""
    made = {**V.lags("sales", (1, 7)), **V.rolling("sales", (7,), ("mean", "std"), exclude_current=True)}
    target = (
        F.col("sales") * 0.1 + F.col("onpromotion") * 20 + F.col("store_nbr") % 5 * 3 + F.weekday("date") * 2
    )
    rows = r.panel().withColumns(made).withColumn("sales", target)
    return rows.withColumns(C.date_parts(F.col("date"))).fillna(0.0)


def prepared(r: Retail) -> tuple[DataFrame, list[str]]:
    def make() -> tuple[DataFrame, list[str]]:
        named = table(r).withColumn("family_name", F.col("family"))
        coded, features = model.prepare(named, ("sales", "date", "family_name"))
        return settle(coded, "prepared"), features

    return once(r, "prepared", make)


def folded(r: Retail) -> tuple[DataFrame, list[str]]:
    rows, features = prepared(r)
    order = ["date", "store_nbr", "family_name"]
    return once(r, "folds", lambda: settle(model.time_folds(rows, order), "folds")), features


def on_all_rows(r: Retail):
    rows, features = prepared(r)
    return once(r, "on all rows", lambda: model.train(rows, features))


def on_early_rows(r: Retail):
    rows, features = prepared(r)
    return once(r, "on early rows", lambda: model.train(rows.where(f"year < {SPLIT_YEAR}"), features))


def cross_validated(r: Retail) -> tuple[DataFrame, DataFrame]:
    stored, features = folded(r)
    return once(r, "cross-validated", lambda: model.cross_validate(stored, features))


#: Rows before this year train the models that are scored on the later ones.
SPLIT_YEAR = 2000
BETTER = "avg((prediction - sales) * (prediction - sales)) < var_pop(sales)"


@query(
    "ml_prepare",
    """SELECT s.store_nbr, date, sales, f.id - 1 AS family_code, onpromotion, CAST(month(date) AS INTEGER) AS month
FROM t_sales s JOIN t_families f ON f.name = family""",
)
def _(r: Retail) -> DataFrame:
    rows = r.panel().withColumn("month", F.month("date"))
    coded, features = model.prepare(rows)
    return coded.select("date", "sales", *features)


@query(
    "ml_train_gbt",
    "SELECT store_nbr, count(*) AS n, TRUE AS better_than_mean FROM t_sales GROUP BY store_nbr",
)
def _(r: Retail) -> DataFrame:
    """Fitted values of boosted trees, judged per store."""
    fitted = on_all_rows(r).transform(prepared(r)[0])
    return fitted.groupBy("store_nbr").agg(
        F.count(F.lit(1)).alias("n"), F.expr(BETTER).alias("better_than_mean")
    )


@query(
    "ml_early_stop",
    "SELECT count(*) // 6 AS n, TRUE AS better_than_mean, TRUE AS within_rounds FROM t_sales",
)
def _(r: Retail) -> DataFrame:
    """Boosting that keeps the best round on the last fold."""
    stored, features = folded(r)
    last = F.col("fold") == 5
    fitted = once(r, "early stop", lambda: model.train_with_early_stop(stored, features, last))
    trees = fitted.stages[-1].getNumTrees
    return fitted.transform(stored.where(last)).agg(
        F.count(F.lit(1)).alias("n"),
        F.expr(BETTER).alias("better_than_mean"),
        F.lit(1 <= trees <= model.regressor().getMaxIter()).alias("within_rounds"),
    )


@query(
    "ml_cv",
    """WITH t AS (SELECT count(*) AS n FROM t_sales)
SELECT k AS fold, n // 6 AS test_rows, n - (6 - k) * (n // 6) AS train_rows, TRUE AS better_than_mean,
  TRUE AS within_summary FROM t, (SELECT unnest([1, 2, 3, 4, 5]) AS k)""",
)
def _(r: Retail) -> DataFrame:
    """Rows and errors of five expanding folds."""
    stored, _ = folded(r)
    scores, _ = cross_validated(r)
    spread = stored.groupBy("fold").agg(F.stddev_pop("sales").alias("spread"))
    mean = model.cv_summary(scores).select("rmse", "rmse_std").withColumnsRenamed({"rmse": "m", "rmse_std": "s"})
    low, high = (F.col("m") - 3 * F.col("s")).alias("low"), (F.col("m") + 3 * F.col("s")).alias("high")
    band = mean.select(F.struct(low, high)).scalar()
    return (
        model.fold_bounds(stored)
        .join(spread, "fold")
        .join(scores, "fold")
        .withColumn("band", band)
        .select(
            "fold",
            "test_rows",
            "train_rows",
            (F.col("rmse") < F.col("spread")).alias("better_than_mean"),
            F.col("rmse").between(F.col("band.low"), F.col("band.high")).alias("within_summary"),
        )
    )


FEATURES_SQL = """(VALUES ('store_nbr'), ('family_code'), ('onpromotion'), ('sales_lag_1'), ('sales_lag_7'),
  ('sales_roll_7_mean'), ('sales_roll_7_std'), ('day_of_week'), ('day_of_month'), ('month'), ('year'), ('quarter'),
  ('is_weekend'), ('is_month_start'), ('is_month_end')) AS f(feature_name)"""


@query(
    "ml_importance",
    f"""SELECT feature_name, TRUE AS is_share, CAST(1 AS DOUBLE) AS total,
  feature_name IN ('onpromotion', 'day_of_week', 'store_nbr') AS leads FROM {FEATURES_SQL}""",
)
def _(r: Retail) -> DataFrame:
    """Importance averaged over the folds; the three features the target is made of lead."""
    _, ranks = cross_validated(r)
    one = Window.partitionBy(F.lit(0))  # one row per feature
    return ranks.select(
        "feature_name",
        F.col("importance_value").between(0, 1).alias("is_share"),
        F.round(F.sum("importance_value").over(one), 9).alias("total"),
        (F.row_number().over(one.orderBy(F.desc("importance_value"), "feature_name")) <= 3).alias("leads"),
    )


@query(
    "ml_select_features",
    " UNION ALL ".join(
        f"SELECT '{n}' AS feature, {rd(f'abs(corr(sales, {e}))')} AS score FROM ml HAVING abs(corr(sales, {e})) >= 0.001"
        for n, e in {
            "store_nbr": "store_nbr",
            "onpromotion": "onpromotion",
            "sales_lag_1": "lag_1",
            "date_year": "year(date)",
            "date_month": "month(date)",
            "date_day": "day(date)",
            "date_dayofweek": "isodow(date) - 1",
            "family_code": "code",
        }.items()
    ).join(
        [
            "WITH ml AS (SELECT s.*, f.id - 1 AS code, coalesce(lag(sales) OVER (PARTITION BY store_nbr, family "
            "ORDER BY date), 0) AS lag_1 FROM t_sales s JOIN t_families f ON f.name = family) ",
            "",
        ]
    ),
)
def _(r: Retail) -> DataFrame:
    """Selection by correlation; the date counts through its parts, the family through its code."""
    rows = r.panel().withColumns(V.lags("sales", (1,))).fillna(0.0, subset=["sales_lag_1"])
    return rounded(model.select_features(rows, "correlation", threshold=0.001))


@query("ml_select_by_importance", "SELECT 3 AS made_of, TRUE AS above FROM (SELECT 1)")
def _(r: Retail) -> DataFrame:
    """Selection by importance finds the features the target is made of."""
    chosen = once(r, "selected", lambda: settle(model.select_features(table(r).drop("date"), "importance", 0.001), "chosen"))
    made_of = F.col("feature").isin("onpromotion", "day_of_week", "store_nbr")
    return chosen.agg(
        F.sum(made_of.cast("int")).cast("int").alias("made_of"), (F.min("score") >= 0.001).alias("above")
    )


@query(
    "ml_batch_score",
    f"""SELECT store_nbr || '-' || family || '-' || strftime(date, '%Y-%m-%d') AS id, 'trees-1' AS model_version,
  TRUE AS usable FROM t_sales WHERE year(date) >= {SPLIT_YEAR}""",
)
def _(r: Retail) -> DataFrame:
    """Train on early years, score the later ones."""
    later = prepared(r)[0].where(f"year >= {SPLIT_YEAR}").withColumnRenamed("family_name", "family")
    scored = model.score(on_early_rows(r), later, "trees-1")
    return scored.select("id", "model_version", (F.col("predicted_sales") >= 0).alias("usable"))


@query(
    "ml_evaluate",
    f"""SELECT count(*) AS count, TRUE AS rmse_above_mae, TRUE AS better_than_constant
FROM t_sales WHERE year(date) >= {SPLIT_YEAR}""",
)
def _(r: Retail) -> DataFrame:
    """Errors on later years beside those of the constant forecast."""
    later = on_early_rows(r).transform(prepared(r)[0].where(f"year >= {SPLIT_YEAR}"))
    flat = model.constant_forecast(later).select(F.col("predicted_sales").alias("predicted"), F.col("sales").alias("actual"))
    pairs = later.select(F.col("prediction").alias("predicted"), F.col("sales").alias("actual"))
    constant = evaluate.evaluation_metrics(flat).select("rmse").scalar()
    return evaluate.evaluation_metrics(pairs).select(
        "count", (F.col("rmse") >= F.col("mae")).alias("rmse_above_mae"), (F.col("rmse") < constant).alias("better_than_constant")
    )


@query(
    "ml_constant_model",
    f"SELECT count(*) AS count, {rd('sqrt(avg((10 - sales) ** 2))')} AS rmse, {rd('avg(abs(10 - sales))')} AS mae, "
    f"{rd('avg(CASE WHEN sales <> 0 THEN abs((sales - 10) / sales) * 100 END)')} AS mape FROM t_sales",
)
def _(r: Retail) -> DataFrame:
    flat = model.constant_forecast(r.sales())
    pairs = flat.select(F.col("predicted_sales").alias("predicted"), F.col("sales").alias("actual"))
    return rounded(evaluate.evaluation_metrics(pairs))


@query("ml_persist", "SELECT count(*) AS n, CAST(0 AS DOUBLE) AS largest_gap FROM t_sales")
def _(r: Retail) -> DataFrame:
    """A saved and loaded model forecasts what the model in memory does."""
    rows, _ = prepared(r)
    path = fresh_path(r.spark, "model")
    model.save(on_all_rows(r), path)
    both = on_all_rows(r).transform(rows).withColumnRenamed("prediction", "before").drop("features")
    gap = F.abs(F.col("prediction") - F.col("before"))
    return model.load(path).transform(both).agg(F.count(F.lit(1)).alias("n"), F.max(gap).alias("largest_gap"))
