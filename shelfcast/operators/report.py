"""Business reports over sales, predictions and stored model tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.operators import evaluate
from shelfcast.operators.distribution import quantiles
from shelfcast.operators.features import active_holidays, flag_dates, join_oil
from shelfcast.operators.sizing import value_of
from shelfcast.sources.sinks import latest_rows


def lookback(
    df: DataFrame,
    time: str,
    days: int,
    as_of: dt.date | DataFrame | None = None,
    strict: bool = False,
) -> DataFrame:
    """Rows of the last ``days`` days. ``as_of`` is a date, a one-row table with that column, or
    the newest moment in ``df`` itself."""
    if isinstance(as_of, dt.date):
        start = F.date_sub(F.lit(as_of), days)
        return df.where(F.col(time) > start if strict else F.col(time) >= start)
    anchor = value_of(df, F.max(time)) if as_of is None else as_of.scalar()
    start = F.date_sub(anchor, days)
    return df.where(F.col(time) > start if strict else F.col(time) >= start)


def where_keys(df: DataFrame, **keys: object) -> DataFrame:
    """Optional equality filters; a key given as None is left out. Each reaches the scan."""
    for column, value in keys.items():
        if value is not None:
            df = df.where(F.col(column) == value)
    return df


# --- exploration --------------------------------------------------------------------------------


def daily_total(sales: DataFrame) -> DataFrame:
    return sales.groupBy("date").agg(F.sum("sales").alias("sales"))


def weekday_mean(sales: DataFrame) -> DataFrame:
    day = F.col("date")
    return (
        sales.groupBy(F.weekday(day).alias("day_of_week"), F.date_format(day, "EEEE").alias("day_name"))
        .agg(F.avg("sales").alias("mean_sales"))
        .orderBy("day_of_week")
    )


def promo_mean(sales: DataFrame) -> DataFrame:
    return sales.groupBy("onpromotion").agg(F.avg("sales").alias("mean_sales"))


def family_mean_top(sales: DataFrame, n: int = 15) -> DataFrame:
    means = sales.groupBy("family").agg(F.avg("sales").alias("mean_sales"))
    return means.orderBy(F.desc("mean_sales"), "family").limit(n)


def store_means(sales: DataFrame, stores: DataFrame) -> DataFrame:
    means = sales.groupBy("store_nbr").agg(F.avg("sales").alias("mean_sales"))
    return means.join(stores, "store_nbr")


def city_mean_top(sales: DataFrame, stores: DataFrame, n: int = 10) -> DataFrame:
    """Mean over a city's stores of the store means."""
    cities = store_means(sales, stores).groupBy("city").agg(F.avg("mean_sales").alias("mean_sales"))
    return cities.orderBy(F.desc("mean_sales"), "city").limit(n)


def box_stats(sales: DataFrame, stores: DataFrame) -> DataFrame:
    """Five-number summary of store means per store type."""
    five = {"lowest": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "highest": 1.0}
    return quantiles(store_means(sales, stores), ["type"], "mean_sales", five)


def holiday_impact(sales: DataFrame, holidays: DataFrame) -> DataFrame:
    """Mean daily total on national holidays and on other days."""
    flagged = flag_dates(daily_total(sales), active_holidays(holidays, "National"))
    return flagged.groupBy("is_holiday").agg(
        F.avg("sales").alias("mean_daily_sales"), F.count(F.lit(1)).alias("days")
    )


def oil_relation(sales: DataFrame, oil: DataFrame) -> DataFrame:
    """Daily total beside the price known on that day."""
    return join_oil(daily_total(sales), oil).select("date", "sales", "dcoilwtico")


# --- performance --------------------------------------------------------------------------------


def performance(facts: DataFrame, by: str) -> DataFrame:
    """Total, mean and number of sales rows, best first."""
    return (
        facts.groupBy(by)
        .agg(
            F.sum("sales").alias("total_sales"),
            F.avg("sales").alias("avg_sales"),
            F.count(F.lit(1)).alias("transactions"),
        )
        .orderBy(F.desc("total_sales"), by)
    )


def store_top(
    facts: DataFrame, pairs: DataFrame, stores: DataFrame, n: int = 10
) -> DataFrame:
    """The ``n`` stores with the highest sales and their forecast accuracy."""
    totals = facts.groupBy("store_id").agg(F.sum("sales").alias("sales"))
    best = totals.orderBy(F.desc("sales"), "store_id").limit(n)
    # at most n rows: pairs of other stores are dropped before they are aggregated
    wanted = pairs.join(F.broadcast(best.select("store_id")), "store_id", "left_semi")
    scored = best.join(evaluate.store_accuracy(wanted), "store_id", "left")
    named = scored.join(stores.select(F.col("id").alias("store_id"), "store_nbr"), "store_id")
    return named.select("store_nbr", "sales", "forecast_accuracy").orderBy(F.desc("sales"), "store_nbr")


def growth(facts: DataFrame, by: str, days: int, as_of: DataFrame) -> DataFrame:
    """Sales of the last ``days`` days against the equal period before, one pass."""
    age = F.datediff(as_of.scalar(), "date")
    dated = facts.where((age > 0) & (age <= 2 * days))
    sums = dated.groupBy(by).agg(
        F.sum(F.when(age <= days, F.col("sales")).otherwise(0.0)).alias("recent_sales"),
        F.sum(F.when(age > days, F.col("sales")).otherwise(0.0)).alias("earlier_sales"),
    )
    rate = evaluate.growth_rate(F.col("recent_sales"), F.col("earlier_sales"))
    return sums.withColumn("growth", rate)


def kpi_summary(facts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Stores, families, mean sales and forecast accuracy in one row."""
    accuracy = evaluate.accuracy_summary(pairs).select("forecast_accuracy")
    return facts.agg(
        F.count_distinct("store_id").alias("total_stores"),
        F.count_distinct("family_id").alias("total_families"),
        F.avg("sales").alias("avg_sales"),
    ).withColumn("forecast_accuracy", accuracy.scalar())


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts of the four core tables and whether there is enough data to train."""
    (first, df), *rest = tables.items()
    one = df.agg(F.count(F.lit(1)).alias(first))
    one = one.withColumns({name: value_of(other, F.count(F.lit(1))) for name, other in rest})
    enough = (
        (F.col("stores_count") > 0) & (F.col("families_count") > 0) & (F.col("sales_records") > 0)
    )
    return one.withColumn("has_enough_data", enough)


def explorer_stats(df: DataFrame) -> DataFrame:
    return df.agg(
        F.sum("sales").alias("total"),
        F.avg("sales").alias("average"),
        F.max("sales").alias("maximum"),
        F.min("sales").alias("minimum"),
    )


# --- lookups ------------------------------------------------------------------------------------


def latest_prediction(predictions: DataFrame) -> DataFrame:
    """The newest prediction of every series; ``max_by`` combines before the shuffle."""
    row = F.struct(*[c for c in predictions.columns if c not in ("store_id", "family_id")])
    best = F.max_by(row, F.struct("target_date", "prediction_date", "id"))
    return predictions.groupBy("store_id", "family_id").agg(best.alias("__r")).select(
        "store_id", "family_id", "__r.*"
    )


def recent_predictions(
    predictions: DataFrame, actuals: DataFrame, n: int = 10
) -> DataFrame:
    """The ``n`` newest predictions with their actual, where known, and accuracy."""
    newest = predictions.orderBy(F.desc("created_at"), "id").limit(n)
    truth = actuals.select(
        "store_id", "family_id", F.col("date").alias("target_date"), F.col("sales").alias("actual_sales")
    )
    # n rows: broadcast the short side, so actuals are only scanned, never shuffled
    found = truth.join(
        F.broadcast(newest.select("store_id", "family_id", "target_date")),
        ["store_id", "family_id", "target_date"],
        "left_semi",
    )
    out = newest.join(found, ["store_id", "family_id", "target_date"], "left")
    p, a = F.col("predicted_sales"), F.col("actual_sales")
    off = F.when(a > 0, F.abs(p - a) / a * 100)
    return out.withColumns(
        {
            "error": F.when(a > 0, p - a),
            "absolute_error": F.when(a > 0, F.abs(p - a)),
            "percentage_error": off,
            "accuracy": F.when(off.isNotNull(), F.greatest(F.lit(0.0), 100 - off)),
        }
    )


def recent_targets(
    predictions: DataFrame, days: int, n: int = 100, as_of=None, **keys: object
) -> DataFrame:
    kept = lookback(where_keys(predictions, **keys), "target_date", days, as_of)
    return kept.orderBy(F.desc("target_date"), "id").limit(n)


def prediction_history(predictions: DataFrame, store_id: int, family_id: int) -> DataFrame:
    return where_keys(predictions, store_id=store_id, family_id=family_id).orderBy("prediction_date", "id")


def sales_history(
    facts: DataFrame, store_id: int, family_id: int, days: int | None = None, as_of=None
) -> DataFrame:
    kept = where_keys(facts, store_id=store_id, family_id=family_id)
    if days is not None:
        kept = lookback(kept, "date", days, as_of)
    return kept.orderBy("date")


def entities(dim: DataFrame, column: str) -> DataFrame:
    return dim.select(column).orderBy(column)


def latest_importance(importance: DataFrame, model: str, version: str | None = None) -> DataFrame:
    """Newest importance per (version, feature), largest first."""
    rows = where_keys(importance, model_name=model, model_version=version)
    newest = latest_rows(rows, ["model_version", "feature_name"], "timestamp")
    return newest.select("model_version", "feature_name", "importance_value").orderBy(
        F.desc("importance_value"), "model_version", "feature_name"
    )


def top_importance(importance: DataFrame, n: int = 10) -> DataFrame:
    return importance.orderBy(F.desc("importance_value"), "feature_name").limit(n)


def metric_history(metrics: DataFrame, model: str, days: int, as_of=None) -> DataFrame:
    kept = lookback(where_keys(metrics, model_name=model), "timestamp", days, as_of)
    return kept.orderBy("timestamp", "model_version", "metric_name")


def latest_metrics(metrics: DataFrame, model: str, version: str | None = None) -> DataFrame:
    """Newest value per metric; ties on the newest moment all stay."""
    rows = where_keys(metrics, model_name=model, model_version=version)
    return latest_rows(rows, ["metric_name"], "timestamp").select("metric_name", "metric_value")


def latest_metrics_map(metrics: DataFrame, model: str, version: str | None = None) -> DataFrame:
    """The same as one map; one value per metric name."""
    single = latest_metrics(metrics, model, version).groupBy("metric_name").agg(
        F.max("metric_value").alias("metric_value")
    )
    return single.agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("metric_name", "metric_value")))).alias(
            "metrics"
        )
    )


METRIC_NAMES = ("mae", "mape", "r2", "rmse")


def metrics_by_version(
    metrics: DataFrame, model: str, names: Sequence[str] = METRIC_NAMES
) -> DataFrame:
    """Newest metrics per version, one column each; names are given, so no extra pass finds them."""
    rows = where_keys(metrics, model_name=model)
    newest = latest_rows(rows, ["model_version", "metric_name"], "timestamp")
    return newest.groupBy("model_version").pivot("metric_name", list(names)).agg(F.first("metric_value"))


def drift_history(drift: DataFrame, model: str, days: int, version: str | None = None, as_of=None):
    kept = lookback(where_keys(drift, model_name=model, model_version=version), "timestamp", days, as_of)
    return kept.orderBy("timestamp", "drift_metric", "model_version")


def daily_drift(drift: DataFrame, model: str, days: int, as_of=None) -> DataFrame:
    """Per day the worst RMSE and MAE and whether any threshold was exceeded; newest first."""
    rows = lookback(where_keys(drift, model_name=model), "timestamp", days, as_of)
    def worst(name: str) -> Column:
        return F.max(F.when(F.col("drift_metric") == name, F.col("drift_value")))

    daily = rows.groupBy(F.to_date("timestamp").alias("date")).agg(
        worst("rmse").alias("rmse"),
        worst("mae").alias("mae"),
        F.max(F.col("exceeded_threshold").cast("int")).alias("drift_detected"),
    )
    return daily.orderBy(F.desc("date")).limit(days)


def drift_arrays(daily: DataFrame) -> DataFrame:
    """Drift days as parallel arrays, newest first; the input holds at most the days asked for."""
    packed = daily.agg(
        F.sort_array(F.collect_list(F.struct("date", "rmse", "mae", "drift_detected")), False).alias("d")
    )
    zero = F.lit(0.0)
    return packed.select(
        F.transform("d", lambda x: F.date_format(x["date"], "yyyy-MM-dd")).alias("dates"),
        F.transform("d", lambda x: F.coalesce(x["rmse"], zero)).alias("rmse"),
        F.transform("d", lambda x: F.coalesce(x["mae"], zero)).alias("mae"),
        F.transform("d", lambda x: x["drift_detected"] * 100.0).alias("drift_score"),
    )
