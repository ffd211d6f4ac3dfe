"""Compositions of operators: feature tables, exploration, reports, training, health."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions import calendar as C
from shelfcast.functions.numeric import fill_prefixed
from shelfcast.operators import evaluate, features, model, monitor, registry, report, windows
from shelfcast.session import settle
from shelfcast.spec import SALES

STORE_TEXT = ("city", "state", "type")
#: Indicator columns that one text of the stores may add to a feature table.
MOST_STORE_CATEGORIES = 1000
GAP_PREFIXES = ("sales_lag", "sales_roll", "transactions_lag")
FIRST_DAY = dt.date(2015, 1, 28)


def _known_facts(
    df: DataFrame, tables: Mapping[str, DataFrame], categories: Mapping[str, list], days: DataFrame
) -> DataFrame:
    """Calendar, store, price and holiday features, all joined on broadcast-size tables."""
    out = df.withColumns(C.date_parts(F.col("date")))
    if "stores" in tables:
        out = features.join_stores(out, tables["stores"])
        out = features.one_hot(out, categories, drop_first=True)
    if "oil" in tables:
        out = features.join_oil(out, tables["oil"], days)
    if "holidays_events" in tables:
        out = features.join_holiday_flags(out, tables["holidays_events"])
    return out


def _series_features(df: DataFrame, exclude_current: bool) -> DataFrame:
    """Sales lags and rolling statistics in one window node."""
    over = SALES.series()
    return df.withColumns(
        {
            **windows.lags("sales", over=over),
            **windows.rolling("sales", over=over, exclude_current=exclude_current),
        }
    )


def _with_transactions(df: DataFrame, transactions: DataFrame, fill: bool) -> DataFrame:
    lagged = features.transaction_lags(transactions)
    joined = transactions.join(lagged, ["store_nbr", "date"])
    out = df.join(joined, ["store_nbr", "date"], "left")
    return out.fillna(0, subset=["transactions"]) if fill else out


def store_categories(tables: Mapping[str, DataFrame]) -> dict[str, list]:
    return features.fit_categories(tables["stores"], STORE_TEXT, MOST_STORE_CATEGORIES) if "stores" in tables else {}


def train_features(
    tables: Mapping[str, DataFrame],
    first_day: dt.date = FIRST_DAY,
    exclude_current: bool = False,
    categories: Mapping[str, list] | None = None,
) -> DataFrame:
    """Raw tables to the training feature table.

    Series windows run on the four panel columns, before anything is joined, so
    the one shuffle of the panel moves narrow rows. The panel is read by several
    steps (calendar, encodings, windows): pass a stored table, not a long query.
    """
    categories = store_categories(tables) if categories is None else categories
    panel = tables["train"].dropna(subset=["date", "store_nbr", "family", "sales", "onpromotion"])
    out = _series_features(panel, exclude_current)
    out = _known_facts(out, tables, categories, features.calendar(panel))
    if "transactions" in tables:
        out = _with_transactions(out, tables["transactions"], fill=True)
    out = features.target_encode(out, ["family", "store_nbr"], "sales", train=panel)
    out = fill_prefixed(out, GAP_PREFIXES)
    return out.where(F.col("date") >= F.lit(first_day))


def test_features(
    tables: Mapping[str, DataFrame], categories: Mapping[str, list] | None = None
) -> DataFrame:
    """Raw tables to the test feature table; history and encodings come from the training rows.

    Transactions of days without a count are the store's last known count.
    """
    categories = store_categories(tables) if categories is None else categories
    train, test = tables["train"], tables["test"]
    both = train.select("store_nbr", "family", "date", "sales", "onpromotion").unionByName(
        test.select("store_nbr", "family", "date", "onpromotion"), allowMissingColumns=True
    )
    dates = test.select("date").distinct()
    series = _series_features(both, exclude_current=False)
    series = series.join(F.broadcast(dates), "date", "left_semi")  # one row per day
    out = _known_facts(series, tables, categories, features.calendar(both))
    if "transactions" in tables:
        known = tables["transactions"]
        last = features.last_known(known, "store_nbr", "transactions").withColumnRenamed(
            "transactions", "__last"
        )
        out = _with_transactions(out, known, fill=False)
        out = features.attach(out, last, "store_nbr")
        out = out.withColumn("transactions", F.coalesce("transactions", "__last")).drop("__last")
    out = features.target_encode(out, ["family", "store_nbr"], "sales", train=train)
    return fill_prefixed(out, GAP_PREFIXES)


def explore(
    sales: DataFrame, stores: DataFrame, holidays: DataFrame, oil: DataFrame
) -> dict[str, DataFrame]:
    """The exploratory summaries, by name."""
    return {
        "daily_total": report.daily_total(sales),
        "weekday_mean": report.weekday_mean(sales),
        "promo_mean": report.promo_mean(sales),
        "family_mean": report.family_mean_top(sales),
        "city_mean": report.city_mean_top(sales, stores),
        "holiday_impact": report.holiday_impact(sales, holidays),
        "oil_relation": report.oil_relation(sales, oil),
    }


def business_report(
    facts: DataFrame, predictions: DataFrame, stores: DataFrame, families: DataFrame
) -> dict[str, DataFrame]:
    """Key figures, store and family comparison, accuracy."""
    pairs = evaluate.pair(predictions, facts)
    labelled = evaluate.label(facts, stores, families)
    return {
        "kpi": report.kpi_summary(facts, pairs),
        "stores": report.store_top(facts, pairs, stores),
        "families": report.performance(labelled, "family"),
        "accuracy": evaluate.accuracy_summary(pairs),
    }


@dataclass
class TrainingRun:
    model: PipelineModel
    features: list[str]
    fold_scores: DataFrame
    importance: DataFrame
    metrics: DataFrame
    baseline: monitor.Baseline
    decision: DataFrame


def training_run(
    table: DataFrame,
    alerts: DataFrame,
    as_of,
    selection: str = "correlation",
    threshold: float = 0.01,
    folds: int = 5,
    gbt: GBTRegressor | None = None,
) -> TrainingRun:
    """Feature table to model, metrics, baseline and retraining check.

    The last fold validates the final model; the table is written once and every
    later step reads it.
    """
    stored = settle(table, "training")
    fitted = registry.fit(stored, [f for f in registry.SALES_FEATURES if f.name in stored.columns])
    shaped = registry.apply(stored.withColumn("__family", F.col("family")), fitted)
    shaped = shaped.withColumnRenamed("__family", "family_name")
    numeric = shaped.drop("family_name")
    chosen = model.select_features(numeric.drop("date"), selection, threshold, gbt=gbt)
    names = [row["feature"] for row in chosen.collect()]  # feature names: columns of the table
    folded = model.time_folds(
        shaped.withColumnRenamed("family_name", "family"), ["date", "store_nbr", "family"], folds
    )
    folded = settle(folded, "folded")
    scores, weights = model.cross_validate(folded, names, folds, gbt)
    final = model.train_with_early_stop(
        folded, names, F.col("fold") == folds, gbt=(gbt or model.regressor()).copy()
    )
    last = model.score(final, folded.where(F.col("fold") == folds), "current")
    pairs = last.select(F.col("predicted_sales").alias("predicted"), F.col("sales").alias("actual"))
    metrics = evaluate.evaluation_metrics(pairs)
    current = metrics.drop("count").unpivot([], ["rmse", "mae", "mape"], "metric_name", "metric_value")
    base = monitor.set_baseline(
        stored, current, ["store_nbr", "family", "date"], ["sales", "onpromotion"], ["family"]
    )
    decision = monitor.retrain_decision(alerts, as_of)
    return TrainingRun(final, names, scores, weights, metrics, base, decision)
