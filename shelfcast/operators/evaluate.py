"""Forecast accuracy: pairing with actuals, metrics, bias and baseline checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions import errors as E
from shelfcast.functions.numeric import clip, ratio
from shelfcast.functions.numeric import correlation as pearson
from shelfcast.operators.windows import naive_baseline
from shelfcast.spec import SALES, PanelSpec

KEYS = ["store_id", "family_id"]


def label(facts: DataFrame, stores: DataFrame, families: DataFrame) -> DataFrame:
    """Star join: store_nbr and family name for rows with surrogate keys. No hints: Spark knows
    the size of stored dimensions and broadcasts them while they are small."""
    s = stores.select(F.col("id").alias("store_id"), "store_nbr", "city", "state", "type")
    f = families.select(F.col("id").alias("family_id"), F.col("name").alias("family"))
    return facts.join(s, "store_id").join(f, "family_id")


def pair(
    predictions: DataFrame, actuals: DataFrame, as_of=None, version_contains: str | None = None
) -> DataFrame:
    """Past predictions with the actual of the same store, family and day."""
    past = predictions
    if version_contains is not None:
        past = past.where(F.col("model_version").contains(version_contains))
    if as_of is not None:
        past = past.where(F.col("target_date") <= F.lit(as_of))
    truth = actuals.select(*KEYS, F.col("date").alias("target_date"), F.col("sales").alias("actual"))
    return past.join(truth, [*KEYS, "target_date"]).withColumnRenamed("predicted_sales", "predicted")


def accuracy_detail(pairs: DataFrame) -> DataFrame:
    """Errors per pair, positive actuals only."""
    p, a = F.col("predicted"), F.col("actual")
    return pairs.where(a > 0).withColumns(
        {
            "error": E.error(p, a),
            "absolute_error": F.abs(p - a),
            "percentage_error": E.pct_error(p, a),
        }
    )


def accuracy_summary(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """count, mean error, MAE, RMSE, MAPE and accuracy over positive actuals."""
    p, a = F.col("predicted"), F.col("actual")
    mape = E.mape_positive(p, a)
    return (
        pairs.where(a > 0)
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.avg(p - a).alias("mean_error"),
            E.mae(p, a).alias("mae"),
            E.rmse(p, a).alias("rmse"),
            mape.alias("mape"),
            E.accuracy_from(mape).alias("forecast_accuracy"),
        )
    )


def model_metrics(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """RMSE, MAE and R² over all pairs, MAPE over positive actuals (0 when there are none)."""
    p, a = F.col("predicted"), F.col("actual")
    return pairs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("count"),
        E.rmse(p, a).alias("rmse"),
        E.mae(p, a).alias("mae"),
        F.coalesce(E.mape_positive(p, a), F.lit(0.0)).alias("mape"),
        E.r_squared(p, a).alias("r2"),
    )


def evaluation_metrics(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """RMSE, MAE and MAPE (actual != 0) with predictions held at 0 or above."""
    p, a = clip(F.col("predicted"), lower=0.0), F.col("actual")
    return pairs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("count"),
        E.rmse(p, a).alias("rmse"),
        E.mae(p, a).alias("mae"),
        E.mape_nonzero(p, a).alias("mape"),
    )


def evaluation_by_group(pairs: DataFrame, by: Sequence[str]) -> DataFrame:
    return evaluation_metrics(pairs, by).orderBy(F.desc("rmse"), *by)


def weighted_error(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return pairs.groupBy(*by).agg(E.wape(F.col("predicted"), F.col("actual")).alias("wape"))


def error_distribution(pairs: DataFrame) -> DataFrame:
    gap = F.col("predicted") - F.col("actual")
    return pairs.agg(F.avg(gap).alias("mean_error"), F.stddev_pop(gap).alias("std_error"))


def bias_drift(pairs: DataFrame, by: Sequence[str], threshold: float = 0.1) -> DataFrame:
    """Signed error per group, null groups included, and a flag at the threshold."""
    p, a = F.col("predicted"), F.col("actual")
    relative = F.avg((p - a) / (F.abs(a) + 1e-8))
    return pairs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(p - a).alias("signed_err"),
        relative.alias("rel_signed_err"),
        (F.abs(relative) >= threshold).cast("int").alias("flag"),
    )


def baseline_comparison(
    scored: DataFrame, window: int = 7, factor: float = 1.5, spec: PanelSpec = SALES
) -> DataFrame:
    """Model against a trailing-mean baseline; flags where the model is ``factor`` times worse.

    ``scored`` has the panel columns plus ``predicted``.
    """
    y, p, b = F.col(spec.target), F.col("predicted"), F.col("__base")
    based = scored.withColumn("__base", naive_baseline(spec.target, window, spec.series()))
    scores = based.agg(
        *[
            fn(col, y).alias(f"{who}_{name}")
            for who, col in (("model", p), ("baseline", b))
            for name, fn in (("rmse", E.rmse), ("mae", E.mae), ("mape", E.mape_floored))
        ]
    )
    return scores.withColumns(
        {
            f"{m}_outlier": F.col(f"model_{m}") > factor * F.col(f"baseline_{m}")
            for m in ("rmse", "mae")
        }
    )


def store_accuracy(pairs: DataFrame) -> DataFrame:
    """Accuracy per store as a fraction; a store without positive actuals is absent."""
    summary = accuracy_summary(pairs, ["store_id"])
    return summary.select("store_id", (F.col("forecast_accuracy") / 100.0).alias("forecast_accuracy"))


def daily_accuracy(pairs: DataFrame) -> DataFrame:
    summary = accuracy_summary(pairs, ["target_date"])
    return summary.select(
        F.col("target_date").alias("date"), (F.col("forecast_accuracy") / 100.0).alias("accuracy")
    )


def correlation(df: DataFrame, features: Sequence[str], target: str = "sales") -> DataFrame:
    """(feature, abs correlation with the target), all features in one pass."""
    wide = df.agg(*[F.abs(pearson(F.col(c).cast("double"), F.col(target))).alias(c) for c in features])
    return wide.unpivot([], list(features), "feature", "abs_corr")


def variances(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, population variance), all features in one pass."""
    wide = df.agg(*[F.var_pop(F.col(c).cast("double")).alias(c) for c in features])
    return wide.unpivot([], list(features), "feature", "variance")


def growth_rate(recent, earlier, default: float = 0.1):
    """(recent - earlier) / earlier, or ``default`` without earlier sales."""
    return F.when(earlier > 0, ratio(recent - earlier, earlier)).otherwise(F.lit(default))
