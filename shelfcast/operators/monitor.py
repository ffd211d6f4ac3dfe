"""Data drift, performance drift, alerts and the retraining decision."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.numeric import numeric_columns, ratio, string_columns
from shelfcast.operators.distribution import bin_number, describe, ks_of_counts, to_long
from shelfcast.operators.sizing import value_of
from shelfcast.session import settle
from shelfcast.sources.sinks import fixed_sample

# Thresholds of the drift rules.
STATISTIC_LIMIT = 0.1
SCORE_LIMIT = 0.3
DEGRADATION_LIMIT = 0.1
SEVERE_SCORE = 0.5
ALERT_DAYS = 7


@dataclass(frozen=True)
class Baseline:
    """What new data is compared with; five tables that can be written and read back.

    ``values`` counts every value of every numeric column, so a later comparison uses the whole
    baseline; ``sample`` is a fixed number of rows for plots."""

    numeric: DataFrame
    categorical: DataFrame
    values: DataFrame
    sample: DataFrame
    metrics: DataFrame

    def save(self, path: str) -> None:
        for name in self.__dataclass_fields__:
            getattr(self, name).write.mode("overwrite").parquet(f"{path}/{name}")

    @classmethod
    def load(cls, spark, path: str) -> Baseline:
        return cls(**{n: spark.read.parquet(f"{path}/{n}") for n in cls.__dataclass_fields__})


# --- profiles -----------------------------------------------------------------------------------


def profile_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """mean, median, std, min, max, p25, p75 per numeric column; exact quantiles."""
    names = list(columns) if columns is not None else numeric_columns(df)
    wanted = ["feature", "mean", "median", "std", "min", "max", "p25", "p75"]
    return describe(df, names).select(*wanted)


def value_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(feature, value, n): how often every value of every numeric column occurs."""
    names = list(columns) if columns is not None else numeric_columns(df)
    return to_long(df, names).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))


def profile_categorical(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(feature, category, prob): share of each category among the non-null values."""
    names = list(columns) if columns is not None else string_columns(df)
    counts = (
        to_long(df, names, cast="string")
        .groupBy("feature", F.col("value").alias("category"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    totals = counts.groupBy("feature").agg(F.sum("n").alias("total"))
    shared = counts.join(F.broadcast(totals), "feature")  # one row per column of the table
    return shared.select("feature", "category", (F.col("n") / F.col("total")).alias("prob"))


def set_baseline(
    df: DataFrame,
    metrics: DataFrame,
    keys: Sequence[str],
    numeric: Sequence[str] | None = None,
    categorical: Sequence[str] | None = None,
    sample_rows: int = 1000,
) -> Baseline:
    return Baseline(
        numeric=profile_numeric(df, numeric),
        categorical=profile_categorical(df, categorical),
        values=value_counts(df, numeric),
        sample=fixed_sample(df, keys, sample_rows),
        metrics=metrics,
    )


# --- data drift ---------------------------------------------------------------------------------


def _moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return (
        to_long(df, columns)
        .groupBy("feature")
        .agg(F.avg("value").alias("new_mean"), F.stddev_samp("value").alias("new_std"))
    )


def _against_profile(profile: DataFrame, new: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Baseline and new moments side by side; every side has one row per column."""
    old = profile.select("feature", F.col("mean").alias("old_mean"), F.col("std").alias("old_std"))
    both = F.broadcast(old).join(F.broadcast(_moments(new, columns)), "feature")
    return both.withColumns(
        {
            "mean_diff": F.abs(F.col("old_mean") - F.col("new_mean")),
            "std_diff": F.abs(F.col("old_std") - F.col("new_std")),
        }
    )


def numeric_drift(
    profile: DataFrame,
    baseline_values: DataFrame,
    new: DataFrame,
    columns: Sequence[str],
    limit: float = STATISTIC_LIMIT,
) -> DataFrame:
    """KS distance, p-value and moment differences per column, against the value counts of the whole
    baseline."""
    old = baseline_values.where(F.col("feature").isin(list(columns)))
    distances = ks_of_counts(
        old.select("feature", "value", F.col("n").alias("old"), F.lit(0).cast("long").alias("new")).unionByName(
            value_counts(new, columns).select(
                "feature", "value", F.lit(0).cast("long").alias("old"), F.col("n").alias("new")
            )
        )
    )
    out = _against_profile(profile, new, columns).join(F.broadcast(distances), "feature")
    return out.select(
        "feature",
        "ks_statistic",
        "p_value",
        "mean_diff",
        "std_diff",
        (F.col("ks_statistic") > limit).alias("drift_detected"),
    )


def mean_shift(
    profile: DataFrame, new: DataFrame, columns: Sequence[str], limit: float = STATISTIC_LIMIT
) -> DataFrame:
    """The test used when no baseline rows exist: difference of means in baseline deviations."""
    out = _against_profile(profile, new, columns)
    shift = F.col("mean_diff") / F.greatest(F.col("old_std"), F.lit(1e-6))
    return out.select(
        "feature",
        shift.alias("ks_statistic"),
        F.when(shift > 2.0, 0.05).otherwise(0.5).alias("p_value"),
        "mean_diff",
        "std_diff",
        (shift > limit).alias("drift_detected"),
    )


def categorical_drift(
    baseline: DataFrame,
    new: DataFrame,
    columns: Sequence[str],
    limit: float = STATISTIC_LIMIT,
    new_categories: bool = False,
) -> DataFrame:
    """Half the summed difference of category shares, at most 1.

    By default only the baseline's categories count; ``new_categories`` also
    adds those seen for the first time.
    """
    seen = profile_categorical(new, columns).withColumnRenamed("prob", "new_prob")
    joined = baseline.where(F.col("feature").isin(list(columns))).join(
        seen, ["feature", "category"], "full" if new_categories else "left"
    )
    zero = F.lit(0.0)
    gap = F.abs(F.coalesce("prob", zero) - F.coalesce("new_prob", zero))
    out = joined.groupBy("feature").agg(F.least(F.lit(1.0), F.sum(gap) / 2).alias("js_divergence"))
    return out.withColumn("drift_detected", F.col("js_divergence") > limit)


def drift_score(
    numeric: DataFrame, categorical: DataFrame, total_columns: int, limit: float = SCORE_LIMIT
) -> DataFrame:
    """One row: share of baseline columns that drift, and whether that is too many."""
    flags = numeric.select(F.col("drift_detected")).unionByName(categorical.select("drift_detected"))
    hits = F.coalesce(F.sum(F.col("drift_detected").cast("int")), F.lit(0))
    score = ratio(hits.cast("double"), F.lit(float(total_columns)))
    scored = flags.agg(F.coalesce(score, F.lit(0.0)).alias("overall_drift_score"))
    return scored.withColumn("drift_detected", F.col("overall_drift_score") > limit)


def density_compare(
    old: DataFrame, new: DataFrame, columns: Sequence[str], bins: int = 20
) -> DataFrame:
    """Densities of both sides over shared equal-width bins, for plotting."""
    long = (
        to_long(old, columns)
        .withColumn("side", F.lit("baseline"))
        .unionByName(to_long(new, columns).withColumn("side", F.lit("current")))
    )
    edges = long.groupBy("feature").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    binned = long.join(F.broadcast(edges), "feature")  # one row per column
    bin_of = bin_number(F.col("value"), F.col("lo"), F.col("hi"), bins)
    counts = binned.groupBy("feature", "side", bin_of.alias("bin"), "lo", "hi").agg(
        F.count(F.lit(1)).alias("n")
    )
    totals = counts.groupBy("feature", "side").agg(F.sum("n").alias("total"))
    width = (F.col("hi") - F.col("lo")) / bins
    shared = counts.join(F.broadcast(totals), ["feature", "side"])  # two rows per column
    return shared.select(
        "feature", "side", "bin", ratio(F.col("n") / F.col("total"), width).alias("density")
    )


# --- performance drift --------------------------------------------------------------------------


def performance_drift(
    baseline: DataFrame, current: DataFrame, limit: float = DEGRADATION_LIMIT
) -> DataFrame:
    """(metric_name, metric_value) tables compared; error metrics degrade upwards."""
    old = baseline.select("metric_name", F.col("metric_value").alias("baseline"))
    now = current.select("metric_name", F.col("metric_value").alias("current"))
    gap = F.abs(F.col("current") - F.col("baseline"))
    relative = F.when(F.col("baseline") != 0, gap / F.abs(F.nullif("baseline", F.lit(0.0)))).otherwise(gap)
    out = old.join(now, "metric_name").withColumns({"abs_diff": gap, "rel_diff": relative})
    worse = (F.col("rel_diff") > limit) & (F.col("current") > F.col("baseline"))
    return out.withColumn("degraded", worse)


# --- alerts -------------------------------------------------------------------------------------


def data_alert(
    score: DataFrame,
    numeric: DataFrame,
    categorical: DataFrame,
    n_rows: DataFrame,
    model: str,
    at: Column,
) -> DataFrame:
    """One alert document when drift was detected, else no row."""
    detail = numeric.select("feature", F.col("ks_statistic").alias("statistic"), "drift_detected")
    detail = detail.unionByName(
        categorical.select("feature", F.col("js_divergence").alias("statistic"), "drift_detected")
    )
    # one entry per monitored column
    entries = F.array_sort(F.collect_list(F.struct("feature", "statistic", "drift_detected")))
    row = score.where("drift_detected").withColumns(
        {"n_rows": n_rows.scalar(), "features": value_of(detail, entries)}
    )
    data = F.struct(
        F.col("n_rows").cast("bigint").alias("n_rows"),
        "overall_drift_score",
        "drift_detected",
        "features",
        F.lit(None).cast("array<string>").alias("degraded_metrics"),
    )
    return _alert(row, "data_drift", model, at, data)


def performance_alert(drift: DataFrame, model: str, at: Column) -> DataFrame:
    """One alert document when any metric degraded, else no row."""
    bad = drift.where("degraded").agg(
        F.array_sort(F.collect_list("metric_name")).alias("degraded_metrics")  # a few metrics
    )
    data = F.struct(
        F.lit(None).cast("bigint").alias("n_rows"),
        F.lit(None).cast("double").alias("overall_drift_score"),
        F.lit(True).alias("drift_detected"),
        F.lit(None)
        .cast("array<struct<feature:string,statistic:double,drift_detected:boolean>>")
        .alias("features"),
        "degraded_metrics",
    )
    return _alert(bad.where(F.size("degraded_metrics") > 0), "performance_drift", model, at, data)


def _alert(rows: DataFrame, kind: str, model: str, at: Column, data: Column) -> DataFrame:
    title = kind.replace("_", " ").title()
    return rows.select(
        at.cast("string").alias("timestamp"),
        F.lit(kind).alias("type"),
        F.lit(model).alias("model"),
        F.lit(f"{title} detected for model {model}").alias("message"),
        data.alias("data"),
    )


def recent_alerts(alerts: DataFrame, as_of: Column, days: int = ALERT_DAYS) -> DataFrame:
    """Alerts of the last days, newest first."""
    at = F.to_timestamp("timestamp")
    return alerts.where(at >= as_of - F.make_dt_interval(F.lit(days))).orderBy(F.desc("timestamp"))


def retrain_decision(
    alerts: DataFrame, as_of: Column, days: int = ALERT_DAYS, severe: float = SEVERE_SCORE
) -> DataFrame:
    """One row (needs_retraining, reason) from the recent alerts."""
    at = F.to_timestamp("timestamp")
    recent = alerts.where(at >= as_of - F.make_dt_interval(F.lit(days)))
    score = F.when(F.col("type") == "data_drift", F.col("data.overall_drift_score"))
    facts = recent.agg(
        F.count(F.lit(1)).alias("n"),
        F.max_by(score, F.when(F.col("type") == "data_drift", at)).alias("latest_score"),
        F.coalesce(F.max(F.col("type") == "performance_drift"), F.lit(False)).alias("degraded"),
    )
    is_severe = F.coalesce(F.col("latest_score") > severe, F.lit(False))
    reason = (
        F.when(F.col("n") == 0, "No alerts detected recently")
        .when(
            is_severe,
            F.format_string("Severe data drift detected: %.2f", F.coalesce("latest_score", F.lit(0.0))),
        )
        .when(F.col("degraded"), "Performance degradation detected")
        .otherwise("No significant issues detected")
    )
    return facts.select((is_severe | F.col("degraded")).alias("needs_retraining"), reason.alias("reason"))


def trend_status(daily: DataFrame, threshold: float = 0.6, slack: float = 0.95) -> DataFrame:
    """Latest, mean and lowest daily accuracy with a status; ``daily`` has date and accuracy."""
    facts = daily.agg(
        F.max_by("accuracy", "date").alias("latest"),
        F.avg("accuracy").alias("average"),
        F.min("accuracy").alias("lowest"),
    )
    status = (
        F.when(F.col("latest") < threshold, "CRITICAL")
        .when(F.col("latest") < F.col("average") * slack, "DRIFT")
        .otherwise("STABLE")
    )
    return facts.withColumn("status", status)


# --- tamper evidence ----------------------------------------------------------------------------


def content_digest(df: DataFrame, day: Column, columns: Sequence[Column]) -> DataFrame:
    """(day, n_rows, digest) per day. A row is written as its values, each with its length in front
    (``3:abc``), a null as ``\\N``, joined by ``|``: no two different rows give one text. The digests of the
    rows are added up in five parts that fit a number, so neither row order nor partitioning matters and the
    sums combine before their shuffle."""
    text = F.concat_ws(
        "|", *[F.coalesce(F.concat(F.length(c.cast("string")), F.lit(":"), c.cast("string")), F.lit("\\N")) for c in columns]
    )
    whole = F.sha2(text, 256)
    parts = {  # 13 hex digits are 52 bits
        f"part{i}": F.conv(F.substring(whole, 13 * i + 1, 13), 16, 10).cast("decimal(38,0)") for i in range(5)
    }
    sums = [F.sum(name).cast("string") for name in parts]
    return (
        df.select(day.alias("day"), *[c.alias(name) for name, c in parts.items()])
        .groupBy("day")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.concat_ws("-", *sums).alias("digest"))
    )


# --- one health check ---------------------------------------------------------------------------


def check_health(
    baseline: Baseline,
    new: DataFrame,
    current_metrics: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    model: str,
    at: Column,
) -> dict[str, DataFrame]:
    """Data drift, performance drift, the alerts they raise and the decision that follows.

    The reports are stored as they are made (one row per column or metric), so
    the new data is read once however many of them are looked at later.
    """
    num = settle(numeric_drift(baseline.numeric, baseline.values, new, numeric), "drift")
    cat = settle(categorical_drift(baseline.categorical, new, categorical), "drift")
    score = drift_score(num, cat, len(numeric) + len(categorical))
    perf = settle(performance_drift(baseline.metrics, current_metrics), "performance")
    n_rows = new.agg(F.count(F.lit(1)).alias("n_rows"))
    alerts = data_alert(score, num, cat, n_rows, model, at).unionByName(
        performance_alert(perf, model, at)
    )
    alerts = settle(alerts, "alerts")
    return {
        "numeric": num,
        "categorical": cat,
        "score": score,
        "performance": perf,
        "alerts": alerts,
        "decision": retrain_decision(alerts, at.cast("timestamp")),
    }
