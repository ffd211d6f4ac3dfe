"""Exact quantiles, histograms and two-sample distances without holding a column in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.numeric import ratio
from shelfcast.operators.ordered import running_totals
from shelfcast.operators.sizing import value_of


def to_long(
    df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (), cast: str = "double"
) -> DataFrame:
    """Columns to (feature, value) rows; nulls and NaN dropped."""
    wide = df.select(*keep, *[F.col(c).cast(cast).alias(c) for c in columns])
    long = wide.unpivot(list(keep), list(columns), "feature", "value")
    known = F.col("value").isNotNull()
    return long.where(known & ~F.isnan("value") if cast == "double" else known)


def quantiles(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    probs: dict[str, float],
    few_groups: bool = False,
) -> DataFrame:
    """Linear-interpolation quantiles per group, one column per entry of ``probs``.

    Nulls and NaN are left out. Values are counted first, so repeated values travel once; the running count
    then tells which value sits at each rank.
    """
    counts = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).groupBy(*by, value).agg(
        F.count(F.lit(1)).alias("n")
    )
    ranked = running_totals(
        counts, by, [value], {"upto": F.col("n")}, few_groups=few_groups
    )
    exprs: list[Column] = []
    for name, p in probs.items():
        spot = (F.col("upto_total") - 1) * F.lit(float(p))
        low = F.floor(spot)
        at_low = (F.col("upto") > low) & (F.col("upto") - F.col("n") <= low)
        at_high = (F.col("upto") > F.ceil(spot)) & (F.col("upto") - F.col("n") <= F.ceil(spot))
        low_value = F.max(F.when(at_low, F.col(value)))
        high_value = F.max(F.when(at_high, F.col(value)))
        weight = F.max(spot - low)
        exprs.append((low_value + (high_value - low_value) * weight).alias(name))
    return ranked.groupBy(*by).agg(*exprs)


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max, one row per column."""
    long = to_long(df, columns)
    moments = long.groupBy("feature").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    spots = {"p25": 0.25, "median": 0.5, "p75": 0.75}
    cuts = quantiles(long, ["feature"], "value", spots, few_groups=True)
    return moments.join(F.broadcast(cuts), "feature")  # one row per column


def histogram(
    df: DataFrame, value: str, bins: int, lower: float | None = None, upper: float | None = None
) -> DataFrame:
    """Counts per equal-width bin; the last bin includes its right edge. Without edges the
    data's own minimum and maximum are used."""
    data = df.select(F.col(value).cast("double").alias("value")).where(F.col(value).isNotNull())
    if lower is None or upper is None:
        edges = value_of(data, F.min("value").alias("lo"), F.max("value").alias("hi"))
        lo, hi = edges["lo"], edges["hi"]
    else:
        lo, hi = F.lit(float(lower)), F.lit(float(upper))
        data = data.where(F.col("value").between(lower, upper))
    binned = data.select(bin_number(F.col("value"), lo, hi, bins).alias("bin"))
    return binned.groupBy("bin").agg(F.count(F.lit(1)).alias("count"))


def bin_number(value: Column, lo: Column, hi: Column, bins: int) -> Column:
    """0-based equal-width bin."""
    raw = F.floor(ratio((value - lo) * bins, hi - lo))
    return F.coalesce(F.least(raw, F.lit(bins - 1)), F.lit(0)).cast("int")


def ks_statistic(long: DataFrame, is_baseline: str) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov distance per feature.

    ``long`` has feature, value and a boolean side column. Returns feature,
    statistic, both sample sizes and the asymptotic p-value.
    """
    side = F.col(is_baseline)
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    return ks_of_counts(
        long.select(
            "feature",
            "value",
            F.when(side, one).otherwise(none).alias("old"),
            F.when(side, none).otherwise(one).alias("new"),
        )
    )


def ks_of_counts(sides: DataFrame) -> DataFrame:
    """The same from rows of ``feature, value, old, new``, where ``old`` and ``new`` count occurrences on
    either side; a value may have several rows."""
    counts = sides.groupBy("feature", "value").agg(F.sum("old").alias("old"), F.sum("new").alias("new"))
    sums = {"f_old": F.col("old"), "f_new": F.col("new")}
    steps = running_totals(counts, ["feature"], ["value"], sums, few_groups=True)
    gap = F.abs(
        ratio(F.col("f_old").cast("double"), F.col("f_old_total").cast("double"))
        - ratio(F.col("f_new").cast("double"), F.col("f_new_total").cast("double"))
    )
    result = steps.groupBy("feature").agg(
        F.max(gap).alias("ks_statistic"),
        F.max("f_old_total").alias("n_baseline"),
        F.max("f_new_total").alias("n_new"),
    )
    return result.withColumn(
        "p_value", ks_p_value(F.col("ks_statistic"), F.col("n_baseline"), F.col("n_new"))
    )


def ks_p_value(statistic: Column, n: Column, m: Column, terms: int = 100) -> Column:
    """Asymptotic two-sided p-value of the KS distance (the Kolmogorov series)."""
    x = statistic * F.sqrt(ratio(n.cast("double") * m, n.cast("double") + m))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda total, k: total
        + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * x * x),
    )
    # the series has no usable value near 0, where the p-value is 1 to machine precision
    return F.when(x < 0.2, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))
