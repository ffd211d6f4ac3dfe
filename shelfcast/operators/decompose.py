"""Additive trend / seasonal / residual split of every series."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.spec import SALES, PanelSpec

# Seasonal periods in rows.
PERIODS = {"weekly": 7, "monthly": 30, "yearly": 365}


def seasonal_decompose(
    df: DataFrame, spec: PanelSpec = SALES, periods: Mapping[str, int] = PERIODS
) -> DataFrame:
    """Add ``<target>_<period>_{trend,seasonal,resid}``; null for series under two periods.

    Trend is the centred moving average of one period. Its ends are extended by
    straight lines: at the front through the first two defined points, at the
    back through the two points before the last defined one, which is what the
    widely used Python implementation does when asked to extrapolate.
    """
    series, whole = spec.series(), spec.whole_series()
    out = df.withColumns(
        {"__i": F.row_number().over(series), "__n": F.count(F.lit(1)).over(whole)}
    )
    for name, p in periods.items():
        out = _one_period(out, spec, f"{spec.target}_{name}", p)
    return out.drop("__i", "__n")


def _one_period(df: DataFrame, spec: PanelSpec, prefix: str, p: int) -> DataFrame:
    series, whole = spec.series(), spec.whole_series()
    i, n, x = F.col("__i"), F.col("__n"), F.col(spec.target)
    half = p // 2
    long_enough = n >= 2 * p
    defined = long_enough & (i > half) & (i <= n - half)

    def mean(lo: int, hi: int) -> Column:
        return F.avg(x).over(series.rowsBetween(lo, hi))

    centred = mean(-half, half) if p % 2 else (mean(-half, half - 1) + mean(1 - half, half)) / 2
    df = df.withColumn("__t", F.when(defined, centred))

    def at(position: Column) -> Column:
        return F.max(F.when(i == position, F.col("__t"))).over(whole)

    first, last = F.lit(half + 1), n - half
    df = df.withColumns(
        {
            "__f0": at(first),
            "__f1": at(first + 1),
            "__b0": at(last - 2),
            "__b1": at(last - 1),
        }
    )
    front = F.col("__f0") + (F.col("__f1") - F.col("__f0")) * (i - first)
    back = F.col("__b0") + (F.col("__b1") - F.col("__b0")) * (i - (last - 2))
    trend = F.when(long_enough, F.coalesce(F.col("__t"), F.when(i <= half, front).otherwise(back)))
    df = df.withColumn(f"{prefix}_trend", trend).withColumn("__pos", (i - 1) % p)

    by_position = Window.partitionBy(*spec.keys, "__pos")
    df = df.withColumn("__s", F.avg(x - F.col(f"{prefix}_trend")).over(by_position))
    # every position occurs once among the first p rows, so this averages the p position means
    centre = F.avg(F.when(i <= p, F.col("__s"))).over(whole)
    df = df.withColumn(f"{prefix}_seasonal", F.col("__s") - centre)
    residual = x - F.col(f"{prefix}_trend") - F.col(f"{prefix}_seasonal")
    return df.withColumn(f"{prefix}_resid", residual).drop(
        "__t", "__f0", "__f1", "__b0", "__b1", "__pos", "__s"
    )
