"""Lag, rolling, expanding, promotion and fill features over panel series.

Each function returns ``{name: Column}`` so that features of one key can be put
into a single ``withColumns``: they then share one exchange and one sort.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from shelfcast.operators.ordered import sliced_window
from shelfcast.spec import SALES, PanelSpec

LAGS = (1, 7, 14, 28)
WINDOWS = (7, 14, 30)
STATS = ("mean", "std", "max", "min")

_AGG = {"mean": F.avg, "std": F.stddev_samp, "max": F.max, "min": F.min, "sum": F.sum}


def lags(
    column: str,
    steps: Iterable[int] = LAGS,
    over: WindowSpec | None = None,
    default: object = None,
) -> dict[str, Column]:
    w = over or SALES.series()
    return {f"{column}_lag_{k}": F.lag(column, k, default).over(w) for k in steps}


def _framed(stat: str, column: str, frame: WindowSpec, min_periods: int) -> Column:
    value = _AGG[stat](column).over(frame)
    if min_periods <= 1:
        return value
    return F.when(F.count(column).over(frame) >= min_periods, value)


def rolling(
    column: str,
    sizes: Iterable[int] = WINDOWS,
    stats: Iterable[str] = STATS,
    over: WindowSpec | None = None,
    min_periods: int = 1,
    exclude_current: bool = False,
) -> dict[str, Column]:
    """Statistics of the last n rows; ``exclude_current`` moves the frame one row back so the
    target does not enter its own feature."""
    w = over or SALES.series()
    shift = 1 if exclude_current else 0
    return {
        f"{column}_roll_{n}_{stat}": _framed(
            stat, column, w.rowsBetween(1 - n - shift, -shift), min_periods
        )
        for n in sizes
        for stat in stats
    }


def expanding(
    column: str,
    stats: Iterable[str] = STATS,
    over: WindowSpec | None = None,
    min_periods: int = 1,
    exclude_current: bool = False,
) -> dict[str, Column]:
    w = over or SALES.series()
    frame = w.rowsBetween(Window.unboundedPreceding, -1 if exclude_current else 0)
    return {
        f"{column}_expanding_{stat}": _framed(stat, column, frame, min_periods) for stat in stats
    }


def promo_counts(
    column: str = "onpromotion", sizes: Iterable[int] = WINDOWS, over: WindowSpec | None = None
) -> dict[str, Column]:
    w = over or SALES.series()
    return {f"{column}_roll_{n}_count": F.sum(column).over(w.rowsBetween(1 - n, 0)) for n in sizes}


def promo_lags(
    column: str = "onpromotion", steps: Iterable[int] = LAGS, over: WindowSpec | None = None
) -> dict[str, Column]:
    return lags(column, steps, over, default=0)


def promo_distances(
    column: str = "onpromotion", over: WindowSpec | None = None
) -> dict[str, Column]:
    """Rows since the last and to the next promoted row; null when there is none.

    Also the two running counters that some feature tables carry under those
    names: unpromoted rows so far, promotions from here on.
    """
    w = over or SALES.series()
    index = F.row_number().over(w)
    back = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    promoted = F.col(column) > 0
    # the row index is a running count, so the distance is a difference of two counts
    since_mark = F.sum(F.when(promoted, 0).otherwise(1)).over(back)
    return {
        "days_since_promo": index - F.last(F.when(promoted, F.col("__idx")), True).over(back),
        "days_to_promo": F.first(F.when(promoted, F.col("__idx")), True).over(ahead) - index,
        "non_promo_rows_so_far": since_mark,
        "promo_rows_ahead": F.sum(F.when(promoted, 1).otherwise(0)).over(ahead),
    }


def with_promo_distances(
    df: DataFrame, spec: PanelSpec = SALES, column: str = "onpromotion"
) -> DataFrame:
    indexed = df.withColumn("__idx", F.row_number().over(spec.series()))
    return indexed.withColumns(promo_distances(column, spec.series())).drop("__idx")


def promo_density(df: DataFrame, column: str = "onpromotion") -> DataFrame:
    """Share of promoted rows per (store, day) and per (family, day).

    Grouped and joined back instead of an unordered window: partial sums leave
    each task before the shuffle, so a day with very many rows is no hot spot.
    """
    out = df
    for key, name in (("store_nbr", "store_promo_density"), ("family", "family_promo_density")):
        share = df.groupBy(key, "date").agg(F.avg(column).alias(name))
        out = out.join(share, [key, "date"], "left")
    return out


def fill_gaps(column: str, over: WindowSpec) -> Column:
    """Last known value; before the first one, the next known value."""
    back = over.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = over.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return F.coalesce(F.last(column, True).over(back), F.first(column, True).over(ahead))


def naive_baseline(column: str, window: int = 7, over: WindowSpec | None = None) -> Column:
    """Trailing mean of ``window`` rows, the cumulative mean while fewer exist."""
    return F.avg(column).over((over or SALES.series()).rowsBetween(1 - window, 0))


def rolling_on_long_groups(
    df: DataFrame,
    by: list[str],
    order: list[str],
    column: str,
    sizes: Iterable[int] = WINDOWS,
    steps: Iterable[int] = LAGS,
    slice_rows: int = 100_000,
) -> DataFrame:
    """Lags and rolling statistics for tables without a one-row-per-day grain, where one group
    may hold a large share of all rows."""
    sizes, steps = list(sizes), list(steps)

    def features(w: WindowSpec) -> Mapping[str, Column]:
        return {**lags(column, steps, w), **rolling(column, sizes, over=w)}

    reach = max([*steps, *[n - 1 for n in sizes]])
    return sliced_window(df, by, order, features, reach, slice_rows)


def repeated_days(df: DataFrame, spec: PanelSpec = SALES) -> DataFrame:
    """Keys and days with more than one row, and how many they have. Window features assume a panel, in
    which there are none."""
    days = df.groupBy(*spec.keys, spec.time).agg(F.count(F.lit(1)).alias("n_rows"))
    return days.where(F.col("n_rows") > 1)
