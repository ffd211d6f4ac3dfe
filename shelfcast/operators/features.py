"""Joins of panel rows with stores, prices, holidays, transactions and encodings."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.operators.ordered import ordered_index
from shelfcast.operators.sizing import attach, by_day, value_of
from shelfcast.operators.windows import LAGS, fill_gaps, lags

LOCALES = ("National", "Regional", "Local")


# --- stores and transactions ------------------------------------------------------------------


def join_stores(df: DataFrame, stores: DataFrame) -> DataFrame:
    """Left join on store_nbr; the store table is read from a file, so Spark knows its size."""
    return df.join(stores, "store_nbr", "left")


def join_transactions(df: DataFrame, transactions: DataFrame) -> DataFrame:
    return df.join(transactions, ["date", "store_nbr"], "left").fillna(0, subset=["transactions"])


def last_known(df: DataFrame, key: str, value: str, time: str = "date") -> DataFrame:
    """(key, value): the newest non-null value per key, combined before the shuffle."""
    known = df.where(F.col(value).isNotNull())
    return known.groupBy(key).agg(F.max_by(value, time).alias(value))


def join_with_last_known(df: DataFrame, transactions: DataFrame) -> DataFrame:
    """Transactions of the day, else the last known ones of the store."""
    last = last_known(transactions, "store_nbr", "transactions").withColumnRenamed(
        "transactions", "__last"
    )
    out = df.join(transactions, ["date", "store_nbr"], "left")
    out = attach(out, last, "store_nbr")
    return out.withColumn("transactions", F.coalesce("transactions", "__last")).drop("__last")


def transaction_lags(transactions: DataFrame, steps: Iterable[int] = LAGS) -> DataFrame:
    """Lags at (store, day) grain, to be joined to any finer panel."""
    over = Window.partitionBy("store_nbr").orderBy("date")
    made = lags("transactions", steps, over)
    return transactions.select("store_nbr", "date", *[c.alias(n) for n, c in made.items()])


# --- calendar tables: one row per day -----------------------------------------------------------


def calendar(df: DataFrame, time: str = "date") -> DataFrame:
    """Every day from the first to the last day of ``df``."""
    bounds = df.agg(F.min(time).alias("lo"), F.max(time).alias("hi"))
    return bounds.where("lo is not null").select(F.explode(F.sequence("lo", "hi")).alias("date"))


def oil_features(oil: DataFrame) -> DataFrame:
    """Forward-filled price and its 7- and 30-observation means, on the price table's own rows."""
    days = Window.orderBy("date")  # one row per trading day
    filled = oil.withColumn(
        "dcoilwtico",
        F.last("dcoilwtico", True).over(days.rowsBetween(Window.unboundedPreceding, 0)),
    )
    return filled.select(
        "date",
        "dcoilwtico",
        F.avg("dcoilwtico").over(days.rowsBetween(-6, 0)).alias("oil_price_7d_avg"),
        F.avg("dcoilwtico").over(days.rowsBetween(-29, 0)).alias("oil_price_30d_avg"),
    )


def as_of_daily(series: DataFrame, days: DataFrame) -> DataFrame:
    """For every day the latest values on or before it, and before the first the earliest."""
    values = [c for c in series.columns if c != "date"]
    spine = days.select("date").unionByName(series.select("date")).distinct()
    order = Window.orderBy("date")  # one row per day
    joined = spine.join(series, "date", "left")
    return joined.select("date", *[fill_gaps(c, order).alias(c) for c in values])


def join_oil(df: DataFrame, oil: DataFrame, days: DataFrame | None = None) -> DataFrame:
    """``days`` are the calendar days of ``df`` when they are cheaper to get elsewhere."""
    daily = as_of_daily(oil_features(oil), calendar(df) if days is None else days)
    return by_day(df, daily)


def active_holidays(holidays: DataFrame, locale: str | None = None) -> DataFrame:
    active = holidays.where(~F.col("transferred"))
    return active.where(F.col("locale") == locale) if locale else active


def holiday_flags(holidays: DataFrame) -> DataFrame:
    """One row per holiday date with a 0/1 flag per locale, so the join cannot multiply rows."""
    flags = [
        F.max((F.col("locale") == name).cast("int")).alias(f"is_{name.lower()}_holiday")
        for name in LOCALES
    ]
    return active_holidays(holidays).groupBy("date").agg(*flags)


def join_holiday_flags(df: DataFrame, holidays: DataFrame) -> DataFrame:
    names = [f"is_{name.lower()}_holiday" for name in LOCALES]
    return by_day(df, holiday_flags(holidays)).fillna(0, subset=names)


def holiday_distances(days: DataFrame, holidays: DataFrame) -> DataFrame:
    """Days to the next and since the last national holiday, per calendar day."""
    marks = active_holidays(holidays, "National").select("date").distinct()
    marked = days.join(F.broadcast(marks.withColumn("mark", F.col("date"))), "date", "left")
    order = Window.orderBy("date")  # one row per day
    back = order.rowsBetween(Window.unboundedPreceding, 0)
    ahead = order.rowsBetween(0, Window.unboundedFollowing)
    return marked.select(
        "date",
        F.datediff(F.first("mark", True).over(ahead), "date").alias("days_to_next_holiday"),
        F.datediff("date", F.last("mark", True).over(back)).alias("days_since_last_holiday"),
    )


def join_holiday_distances(df: DataFrame, holidays: DataFrame) -> DataFrame:
    return by_day(df, holiday_distances(calendar(df), holidays))


def flag_dates(df: DataFrame, dates: DataFrame, name: str = "is_holiday") -> DataFrame:
    """0/1: does the row's date occur in ``dates``."""
    marked = dates.select("date").distinct().withColumn("__hit", F.lit(1))
    return by_day(df, marked).withColumn(name, F.coalesce("__hit", F.lit(0))).drop("__hit")


def join_weather(
    df: DataFrame, weather: DataFrame | None = None, defaults: Mapping[str, float] | None = None
) -> DataFrame:
    """Weather by (store_nbr, date) with defaults where it is unknown."""
    defaults = defaults or {"temperature": 25.0, "precipitation": 0.0, "humidity": 70.0}
    if weather is None:
        return df.withColumns({c: F.lit(v) for c, v in defaults.items()})
    out = df.join(weather.select("store_nbr", "date", *defaults), ["store_nbr", "date"], "left")
    return out.fillna(dict(defaults))


def densify(df: DataFrame, keys: Sequence[str] = ("store_nbr", "family")) -> DataFrame:
    """One row per series and calendar day; sales of absent days are 0."""
    series = df.select(*keys).distinct()
    days = value_of(df, F.min("date").alias("lo"), F.max("date").alias("hi"))
    grid = series.withColumn("date", F.explode(F.sequence(days["lo"], days["hi"])))
    return grid.join(df, [*keys, "date"], "left").fillna(0)


# --- encodings ----------------------------------------------------------------------------------


def fit_target_encoding(df: DataFrame, column: str, target: str = "sales") -> DataFrame:
    """(column, mean, count): a parameter table, one row per category."""
    return df.groupBy(column).agg(
        F.avg(target).alias(f"{column}_{target}_mean"), F.count(target).alias(f"{column}_count")
    )


def target_encode(
    df: DataFrame,
    columns: Sequence[str],
    target: str = "sales",
    train: DataFrame | None = None,
    with_count: bool = False,
) -> DataFrame:
    """Replace nothing, add the category mean of the target; unseen categories get the overall
    mean. ``train`` restricts the fit to other rows than those encoded."""
    source = df if train is None else train
    overall, out = value_of(source, F.avg(target)), df
    for column in columns:
        fitted = fit_target_encoding(source, column, target)
        mean, count = f"{column}_{target}_mean", f"{column}_count"
        out = attach(out, fitted if with_count else fitted.drop(count), column)
        out = out.withColumn(mean, F.coalesce(F.col(mean), overall))
        if with_count:
            out = out.fillna(0, subset=[count])
    return out


def fit_categories(df: DataFrame, columns: Sequence[str], most: int) -> dict[str, list]:
    """Sorted categories per column. They become columns of the result, so the caller says how
    many a table may get of each; a column with more belongs in ``category_codes``."""
    found: dict[str, list] = {}
    for column in columns:
        values = df.select(column).where(F.col(column).isNotNull()).distinct()
        rows = values.limit(most + 1).collect()
        if len(rows) > most:
            raise ValueError(f"{column} has more than {most} categories")
        found[column] = sorted(row[0] for row in rows)
    return found


def one_hot(
    df: DataFrame, categories: Mapping[str, Sequence], drop_first: bool = False
) -> DataFrame:
    """0/1 column per fitted category; the source column goes, unknown values give all zeros."""
    made: dict[str, Column] = {}
    for column, values in categories.items():
        for value in list(values)[1 if drop_first else 0 :]:
            hit = F.col(column).eqNullSafe(F.lit(value))
            made[f"{column}_{value}"] = hit.cast("int")
    return df.withColumns(made).drop(*categories)


def fit_codes(df: DataFrame, column: str) -> DataFrame:
    """(column, <column>_code): categories numbered from 0 in sorted order, exact for any
    number of categories."""
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    ranked = ordered_index(values, [], [column], "__rank")
    return ranked.select(column, (F.col("__rank") - 1).cast("int").alias(f"{column}_code"))


def category_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add an integer code per column; null and unseen values get -1."""
    out = df
    for column in columns:
        out = attach(out, fit_codes(df, column), column)
        out = out.fillna(-1, subset=[f"{column}_code"])
    return out


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: mean and population standard deviation per column; 0 deviation becomes 1."""
    exprs: list[Column] = []
    for c in columns:
        deviation = F.stddev_pop(c)
        exprs.append(F.avg(c).alias(f"{c}__mean"))
        exprs.append(F.when(deviation == 0, 1.0).otherwise(deviation).alias(f"{c}__std"))
    return df.agg(*exprs)


def apply_scaler(df: DataFrame, scaler: DataFrame, columns: Sequence[str]) -> DataFrame:
    fitted = scaler.select(F.struct(*scaler.columns)).scalar()
    return df.withColumns({c: (F.col(c) - fitted[f"{c}__mean"]) / fitted[f"{c}__std"] for c in columns})


def common_columns(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    shared = [c for c in left.columns if c in set(right.columns)]
    return left.select(*shared), right.select(*shared)


# --- fixed feature vector -----------------------------------------------------------------------

# Family slots of the feature vector, in slot order.
VECTOR_FAMILIES = [
    "AUTOMOTIVE",
    "BABY CARE",
    "BEAUTY",
    "BEVERAGES",
    "BOOKS",
    "BREAD/BAKERY",
    "CELEBRATION",
    "CLEANING",
    "DAIRY",
    "DELI",
    "EGGS",
    "FROZEN FOODS",
    "GROCERY I",
    "GROCERY II",
    "HARDWARE",
    "HOME AND KITCHEN",
    "LADIESWEAR",
    "LAWN AND GARDEN",
    "LINGERIE",
    "LIQUOR,WINE,BEER",
    "MAGAZINES",
    "MEATS",
    "PERSONAL CARE",
    "PET SUPPLIES",
    "PLAYERS AND ELECTRONICS",
    "POULTRY",
    "PREPARED FOODS",
    "PRODUCE",
    "SCHOOL AND OFFICE SUPPLIES",
    "SEAFOOD",
    "HOME APPLIANCES",
    "TOYS",
]
VECTOR_SIZE = 81
VECTOR_STORES = 40
_DATE_SLOTS = 8


def vector_names(
    families: Sequence[str] = VECTOR_FAMILIES, stores: int = VECTOR_STORES, size: int = VECTOR_SIZE
) -> list[str]:
    names = ["onpromotion", "year", "month", "day", "dayofweek", "dayofyear", "quarter", "is_weekend"]
    names += [f"store_{i}" for i in range(1, stores + 1)]
    names += [f"family_{f}" for f in families]
    return (names + [f"feature_{i}" for i in range(len(names), size)])[:size]


def feature_vector(
    store: Column,
    family: Column,
    promo: Column,
    day: Column,
    families: Sequence[str] = VECTOR_FAMILIES,
    stores: int = VECTOR_STORES,
    size: int = VECTOR_SIZE,
) -> Column:
    """array<double> of promotion flag, seven date parts, store slots and family slots; a store
    or family without a slot leaves its block at zero, a missing date gives an all-zero vector."""
    head = F.array(
        *[
            c.cast("double")
            for c in (
                promo.cast("int"),
                F.year(day),
                F.month(day),
                F.dayofmonth(day),
                F.weekday(day),
                F.dayofyear(day),
                F.quarter(day),
                (F.weekday(day) >= 5).cast("int"),
            )
        ]
    )
    family_slot = F.array_position(F.array(*[F.lit(f) for f in families]), family) - 1
    store_slot = F.when(store.between(1, stores), store - 1)
    hot = F.array(store_slot.cast("int"), (F.when(family_slot >= 0, family_slot) + stores).cast("int"))
    tail = F.transform(
        F.sequence(F.lit(0), F.lit(size - _DATE_SLOTS - 1)),
        lambda i: F.coalesce(F.array_contains(F.array_compact(hot), i), F.lit(False)).cast("double"),
    )
    zeros = F.array_repeat(F.lit(0.0), size)
    return F.when(day.isNull(), zeros).otherwise(F.concat(head, tail))


# --- cold start ---------------------------------------------------------------------------------

# Typical demand per family before any history exists.
FAMILY_BASELINES = {
    "PRODUCE": 45.0,
    "GROCERY I": 38.5,
    "GROCERY II": 35.0,
    "BEVERAGES": 42.0,
    "DAIRY": 28.5,
    "BREAD/BAKERY": 22.0,
    "CLEANING": 18.5,
    "PERSONAL CARE": 32.0,
    "HOME CARE": 25.0,
    "MEATS": 55.0,
    "POULTRY": 48.0,
    "SEAFOOD": 65.0,
    "BEAUTY": 39.0,
    "LIQUOR,WINE,BEER": 75.0,
    "EGGS": 15.5,
    "HOME APPLIANCES": 120.0,
    "BOOKS": 18.0,
    "MAGAZINES": 9.5,
}


def cold_start(
    requests: DataFrame, history: DataFrame, baselines: Mapping[str, float] = FAMILY_BASELINES
) -> DataFrame:
    """Forecast without a model: the series' mean (when not 0), else the family baseline times a
    store factor, else a value derived from the characters of the family name."""
    from shelfcast.functions.text import code_point_score

    means = history.groupBy("store_nbr", "family").agg(F.avg("sales").alias("__mean"))
    table = F.create_map(*[F.lit(x) for pair in baselines.items() for x in pair])
    factor = 0.5 + (F.col("store_nbr") % 10) * 0.15
    fallback = F.coalesce(
        F.try_element_at(table, F.col("family")) * factor,
        15.0 + code_point_score(F.col("family")) / 100.0 * 40.0,
    )
    out = attach(requests, means, ["store_nbr", "family"])
    seen = F.nullif(F.col("__mean"), F.lit(0.0))
    return out.withColumn("predicted_sales", F.coalesce(seen, fallback)).drop("__mean")
