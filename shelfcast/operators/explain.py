"""Rule-based and importance-based explanations of single forecasts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.numeric import first_match, ratio, round_to
from shelfcast.functions.text import FAMILY_SHARE, FAMILY_SHARE_DEFAULT
from shelfcast.operators.sizing import value_of

# Share of a forecast that counts as its base.
BASE_SHARE = 0.6
TOP = 10
SMALLEST = 0.05


def _bands(value: Column, bands: list[tuple[Column, float]], default: float) -> Column:
    return reduce(
        lambda rest, band: F.when(band[0], band[1]).otherwise(rest), reversed(bands), F.lit(default)
    )


def _store_weight(store: Column, large: float, middle: float, small: float) -> Column:
    return _bands(store, [(store < 10, large), (store < 30, middle)], small)


def _weekday_weight(day: Column, weekend: float, friday: float, other: float) -> Column:
    d = F.weekday(day)
    return _bands(d, [(d >= 5, weekend), (d == 4, friday)], other)


def _month_weight(day: Column, peak: float, slump: float, summer: float, other: float) -> Column:
    m = F.month(day)
    bands = [(m.isin(11, 12), peak), (m.isin(1, 2), slump), (m.isin(7, 8), summer)]
    return _bands(m, bands, other)


def _item(feature: Column, contribution: Column, value: Column) -> Column:
    return F.struct(
        feature.alias("feature"),
        contribution.cast("double").alias("contribution"),
        value.cast("string").alias("value"),
    )


def _sortable(feature: Column, contribution: Column, value: Column) -> Column:
    """An item led by its negative size, so that the natural struct order is largest first."""
    return F.struct(
        (-F.abs(contribution)).alias("order"),
        feature.alias("feature"),
        contribution.cast("double").alias("contribution"),
        value.cast("string").alias("value"),
    )


def _sorted(items: Column) -> Column:
    return F.transform(
        F.sort_array(items), lambda x: _item(x["feature"], x["contribution"], x["value"])
    )


def explain(df: DataFrame) -> DataFrame:
    """Contributions of store, family, promotion, weekday, month and holiday, scaled so that they
    add up to prediction minus base.

    Needs store_nbr, family, onpromotion, date, predicted_sales and a 0/1 is_holiday.
    """
    p = F.col("predicted_sales")
    promoted, holiday = F.col("onpromotion") > 0, F.col("is_holiday") > 0
    # Shares of the forecast credited to each circumstance.
    weights = {
        "store": _store_weight(F.col("store_nbr"), 0.15, -0.02, -0.12),
        "family": first_match(F.col("family"), FAMILY_SHARE, FAMILY_SHARE_DEFAULT),
        "onpromotion": F.when(promoted, 0.15).otherwise(-0.08),
        "dayofweek": _weekday_weight(F.col("date"), 0.08, 0.03, -0.03),
        "month": _month_weight(F.col("date"), 0.12, -0.06, 0.04, -0.02),
        "holiday": F.when(holiday, 0.07).otherwise(-0.05),
    }
    labels = {
        "store": (F.concat(F.lit("store_"), "store_nbr"), F.concat(F.lit("Store #"), "store_nbr")),
        "family": (F.concat(F.lit("family_"), "family"), F.col("family")),
        "onpromotion": (F.lit("onpromotion"), F.when(promoted, "Yes").otherwise("No")),
        "dayofweek": (F.lit("dayofweek"), F.date_format("date", "EEE")),
        "month": (F.lit("month"), F.date_format("date", "MMM")),
        "holiday": (F.lit("holiday"), F.when(holiday, "Yes").otherwise("No")),
    }
    # plain columns first: they stay inside generated code, which lambdas over arrays do not
    parts = {k: f"__{k}" for k in weights}
    out = df.withColumns({parts[k]: round_to(p * w, 2) for k, w in weights.items()})
    total = sum((F.col(c) for c in list(parts.values())[1:]), F.col(parts["store"]))
    # the parts are whole cents, so rounding their sum only removes binary noise around zero
    scale = F.coalesce(ratio(p - p * BASE_SHARE, round_to(total, 2)), F.lit(1.0))
    out = out.withColumn("__scale", scale)
    out = out.withColumns({c: round_to(F.col(c) * F.col("__scale"), 2) for c in parts.values()})
    items = F.array(*[_sortable(labels[k][0], F.col(c), labels[k][1]) for k, c in parts.items()])
    return out.withColumns(
        {"base_value": round_to(p * BASE_SHARE, 2), "feature_contributions": _sorted(items)}
    ).drop("__scale", *parts.values())


# Unscaled weight of the product family, first keyword wins.
FAMILY_WEIGHT = {
    "PRODUCE": 1.8,
    "GROCERY": 1.5,
    "BEVERAGES": 1.3,
    "BREAD": 1.2,
    "BAKERY": 1.2,
    "DAIRY": 1.1,
    "CLEANING": 0.9,
    "BEAUTY": 0.7,
    "ELECTRONICS": 2.0,
}


def explain_unscaled(df: DataFrame) -> DataFrame:
    """Fixed-weight variant: contributions above 0.05 in size, at most ten, largest first."""
    # The weights of the variant.
    day = F.col("date")
    items = F.array(
        _sortable(
            F.concat(F.lit("family_"), "family"),
            first_match(F.col("family"), FAMILY_WEIGHT, 1.0),
            F.col("family"),
        ),
        _sortable(
            F.concat(F.lit("store_"), "store_nbr"),
            _store_weight(F.col("store_nbr"), 1.2, -0.2, -1.2),
            F.col("store_nbr"),
        ),
        _sortable(F.lit("month"), _month_weight(day, 1.2, -0.6, 0.4, -0.2), F.month(day)),
        _sortable(F.lit("dayofweek"), _weekday_weight(day, 0.8, 0.3, -0.3), F.weekday(day)),
        _sortable(
            F.lit("onpromotion"),
            F.when(F.col("onpromotion") > 0, 1.5).otherwise(-0.8),
            F.col("onpromotion"),
        ),
        _sortable(F.lit("year"), F.lit(0.05), F.year(day)),
        _sortable(F.lit("quarter"), F.lit(-0.08), F.quarter(day)),
    )
    return df.withColumn("feature_contributions", _ranked(items, SMALLEST, TOP))


def rank_contributions(items: Column, smallest: float = SMALLEST, top: int = TOP) -> Column:
    """Drop contributions of at most ``smallest``, order by size, keep the first ``top``. Items are
    structs with feature and contribution; further fields come after and are kept."""
    keyed = F.transform(items, lambda x: F.struct((-F.abs(x["contribution"])).alias("order"), x.alias("item")))
    kept = F.filter(F.sort_array(keyed), lambda k: k["order"] < -smallest)
    return F.transform(F.slice(kept, 1, top), lambda k: k["item"])


def _ranked(items: Column, smallest: float, top: int) -> Column:
    kept = F.filter(items, lambda x: x["order"] < -smallest)
    return F.slice(_sorted(kept), 1, top)


def relative_sizes(items: Column) -> Column:
    """Each contribution's size relative to the largest one."""
    largest = F.array_max(F.transform(items, lambda x: F.abs(x["contribution"])))
    return F.transform(
        items,
        lambda x: F.struct(
            x["feature"].alias("feature"),
            F.coalesce(ratio(F.abs(x["contribution"]), largest), F.lit(0.0)).alias("relative"),
        ),
    )


def contribution_summary(explained: DataFrame) -> DataFrame:
    """Mean absolute contribution per feature over many forecasts."""
    # the outer form: the inner one makes Spark test the array for emptiness, which repeats the
    # whole expression behind it
    items = explained.select(F.inline_outer("feature_contributions")).where("feature is not null")
    return items.groupBy("feature").agg(
        F.avg(F.abs("contribution")).alias("mean_abs_contribution"), F.count(F.lit(1)).alias("n")
    )


def importance_contributions(
    predictions: DataFrame, importance: DataFrame, top: int = TOP
) -> DataFrame:
    """Split prediction minus base over the features by importance, ten largest.

    Importance is one row per model feature. The order by size is the order by
    importance for every forecast, so the top features are chosen once.
    """
    value = F.col("importance_value")
    share = F.coalesce(ratio(value, value_of(importance, F.sum("importance_value"))), F.lit(0.0))
    ranked = importance.select("feature_name", "importance_value", share.alias("__share"))
    chosen = ranked.orderBy(F.desc(F.abs(value)), "feature_name").limit(top)
    # at most `top` entries, one small array for the whole table
    entry = F.struct((-F.abs(value)).alias("k"), F.col("feature_name").alias("f"), F.col("__share").alias("s"))
    entries = value_of(chosen, F.sort_array(F.collect_list(entry)))
    p = F.col("predicted_sales")
    return predictions.select(*predictions.columns, F.posexplode(entries).alias("__at", "__e")).select(
        *predictions.columns,
        F.col("__e.f").alias("feature"),
        (F.col("__at") + 1).alias("position"),
        ((p - p * BASE_SHARE) * F.col("__e.s")).alias("contribution"),
    )


def fallback_weights(n: int, top: int = TOP) -> list[float]:
    """Linearly falling weights for models without importances; they sum to 1."""
    k = min(top, n)
    raw = [0.3 + (0.05 - 0.3) * i / (k - 1) if k > 1 else 0.3 for i in range(k)]
    return [w / sum(raw) for w in raw]


def fallback_contributions(predictions: DataFrame, features: list[str], top: int = TOP) -> DataFrame:
    p = F.col("predicted_sales")
    pairs = [
        F.struct(F.lit(f).alias("feature"), ((p - p * BASE_SHARE) * w).alias("contribution"))
        for f, w in zip(features, fallback_weights(len(features), top))
    ]
    return predictions.withColumn("feature_contributions", F.array(*pairs))
