"""Feature registry: definitions and groups as tables, fitted parameters as tables."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.operators.features import apply_scaler, fit_categories, fit_scaler, one_hot
from shelfcast.operators.sizing import value_of
from shelfcast.schemas import schema


@dataclass(frozen=True)
class Feature:
    name: str
    description: str = ""
    type: str = "numerical"
    entity_type: str = "product_store"
    transformation: str | None = None
    dependencies: tuple[str, ...] = ()


def registry_table(spark: SparkSession, features: Iterable[Feature], at: str) -> DataFrame:
    moment = F.lit(at).cast("timestamp")
    rows = [
        (f.name, f.description, f.type, f.entity_type, f.transformation, list(f.dependencies))
        for f in features
    ]
    cols = schema("feature_registry").fields[:6]
    table = spark.createDataFrame(rows, ",".join(f"{c.name} {c.dataType.simpleString()}" for c in cols))
    return table.withColumns({"created_at": moment, "updated_at": moment})


def list_features(registry: DataFrame, entity_type: str | None = None) -> DataFrame:
    rows = registry if entity_type is None else registry.where(F.col("entity_type") == entity_type)
    return rows.orderBy("name")


def make_groups(groups: DataFrame, registry: DataFrame) -> DataFrame:
    """Feature groups with members the registry does not know taken out, order kept."""
    known = value_of(registry, F.collect_set("name"))  # names of features
    return groups.withColumn("features", F.array_intersect(F.col("features"), known))


def group_union(groups: DataFrame) -> DataFrame:
    """Every feature of every group once."""
    return groups.select(F.explode("features").alias("feature")).distinct()


def dependency_order(dependencies: Mapping[str, Sequence[str]]) -> list[str]:
    """Features after everything they need; an unknown dependency or a cycle is an error."""
    missing = {d for deps in dependencies.values() for d in deps} - set(dependencies)
    if missing:
        raise ValueError(f"unknown dependencies: {sorted(missing)}")
    try:
        return list(TopologicalSorter({k: sorted(v) for k, v in sorted(dependencies.items())}).static_order())
    except CycleError as problem:
        raise ValueError(f"dependency cycle: {problem.args[1]}") from problem


@dataclass
class Fitted:
    """Parameters of one training run. ``scaler`` is a one-row table, ``categories`` the names of
    the columns to make."""

    standardized: list[str] = field(default_factory=list)
    scaler: DataFrame | None = None
    categories: dict[str, list] = field(default_factory=dict)


def fit(df: DataFrame, features: Sequence[Feature], most_categories: int = 1000) -> Fitted:
    """What the transformations need to know of the training rows. A one-hot column with more than
    ``most_categories`` is an error: each of them becomes a column."""
    by_name = {f.name: f for f in features}
    order = dependency_order({f.name: f.dependencies for f in features})
    absent = [name for name in order if name not in df.columns]
    if absent:
        raise ValueError(f"features not in the table: {absent}")
    scaled = [n for n in order if by_name[n].transformation == "standardize"]
    hot = [n for n in order if by_name[n].transformation == "one_hot"]
    return Fitted(
        standardized=scaled,
        scaler=fit_scaler(df, scaled) if scaled else None,
        categories=fit_categories(df, hot, most_categories),
    )


def apply(df: DataFrame, fitted: Fitted) -> DataFrame:
    """The fitted transformations on training or new rows."""
    out = df
    if fitted.scaler is not None:
        out = apply_scaler(out, fitted.scaler, fitted.standardized)
    return one_hot(out, fitted.categories) if fitted.categories else out


def save_parameters(fitted: Fitted, spark: SparkSession, path: str) -> None:
    """Scaler and categories as tables; a category is stored as JSON, which keeps numbers numbers."""
    if fitted.scaler is not None:
        fitted.scaler.write.mode("overwrite").parquet(f"{path}/scaler")
    rows = [(c, i, json.dumps(v)) for c, vs in fitted.categories.items() for i, v in enumerate(vs)]
    spark.createDataFrame(rows, "feature string, position int, category string").write.mode(
        "overwrite"
    ).parquet(f"{path}/categories")


def load_parameters(spark: SparkSession, path: str, standardized: Sequence[str] = ()) -> Fitted:
    """Read parameters back; the category table is bounded by the one-hot limit."""
    rows = spark.read.parquet(f"{path}/categories").orderBy("feature", "position").collect()
    categories: dict[str, list] = {}
    for row in rows:
        categories.setdefault(row["feature"], []).append(json.loads(row["category"]))
    scaler = spark.read.parquet(f"{path}/scaler") if standardized else None
    return Fitted(list(standardized), scaler, categories)


# The features of the training table, under the names it really has.
SALES_FEATURES = (
    Feature("store_nbr", "Store number", "categorical", "store"),
    Feature("family", "Product family", "categorical", "product", "one_hot"),
    Feature("onpromotion", "Whether the item is promoted", "binary", "product_store"),
    Feature("day_of_week", "Weekday, Monday is 0", "numerical", "date"),
    Feature("month", "Month", "numerical", "date"),
    Feature("is_weekend", "Saturday or Sunday", "binary", "date", None, ("day_of_week",)),
    Feature("is_national_holiday", "National holiday", "binary", "date"),
    Feature("dcoilwtico", "Oil price", "numerical", "date", "standardize"),
    Feature("sales_lag_1", "Sales one row back", "numerical", "product_store"),
    Feature("sales_lag_7", "Sales seven rows back", "numerical", "product_store"),
    Feature(
        "sales_roll_7_mean", "Mean of seven rows", "numerical", "product_store", "standardize",
        ("sales_lag_1",),
    ),
)
