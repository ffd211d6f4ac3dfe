"""The retail star built from a wholesale order schema.

Lineitems become daily sales by store (supplier nation) and family (part type),
orders become store transactions and a weekday price series, events become a
second, dense panel. Names follow the retail side from here on.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.functions.numeric import correlation
from shelfcast.functions.text import prediction_id
from shelfcast.operators import evaluate
from shelfcast.operators.ordered import ordered_index
from shelfcast.session import settle

PROMO_DISCOUNT = 0.08
MODEL = "naive7"

# The holiday calendar, by rule.
_YEARS = range(1995, 2002)
HOLIDAYS: list[tuple[dt.date, str, str, str, bool]] = (
    [(dt.date(y, 1, 1), "Holiday", "National", "New Year", False) for y in _YEARS]
    + [(dt.date(y, 5, 1), "Holiday", "National", "Labour Day", False) for y in _YEARS]
    + [(dt.date(y, 12, 25), "Holiday", "National", "Christmas", False) for y in _YEARS]
    + [(dt.date(y, 4, 10), "Holiday", "Regional", "Province Day", False) for y in _YEARS]
    + [(dt.date(y, 8, 15), "Event", "Local", "City Day", False) for y in _YEARS]
    + [
        (dt.date(1998, 5, 24), "Holiday", "National", "Moved Holiday", True),
        (dt.date(1996, 12, 25), "Event", "National", "Second Row Same Day", False),
    ]
)

#: Derived tables of this process, shared by all queries over the same folder.
_STORED: dict[tuple[str, str, str], DataFrame] = {}


class Retail:
    """Retail tables of one data folder; every method returns a lazy DataFrame."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        self._opened: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        """A raw table; opened once, since opening reads file footers."""
        if name not in self._opened:
            self._opened[name] = self.spark.read.parquet(f"{self.root}/{name}.parquet")
        return self._opened[name]

    def lines(self) -> DataFrame:
        """(store_nbr, family, date, l_quantity, promo) of every order line.

        Join sides are left to Spark: it broadcasts part and supplier while their
        files are small and sort-merges them beyond, splitting hot keys at run
        time.
        """
        part = self.raw("part").select("p_partkey", F.col("p_type").alias("family"))
        supplier = self.raw("supplier").select("s_suppkey", F.col("s_nationkey").alias("store_nbr"))
        lines = self.raw("lineitem").select(
            "l_partkey",
            "l_suppkey",
            F.col("l_shipdate").cast("date").alias("date"),
            "l_quantity",
            (F.col("l_discount") >= PROMO_DISCOUNT).cast("int").alias("promo"),
        )
        return lines.join(supplier, lines.l_suppkey == supplier.s_suppkey).join(
            part, lines.l_partkey == part.p_partkey
        )

    def sales(self) -> DataFrame:
        """(store_nbr, family, date, sales, onpromotion), one row per key and day. The sum combines
        before its shuffle."""
        return self.lines().groupBy("store_nbr", "family", "date").agg(
            F.sum("l_quantity").alias("sales"), F.max("promo").alias("onpromotion")
        )

    def _store(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """A derived table, written once per application and folder and read from there afterwards."""
        key = (self.spark.sparkContext.applicationId, self.root, name)
        if key not in _STORED:
            _STORED[key] = settle(make(), name)
        return _STORED[key]

    def panel(self) -> DataFrame:
        """The sales panel as a stored table, for work that reads it more than once: the large
        lineitem table is then scanned and joined a single time."""
        return self._store("panel", self.sales)

    def newest_day(self) -> DataFrame:
        """One row: the last sales date, from a one-column scan."""
        return self.raw("lineitem").agg(F.max("l_shipdate").cast("date").alias("as_of"))

    def stores(self) -> DataFrame:
        nation, region = self.raw("nation"), self.raw("region")
        n = F.col("n_nationkey")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            (n + 1).alias("id"),
            n.alias("store_nbr"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            F.chr(65 + n % 5).alias("type"),
            (n % 17).alias("cluster"),
        )

    def families(self) -> DataFrame:
        """id, name: the distinct part types numbered in name order."""
        return self._store("families", self._families)

    def _families(self) -> DataFrame:
        names = self.raw("part").select(F.col("p_type").alias("name")).distinct()
        return ordered_index(names, [], ["name"], "rank").select(F.col("rank").cast("int").alias("id"), "name")

    def transactions(self) -> DataFrame:
        customer = self.raw("customer").select("c_custkey", F.col("c_nationkey").alias("store_nbr"))
        orders = self.raw("orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("date"))
        return (
            orders.join(customer, orders.o_custkey == customer.c_custkey)
            .groupBy("date", "store_nbr")
            .agg(F.count(F.lit(1)).alias("transactions"))
        )

    def oil(self) -> DataFrame:
        """date, dcoilwtico: a weekday price series with gaps, one row per trading day."""
        orders = self.raw("orders").select(
            F.col("o_orderdate").cast("date").alias("date"),
            F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        )
        daily = (
            orders.where(F.weekday("date") < 5)
            .groupBy("date")
            .agg(F.sum("price").cast("double").alias("total"), F.count(F.lit(1)).alias("n"))
        )
        level = F.round(F.col("total") / F.col("n") / 1000.0 * 10000.0) / 10000.0
        gap = F.dayofmonth("date") % 10 == 0
        return daily.select("date", F.when(~gap, level).alias("dcoilwtico"))

    def holidays(self) -> DataFrame:
        fields = "date date, type string, locale string, description string, transferred boolean"
        return self.spark.createDataFrame(HOLIDAYS, fields)

    def historical_sales(self, sales: DataFrame | None = None) -> DataFrame:
        """Sales under surrogate keys."""
        sales = self.panel() if sales is None else sales
        stores = self.stores().select(F.col("id").alias("store_id"), "store_nbr")
        families = self.families().select(
            F.col("id").alias("family_id"), F.col("name").alias("family")
        )
        keyed = sales.join(stores, "store_nbr").join(families, "family")
        return keyed.select("store_id", "family_id", "date", "sales", "onpromotion")

    def forecasts(self, sales: DataFrame | None = None) -> DataFrame:
        """One-step forecasts: mean of the previous 7 rows of the series, no forecast for the
        first row. ``actual``, ``store_nbr`` and ``family`` of the same row stay beside it."""
        sales = self.panel() if sales is None else sales
        past = Window.partitionBy("store_nbr", "family").orderBy("date").rowsBetween(-7, -1)
        scored = sales.withColumns(
            {"predicted_sales": F.avg("sales").over(past), "spread": F.stddev_samp("sales").over(past)}
        ).where(F.col("predicted_sales").isNotNull())
        stores = self.stores().select(F.col("id").alias("store_id"), "store_nbr")
        families = self.families().select(
            F.col("id").alias("family_id"), F.col("name").alias("family")
        )
        keyed = scored.join(stores, "store_nbr").join(families, "family")
        band = 1.96 * F.coalesce(F.col("spread"), F.lit(0.0))
        return keyed.select(
            prediction_id(F.col("store_nbr"), F.col("family"), F.col("date")).alias("id"),
            "store_id",
            "family_id",
            F.date_sub("date", 1).alias("prediction_date"),
            F.col("date").alias("target_date"),
            "onpromotion",
            "predicted_sales",
            (F.col("predicted_sales") - band).alias("prediction_interval_lower"),
            (F.col("predicted_sales") + band).alias("prediction_interval_upper"),
            F.year("date").cast("string").alias("model_version"),
            F.date_sub("date", 1).alias("created_at"),
            "store_nbr",
            "family",
            F.col("sales").alias("actual"),
        )

    def predictions(self, sales: DataFrame | None = None) -> DataFrame:
        """The forecasts as a table of predictions, without what became of them."""
        return self.forecasts(sales).drop("store_nbr", "family", "actual")

    def event_panel(self) -> DataFrame:
        """(store_nbr, family, date, sales) from the event table: a short, nearly dense panel."""
        return (
            self.raw("events")
            .groupBy(
                (F.col("user_id") % 10).cast("int").alias("store_nbr"),
                F.col("event_type").alias("family"),
                F.col("ts").cast("date").alias("date"),
            )
            .agg(F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("sales"))
        )

    # --- stored model tables ------------------------------------------------------------------

    def pairs(self) -> DataFrame:
        """Forecasts with their actuals, which come from the row of the forecast itself; predictions
        from elsewhere are joined by ``evaluate.pair``."""
        made = self.forecasts().drop("store_nbr", "family")
        return made.withColumnRenamed("predicted_sales", "predicted")

    def model_metrics(self) -> DataFrame:
        """Metrics per model version and month, one row per metric; a stored table."""
        return self._store("model_metrics", self._model_metrics)

    def _model_metrics(self) -> DataFrame:
        monthly = self.pairs().withColumn("timestamp", F.trunc("target_date", "month"))
        wide = evaluate.model_metrics(monthly, ["model_version", "timestamp"])
        long = wide.unpivot(
            ["model_version", "timestamp"], ["rmse", "mae", "mape", "r2"], "metric_name", "metric_value"
        )
        return long.withColumn("model_name", F.lit(MODEL))

    def model_drift(self) -> DataFrame:
        """Daily RMSE and MAE per model version against 1.1 times the version's own level; a
        stored table."""
        return self._store("model_drift", self._model_drift)

    def _model_drift(self) -> DataFrame:
        gap = F.col("predicted") - F.col("actual")
        daily = self.pairs().groupBy("model_version", F.col("target_date").alias("timestamp")).agg(
            F.sum(gap * gap).alias("sse"), F.sum(F.abs(gap)).alias("sae"), F.count(gap).alias("n")
        )
        version = Window.partitionBy("model_version")  # one row per day of the version's year
        total = {c: F.sum(c).over(version) for c in ("sse", "sae", "n")}

        def entry(name: str, value: Column, level: Column) -> Column:
            return F.struct(
                F.lit(name).alias("drift_metric"),
                value.alias("drift_value"),
                (level * 1.1).alias("threshold"),
            )

        n = F.col("n")
        both = F.array(
            entry("rmse", F.sqrt(F.col("sse") / n), F.sqrt(total["sse"] / total["n"])),
            entry("mae", F.col("sae") / n, total["sae"] / total["n"]),
        )
        rows = daily.withColumn("both", both).select("model_version", "timestamp", F.inline_outer("both"))
        return rows.withColumns(
            {
                "model_name": F.lit(MODEL),
                "exceeded_threshold": F.col("drift_value") > F.col("threshold"),
            }
        )

    def feature_importance(self) -> DataFrame:
        """Absolute correlation with sales per model version and quarter; a stored table."""
        return self._store("feature_importance", self._feature_importance)

    def _feature_importance(self) -> DataFrame:
        day = F.col("date")
        dated = self.sales().select(
            F.year(day).cast("string").alias("model_version"),
            F.trunc(day, "quarter").alias("timestamp"),
            "sales",
            "onpromotion",
            "store_nbr",
            F.weekday(day).alias("day_of_week"),
            F.month(day).alias("month"),
        )
        names = ["onpromotion", "store_nbr", "day_of_week", "month"]
        wide = dated.groupBy("model_version", "timestamp").agg(
            *[F.abs(correlation(F.col(c).cast("double"), F.col("sales"))).alias(c) for c in names]
        )
        long = wide.unpivot(["model_version", "timestamp"], names, "feature_name", "importance_value")
        return long.where("importance_value is not null").withColumn("model_name", F.lit(MODEL))
