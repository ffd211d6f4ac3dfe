"""Maps, explanations, alert documents and the feature registry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.operators import explain, registry, report
from shelfcast.operators import features as B
from shelfcast.plans.catalog.base import query, rd, rounded
from shelfcast.plans.catalog.lookups import IMPORTANCE_SQL
from shelfcast.plans.catalog.scalars import FOOD, FOOD_SQL
from shelfcast.plans.catalog.scans import ALERTS_SQL, alert_documents
from shelfcast.session import fresh_path
from shelfcast.sources.retail import MODEL, Retail


@query(
    "nst_feature_values",
    f"SELECT id, {rd('onpromotion')} AS onpromotion, {rd('month(target_date)')} AS month, "
    f"{rd('store_id')} AS store FROM t_pred",
)
def _(r: Retail) -> DataFrame:
    """A map of features stored with each forecast, written as JSON text and parsed again."""
    pairs = {
        "onpromotion": F.col("onpromotion"), "month": F.month("target_date"), "store": F.col("store_id"),
    }
    packed = F.create_map(*[x for k, v in pairs.items() for x in (F.lit(k), v.cast("double"))])
    stored = r.predictions().select("id", F.to_json(packed).alias("doc"))
    parsed = stored.select("id", F.from_json("doc", "map<string,double>").alias("m"))
    return rounded(parsed.select("id", *[F.col("m")[k].alias(k) for k in pairs]))


def _forecasts(r: Retail) -> DataFrame:
    """Forecasts under food-family names with the flag of national holidays."""
    made = r.forecasts().withColumnRenamed("target_date", "date").replace(FOOD, subset=["family"])
    joined = made.select("id", "store_nbr", "family", "date", "predicted_sales", "onpromotion")
    return B.flag_dates(joined, B.active_holidays(r.holidays(), "National"))


FORECAST_SQL = f"""
SELECT store_nbr || '-' || family || '-' || strftime(date, '%Y-%m-%d') AS id, store_nbr, {FOOD_SQL} AS family,
       date, onpromotion, predicted_sales AS p,
       CAST(date IN (SELECT date FROM t_active WHERE locale = 'National') AS INTEGER) AS is_holiday
FROM t_scored WHERE predicted_sales IS NOT NULL"""


def _weights_sql(store, family: str, promo, dow, month, scale: str = "p * ") -> dict[str, str]:
    def times(case: str) -> str:
        return f"CAST({case} AS DOUBLE)"

    d, m = "isodow(date)", "month(date)"
    return {
        "'store_' || store_nbr": times(
            f"CASE WHEN store_nbr < 10 THEN {store[0]} WHEN store_nbr < 30 THEN {store[1]} ELSE {store[2]} END"
        ),
        "'family_' || family": times(family),
        "'onpromotion'": times(f"CASE WHEN onpromotion > 0 THEN {promo[0]} ELSE {promo[1]} END"),
        "'dayofweek'": times(f"CASE WHEN {d} >= 6 THEN {dow[0]} WHEN {d} = 5 THEN {dow[1]} ELSE {dow[2]} END"),
        "'month'": times(
            f"CASE WHEN {m} IN (11, 12) THEN {month[0]} WHEN {m} IN (1, 2) THEN {month[1]} "
            f"WHEN {m} IN (7, 8) THEN {month[2]} ELSE {month[3]} END"
        ),
    }


SCALED_WEIGHTS = {
    **_weights_sql(
        (0.15, -0.02, -0.12),
        "CASE WHEN contains(family, 'PRODUCE') THEN 0.18 WHEN contains(family, 'GROCERY') THEN 0.15 "
        "WHEN contains(family, 'BREAD') THEN 0.12 ELSE 0.10 END",
        (0.15, -0.08), (0.08, 0.03, -0.03), (0.12, -0.06, 0.04, -0.02),
    ),
    "'holiday'": "CAST(CASE WHEN is_holiday > 0 THEN 0.07 ELSE -0.05 END AS DOUBLE)",
}

EXPLAIN_SQL = f"""
SELECT id, p, unnest([{', '.join(SCALED_WEIGHTS)}]) AS feature,
       unnest([{', '.join(f'round(c{i} * scale, 2)' for i in range(6))}]) AS contribution
FROM (SELECT *, coalesce((p - p * 0.6::DOUBLE) / nullif(round({' + '.join(f'c{i}' for i in range(6))}, 2), 0), 1) AS scale
      FROM (SELECT *, {', '.join(f'round(p * {w}, 2) AS c{i}' for i, w in enumerate(SCALED_WEIGHTS.values()))}
            FROM ({FORECAST_SQL})))"""


@query(
    "nst_explanation",
    f"SELECT id, {rd('round(p * 0.6::DOUBLE, 2)', 2)} AS base_value, feature, {rd('contribution', 2)} AS contribution "
    f"FROM ({EXPLAIN_SQL})",
)
def _(r: Retail) -> DataFrame:
    explained = explain.explain(_forecasts(r))
    rows = explained.select("id", "base_value", F.inline_outer("feature_contributions"))
    return rounded(rows.drop("value"), digits=2)


UNSCALED_WEIGHTS = {
    **_weights_sql(
        (1.2, -0.2, -1.2),
        "CASE WHEN contains(family, 'PRODUCE') THEN 1.8 WHEN contains(family, 'GROCERY') THEN 1.5 "
        "WHEN contains(family, 'BREAD') THEN 1.2 ELSE 1.0 END",
        (1.5, -0.8), (0.8, 0.3, -0.3), (1.2, -0.6, 0.4, -0.2),
    ),
    "'quarter'": "CAST(-0.08 AS DOUBLE)",
}


@query(
    "nst_explanation_unscaled",
    f"SELECT id, unnest([{', '.join(UNSCALED_WEIGHTS)}]) AS feature, "
    f"unnest([{', '.join(UNSCALED_WEIGHTS.values())}]) AS contribution FROM ({FORECAST_SQL})",
)
def _(r: Retail) -> DataFrame:
    explained = explain.explain_unscaled(_forecasts(r))
    return explained.select("id", F.inline_outer("feature_contributions")).drop("value")


@query(
    "nst_contrib_summary",
    f"SELECT feature, {rd('avg(abs(contribution))')} AS mean_abs_contribution, count(*) AS n "
    f"FROM ({EXPLAIN_SQL}) GROUP BY 1",
)
def _(r: Retail) -> DataFrame:
    return rounded(explain.contribution_summary(explain.explain(_forecasts(r))))


@query(
    "nst_contrib_relative",
    f"SELECT id, feature, {rd('coalesce(abs(contribution) / nullif(max(abs(contribution)) OVER (PARTITION BY id), 0), 0)')} "
    f"AS relative FROM ({EXPLAIN_SQL})",
)
def _(r: Retail) -> DataFrame:
    explained = explain.explain(_forecasts(r))
    sizes = explain.relative_sizes(F.col("feature_contributions"))
    return rounded(explained.select("id", F.inline_outer(sizes)))


NEWEST_IMPORTANCE_SQL = f"SELECT feature_name, importance_value FROM ({IMPORTANCE_SQL}) WHERE model_version = '2000'"


@query(
    "nst_importance_contrib",
    f"""SELECT id, feature_name AS feature, CAST(position AS INTEGER) AS position,
  {rd('(predicted_sales - predicted_sales * 0.6) * share')} AS contribution
FROM t_pred, (SELECT feature_name, importance_value / sum(importance_value) OVER () AS share,
  row_number() OVER (ORDER BY importance_value DESC, feature_name) AS position FROM ({NEWEST_IMPORTANCE_SQL}))
WHERE position <= 10""",
)
def _(r: Retail) -> DataFrame:
    importance = report.latest_importance(r.feature_importance(), MODEL, "2000")
    predictions = r.predictions().select("id", "predicted_sales")
    made = explain.importance_contributions(predictions, importance)
    return rounded(made.drop("predicted_sales"))


FALLBACK_FEATURES = ["onpromotion", "store_nbr", "day_of_week", "month"]


@query(
    "nst_fallback_contrib",
    f"""SELECT id, feature, {rd('(predicted_sales - predicted_sales * 0.6) * w / sum(w) OVER (PARTITION BY id)')} AS contribution
FROM t_pred, (VALUES ('onpromotion', 0.3::DOUBLE), ('store_nbr', 0.3 - 0.25::DOUBLE / 3),
  ('day_of_week', 0.3 - 0.5::DOUBLE / 3), ('month', 0.05::DOUBLE)) AS f(feature, w)""",
)
def _(r: Retail) -> DataFrame:
    """Linearly falling weights, for a model that has no importances."""
    made = explain.fallback_contributions(r.predictions().select("id", "predicted_sales"), FALLBACK_FEATURES)
    return rounded(made.select("id", F.inline("feature_contributions")))


@query(
    "nst_alert_payload",
    f"SELECT day AS timestamp, {rd('score')} AS score, score > 0.5 AS severe FROM ({ALERTS_SQL})",
)
def _(r: Retail) -> DataFrame:
    """A field inside the nested payload."""
    score = F.col("data.overall_drift_score")
    return rounded(alert_documents(r).select("timestamp", score.alias("score"), (score > 0.5).alias("severe")))


@query(
    "nst_feature_registry",
    """SELECT entity, CAST(count(*) AS BIGINT) AS features, string_agg(name, ',' ORDER BY name) AS names FROM (
  SELECT CASE WHEN family IN ('PROMO', 'SMALL') THEN 'product' ELSE 'product_store' END AS entity,
         family || '_share' AS name FROM (SELECT DISTINCT family FROM t_sales)) GROUP BY 1""",
)
def _(r: Retail) -> DataFrame:
    """One feature per family of the panel, listed by entity type through a registry table."""
    entity = F.when(F.col("family").isin("PROMO", "SMALL"), "product").otherwise("product_store")
    known = r.sales().select("family").distinct()
    table = known.select(
        F.concat("family", F.lit("_share")).alias("name"), entity.alias("entity_type"),
        F.array(F.lit("sales")).alias("dependencies"),
    )
    path = fresh_path(r.spark, "registry")
    table.write.parquet(path)
    stored = r.spark.read.parquet(path)
    groups = stored.groupBy(F.col("entity_type").alias("entity")).agg(
        F.array_sort(F.collect_list("name")).alias("features")
    )
    listed = registry.make_groups(groups, registry.list_features(stored))
    return listed.select(
        "entity", F.size("features").cast("bigint").alias("features"), F.array_join("features", ",").alias("names")
    )


@query(
    "nst_dependency_order",
    f"""SELECT store_nbr, family, date, CAST(isodow(date) - 1 AS INTEGER) AS day_of_week,
  CAST(isodow(date) >= 6 AS INTEGER) AS is_weekend, {rd('CASE WHEN isodow(date) >= 6 THEN sales ELSE 0 END')} AS weekend_sales
FROM t_sales""",
)
def _(r: Retail) -> DataFrame:
    """Features applied in the order their dependencies ask for."""
    rules = {
        "weekend_sales": (("is_weekend",), lambda: F.col("sales") * F.col("is_weekend")),
        "is_weekend": (("day_of_week",), lambda: (F.col("day_of_week") >= 5).cast("int")),
        "day_of_week": ((), lambda: F.weekday("date")),
    }
    out = r.sales()
    for name in registry.dependency_order({k: needs for k, (needs, _) in rules.items()}):
        out = out.withColumn(name, rules[name][1]())
    return rounded(out.drop("sales", "onpromotion"), "weekend_sales")
