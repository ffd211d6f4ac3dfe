"""Hand-made cases for the decisions and edges of the operators."""

import datetime as dt
import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfcast.functions import calendar as C
from shelfcast.functions import numeric as N
from shelfcast.functions import text as X
from shelfcast.operators import decompose, distribution, evaluate, explain, features, monitor, ordered
from shelfcast.operators import registry, report
from shelfcast.operators import windows as V
from shelfcast.sources import sinks, tables
from shelfcast.spec import PanelSpec


def day(n):
    return dt.date(2020, 1, 1) + dt.timedelta(days=n)


def series(spark, values, store=1, family="A"):
    rows = [(store, family, day(i), float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "store_nbr int, family string, date date, sales double")


def column(df, name, order="date"):
    return [r[name] for r in df.orderBy(order).collect()]


# --- scalars --------------------------------------------------------------------------------------


def test_date_parts_of_one_day(spark):
    d = F.lit(dt.date(2025, 5, 10))
    parts = {**C.date_parts(d), "doy": C.day_of_year(d)}
    row = spark.range(1).select(*[c.alias(n) for n, c in parts.items()]).first()
    assert (row.year, row.month, row.day_of_month, row.day_of_week) == (2025, 5, 10, 5)
    assert (row.doy, row.quarter, row.is_weekend) == (130, 2, 1)


def test_unreadable_date_is_null(spark):
    df = spark.createDataFrame([("invalid-date",), ("2025-05-10",)], "t string")
    assert [r[0] for r in df.select(C.parse_date(F.col("t"))).collect()] == [None, dt.date(2025, 5, 10)]


def vector(spark, store, family, promo, date=dt.date(2025, 5, 10)):
    df = spark.createDataFrame([(store, family, promo, date)], "s int, f string, p boolean, d date")
    return df.select(features.feature_vector(*[F.col(c) for c in "sfpd"])).first()[0]


def test_vector_slots(spark):
    names = features.vector_names()
    known = vector(spark, 12, "GROCERY I", True)
    assert len(known) == len(names) == 81
    hot = {n for n, v in zip(names, known) if v and n.startswith(("store_", "family_"))}
    assert hot == {"store_12", "family_GROCERY I"} and known[0] == 1.0
    unknown = vector(spark, 9999, "INVALID", False)
    assert sum(unknown[8:]) == 0 and unknown[0] == 0.0
    assert sum(vector(spark, 1, "DAIRY", True, None)) == 0


def test_inventory_advice(spark):
    advice = N.inventory_advice(F.col("p"), F.col("f"))
    df = spark.createDataFrame([(10.0, "GROCERY I")], "p double, f string")
    row = df.select(*[c.alias(n) for n, c in advice.items()]).first()
    assert (row.low_threshold, row.inventory_action) == (12.0, "reducing")
    assert (row.order_quantity, row.potential_savings, row.orders_per_week) == (50.0, 1.5, 3)


def test_sanitise(spark):
    text = [("user:hi",), ("user: hi",), (None,), ("x" * 300,), ("<USER>a",), ("system:é",)]
    df = spark.createDataFrame(text, "t string")
    out = [r[0] for r in df.select(X.sanitise(F.col("t"))).collect()]
    assert out[0] == " hi" and out[1] == "user: hi" and out[2] == "" and len(out[3]) == 256
    # a token needs a word character on its outer side to be a word boundary
    assert out[4] == "<USER>a" and out[5] == " é"
    loose = [r[0] for r in df.select(X.sanitise(F.col("t"), pattern=X.ROLE_TOKENS_LOOSE)).collect()]
    assert loose[1] == "  hi"


def test_family_names(spark):
    df = spark.createDataFrame([(" home and kitchen ",), ("nothing",), (None,)], "f string")
    known = ["HOME AND GARDEN", "PRODUCE"]
    out = [r[0] for r in df.select(X.normalise_family(F.col("f"), known)).collect()]
    assert out == ["HOME AND GARDEN", "PRODUCE", "PRODUCE"]


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (-3.0,), (9.0,)], "x double")
    assert [r[0] for r in df.select(N.clip(F.col("x"), 0, 5)).collect()] == [None, 0.0, 5.0]


# --- windows --------------------------------------------------------------------------------------


def test_rolling_on_one_row(spark):
    row = series(spark, [5]).withColumns(V.rolling("sales", (7,))).first()
    assert row.sales_roll_7_mean == 5.0 and row.sales_roll_7_std is None


def test_min_periods_and_past_only(spark):
    df = series(spark, [1, 2, 3])
    assert column(df.withColumns(V.rolling("sales", (3,), ("mean",), min_periods=2)), "sales_roll_3_mean") == [
        None, 1.5, 2.0,
    ]
    past = df.withColumns(V.rolling("sales", (3,), ("mean",), exclude_current=True))
    assert column(past, "sales_roll_3_mean") == [None, 1.0, 1.5]


def test_naive_baseline_warm_up(spark):
    assert column(series(spark, [1, 2, 3]).withColumn("b", V.naive_baseline("sales")), "b") == [1.0, 1.5, 2.0]


def test_promotion_distances(spark):
    df = series(spark, [1] * 5).withColumn("onpromotion", F.dayofmonth("date").isin(2, 4).cast("int"))
    made = V.with_promo_distances(df)
    assert column(made, "days_since_promo") == [None, 0, 1, 0, 1]
    assert column(made, "days_to_promo") == [1, 0, 1, 0, None]


def test_decomposition_against_plain_python(spark):
    values = [10 + 0.5 * i + [3, -1, 0, 2, -4, 1, -1][i % 7] + (i * 37 % 11) / 10 for i in range(30)]
    for p in (7, 4):
        made = decompose.seasonal_decompose(series(spark, values), PanelSpec(), {"x": p}).orderBy("date").collect()
        n, h = len(values), p // 2
        trend = [None] * n
        for i in range(h, n - h):
            w = values[i - h : i + h + 1]
            trend[i] = sum(w) / p if p % 2 else (sum(w) - (w[0] + w[-1]) / 2) / p
        first, last = h, n - h - 1
        for i in range(first):
            trend[i] = trend[first] + (trend[first + 1] - trend[first]) * (i - first)
        for i in range(last + 1, n):
            trend[i] = trend[last - 2] + (trend[last - 1] - trend[last - 2]) * (i - last + 2)
        rest = [v - t for v, t in zip(values, trend)]
        means = [sum(rest[k::p]) / len(rest[k::p]) for k in range(p)]
        centre = sum(means) / p
        for i, row in enumerate(made):
            assert math.isclose(row.sales_x_trend, trend[i], abs_tol=1e-9)
            assert math.isclose(row.sales_x_seasonal, means[i % p] - centre, abs_tol=1e-9)
            total = row.sales_x_trend + row.sales_x_seasonal + row.sales_x_resid
            assert math.isclose(total, values[i], abs_tol=1e-9)


def test_short_series_is_not_decomposed(spark):
    row = decompose.seasonal_decompose(series(spark, range(13)), periods={"weekly": 7}).first()
    assert row.sales_weekly_trend is None and row.sales_weekly_resid is None


def test_seasonal_features_fill_from_both_sides(spark):
    df = series(spark, range(4)).withColumn("x", F.when(F.col("sales").isin(1.0, 2.0), F.col("sales")))
    filled = df.withColumn("y", V.fill_gaps("x", PanelSpec().series()))
    assert column(filled, "y") == [1.0, 1.0, 2.0, 2.0]


# --- order-dependent work on hot groups -----------------------------------------------------------


@pytest.fixture(scope="module")
def hot(spark):
    """One key holds most rows, many rows share one moment."""
    key = F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7))
    moment = F.when(F.col("id") % 3 == 0, F.lit(500)).otherwise(F.col("id") * 7919 % 1000)
    value = (F.col("id") * 31 % 97).cast("double")
    return spark.range(4000).select("id", key.alias("k"), moment.alias("t"), value.alias("v"))


def test_index_equals_row_number(spark, hot):
    made = ordered.ordered_index(hot, ["k"], ["t", "id"], "i", ranges=16)
    plain = F.row_number().over(Window.partitionBy("k").orderBy("t", "id"))
    wrong = made.withColumn("r", plain).where("i <> r")
    assert made.count() == 4000 and wrong.count() == 0


def test_global_index(spark, hot):
    got = [r.i for r in ordered.ordered_index(hot, [], ["t", "id"], "i", ranges=9).orderBy("t", "id").collect()]
    assert got == list(range(1, 4001))


@pytest.mark.parametrize("ranges", [1, 2, 5, 64])
def test_ranges_never_change_results(spark, hot, ranges):
    df = hot.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    made = ordered.running_totals(df, ["k"], ["v"], {"c": F.col("n")}, ranges=ranges)
    plain = F.sum("n").over(Window.partitionBy("k").orderBy("v"))
    assert made.withColumn("p", plain).where("c <> p").count() == 0


def test_sliced_window_equals_plain_window(spark, hot):
    def exprs(w):
        return {"lag": F.lag("v", 5).over(w), "avg": F.avg("v").over(w.rowsBetween(-6, 0))}

    made = ordered.sliced_window(hot, ["k"], ["t", "id"], exprs, reach=6, slice_rows=50)
    w = Window.partitionBy("k").orderBy("t", "id")
    both = made.withColumns({"lag2": F.lag("v", 5).over(w), "avg2": F.avg("v").over(w.rowsBetween(-6, 0))})
    assert made.count() == 4000
    assert both.where("not (lag <=> lag2) or abs(avg - avg2) > 1e-9").count() == 0


def test_quantiles_equal_percentile(spark, hot):
    made = distribution.quantiles(hot, ["k"], "v", {"q": 0.37, "lo": 0.0, "hi": 1.0})
    plain = hot.groupBy("k").agg(F.percentile("v", F.lit(0.37)).alias("p"), F.min("v").alias("a"), F.max("v").alias("b"))
    joined = made.join(plain, "k")
    assert joined.count() == made.count()
    assert joined.where("abs(q - p) > 1e-9 or lo <> a or hi <> b").count() == 0


def test_codes_are_sorted_and_unseen_is_minus_one(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",)], "x string")
    rows = {r.x: r.x_code for r in features.category_codes(df, ["x"]).collect()}
    assert rows == {"a": 0, "b": 1, "c": 2, None: -1}


# --- joins and encodings --------------------------------------------------------------------------


def holidays(spark, *rows):
    return spark.createDataFrame(
        [(d, "Holiday", loc, "x", moved) for d, loc, moved in rows],
        "date date, type string, locale string, description string, transferred boolean",
    )


def test_two_holidays_on_one_date_keep_one_row(spark):
    h = holidays(spark, (day(1), "National", False), (day(1), "National", False), (day(2), "Local", True))
    out = features.join_holiday_flags(series(spark, [1, 2, 3]), h)
    assert column(out, "is_national_holiday") == [0, 1, 0]
    assert column(out, "is_local_holiday") == [0, 0, 0]


def test_holiday_distance(spark):
    h = holidays(spark, (day(2), "National", False))
    out = features.join_holiday_distances(series(spark, [1] * 5), h)
    assert column(out, "days_to_next_holiday") == [2, 1, 0, None, None]
    assert column(out, "days_since_last_holiday") == [None, None, 0, 1, 2]


def test_oil_is_as_of_then_earliest(spark):
    oil = spark.createDataFrame([(day(1), 10.0), (day(3), None), (day(4), 20.0)], "date date, dcoilwtico double")
    out = features.join_oil(series(spark, [1] * 6), oil)
    assert column(out, "dcoilwtico") == [10.0, 10.0, 10.0, 10.0, 20.0, 20.0]


def test_unseen_category_gets_the_overall_mean(spark):
    train = series(spark, [2, 4], family="A").unionByName(series(spark, [9], family="B"))
    new = series(spark, [0], family="Z")
    row = features.target_encode(new, ["family"], train=train, with_count=True).first()
    assert row.family_sales_mean == 5.0 and row.family_count == 0


def test_one_hot_unknown_is_all_zero(spark):
    fitted = features.fit_categories(series(spark, [1], family="A").unionByName(series(spark, [1], family="B")), ["family"], most=9)
    row = features.one_hot(series(spark, [1], family="Z"), fitted).first()
    assert "family" not in row and (row.family_A, row.family_B) == (0, 0)


def test_constant_column_scales_to_zero(spark):
    df = series(spark, [3, 3])
    assert column(features.apply_scaler(df, features.fit_scaler(df, ["sales"]), ["sales"]), "sales") == [0.0, 0.0]


def test_cold_start_levels(spark):
    history = series(spark, [4, 6], 3, "A")
    asked = spark.createDataFrame([(3, "A"), (3, "DAIRY"), (3, "AB")], "store_nbr int, family string")
    rows = {r.family: r.predicted_sales for r in features.cold_start(asked, history).collect()}
    assert rows["A"] == 5.0
    assert math.isclose(rows["DAIRY"], 28.5 * (0.5 + 3 * 0.15))
    assert math.isclose(rows["AB"], 15 + (ord("A") + ord("B")) % 100 / 100 * 40)


def test_densify(spark):
    df = series(spark, [1, 2, 3]).where("sales <> 2")
    assert column(features.densify(df), "sales") == [1.0, 0.0, 3.0]


# --- accuracy -------------------------------------------------------------------------------------


def pairs(spark, *rows):
    return spark.createDataFrame([(float(a), float(p)) for a, p in rows], "actual double, predicted double")


def test_mape_leaves_out_zero_actuals(spark):
    assert evaluate.evaluation_metrics(pairs(spark, (0, 5), (10, 8))).first().mape == 20.0
    assert evaluate.evaluation_metrics(pairs(spark, (0, 5))).first().mape is None


def test_accuracy_floor_and_seeded_error(spark):
    assert evaluate.accuracy_summary(pairs(spark, (1, 5))).first().forecast_accuracy == 0.0
    seeded = [(a, a * (1.2 if a % 2 else 0.8)) for a in range(10, 60)]
    assert math.isclose(evaluate.accuracy_summary(pairs(spark, *seeded)).first().forecast_accuracy, 80.0)


def test_r2_is_not_squared_correlation(spark):
    row = evaluate.model_metrics(pairs(spark, (1, 2), (2, 4), (3, 6))).first()
    assert math.isclose(row.r2, 1 - (1 + 4 + 9) / 2)


def test_growth_without_history(spark):
    as_of = spark.createDataFrame([(day(1),)], "as_of date")
    assert report.growth(series(spark, [5]), "family", 30, as_of).first().growth == 0.1


def test_bias_keeps_null_groups(spark):
    df = pairs(spark, (10, 12), (10, 10)).withColumn("g", F.when(F.col("predicted") > 11, "x"))
    rows = {r.g: r.flag for r in evaluate.bias_drift(df, ["g"]).collect()}
    assert rows == {"x": 1, None: 0}


# --- monitoring -----------------------------------------------------------------------------------


def letters(spark, **counts):
    return spark.createDataFrame([(k,) for k, n in counts.items() for _ in range(n)], "c string")


def test_categorical_drift(spark):
    base = monitor.profile_categorical(letters(spark, a=5, b=5))
    row = monitor.categorical_drift(base, letters(spark, a=9, c=1), ["c"]).first()
    assert math.isclose(row.js_divergence, 0.45) and row.drift_detected
    full = monitor.categorical_drift(base, letters(spark, a=9, c=1), ["c"], new_categories=True).first()
    assert math.isclose(full.js_divergence, 0.5)


def test_ks_of_identical_samples(spark):
    df = series(spark, range(50))
    row = monitor.numeric_drift(monitor.profile_numeric(df, ["sales"]), monitor.value_counts(df), df, ["sales"]).first()
    assert row.ks_statistic == 0 and row.p_value == 1.0 and not row.drift_detected


def test_ks_of_disjoint_samples(spark):
    old, new = series(spark, range(50)), series(spark, range(100, 150))
    row = monitor.numeric_drift(monitor.profile_numeric(old, ["sales"]), monitor.value_counts(old, ["sales"]), new, ["sales"]).first()
    assert row.ks_statistic == 1.0 and row.p_value < 1e-6 and row.drift_detected


def metric(spark, value):
    return spark.createDataFrame([("rmse", float(value))], "metric_name string, metric_value double")


@pytest.mark.parametrize("now, degraded", [(111, True), (80, False), (105, False)])
def test_performance_drift(spark, now, degraded):
    assert monitor.performance_drift(metric(spark, 100), metric(spark, now)).first().degraded is degraded


def alerts(spark, *rows):
    made = spark.createDataFrame(rows, "timestamp string, type string, score double")
    return made.select("timestamp", "type", F.struct(F.col("score").alias("overall_drift_score")).alias("data"))


@pytest.mark.parametrize(
    "rows, needed, reason",
    [
        ([("2024-01-09", "data_drift", 0.6)], True, "Severe data drift detected: 0.60"),
        ([("2024-01-09", "data_drift", 0.4)], False, "No significant issues detected"),
        ([("2024-01-09", "performance_drift", None)], True, "Performance degradation detected"),
        ([("2023-12-01", "data_drift", 0.9)], False, "No alerts detected recently"),
        ([("2024-01-08", "data_drift", 0.9), ("2024-01-09", "data_drift", 0.2)], False, "No significant issues detected"),
    ],
)
def test_retrain_decision(spark, rows, needed, reason):
    row = monitor.retrain_decision(alerts(spark, *rows), F.lit("2024-01-10").cast("timestamp")).first()
    assert (row.needs_retraining, row.reason) == (needed, reason)


@pytest.mark.parametrize("threshold, status", [(0.6, "DRIFT"), (0.75, "CRITICAL")])
def test_trend_status(spark, threshold, status):
    rows = [(day(0), 0.9), (day(1), 0.9), (day(2), 0.7)]
    df = spark.createDataFrame(rows, "date date, accuracy double")
    assert monitor.trend_status(df, threshold).first().status == status


def test_digest_ignores_order_and_sees_changes(spark):
    df = series(spark, range(100))
    cols = [F.col("store_nbr"), F.col("sales")]
    one = monitor.content_digest(df, F.lit("d"), cols).first().digest
    assert one == monitor.content_digest(df.repartition(7).orderBy(F.desc("date")), F.lit("d"), cols).first().digest
    changed = df.withColumn("sales", F.when(F.col("sales") == 7, 7.5).otherwise(F.col("sales")))
    assert one != monitor.content_digest(changed, F.lit("d"), cols).first().digest


# --- explanations and registry --------------------------------------------------------------------


def test_contributions_add_up(spark):
    df = series(spark, [50], 3, "PRODUCE").withColumns(
        {"predicted_sales": F.lit(50.0), "onpromotion": F.lit(1), "is_holiday": F.lit(0)}
    )
    row = explain.explain(df).first()
    total = sum(c.contribution for c in row.feature_contributions)
    assert abs(total - (50.0 - row.base_value)) < 0.05
    sizes = [abs(c.contribution) for c in row.feature_contributions]
    assert sizes == sorted(sizes, reverse=True)


def test_fallback_weights_sum_to_one():
    weights = explain.fallback_weights(20)
    assert len(weights) == 10 and math.isclose(sum(weights), 1.0) and weights[0] > weights[-1]


def test_dependency_order():
    assert registry.dependency_order({"a": ["b"], "b": ["c"], "c": []}) == ["c", "b", "a"]
    with pytest.raises(ValueError, match="unknown"):
        registry.dependency_order({"a": ["z"]})
    with pytest.raises(ValueError, match="cycle"):
        registry.dependency_order({"a": ["b"], "b": ["a"]})


def test_registry_parameters_survive_storage(spark, tmp_path):
    df = series(spark, [1, 3], family="A").unionByName(series(spark, [5], family="B"))
    made = (registry.Feature("family", transformation="one_hot"), registry.Feature("sales", transformation="standardize"))
    fitted = registry.fit(df, made)
    registry.save_parameters(fitted, spark, str(tmp_path))
    again = registry.load_parameters(spark, str(tmp_path), ["sales"])
    left = registry.apply(df, fitted).orderBy("date", "sales").collect()
    assert left == registry.apply(df, again).orderBy("date", "sales").collect()
    with pytest.raises(ValueError, match="not in the table"):
        registry.fit(df, [registry.Feature("absent")])


# --- tables ---------------------------------------------------------------------------------------


def test_missing_tables_are_skipped(spark, tmp_path, caplog):
    (tmp_path / "oil.csv").write_text("date,dcoilwtico\n2020-01-01,50.5\n2020-01-02,\n")
    found = tables.load_tables(spark, str(tmp_path))
    assert list(found) == ["oil"] and "stores" in caplog.text
    assert [r.dcoilwtico for r in found["oil"].orderBy("date").collect()] == [50.5, None]


def test_new_dimension_rows_continue_the_ids(spark):
    dim = spark.createDataFrame([(1, "a"), (4, "b")], "id int, name string")
    names = spark.createDataFrame([("b",), ("z",), ("c",), ("c",)], "name string")
    assert {r.name: r.id for r in sinks.get_or_create(dim, names).collect()} == {"a": 1, "b": 4, "c": 5, "z": 6}


def test_newest_per_key(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], "k int, x string, v int")
    assert {r.k: r.x for r in sinks.newest_per_key(df, ["k"], "v").collect()} == {1: "b", 2: "c"}


def groups_with_null(spark):
    rows = [(g, i, float(v)) for g in ("a", None) for i, v in enumerate((1, 10, 5))]
    return spark.createDataFrame(rows, "g string, i int, v double")


def test_null_groups_are_kept(spark):
    df = groups_with_null(spark)
    medians = distribution.quantiles(df, ["g"], "v", {"median": 0.5}).collect()
    assert {r.g: r["median"] for r in medians} == {"a": 5.0, None: 5.0}
    numbered = ordered.ordered_index(df, ["g"], ["i"], "n").collect()
    assert sorted((r.g or "", r.i, r.n, r.n_total) for r in numbered) == [
        (g, i, i + 1, 3) for g in ("", "a") for i in range(3)
    ]
    def sums(window):
        return {"two": F.sum("v").over(window.rowsBetween(-1, 0))}
    sliced = ordered.sliced_window(df, ["g"], ["i"], sums, reach=1, slice_rows=2).collect()
    assert sorted((r.g or "", r.i, r.two) for r in sliced) == [
        (g, i, t) for g in ("", "a") for i, t in enumerate((1.0, 11.0, 15.0))
    ]


def test_ranges_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(ordered, "RANGE_ROWS", 10)
    assert ordered.range_count(spark.range(1000)) == 100
    numbered = ordered.ordered_index(spark.range(1000).toDF("i"), [], ["i"], "n")
    assert numbered.where("n != i + 1").count() == 0


def test_upsert_keeps_one_row_per_key(spark):
    old = spark.createDataFrame([(1, "o", 0), (2, "o", 0), (None, "o", 0)], "k int, x string, v int")
    new = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (None, "n", 1), (3, "c", 1)], "k int, x string, v int")
    merged = sinks.upsert(old, new, ["k"], "v").collect()
    assert sorted((r.k or 0, r.x) for r in merged) == [(0, "n"), (1, "b"), (2, "o"), (3, "c")]


def test_merge_moves_rows_between_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    shape = "k int, x string, v int, p int"
    rows = [(1, "o", 0, 1), (2, "o", 0, 2), (3, "o", 0, 3)]
    spark.createDataFrame(rows, shape).write.partitionBy("p").parquet(path)
    batch = spark.createDataFrame([(1, "n", 1, 2), (1, "late", 2, 2)], shape)
    sinks.merge_into_partitions(path, batch, ["k"], ["p"], "v")
    found = spark.read.parquet(path).collect()
    assert sorted((r.k, r.x, r.p) for r in found) == [(1, "late", 2), (2, "o", 2), (3, "o", 3)]


@pytest.mark.parametrize(
    "errors, patience, best",
    [
        ([5, 4, 4, 4, 3, 6], 50, 5),  # a gain returns after flat rounds
        ([5, 4, 6, 6, 6, 3], 3, 2),  # it comes too late
        ([1], 50, 1),
        ([3, 3, 3], 50, 1),  # ties: the earliest
    ],
)
def test_best_round(errors, patience, best):
    from shelfcast.operators import model

    assert model.best_round(errors, patience) == best


def test_empty_input_gives_empty_output(spark):
    none = series(spark, [1]).where("1 = 0")
    assert none.withColumns(V.rolling("sales")).count() == 0
    assert features.densify(none).count() == 0
    assert report.family_mean_top(none).count() == 0
    assert monitor.profile_numeric(none, ["sales"]).count() == 0
