"""Gradient-boosted forecasting on MLlib: folds, training, selection, scoring."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions.calendar import expand_datetimes
from shelfcast.functions.numeric import clip, string_columns
from shelfcast.functions.text import prediction_id
from shelfcast.operators.evaluate import correlation, variances
from shelfcast.operators.features import category_codes
from shelfcast.operators.ordered import ordered_index
from shelfcast.session import settle, shared_dir

TARGET = "sales"
NOT_FEATURES = ("sales", "date", "id")
CONSTANT_FORECAST = 10.0
#: Rows a training task holds: at least so many before another task is worth its jobs, and never more than so many.
TASK_ROWS, MOST_TASK_ROWS = 50_000, 500_000


# --- folds --------------------------------------------------------------------------------------


def time_folds(df: DataFrame, order: Sequence[str], folds: int = 5) -> DataFrame:
    """Number the expanding validation folds: a row with fold f is tested in fold f and trains
    every later one; rows before the first test block have fold 0.

    The row order is global, so it is computed over value ranges; ``order`` must be unique.
    """
    indexed = ordered_index(df, [], order, "__row")
    total, position = F.col("__row_total"), F.col("__row") - 1
    size = F.floor(total / (folds + 1))
    first = total - size * folds
    fold = F.when(position < first, 0).otherwise(F.floor((position - first) / size) + 1)
    return indexed.withColumns({"row_index": position, "fold": fold.cast("int")}).drop(
        "__row", "__row_total"
    )


def fold_bounds(folded: DataFrame, time: str = "date") -> DataFrame:
    """Train and test sizes and test dates per fold."""
    sizes = folded.groupBy("fold").agg(
        F.count(F.lit(1)).alias("test_rows"),
        F.min("row_index").alias("train_rows"),  # everything before the test block trains
        F.min(time).alias("test_from"),
        F.max(time).alias("test_to"),
    )
    return sizes.where(F.col("fold") > 0)


# --- features -----------------------------------------------------------------------------------


def prepare(df: DataFrame, drop: Sequence[str] = NOT_FEATURES) -> tuple[DataFrame, list[str]]:
    """Numeric feature table and the names of its features; text columns become codes."""
    texts = [c for c in string_columns(df) if c not in drop]
    coded = category_codes(df, texts)
    features = [f"{c}_code" if c in texts else c for c in df.columns if c not in drop]
    kept = [c for c in df.columns if c in drop]
    return coded.select(*kept, *features), features


def regressor(
    rounds: int = 100, rate: float = 0.05, depth: int = 5, seed: int = 42, target: str = TARGET
) -> GBTRegressor:
    """Boosted trees; depth 5 gives about the 31 leaves of the leaf-wise setting. Lineage of the
    boosting loop is cut by checkpoints every ten rounds."""
    return GBTRegressor(
        labelCol=target,
        featuresCol="features",
        maxIter=rounds,
        stepSize=rate,
        maxDepth=depth,
        seed=seed,
        checkpointInterval=10,
        maxMemoryInMB=512,
    )


def training_tasks(rows: int, cores: int) -> int:
    """Partitions of a training table: boosting runs two stages for every level of every tree, so its time and what
    its tasks report to the driver grow with the partitions of the table, not only with its rows."""
    return max(min(-(-rows // TASK_ROWS), cores), -(-rows // MOST_TASK_ROWS), 1)


def dealt(df: DataFrame) -> DataFrame:
    """``df`` in evenly filled partitions, as many as its rows need, whatever files or folds it comes from."""
    return df.repartition(training_tasks(df.count(), df.sparkSession.sparkContext.defaultParallelism))


def train(
    df: DataFrame, features: Sequence[str], gbt: GBTRegressor | None = None
) -> PipelineModel:
    if not df.sparkSession.sparkContext.getCheckpointDir():
        df.sparkSession.sparkContext.setCheckpointDir(shared_dir(df.sparkSession))
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    return Pipeline(stages=[assembler, gbt or regressor()]).fit(dealt(df))


def best_round(errors: Sequence[float], patience: int) -> int:
    """How many rounds to keep: those up to the smallest error, once ``patience`` rounds have brought no
    smaller one (or the rounds are over)."""
    best = 0
    for i, error in enumerate(errors):
        if error < errors[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def prefix(fitted: PipelineModel, rounds: int) -> PipelineModel:
    """The fitted pipeline with the first ``rounds`` trees and weights of its ensemble: what a fit of that many
    rounds grows, as tree ``k`` depends only on the trees before it (no subsampling)."""
    booster = fitted.stages[-1]
    found = booster._java_obj
    context = SparkSession.active().sparkContext
    jvm, gateway = context._jvm, context._gateway
    keep = min(rounds, len(booster.trees))
    trees, weights = found.trees(), found.treeWeights()
    first = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, keep)
    scale = gateway.new_array(jvm.double, keep)
    for i in range(keep):
        first[i], scale[i] = trees[i], weights[i]
    shorter = jvm.org.apache.spark.ml.regression.GBTRegressionModel(found.uid(), first, scale, found.numFeatures())
    made = GBTRegressionModel(shorter)
    made._transfer_params_from_java()
    made.setFeaturesCol(booster.getFeaturesCol()).setPredictionCol(booster.getPredictionCol())
    return PipelineModel([*fitted.stages[:-1], made])


def train_with_early_stop(
    df: DataFrame,
    features: Sequence[str],
    validation: Column,
    patience: int = 50,
    gbt: GBTRegressor | None = None,
) -> PipelineModel:
    """Boost all rounds on the rows not marked by ``validation``, and keep the rounds up to the smallest error on
    the marked ones by the rule of ``best_round``: one fit, whose first trees are kept (``prefix``)."""
    booster = gbt or regressor()
    seen, held = df.where(~validation), df.where(validation)
    fitted = train(seen, features, booster)
    errors = fitted.stages[-1].evaluateEachIteration(fitted.stages[0].transform(held), "squared")
    kept = best_round(errors, patience)
    return fitted if kept == len(errors) else prefix(fitted, kept)


def importance(model: PipelineModel, features: Sequence[str], spark: SparkSession) -> DataFrame:
    """(feature_name, importance_value), largest first."""
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(f, float(w)) for f, w in zip(features, weights)]
    table = spark.createDataFrame(rows, "feature_name string, importance_value double")
    return table.orderBy(F.desc("importance_value"), "feature_name")


def cross_validate(
    folded: DataFrame,
    features: Sequence[str],
    folds: int = 5,
    gbt: GBTRegressor | None = None,
    patience: int = 50,
) -> tuple[DataFrame, DataFrame]:
    """Per-fold RMSE and MAE, and the feature importance averaged over folds.

    The folded table is written once and read by every fold.
    """
    spark = folded.sparkSession
    stored = settle(folded, "folds")

    def one_fold(k: int) -> tuple[DataFrame, DataFrame]:
        seen = stored.where(F.col("fold") <= k)
        model = train_with_early_stop(
            seen, features, F.col("fold") == k, patience, (gbt or regressor()).copy()
        )
        tested = model.transform(stored.where(F.col("fold") == k))
        gap = F.col("prediction") - F.col(TARGET)
        score = tested.agg(F.sqrt(F.avg(gap * gap)).alias("rmse"), F.avg(F.abs(gap)).alias("mae"))
        return score.select(F.lit(k).alias("fold"), "rmse", "mae"), importance(model, features, spark)

    with ThreadPoolExecutor(folds) as threads:  # the folds' jobs share the cluster
        done = list(threads.map(inheritable_thread_target(spark)(one_fold), range(1, folds + 1)))
    scores, weights = [d[0] for d in done], [d[1] for d in done]
    table, ranks = scores[0], weights[0]
    for more in scores[1:]:
        table = table.unionByName(more)
    for more in weights[1:]:
        ranks = ranks.unionByName(more)
    mean = ranks.groupBy("feature_name").agg(F.avg("importance_value").alias("importance_value"))
    return table, mean.orderBy(F.desc("importance_value"), "feature_name")


def cv_summary(scores: DataFrame) -> DataFrame:
    """Mean and population deviation over folds."""
    return scores.agg(
        F.avg("rmse").alias("rmse"),
        F.avg("mae").alias("mae"),
        F.stddev_pop("rmse").alias("rmse_std"),
        F.stddev_pop("mae").alias("mae_std"),
    )


# --- selection ----------------------------------------------------------------------------------


def select_features(
    df: DataFrame,
    method: str = "importance",
    threshold: float = 0.01,
    max_features: int | None = None,
    target: str = TARGET,
    gbt: GBTRegressor | None = None,
) -> DataFrame:
    """(feature, score) of the features at or above the threshold, best first; only the first
    ``max_features`` of them, if given. Dates count through their parts, text through its codes."""
    label = df.withColumnRenamed(target, "__y")
    coded, features = prepare(expand_datetimes(label), drop=("__y", "id"))
    if method == "correlation":
        scores = correlation(coded, features, "__y").withColumnRenamed("abs_corr", "score")
    elif method == "variance":
        scores = variances(coded, features).withColumnRenamed("variance", "score")
    elif method == "importance":
        booster = (gbt or regressor()).copy().setLabelCol("__y")
        fitted = train(coded, features, booster)
        scores = importance(fitted, features, df.sparkSession).toDF("feature", "score")
    else:
        raise ValueError(f"unknown selection method: {method}")
    passed = F.col("score") > threshold if method == "variance" else F.col("score") >= threshold
    ranked = scores.where(passed).orderBy(F.desc("score"), "feature")
    return ranked if max_features is None else ranked.limit(max_features)


# --- scoring ------------------------------------------------------------------------------------


def score(
    model: PipelineModel, df: DataFrame, version: str, at: Column | None = None
) -> DataFrame:
    """Forecasts, never negative, with their key and model version."""
    out = model.transform(df).withColumn("predicted_sales", clip(F.col("prediction"), lower=0.0))
    out = out.withColumns(
        {
            "id": prediction_id(F.col("store_nbr"), F.col("family"), F.col("date")),
            "model_version": F.lit(version),
        }
    )
    if at is not None:
        out = out.withColumn("created_at", at)
    return out.drop("features", "prediction")


def constant_forecast(df: DataFrame, value: float = CONSTANT_FORECAST) -> DataFrame:
    return df.withColumn("predicted_sales", F.lit(float(value)))


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
