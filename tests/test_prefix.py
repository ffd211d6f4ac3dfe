"""Early stopping keeps the first trees of one fit; they equal a fit with that many rounds."""

from pyspark.sql import functions as F

from shelfcast.operators import model


def test_prefix_equals_a_shorter_fit(spark):
    rows = spark.range(300).select(
        F.col("id").cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"),
    ).withColumn("sales", F.col("a") * 0.1 + F.col("b") * F.col("b") + F.sin("a"))
    long = model.train(rows, ["a", "b"], model.regressor(rounds=8, depth=3))
    short = model.train(rows, ["a", "b"], model.regressor(rounds=3, depth=3))
    cut = model.prefix(long, 3)
    assert cut.stages[-1].getNumTrees == 3
    one = [r.prediction for r in cut.transform(rows).orderBy("a").collect()]
    two = [r.prediction for r in short.transform(rows).orderBy("a").collect()]
    assert max(abs(x - y) for x, y in zip(one, two)) < 1e-9
    held = F.col("a") >= 240
    stopped = model.train_with_early_stop(rows, ["a", "b"], held, patience=2, gbt=model.regressor(rounds=8, depth=3))
    assert 1 <= stopped.stages[-1].getNumTrees <= 8
