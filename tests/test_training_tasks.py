"""The partitions of a training table follow its rows, not the files or folds it is read from."""

from pyspark.sql import functions as F

from shelfcast.operators import model


def test_tasks_follow_rows():
    assert [model.training_tasks(n, 12) for n in (0, 1, 50_000, 50_001, 375_000, 5_000_000)] == [1, 1, 1, 2, 8, 12]
    assert model.training_tasks(50_000_000, 12) == 100


def test_a_scattered_table_trains_in_few_tasks(spark):
    rows = spark.range(0, 300, 1, 40).select(F.col("id").cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("sales"))
    sc = spark.sparkContext
    sc.setJobGroup("scattered", "")
    fitted = model.train(rows, ["a"], model.regressor(rounds=2, depth=2))
    sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("scattered") for s in tracker.getJobInfo(j).stageIds]
    grown = [s.numTasks for s in stages if s is not None and "RandomForest" in s.name]
    assert grown and max(grown) == 1
    assert fitted.transform(rows).where("prediction is not null").count() == 300
