"""Upserts with null versions, quantiles beside NaN, digests of rows whose values hold the separator."""

import math

from pyspark.sql import functions as F

from shelfcast.operators import distribution, monitor
from shelfcast.sources import sinks


def test_newest_per_key_with_null_versions(spark):
    batch = spark.createDataFrame(
        [(1, None, "a"), (1, None, "b"), (2, None, "x"), (2, 3, "y"), (3, 1, "p"), (3, 1, "q")],
        "k int, version int, value string",
    )
    got = {r.k: (r.version, r.value) for r in sinks.newest_per_key(batch, ["k"], "version").collect()}
    assert got == {1: (None, "b"), 2: (3, "y"), 3: (1, "q")}


def test_quantiles_leave_nan_out(spark):
    df = spark.createDataFrame([("g", 1.0), ("g", float("nan")), ("g", 3.0), ("g", None)], "g string, v double")
    row = distribution.quantiles(df, ["g"], "v", {"median": 0.5}).collect()[0]
    assert math.isclose(row["median"], 2.0)


def test_digest_tells_where_values_end(spark):
    rows = spark.createDataFrame([("d", "a|b", "c"), ("e", "a", "b|c"), ("f", "\\N", None), ("g", None, None)], "day string, x string, y string")
    got = {r.day: r.digest for r in monitor.content_digest(rows, F.col("day"), [F.col("x"), F.col("y")]).collect()}
    assert got["d"] != got["e"] and got["f"] != got["g"]
