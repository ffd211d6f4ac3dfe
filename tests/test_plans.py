"""Plans: shuffles, pushdown, no Python workers, no nested-loop joins."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from shelfcast.operators import windows as V
from shelfcast.sources.retail import Retail

FOLDER = "/root/testdata/sf0.001"
QUERIES = contract.queries()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_series_features_share_one_shuffle_and_one_sort(spark):
    path = f"{FOLDER}/lineitem.parquet"
    panel = spark.read.parquet(path).selectExpr(
        "l_suppkey as store_nbr", "l_returnflag as family", "l_shipdate as date", "l_quantity as sales"
    )
    text = plan(panel.withColumns({**V.lags("sales"), **V.rolling("sales"), **V.expanding("sales")}))
    assert text.count("Exchange hashpartitioning") == 1
    assert len(re.findall(r"\bSort \[", text)) == 1


def test_lines_are_read_narrow(spark):
    text = plan(Retail(spark, FOLDER).sales())
    read = re.search(r"ReadSchema: struct<(l_partkey[^>]*)>", text).group(1)
    assert "l_tax" not in read and "l_extendedprice" not in read


def test_a_date_filter_reaches_the_scan(spark):
    rows = spark.read.parquet(f"{FOLDER}/events.parquet")
    text = plan(rows.where(F.col("ts") >= F.lit(dt.datetime(2024, 1, 16)).cast("timestamp_ntz")))
    assert "GreaterThanOrEqual(ts" in text


NO_LOOPS = [
    "agg_store_top10", "agg_kpi_summary", "agg_target_encoding", "win_rolling_long_groups", "win_ks",
    "win_ts_folds", "jn_pred_actual", "jn_panel_densify", "mon_numeric_drift", "nst_importance_contrib",
    "pipe_train_features",
]


@pytest.mark.parametrize("name", NO_LOOPS)
def test_no_nested_loops_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert node not in text
