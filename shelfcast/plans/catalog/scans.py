"""Sources, sinks, samples and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.operators.registry import group_union
from shelfcast.plans.catalog.base import query, rd, rounded
from shelfcast.session import fresh_path
from shelfcast.sources import sinks, tables
from shelfcast.sources.retail import Retail

SALES_COLUMNS = ["store_nbr", "family", "date", "sales", "onpromotion"]
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _from_sales(columns: str) -> str:
    return f"SELECT {columns} FROM t_sales"


@query("src_csv_multi", _from_sales("store_nbr, family, date, sales, onpromotion"))
def _(r: Retail) -> DataFrame:
    """Sales written as CSV, opened again as one of a set of tables of which others are missing."""
    folder = fresh_path(r.spark, "csv")
    train = r.sales().select(
        F.lit(None).cast("bigint").alias("id"), "date", "store_nbr", "family", "sales", "onpromotion"
    )
    train.write.option("header", True).csv(f"{folder}/train.csv")
    found = tables.load_tables(r.spark, folder)
    return found["train"].select(*SALES_COLUMNS)


@query(
    "src_shape_profile",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS row_count, "
        f"CAST((SELECT count(*) FROM (DESCRIBE SELECT * FROM {t})) AS INTEGER) AS column_count"
        for t in TABLES
    ),
)
def _(r: Retail) -> DataFrame:
    return tables.shape_profile({t: r.raw(t) for t in TABLES})


@query("src_distinct_scan", "SELECT DISTINCT p_type FROM part WHERE p_type IS NOT NULL")
def _(r: Retail) -> DataFrame:
    return tables.distinct_values(r.raw("part"), "p_type")


@query(
    "src_recent_range",
    _from_sales("*") + " WHERE date >= (SELECT max(date) FROM t_sales) - 90",
)
def _(r: Retail) -> DataFrame:
    return tables.recent_range(r.panel(), 90)


@query("src_jdbc_table", "SELECT store_id, family_id, date, sales, onpromotion = 1 AS onpromotion FROM t_facts")
def _(r: Retail) -> DataFrame:
    """The relational sales table from its Parquet location; JDBC is an option of the reader."""
    path = fresh_path(r.spark, "relation")
    facts = r.historical_sales().withColumn("onpromotion", F.col("onpromotion") == 1)
    facts.write.parquet(path)
    stored = tables.read_relation(r.spark, "historical_sales", path)
    return stored.select("store_id", "family_id", "date", "sales", "onpromotion")


def alert_documents(r: Retail) -> DataFrame:
    """One alert document per day on which a drift threshold was exceeded."""
    daily = r.model_drift().groupBy("timestamp").agg(
        F.avg(F.col("exceeded_threshold").cast("double")).alias("score"), F.count(F.lit(1)).alias("n")
    )
    data = F.struct(
        F.col("n").alias("n_rows"), F.col("score").alias("overall_drift_score"),
        (F.col("score") > 0.3).alias("drift_detected"),
    )
    return daily.where("score > 0").select(
        F.col("timestamp").cast("string").alias("timestamp"), F.lit("data_drift").alias("type"),
        F.lit("naive7").alias("model"), F.lit("drift").alias("message"), data.alias("data"),
    )


ALERTS_SQL = """
SELECT strftime(timestamp, '%Y-%m-%d') AS day, avg(CASE WHEN exceeded_threshold THEN 1.0 ELSE 0.0 END) AS score,
       count(*) AS n
FROM t_drift GROUP BY 1 HAVING score > 0"""


@query(
    "src_json_docs",
    f"SELECT day AS timestamp, 'data_drift' AS type, n AS n_rows, {rd('score')} AS score FROM ({ALERTS_SQL})",
)
def _(r: Retail) -> DataFrame:
    """Alert documents written as JSON and read back under a declared schema."""
    folder = fresh_path(r.spark, "alerts")
    sinks.write_documents(alert_documents(r), folder)
    docs = tables.read_documents(r.spark, folder)
    return rounded(
        docs.select(
            "timestamp", "type", F.col("data.n_rows").alias("n_rows"),
            F.col("data.overall_drift_score").alias("score"),
        )
    )


@query(
    "snk_features",
    "SELECT *, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month FROM t_sales",
)
def _(r: Retail) -> DataFrame:
    """Every row read back from the table partitioned by year and month."""
    path = fresh_path(r.spark, "features")
    sinks.write_features(r.sales(), path)
    return r.spark.read.parquet(path)


@query(
    "snk_append",
    _from_sales("*") + " WHERE store_nbr < 10 UNION ALL SELECT * FROM t_sales WHERE store_nbr >= 10",
)
def _(r: Retail) -> DataFrame:
    path = fresh_path(r.spark, "append")
    sales = r.panel().select(*SALES_COLUMNS)
    sinks.append(sales.where("store_nbr < 10"), path)
    sinks.append(sales.where("store_nbr >= 10"), path)
    return r.spark.read.schema(sales.schema).parquet(path)


def _correction(r: Retail) -> DataFrame:
    """Corrected promoted sales, and one new family per store and day seen."""
    sales = r.panel().select(*SALES_COLUMNS)
    fixed = sales.where("onpromotion = 1").withColumn("sales", F.col("sales") + 1)
    new = sales.where("family = 'PROMO'").withColumn("family", F.lit("NEW"))
    return fixed.unionByName(new)


CORRECTION_SQL = """
SELECT store_nbr, family, date, sales + 1 AS sales, onpromotion FROM t_sales WHERE onpromotion = 1
UNION ALL SELECT store_nbr, 'NEW', date, sales, onpromotion FROM t_sales WHERE family = 'PROMO'"""


@query(
    "snk_upsert",
    """WITH batch AS (
  SELECT store_nbr, family, date, CASE WHEN store_nbr < 10 THEN sales + 5 ELSE sales + 1 END AS sales, onpromotion
  FROM t_sales WHERE onpromotion = 1
  UNION ALL SELECT store_nbr, 'NEW', date, sales, onpromotion FROM t_sales WHERE family = 'PROMO')
SELECT * FROM batch UNION ALL SELECT s.* FROM t_sales s ANTI JOIN batch b USING (store_nbr, family, date)""",
)
def _(r: Retail) -> DataFrame:
    """Merge a batch into a partitioned table, rewriting the touched partitions only; the batch
    repeats keys, and the highest revision of a key wins."""
    path = fresh_path(r.spark, "upsert")
    year = F.year("date")
    sales = r.panel().select(*SALES_COLUMNS)
    sales.withColumns({"revision": F.lit(0), "year": year}).write.partitionBy("year").parquet(path)
    first = _correction(r).withColumn("revision", F.lit(1))
    second = sales.where("onpromotion = 1 AND store_nbr < 10").withColumn("sales", F.col("sales") + 5)
    batch = first.unionByName(second.withColumn("revision", F.lit(2))).withColumn("year", year)
    sinks.merge_into_partitions(path, batch, ["store_nbr", "family", "date"], ["year"], "revision")
    return r.spark.read.parquet(path).select(*SALES_COLUMNS)


@query(
    "snk_delete_replace",
    f"WITH batch AS ({CORRECTION_SQL}) SELECT * FROM batch UNION ALL "
    "SELECT * FROM t_sales WHERE (store_nbr, date) NOT IN (SELECT (store_nbr, date) FROM batch)",
)
def _(r: Retail) -> DataFrame:
    sales = r.panel().select(*SALES_COLUMNS)
    return sinks.delete_and_insert(sales, _correction(r), ["store_nbr", "date"])


@query(
    "snk_dim_get_or_create",
    """WITH fresh AS (SELECT DISTINCT event_type AS name FROM events
                     WHERE event_type NOT IN (SELECT name FROM t_families))
       SELECT id, name FROM t_families UNION ALL
       SELECT CAST((SELECT max(id) FROM t_families) + row_number() OVER (ORDER BY name) AS INTEGER), name
       FROM fresh""",
)
def _(r: Retail) -> DataFrame:
    names = r.raw("events").select(F.col("event_type").alias("name"))
    return sinks.get_or_create(r.families(), names)


@query(
    "snk_json_report",
    f"SELECT family, n, {rd('mean_sales')} AS mean_sales FROM "
    "(SELECT family, count(*) AS n, avg(sales) AS mean_sales FROM t_sales GROUP BY 1)",
)
def _(r: Retail) -> DataFrame:
    """A nested report as JSON documents."""
    path = fresh_path(r.spark, "report")
    stats = r.sales().groupBy("family").agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.avg("sales").alias("mean_sales")).alias("stats")
    )
    sinks.write_documents(stats, path)
    stored = r.spark.read.schema(stats.schema).json(path)
    return rounded(stored.select("family", "stats.n", "stats.mean_sales"))


@query("snk_csv_export", _from_sales("*") + " WHERE store_nbr = 3")
def _(r: Retail) -> DataFrame:
    path = fresh_path(r.spark, "export")
    history = r.sales().select(*SALES_COLUMNS).where("store_nbr = 3")
    sinks.export_csv(history, path)
    return r.spark.read.schema(history.schema).option("header", True).csv(path)


@query(
    "smp_fixed",
    "SELECT event_id, event_type, value FROM events ORDER BY md5('42|' || event_id), event_id LIMIT 1000",
)
def _(r: Retail) -> DataFrame:
    """A repeatable sample of 1000 rows."""
    rows = r.raw("events").select("event_id", "event_type", "value")
    return sinks.fixed_sample(rows, ["event_id"], 1000)


# --- sets -----------------------------------------------------------------------------------------


@query(
    "set_union_panel",
    "SELECT store_nbr, family, date, CASE WHEN year(date) < 2001 THEN sales END AS sales, onpromotion "
    "FROM t_sales",
)
def _(r: Retail) -> DataFrame:
    """Training and test rows together; what the test rows lack is null."""
    sales = r.panel()
    train = sales.where(F.year("date") < 2001)
    test = sales.where(F.year("date") >= 2001).drop("sales")
    return train.unionByName(test, allowMissingColumns=True)


@query(
    "set_distinct_values",
    "SELECT 'family' AS kind, family AS value FROM (SELECT DISTINCT family FROM t_sales) UNION ALL "
    "SELECT DISTINCT 'weekday', CAST(isodow(date) - 1 AS VARCHAR) FROM t_sales",
)
def _(r: Retail) -> DataFrame:
    sales = r.panel()
    families = sales.select(F.lit("family").alias("kind"), F.col("family").alias("value")).distinct()
    days = sales.select(F.lit("weekday").alias("kind"), F.weekday("date").cast("string").alias("value"))
    return families.unionByName(days.distinct())


@query("set_feature_union", "SELECT DISTINCT feature FROM (SELECT family || '_' || store_nbr AS feature FROM t_sales)")
def _(r: Retail) -> DataFrame:
    """Features of all groups: one group per family, one feature per store that sells it."""
    name = F.concat_ws("_", "family", F.col("store_nbr").cast("string"))
    pairs = r.sales().select("family", name.alias("feature")).distinct()
    groups = pairs.groupBy(F.col("family").alias("name")).agg(F.collect_set("feature").alias("features"))
    return group_union(groups)


