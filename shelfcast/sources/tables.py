"""Reading table sets, relational tables and event documents."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.operators.sizing import value_of
from shelfcast.schemas import RAW_TABLES, schema

log = logging.getLogger(__name__)


def load_tables(
    spark: SparkSession, folder: str, names: Iterable[str] = RAW_TABLES, fmt: str = "csv"
) -> dict[str, DataFrame]:
    """Open ``<folder>/<name>.<fmt>`` for every name with its declared schema; a missing file is
    skipped with a warning."""
    tables: dict[str, DataFrame] = {}
    for name in names:
        reader = spark.read.schema(schema(name))
        if fmt == "csv":
            reader = reader.option("header", True)
        try:
            tables[name] = reader.format(fmt).load(f"{folder}/{name}.{fmt}")
        except AnalysisException as problem:
            if "PATH_NOT_FOUND" not in str(problem):
                raise
            log.warning("table %s not found in %s", name, folder)
    return tables


def shape_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns of every table; each scan reads no column data."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"),
            "row_count",
            F.lit(len(df.columns)).cast("int").alias("column_count"),
        )
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull()).distinct()


def recent_range(df: DataFrame, days: int, time: str = "date") -> DataFrame:
    """Rows of the last ``days`` days before the newest date in the table."""
    return df.where(F.col(time) >= F.date_sub(value_of(df, F.max(time)), days))


def read_relation(
    spark: SparkSession, name: str, location: str, jdbc: Mapping[str, str] | None = None
) -> DataFrame:
    """A relational table: Parquet at ``location``, or over JDBC when options are given. For a
    parallel JDBC read pass partitionColumn, lowerBound, upperBound and numPartitions."""
    if jdbc:
        return spark.read.format("jdbc").options(**{"dbtable": name, **jdbc}).load()
    return spark.read.schema(schema(name)).parquet(location)


def read_documents(spark: SparkSession, folder: str, name: str = "alerts") -> DataFrame:
    """A folder of JSON event documents under a declared schema."""
    return spark.read.schema(schema(name)).option("recursiveFileLookup", True).json(folder)
