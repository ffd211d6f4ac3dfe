"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

_TUNING = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot join key is split by AQE once its partition is this much above the median.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}


def build_session(app: str = "shelfcast", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**_TUNING, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can see: ``spark.checkpoint.dir``, or a local one in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="shelfcast-")
    spark.conf.set("spark.checkpoint.dir", folder)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; never reused, so nothing has to be cleared."""
    return f"{shared_dir(spark)}/shelfcast/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str = "stage", **options: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage ends at a table that
    outlives executors, and later plans see its true size. ``options`` go to the writer."""
    path = fresh_path(df.sparkSession, label)
    df.write.mode("errorifexists").options(**options).parquet(path)
    remove_at_end(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_at_end(spark: SparkSession, path: str) -> None:
    """Have the file system drop an intermediate table when the driver ends."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)


def discard(df: DataFrame) -> None:
    """Drop the files of a table that ``settle`` returned, once nothing reads it any more, and let Spark drop the
    shuffle files of plans that are out of use."""
    spark = df.sparkSession
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        place = spark._jvm.org.apache.hadoop.fs.Path(unquote(folder))
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    spark._jvm.System.gc()
