"""Writing tables: append, upsert, replace, surrogate keys, documents, exports, samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.operators.ordered import ordered_index
from shelfcast.operators.sizing import value_of
from shelfcast.session import settle


def write_features(df: DataFrame, path: str, time: str = "date") -> None:
    """Feature table partitioned by year and month; rows are gathered per month before the
    write, and AQE splits a month that is too large for one file."""
    parts = [c for c in ("year", "month") if c not in df.columns]
    made = {"year": F.year(time), "month": F.month(time)}
    out = df.withColumns({c: made[c] for c in parts}) if parts else df
    (
        out.hint("rebalance", "year", "month")
        .write.mode("overwrite")
        .partitionBy("year", "month")
        .parquet(path)
    )


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def newest_per_key(batch: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """One row per key, the one with the highest ``version``; a null version ranks below every other, and
    equal versions are settled by the rest of the row, so a key whose versions are all null keeps a whole
    row of its own. ``max_by`` combines before the shuffle, so a key repeated very often is no hot spot."""
    rest = [c for c in batch.columns if c not in keys]
    order = F.struct(F.col(version).isNotNull(), F.col(version), F.struct(*rest))
    picked = batch.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("__row"))
    return picked.select(*keys, "__row.*").select(*batch.columns)


def without_keys(old: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``old`` whose key, nulls included, does not occur in ``batch``."""
    gone = batch.select(*[F.col(k).alias(f"__gone_{k}") for k in keys]).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"__gone_{k}")) for k in keys]
    return old.join(gone, same, "left_anti")


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Rows of ``new`` replace rows of ``old`` with the same key; the others are kept. Of several new rows
    with one key the one with the highest ``version`` wins. A null is a key value like any other."""
    newest = newest_per_key(new, keys, version)
    return without_keys(old, newest, keys).unionByName(newest)


def delete_and_insert(old: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Remove every old row whose key occurs in the batch, then add the batch (which may hold
    several rows per key)."""
    return without_keys(old, batch, keys).unionByName(batch)


def merge_into_partitions(
    path: str, batch: DataFrame, keys: Sequence[str], partition: Sequence[str], version: str
) -> None:
    """Upsert into a partitioned Parquet table, rewriting only the partitions the batch touches: those
    it writes to and those that hold an old row of one of its keys, which may move.

    The merged rows are staged in the shared folder first: a table must not be
    overwritten while it is being read.
    """
    spark = batch.sparkSession
    stored = spark.read.parquet(path)
    wanted = batch.select(*[F.col(k).alias(f"__key_{k}") for k in keys]).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"__key_{k}")) for k in keys]
    before = stored.join(wanted, same, "left_semi").select(*partition)
    touched = settle(batch.select(*partition).union(before).distinct(), "touched")
    inside = touched.select(*[F.col(c).alias(f"__part_{c}") for c in partition])
    here = [F.col(c).eqNullSafe(F.col(f"__part_{c}")) for c in partition]
    old = stored.join(inside, here, "left_semi").select(*batch.columns)
    staged = settle(upsert(old, batch, keys, version), "merge")
    (
        staged.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition)
        .parquet(path)
    )
    emptied = touched.join(staged.select(*partition).distinct(), list(partition), "left_anti")
    for row in emptied.collect():  # partitions that lost their last row: at most as many as partitions
        where = "/".join(f"{c}={row[c]}" for c in partition)
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{where}")
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def get_or_create(dim: DataFrame, names: DataFrame, name: str = "name") -> DataFrame:
    """The dimension plus a new surrogate id for every name it does not know yet."""
    fresh = names.select(name).where(F.col(name).isNotNull()).distinct()
    fresh = fresh.join(dim.select(name), name, "left_anti")
    numbered = ordered_index(fresh, [], [name], "__rank").drop("__rank_total")
    top = value_of(dim, F.coalesce(F.max("id"), F.lit(0)))
    made = numbered.select((top + F.col("__rank")).cast("int").alias("id"), name)
    return dim.unionByName(made, allowMissingColumns=True)


def write_documents(df: DataFrame, path: str) -> None:
    """Nested rows as JSON documents."""
    df.write.mode("append").json(path)


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV export with a header. ``single_file`` is for small extracts only; by default every
    task writes its own file."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("errorifexists").option("header", True).csv(path)


def fixed_sample(df: DataFrame, keys: Sequence[str], n: int = 1000, seed: int = 42) -> DataFrame:
    """A repeatable random sample of ``n`` rows: the smallest seeded digests of the key.

    Each task keeps its own best ``n``, so nothing is shuffled but candidates.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return df.orderBy(F.md5(text), *keys).limit(n)


def latest_rows(df: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """All rows carrying the newest ``time`` of their key, ties included.

    The newest time is found by partial aggregation and joined back rather than
    ranked in a window, so a key with very many rows stays spread out.
    """
    newest = df.groupBy(*keys).agg(F.max(time).alias(time))
    return df.join(newest, [*keys, time], "left_semi")
