"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts handled at once inside a task, in characters; a longer text is handled alone.
BLOCK_CHARS = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(column: str, folds: int) -> F.Column:
    """crc32 of the id as text, modulo ``folds``; null ids fall into fold -1."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % folds, F.lit(-1))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def same_columns(df: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like`` out of ``df``."""
    return df.select([F.col(f"`{c}`") for c in like.columns])


def bounded_sample(df: DataFrame, rows: int, seed: int) -> DataFrame:
    """About ``rows`` rows spread over the whole table, never more: each row is kept with the
    probability that yields a fifth more than asked for, and a limit ends it."""
    total = df.count()
    if total <= rows:
        return df
    return df.sample(fraction=min(1.0, 1.2 * rows / total), seed=seed).limit(rows)


def text_blocks(
    batches: Iterator[pa.RecordBatch], text: str, limit: int = BLOCK_CHARS
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches whose texts together stay near ``limit`` characters."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
        begin = held = 0
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                part = batch.slice(begin, i - begin)
                yield part, [t or "" for t in part.column(text).to_pylist()]
                begin, held = i, 0
            held += size
        if begin < len(sizes):
            part = batch.slice(begin)
            yield part, [t or "" for t in part.column(text).to_pylist()]
