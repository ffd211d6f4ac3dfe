"""Nearest neighbours by multi-index hashing.

Learned rotations turn vectors into binary codes. A code is split into substrings and each has its own
index: the distinct substring values of a block of vectors with the vectors that have them. If two
codes differ in at most ``R`` of their bits, some of their ``m`` substrings differ in at most
``floor(R / m)``, so probing every index for values that near finds every code within ``R``. What is
found is checked on whole codes and then ranked by the original vectors in double precision.

Equal vectors are one entry of the index with their smallest ids, so a vector that many rows share costs
no more than another. Queries and entries meet in blocks, and a block returns its best per query.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import bounded_sample
from shelfcast.session import settle

#: Bounds of the sample that rotations and radius are learned on.
SAMPLE_ROWS = 3_000
#: Bits of a code and of a substring.
CODE_BITS = 256
PART_BITS = 16
#: Share of the sample's nearest pairs that the radius must reach.
REACH = 0.97
#: Entries and queries of a block, on average.
BLOCK_ENTRIES = 1_024
BLOCK_QUERIES = 1_024


@dataclass
class Coder:
    """Rotations (dimensions x bits) after subtracting the mean, and the Hamming radius."""

    mean: np.ndarray
    rotations: np.ndarray
    radius: int

    def codes(self, unit: np.ndarray) -> np.ndarray:
        """Codes of unit vectors, 16-bit substrings as columns."""
        bits = (unit - self.mean) @ self.rotations > 0
        return np.packbits(bits, axis=1, bitorder="little").view("<u2")


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows of finite, non-zero vectors scaled to length 1; divided by their largest absolute component first,
    so that neither the squares of very large nor of very small components leave the range of doubles."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def learn_rotation(centred: np.ndarray, rng: np.random.Generator, steps: int = 20) -> np.ndarray:
    """Iterative quantisation: the rotation that brings the vectors closest to their own signs."""
    rotation, _ = np.linalg.qr(rng.standard_normal((centred.shape[1], centred.shape[1])))
    for _ in range(steps):
        signs = np.where(centred @ rotation > 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(centred.T @ signs)
        rotation = left @ right
    return rotation


def learn_coder(sample: np.ndarray, bits: int = CODE_BITS, nearest: int = 5, seed: int = 1) -> Coder:
    """Rotations from different starts until there are ``bits`` columns, and the radius that reaches the
    ``REACH`` share of the sample's own nearest pairs. A larger table has nearer neighbours than its
    sample, so the radius errs on the safe side."""
    unit = unit_rows(sample)
    mean = unit.mean(axis=0)
    rng = np.random.default_rng(seed)
    made: list[np.ndarray] = []
    while sum(r.shape[1] for r in made) < bits:
        made.append(learn_rotation(unit - mean, rng))
    coder = Coder(mean, np.concatenate(made, axis=1)[:, :bits], bits)
    if len(unit) > nearest:
        asked = np.arange(0, len(unit), max(1, len(unit) // 300))
        near = unit[asked] @ unit.T
        near[np.arange(len(asked)), asked] = -2.0
        best = np.argpartition(-near, nearest, axis=1)[:, :nearest]
        codes = coder.codes(unit)
        gaps = np.bitwise_count(codes[asked][:, None] ^ codes[best]).sum(axis=2, dtype=np.int64)
        coder.radius = int(np.quantile(gaps, REACH))
    return coder


def search_block(
    coder: Coder, entry_codes: np.ndarray, entry_units: np.ndarray, codes: np.ndarray, units: np.ndarray, nearest: int
) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """For every query its nearest entries of one block: ``(query, entry rows, cosines)``. If the radius holds
    fewer than asked for, it grows to that of the nearest codes, so small tables are searched whole."""
    parts = entry_codes.shape[1]
    index = [np.unique(entry_codes[:, p], return_inverse=True) for p in range(parts)]
    found = []
    for q in range(len(codes)):
        radius = coder.radius
        while True:
            # pigeonhole: a code within the radius has a substring within its share of it
            probed = np.zeros(len(entry_codes), bool)
            for p, (values, rows) in enumerate(index):
                near = np.bitwise_count(values ^ codes[q, p]) <= radius // parts
                probed |= near[rows]
            rows = np.flatnonzero(probed)
            gaps = np.bitwise_count(entry_codes[rows] ^ codes[q]).sum(axis=1, dtype=np.int64)
            rows = rows[gaps <= radius]
            if len(rows) >= min(nearest + 1, len(entry_codes)):
                break
            radius = min(radius + parts, 16 * parts)
        cosines = np.einsum("ij,j->i", entry_units[rows], units[q])
        if len(rows) > nearest + 1:
            # ties at the end must all stay: their order is decided by ids
            last = np.partition(cosines, len(cosines) - nearest - 1)[len(cosines) - nearest - 1]
            keep = cosines >= last
            rows, cosines = rows[keep], cosines[keep]
        found.append((q, rows, cosines))
    return found


def usable_vectors(embeddings: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``vec_id, vector`` of the rows that take part: an id, no null or non-finite component, not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(vector, lambda x: x != 0)
    rows = embeddings.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector"))
    return rows.where(F.col("vec_id").isNotNull()).where(finite.eqNullSafe(True)).where(some.eqNullSafe(True))


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """``entry, vector, ids``: every different vector once, with its ``keep`` smallest ids. Ids beyond them
    can be in no answer. The ids are cut before the shuffle, so a common vector is no hot group."""
    smallest = Window.partitionBy("vector").orderBy("vec_id")
    kept = rows.withColumn("place", F.dense_rank().over(smallest)).where(F.col("place") <= keep)
    return (
        kept.groupBy("vector")
        .agg(F.array_sort(F.collect_set("vec_id")).alias("ids"))
        .withColumn("entry", F.monotonically_increasing_id())
    )


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows of doubles; shorter ones are filled up with zeros."""
    rows = column.to_pylist()
    matrix = np.zeros((len(rows), width))
    for i, row in enumerate(rows):
        matrix[i, : len(row)] = row
    return matrix


def nearest_neighbours(
    embeddings: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    query_every: int = 50,
    nearest: int = 5,
    bits: int = CODE_BITS,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``query_id, rank`` (from 1), ``vec_id, score`` (cosine): for each row whose id is divisible by
    ``query_every`` its nearest rows, ties to the smaller id, without rows of its own id.

    Rows without an id and vectors that are null, zero, or hold null or non-finite components take no
    part. Shorter vectors count as filled up with zeros. Repeated rows count once; an id with several
    vectors is one query whose candidates are merged. Other columns are not read; an empty table gives
    an empty result, and a query without candidates gives no row.
    """
    spark = embeddings.sparkSession
    rows = usable_vectors(embeddings, vec_id, vector)
    kind = rows.schema["vec_id"].dataType.simpleString()
    entries = settle(distinct_vectors(rows, nearest + 1), "vectors")
    number = entries.count()
    shape = f"query long, vec_id {kind}, score double"
    asked = rows.where(F.col("vec_id") % query_every == 0).select(F.col("vec_id").alias("query_id"), "vector")
    queries = asked.join(entries.select("vector", F.col("entry").alias("query")), "vector").select(
        "query_id", "query"
    )
    queries = settle(queries.distinct(), "vector-queries")
    if number:
        found = _searched(spark, entries, queries, number, nearest, bits, sample_rows, shape)
    else:
        found = spark.createDataFrame([], shape)
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    top = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= nearest + 1)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        queries.join(top, "query")
        .where(F.col("vec_id") != F.col("query_id"))
        .groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= nearest)
        .select("query_id", "rank", "vec_id", "score")
    )


def _searched(spark, entries, queries, number, nearest, bits, sample_rows, shape) -> DataFrame:
    width = entries.agg(F.max(F.size("vector"))).first()[0]
    sample = [r.vector for r in bounded_sample(entries.select("vector"), sample_rows, seed=2).collect()]
    matrix = np.zeros((len(sample), width))
    for i, row in enumerate(sample):
        matrix[i, : len(row)] = row
    coder = spark.sparkContext.broadcast(learn_coder(matrix, bits, nearest))
    wanted = queries.select(F.col("query").alias("entry")).distinct()
    query_blocks = max(1, -(-wanted.count() // BLOCK_QUERIES))
    entry_blocks = max(1, -(-number // BLOCK_ENTRIES))
    block = F.pmod(F.xxhash64("entry"), F.lit(entry_blocks))
    query_block = F.pmod(F.xxhash64("entry"), F.lit(query_blocks))
    left = entries.select(
        F.col("vector").alias("point"), "ids", block.alias("eb"), F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("qb")
    )
    right = entries.join(wanted, "entry").select(
        F.col("entry").alias("query"), F.col("vector").alias("asked"),
        F.explode(F.sequence(F.lit(0), F.lit(entry_blocks - 1))).alias("eb"),
        query_block.alias("qb"),
    )

    def search(mine: pa.Table, others: pa.Table) -> pa.Table:
        queries, ids, scores = [], [], []
        if len(mine) and len(others):
            units = unit_rows(_matrix(mine.column("point"), width))
            asked = unit_rows(_matrix(others.column("asked"), width))
            own, use = mine.column("ids").to_pylist(), coder.value
            names = others.column("query").to_pylist()
            for q, found, cosines in search_block(use, use.codes(units), units, use.codes(asked), asked, nearest):
                pairs = [(-c, i) for e, c in zip(found.tolist(), cosines.tolist(), strict=True) for i in own[e]]
                for score, vec in sorted(pairs)[: nearest + 1]:
                    queries.append(names[q])
                    ids.append(vec)
                    scores.append(-score)
        kind = mine.schema.field("ids").type.value_type
        return pa.table(
            {"query": pa.array(queries, pa.int64()), "vec_id": pa.array(ids, kind), "score": pa.array(scores, pa.float64())}
        )

    whole = {c: F.col(c).cast("long") for c in ("eb", "qb")}
    met = left.withColumns(whole).groupBy("eb", "qb").cogroup(right.withColumns(whole).groupBy("eb", "qb"))
    return met.applyInArrow(search, shape)
