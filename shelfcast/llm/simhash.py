"""SimHash fingerprints and their near-duplicate components by ball hashing.

Two fingerprints within ``2 r`` bits always have a common neighbour within ``r`` bits of each: the
point halfway. Every distinct fingerprint therefore emits all values within half of the largest
distance, a shuffle brings equal values together, and every value that several fingerprints meet
at links them. With half the distance ``r = 1`` a meeting value has at most 65 members, all within
2 bits of each other, so linking them to the smallest one keeps every connection without
building pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from shelfcast.llm.common import free_name, same_columns, text_blocks
from shelfcast.llm.components import smallest_reachable
from shelfcast.session import settle

SEED = 42
BITS = 64
#: Fingerprints whose variants one task makes, at most on average.
FINGERPRINTS_A_TASK = 200_000


def fingerprint(text: str, shingle_words: int = 3) -> int:
    """The 64-bit fingerprint of a whole text: bit i is set if it is set in more than half of the
    shingle hashes. Words are separated by ASCII white space and A-Z are lower-cased."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    if len(words) < shingle_words:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle_words)), strict=False))
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65_536):
        block = hashes[at : at + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * ones > len(hashes)).tolist()))


def fingerprints(documents: DataFrame, shingle_words: int = 3) -> DataFrame:
    """``doc_id, fp`` (the fingerprint as a signed long) of every row."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_blocks(batches, "text"):
            own = np.array([fingerprint(t, shingle_words) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(own.view(np.int64))], names=["doc_id", "fp"]
            )

    rows = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(make, f"doc_id {kind}, fp long")


def ball(radius: int) -> list[int]:
    """All masks with at most ``radius`` bits set, as signed longs."""
    masks = [sum(1 << b for b in bits) for n in range(radius + 1) for bits in combinations(range(BITS), n)]
    return [m - (1 << BITS) if m >= 1 << (BITS - 1) else m for m in masks]


def fingerprint_links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """Links ``a, b`` (``a`` below ``b``) between distinct fingerprints ``fp``, enough to connect all
    that are within ``max_bits``, each verified."""
    radius = max_bits // 2
    if max_bits % 2:
        raise ValueError("max_bits must be even: the ball has half of it as its radius")
    masks = F.array(*[F.lit(m).cast("long") for m in ball(radius)])
    variants = distinct.select("fp", F.explode(masks).alias("mask")).select(
        F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"), "fp"
    )
    met = variants.groupBy("variant").agg(F.collect_set("fp").alias("members")).where(F.size("members") > 1)
    if radius <= 1:
        # members differ from the variant in one bit at most, hence from each other in two at most
        sorted_members = F.array_sort("members")
        pairs = met.select(
            F.element_at(sorted_members, 1).alias("a"),
            F.explode(F.slice(sorted_members, 2, F.size(sorted_members))).alias("b"),
        )
    else:
        # farther members may be out of reach of the smallest: pairs inside a ball, whose size the radius bounds
        pairs = met.select(F.explode("members").alias("a"), "members").select(
            "a", F.explode("members").alias("b")
        ).where(F.col("a") < F.col("b"))
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits).distinct()


def near_duplicates(documents: DataFrame, shingle_words: int = 3, max_bits: int = 2) -> DataFrame:
    """One row per input row: ``doc_id, fingerprint`` (16 hex digits), ``component_id`` (the smallest
    doc_id among the documents reachable over links of at most ``max_bits`` bits, itself included).

    ``documents`` needs ``doc_id`` and ``text``; other columns are not read. Null, empty and blank
    texts have fingerprint zero and are linked like any other. Rows with a null doc_id get the
    component of the others, or null if it has no id at all. Copies meet in their common
    fingerprint and are never expanded into pairs. An empty table gives an empty result.
    """
    own = settle(fingerprints(documents, shingle_words), "fingerprints")
    labelled = labelled_fingerprints(own, max_bits)
    firsts = labelled.groupBy("label").agg(F.min("first_id").alias("component_id"))
    by_fp = labelled.join(firsts, "label").select("fp", "component_id")
    return own.join(by_fp, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def labelled_fingerprints(own: DataFrame, max_bits: int) -> DataFrame:
    """``fp, first_id, label`` of every distinct fingerprint of ``own`` (``doc_id, fp``): its smallest doc_id
    and a label that is the same all over its component and nowhere else."""
    spark = own.sparkSession
    distinct = settle(own.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    # a fingerprint becomes many variants: spread them before that
    tasks = max(spark.sparkContext.defaultParallelism, -(-distinct.count() // FINGERPRINTS_A_TASK))
    links = settle(fingerprint_links(distinct.select("fp").repartition(tasks, "fp"), max_bits), "fingerprint-links")
    groups = smallest_reachable(spark, links)
    return distinct.join(groups, distinct.fp == groups.node, "left").select(
        "fp", "first_id", F.coalesce("label", "fp").alias("label")
    )


def first_of_each(documents: DataFrame, shingle_words: int = 3, max_bits: int = 2) -> DataFrame:
    """One row of every near-duplicate component, with all its columns: one with the smallest doc_id. Rows that
    share an id but are not near each other are in components of their own. No doc_id may be null; ``text`` is a string."""
    fp = free_name(documents, "fp")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_blocks(batches, "text"):
            own = np.array([fingerprint(t, shingle_words) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(own.view(np.int64))], names=[*names, fp])

    names = documents.columns
    shape = StructType([*documents.schema.fields, StructField(fp, LongType())])
    own = settle(documents.mapInArrow(make, shape), "fingerprinted-rows")
    labelled = labelled_fingerprints(own.select("doc_id", F.col(f"`{fp}`").alias("fp")), max_bits)
    firsts = labelled.groupBy("label").agg(F.min(F.struct("first_id", "fp")).alias("first"))
    firsts = firsts.select(F.col("first.first_id").alias("doc_id"), F.col("first.fp").alias(fp))
    return same_columns(own.join(firsts, ["doc_id", fp]).dropDuplicates(["doc_id", fp]), documents)
