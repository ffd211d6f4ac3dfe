"""Ranked lexical search: integer BM25-like scores, top documents by best-first search over range maxima.

Documents are dealt to shards. Inside a shard every posting list (the documents of one term,
in document order, with their impact ``w * ((10**9 * tf) div (1000 * tf + 12 * m))``) gets a sparse
table of range maxima. A query searches the shard's document range best first: the bound of an interval
is the sum, over the query's terms with their repeats, of each list's maximum inside it. The interval with
the highest bound is split at the block (``LEAF`` documents) of its largest single contribution; a block
whose bound comes up has its documents scored exactly, from their own impacts. Popping in (bound, first
document) order yields documents by descending score and ascending document, so the search stops after
``k``. Shards return their ``k`` best; the best ``k`` of those are the answer.

A document's terms are counted inside its row, in one pass over the texts: only the numbers and counts of
terms that some query holds leave it, and the number of all its terms. N, L and df count all rows. Shards are
sized so that each holds a bounded number of postings; queries are taken in blocks of a bounded number of
terms, each block in a pass of its own.

Defined results:

* A null text has no terms; such a document counts in neither N nor L and is never found.
* Rows repeating a (doc_id, text) pair are separate documents with equal scores: each counts in N, L and
  df and takes its own rank. Null doc_id sorts after all others among equal scores.
* An item_id is a query; rows repeating an (item_id, text) pair count once, and different texts under one
  item_id are asked together (their terms with their repeats). Items without terms or with a score of 0 for
  every document have no rows; null item_id is an item of its own.
* Empty tables give no rows.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import text_blocks
from shelfcast.session import settle

#: Fixed values of the contract: the term pattern and the scoring constants.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Postings per shard, on average, and query terms per block.
SHARD_POSTINGS = 2_000_000
BLOCK_TERMS = 200_000
#: Documents scored at once when an interval has come down to them.
LEAF = 512
#: Bytes of a text that are cut into terms at once.
SLICE = 1 << 22


def terms(text: F.Column) -> F.Column:
    """Maximal runs of letters, digits and non-ASCII characters, A-Z lower-cased; null has none."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(TERM), 0)


def byte_map() -> bytes:
    """UTF-8 bytes as ``terms`` sees them: A-Z lower-cased, bytes of no term a blank."""
    kept = [b > 0x7F or chr(b).isalnum() for b in range(256)]
    return bytes(ord(chr(b).lower()) if b < 0x80 and kept[b] else b if kept[b] else 0x20 for b in range(256))


def words_of(text: bytes, marks: bytes, size: int = SLICE) -> Iterator[list[bytes]]:
    """The terms of a text as lists of bounded length."""
    text, at = text.translate(marks), 0
    while at < len(text):
        end = text.find(b" ", at + size)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def _term_counts(vocabulary: dict[bytes, int]) -> Callable:
    """The function every task of the texts runs: a row for each document with terms, holding the numbers and
    counts of those in ``vocabulary``. ``lot`` numbers the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, number, lot = byte_map(), vocabulary.get, TaskContext.get().partitionId() << 36
        for part, texts in text_blocks(batches, "text"):
            rows, sizes, codes, counts, ends = [], [], [], [], [0]
            for row, text in enumerate(texts):
                held, n = Counter(), 0
                for words in words_of(text or b"", marks):
                    n += len(words)
                    held.update(map(number, words))
                if not n:
                    continue
                held.pop(None, None)
                rows.append(row)
                sizes.append(n)
                codes.extend(held)
                counts.extend(held.values())
                ends.append(len(codes))
            lots = pa.array(range(lot, lot := lot + len(rows)), pa.int64())
            ends = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(x, pa.int32())) for x in (codes, counts)]
            own = part.select(["doc_id", "has_doc"]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*own.columns, lots, pa.array(sizes, pa.int64()), *lists],
                names=["doc_id", "has_doc", "lot", "n", "codes", "counts"],
            )

    return run


class RangeMax:
    """Sparse table of posting lists end to end: the position of the largest impact in any range, lowest on
    ties. ``longest`` is the length of the longest range asked for (by default, of all impacts)."""

    def __init__(self, impacts: np.ndarray, longest: int | None = None):
        self.impacts = impacts
        n = len(impacts)
        depth = max(min(longest or n, n), 1).bit_length()
        self.levels = np.zeros((depth, n), dtype=np.int32)
        self.levels[0] = np.arange(n)
        for j in range(1, depth):
            span, prev = 1 << (j - 1), self.levels[j - 1]
            left, right = prev[: n - 2 * span + 1], prev[span : n - span + 1]
            self.levels[j, : n - 2 * span + 1] = np.where(impacts[right] > impacts[left], right, left)

    def many(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``best`` of many ranges at once."""
        j = np.frexp((b - a).astype(np.float64))[1] - 1
        left, right = self.levels[j, a], self.levels[j, b - (1 << j.astype(np.int64))]
        return np.where(self.impacts[right] > self.impacts[left], right, left)

    def best(self, a: int, b: int) -> int:
        """Position of the largest impact in ``[a, b)``, which must not be empty."""
        j = int(b - a).bit_length() - 1
        left, right = self.levels[j][a], self.levels[j][b - (1 << j)]
        return right if self.impacts[right] > self.impacts[left] else left


def search(lists: list[tuple[int, np.ndarray, RangeMax]], documents: int, k: int) -> list[tuple[int, int]]:
    """``(document, score)`` of the ``k`` best documents of ``range(documents)`` with a score above 0.

    ``lists`` holds, per query term, its repeat count, the sorted documents of its posting list and their
    range maxima."""

    def bound(lo: int, hi: int) -> tuple[int, int]:
        total, top, at = 0, -1, -1
        for q, docs, rmq in lists:
            a, b = np.searchsorted(docs, lo), np.searchsorted(docs, hi)
            if a < b:
                p = rmq.best(a, b)
                part = q * int(rmq.impacts[p])
                total += part
                if part > top:
                    top, at = part, int(docs[p])
        return total, at

    return best_first(bound, documents, k)


def best_first(bound, documents: int, k: int, leaf: int = 1, score=None) -> list[tuple[int, int]]:
    """Pop intervals by (bound, first document); split one at the block of ``leaf`` documents that holds its
    largest contribution. A popped block gives way to its ``k`` best documents, by their exact scores."""
    found: list[tuple[int, int]] = []
    first, at = bound(0, documents)
    heap = [(-first, 0, documents, at)]
    while heap and len(found) < k:
        value, lo, hi, at = heapq.heappop(heap)
        if -value <= 0:
            break
        if hi - lo == 1:
            found.append((lo, -value))
            continue
        if hi - lo <= leaf:
            exact = score(lo, hi)
            for i in np.argsort(-exact, kind="stable")[:k].tolist():
                if exact[i] > 0:
                    heapq.heappush(heap, (-int(exact[i]), lo + i, lo + i + 1, lo + i))
            continue
        cut = at - at % leaf
        for a, b in ((lo, cut), (cut, min(cut + leaf, hi)), (cut + leaf, hi)):
            if a < b:
                s, m = bound(a, b)
                if s > 0:
                    heapq.heappush(heap, (-s, a, b, m))
    return found


class ShardIndex:
    """All posting lists of a shard end to end, keyed by ``term * documents + document``, with one table of
    range maxima; a query's bound over an interval takes all its terms in a few array operations."""

    def __init__(self, term: np.ndarray, at: np.ndarray, impacts: np.ndarray, documents: int):
        self.documents, self.at, self.impacts = documents, at, impacts
        self.key = term.astype(np.int64) * documents + at
        self.rmq = RangeMax(impacts, documents)

    def search(self, terms: np.ndarray, repeats: np.ndarray, k: int, leaf: int = LEAF) -> list[tuple[int, int]]:
        base = terms.astype(np.int64) * self.documents

        def ranges(lo: int, hi: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            a, b = np.searchsorted(self.key, base + lo), np.searchsorted(self.key, base + hi)
            live = a < b
            return a[live], b[live], repeats[live]

        def bound(lo: int, hi: int) -> tuple[int, int]:
            a, b, times = ranges(lo, hi)
            if not len(a):
                return 0, -1
            p = self.rmq.many(a, b)
            part = times * self.impacts[p]
            return int(part.sum()), int(self.at[p[int(np.argmax(part))]])

        def score(lo: int, hi: int) -> np.ndarray:
            a, b, times = ranges(lo, hi)
            held = b - a
            p = np.repeat(a - (np.cumsum(held) - held), held) + np.arange(held.sum())
            total = np.zeros(hi - lo, dtype=np.int64)
            np.add.at(total, self.at[p] - lo, np.repeat(times, held) * self.impacts[p])
            return total

        return best_first(bound, self.documents, k, leaf, score)


def _shard_search(k: int, queries: list, weights: np.ndarray, n_docs: int, n_terms: int) -> Callable:
    """The function every shard runs: range maxima of its posting lists, then every query. ``queries`` holds
    an item's key, the numbers of its terms and their repeats; ``weights`` the weight of every number."""
    shape = [("item_id", pa.int64()), ("has_item", pa.bool_()), ("doc_id", pa.int64()), ("has_doc", pa.bool_()), ("score", pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        rows = pa.Table.from_batches(parts).combine_chunks()
        doc_id, has_doc, n = (rows.column(c).to_numpy() for c in ("doc_id", "has_doc", "n"))
        order = np.lexsort((doc_id, ~has_doc))
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        held = pc.list_value_length(rows.column("codes")).to_numpy()
        code = pc.list_flatten(rows.column("codes")).to_numpy()
        tf = pc.list_flatten(rows.column("counts")).to_numpy().astype(np.int64)
        m = np.repeat(75 + (25 * n * n_docs) // n_terms, held)
        impact = weights[code] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))
        at = np.repeat(place, held)
        live = np.flatnonzero(impact)
        live = live[np.lexsort((at[live], code[live]))]
        if not len(live):
            return
        index = ShardIndex(code[live], at[live], impact[live], len(order))
        doc_id, has_doc = doc_id[order], has_doc[order]
        out = []
        for (has_item, item_id), terms, repeats in queries:
            out += [(item_id, has_item, int(doc_id[i]), bool(has_doc[i]), s) for i, s in index.search(terms, repeats, k)]
        columns = zip(*out, strict=True) if out else [[] for _ in shape]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(columns, shape, strict=True)], schema=pa.schema(shape))

    return run


def rank(
    documents: DataFrame,
    benchmark: DataFrame,
    k: int = 20,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score``: every item's ``k`` best documents with a score above 0."""
    spark = documents.sparkSession
    rows = documents.select(
        F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(0)).alias("doc_id"),
        F.col(f"`{doc_id}`").isNotNull().alias("has_doc"),
        F.col(f"`{text}`").cast("string").cast("binary").alias("text"),
    )
    items = benchmark.select(
        F.col(f"`{item_id}`").cast("long").alias("item_id"), terms(F.col(f"`{item_text}`")).alias("terms")
    ).dropDuplicates(["item_id", "terms"])
    asked = items.select("item_id", F.posexplode("terms").alias("i", "term")).groupBy("item_id", "term").agg(F.count("i").alias("q"))

    found = None
    for block in _blocks(asked):
        part = _ask(rows, block, k)
        if part is None:
            break
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = F.row_number().over(
        Window.partitionBy("has_item", "item_id").orderBy(F.col("score").desc(), F.col("has_doc").desc(), "doc_id")
    )
    best = found.withColumn("rank", order).where(F.col("rank") <= k)
    return best.select(
        F.when(F.col("has_item"), F.col("item_id")).alias("item_id"),
        F.col("rank").cast("int"),
        F.when(F.col("has_doc"), F.col("doc_id")).alias("doc_id"),
        "score",
    )


def _ask(rows: DataFrame, block: dict, k: int) -> DataFrame | None:
    """Every shard's best documents for the items of a block; None if no document has a term."""
    spark = rows.sparkSession
    number: dict[str, int] = {}
    for asked in block.values():
        for term, _ in asked:
            number.setdefault(term, len(number))
    counted = rows.mapInArrow(
        _term_counts({term.encode(): i for term, i in number.items()}),
        "doc_id long, has_doc boolean, lot long, n long, codes array<int>, counts array<int>",
    )
    stored = settle(counted, "postings")
    figures = stored.agg(
        F.count(F.lit(1)).alias("N"), F.sum("n").alias("L"), F.sum(F.size("codes").cast("long")).alias("postings")
    ).first()
    n_docs, n_terms = int(figures["N"]), int(figures["L"] or 0)
    if n_docs == 0:
        return None
    df = stored.select(F.explode("codes").alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("df"))
    w = F.floor(F.lit(1000.0) * F.log((2.0 * n_docs + 2) / (2.0 * F.col("df") + 1))).cast("long")
    weights = np.zeros(len(number), dtype=np.int64)
    for found in df.select("code", w.alias("w")).collect():  # one row per term of the block
        weights[found["code"]] = found["w"]
    queries = [
        (key, np.array([number[t] for t, _ in asked], dtype=np.int64), np.array([q for _, q in asked], dtype=np.int64))
        for key, asked in block.items()
    ]
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    shards = max(tasks, math.ceil(int(figures["postings"]) / SHARD_POSTINGS))
    # every partition is a shard; one by number is not merged by adaptive execution
    dealt = stored.where(F.size("codes") > 0).repartition(shards, "lot")
    return dealt.mapInArrow(
        _shard_search(k, queries, weights, n_docs, n_terms),
        "item_id long, has_item boolean, doc_id long, has_doc boolean, score long",
    )


def _blocks(asked: DataFrame):
    """The queries' terms as dictionaries of at most about ``BLOCK_TERMS`` terms, item by item."""
    block: dict = {}
    held = 0
    for row in asked.orderBy("item_id", "term").toLocalIterator():
        key = (row["item_id"] is not None, row["item_id"] if row["item_id"] is not None else 0)
        if key not in block and held >= BLOCK_TERMS:
            yield block
            block, held = {}, 0
        block.setdefault(key, []).append((row["term"], int(row["q"])))
        held += 1
    if block:
        yield block
