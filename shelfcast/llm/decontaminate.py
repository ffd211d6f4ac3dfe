"""Benchmark decontamination by spaced-seed hashing.

A seed is a fixed mask over a window of token positions; positions outside the mask are ignored, so a
window with substituted tokens still matches under some mask. Training windows are hashed under
every mask, kept if a fixed-size bitmap of the benchmark's hashes may hold them, and joined with the
benchmark's hashes. Around every hit the two token sequences are compared position by position
along the same diagonal, and only overlaps that agree well enough count.

Windows that pass the bitmap and lie close together form a passage, which carries its tokens once.
The bitmap only saves shuffling: the join decides, however full the bitmap is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import same_columns, text_blocks
from shelfcast.session import settle

#: Masks with 7 compared positions. Wherever two of 13 tokens are substituted, one of them still fits in
#: between at some place; the tests go through all cases.
MASKS = ("11110111", "1100101111", "111011001001")
#: The same for items of fewer tokens, by their number and for as many substitutions as it allows.
SHORT_MASKS = {
    12: ("11010111", "1110110001", "1100011011"),
    11: ("1111011", "110001111", "1101100011"),
    10: ("110111", "11001011", "1100000111"),
    9: ("1101111", "11110101"),
    8: ("110111", "1110011"),
    7: ("11111", "111011", "1001111"),
    6: ("11011", "101101"),
    **{n: ("1" * n,) for n in range(2, 6)},
}
#: Items of so many tokens at most must agree in all of them.
EXACT_ITEM = 5
#: Tokens an overlap must cover (or the whole item, if shorter), and the share that must agree.
MIN_OVERLAP = 13
MIN_AGREEMENT = 0.8
#: Size of the bitmap: 4 MB, whatever the tables.
BITMAP_BITS = 1 << 25

_PUNCTUATION = "".join(map(chr, range(33, 127)))
_STRIP = "".join(c for c in _PUNCTUATION if not c.isalnum()) + "«»“”‘’„…–—¿¡、。〈〉《》「」『』【】〔〕・！（），．：；？［］｛｝～｡｢｣､"
# Scripts written without blanks between words (Thai, Lao, Myanmar, Khmer, kana, Han), whose characters
# are tokens, with the marks that follow them.
_UNSPACED = re.compile(
    "[\u0e01-\u0e30\u0e32\u0e33\u0e40-\u0e46\u0e50-\u0e59\u0e81-\u0eb0\u0eb2\u0eb3\u0ebd\u0ec0-\u0ec6\u0ed0-\u0edf"
    "\u1000-\u102a\u103f-\u1055\u1780-\u17b3\u17e0-\u17e9\u3005-\u3007\u3041-\u3096\u309d-\u30fa\u30fc-\u30ff\u31f0-\u31ff"
    "\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9d\U00020000-\U000323af]"
    "[\u0e31\u0e34-\u0e3a\u0e47-\u0e4e\u0eb1\u0eb4-\u0ebc\u0ec8-\u0ecd\u102b-\u103e\u1056-\u1059\u17b4-\u17d3\u3099\u309a"
    "\ufe00-\ufe0f\uff9e\uff9f\U000e0100-\U000e01ef]*"
)


class TokenHashes(dict):
    """64-bit hash of a word's normal form: lower case without punctuation at its ends; 0 if
    nothing is left. A worker keeps the hashes and starts afresh beyond ``limit`` words."""

    limit = 1_000_000

    def __missing__(self, word: str) -> int:
        bare = word.strip(_STRIP).lower()
        value = xxhash.xxh64_intdigest(bare.encode("utf-8", "replace")) | 1 if bare else 0
        if len(word) <= 60:
            if len(self) >= self.limit:
                self.clear()
            self[word] = value
        return value


@lru_cache(maxsize=1)
def _hashes() -> TokenHashes:
    return TokenHashes()


def token_hashes(text: str) -> np.ndarray:
    if not text.isascii():
        text = _UNSPACED.sub(r" \g<0> ", text)
    hashes = np.fromiter(map(_hashes().__getitem__, text.split()), np.uint64)
    return hashes[hashes != 0]


def seed_hashes(tokens: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the compared positions of every window under a mask."""
    n = len(tokens) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    mixed = np.full(n, int(mask, 2), np.uint64)
    for i, compared in enumerate(mask):
        if compared == "1":
            mixed *= np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            mixed += tokens[i : i + n]
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32))


def item_masks(n_tokens: int) -> tuple[str, ...]:
    """The masks under which an item of so many tokens is looked up."""
    return MASKS if n_tokens >= MIN_OVERLAP else SHORT_MASKS.get(n_tokens, ())


def _bitmap_places(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = np.uint64(BITMAP_BITS - 1)
    return hashes & size, (hashes >> np.uint64(32)) & size


def benchmark_seeds(items: DataFrame) -> DataFrame:
    """``seed, item_id, item_at`` of every window of every item under every mask for its length."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, blobs in _token_batches(batches):
            rows, ats, seeds = [], [], []
            for row, tokens in enumerate(blobs):
                for mask in item_masks(len(tokens)):
                    own = seed_hashes(tokens, mask)
                    rows += [row] * len(own)
                    ats += range(len(own))
                    seeds += own.view(np.int64).tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(seeds, pa.int64()),
                    part.column("item_id").take(pa.array(rows, pa.int64())),
                    pa.array(ats, pa.int32()),
                ],
                names=["seed", "item_id", "item_at"],
            )

    kind = items.schema["item_id"].dataType.simpleString()
    return items.mapInArrow(emit, f"seed long, item_id {kind}, item_at int")


def _token_batches(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        yield batch, [np.frombuffer(b, np.uint64) for b in batch.column("tokens").to_pylist()]


def benchmark_tokens(benchmark: DataFrame) -> DataFrame:
    """``item_id, n_tokens, tokens`` of every item."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_blocks(batches, "text"):
            blobs = [token_hashes(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("item_id"),
                    pa.array([len(b) for b in blobs], pa.int32()),
                    pa.array([b.tobytes() for b in blobs], pa.binary()),
                ],
                names=["item_id", "n_tokens", "tokens"],
            )

    rows = benchmark.select("item_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["item_id"].dataType.simpleString()
    return rows.mapInArrow(emit, f"item_id {kind}, n_tokens int, tokens binary")


def seed_bitmap(seeds: DataFrame) -> bytes:
    """The bitmap of all seeds, two bits each. Every task makes its own, one task merges
    them as they come, and the driver receives a single bitmap."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(BITMAP_BITS // 8, np.uint8)
        for batch in batches:
            hashes = batch.column("seed").to_numpy().view(np.uint64)
            for place in _bitmap_places(hashes):
                np.bitwise_or.at(bits, place >> np.uint64(3), np.uint8(1) << (place & np.uint64(7)).astype(np.uint8))
        yield pa.RecordBatch.from_pydict({"bits": [bits.tobytes()]})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(BITMAP_BITS // 8, np.uint8)
        for batch in batches:
            for blob in batch.column("bits"):
                bits |= np.frombuffer(blob.as_py(), np.uint8)
        yield pa.RecordBatch.from_pydict({"bits": [bits.tobytes()]})

    maps = seeds.select("seed").mapInArrow(fill, "bits binary")
    maps = maps.repartition(1).mapInArrow(merge, "bits binary")
    return bytes(maps.collect()[0].bits)


def training_passages(documents: DataFrame, bitmap, masks: list[str]) -> DataFrame:
    """``doc_id, begin, tokens, hits`` of every stretch of a document whose windows the bitmap may hold;
    ``begin`` is the stretch's first token, ``hits`` are the seeds and their places in the document."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap.value, np.uint8)

        def may_hold(hashes: np.ndarray) -> np.ndarray:
            found = np.arange(len(hashes))
            for place in _bitmap_places(hashes):
                place = place[found]
                held = bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1
                found = found[held == 1]
                if not len(found):
                    break
            return found

        for part, texts in text_blocks(batches, "text"):
            rows, begins, blobs, hits = [], [], [], []
            for row, text in enumerate(texts):
                tokens = token_hashes(text)
                at, seed = [], []
                for mask in masks:
                    own = seed_hashes(tokens, mask)
                    found = may_hold(own)
                    at.append(found)
                    seed.append(own[found])
                at, seed = np.concatenate(at), np.concatenate(seed)
                if not len(at):
                    continue
                order = np.argsort(at, kind="stable")
                at, seed = at[order], seed[order].view(np.int64)
                reach = MIN_OVERLAP + max(map(len, MASKS))
                for own in np.split(np.arange(len(at)), np.flatnonzero(np.diff(at) > reach) + 1):
                    begin = max(0, int(at[own[0]]) - MIN_OVERLAP)
                    rows.append(row)
                    begins.append(begin)
                    blobs.append(tokens[begin : int(at[own[-1]]) + reach].tobytes())
                    hits.append([{"seed": s, "at": a} for s, a in zip(seed[own].tolist(), at[own].tolist())])
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").take(pa.array(rows, pa.int64())),
                    pa.array(begins, pa.int32()),
                    pa.array(blobs, pa.binary()),
                    pa.array(hits, pa.list_(pa.struct([("seed", pa.int64()), ("at", pa.int32())]))),
                ],
                names=["doc_id", "begin", "tokens", "hits"],
            )

    rows = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {kind}, begin int, tokens binary, hits array<struct<seed: long, at: int>>"
    return rows.mapInArrow(emit, shape)


def agreeing(item: np.ndarray, passage: np.ndarray, shift: int) -> tuple[int, int, int]:
    """Compare ``item[i]`` with ``passage[i + shift]``: covered tokens, agreeing tokens and the first
    covered place in the item, over all stretches of the needed length that agree well enough."""
    low, high = max(0, -shift), min(len(item), len(passage) - shift)
    need = min(MIN_OVERLAP, len(item))
    if high - low < need:
        return 0, 0, 0
    same = item[low:high] == passage[low + shift : high + shift]
    total = np.concatenate([[0], np.cumsum(same)])
    share = MIN_AGREEMENT if len(item) > EXACT_ITEM else 1
    good = np.flatnonzero(total[need:] - total[:-need] >= share * need)
    if not len(good):
        return 0, 0, 0
    covered = np.zeros(len(same) + 1, np.int64)
    np.add.at(covered, good, 1)
    np.add.at(covered, good + need, -1)
    inside = np.cumsum(covered[:-1]) > 0
    return int(inside.sum()), int(same[inside].sum()), low + int(good[0])


def verified(pairs: DataFrame) -> DataFrame:
    """Overlaps that agree: ``doc_id, item_id, doc_from`` (first token), ``n_overlap, n_same``."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, found = [], []
            columns = [batch.column(c).to_pylist() for c in ("item_tokens", "tokens", "diagonal", "begin")]
            for row, (item, passage, diagonal, begin) in enumerate(zip(*columns, strict=True)):
                covered, same, first = agreeing(
                    np.frombuffer(item, np.uint64), np.frombuffer(passage, np.uint64), diagonal - begin
                )
                if covered:
                    kept.append(row)
                    found.append((first + diagonal, covered, same))
            index = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(index), batch.column("item_id").take(index)]
                + [pa.array([f[i] for f in found], pa.int32()) for i in range(3)],
                names=["doc_id", "item_id", "doc_from", "n_overlap", "n_same"],
            )

    kinds = [pairs.schema[c].dataType.simpleString() for c in ("doc_id", "item_id")]
    return pairs.mapInArrow(
        check, f"doc_id {kinds[0]}, item_id {kinds[1]}, doc_from int, n_overlap int, n_same int"
    )


def contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item that overlap: ``doc_id, item_id, doc_from`` (first token
    of the longest overlap), ``n_overlap`` (its tokens), ``n_same`` (those that agree).

    An overlap covers at least ``MIN_OVERLAP`` tokens, or the whole item if that is shorter, and in every
    stretch of that length at least ``MIN_AGREEMENT`` of the tokens agree position by position. Tokens
    are words in lower case without punctuation at their ends; in scripts without blanks, characters. Items of at
    most ``EXACT_ITEM`` tokens must agree in all. Items of a single token, null and empty texts overlap with nothing. Rows with a null id take part under that id. Repeated rows
    give one row; other columns are not read; an empty table on either side gives an empty result.
    """
    spark = documents.sparkSession
    items = settle(benchmark_tokens(benchmark), "benchmark-tokens")
    short = items.where(F.col("n_tokens") < MIN_OVERLAP).select("n_tokens").distinct()
    lengths = sorted(r.n_tokens for r in short.collect())  # at most one row for each
    seeds = settle(benchmark_seeds(items), "benchmark-seeds")
    bitmap = spark.sparkContext.broadcast(seed_bitmap(seeds))
    masks = list(dict.fromkeys([*MASKS, *(m for n in lengths for m in item_masks(n))]))
    passages = settle(
        training_passages(documents, bitmap, masks).withColumn("passage", F.monotonically_increasing_id()),
        "passages",
    )
    hits = passages.select("passage", F.explode("hits").alias("hit")).select("passage", "hit.seed", "hit.at")
    diagonals = (
        hits.join(seeds, "seed")
        .select("passage", "item_id", (F.col("at") - F.col("item_at")).alias("diagonal"))
        .distinct()
    )
    pairs = (
        diagonals.join(passages.select("passage", "doc_id", "begin", "tokens"), "passage")
        .join(items.select("item_id", F.col("tokens").alias("item_tokens")), "item_id")
    )
    longest = F.struct("n_overlap", "n_same", (-F.col("doc_from")).alias("early"), "doc_from")
    return (
        verified(pairs)
        .groupBy("doc_id", "item_id")
        .agg(F.max(longest).alias("best"))
        .select("doc_id", "item_id", "best.doc_from", "best.n_overlap", "best.n_same")
    )


def clean_documents(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that overlap with no benchmark item, with all their columns. Rows with a null
    id stay."""
    found = contaminated(documents, benchmark).select("doc_id").distinct()
    return same_columns(documents.join(found, "doc_id", "left_anti"), documents)
