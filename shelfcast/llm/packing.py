"""Best-fit-decreasing packing of token sequences.

Pieces of equal length are interchangeable, so the whole packing is decided from the number of
pieces of each length, a table with at most ``capacity`` rows whatever the size of the corpus.
The driver runs best-fit decreasing on it: a segment tree over remaining capacities finds the
tightest open bin in logarithmic time, and all pieces of a length that meet bins of the same
remaining capacity are placed in one step. The steps are runs "pieces r to r+n of length L go to
the bins from b on, k to a bin, from offset o". Every piece then gets its number among the pieces
of its length by a salted distributed count and looks up its run; pieces never leave the executors.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import text_blocks
from shelfcast.llm.tokens import load_tokenizer
from shelfcast.session import settle

#: Words whose ids a worker keeps before it starts afresh.
CACHE_WORDS = 500_000


class WordIds(dict):
    """The ids of a word as bytes; a missing word is encoded when first asked for. Cutting at
    blanks and line breaks is exact where the tokenizer drops white space."""

    def __init__(self, encode: Callable[[str], bytes], limit: int = CACHE_WORDS):
        super().__init__({"": b""})
        self.encode, self.limit = encode, limit

    def __missing__(self, word: str) -> bytes:
        core = word.rstrip(MARKS)
        if len(core) < len(word) and plain_letters(core):
            ids = self[core] + self[word[len(core) :]]
        elif word.isascii() and word.isalpha() and not word.islower():
            return self[word.lower()]
        else:
            ids = self.encode(word)
        if len(word) <= 40:
            if len(self) >= self.limit:
                self.clear()
                self[""] = b""
            self[word] = ids
        return ids


#: Signs that end a run of letters and form a run of their own.
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Normalizer and pre-tokenizer of the tokenizers whose words of letters go to the model directly.
LOWER_CASE = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
LETTER_RUNS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def plain_letters(word: str) -> bool:
    """Whether ``word`` is Latin-1 letters only: lower-cased one by one, never composed, one run."""
    return word.isalpha() and (word.isascii() or max(word) < "\u0100")


def byte_characters() -> list[str]:
    """The character that byte-level tokenizers write for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


def word_encoder(tokenizer) -> Callable[[str], bytes]:
    """Ids of one word. A word of plain letters goes to the tokenizer's model directly, if its normalizer and
    pre-tokenizer would only lower-case it and write its bytes as characters; others take every step."""
    made = json.loads(tokenizer.to_str())
    cuts = (made["pre_tokenizer"] or {}).get("pretokenizers", [{}, {}])
    direct = (
        (made["normalizer"] or {}).get("normalizers") == LOWER_CASE
        and [c.get("type") for c in cuts] == ["Split", "ByteLevel"]
        and cuts[0]["pattern"] == {"Regex": LETTER_RUNS}
        and cuts[0]["invert"]
        and not cuts[1]["add_prefix_space"] | cuts[1]["use_regex"]
        and not made["post_processor"]
        and all(not plain_letters(t["content"]) and "<" in t["content"] for t in made["added_tokens"])
    )
    model, shown = tokenizer.model, byte_characters()

    def encode(word: str) -> bytes:
        if direct and plain_letters(word):
            low = word.lower()
            if not low.isascii():
                low = "".join([shown[b] for b in low.encode()])
            ids = [t.id for t in model.tokenize(low)]
        else:
            ids = tokenizer.encode(word, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    return encode


@lru_cache(maxsize=2)
def lower_word_ids(path: str) -> Callable[[str], bytes]:
    """Little-endian 32-bit ids of a whole text by a tokenizer that lower-cases and drops white
    space; kept by the worker from task to task."""
    words = WordIds(word_encoder(load_tokenizer(path)))
    return lambda text: b"".join(map(words.__getitem__, text.replace("\n", " ").split(" ")))


def cut_pieces(
    documents: DataFrame,
    encoder: Callable[[], Callable[[str], bytes]],
    width: int,
    end_id: int,
    capacity: int,
    with_ids: bool,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``) of the pieces of every document.
    ``encoder`` makes, on a worker, the function from a text to its ids of ``width`` bytes each."""
    end, step = end_id.to_bytes(width, "little"), capacity * width

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()
        for part, texts in text_blocks(batches, "text"):
            rows, pieces, starts, lengths, sums, ids = [], [], [], [], [], []
            for row, text in enumerate(texts):
                whole = encode(text) + end
                for piece, at in enumerate(range(0, len(whole), step)):
                    own = whole[at : at + step]
                    rows.append(row)
                    pieces.append(piece)
                    starts.append(at // width)
                    lengths.append(len(own) // width)
                    sums.append(zlib.crc32(own))
                    if with_ids:
                        ids.append(own)
            columns = [part.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(pieces, pa.int32())]
            columns += [pa.array(x, pa.int64()) for x in (starts, lengths, sums)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns, names = [*columns, pa.array(ids, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return rows.mapInArrow(cut, shape)


class CapacityTree:
    """A segment tree over remaining capacities: which of them some open bin has."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.open = [False] * (2 * self.size)

    def put(self, remaining: int, is_open: bool) -> None:
        node = remaining + self.size
        self.open[node] = is_open
        while node > 1:
            node //= 2
            self.open[node] = self.open[2 * node] or self.open[2 * node + 1]

    def tightest(self, length: int) -> int | None:
        """The smallest remaining capacity of an open bin that is at least ``length``."""
        node = length + self.size
        if self.open[node]:
            return length
        while node > 1 and not (node % 2 == 0 and self.open[node + 1]):
            node //= 2
        if node <= 1:
            return None
        node += 1
        while node < self.size:
            node = 2 * node if self.open[2 * node] else 2 * node + 1
        return node - self.size


def best_fit_runs(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over ``counts`` (pieces by length). Runs ``(length, first piece, pieces,
    first bin, pieces per bin, offset)``; the same packing as placing one piece after the other."""
    tree, groups = CapacityTree(capacity), {}
    runs, bins = [], 0

    def add(remaining: int, first: int, number: int) -> None:
        if number and remaining:
            if not groups.setdefault(remaining, []):
                tree.put(remaining, True)
            groups[remaining].append((first, number))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room, first = capacity, bins
                number = -(-left // (capacity // length))
                bins += number
            else:
                first, number = groups[room].pop()
                if not groups[room]:
                    tree.put(room, False)
            each = room // length
            full, rest = min(number, left // each), 0
            if full < number:
                rest = left - full * each
            runs.append((length, rank, full * each + rest, first, each, capacity - room))
            add(room - each * length, first, full)
            if full < number:
                add(room - rest * length, first + full, 1) if rest else None
                add(room, first + full + bool(rest), number - full - bool(rest))
            rank += full * each + rest
            left -= full * each + rest
    return runs


def assign_sequences(pieces: DataFrame, capacity: int, order: list[str]) -> DataFrame:
    """``pieces`` (a stored table) with ``sequence_id`` and ``offset``.

    The driver sees the number of pieces of each length (at most ``capacity`` rows). A hot length
    is dealt over as many salts as keep a group below a thousandth of all pieces (at least 256, at
    most a million rows). The runs are broadcast: their number depends on ``capacity`` alone.
    """
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    target = min(max(sum(counts.values()) // 1000, 256), 1_000_000)
    salts = spark.createDataFrame(
        [(length, -(-n // target)) for length, n in counts.items()], "length long, salts long"
    )
    runs = spark.createDataFrame(
        best_fit_runs(counts, capacity),
        "length long, rank_from long, run_pieces long, bin_from long, per_bin long, offset_from long",
    ).withColumnRenamed("length", "run_length")
    salted = pieces.join(F.broadcast(salts), "length").withColumn(
        "salt", F.pmod(F.xxhash64(*order), F.col("salts"))
    )
    sizes = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    within = Window.partitionBy("length", "salt").orderBy(*order)
    ranked = (
        salted.withColumn("rank", F.row_number().over(within) - 1)
        .join(offsets, ["length", "salt"])
        .withColumn("rank", F.col("rank") + F.col("ahead"))
    )
    own = (F.col("length") == F.col("run_length")) & F.col("rank").between(
        F.col("rank_from"), F.col("rank_from") + F.col("run_pieces") - 1
    )
    at = F.col("rank") - F.col("rank_from")
    return ranked.join(F.broadcast(runs), own).select(
        *pieces.columns,
        (F.col("bin_from") + F.floor(at / F.col("per_bin"))).cast("long").alias("sequence_id"),
        (F.col("offset_from") + (at % F.col("per_bin")) * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(
    documents: DataFrame,
    capacity: int = 2048,
    tokenizer_path: str | None = None,
    end_id: int = 0,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` (and the
    piece's ``ids`` as little-endian 32-bit numbers, if asked for).

    ``documents`` needs ``doc_id`` and ``text``; other columns are not read. A null or empty text is
    the end id alone. Only documents above ``capacity`` tokens are cut. Repeated rows are packed
    each; an empty table gives an empty result. ``tokenizer_path`` names the file of a tokenizer
    that lower-cases and drops white space, readable by every executor.
    """
    path = tokenizer_path or public_tokenizers.path("word_bpe_49k.json")
    pieces = cut_pieces(documents, lambda: lower_word_ids(path), 4, end_id, capacity, with_ids)
    stored = settle(pieces, "pieces")
    return assign_sequences(stored, capacity, ["doc_id", "piece", "ids_crc32"])
