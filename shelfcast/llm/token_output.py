"""Packed token ids as fixed-width binary rows.

Documents become ids, overlong ones are cut without loss, pieces are packed by best-fit decreasing, and
every sequence is written as one row of the id matrix with the cumulative lengths of its segments
and the places where positions restart. Tasks pack what they read, so ids are never shuffled;
`packing.py` packs a whole corpus at once, from lengths alone.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import text_blocks
from shelfcast.llm.packing import CapacityTree
from shelfcast.llm.tokens import CACHE_WORDS, _TOUCHING, WordValues
from shelfcast.session import settle

#: Bytes of an id: the vocabulary has 50,257 ids with the end of text.
WIDTH = 2
END_OF_TEXT = 50256
#: Tokens a task holds before it packs them: 8 MB of ids.
WINDOW_TOKENS = 4_000_000
COLUMNS = ["sequence_id", "n_tokens", "input_ids", "cu_seqlens", "position_resets", "doc_ids", "pieces"]


@lru_cache(maxsize=2)
def byte_level_ids(path: str) -> Callable[[str], bytes]:
    """Little-endian 16-bit ids of a whole text; kept by the worker from task to task."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    coder = tiktoken.Encoding(
        "byte level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )

    def encode(text: str) -> bytes:
        return np.array(coder.encode_ordinary(text), "<u2").tobytes()

    spaced = WordValues(encode, " ", {}, CACHE_WORDS)
    spaced.bare = WordValues(encode, "", {"": b""}, CACHE_WORDS // 4)

    def ids(text: str) -> bytes:
        if not text or text[0] == " " or _TOUCHING.search(text):
            return encode(text)
        first, *rest = text.split(" ")
        return spaced.bare[first] + b"".join(map(spaced.__getitem__, rest))

    return ids


def place_pieces(lengths: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: every piece, the longest first, goes to the open bin with the least room
    that still holds it, found in a segment tree over remaining capacities. Returns the pieces of
    every bin in the order they were placed."""
    tree, rooms, bins = CapacityTree(capacity), [[] for _ in range(capacity + 1)], []
    for piece in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        room = tree.tightest(lengths[piece])
        if room is None:
            room, own = capacity, len(bins)
            bins.append([])
        else:
            own = rooms[room].pop()
            if not rooms[room]:
                tree.put(room, False)
        bins[own].append(piece)
        left = room - lengths[piece]
        if left:
            if not rooms[left]:
                tree.put(left, True)
            rooms[left].append(own)
    return bins


def write_packed_ids(
    documents: DataFrame,
    capacity: int = 2048,
    tokenizer_path: str | None = None,
    pad_id: int = END_OF_TEXT,
    window_tokens: int = WINDOW_TOKENS,
) -> DataFrame:
    """Write the id matrix to the shared folder and return it, one row per sequence:
    ``sequence_id, n_tokens, input_ids`` (``capacity`` little-endian 16-bit ids, padded at the end),
    ``cu_seqlens`` (0 and the end of every segment), ``position_resets`` (where positions restart
    at 0), ``doc_ids`` and ``pieces`` of the segments.

    A task packs its documents in windows of about ``window_tokens`` tokens, so its memory is bounded, nothing is
    shuffled, and a lost task is simply run again. Each window leaves at most a few bins partly open. ``documents`` needs
    ``doc_id`` and ``text``; other columns are not read. Every document ends with the end-of-text id, so a
    null or empty text is that id alone. Only documents above ``capacity`` tokens are cut, without
    loss. Repeated rows are written each; an empty table gives an empty matrix.
    """
    path = tokenizer_path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    rows = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    padding, end, step = pad_id.to_bytes(WIDTH, "little"), END_OF_TEXT.to_bytes(WIDTH, "little"), capacity * WIDTH
    kind = rows.schema["doc_id"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_level_ids(path)
        number = TaskContext.get().partitionId() << 33
        held: list[tuple[object, int, bytes]] = []
        size, doc_kind = 0, None

        def flush() -> pa.RecordBatch:
            nonlocal number
            bins = place_pieces([len(ids) // WIDTH for _, _, ids in held], capacity)
            ends = [list(accumulate((len(held[i][2]) // WIDTH for i in own), initial=0)) for own in bins]
            ids = [b"".join(held[i][2] for i in own) for own in bins]
            columns = [
                pa.array(range(number, number + len(bins)), pa.int64()),
                pa.array([e[-1] for e in ends], pa.int32()),
                pa.array([x + padding * (capacity - len(x) // WIDTH) for x in ids], pa.binary()),
                pa.array(ends, pa.list_(pa.int32())),
                pa.array([e[:-1] for e in ends], pa.list_(pa.int32())),
                pa.array([[held[i][0] for i in own] for own in bins], pa.list_(doc_kind)),
                pa.array([[held[i][1] for i in own] for own in bins], pa.list_(pa.int32())),
            ]
            number += len(bins)
            held.clear()
            return pa.RecordBatch.from_arrays(columns, names=COLUMNS)

        for part, texts in text_blocks(batches, "text"):
            doc_kind = part.schema.field("doc_id").type
            for doc, text in zip(part.column("doc_id").to_pylist(), texts, strict=True):
                whole = encode(text) + end
                for piece, at in enumerate(range(0, len(whole), step)):
                    held.append((doc, piece, whole[at : at + step]))
                size += len(whole) // WIDTH
                if size >= window_tokens:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    matrix = rows.mapInArrow(
        pack,
        "sequence_id long, n_tokens int, input_ids binary, cu_seqlens array<int>, "
        f"position_resets array<int>, doc_ids array<{kind}>, pieces array<int>",
    )
    return settle(matrix, "packed-ids", compression="zstd")


def read_rows(input_ids: bytes, cu_seqlens: list[int]) -> list[np.ndarray]:
    """The segments of one matrix row as arrays of ids."""
    ids = np.frombuffer(input_ids, "<u2")
    return [ids[a:b] for a, b in zip(cu_seqlens[:-1], cu_seqlens[1:], strict=True)]


def positions(cu_seqlens: list[int]) -> np.ndarray:
    """Position of every token of one row inside its segment."""
    return np.concatenate([np.arange(b - a) for a, b in zip(cu_seqlens[:-1], cu_seqlens[1:], strict=True)])


def digest(matrix: DataFrame) -> DataFrame:
    """The matrix with a checksum in place of the ids."""
    return matrix.select(
        "sequence_id", "n_tokens", F.crc32("input_ids").alias("ids_crc32"),
        "cu_seqlens", "position_resets", "doc_ids", "pieces",
    )
