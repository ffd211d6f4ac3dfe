"""Token counts by a two-tier lookup inside each task.

The first tier is a compact table of frequent words and their numbers of tokens, broadcast to all
executors. Words outside it go to a cache that a worker fills by calling the tokenizer. No word
is ever shuffled. The first tier only saves work: counts are the same with any table, or none.

A text is cut at single blanks. For the byte-level pre-tokenizer a cut before a blank is always a
boundary between pre-tokens unless the blank touches other white space, so a word with its leading
blank is a run of whole pre-tokens. Texts in which a blank is followed by white space are
encoded whole by the library.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import bounded_sample, text_blocks

#: Bounds of the first tier: rows of the sample it is counted on, words kept, characters of a word.
SAMPLE_ROWS = 2_000
TABLE_WORDS = 50_000
WORD_CHARS = 40
#: Words a worker keeps beside the first tier before it starts afresh.
CACHE_WORDS = 600_000

_TOUCHING = re.compile(r" (?=\s)")


@lru_cache(maxsize=4)
def load_tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class WordValues(dict):
    """What a word with the given prefix is encoded to, as a value that adds up over words: its
    number of tokens, or its ids as bytes. A missing word is encoded when first asked for."""

    def __init__(self, encode: Callable, prefix: str, first: dict, limit: int):
        super().__init__(first)
        self.encode, self.prefix, self.first, self.limit = encode, prefix, first, limit
        self.bare: WordValues = self

    def __missing__(self, word: str):
        head, line, tail = word.partition("\n")
        if line and head and tail and head[-1].isalnum() | (head[-1] in ".,!?") and tail[0].isalpha():
            # letters, a line break, letters: three runs of pre-tokens; not worth keeping as one
            return self[head] + self.bare["\n"] + self.bare[tail]
        if len(word) > 1 and word[-1] in ".," and word[-2].isalpha() and "\n" not in word and "<|" not in word:
            return self[word[:-1]] + self.bare[word[-1]]
        n = self.encode(self.prefix + word)
        if len(word) <= WORD_CHARS:
            if len(self) >= self.limit + len(self.first):
                self.clear()
                self.update(self.first)
            self[word] = n
        return n


@lru_cache(maxsize=2)
def _worker_counts(path: str, words: bytes, lengths: bytes, limit: int):
    """Kept by the worker from task to task."""
    tokenizer = load_tokenizer(path)

    def encode(text: str) -> int:
        return len(tokenizer.encode(text, add_special_tokens=False))

    first = dict(zip(words.decode().split(" "), lengths, strict=True)) if lengths else {}
    spaced = WordValues(encode, " ", first, limit)
    spaced.bare = WordValues(encode, "", {}, limit // 4)
    return encode, spaced


def count_text(text: str, encode: Callable[[str], int], spaced: WordValues) -> int:
    if not text:
        return 0
    if _TOUCHING.search(text):
        return encode(text)
    first, *rest = text.split(" ")
    return spaced.bare[first] + sum(map(spaced.__getitem__, rest)) if first else encode(text)


def frequent_words(documents: DataFrame, text: str, path: str, sample_rows: int, size: int) -> tuple[bytes, bytes]:
    """The first tier: at most ``size`` words of at most ``WORD_CHARS`` characters, joined by
    blanks, and one byte for the tokens of each. Counted on a bounded sample in one task, so no
    word is shuffled; the driver receives the table alone."""

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for _, texts in text_blocks(batches, text):
            for t in texts:
                seen.update(t.split(" "))
            if len(seen) > 20 * size:
                seen = Counter(dict(seen.most_common(10 * size)))
        encode, spaced = _worker_counts(path, b"", b"", size)
        words = [w for w, _ in seen.most_common(2 * size) if 0 < len(w) <= WORD_CHARS and "\n" not in w][:size]
        counted = [(w, n) for w in words if (n := spaced[w]) < 256]
        yield pa.RecordBatch.from_pydict(
            {"words": [" ".join(w for w, _ in counted).encode()], "lengths": [bytes(n for _, n in counted)]}
        )

    sample = bounded_sample(documents.select(text), sample_rows, seed=11).coalesce(1)
    rows = sample.mapInArrow(top, "words binary, lengths binary").collect()
    return (bytes(rows[0].words), bytes(rows[0].lengths)) if rows else (b"", b"")


def count_tokens(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    tokenizer_path: str | None = None,
    max_tokens: int = 1024,
    sample_rows: int = SAMPLE_ROWS,
    table_words: int = TABLE_WORDS,
    cache_words: int = CACHE_WORDS,
) -> DataFrame:
    """One row per input row: ``doc_id, n_bytes, n_tokens, over_limit``.

    ``tokenizer_path`` names a byte-level tokenizer file that every executor can read. A null or
    empty text has no bytes and no tokens. Repeated rows are counted each; other columns are not
    read, so clashing names do no harm. An empty table gives an empty result. Strings of special
    tokens inside a text count as the library counts them by default.
    """
    path = tokenizer_path or public_tokenizers.path("byte_bpe_50k.json")
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    table = documents.sparkSession.sparkContext.broadcast(
        frequent_words(rows, "text", path, sample_rows, table_words)
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, spaced = _worker_counts(path, *table.value, cache_words)
        for part, texts in text_blocks(batches, "text"):
            sizes = pc.fill_null(pc.binary_length(part.column("text")), 0)
            tokens = [count_text(t, encode, spaced) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), sizes.cast(pa.int64()), pa.array(tokens, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    counted = rows.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > max_tokens)
