"""Document quality from a linear-chain conditional random field over lines.

Every line is labelled good or bad from its own features and those of the lines before and after it;
transition weights tie neighbours together. Forward-backward gives each line's probability of
being good, and the document's score is their mean weighted by line length, put on the scale of the
labels by a logistic fit. A document's label is taken as the label of each of its lines for training.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import bounded_sample, text_blocks

#: Bounds of the training sample: labelled documents, and lines of each (its runs of lines are spread).
SAMPLE_ROWS = 2_000
LINES_PER_TEXT = 40
#: Characters counted as symbols; letters and digits of any script are told by the string methods.
SYMBOLS = "#$%&*+/<=>@\\^_`{|}~"
FEATURES = (
    "bias", "length", "words", "word_length", "letters", "upper", "digits", "symbols", "bars", "exclamations",
    "distinct", "next_same", "ends", "starts_upper", "seen_before", "empty",
)


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features of every line of a text (lines x features) and their lengths in characters."""
    rows, lengths, seen = [], [], set()
    for line in text.split("\n"):
        n = len(line)
        words = line.split()
        k = len(words)
        if not k:
            rows.append((1.0,) + (0.0,) * (len(FEATURES) - 2) + (1.0,))
            lengths.append(n)
            continue
        glued = "".join(words)
        size = len(glued)
        upper = sum(map(str.isupper, words)) / k
        marks = sum(map(glued.count, SYMBOLS))
        letters = sum(map(str.isalpha, words)) / k
        rows.append(
            (
                1.0,
                min(np.log1p(n) / 6.0, 2.0),
                min(np.log1p(k) / 4.0, 2.0),
                min(size / k / 10.0, 3.0),
                letters,
                upper,
                min(1.0, 5 * sum(map(glued.count, "0123456789")) / size),
                min(1.0, 5 * marks / size),
                min(1.0, 4 * glued.count("|") / k),
                min(1.0, 2 * glued.count("!") / k),
                len(set(words)) / k,
                sum(map(str.__eq__, words, words[1:])) / k,
                1.0 if words[-1][-1] in ".!?:;\"'" else 0.0,
                1.0 if words[0][:1].isupper() else 0.0,
                1.0 if line in seen else 0.0,
                0.0,
            )
        )
        lengths.append(n)
        seen.add(line)
    return np.array(rows, np.float64), np.array(lengths, np.float64)


def with_neighbours(rows: np.ndarray) -> np.ndarray:
    """Own features beside those of the line before and the line after (zeros at the ends)."""
    before, after = np.zeros_like(rows), np.zeros_like(rows)
    before[1:], after[:-1] = rows[:-1], rows[1:]
    return np.concatenate([rows, before, after], axis=1)


@dataclass
class Field:
    """``unary`` scores good against bad; ``links[a, b]`` scores label b after label a (0 bad, 1 good).
    ``slope`` and ``shift`` put the weighted mean of the marginals on the scale of the labels."""

    unary: np.ndarray
    links: np.ndarray
    slope: float = 1.0
    shift: float = 0.0


def marginals(scores: np.ndarray, ends: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over many sequences at once. ``scores``: per line, good against bad;
    ``ends``: end of every sequence (none empty). Returns the probability of good for every line and
    the expected number of each transition."""
    starts = np.concatenate([[0], ends[:-1]])
    sizes = ends - starts
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    emit = np.stack([np.zeros_like(scores), scores], axis=1)
    alpha, beta = np.zeros_like(emit), np.zeros_like(emit)
    # sequences are ordered by size, so those that reach step t come first
    alpha[starts] = emit[starts]
    longest = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(longest), side="left")  # sequences longer than t
    for t in range(1, longest):
        own = starts[: active[t]] + t
        previous = alpha[own - 1]
        alpha[own] = emit[own] + np.logaddexp(previous[:, :1] + links[0], previous[:, 1:] + links[1])
    for t in range(longest - 2, -1, -1):
        own = starts[: active[t + 1]] + t
        following = beta[own + 1] + emit[own + 1]
        beta[own] = np.logaddexp(following[:, :1] + links[:, 0], following[:, 1:] + links[:, 1])
    both = alpha + beta
    good = 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -500, 500)))
    inner = np.ones(len(scores), bool)
    inner[starts] = False
    at = np.flatnonzero(inner)
    total = np.logaddexp(both[:, 0], both[:, 1])[at]
    expected = np.zeros((2, 2))
    for a in range(2):
        for b in range(2):
            expected[a, b] = np.exp(alpha[at - 1, a] + links[a, b] + emit[at, b] + beta[at, b] - total).sum()
    return good, expected


def fit_field(texts: list[np.ndarray], sizes: list[np.ndarray], labels: np.ndarray, steps: int = 120) -> Field:
    """Maximise the likelihood of the line labels by Adam."""
    lines, ends = np.concatenate([with_neighbours(t) for t in texts]), np.cumsum([len(t) for t in texts])
    counts = np.diff(np.concatenate([[0], ends]))
    truth = np.repeat(labels, counts).astype(np.float64)
    inner = np.ones(len(truth), bool)
    inner[ends - counts] = False
    at = np.flatnonzero(inner)
    observed = np.zeros((2, 2))
    for label in (0, 1):
        observed[label, label] = (truth[at] == label).sum()
    field = Field(np.zeros(lines.shape[1]), np.zeros((2, 2)))
    weights = [field.unary, field.links]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, steps + 1):
        good, expected = marginals(lines @ field.unary, ends, field.links)
        grads = [
            lines.T @ (truth - good) / len(truth) - 1e-4 * field.unary,
            (observed - expected) / len(truth) - 1e-3 * field.links,
        ]
        for w, g, m, v in zip(weights, grads, first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    means = document_means(field, lines, ends, np.concatenate(sizes))
    field.slope, field.shift = _logistic(means, labels)
    return field


def document_means(field: Field, lines: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Mean probability of good per document, weighted by line length; lines without characters count
    as one character."""
    good, _ = marginals(lines @ field.unary, ends, field.links)
    weight = np.maximum(sizes, 1.0)
    starts = np.concatenate([[0], ends[:-1]])
    return np.add.reduceat(good * weight, starts) / np.add.reduceat(weight, starts)


def _logistic(means: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve from the log-odds of the means to the labels, by
    Newton steps on a lightly penalised likelihood."""
    x = np.stack([_log_odds(means), np.ones(len(means))], axis=1)
    w = np.zeros(2)
    for _ in range(25):
        p = 1 / (1 + np.exp(-x @ w))
        slope = x.T @ (labels - p) - 0.1 * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2)
        w = w + np.linalg.solve(curve, slope)
    return float(max(w[0], 1e-3)), float(w[1])


def _log_odds(means: np.ndarray) -> np.ndarray:
    p = np.clip(means, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def final_scores(field: Field, means: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-(field.slope * _log_odds(means) + field.shift)))


def fit(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Field | None:
    """Train on the ``text`` of a bounded sample of ``labels`` (``doc_id`` and ``quality``, 0 or 1); null if one
    of both is missing. The sample has at most ``sample_rows`` rows, so it can be broadcast. At most
    ``LINES_PER_TEXT`` neighbouring lines of a document are taken, from a place that depends on its text."""

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_blocks(batches, "text"):
            taken, lengths = [], []
            for text in texts:
                rows, sizes = line_features(text)
                begin = (len(text) * 7919) % max(1, len(rows) - LINES_PER_TEXT + 1)
                taken.append(rows[begin : begin + LINES_PER_TEXT].tobytes())
                lengths.append(sizes[begin : begin + LINES_PER_TEXT].tobytes())
            yield pa.RecordBatch.from_arrays(
                [part.column("quality"), pa.array(taken, pa.binary()), pa.array(lengths, pa.binary())],
                names=["quality", "rows", "sizes"],
            )

    known = labels.where(F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").cast("int").alias("quality"))
    sample = bounded_sample(known.dropDuplicates(["doc_id"]), sample_rows, seed=3)
    usable = documents.where(F.col("text").isNotNull()).select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    shape = "quality int, rows binary, sizes binary"
    found = usable.select("text", "quality").mapInArrow(prepare, shape).collect()
    labels = np.array([r.quality for r in found], np.float64)
    if len(set(labels)) < 2:
        return None
    texts = [np.frombuffer(r.rows).reshape(-1, len(FEATURES)) for r in found]
    return fit_field(texts, [np.frombuffer(r.sizes) for r in found], labels)


def score(documents: DataFrame, field: Field | None, score_as: str = "score") -> DataFrame:
    """``score`` (under the name given) beside all columns of ``documents``, which needs ``text`` as a string: 0 to
    1, the higher the likelier good. Null and empty texts are a single empty line; without a model
    every score is 0.5."""
    sent = documents.sparkSession.sparkContext.broadcast(field)
    names = documents.columns

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for part, texts in text_blocks(batches, "text"):
            scores = np.full(len(texts), 0.5)
            if own is not None and texts:
                made = [line_features(t) for t in texts]
                lines = np.concatenate([with_neighbours(rows) for rows, _ in made])
                ends = np.cumsum([len(rows) for rows, _ in made])
                scores = final_scores(own, document_means(own, lines, ends, np.concatenate([s for _, s in made])))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores)], names=[*names, score_as])

    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema.fields)
    return documents.mapInArrow(judge, f"{shape}, `{score_as}` double")
