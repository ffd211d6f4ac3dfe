"""Language of a text by a bidirectional gated recurrent network over bytes.

The network is trained here, in numpy, by backpropagation through time. A text is cut into spans of
``SPAN`` bytes; in each span one recurrence runs forwards and one backwards, every byte gets a
probability for each language from both states, and the document's probability is their mean
over all its bytes. Scoring runs all spans of a block of documents side by side.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import bounded_sample, text_blocks

#: Bytes a state is carried over, and the symbol after a span's end.
SPAN = 64
END = 256
UNKNOWN = "und"
#: Bounds of the training sample: documents, and spans taken from each (spread over its length).
SAMPLE_ROWS = 3_000
SPANS_PER_TEXT = 6


@dataclass
class Network:
    """Weights; the first axis of ``inputs``, ``recurrent`` and ``bias`` is the direction.

    Gates are in the order update, reset, candidate. ``inputs`` holds the contribution of every
    symbol to the three gates."""

    labels: list[str]
    inputs: np.ndarray  # 2, symbols, 3 h
    recurrent: np.ndarray  # 2, h, 3 h
    bias: np.ndarray  # 2, 3 h
    output: np.ndarray  # 2 h, labels
    output_bias: np.ndarray  # labels

    @property
    def width(self) -> int:
        return self.recurrent.shape[1]

    def weights(self) -> list[np.ndarray]:
        return [self.inputs, self.recurrent, self.bias, self.output, self.output_bias]


def new_network(labels: list[str], width: int, seed: int) -> Network:
    rng = np.random.default_rng(seed)

    def draw(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    return Network(
        labels,
        draw(2, 257, 3 * width, scale=0.3),
        draw(2, width, 3 * width, scale=0.5 / np.sqrt(width)),
        np.zeros((2, 3 * width), np.float32),
        draw(2 * width, len(labels), scale=0.3),
        np.zeros(len(labels), np.float32),
    )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def gradients(net: Network, spans: np.ndarray, targets: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean loss per byte and its gradient by every weight: backpropagation through time."""
    n, length = spans.shape
    h = net.width
    symbols = np.stack([spans, spans[:, ::-1]])  # direction, span, step
    states = np.zeros((2, length + 1, n, h), np.float32)
    kept = []
    for t in range(length):
        before = states[:, t]
        own = np.stack([net.inputs[d][symbols[d, :, t]] for d in range(2)]) + net.bias[:, None]
        past = before @ net.recurrent
        z, r = _sigmoid(own[..., :h] + past[..., :h]), _sigmoid(own[..., h : 2 * h] + past[..., h : 2 * h])
        c = np.tanh(own[..., 2 * h :] + r * past[..., 2 * h :])
        states[:, t + 1] = before + z * (c - before)
        kept.append((z, r, c, past[..., 2 * h :]))
    both = np.concatenate([states[0, 1:], states[1, :0:-1]], axis=-1)  # step, span, 2 h
    logits = both @ net.output + net.output_bias
    logits -= logits.max(axis=-1, keepdims=True)
    probs = np.exp(logits)
    probs /= probs.sum(axis=-1, keepdims=True)
    real = (spans != END).T.astype(np.float32)
    count = real.sum()
    steps, rows = np.indices(real.shape)
    loss = -(np.log(probs[steps, rows, targets[None, :]] + 1e-9) * real).sum() / count
    probs[steps, rows, targets[None, :]] -= 1
    d_logits = probs * (real / count)[..., None]
    d_output = np.tensordot(both, d_logits, axes=([0, 1], [0, 1]))
    d_both = d_logits @ net.output.T
    d_states = np.stack([d_both[..., :h], d_both[::-1, :, h:]])  # direction, step, span, h
    d_inputs, d_recurrent = np.zeros_like(net.inputs), np.zeros_like(net.recurrent)
    d_bias = np.zeros_like(net.bias)
    carried = np.zeros((2, n, h), np.float32)
    for t in reversed(range(length)):
        z, r, c, past = kept[t]
        before = states[:, t]
        d = d_states[:, t] + carried
        d_c = d * z * (1 - c * c)
        d_z = d * (c - before) * z * (1 - z)
        d_r = d_c * past * r * (1 - r)
        d_past = np.concatenate([d_z, d_r, d_c * r], axis=-1)
        d_own = np.concatenate([d_z, d_r, d_c], axis=-1)
        d_recurrent += before.transpose(0, 2, 1) @ d_past
        d_bias += d_own.sum(axis=1)
        for direction in range(2):
            np.add.at(d_inputs[direction], symbols[direction, :, t], d_own[direction])
        carried = d * (1 - z) + d_past @ net.recurrent.transpose(0, 2, 1)
    return float(loss), [d_inputs, d_recurrent, d_bias, d_output, d_logits.sum(axis=(0, 1))]


def train(
    spans: np.ndarray, targets: np.ndarray, labels: list[str],
    width: int = 8, steps: int = 350, batch: int = 192, rate: float = 0.02, seed: int = 7,
) -> Network:
    """Adam on random batches with equal shares of all languages."""
    net, rng = new_network(labels, width, seed), np.random.default_rng(seed)
    first = [np.zeros_like(w) for w in net.weights()]
    second = [np.zeros_like(w) for w in net.weights()]
    groups = [np.flatnonzero(targets == k) for k in range(len(labels))]
    for step in range(1, steps + 1):
        own = np.concatenate([rng.choice(g, -(-batch // len(groups))) for g in groups])
        _, grads = gradients(net, spans[own], targets[own])
        scale = min(1.0, 2.0 / (np.sqrt(sum(float((g * g).sum()) for g in grads)) + 1e-9))
        now = rate * (1 - (step - 1) / steps) + 1e-4
        for w, g, m, v in zip(net.weights(), grads, first, second, strict=True):
            g = g * scale
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= (now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def cut_spans(data: bytes, span: int = SPAN) -> np.ndarray:
    """All bytes as rows of ``span`` symbols; the last row is filled up with ``END``."""
    rows = -(-len(data) // span)
    spans = np.full(rows * span, END, np.int16)
    spans[: len(data)] = np.frombuffer(data, np.uint8)
    return spans.reshape(rows, span)


class Scorer:
    """The trained network as tables that make a step of the recurrence few array operations."""

    def __init__(self, net: Network, rows: int = 2_048):
        self.net, self.rows, h = net, rows, net.width
        halved = np.ones(3 * h, np.float32)
        halved[: 2 * h] = 0.5  # sigmoid(x) = tanh(x / 2) / 2 + 1 / 2
        self.inputs = ((net.inputs + net.bias[:, None]) * halved).astype(np.float32)
        self.recurrent = (net.recurrent * halved).astype(np.float32)

    def span_sums(self, spans: np.ndarray) -> np.ndarray:
        """Sum of the label probabilities over the bytes of every span."""
        parts = [self._sums(spans[i : i + self.rows]) for i in range(0, len(spans), self.rows)]
        return np.concatenate(parts) if parts else np.zeros((0, len(self.net.labels)), np.float32)

    def _sums(self, spans: np.ndarray) -> np.ndarray:
        (n, length), h, labels = spans.shape, self.net.width, len(self.net.labels)
        by_step = np.ascontiguousarray(spans.T).astype(np.intp)
        logits = np.empty((2, length, n, labels), np.float32)
        state = np.zeros((2, n, h), np.float32)
        own, past = np.empty((2, n, 3 * h), np.float32), np.empty((2, n, 3 * h), np.float32)
        for t in range(length):
            for d in range(2):
                np.take(self.inputs[d], by_step[t if d == 0 else length - 1 - t], axis=0, out=own[d], mode="clip")
                np.dot(state[d], self.recurrent[d], out=past[d])
            gates = own[..., : 2 * h] + past[..., : 2 * h]
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            fresh = past[..., 2 * h :]
            fresh *= gates[..., h:]
            fresh += own[..., 2 * h :]
            new = np.tanh(fresh)
            new -= state
            new *= gates[..., :h]
            state += new
            for d in range(2):
                np.dot(
                    state[d], self.net.output[d * h : (d + 1) * h],
                    out=logits[d, t if d == 0 else length - 1 - t],
                )
        total = logits[0]
        total += logits[1]
        total += self.net.output_bias
        np.exp(total, out=total)
        total /= total @ np.ones((labels, 1), np.float32)
        total *= (by_step != END)[..., None]
        return total.sum(axis=0)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def fit(documents: DataFrame, sample_rows: int = SAMPLE_ROWS, width: int = 8, steps: int = 350) -> Network | None:
    """Train on a bounded sample of ``text`` and ``lang``; null if no row has both. A sample holds at most
    ``sample_rows`` rows and ``SPANS_PER_TEXT`` spans of each, so its size does not follow the table's."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_blocks(batches, "text"):
            taken = []
            for text in texts:
                spans = cut_spans(text.encode("utf-8", "replace"))
                rows = np.unique(np.linspace(0, len(spans) - 1, SPANS_PER_TEXT).astype(int)) if len(spans) else []
                taken.append(spans[rows].astype("<i2").tobytes())
            yield pa.RecordBatch.from_arrays(
                [part.column("lang"), pa.array(taken, pa.binary())], names=["lang", "spans"]
            )

    usable = documents.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("text", "lang")
    rows = bounded_sample(usable, sample_rows, seed=5).mapInArrow(spread, "lang string, spans binary").collect()
    if not rows:
        return None
    labels = sorted({r.lang for r in rows})
    spans = [np.frombuffer(r.spans, "<i2").reshape(-1, SPAN) for r in rows]
    targets = np.concatenate([np.full(len(s), labels.index(r.lang)) for s, r in zip(spans, rows, strict=True)])
    if len(labels) == 1:
        steps = 1  # nothing to tell apart
    return train(np.concatenate(spans), targets, labels, width=width, steps=steps)


def predict(
    documents: DataFrame, net: Network | None, pred_as: str = "lang_pred", score_as: str = "score"
) -> DataFrame:
    """``lang_pred, score`` (under the names given) beside all columns of ``documents``, which needs
    ``text`` as a string.

    ``lang_pred`` is ``und`` with score 0 if the text is null or has no letter, or if there is no network."""
    sent = documents.sparkSession.sparkContext.broadcast(net)
    names = documents.columns

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value) if sent.value else None
        for part, texts in text_blocks(batches, "text", 1_000_000):
            spans = [
                cut_spans(t.encode("utf-8", "replace")) if scorer and has_letter(t) else np.zeros((0, SPAN), np.int16)
                for t in texts
            ]
            guesses, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if any(map(len, spans)):
                sums = scorer.span_sums(np.concatenate(spans)).astype(np.float64)
                ends = np.cumsum([len(s) for s in spans])
                for i, (end, own) in enumerate(zip(ends, spans, strict=True)):
                    if len(own):
                        probs = sums[end - len(own) : end].sum(axis=0)
                        best = int(probs.argmax())
                        guesses[i], scores[i] = sent.value.labels[best], probs[best] / probs.sum()
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(guesses, pa.string()), pa.array(scores)],
                names=[*names, pred_as, score_as],
            )

    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema.fields)
    return documents.mapInArrow(score, f"{shape}, `{pred_as}` string, `{score_as}` double")
