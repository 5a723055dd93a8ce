"""Quality scores by a byte-level convolutional network in numpy.

Bytes are embedded, filters run over every text in steps of STRIDE bytes, their answers are
max-pooled over chunks that overlap by half and cover the whole text, and the mean and the maximum
over the chunks are combined into one probability.

The network is trained on a bounded sample of labelled rows (TRAIN_ROWS by a hash of the id, and of
each up to TRAIN_BYTES bytes in stretches spread over the whole text). Scoring covers whole texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, held_out
from .toxicity import sampled_labels

#: Bounds of the training sample: labelled rows, and bytes of each.
TRAIN_ROWS = 2400
TRAIN_BYTES = 4096
STRETCH = 1024
KERNEL, STRIDE, EMBED, FILTERS, HIDDEN = 12, 4, 6, 32, 16
#: Steps of a half chunk: two halves make a chunk of 512 bytes.
HALF = 64
#: Bytes of a text that are convolved at a time.
PIECE = HALF * STRIDE * 512
EPOCHS = 14
BATCH = 48
RATE = 0.006
THRESHOLD = 0.5


class Network:
    """Parameters by name; all arrays of 32-bit floats."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        normal = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        self.p = {
            "embed": normal(256, EMBED, scale=0.5),
            "filters": normal(KERNEL * EMBED, FILTERS, scale=(KERNEL * EMBED) ** -0.5),
            "filter_bias": np.zeros(FILTERS, np.float32),
            "hidden": normal(2 * FILTERS, HIDDEN, scale=(2 * FILTERS) ** -0.5),
            "hidden_bias": np.zeros(HIDDEN, np.float32),
            "out": normal(HIDDEN, scale=HIDDEN**-0.5),
            "out_bias": np.zeros(1, np.float32),
        }

    def windows(self, data: np.ndarray) -> np.ndarray:
        """Bytes of each step: one row of KERNEL bytes every STRIDE bytes, zeros at the end."""
        steps = max(1, -(-len(data) // STRIDE))
        padded = np.zeros((steps - 1) * STRIDE + KERNEL, np.uint8)
        padded[: min(len(data), len(padded))] = data[: len(padded)]
        return np.lib.stride_tricks.sliding_window_view(padded, KERNEL)[::STRIDE]

    def convolve(self, windows: np.ndarray) -> np.ndarray:
        x = self.p["embed"][windows].reshape(len(windows), KERNEL * EMBED)
        return x @ self.p["filters"] + self.p["filter_bias"]

    def pooled(self, text: np.ndarray) -> np.ndarray:
        """Mean and maximum over the chunks of the filters' largest answers."""
        halves = []
        for begin in range(0, max(1, len(text)), PIECE):  # a piece reads on into the next one
            windows = self.windows(text[begin : begin + PIECE + KERNEL])
            answers = self.convolve(windows[: max(1, -(-min(PIECE, len(text) - begin) // STRIDE))])
            halves.append(np.maximum.reduceat(answers, np.arange(0, len(answers), HALF)))
        half = np.concatenate(halves)
        chunks = np.maximum(np.maximum(half[:-1], half[1:]) if len(half) > 1 else half, 0)
        return np.concatenate([chunks.mean(0), chunks.max(0)])

    def head(self, pooled: np.ndarray) -> np.ndarray:
        hidden = np.maximum(pooled @ self.p["hidden"] + self.p["hidden_bias"], 0)
        return hidden @ self.p["out"] + self.p["out_bias"][0]

    def score(self, text: bytes) -> float:
        margin = float(self.head(self.pooled(np.frombuffer(text, np.uint8))))
        return float(1 / (1 + np.exp(-np.clip(margin, -30, 30))))

    def gradients(self, texts: list[np.ndarray], labels: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean logistic loss of some texts."""
        p, g = self.p, {k: np.zeros_like(v) for k, v in self.p.items()}
        windows = [self.windows(t) for t in texts]
        sizes = np.array([len(w) for w in windows])
        every = np.concatenate(windows)
        x = p["embed"][every].reshape(len(every), KERNEL * EMBED)
        answers = x @ p["filters"] + p["filter_bias"]
        ends = np.cumsum(sizes)
        pooled = np.zeros((len(texts), 2 * FILTERS), np.float32)
        kept: list[tuple] = []
        columns = np.arange(FILTERS)
        for i, (a, b) in enumerate(zip(ends - sizes, ends, strict=True)):
            heads = np.arange(a, b, HALF)
            bounds = [(h, min(h + 2 * HALF, b)) for h in (heads[:-1] if len(heads) > 1 else heads)]
            best = np.array([answers[s:e].argmax(0) + s for s, e in bounds])
            top = np.maximum(answers[best, columns], 0)
            peak = top.argmax(0)
            pooled[i] = np.concatenate([top.mean(0), top[peak, columns]])
            kept.append((best, top > 0, peak))
        before = pooled @ p["hidden"] + p["hidden_bias"]
        hidden = np.maximum(before, 0)
        margin = hidden @ p["out"] + p["out_bias"][0]
        error = ((1 / (1 + np.exp(-margin)) - labels) / len(texts)).astype(np.float32)
        g["out"], g["out_bias"] = hidden.T @ error, error.sum(keepdims=True)
        back = np.outer(error, p["out"]) * (before > 0)
        g["hidden"], g["hidden_bias"] = pooled.T @ back, back.sum(0)
        back = back @ p["hidden"].T
        slopes = np.zeros_like(answers)
        for i, (best, live, peak) in enumerate(kept):
            np.add.at(slopes, (best, columns), back[i, :FILTERS] * live / len(best))
            np.add.at(slopes, (best[peak, columns], columns), back[i, FILTERS:] * live[peak, columns])
        used = np.flatnonzero(slopes.any(1))
        g["filters"], g["filter_bias"] = x[used].T @ slopes[used], slopes[used].sum(0)
        down = (slopes[used] @ p["filters"].T).reshape(len(used) * KERNEL, EMBED)
        np.add.at(g["embed"], every[used].reshape(-1), down)
        return g


def fit(texts: list[bytes], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Network:
    """Train by Adam on shuffled batches; the order is fixed by the seed."""
    network, rng = Network(seed), np.random.default_rng(seed)
    if not len(texts):
        return network
    arrays = [np.frombuffer(t, np.uint8) for t in texts]
    share = float(np.clip(labels.mean(), 0.01, 0.99))
    network.p["out_bias"][:] = np.log(share / (1 - share))
    mean = {k: np.zeros_like(v) for k, v in network.p.items()}
    square = {k: np.zeros_like(v) for k, v in network.p.items()}
    total, step = epochs * -(-len(arrays) // BATCH), 0
    for _ in range(epochs):
        order = rng.permutation(len(arrays))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            step += 1
            rate = RATE * min(1.0, 1.05 - step / total)
            for k, slope in network.gradients([arrays[i] for i in chosen], labels[chosen]).items():
                mean[k] = 0.9 * mean[k] + 0.1 * slope
                square[k] = 0.99 * square[k] + 0.01 * slope**2
                fixed = mean[k] / (1 - 0.9**step), square[k] / (1 - 0.99**step)
                network.p[k] = network.p[k] - np.float32(rate) * fixed[0] / (np.sqrt(fixed[1]) + 1e-7)
    return network


def stretches(text: str | None, most: int = TRAIN_BYTES) -> bytes:
    """A text of up to ``most`` bytes, of a longer one stretches spread evenly over all of it."""
    data = as_bytes(text)
    if len(data) <= most:
        return data
    starts = np.linspace(0, len(data) - STRETCH, most // STRETCH).astype(int)
    return b"".join(data[s : s + STRETCH] for s in starts)


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Network:
    """Train on a sample of labelled documents; the driver gets ``rows`` times TRAIN_BYTES at most."""
    sample = docs.join(F.broadcast(sampled_labels(labels, "quality", rows)), "doc_id")

    def run(batches):
        for batch in batches:
            texts = [stretches(t.as_py()) for t in batch.column("text")]
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("label"), pa.array(texts, pa.binary())],
                names=["doc_id", "label", "bytes"],
            )

    chosen = sample.select(F.col("doc_id").cast("long"), "label", "text")
    found = chosen.mapInArrow(run, "doc_id long, label int, bytes binary").toArrow()
    found = found.sort_by("doc_id")
    marks = (found.column("label").to_numpy() == 1).astype(np.float32)
    return fit(found.column("bytes").to_pylist(), marks)


def quality_scores(
    docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, network: Network | None = None
) -> DataFrame:
    """Add held_out, score (0 to 1) and predicted to every document; nothing else is changed.

    Labels of held-out ids are never looked at, and no column but the text is an input of a score.
    NULL and empty texts are scored as one step of zeros. Ids that are NULL are never training rows
    and count as not held out. Repeated rows get equal scores. Columns named like a result are
    replaced. Without labels the scores say nothing, but are there.
    """
    docs = docs.drop("held_out", "score", "predicted")
    if network is None:
        network = train(docs.select("doc_id", "text"), labels)

    @F.pandas_udf("double")
    def score(texts):
        return texts.map(lambda t: network.score(as_bytes(t)), na_action=None)

    scored = docs.withColumn("score", score(F.coalesce("text", F.lit(""))))
    return scored.withColumns(
        {
            "held_out": F.coalesce(held_out(F.col("doc_id")), F.lit(False)),
            "predicted": (F.col("score") >= threshold).cast("int"),
        }
    )
