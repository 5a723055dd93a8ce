"""Toxicity scores from confirmed examples and unlabelled text: non-negative PU learning in numpy.

Only examples labelled toxic count as labelled; all other training rows, whatever their label says,
are unlabelled text in which toxic documents hide. The risk of calling unlabelled text clean is
corrected by the class prior, and where the corrected part turns negative it is pushed back up
(non-negative estimator). Features are the distinct words of the whole
text and their beginnings.

The model is fitted on a bounded sample of labelled rows (TRAIN_ROWS, by a hash of the id), of which
the driver gets hashes only. Scoring covers every whole text, in one pass without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, held_out

#: Bound of the sample of labelled rows that the model is fitted on.
TRAIN_ROWS = 8_000
FEATURE_BITS = 22
#: Bytes of the words' beginnings that are features besides the words: stems of inflected words.
BEGINNINGS = (4, 5, 6, 7, 8)
#: A word is a feature if so many training documents have it, toxic ones at least.
MIN_TOXIC_DOCUMENTS = 5
#: ... and if toxic documents have it so many times as often as all documents.
MIN_LIFT = 1.5
THRESHOLD = 0.7
STEPS = 200
FOLDS = 3
RATE = 0.05
DECAY = 1e-4

#: Everything but ASCII letters, apostrophes and the bytes of other letters separates words.
PLAIN = bytes(c if chr(c).isalpha() or c == 39 else 32 for c in range(128)) + bytes(range(128, 256))


def word_features(text: str | None) -> np.ndarray:
    """Hashes of the distinct lower-cased words and of their beginnings, sorted."""
    words = set(as_bytes(text).lower().translate(PLAIN).split())
    terms = {word + b"$" for word in words}
    for n in BEGINNINGS:
        terms |= {word[:n] for word in words if len(word) >= n}
    digest = xxhash.xxh32_intdigest
    mask = (1 << FEATURE_BITS) - 1
    return np.unique(np.fromiter((digest(w) & mask for w in terms), np.int64, len(terms)))


@dataclass
class Model:
    """Weights of some features (sorted); all others count nothing."""

    features: np.ndarray
    weights: np.ndarray
    bias: float

    def margin(self, found: np.ndarray) -> float:
        if not len(self.features) or not len(found):
            return self.bias
        at = np.minimum(np.searchsorted(self.features, found), len(self.features) - 1)
        return float(self.weights[at][self.features[at] == found].sum()) + self.bias

    def score(self, found: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.margin(found), -30, 30))))


def fit(rows: list[np.ndarray], toxic: np.ndarray, steps: int = STEPS) -> Model:
    """Fit a linear model to the features of documents by the non-negative risk estimator.

    The class prior is the share of toxic labels. Without any toxic example nothing is toxic.
    """
    prior = float(toxic.mean()) if len(toxic) else 0.0
    none = Model(np.empty(0, np.int64), np.empty(0), -4.0)
    if not 0 < prior < 1:
        return none
    seen = np.zeros(1 << FEATURE_BITS, np.int32)
    everywhere = np.zeros(1 << FEATURE_BITS, np.int32)
    for found, bad in zip(rows, toxic, strict=True):  # the words of a document are distinct
        everywhere[found] += 1
        if bad:
            seen[found] += 1
    features = np.flatnonzero(
        (seen >= MIN_TOXIC_DOCUMENTS) & (seen >= MIN_LIFT * prior * everywhere)
    )
    if not len(features):
        return none
    place = np.full(1 << FEATURE_BITS, -1, np.int32)
    place[features] = np.arange(len(features))
    columns = [at[at >= 0] for at in (place[found] for found in rows)]
    owner = np.repeat(np.arange(len(rows)), [len(at) for at in columns])
    column = np.concatenate(columns)
    n, m = len(rows), len(features)
    # Unlabelled text is the whole sample, the confirmed examples among it: it has their prior.
    share_p = np.where(toxic, prior / toxic.sum(), 0.0)
    share_u = np.full(n, 1.0 / n)

    weights, bias = np.zeros(m), float(np.log(prior / (1 - prior)))
    mean, square = np.zeros(m + 1), np.zeros(m + 1)
    for step in range(1, steps + 1):
        margin = bias + np.bincount(owner, weights[column], minlength=n)
        p = 1 / (1 + np.exp(-margin))
        as_clean = np.logaddexp(0, margin)  # the loss of calling a document clean
        corrected = float((share_u - share_p) @ as_clean)
        gradient = (share_u - share_p) * p  # of the corrected risk of the clean
        slope = -gradient if corrected < 0 else gradient - share_p * (1 - p)
        full = np.r_[np.bincount(column, slope[owner], minlength=m) + DECAY * weights, slope.sum()]
        mean = 0.9 * mean + 0.1 * full
        square = 0.999 * square + 0.001 * full**2
        move = RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        weights -= move[:m]
        bias -= float(move[m])
    return Model(features, weights, bias)


def calibrated(rows: list[np.ndarray], toxic: np.ndarray) -> Model:
    """Fit to all rows, then scale and shift the margin.

    Scale and shift are those of a logistic curve through the margins that rows get from models
    fitted without them (FOLDS parts), by the prior-corrected risk: every row counts as unlabelled
    text called clean, and a toxic one, by the prior's share, takes that back and counts as toxic.
    With the prior of the sample itself that sums up to the slope ``p - toxic`` of each row.
    """
    model = fit(rows, toxic)
    if not len(model.features):
        return model
    margins = np.empty(len(rows))
    part = np.arange(len(rows)) % FOLDS
    for k in range(FOLDS):
        inside = np.flatnonzero(part != k)
        other = fit([rows[i] for i in inside], toxic[inside])
        for i in np.flatnonzero(part == k):
            margins[i] = other.margin(rows[i])
    curve = np.c_[margins, np.ones(len(rows))]
    at, stiff = np.array([1.0, 0.0]), np.diag([1e-3, 1e-3])
    for _ in range(50):  # Newton steps; the small weight keeps separable margins finite
        p = 1 / (1 + np.exp(-np.clip(curve @ at, -30, 30)))
        slope = curve.T @ (p - toxic) + stiff @ (at - [1.0, 0.0])
        bend = (curve * (p * (1 - p))[:, None]).T @ curve + stiff
        at = at - np.linalg.solve(bend, slope)
    scale = max(float(at[0]), 1e-3)
    return Model(model.features, scale * model.weights, scale * model.bias + float(at[1]))


def sampled_labels(labels: DataFrame, column: str, rows: int) -> DataFrame:
    """At most ``rows`` labelled ids outside the held-out third, the first ones by a hash."""
    labels = labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull())
    labels = labels.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(
        F.max(column).cast("int").alias("label")
    )
    return labels.orderBy(F.xxhash64(F.lit(1), "doc_id"), "doc_id").limit(rows)


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Fit on a sample of at most ``rows`` labelled documents; the driver gets their hashes only."""
    sample = docs.join(F.broadcast(sampled_labels(labels, "toxic", rows)), "doc_id")

    def run(batches):
        for batch in batches:
            found = [word_features(t.as_py()).astype(np.int32) for t in batch.column("text")]
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("label"), pa.array(found, pa.list_(pa.int32()))],
                names=["doc_id", "label", "words"],
            )

    chosen = sample.select(F.col("doc_id").cast("long"), "label", "text")
    found = chosen.mapInArrow(run, "doc_id long, label int, words array<int>").toArrow()
    found = found.sort_by("doc_id")
    rows = [np.asarray(x.values) for x in found.column("words")]
    return calibrated(rows, found.column("label").to_numpy() == 1)


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, model: Model | None = None
) -> DataFrame:
    """Add held_out, score (0 to 1) and predicted to every document; nothing else is changed.

    Labels of held-out ids are never looked at, and no column but the text is an input of a score.
    NULL and empty texts get the score of a text without features. Ids that are NULL are never
    training rows and count as not held out. Repeated rows get equal scores; an id with two labels
    counts as toxic if one of them is. Columns named like a result are replaced.
    """
    docs = docs.drop("held_out", "score", "predicted")
    if model is None:
        model = train(docs.select("doc_id", "text"), labels)

    @F.pandas_udf("double")
    def score(texts):
        return texts.map(lambda t: model.score(word_features(t)), na_action=None)

    scored = docs.withColumn("score", score(F.coalesce("text", F.lit(""))))
    return scored.withColumns(
        {
            "held_out": F.coalesce(held_out(F.col("doc_id")), F.lit(False)),
            "predicted": (F.col("score") >= threshold).cast("int"),
        }
    )
