"""Document quality from a linear-chain conditional random field over lines.

Every line of a document is labelled good or bad. A line's potential adds up learned
weights of its own features and of those of the lines before and after it; pairs of
neighbouring labels have weights too. The forward-backward pass gives the probability
that a line is good, and a document's score is the mean of these, weighted by the
lines' lengths. Features describe form only (lengths, shares of characters and repeated
words); language, source and id play no part.

Training fits the weights by gradient ascent on a sample of labelled documents, whose
lines take the label of their document. The sample is bounded: ``TRAIN_DOCS`` labelled
documents, chosen by a hash of their id, half of them of each label where there are as
many, and of those the ones with at most ``TRAIN_LINES`` lines. Rows that repeat an id
are one document of it, the one with the least text. Only line features of this sample
reach the driver. Scoring is one narrow pass over whole texts.

Cases: a null or empty text is a document of one empty line. Documents labelled in
two ways teach nothing. Without labels all scores are 0.5. Repeated rows get a row each,
an empty table gives none, other columns are kept; one named like the score is
replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.llm.arrow import map_slices, text_udf, texts, without

TRAIN_DOCS = 4000
TRAIN_LINES = 2000
STEPS = 150
RATE = 0.1
DECAY = 1e-3
THRESHOLD = 0.3
FOLDS = 5

BINS = 12
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGIT = bytes(range(48, 58))
_SPACE = b" \t\r\x0b\x0c"
_MARKS = b".,;:'\"-()?"
_ENDS = tuple(".!?:;\"')»")

#: Features of a line, each with BINS values, in this order.
FEATURES = (
    "length words word_length upper symbols digits distinct repeats pipes "
    "end start shouted"
).split()
VALUES = len(FEATURES) * BINS


def _share(part: float, whole: float) -> int:
    """Bin 0 for none, then eleven equal bins."""
    return min(BINS - 1, 1 + int(part / whole * (BINS - 1))) if part and whole else 0


def line_features(line: str) -> list[int]:
    """The bin of each feature."""
    data = line.encode(errors="replace")
    n = len(data)

    def count(chars: bytes) -> int:
        return n - len(data.translate(None, chars))

    upper, lower = count(_UPPER), count(_LOWER)
    letters = upper + lower
    high = len(data) - len(data.decode("ascii", "ignore"))
    symbols = n - letters - high - count(_DIGIT) - count(_SPACE) - count(_MARKS)
    words = line.split()
    w = len(words)
    return [
        min(BINS - 1, len(line).bit_length()),
        min(BINS - 1, w.bit_length()),
        min(BINS - 1, int(len(line) / w)) if w else 0,
        _share(upper, letters),
        _share(symbols, n),
        _share(count(_DIGIT), n),
        _share(len(set(words)), w),
        _share(sum(map(eq, words, words[1:])), w - 1),
        _share(data.count(b"|"), w),
        int(line.rstrip().endswith(_ENDS)),
        int(words[0][:1].isupper()) + 2 * int(words[0][:1].isalpha()) if w else 3,
        int(line.isupper()),
    ]


_OFFSETS = np.arange(len(FEATURES), dtype=np.int32) * BINS


@dataclass
class Lines:
    """Lines of several documents, one after another."""

    bins: np.ndarray  # line x feature
    lengths: np.ndarray
    counts: np.ndarray  # lines of each document

    @classmethod
    def of(cls, documents: list[str]) -> Lines:
        split = [d.split("\n") for d in documents]
        flat = [line for doc in split for line in doc]
        return cls(
            np.array([line_features(x) for x in flat], dtype=np.int32).reshape(
                len(flat), len(FEATURES)
            ),
            np.array([max(len(x), 1) for x in flat], dtype=np.float64),
            np.array([len(doc) for doc in split], dtype=np.int64),
        )

    def indices(self) -> np.ndarray:
        """Weights of each line: its own, of the line before and of the line after."""
        own = self.bins + _OFFSETS
        starts = np.cumsum(self.counts) - self.counts
        before, after = np.roll(own, 1, axis=0), np.roll(own, -1, axis=0)
        edge = 3 * VALUES  # one weight for each end of a document
        before, after = before + VALUES, after + 2 * VALUES
        if len(own):
            before[starts] = edge
            after[starts + self.counts - 1] = edge + 1
        return np.concatenate([own, before, after], axis=1)


N_WEIGHTS = 3 * VALUES + 2


@dataclass
class Crf:
    """Weights for label good, label bad having none, and for pairs of labels."""

    weights: np.ndarray
    pairs: np.ndarray  # before x after; 0 bad, 1 good

    @classmethod
    def untrained(cls) -> Crf:
        return cls(np.zeros(N_WEIGHTS), np.zeros((2, 2)))

    def marginals(self, potential: np.ndarray, counts: np.ndarray):
        """Probability of good for each line, and the expected pairs of labels.

        All documents advance together, line by line, by forward and backward
        messages that are scaled to add up to one.
        """
        n = len(potential)
        order = np.argsort(-counts, kind="stable")
        starts = (np.cumsum(counts) - counts)[order]
        sizes = counts[order]
        top = np.maximum(potential, 0)
        emit = np.stack([np.exp(-top), np.exp(potential - top)], axis=1)
        step = np.exp(self.pairs - self.pairs.max())
        forward, backward = np.empty((n, 2)), np.ones((n, 2))
        longest = int(sizes[0]) if len(sizes) else 0
        active = np.searchsorted(-sizes, -np.arange(longest), side="left")
        for t in range(longest):
            at = starts[: active[t]] + t
            message = emit[at] if t == 0 else (forward[at - 1] @ step) * emit[at]
            forward[at] = message / message.sum(axis=1, keepdims=True)
        expected = np.zeros((2, 2))
        for t in range(longest - 2, -1, -1):
            at = starts[: active[t + 1]] + t
            ahead = emit[at + 1] * backward[at + 1]
            both = forward[at][:, :, None] * step[None] * ahead[:, None, :]
            expected += (both / both.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            message = ahead @ step.T
            backward[at] = message / message.sum(axis=1, keepdims=True)
        joint = forward * backward
        return joint[:, 1] / joint.sum(axis=1), expected

    def line_scores(self, lines: Lines) -> np.ndarray:
        potential = self.weights[lines.indices()].sum(axis=1)
        return self.marginals(potential, lines.counts)[0]

    def scores(self, lines: Lines) -> np.ndarray:
        """The mean marginal of each document's lines, weighted by length."""
        if not len(lines.counts):
            return np.empty(0)
        good = self.line_scores(lines)
        starts = np.cumsum(lines.counts) - lines.counts
        total = np.add.reduceat(lines.lengths, starts)
        return np.clip(np.add.reduceat(good * lines.lengths, starts) / total, 0, 1)


def gradient(model: Crf, lines: Lines, labels: np.ndarray, indices: np.ndarray):
    """Of the log likelihood of all lines having their document's label, a document."""
    y = np.repeat(labels.astype(float), lines.counts)
    potential = model.weights[indices].sum(axis=1)
    good, expected = model.marginals(potential, lines.counts)
    error = np.repeat(y - good, indices.shape[1])
    weights = np.bincount(indices.ravel(), error, minlength=N_WEIGHTS)
    seen = np.zeros((2, 2))
    pairs = lines.counts - 1
    seen[1, 1], seen[0, 0] = pairs[labels == 1].sum(), pairs[labels == 0].sum()
    n = len(labels)
    return weights / n, (seen - expected) / n


def fit(lines: Lines, labels: np.ndarray, steps: int = STEPS) -> Crf:
    """Weights by Adam on the whole sample with a penalty on their squares."""
    model = Crf.untrained()
    if not len(labels):
        return model
    indices = lines.indices()
    theta = np.zeros(N_WEIGHTS + 4)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        weights, pairs = gradient(model, lines, labels, indices)
        g = np.concatenate([weights, pairs.ravel()]) - DECAY * theta
        mean = 0.9 * mean + 0.1 * g
        square = 0.99 * square + 0.01 * g * g
        theta += RATE * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-8)
        model = Crf(theta[:N_WEIGHTS], theta[N_WEIGHTS:].reshape(2, 2))
    return model


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from training."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_docs: int = TRAIN_DOCS) -> Crf:
    """Fit a model on a bounded sample of labelled documents that are not held out."""
    clear = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .where(~held_out())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("_most"))
        .where("quality = _most and quality in (0, 1)")
        .select("doc_id", "quality")
    )
    half = [
        clear.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs // 2)
        for q in (0, 1)
    ]
    chosen = half[0].unionByName(half[1]).withColumnRenamed("doc_id", "_id")
    schema = pa.schema([("quality", pa.int32()), ("bins", pa.binary()), ("lengths", pa.binary())])

    def make():
        def apply(part):
            bins, sizes = [], []
            for text in texts(part):
                lines = Lines.of([text])
                fits = len(lines.lengths) <= TRAIN_LINES
                bins.append(lines.bins.astype(np.uint8).tobytes() if fits else None)
                sizes.append(lines.lengths.tobytes() if fits else None)
            return pa.RecordBatch.from_arrays(
                [part.column("quality"), pa.array(bins, pa.binary()), pa.array(sizes, pa.binary())],
                schema=schema,
            )

        return apply

    sample = docs.select(F.col("doc_id").cast("long").alias("_id"), "text").join(
        F.broadcast(chosen), "_id"
    )
    # A row for each id, combined within a task first.
    one = sample.groupBy("_id", "quality").agg(F.min("text").alias("text"))
    source = one.select("text", F.col("quality").cast("int"))
    rows = (
        map_slices(source, make, "quality int, bins binary, lengths binary")
        .where("bins is not null")
        .collect()
    )
    rows.sort(key=lambda r: (r.quality, bytes(r.bins), bytes(r.lengths)))
    return fit(
        Lines(
            np.frombuffer(b"".join(r.bins for r in rows), np.uint8).reshape(-1, len(FEATURES)).astype(np.int32),
            np.frombuffer(b"".join(r.lengths for r in rows), np.float64),
            np.array([len(r.lengths) // 8 for r in rows], dtype=np.int64),
        ),
        np.array([r.quality for r in rows]),
    )


SCORE = "quality_score"


def score(docs: DataFrame, model: Crf) -> DataFrame:
    """The documents with ``quality_score``; a column of that name is replaced."""
    weights, pairs = model.weights, model.pairs

    def make():
        crf = Crf(weights, pairs)
        return lambda found: pa.array(crf.scores(Lines.of(found)), pa.float64())

    return without(docs, SCORE).withColumn(SCORE, text_udf(make, T.DoubleType())("text"))


def accepted(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier does not reject, without their score."""
    return scored.where(F.col(SCORE) >= threshold).drop(SCORE)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every document."""
    return score(docs, train(docs, labels)).select(
        "doc_id",
        held_out().alias("held_out"),
        F.col(SCORE).alias("score"),
        (F.col(SCORE) >= THRESHOLD).cast("int").alias("predicted"),
    )
