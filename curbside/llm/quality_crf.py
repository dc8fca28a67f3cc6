"""Document quality by a linear-chain conditional random field over lines.

Every line with a word is labelled good or bad from features of itself and its
two neighbours. Lines of a labelled document carry the document's label in
training; the chain is fitted in numpy by its exact likelihood gradient. A
document's quality is the mean of its lines' forward-backward marginals,
weighted by line length, put on a probability scale by a two-parameter logistic
fitted to the same training documents.

The fit uses a bounded sample: ``TRAIN_DOCS`` labelled documents, chosen by a hash of
their id, of a longer one ``TRAIN_CHARS`` characters from a hashed place, and of
these at most ``TRAIN_LINES`` lines. Scoring reads every text whole, without a
shuffle.

Defined results: a NULL or wordless text is scored as one empty line; repeated
rows are each scored; without labels of both kinds every score is the share of
good labels (0.5 without any). Other columns of the inputs are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from curbside.llm.text import crc_remainder, small_batches, stretch

TRAIN_DOCS = 3_000
TRAIN_CHARS = 20_000
TRAIN_LINES = 400
STEPS = 200
RATE = 0.05
RIDGE = 1e-3
GOOD_FROM = 0.3

_SPACE, _LOWER, _UPPER, _DIGIT, _SYMBOL, _STOP, _BANG, _OTHER, _HIGH = range(9)
CLASSES = 9


def _byte_classes() -> np.ndarray:
    kind = np.full(256, _OTHER, np.uint8)
    kind[128:] = _HIGH
    kind[[9, 10, 11, 12, 13, 32]] = _SPACE
    kind[ord("a") : ord("z") + 1] = _LOWER
    kind[ord("A") : ord("Z") + 1] = _UPPER
    kind[ord("0") : ord("9") + 1] = _DIGIT
    for marks, name in ((b"#*$%&|<>", _SYMBOL), (b".,;:", _STOP), (b"!?", _BANG)):
        kind[list(marks)] = name
    return kind


KIND = _byte_classes()
POWERS = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64))
FEATURES = CLASSES + 6


@dataclass
class Lines:
    """Lines with a word, of all texts of a batch: features, document and byte length."""

    x: np.ndarray
    doc: np.ndarray
    size: np.ndarray


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts, dtype=np.float64) if len(starts) else np.zeros(0)


def line_features(texts: pa.Array) -> Lines:
    """Character, word and repetition shares of each line with a word."""
    whole = pa.array(texts.fill_null("").cast(pa.large_binary()))
    ends = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset : whole.offset + len(whole) + 1]
    held = whole.buffers()[2]
    data = np.frombuffer(held, np.uint8)[ends[0] : ends[-1]] if held is not None else np.zeros(0, np.uint8)
    ends = ends - ends[0]
    if not len(data):
        return Lines(np.zeros((0, FEATURES)), np.zeros(0, np.int64), np.zeros(0))
    kind = KIND[data]
    opens = np.zeros(len(data) + 1, bool)
    opens[1:] = data == 10
    opens[ends[:-1]] = True  # a newline belongs to the line before it
    starts = np.flatnonzero(opens[:-1])
    size = np.diff(np.append(starts, len(data)))
    counts = np.stack([_sums(kind == c, starts) for c in range(CLASSES)], 1)
    # Words: start after white space or at a line's start.
    inside = kind != _SPACE
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | opens[1:-1]
    first = np.flatnonzero(begins)
    line_of = np.cumsum(opens[:-1]) - 1
    words = np.bincount(line_of[first], minlength=len(starts)).astype(float)
    place = np.arange(len(data))
    if len(first):
        place[first[0] :] -= np.repeat(first, np.diff(np.append(first, len(data))))
    mixed = (data.astype(np.uint64) + np.uint64(1)) * POWERS[place & 63] * inside
    distinct = np.zeros(len(starts))
    stutter = np.zeros(len(starts))
    if len(first):
        code = np.add.reduceat(mixed, first) >> np.uint64(24)
        home = line_of[first]
        keyed = (home.astype(np.uint64) << np.uint64(40)) | code
        distinct = np.bincount(
            (np.unique(keyed) >> np.uint64(40)).astype(np.int64), minlength=len(starts)
        ).astype(float)
        again = np.flatnonzero(keyed[1:] == keyed[:-1]) + 1
        stutter = np.bincount(home[again], minlength=len(starts)).astype(float)
    # Enough to spot an equal earlier line; the order of words does not count.
    line_code = np.add.reduceat((mixed >> np.uint64(7)) * np.uint64(0xD6E8FEB86659FD93), starts)
    doc = np.searchsorted(ends, starts, side="right") - 1
    kept = words > 0
    _, seen, back = np.unique(
        np.stack([doc[kept].astype(np.uint64), line_code[kept], size[kept].astype(np.uint64)], 1),
        axis=0, return_index=True, return_inverse=True,
    )
    copied = (seen[back.ravel()] != np.arange(kept.sum())).astype(float)
    size, words, doc = size[kept].astype(float), words[kept], doc[kept]
    x = np.column_stack(
        [
            counts[kept] / size[:, None],
            np.log1p(size),
            np.log1p(words),
            np.minimum((size - counts[kept][:, _SPACE]) / words, 40),
            distinct[kept] / words,
            stutter[kept] / words,
            copied,
        ]
    )
    return Lines(x, doc, size)


def with_neighbours(x: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Features of the line before, the line and the line after; zeros beyond a document."""
    before, after = np.zeros_like(x), np.zeros_like(x)
    same = doc[1:] == doc[:-1]
    before[1:] = x[:-1] * same[:, None]
    after[:-1] = x[1:] * same[:, None]
    return np.hstack([before, x, after, np.ones((len(x), 1))])


def _chains(doc: np.ndarray) -> list[np.ndarray]:
    """Line numbers at step 0, 1, 2… of every chain that is that long, longest chain first."""
    if not len(doc):
        return []
    starts = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    length = np.diff(np.append(starts, len(doc)))
    order = np.argsort(-length, kind="stable")
    starts, length = starts[order], length[order]
    alive = np.searchsorted(-length, -np.arange(1, length[0] + 1), side="right")
    return [starts[:n] + step for step, n in enumerate(alive)]


def forward_backward(s: np.ndarray, chains: list[np.ndarray], t: np.ndarray):
    """Log-odds of good against bad gathered from the left (with the line) and from the right.

    ``s`` is the lines' own log-odds, ``t[a, b]`` the score of label a before b.
    """
    left, right = s.copy(), np.zeros_like(s)
    for step in range(1, len(chains)):
        at = chains[step]
        r = left[at - 1]
        left[at] += np.logaddexp(r + t[1, 1], t[0, 1]) - np.logaddexp(r + t[1, 0], t[0, 0])
    for step in range(len(chains) - 1, 0, -1):
        at = chains[step]
        q = s[at] + right[at]
        right[at - 1] = np.logaddexp(q + t[1, 1], t[1, 0]) - np.logaddexp(q + t[0, 1], t[0, 0])
    return left, right


def _sigmoid(v: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * v))


@dataclass
class Model:
    """Standardising, line weights, transitions and the logistic of document quality."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None
    moves: np.ndarray
    slope: float = 0.0
    base: float = 0.0

    def marginals(self, lines: Lines) -> np.ndarray:
        """Probability of each line to be good."""
        x = with_neighbours((lines.x - self.mean) / self.scale, lines.doc)
        left, right = forward_backward(x @ self.weights, _chains(lines.doc), self.moves)
        return _sigmoid(left + right)

    def qualities(self, lines: Lines, docs: int) -> np.ndarray:
        """Length-weighted marginals by document; a text without lines is one empty line."""
        p, size = self.marginals(lines), lines.size
        weight = np.bincount(lines.doc, size, docs)
        good = np.bincount(lines.doc, size * p, docs)
        blank = Lines(np.zeros((1, FEATURES)), np.zeros(1, np.int64), np.ones(1))
        empty = float(self.marginals(blank)[0])
        return np.where(weight > 0, good / np.maximum(weight, 1e-300), empty)

    def scores(self, texts: pa.Array) -> np.ndarray:
        if self.weights is None:
            return np.full(len(texts), float(_sigmoid(np.array(self.base))))
        q = self.qualities(line_features(texts), len(texts))
        return _sigmoid(self.slope * q + self.base)


def _gradient(x, y, chains, w, t):
    s = x @ w
    left, right = forward_backward(s, chains, t)
    dw = x.T @ (y - _sigmoid(left + right))
    dt = np.zeros((2, 2))
    pairs = np.concatenate(chains[1:]) if len(chains) > 1 else np.zeros(0, np.int64)
    if len(pairs):
        a, b = left[pairs - 1], s[pairs] + right[pairs]
        joint = np.stack([t[0, 0] + 0 * a, t[0, 1] + b, t[1, 0] + a, t[1, 1] + a + b], 1)
        joint = np.exp(joint - joint.max(1, keepdims=True))
        joint /= joint.sum(1, keepdims=True)
        seen = np.zeros((len(pairs), 4))
        seen[np.arange(len(pairs)), (2 * y[pairs - 1] + y[pairs]).astype(int)] = 1
        dt = (seen - joint).sum(0).reshape(2, 2)
    return dw, dt


def _in_parts(texts: list[str | None], size: int = 100) -> Lines:
    """Features of many texts, a part at a time: they take far less room than what makes them."""
    parts = []
    for start in range(0, len(texts), size):
        part = line_features(pa.array(texts[start : start + size], pa.large_string()))
        parts.append(Lines(part.x, part.doc + start, part.size))
    return Lines(*(np.concatenate([getattr(p, f) for p in parts]) for f in ("x", "doc", "size")))


def fit(texts: list[str | None], labels: list[int], steps: int = STEPS) -> Model:
    """Fit chain and logistic on whole training texts held in memory."""
    labels = np.array(labels, float)
    flat = np.zeros((2, 2))
    share = (labels.sum() + 1) / (len(labels) + 2)
    if len(labels) == 0 or labels.min() == labels.max():
        return Model(np.zeros(FEATURES), np.ones(FEATURES), None, flat, 0.0, float(np.log(share / (1 - share))))
    lines = _in_parts(texts)
    mean, scale = lines.x.mean(0), lines.x.std(0) + 1e-6
    x = with_neighbours((lines.x - mean) / scale, lines.doc)
    y = labels[lines.doc]
    chains = _chains(lines.doc)
    theta = np.zeros(x.shape[1] + 4)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        dw, dt = _gradient(x, y, chains, theta[:-4], theta[-4:].reshape(2, 2))
        g = np.append(dw, dt.ravel()) / len(x) - RIDGE * theta
        first = 0.9 * first + 0.1 * g
        second = 0.999 * second + 0.001 * g * g
        theta += RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    model = Model(mean, scale, theta[:-4].copy(), theta[-4:].reshape(2, 2).copy())
    q = model.qualities(lines, len(labels))
    z = np.column_stack([q, np.ones(len(q))])
    b = np.zeros(2)
    for _ in range(30):  # Newton steps of a ridge logistic
        p = _sigmoid(z @ b)
        h = (z * (p * (1 - p))[:, None]).T @ z + np.eye(2)
        b += np.linalg.solve(h, z.T @ (labels - p) - b)
    model.slope, model.base = float(b[0]), float(b[1])
    return model


def training_sample(
    docs: DataFrame, labels: DataFrame, usable, doc_id: str = "doc_id", text: str = "text"
) -> list:
    """At most ``TRAIN_DOCS`` rows (text, quality), the same for any partitioning."""
    drawn = (
        labels.select(F.col(doc_id).alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & usable(F.col("doc_id")))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality")
        .limit(TRAIN_DOCS)
    )
    whole = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    # The sample has a fixed number of narrow rows.
    found = whole.join(F.broadcast(drawn), "doc_id")
    part = F.substring_index(stretch(F.col("text"), F.col("doc_id"), TRAIN_CHARS), "\n", TRAIN_LINES)
    found = found.withColumn("text", part)
    return found.orderBy(F.xxhash64("doc_id"), "doc_id", "text", "quality").limit(TRAIN_DOCS).collect()


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    folds: int = 5,
    held_out_fold: int = 0,
) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted), one per document.

    Documents whose crc32 remainder is ``held_out_fold`` teach nothing.
    """
    held = lambda key: crc_remainder(key, folds) == held_out_fold
    rows = training_sample(docs, labels, lambda key: ~held(key), doc_id, text)
    model = fit([r["text"] for r in rows], [r["quality"] for r in rows])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            score = model.scores(batch.column("text").cast(pa.large_string()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(score, pa.float64()),
                    pa.array((score >= GOOD_FROM).astype(np.int32)),
                ],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    whole = docs.select(
        F.col(doc_id).alias("doc_id"), held(F.col(doc_id)).alias("held_out"), F.col(text).alias("text")
    )
    kind = whole.schema["doc_id"].dataType.simpleString()
    return whole.mapInArrow(scored, f"doc_id {kind}, held_out boolean, score double, predicted int")
