"""Language of a text by a bidirectional gated recurrent network over bytes.

The network reads a word's bytes in both directions and gives every position a
probability for each language; a document's probabilities are the mean over all
positions of its text. States start fresh at every word (pieces of ``PIECE``
bytes for longer ones), so equal words of a batch run through the network once
and count as often as they occur. Texts are lower-cased first.

Training is in numpy on the driver: backpropagation through time on words of a
bounded sample, at most ``TRAIN_DOCS`` documents, languages in turn, chosen by a hash
of the id, and of a longer one ``TRAIN_CHARS`` characters from a hashed place.
Prediction reads every text whole, without a shuffle.

Defined results: NULL text and text without a letter are ``und`` with score 0;
so is everything if no document teaches a language; repeated rows are each
predicted. Other columns of the input are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window, functions as F

from curbside.llm.text import crc_remainder, map_texts, small_batches, stretch

UNKNOWN = "und"
TRAIN_DOCS = 1_000
TRAIN_CHARS = 20_000
# Parts in which a language's rows are cut down before they meet.
TURN_PARTS = 32
HIDDEN = 12
PIECE = 32
STEPS = 500
BATCH = 256
RATE = 0.01
SEED = 17

# A pipeline keeps documents whose language is at least this likely.
LEAST_SCORE = 0.3

# Words whose sums a task keeps, and words run through the network at once.
KEPT_WORDS = 250_000
RUN_WORDS = 2_048

LETTER = regex.compile(r"\p{L}")


def _sigmoid(v: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * (np.tanh(np.float32(0.5) * v) + np.float32(1))


class Direction:
    """One gated recurrent layer; ``table`` holds the gates' input for each byte."""

    def __init__(self, rng: np.random.Generator, hidden: int, languages: int):
        draw = lambda *shape: rng.normal(0, 1, shape).astype(np.float32)
        self.hidden = hidden
        self.parts = {
            "table": draw(256, 3 * hidden) * np.float32(0.3),
            "state": draw(hidden, 3 * hidden) / np.float32(np.sqrt(hidden)),
            "out": draw(hidden, languages) * np.float32(0.1),
        }

    def run(self, data: np.ndarray, keep: bool = False):
        """States after each byte, shape (steps, words, hidden); what training needs besides."""
        h, table, state = self.hidden, self.parts["table"], self.parts["state"]
        now = np.zeros((len(data), h), np.float32)
        states = np.empty((data.shape[1], len(data), h), np.float32)
        trace = []
        for step in range(data.shape[1]):
            x, u = table[data[:, step]], now @ state
            gates = _sigmoid(x[:, : 2 * h] + u[:, : 2 * h])
            z, r = gates[:, :h], gates[:, h:]
            fresh = np.tanh(x[:, 2 * h :] + r * u[:, 2 * h :])
            if keep:
                trace.append((now, z, r, fresh, u[:, 2 * h :]))
            now = fresh + z * (now - fresh)
            states[step] = now
        return states, trace

    def back(self, data: np.ndarray, trace: list, d_states: np.ndarray) -> dict[str, np.ndarray]:
        """Backpropagation through time of the loss's gradient at every state."""
        state = self.parts["state"]
        d_gates = np.empty((data.shape[1], len(data), 3 * self.hidden), np.float32)
        d_state, carried = np.zeros_like(state), np.zeros_like(d_states[0])
        for step in range(data.shape[1] - 1, -1, -1):
            before, z, r, fresh, pull = trace[step]
            d = d_states[step] + carried
            d_fresh = d * (1 - z) * (1 - fresh * fresh)
            d_z = d * (before - fresh) * z * (1 - z)
            d_r = d_fresh * pull * r * (1 - r)
            d_gates[step] = np.hstack([d_z, d_r, d_fresh])
            d_pull = np.hstack([d_z, d_r, d_fresh * r])
            d_state += before.T @ d_pull
            carried = d * z + d_pull @ state.T
        seen = np.zeros((data.size, 256), np.float32)
        seen[np.arange(data.size), data.T.ravel()] = 1
        return {"table": seen.T @ d_gates.reshape(data.size, -1), "state": d_state}


def _padded(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes (words, longest), the same reversed word by word, and lengths."""
    length = np.array([len(w) for w in words], np.int64)
    width = int(length.max())
    data = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8)
    data = data.reshape(len(words), width)
    back = np.abs(length[:, None] - 1 - np.arange(width))
    turned = np.take_along_axis(data, np.minimum(back, width - 1), 1)
    return data, turned, length


@dataclass
class Network:
    languages: list[str]
    ahead: Direction
    behind: Direction
    bias: np.ndarray

    def positions(self, words: list[bytes], keep: bool = False):
        """Probabilities (words, positions, languages) and what training needs."""
        data, turned, length = _padded(words)
        ahead, trace_a = self.ahead.run(data, keep)
        behind, trace_b = self.behind.run(turned, keep)
        there = np.arange(data.shape[1]) < length[:, None]
        mirror = np.where(there, length[:, None] - 1 - np.arange(data.shape[1]), 0)
        z = (ahead @ self.ahead.parts["out"]).transpose(1, 0, 2)
        y = (behind @ self.behind.parts["out"]).transpose(1, 0, 2)
        z = z + np.take_along_axis(y, mirror[:, :, None], 1) + self.bias
        z = np.exp(z - z.max(2, keepdims=True))
        z /= z.sum(2, keepdims=True)
        return z * there[:, :, None], (data, turned, there, mirror, ahead, behind, trace_a, trace_b)

    def sums(self, words: list[bytes]) -> np.ndarray:
        """Probabilities summed over the positions of each word (at most ``PIECE`` bytes)."""
        out = np.empty((len(words), len(self.languages)), np.float64)
        order = np.argsort([len(w) for w in words], kind="stable")
        for start in range(0, len(words), RUN_WORDS):
            some = order[start : start + RUN_WORDS]
            out[some] = self.positions([words[i] for i in some])[0].sum(1)
        return out


def train(texts: list[str], labels: list[str], steps: int = STEPS) -> Network | None:
    """Fit on the words of labelled texts, languages drawn equally often."""
    languages = sorted(set(labels))
    if not languages:
        return None
    pools = {
        name: np.array(
            [
                piece
                for text, label in zip(texts, labels)
                if label == name
                for word in text.lower().split()
                for piece in pieces(word.encode())
            ],
            object,
        )
        for name in languages
    }
    rng = np.random.default_rng(SEED)
    net = Network(
        languages,
        Direction(rng, HIDDEN, len(languages)),
        Direction(rng, HIDDEN, len(languages)),
        np.zeros(len(languages), np.float32),
    )
    parts = [(net.ahead.parts, k) for k in ("table", "state", "out")]
    parts += [(net.behind.parts, k) for k in ("table", "state", "out")]
    moments = [[np.zeros_like(p[k]), np.zeros_like(p[k])] for p, k in parts]
    for step in range(1, steps + 1):
        label = rng.integers(0, len(languages), BATCH)
        words = [pools[languages[i]][rng.integers(len(pools[languages[i]]))] for i in label]
        p, (data, turned, there, mirror, ahead, behind, trace_a, trace_b) = net.positions(words, True)
        d = p.astype(np.float32)
        d[np.arange(BATCH), :, label] -= there
        d /= np.float32(there.sum())
        d_b = np.zeros_like(d)
        np.put_along_axis(d_b, mirror[:, :, None], np.where(there[:, :, None], d, 0), 1)
        # Positions beyond a word all point at 0; write its first byte's gradient last.
        d_b[np.arange(BATCH), mirror[:, 0]] = d[:, 0]
        last = there.sum(1) - 1
        d_b[np.arange(BATCH), 0] = d[np.arange(BATCH), last]
        grads = []
        for side, bytes_, states, trace, dz in (
            (net.ahead, data, ahead, trace_a, d),
            (net.behind, turned, behind, trace_b, d_b),
        ):
            dz = np.ascontiguousarray(dz.transpose(1, 0, 2))
            g = side.back(bytes_, trace, dz @ side.parts["out"].T)
            grads += [g["table"], g["state"], np.einsum("tbh,tbk->hk", states, dz)]
        net.bias -= np.float32(RATE) * d.sum((0, 1))
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for (p_, k), m, g in zip(parts, moments, grads):
            m[0] += np.float32(0.1) * (g - m[0])
            m[1] += np.float32(0.001) * (g * g - m[1])
            scaled = m[0] / np.float32(1 - 0.9**step)
            p_[k] -= np.float32(rate) * scaled / (np.sqrt(m[1] / np.float32(1 - 0.999**step)) + np.float32(1e-8))
    return net


def pieces(word: bytes) -> list[bytes]:
    return [word[i : i + PIECE] for i in range(0, len(word), PIECE)]


class Reader:
    """Document probabilities from word sums.

    Sums of up to twice ``KEPT_WORDS`` words are remembered: once the newer half
    is full it becomes the older one, and words still met move over.
    """

    def __init__(self, net: Network):
        self.net = net
        self._empty = np.zeros((0, len(net.languages)))
        self.rows, self.sums = {}, self._empty
        self.old_rows, self.old_sums = {}, self._empty

    def _learn(self, fresh: list[str]) -> None:
        if len(self.rows) >= KEPT_WORDS:
            self.old_rows, self.old_sums = self.rows, self.sums
            self.rows, self.sums = {}, self._empty
        new = np.empty((len(fresh), self._empty.shape[1]))
        known = np.array([self.old_rows.get(w, -1) for w in fresh], np.int64)
        new[known >= 0] = self.old_sums[known[known >= 0]]
        unknown = np.flatnonzero(known < 0)
        if len(unknown):
            cut = [pieces(fresh[i].encode()) for i in unknown]
            flat = self.net.sums([piece for listed in cut for piece in listed])
            starts = np.cumsum([0] + [len(listed) for listed in cut[:-1]])
            new[unknown] = np.add.reduceat(flat, starts, axis=0)
        base = len(self.rows)
        self.rows.update((w, base + i) for i, w in enumerate(fresh))
        self.sums = np.vstack([self.sums, new])

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        counted = [
            Counter(t.lower().split()) if t and LETTER.search(t) else Counter() for t in texts
        ]
        words = set().union(*counted)
        if len(self.rows) >= KEPT_WORDS or not words <= self.rows.keys():
            # After the halves change places every word of the batch has to be found again.
            full = len(self.rows) >= KEPT_WORDS
            self._learn(sorted(words if full else words.difference(self.rows)))
        names, scores = [], np.zeros(len(texts))
        for i, held in enumerate(counted):
            if not held:
                names.append(UNKNOWN)
                continue
            rows = np.fromiter(map(self.rows.__getitem__, held), np.int64, len(held))
            total = np.fromiter(held.values(), np.float64, len(held)) @ self.sums[rows]
            best = int(total.argmax())
            names.append(self.net.languages[best])
            scores[i] = total[best] / total.sum()
        return names, np.minimum(scores, 1.0)


def training_sample(docs: DataFrame, usable, doc_id: str, text: str, lang: str) -> list:
    """At most ``TRAIN_DOCS`` rows (text, lang): languages in turn, by a hash of the id."""
    named = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(lang).alias("lang"),
        F.col(text).rlike(r"\p{L}").alias("fit"),
    ).where(F.col("lang").isNotNull() & F.col("fit") & F.col("doc_id").isNotNull() & usable(F.col("doc_id")))
    # No language can give more than the whole sample. Its rows are cut down to that in parts
    # first, so that what is sorted in one place does not grow with the rows or the tasks.
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    part = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(TURN_PARTS))
    near = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    turn = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    drawn = (
        named.withColumn("part", part)
        .withColumn("near", near)
        .where(F.col("near") <= TRAIN_DOCS)
        .select("doc_id", "lang", turn.alias("turn"))
        .where(F.col("turn") <= TRAIN_DOCS)
        .orderBy("turn", "lang")
        .limit(TRAIN_DOCS)
        .select("doc_id", "lang")
        .distinct()
    )
    whole = docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    found = whole.where(F.col("text").isNotNull()).join(F.broadcast(drawn), ["doc_id", "lang"])
    found = found.withColumn("text", stretch(F.col("text"), F.col("doc_id"), TRAIN_CHARS))
    return found.orderBy(F.xxhash64("doc_id"), "doc_id", "lang", "text").limit(TRAIN_DOCS).collect()


def predict_language(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    folds: int = 4,
    held_out_fold: int = 2,
) -> DataFrame:
    """Rows (doc_id, held_out, lang_pred, score), one per document.

    Documents whose crc32 remainder is ``held_out_fold`` teach nothing.
    """
    held = lambda key: crc_remainder(key, folds) == held_out_fold
    rows = training_sample(docs, lambda key: ~held(key), doc_id, text, lang)
    net = train([r["text"] for r in rows], [r["lang"] for r in rows])
    whole = docs.select(
        F.col(doc_id).alias("doc_id"), held(F.col(doc_id)).alias("held_out"), F.col(text).alias("text")
    )
    kind = whole.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, lang_pred string, score double"
    return map_texts(whole, _predictor(net), schema)


def keep_known_languages(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    least: float = LEAST_SCORE,
    folds: int = 4,
    held_out_fold: int = 2,
) -> DataFrame:
    """The documents whose language is known with at least this score; columns as given."""
    held = lambda key: crc_remainder(key, folds) == held_out_fold
    rows = training_sample(docs, lambda key: ~held(key), doc_id, text, lang)
    predicted = _predictor(train([r["text"] for r in rows], [r["lang"] for r in rows]), text)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text):
            for found in predicted(iter([batch])):
                known = pc.not_equal(found.column("lang_pred"), UNKNOWN)
                sure = pc.greater_equal(found.column("score"), least)
                yield batch.filter(pc.and_(known, sure))

    return map_texts(docs, kept, docs.schema)


def _predictor(net: Network | None, text: str = "text"):
    """Function over Arrow batches: the text column gives way to its prediction."""

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(net) if net else None
        for batch in small_batches(batches, text):
            texts = batch.column(text).to_pylist()
            if reader:
                names, scores = reader.predict(texts)
            else:
                names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            found = {n: c for n, c in zip(batch.schema.names, batch.columns) if n != text}
            found["lang_pred"] = pa.array(names, pa.string())
            found["score"] = pa.array(scores, pa.float64())
            yield pa.RecordBatch.from_arrays(list(found.values()), names=list(found))

    return predicted
