"""Byte-level BPE encoding and decoding with a compiled lexicon.

The corpus' most frequent words are encoded once and compiled into a minimal
acyclic transducer: words that end alike share their states, and each edge
carries a number, so that a word's numbers add up to its place in the table of
id sequences. Automaton and table are one block of bytes, which every worker
maps into memory from a file without a name. What the lexicon lacks is merged
exactly by the tokenizer's rules, so the lexicon changes speed and no result.

What a worker has once encoded it remembers by pre-token: the ids as text, their
number and the bytes they decode to. It keeps those met last, in bounded number,
from one task to the next.

Defined results: a NULL text is empty and gives no ids; repeated rows are each
encoded; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import re
import struct
import tempfile
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from curbside.llm.text import map_texts, small_batches, words_of

# Occurrences per byte from which a word is compiled into the lexicon: at most 250,000 words.
LEXICON_SHARE = 2e-6
# Pre-tokens that a worker remembers.
KEPT_TOKENS = 200_000
# Characters from which a text is taken in pieces, and pre-tokens of a piece.
LONG_TEXT, PIECE_TOKENS = 4 << 20, 200_000
# Bytes from which a pre-token is merged with a queue.
LONG_TOKEN = 200
NEVER = 1 << 40

# Fixed value: the pre-tokens of this kind of tokenizer. White space is Unicode's
# property of that name, which leaves out the four ASCII separators 1C to 1F.
_PARTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^{W}{L}{N}]+|[{W}]+(?![^{W}])|[{W}]+"
PRE_TOKENS = regex.compile(_PARTS.format(L=r"\p{L}", N=r"\p{N}", W=r"\p{White_Space}"))
# The same classes up to the last Latin letter of Unicode's block Latin Extended-B.
LATIN_CLASSES = {
    "L": "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f",
    "N": "0-9\u00b2\u00b3\u00b9\u00bc-\u00be",
    "W": "\t-\r \u0085\u00a0",
}
LATIN_TOKENS = re.compile(_PARTS.format(**LATIN_CLASSES))
BEYOND_LATIN = re.compile("[^\u0000-\u024f]")


def pre_tokens(text: str) -> Iterator[list[str]]:
    """A text's pre-tokens, all in one list or, of a long text, in several."""
    pattern = PRE_TOKENS if BEYOND_LATIN.search(text) else LATIN_TOKENS
    if len(text) < LONG_TEXT:
        yield pattern.findall(text)
        return
    found = pattern.finditer(text)
    while piece := [m.group() for m in islice(found, PIECE_TOKENS)]:
        yield piece


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    letters = {b: chr(b) for b in plain}
    rest = (b for b in range(256) if b not in letters)
    letters.update((b, chr(256 + i)) for i, b in enumerate(rest))
    return [letters[b] for b in range(256)]


class Vocabulary:
    """Ids, merge ranks and added tokens of a tokenizer file; texts to ids and back."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        ids = spec["model"]["vocab"]
        letters = byte_letters()
        self.bytes_ids = [ids[c] for c in letters]
        merges = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        self.ranks, self.wholes = {}, []
        for rank, (a, b) in enumerate(merges):
            self.ranks[ids[a], ids[b]] = rank
            self.wholes.append(ids[a + b])
        pairs = np.array([a << 32 | b for a, b in self.ranks], np.int64)
        self.pair_order = np.argsort(pairs)
        self.pair_keys = pairs[self.pair_order]
        byte_of = {c: b for b, c in enumerate(letters)}
        self.pieces = {i: bytes(byte_of[c] for c in token) for token, i in ids.items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pieces.update((i, text.encode()) for text, i in self.added.items())
        by_length = sorted(self.added, key=len, reverse=True)
        self.added_pattern = re.compile("(" + "|".join(map(re.escape, by_length)) + ")")

    def merge(self, token: bytes) -> list[int]:
        """Ids of one pre-token: the pair of lowest rank merges first, leftmost of equals."""
        return self.merge_all([token])[0]

    def merge_all(self, tokens: list[bytes]) -> list[list[int]]:
        """The same for many pre-tokens at once, one merge of each in every round."""
        out: list[list[int]] = [[]] * len(tokens)
        short = []
        for number, token in enumerate(tokens):
            if len(token) > LONG_TOKEN:
                out[number] = self._merge_long([self.bytes_ids[b] for b in token])
            elif token:
                short.append(number)
        for number, ids in zip(short, self._merge_rounds([tokens[i] for i in short])):
            out[number] = ids
        return out

    def _pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_order[at], NEVER)

    def _merge_rounds(self, tokens: list[bytes]) -> list[list[int]]:
        if not tokens:
            return []
        sizes = np.array([len(t) for t in tokens])
        ids = np.array(self.bytes_ids, np.int64)[np.frombuffer(b"".join(tokens), np.uint8)]
        word = np.repeat(np.arange(len(tokens)), sizes)
        ranks = np.full(len(ids), NEVER)
        inner = np.flatnonzero(word[:-1] == word[1:])
        ranks[inner] = self._pair_ranks(ids[inner], ids[inner + 1])
        wholes = np.array(self.wholes, np.int64)
        done_ids, done_words = [], []
        while len(ids):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            best = np.minimum.reduceat(ranks, starts)
            lengths = np.diff(np.append(starts, len(ids)))
            ended = np.repeat(best == NEVER, lengths)
            if ended.any():
                done_ids.append(ids[ended])
                done_words.append(word[ended])
                ids, word, ranks = ids[~ended], word[~ended], ranks[~ended]
                lengths, best = lengths[best != NEVER], best[best != NEVER]
                if not len(ids):
                    break
            at = np.flatnonzero(ranks == np.repeat(best, lengths))
            at = at[np.r_[True, word[at[1:]] != word[at[:-1]]]]
            ids[at] = wholes[best]
            kept = np.ones(len(ids), bool)
            kept[at + 1] = False
            ids, word, ranks = ids[kept], word[kept], ranks[kept]
            at -= np.arange(len(at))
            for left in (at, at - 1):
                left = left[(left >= 0) & (left < len(ids))]
                whole = left[left + 1 < len(ids)]
                same = whole[word[whole] == word[whole + 1]]
                here = np.isin(left, same, assume_unique=True, kind="sort") if len(same) < len(left) else slice(None)
                fresh = np.full(len(left), NEVER)
                fresh[here] = self._pair_ranks(ids[same], ids[same + 1])
                # The place before a word's first belongs to another word and keeps its rank.
                ranks[left] = fresh
        flat, owner = np.concatenate(done_ids), np.concatenate(done_words)
        order = np.argsort(owner, kind="stable")
        ends = np.cumsum(np.bincount(owner, minlength=len(tokens)))
        flat = flat[order].tolist()
        return [flat[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same by a queue, for a token too long to scan for every merge."""
        size = len(ids)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        queue = []

        def offer(left: int, right: int) -> None:
            rank = self.ranks.get((ids[left], ids[right]))
            if rank is not None:
                heapq.heappush(queue, (rank, left, right, ids[left], ids[right]))

        for place in range(size - 1):
            offer(place, place + 1)
        while queue:
            rank, left, right, a, b = heapq.heappop(queue)
            if ids[left] != a or ids[right] != b or after[left] != right:
                continue
            ids[left], ids[right] = self.wholes[rank], -1
            after[left] = after[right]
            if after[right] < size:
                before[after[right]] = left
            if before[left] >= 0:
                offer(before[left], left)
            if after[left] < size:
                offer(left, after[left])
        return [i for i in ids if i >= 0]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))


def _minimal_states(words: list[bytes]) -> tuple[list[list[tuple[int, int]]], list[bool], int]:
    """Edges and final marks of the smallest automaton of sorted distinct words, and its start."""
    edges: list[list[tuple[int, int]]] = []
    final: list[bool] = []
    known: dict[tuple, int] = {}

    def settle(open_edges: list[tuple[int, int]], ends: bool) -> int:
        key = (ends, tuple(open_edges))
        if key not in known:
            known[key] = len(edges)
            edges.append(open_edges)
            final.append(ends)
        return known[key]

    # Open states of the current word's path; states off the path are settled for good.
    path: list[tuple[list[tuple[int, int]], bool]] = [([], False)]
    last = b""
    for word in words:
        common = 0
        while common < min(len(word), len(last)) and word[common] == last[common]:
            common += 1
        while len(path) > common + 1:
            state = settle(*path.pop())
            path[-1][0].append((last[len(path) - 1], state))
        path += [([], False) for _ in word[common:]]
        path[-1] = (path[-1][0], True)
        last = word
    while len(path) > 1:
        state = settle(*path.pop())
        path[-1][0].append((last[len(path) - 1], state))
    return edges, final, settle(*path[0])


def compile_lexicon(entries: dict[bytes, list[int]]) -> bytes:
    """One block: head, edge labels, states, edge targets and numbers, id table.

    A state is (first edge, final); an edge's number counts the words that sort
    before those it leads to, so numbers along a word add up to its place.
    """
    words = sorted(entries)
    edges, final, start = _minimal_states(words)
    below = [0] * len(edges)
    labels, targets, numbers, firsts = bytearray(), array("I"), array("I"), array("I")
    # States are settled after those they lead to, so one pass counts words below.
    for state, listed in enumerate(edges):
        firsts.append(len(labels))
        passed = int(final[state])
        for label, target in listed:
            labels.append(label)
            targets.append(target)
            numbers.append(passed)
            passed += below[target]
        below[state] = passed
    firsts.append(len(labels))
    ends = array("I", [0])
    table = array("I")
    for word in words:
        table.extend(entries[word])
        ends.append(len(table))
    marks = bytes(map(int, final))
    pad = lambda block: block + b"\0" * (-len(block) % 4)
    blocks = [pad(bytes(labels)), pad(marks)] + [a.tobytes() for a in (firsts, targets, numbers, ends, table)]
    head = struct.pack("<9I", start, len(words), *(len(b) for b in blocks))
    return head + b"".join(blocks)


class Lexicon:
    """A compiled block, mapped into memory."""

    def __init__(self, block: bytes):
        with tempfile.TemporaryFile() as file:  # has no name; gone with the mapping
            file.write(block)
            file.flush()
            self.block = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        self.start, self.size, *lengths = struct.unpack_from("<9I", self.block)
        at, views = 36, []
        for length in lengths:
            views.append((at, at + length))
            at += length
        whole = memoryview(self.block)
        labels, self.final = (np.frombuffer(whole[a:b], np.uint8) for a, b in views[:2])
        self.firsts, self.targets, self.numbers, self.ends, self.table = (
            np.frombuffer(whole[a:b], np.uint32) for a, b in views[2:]
        )
        # Edges lie in order of state and label, so one search finds a state's edge.
        states = np.repeat(np.arange(len(self.firsts) - 1), np.diff(self.firsts.astype(np.int64)))
        self.edges = states << 8 | labels[: len(states)]

    def find_all(self, words: list[bytes]) -> list[list[int] | None]:
        """Id sequences of the words that are in the lexicon, all followed letter by letter."""
        out: list[list[int] | None] = [None] * len(words)
        if not self.size:
            return out
        length = np.array([len(w) for w in words], np.int64)
        starts = np.cumsum(length) - length
        data = np.frombuffer(b"".join(words), np.uint8)
        going = np.arange(len(words))
        state = np.full(len(words), self.start, np.int64)
        place = np.zeros(len(words), np.int64)
        step = 0
        while len(going):
            ended = length[going] == step
            for i in going[ended & (self.final[state] > 0)].tolist():
                at = int(place[i])
                out[i] = self.table[self.ends[at] : self.ends[at + 1]].tolist()
            going, state = going[~ended], state[~ended]
            if not len(going) or not len(self.edges):
                break
            keys = state << 8 | data[starts[going] + step]
            edge = np.minimum(np.searchsorted(self.edges, keys), len(self.edges) - 1)
            there = self.edges[edge] == keys
            going, edge = going[there], edge[there]
            place[going] += self.numbers[edge]
            state = self.targets[edge].astype(np.int64)
            step += 1
        return out

    def find(self, word: bytes) -> list[int] | None:
        return self.find_all([word])[0]


# What is known of a pre-token: its ids joined by commas, their number, the bytes they decode to.
Known = tuple[str, int, bytes]


class Codec:
    """Encodes by pre-tokens: memory first, then the lexicon, then merging."""

    def __init__(self, vocabulary: Vocabulary, block: bytes):
        self.vocabulary = vocabulary
        self.lexicon = Lexicon(block)
        self.recent: dict[str, Known] = {}
        self.earlier: dict[str, Known] = {}

    def ids_of(self, tokens: list[bytes]) -> list[list[int]]:
        """Ids of pre-tokens: from the lexicon, or else merged."""
        found = self.lexicon.find_all(tokens)
        lacking = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(lacking, self.vocabulary.merge_all([tokens[i] for i in lacking])):
            found[i] = ids
        return found

    def _known(self, ids: list[int]) -> Known:
        return ",".join(map(str, ids)), len(ids), self.vocabulary.decode(ids)

    def look_up(self, pieces: list[list[str]]) -> list[list[Known]]:
        """What is known of the pre-tokens of every piece; those not met lately are learnt, all at once."""
        if len(self.recent) > KEPT_TOKENS // 2:
            self.earlier, self.recent = self.recent, {}
        lacking = set().union(*pieces).difference(self.recent)
        again = {token: self.earlier[token] for token in lacking if token in self.earlier}
        self.recent.update(again)
        new = sorted(lacking.difference(again))
        ids = self.ids_of([token.encode() for token in new])
        self.recent.update(zip(new, map(self._known, ids)))
        get = self.recent.__getitem__
        return [list(map(get, piece)) for piece in pieces]

    def parts(self, text: str) -> Iterator[list[str] | Known]:
        """Pieces of a text in their order: lists of pre-tokens, and added tokens as what is known of them."""
        added = self.vocabulary.added
        # Split at a pattern's group, so every other part is an added token.
        for number, part in enumerate(self.vocabulary.added_pattern.split(text)):
            if number % 2:
                yield self._known([added[part]])
            elif part:
                yield from pre_tokens(part)

    def encode_all(self, texts: list[str], begin: Callable, add: Callable) -> list:
        """A state per text: ``begin()``, then ``add(state, known)`` for one piece after another."""
        states = [begin() for _ in texts]
        waiting: list[tuple[int, list[str] | Known]] = []
        held = 0

        def settle() -> None:
            looked = iter(self.look_up([part for _, part in waiting if isinstance(part, list)]))
            for owner, part in waiting:
                add(states[owner], next(looked) if isinstance(part, list) else [part])
            waiting.clear()

        for owner, text in enumerate(texts):
            for part in self.parts(text):
                waiting.append((owner, part))
                held += len(part) if isinstance(part, list) else 1
                if held >= PIECE_TOKENS:
                    settle()
                    held = 0
        settle()
        return states

    def encode(self, text: str) -> list[int]:
        codes = self.encode_all([text], list, lambda state, known: state.extend(code for code, _, _ in known))[0]
        return [int(i) for code in codes for i in code.split(",")]

    def decode(self, ids: Iterable[int]) -> bytes:
        return self.vocabulary.decode(ids)


class Digest:
    """Number and hash of a text's ids, and hash of the text they decode to, piece by piece."""

    COLUMNS = "ids_sha256 string, decoded_sha256 string"

    def __init__(self):
        self.count, self.ids, self.decoded = 0, hashlib.sha256(), hashlib.sha256()

    def add(self, known: list[Known]) -> None:
        if self.count:
            self.ids.update(b",")
        self.count += sum([n for _, n, _ in known])
        self.ids.update(",".join([code for code, _, _ in known]).encode())
        # Pre-tokens end between characters, so pieces decode by themselves.
        self.decoded.update(_shown(known).encode())

    def cells(self) -> tuple[str, str]:
        return self.ids.hexdigest(), self.decoded.hexdigest()


class Whole:
    """Ids and decoded text."""

    COLUMNS = "ids array<int>, decoded string"

    def __init__(self):
        self.count, self.ids, self.decoded = 0, array("i"), []

    def add(self, known: list[Known]) -> None:
        self.count += sum([n for _, n, _ in known])
        self.ids.extend(map(int, ",".join([code for code, _, _ in known]).split(",")))
        self.decoded.append(_shown(known))

    def cells(self) -> tuple[np.ndarray, str]:
        return np.array(self.ids, np.int32), "".join(self.decoded)


def _shown(known: list[Known]) -> str:
    return b"".join([held for _, _, held in known]).decode("utf-8", "replace")


def frequent_words(docs: DataFrame, text: str = "text", share: float = LEXICON_SHARE) -> list[str]:
    """Words that occur more than ``share`` times per byte of the corpus, counted over all texts.

    There cannot be more than 1 / (2 share) of them, whatever the corpus, because
    each occurrence takes a byte and a space.
    """
    size = docs.agg(F.sum(F.octet_length(F.col(text)) + 1).alias("n")).first()["n"] or 0
    words = docs.select(F.explode(words_of(F.col(text))).alias("word")).where(F.octet_length("word") <= 64)
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > size * share)
    return sorted(r["word"] for r in counted.select("word").collect())


def lexicon_of(words: list[str], vocabulary: Vocabulary) -> bytes:
    tokens = {t for word in words for form in (word, " " + word) for t in PRE_TOKENS.findall(form)}
    coded = [t.encode() for t in sorted(tokens)]
    return compile_lexicon(dict(zip(coded, vocabulary.merge_all(coded))))


def encode_documents(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, n_tokens, ids array<int>, decoded), one per document."""
    return _coded(docs, path, doc_id, text, Whole)


def encode_digests(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, n_tokens, ids_sha256, decoded_sha256), one per document."""
    return _coded(docs, path, doc_id, text, Digest)


def _coded(docs: DataFrame, path: str, doc_id: str, text: str, form: type) -> DataFrame:
    """Lexicon from the whole corpus, then one pass over the texts without a shuffle."""
    vocabulary = Vocabulary(path)
    block = lexicon_of(frequent_words(docs, text), vocabulary)
    # Both have a fixed size: the tokenizer's vocabulary and 1 / (2 LEXICON_SHARE) words of 64 bytes.
    shared = docs.sparkSession.sparkContext.broadcast({"vocabulary": vars(vocabulary), "block": block})
    whole = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = whole.schema["doc_id"].dataType.simpleString()
    columns = form.COLUMNS.split(", ")
    names = ["doc_id", "n_tokens", *(c.split(" ")[0] for c in columns)]
    kinds = [pa.list_(pa.int32()) if "array" in c else pa.string() for c in columns]

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = shared.value
        if "codec" not in state:  # a worker holds one copy of the value for all its tasks
            vocabulary = Vocabulary.__new__(Vocabulary)
            vars(vocabulary).update(state["vocabulary"])
            state["codec"] = Codec(vocabulary, state["block"])
        codec = state["codec"]
        for batch in small_batches(batches, "text"):
            texts = [text or "" for text in batch.column("text").to_pylist()]
            found = codec.encode_all(texts, form, form.add)
            left, right = zip(*(f.cells() for f in found))
            arrays = [batch.column("doc_id"), pa.array([f.count for f in found], pa.int64())]
            arrays += [pa.array(v, k) for v, k in zip((left, right), kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return map_texts(whole, coded, f"doc_id {kind}, n_tokens long, {form.COLUMNS}")
