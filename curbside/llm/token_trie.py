"""Token counts of documents under a unigram model, by a trie of their words.

The pieces of a public tokenizer get Zipf probabilities by rank. A word, with
the mark for the space before it, is cut into the pieces of the highest product
of probabilities (fewest pieces among equals); a character in no piece costs
``UNKNOWN_PENALTY`` more than the rarest piece and counts as its bytes.

Distinct words are inserted into a trie. A node holds the best score and the
pieces of the text from the root to it, computed once from the nodes above it,
however many words share that beginning; words keep the count of their last
node. A task's trie is started anew when it has ``TRIE_NODES`` nodes, which
changes no count.

Defined results: a NULL or wordless text has 0 words and 0 tokens; repeated rows
are each counted; an empty table gives an empty result. Other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from curbside.llm.text import small_batches

# Fixed value: the mark of a word's beginning in the pieces.
WORD_START = "▁"
UNKNOWN_PENALTY = 10.0
TRIE_NODES = 600_000


def zipf_pieces(path: str) -> dict[str, float]:
    """Log-probability of every ordinary piece: 1 / rank, normalised."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    special = lambda i: model.is_unknown(i) or model.is_control(i) or model.is_byte(i)
    pieces = [model.id_to_piece(i) for i in range(size) if not special(i) and not model.is_unused(i)]
    total = log(sum(1 / rank for rank in range(1, len(pieces) + 1)))
    return {piece: -log(rank) - total for rank, piece in enumerate(pieces, 1)}


class Trie:
    """Words inserted so far, with forward scores of their beginnings."""

    def __init__(self, pieces: dict[str, float], limit: int = TRIE_NODES):
        self.pieces = pieces
        self.limit = limit
        self.longest = max(map(len, pieces), default=1)
        self.unknown = min(pieces.values(), default=0.0) - UNKNOWN_PENALTY
        self._restart()

    def _restart(self) -> None:
        self.children: dict[tuple[int, str], int] = {}
        self.scores, self.tokens = [0.0], [0]
        self.terminal: dict[bytes, int] = {}

    def _forward(self, word: str, depth: int, path: list[int]) -> tuple[float, int]:
        """Best score and pieces of the word's first ``depth`` characters.

        ``path`` holds the nodes of all its shorter beginnings.
        """
        letter = word[depth - 1]
        above = path[depth - 1]
        score = self.scores[above] + self.unknown
        tokens = self.tokens[above] + len(letter.encode())
        known = self.pieces.get
        for start in range(max(0, depth - self.longest), depth):
            piece = known(word[start:depth])
            if piece is not None:
                node = path[start]
                found, count = self.scores[node] + piece, self.tokens[node] + 1
                if found > score or (found == score and count < tokens):
                    score, tokens = found, count
        return score, tokens

    def insert(self, word: str) -> int:
        """Tokens of a word; new nodes are computed from the known ones above."""
        node, path = 0, [0]
        children = self.children
        for depth, letter in enumerate(word, 1):
            below = children.get((node, letter))
            if below is None:
                score, tokens = self._forward(word, depth, path)
                below = len(self.scores)
                children[node, letter] = below
                self.scores.append(score)
                self.tokens.append(tokens)
            node = below
            path.append(node)
        return self.tokens[node]

    def count(self, words: list[bytes]) -> int:
        """Tokens of all words, repeats counted."""
        terminal = self.terminal
        for word in set(words).difference(terminal):
            terminal[word] = self.insert(WORD_START + word.decode())
        total = sum(map(terminal.__getitem__, words))
        if len(self.scores) > self.limit:
            self._restart()
        return total


def token_counts(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, n_words, n_tokens), one per document, without a shuffle."""
    # The vocabulary has a fixed size.
    pieces = docs.sparkSession.sparkContext.broadcast(zipf_pieces(path))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(pieces.value)
        for batch in small_batches(batches, "text"):
            # Bytes split at just the white space that ends a word here.
            words = [(t or b"").split() for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(w) for w in words], pa.int64()),
                    pa.array([trie.count(w) for w in words], pa.int64()),
                ],
                names=["doc_id", "n_words", "n_tokens"],
            )

    whole = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = whole.schema["doc_id"].dataType.simpleString()
    return whole.mapInArrow(counted, f"doc_id {kind}, n_words long, n_tokens long")
