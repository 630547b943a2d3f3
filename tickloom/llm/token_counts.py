"""Unigram token counts by dynamic programming over a trie of distinct pre-tokens.

A pre-token is a word behind the word-start mark. Its best segmentation maximises the sum of the pieces'
log-probabilities; characters no piece covers cost one unknown token per byte. The forward score of a
prefix does not depend on what follows it, so the distinct pre-tokens are walked in sorted order, which
is a depth-first walk of their trie: the stack holds score and count of each prefix of the current path,
a shared prefix is computed once, and the count of a terminal is stored for every text that holds the word.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from tickloom.llm.tables import only
from tickloom.llm.words import pieces

MARK = "▁"
PIECE_BYTES = 4 << 20
POOL_WORDS = 400_000
"""Words a worker remembers; beyond it the store starts anew."""


def rank_scores(pieces_in_order: list[str]) -> dict[str, float]:
    """Log-probabilities of a vocabulary listed by rank: Zipf's law, p proportional to 1 / (rank + 1)."""
    whole = math.log(sum(1 / (i + 1) for i in range(len(pieces_in_order))))
    return {piece: -math.log(i + 1) - whole for i, piece in enumerate(pieces_in_order)}


@lru_cache(maxsize=4)
def vocabulary(path: str) -> dict[str, float]:
    """Pieces of a public SentencePiece model without its control and byte pieces, scored by their rank."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [
        i for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    ]
    return rank_scores([model.id_to_piece(i) for i in plain])


class TrieCounter:
    """Best score and number of pieces of many pre-tokens."""

    def __init__(self, scores: dict[str, float]):
        # pieces backwards, so that all pieces that end at a place are met by one walk
        self.root: dict = {}
        for piece, score in scores.items():
            node = self.root
            for letter in reversed(piece):
                node = node.setdefault(letter, {})
            node[0] = score
        self.unknown = (min(scores.values()) if scores else 0.0) - 10.0
        self.steps = 0

    def run(self, tokens: list[str]) -> tuple[list[int], list[float]]:
        """Counts and scores of sorted pre-tokens."""
        best, count, path = [0.0], [0], ""
        counts, scores = [], []
        root, unknown = self.root, self.unknown
        for token in tokens:
            shared = 0
            for a, b in zip(path, token):
                if a != b:
                    break
                shared += 1
            del best[shared + 1 :], count[shared + 1 :]
            path = token
            for end in range(shared + 1, len(token) + 1):
                self.steps += 1
                n = len(token[end - 1].encode("utf-8", "surrogatepass"))
                top, pieces_used, node, at = best[end - 1] + n * unknown, count[end - 1] + n, root, end - 1
                while at >= 0 and (node := node.get(token[at])) is not None:
                    if (score := node.get(0)) is not None:
                        value = best[at] + score
                        if value > top or (value == top and count[at] + 1 < pieces_used):
                            top, pieces_used = value, count[at] + 1
                    at -= 1
                best.append(top)
                count.append(pieces_used)
            counts.append(count[-1])
            scores.append(best[-1])
        return counts, scores


class CountStore:
    """Terminal counts and scores of the words a worker has met."""

    def __init__(self, scores: dict[str, float]):
        self.counter = TrieCounter(scores)
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)
        self.counts = np.zeros(0, dtype=np.int64)
        self.scores = np.zeros(0)

    def totals(self, piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words, tokens and score of each text."""
        words = piece.words()
        hashes = words.hashes()
        distinct, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) > POOL_WORDS:
            self._clear()
        at = np.minimum(np.searchsorted(self.keys, distinct), max(len(self.keys) - 1, 0))
        new = self.keys[at] != distinct if len(self.keys) else np.ones(len(distinct), dtype=bool)
        if new.any():
            raw, keys = piece.data.tobytes(), distinct[new]
            tokens = [MARK + raw[words.start[i] : words.end[i]].decode() for i in first[new]]
            order = sorted(range(len(tokens)), key=tokens.__getitem__)
            counts, scores = self.counter.run([tokens[i] for i in order])
            back_order = np.argsort(order)
            place = np.searchsorted(self.keys, keys)
            self.counts = np.insert(self.counts, place, np.array(counts)[back_order])
            self.scores = np.insert(self.scores, place, np.array(scores)[back_order])
            self.keys = np.insert(self.keys, place, keys)
        row = np.searchsorted(self.keys, distinct)[back]
        text = words.text_of()
        # summed per text, so that a text's score does not depend on its neighbours
        score = np.bincount(text, self.scores[row], minlength=piece.n).astype(float)
        return words.counts, words.per_text(self.counts[row]), score


@lru_cache(maxsize=2)
def _store(path: str) -> CountStore:
    return CountStore(vocabulary(path))


def count_tokens(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, n_words, n_tokens, log_prob - one row per row of docs.

    ``n_tokens`` sums the pieces of the best segmentation of every word of the whole text, ``log_prob`` their
    scores. A null or empty text has none; null and repeated ids are counted like any other; other
    columns are not read; an empty table gives no rows.
    """
    path = model or public_tokenizers.path("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = _store(path)
        for batch in batches:
            for piece in pieces(batch.column("text"), PIECE_BYTES):
                n_words, n_tokens, score = store.totals(piece)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(piece.rows.start, piece.n), pa.array(n_words.astype(np.int64)),
                     pa.array(n_tokens.astype(np.int64)), pa.array(score)],
                    ["doc_id", "n_words", "n_tokens", "log_prob"],
                )

    return only(docs, doc_id="long", text="string").mapInArrow(
        run, "doc_id long, n_words long, n_tokens long, log_prob double"
    )
