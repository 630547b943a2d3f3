"""Token ids of whole texts with a public tokenizer, most words encoded once per worker.

A tokenizer that drops white space and never looks across it gives each word the same ids wherever it
stands. Words are found and hashed as flat arrays; only words a worker has not met go through the
tokenizer, and the ids of a text are gathered from a pool. Other tokenizers encode whole texts.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

from tickloom.llm.words import Piece, byte_table, prefix

POOL_WORDS = 800_000
"""Words a worker remembers; beyond it the pool starts anew."""
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_LETTER = byte_table(range(0x61, 0x7B))
_STOP = byte_table(b".,")
_SECOND = byte_table([*range(0x9F, 0xB7), *range(0xB8, 0xC0)])
_JOINED = 512


def _simple(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Flags of the words of lower-case letters that no normalisation changes (a-z, U+00DF to U+00FF without U+00F7):
    each is one pre-token, so it has one end-of-word id."""
    fine = _LETTER[data] | (data == 0xC3)
    fine[1:] |= (data[:-1] == 0xC3) & _SECOND[data[1:]]
    wrong = prefix(~fine)
    return wrong[end] == wrong[start]


class WordPool:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [t["content"].encode() for t in spec.get("added_tokens") or ()]
        suffix = spec["model"].get("end_of_word_suffix")
        pre = json.dumps(spec.get("pre_tokenizer"))
        self.by_word = bool(suffix) and '"Removed"' in pre and "Lowercase" in json.dumps(spec.get("normalizer"))
        if self.by_word:
            vocab = self.tokenizer.get_vocab()
            self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
            self.ends[[i for word, i in vocab.items() if word.endswith(suffix)]] = True
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)
        self.rows = np.zeros(0, dtype=np.int64)
        self.at = np.zeros(1, dtype=np.int64)
        self.pool = np.zeros(0, dtype=np.uint32)

    def _encode(self, words: list[bytes], simple: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
        """(words in the order in which they were encoded, number of ids of each, their ids one after the other)."""
        plain, rest = np.flatnonzero(simple).tolist(), np.flatnonzero(~simple).tolist()
        texts = [b" ".join([words[i] for i in plain[k : k + _JOINED]]).decode() for k in range(0, len(plain), _JOINED)]
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.array([i for x in found for i in x.ids], dtype=np.uint32)
        lengths = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)  # a plain word ends with its one end-of-word id
        if len(lengths) != len(plain):
            raise RuntimeError("a word without an end of its own")
        others = self.tokenizer.encode_batch_fast([words[i].decode() for i in rest], add_special_tokens=False)
        more = [x.ids for x in others]
        lengths = np.append(lengths, np.array([len(x) for x in more], dtype=np.int64))
        return plain + rest, lengths, np.append(ids, np.array([i for x in more for i in x], dtype=np.uint32))

    def _learn(self, keys: np.ndarray, words: list[bytes], simple: np.ndarray) -> None:
        order, lengths, ids = self._encode(words, simple)
        rows = np.empty(len(keys), dtype=np.int64)
        rows[order] = np.arange(len(self.at) - 1, len(self.at) - 1 + len(keys))
        self.at = np.concatenate((self.at, self.at[-1] + np.cumsum(lengths, dtype=np.int64)))
        self.pool = np.concatenate((self.pool, ids))
        place = np.searchsorted(self.keys, keys)
        self.keys, self.rows = np.insert(self.keys, place, keys), np.insert(self.rows, place, rows)

    def ids(self, piece: Piece) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of each text's ids)."""
        raw = piece.data.tobytes()
        if not self.by_word:
            texts = [raw[a:b].decode() for a, b in zip(piece.edges[:-1], piece.edges[1:])]
            found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            return np.array([i for x in found for i in x], dtype=np.uint32), prefix(np.array([len(x) for x in found]))
        lowered = _LOWER[piece.data]
        low = lowered.tobytes()
        if not any(s in raw or s in low for s in self.specials):  # upper case would hide or make a special token
            piece, raw = Piece(lowered, piece.edges, piece.rows), low
        words = piece.words()
        start, end = words.start, words.end
        # a final stop after a letter is a pre-token of its own: cut it off, so the word is met more often
        cut = (end - start >= 2) & _STOP[piece.data[end - 1]] & _LETTER[piece.data[np.maximum(end - 2, 0)]]
        place = np.cumsum(1 + cut) - 1
        starts, ends = np.empty(len(start) + int(cut.sum()), np.int64), np.empty(len(start) + int(cut.sum()), np.int64)
        starts[place], ends[place] = np.where(cut, end - 1, start), end
        starts[place[cut] - 1], ends[place[cut] - 1] = start[cut], end[cut] - 1
        edges = np.searchsorted(starts, piece.edges)
        hashes = piece.hash_ranges(starts, ends)
        distinct, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) > POOL_WORDS:
            self._clear()
        place = np.minimum(np.searchsorted(self.keys, distinct), max(len(self.keys) - 1, 0))
        new = self.keys[place] != distinct if len(self.keys) else np.ones(len(distinct), dtype=bool)
        if new.any():
            a, b = starts[first[new]], ends[first[new]]
            self._learn(distinct[new], [raw[i:j] for i, j in zip(a.tolist(), b.tolist())], _simple(piece.data, a, b))
        row = self.rows[np.searchsorted(self.keys, distinct)][back]
        lengths = self.at[row + 1] - self.at[row]
        sums = prefix(lengths)
        take = np.repeat(self.at[row] - sums[:-1], lengths) + np.arange(sums[-1])
        return self.pool[take], sums[edges]


@lru_cache(maxsize=2)
def word_pool(path: str) -> WordPool:
    """The worker's own pool; it lives on from task to task."""
    return WordPool(path)
