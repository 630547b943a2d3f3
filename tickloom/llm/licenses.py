"""License scans: template markup compiled into token automata.

A template is plain wording with two kinds of markup::

    [[optional wording]]            may be left out; regions nest
    {{name:low-high}}               low to high words of any kind

Everything else is mandatory and must match word for word. A text is lower-cased (A-Z) and cut into
words of digits, a-z and non-ASCII characters, so punctuation and line breaks never matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tickloom.llm.tables import only
from tickloom.llm.words import Piece, Words, byte_table, pieces

# ---------------------------------------------------------------------------
# Base phrases, and the wording of public license notices.
# ---------------------------------------------------------------------------
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
TEMPLATES = {
    "apache-2.0": "licensed under the apache license [[,]] version 2.0 [[the license]]",
    "cc-by-nc": "licensed under [[the]] [[a]] cc by-nc [[{{version:1-2}}]] [[international]] [[license]]",
    "cc-by-sa": "licensed under [[the]] [[a]] cc by-sa [[{{version:1-2}}]] [[international]] [[license]]",
    "cc-by-4.0": "licensed under [[the]] [[a]] cc by 4.0 [[international]] [[license]]",
    "gpl-3.0": "licensed under the [[terms of the]] gnu general public license [[as published by the free "
               "software foundation]] [[either]] version 3 [[of the license]] [[or any later version]]",
    "gpl-2.0": "licensed under the [[terms of the]] gnu general public license [[as published by the free "
               "software foundation]] [[either]] version 2 [[of the license]] [[or any later version]]",
    "mit": "[[released]] [[licensed]] [[distributed]] under the [[terms of the]] mit license",
    "mit-text": "permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                "associated documentation files {{notice:0-3}} to deal in the software without restriction, "
                "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
                "sublicense, and/or sell copies of the software, and to permit persons to whom the software is "
                "furnished to do so, subject to the following conditions",
    "isc-text": "permission to use, copy, modify, and/or distribute this software for any purpose with or without "
                "fee is hereby granted, provided that the above copyright notice and this permission notice appear "
                "in all copies",
    "bsd-text": "redistribution and use in source and binary forms, with or without modification, are permitted "
                "[[provided that the following conditions are met]]",
    "copyright": "copyright [[c]] {{holder:1-8}} all rights reserved",
}
# ---------------------------------------------------------------------------

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
WORD = byte_table([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
_MARKUP = re.compile(r"\[\[|\]\]|\{\{\s*[\w -]*:\s*(\d+)\s*-\s*(\d+)\s*\}\}")


def _lowered(text: str) -> list[str]:
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def _ids(words: list[str]) -> list[int]:
    """Hashes of words, as the scan computes them."""
    for piece in pieces(pa.array([" ".join(words)], pa.string())):
        return piece.words(WORD).hashes().tolist()
    return []


class Automaton:
    """Nondeterministic token automaton of one template, determinised as far as texts reach it."""

    def __init__(self, markup: str):
        self.on: list[dict[int, int]] = [{}]
        self.any: list[int | None] = [None]
        self.free: list[list[int]] = [[]]
        at, open_at, place = 0, [], 0
        for mark in [*_MARKUP.finditer(markup), None]:
            for word in _ids(_lowered(markup[place : mark.start() if mark else None])):
                at = self._step(at, word)
            if mark is None:
                break
            place = mark.end()
            if mark[0] == "[[":
                open_at.append(at)
            elif mark[0] == "]]":
                at = self._join(open_at.pop(), at)
            else:
                low, high = int(mark[1]), int(mark[2])
                skips = []
                for i in range(high):
                    if i >= low:
                        skips.append(at)
                    at = self._step(at, None)
                end = self._new()
                for state in (*skips, at):
                    self.free[state].append(end)
                at = end
        if open_at:
            raise ValueError(f"unclosed optional region in {markup!r}")
        self.final = at
        self._known: dict[tuple[frozenset, int], frozenset] = {}
        self.start = self._closure({0})
        if self.final in self.start:
            raise ValueError("a template needs mandatory wording")

    def _new(self) -> int:
        self.on.append({})
        self.any.append(None)
        self.free.append([])
        return len(self.on) - 1

    def _step(self, at: int, word: int | None) -> int:
        to = self._new()
        if word is None:
            self.any[at] = to
        else:
            self.on[at][word] = to
        return to

    def _join(self, opened: int, closed: int) -> int:
        to = self._new()
        self.free[opened].append(to)
        self.free[closed].append(to)
        return to

    def _closure(self, states: set[int]) -> frozenset:
        todo, seen = list(states), set(states)
        while todo:
            for to in self.free[todo.pop()]:
                if to not in seen:
                    seen.add(to)
                    todo.append(to)
        return frozenset(seen)

    def openers(self) -> set[int] | None:
        """Words a match can begin with; None if any word can."""
        if any(self.any[s] is not None for s in self.start):
            return None
        return {word for s in self.start for word in self.on[s]}

    def longest(self, words: np.ndarray, at: int = 0, stop: int | None = None) -> int:
        """Length of the longest match at words[at], before ``stop`` (0: none). Regions do not repeat, so a walk ends
        after as many words as the template has at most, usually after one or two."""
        states, best = self.start, 0
        for i in range(at, len(words) if stop is None else stop):
            word = int(words[i])
            key = (states, word)
            if (then := self._known.get(key)) is None:
                moved = {self.on[s][word] for s in states if word in self.on[s]}
                moved |= {self.any[s] for s in states if self.any[s] is not None}
                then = self._closure(moved)
                if len(self._known) < 100_000:  # a cache; beyond it steps are computed anew
                    self._known[key] = then
            states = then
            if not states:
                break
            if self.final in states:
                best = i + 1 - at
        return best


class Scanner:
    """Base phrases and compiled templates."""

    def __init__(self, templates: dict[str, str]):
        self.phrases = [(np.array(_ids(_lowered(p)), dtype=np.uint64), label) for p, label in PHRASES.items()]
        self.automata = [(label, Automaton(markup)) for label, markup in templates.items()]
        self.by_opener: dict[int, list[tuple[str, Automaton]]] = {}
        self.anywhere = []  # templates that any word can open
        for label, automaton in self.automata:
            openers = automaton.openers()
            if openers is None:
                self.anywhere.append((label, automaton))
            for word in openers or ():
                self.by_opener.setdefault(int(word), []).append((label, automaton))
        self.openers = None if self.anywhere else np.array(sorted(self.by_opener), dtype=np.uint64)

    def scan(self, piece: Piece) -> tuple[Words, list[tuple[int, int, int, str, bool]]]:
        """The words, and (text, first word, number of words, label, is a base phrase) of each place."""
        words = Piece(_LOWER[piece.data], piece.edges, piece.rows).words(WORD)
        hashes = words.hashes()
        found = []
        for phrase, label in self.phrases:
            at = np.flatnonzero(hashes == phrase[0])
            at = at[at + len(phrase) <= len(hashes)]
            for i in range(1, len(phrase)):
                at = at[hashes[at + i] == phrase[i]]
            text = np.searchsorted(words.first, at, side="right") - 1
            inside = at + len(phrase) <= words.first[text + 1]
            found += [(int(t), int(a), len(phrase), label, True) for t, a in zip(text[inside], at[inside])]
        if self.openers is None:
            at = np.arange(len(hashes))
        elif len(self.openers):
            slot = np.minimum(np.searchsorted(self.openers, hashes), len(self.openers) - 1)
            at = np.flatnonzero(self.openers[slot] == hashes)
        else:
            at = np.zeros(0, dtype=np.int64)
        text = np.searchsorted(words.first, at, side="right") - 1
        for t, a in zip(text.tolist(), at.tolist()):
            for label, automaton in (*self.by_opener.get(int(hashes[a]), ()), *self.anywhere):
                if n := automaton.longest(hashes, a, int(words.first[t + 1])):
                    found.append((t, a, n, label, False))
        return words, found


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``n_base`` counts all places of the base phrases; ``first_word`` / ``last_word`` are the smallest
    and largest word on which one starts (null without any). ``labels`` joins base labels and those of
    accepted templates. ``score`` is the share of the text's words that lie in such wording. A null text
    has no words; a text of any length is scanned whole, in time in proportion to its words; rows with null or repeated
    ids are scanned like any other; other columns are not read; an empty table gives no rows.
    """
    scanner = Scanner(TEMPLATES if templates is None else templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch.column("text")):
                words, found = scanner.scan(piece)
                per_text: dict[int, list] = {}
                for place in found:
                    per_text.setdefault(place[0], []).append(place)
                n_base = np.zeros(piece.n, dtype=np.int64)
                first, last = [None] * piece.n, [None] * piece.n
                base_labels, labels = [""] * piece.n, [""] * piece.n
                score = np.zeros(piece.n)
                for t, places in per_text.items():
                    base = [p[1] - int(words.first[t]) for p in places if p[4]]
                    if base:
                        n_base[t], first[t], last[t] = len(base), min(base), max(base)
                        base_labels[t] = ",".join(sorted({p[3] for p in places if p[4]}))
                    labels[t] = ",".join(sorted({p[3] for p in places}))
                    inside = {w for p in places for w in range(p[1], p[1] + p[2])}
                    score[t] = len(inside) / int(words.counts[t])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(piece.rows.start, piece.n), pa.array(words.counts.astype(np.int64)),
                     pa.array(n_base), pa.array(first, pa.int64()), pa.array(last, pa.int64()),
                     pa.array(base_labels), pa.array(labels), pa.array(score)],
                    ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
                )

    return only(docs, doc_id="long", text="string").mapInArrow(
        run,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double",
    )
