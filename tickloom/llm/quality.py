"""Quality rules: boosted trees over document statistics, beside two fixed rules."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tickloom.llm import boosting
from tickloom.llm.tables import labelled_sample, only, sampled_texts, small_batches
from tickloom.llm.words import Piece, byte_table, covered, gram_hashes, mix, pieces, repeated

SAMPLE_ROWS = 12_000
"""Most labelled documents that the trees are fitted on."""
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

# name of each feature and the direction in which the score may move with it (0: free)
FEATURES = {
    "log_words": 0, "chars_per_word": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1,
    "upper_share": 0, "digit_share": 0, "stop_share": 0, "mark_share": -1, "distinct_share": 0,
    "words_per_line": 0, "short_word_share": 0,
}
_SYMBOL = byte_table(b"#*$%&|<>")
_LEAD = ~byte_table(range(0x80, 0xC0))
_UPPER = byte_table(range(0x41, 0x5B))
_DIGIT = byte_table(range(0x30, 0x3A))
_STOP = byte_table(b".,;:")
_MARK = byte_table(b"!?")
_NEWLINE = byte_table(b"\n")
_SEED = np.uint64(0x2545F4914F6CDD1D)

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def statistics(piece: Piece) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The five base counts of each text, and the feature matrix."""
    words = piece.words()
    salt = mix(np.arange(1, piece.n + 1).astype(np.uint64) * _SEED)
    hashes = words.hashes()
    text = words.text_of()

    leads = np.concatenate(([0], np.cumsum(_LEAD[piece.data], dtype=np.int64)))
    lengths = leads[words.end] - leads[words.start]
    n_chars = np.diff(leads[piece.edges])

    starts = words.gram_starts(WINDOW)
    keys = gram_hashes(hashes, starts, WINDOW) ^ salt[text[starts]]
    n_repeat = words.per_text(covered(starts[repeated(keys)], WINDOW, len(words)).astype(np.int64))

    breaks = np.flatnonzero(_NEWLINE[piece.data])
    line_start = np.sort(np.concatenate((piece.edges[:-1], breaks + 1)), kind="stable")
    line_end = np.sort(np.concatenate((piece.edges[1:], breaks)), kind="stable")
    line_text = np.searchsorted(piece.edges, line_start, side="right") - 1
    # lines that hold a word: an empty line on the edge of two texts has none, so its text is no matter
    full = np.searchsorted(words.start, line_start) < np.searchsorted(words.start, line_end)
    line_start, line_end, line_text = line_start[full], line_end[full], line_text[full]
    line_keys = piece.hash_ranges(line_start, line_end) ^ salt[line_text]
    _, seen_first = np.unique(line_keys, return_index=True)
    n_lines = np.bincount(line_text, minlength=piece.n)
    n_dup = n_lines - np.bincount(line_text[seen_first], minlength=piece.n)

    _, word_first = np.unique(hashes ^ salt[text], return_index=True)
    n_distinct = np.bincount(text[word_first], minlength=piece.n)

    counts = {
        "n_words": words.counts, "word_chars": words.per_text(lengths), "n_symbols": piece.count(_SYMBOL),
        "n_dup_lines": n_dup, "n_repeat_words": n_repeat,
    }
    n = np.maximum(words.counts, 1).astype(float)
    chars = np.maximum(n_chars, 1).astype(float)
    x = np.stack([
        np.log1p(words.counts), counts["word_chars"] / n, counts["n_symbols"] / chars,
        n_dup / np.maximum(n_lines, 1), n_repeat / n, piece.count(_UPPER) / chars, piece.count(_DIGIT) / chars,
        piece.count(_STOP) / n, piece.count(_MARK) / n, n_distinct / n,
        words.counts / np.maximum(n_lines, 1), words.per_text((lengths <= 3).astype(np.int64)) / n,
    ], axis=1)
    return counts, x


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch.column("text")):
            x = statistics(piece)[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(batch.column("label").slice(piece.rows.start, piece.n)), pa.array(list(x), pa.list_(pa.float64()))],
                ["label", "x"],
            )


def base_failed(counts: dict[str, np.ndarray]) -> np.ndarray:
    return (counts["n_words"] < MIN_WORDS) | (
        100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"]
    )


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> boosting.FlatTrees | None:
    """Trees that give P(quality = 1), fitted on at most ``sample_rows`` labelled documents.

    The sample's features (12 numbers a row) are all that reaches the driver; an id that comes more than once
    counts once, with the text of smallest hash. None if the labels do not hold both classes.
    """
    known = sampled_texts(docs, labelled_sample(labels, "quality", sample_rows))
    found = known.select("label", "text").mapInArrow(_features, "label int, x array<double>").collect()
    if len({row.label for row in found}) < 2:
        return None
    found.sort(key=lambda row: (row.label, row.x))  # the order of arrival must not matter
    x, y = np.array([row.x for row in found]), np.array([row.label > 0 for row in found], dtype=float)
    return boosting.fit(x, y, np.array(list(FEATURES.values())))


def score(docs: DataFrame, trees: boosting.FlatTrees | None, threshold: float = 0.5) -> DataFrame:
    """doc_id, the five counts, base_failed, score (null without trees), kept - one row per row of docs.

    A null text has no words. Rows with a null or repeated id are scored like any other; an empty
    table gives no rows; columns other than doc_id and text are not read. A document is kept unless
    a fixed rule fails or the trees score it below ``threshold``.
    """
    def run(batches):
        for batch in batches:
            for piece in pieces(batch.column("text")):
                counts, x = statistics(piece)
                failed = base_failed(counts)
                p = trees.probability(x) if trees is not None else None
                kept = ~failed & (p >= threshold) if p is not None else ~failed
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(piece.rows.start, piece.n)]
                    + [pa.array(counts[name].astype(np.int64)) for name in STATISTICS]
                    + [pa.array(failed), pa.array(p) if p is not None else pa.nulls(piece.n, pa.float64()), pa.array(kept)],
                    ["doc_id", *STATISTICS, "base_failed", "score", "kept"],
                )

    schema = "doc_id long, " + ", ".join(f"{name} long" for name in STATISTICS) + ", base_failed boolean, score double, kept boolean"
    return only(docs, doc_id="long", text="string").mapInArrow(run, schema)


def keep_good(docs: DataFrame, trees: boosting.FlatTrees | None, threshold: float = 0.5) -> DataFrame:
    """The rows of docs that ``score`` keeps, with all their columns."""
    def run(batches):
        for batch in batches:
            text = batch.column(batch.schema.get_field_index("text"))
            keep = np.zeros(batch.num_rows, dtype=bool)
            for piece in pieces(text):
                counts, x = statistics(piece)
                good = ~base_failed(counts)
                if trees is not None:
                    good &= trees.probability(x) >= threshold
                keep[piece.rows] = good
            yield batch.filter(pa.array(keep))

    return small_batches(docs).mapInArrow(run, docs.schema)
