"""Toxicity by a classifier chain of linear models.

The categories form a chain: the model of each category sees which words and word beginnings a text holds
(once, and often), and the probabilities of the categories before it. While training, those are out-of-fold predictions, so a later model learns from
what the earlier ones say of texts they were not fitted on. Each model is a logistic regression with an L1
penalty, so noise in long texts has no weight.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.tables import only, sampled_texts
from tickloom.llm.words import Piece, byte_table, pieces
from tickloom.session import stored

SAMPLE_ROWS = 8000
"""Most labelled documents that the chain is fitted on."""
MAX_FEATURES = 2048
"""Features per category, those with the largest chi-square over the sample."""
FOLDS = 3
OFTEN = 3
"""Times a word must occur in a text for its second feature."""
_OFTEN_MARK = np.uint64(0x5851F42D4C957F2D)
_PREFIXES = (4, 5, 6)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
WORD = byte_table([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])


def features(piece: Piece) -> tuple[np.ndarray, np.ndarray]:
    """(text, 64-bit feature) of every lower-cased word and word beginning, with repeats."""
    words = Piece(_LOWER[piece.data], piece.edges, piece.rows).words(WORD)
    text, keys = [words.text_of()], [words.hashes()]
    size = words.end - words.start
    for n in _PREFIXES:
        long = size > n
        start = words.start[long]
        text.append(text[0][long])
        keys.append(words.piece.hash_ranges(start, start + n) + np.uint64(n))
    return np.concatenate(text), np.concatenate(keys).astype(np.uint64)


def _present(text: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, key) in order, and for keys that a text holds OFTEN times the key's own second feature."""
    order = np.lexsort((keys, text))
    text, keys = text[order], keys[order]
    new = np.ones(len(text), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (keys[1:] != keys[:-1])
    at = np.flatnonzero(new)
    often = at[np.diff(np.append(at, len(text))) >= OFTEN]
    text, keys = np.concatenate((text[at], text[often])), np.concatenate((keys[at], keys[often] ^ _OFTEN_MARK))
    order = np.argsort(text, kind="stable")
    return text[order], keys[order]


def _among(keys: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return place, known[place] == keys


def _hits(piece: Piece, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, place in ``known``) of the known features."""
    text, keys = features(piece)
    near = _among(keys, np.unique(np.concatenate((known, known ^ _OFTEN_MARK))))[1]
    text, keys = _present(text[near], keys[near])
    place, found = _among(keys, known)
    return text[found], place[found]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_logistic(
    rows: np.ndarray, cols: np.ndarray, n: int, width: int, extra: np.ndarray, y: np.ndarray,
    penalty: float = 1.0, steps: int = 120,
) -> np.ndarray:
    """Weights (width features, then extra columns, then intercept) of an L1-penalised logistic regression.

    Proximal gradient steps with momentum; ``extra`` columns and the intercept are not penalised.
    """
    k = extra.shape[1]
    seen = np.bincount(cols, minlength=width).astype(float)
    # per-coordinate step sizes, safe because a row's curvature is spread over its own entries
    load = np.bincount(rows, minlength=n) + np.abs(extra).sum(1) + 1
    curve = 0.25 * np.concatenate((
        np.bincount(cols, load[rows], minlength=width), (np.abs(extra) * load[:, None]).sum(0), [load.sum()]
    )) + 1e-9
    shrink = np.concatenate((np.full(width, penalty), np.zeros(k + 1)))
    shrink[:width][seen == 0] = np.inf
    w = np.zeros(width + k + 1)
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    w[-1] = np.log(mean / (1 - mean))
    ahead, t = w.copy(), 1.0
    for _ in range(steps):
        z = np.bincount(rows, ahead[cols], minlength=n) + extra @ ahead[width : width + k] + ahead[-1]
        r = _sigmoid(z) - y
        g = np.concatenate((np.bincount(cols, r[rows], minlength=width), extra.T @ r, [r.sum()]))
        moved = ahead - g / curve
        then = np.sign(moved) * np.maximum(np.abs(moved) - shrink / curve, 0)
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = then + (t - 1) / t_next * (then - w), then, t_next
    return w


@dataclass
class Chain:
    """Sorted feature keys, and weights [category][keys, earlier categories, intercept]."""

    names: list[str]
    keys: np.ndarray
    weights: list[np.ndarray] = field(default_factory=list)
    thresholds: list[float] = field(default_factory=list)
    held_out: list[np.ndarray] = field(default_factory=list)

    def margins(self, category: int, rows, cols, n: int, earlier: np.ndarray) -> np.ndarray:
        w, width = self.weights[category], len(self.keys)
        return np.bincount(rows, w[cols], minlength=n).astype(float) + earlier @ w[width : width + category] + w[-1]

    def probabilities(self, rows: np.ndarray, cols: np.ndarray, n: int) -> np.ndarray:
        """One column per category, each fed with those before it."""
        out = np.zeros((n, len(self.names)))
        for c in range(len(self.names)):
            out[:, c] = _sigmoid(self.margins(c, rows, cols, n, out[:, :c]))
        return out


def _best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """Threshold with the best F1 on out-of-fold probabilities: the middle of the gap below it."""
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(p) + 1) + y.sum())
    last = np.flatnonzero(np.append(p[order][1:] != p[order][:-1], True))
    k = int(last[np.argmax(f1[last])])
    below = p[order][k + 1] if k + 1 < len(p) else 0.0
    return float((p[order][k] + below) / 2)


def fit_chain(names: list[str], keys: np.ndarray, rows, cols, fold: np.ndarray, y: np.ndarray) -> Chain:
    """Fit the chain on the sample matrix (rows, cols); ``y`` has a column per category, in chain order."""
    n, width = y.shape[0], len(keys)
    chain = Chain(names, keys)
    earlier = np.zeros((n, 0))
    for c in range(len(names)):
        outside = np.zeros(n)
        for k in range(FOLDS):
            train = fold != k
            place = np.cumsum(train) - 1
            mine = train[rows]
            w = fit_logistic(place[rows[mine]], cols[mine], int(train.sum()), width, earlier[train], y[train, c])
            z = np.bincount(rows, w[cols], minlength=n) + earlier @ w[width : width + c] + w[-1]
            outside[~train] = _sigmoid(z[~train])
        chain.weights.append(fit_logistic(rows, cols, n, width, earlier, y[:, c]))
        chain.thresholds.append(_best_threshold(outside, y[:, c]))
        chain.held_out.append(outside)
        earlier = np.hstack([earlier, outside[:, None]])
    return chain


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, str], sample_rows: int = SAMPLE_ROWS) -> Chain | None:
    """Fit a chain on at most ``sample_rows`` labelled documents.

    ``categories`` maps each category, in chain order, to a boolean SQL expression over labels (which has
    doc_id). Rows without an id or with an unknown category are left out; a document labelled twice is in a
    category if either row says so, and a repeated id counts once, with the text of smallest hash. What reaches the driver is bounded: at most MAX_FEATURES * categories
    feature numbers for each sampled document. None if some category has only one class.
    """
    names = list(categories)
    known = labels.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *[F.expr(rule).cast("int").alias(f"y{i}") for i, rule in enumerate(categories.values())],
    ).dropna()
    known = known.groupBy("doc_id").agg(*[F.max(f"y{i}").alias(f"y{i}") for i in range(len(names))])
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    mine = stored(sampled_texts(docs, sample), "tox-sample")
    counts = mine.agg(F.count("*"), *[F.coalesce(F.sum(f"y{i}"), F.lit(0)) for i in range(len(names))]).first()
    total, positive = counts[0], list(counts[1:])
    if any(p in (0, total) for p in positive):
        return None

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch.column("text")):
                text, keys = _present(*features(piece))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64))]
                    + [batch.column(f"y{i}").slice(piece.rows.start, piece.n).take(pa.array(text)) for i in range(len(names))],
                    ["key", *(f"y{i}" for i in range(len(names)))],
                )

    spelled = mine.mapInArrow(spell, "key long, " + ", ".join(f"y{i} int" for i in range(len(names))))
    seen = stored(
        spelled.groupBy("key").agg(F.count("*").alias("n"), *[F.sum(f"y{i}").alias(f"y{i}") for i in range(len(names))])
        .where("n >= 3"),
        "tox-features",
    )
    keys: set[int] = set()
    for i, p in enumerate(positive):
        share = p / total
        expected = F.col("n") * share
        chi = F.pow(F.col(f"y{i}") - expected, 2) / (expected * (1 - share))
        keys |= {r.key for r in seen.orderBy(chi.desc(), "key").limit(MAX_FEATURES).select("key").collect()}
    chosen = np.sort(np.array(sorted(keys), dtype=np.int64).view(np.uint64))
    if not len(chosen):
        return None

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch.column("text")):
                text, place = _hits(piece, chosen)
                edges = np.searchsorted(text, np.arange(piece.n + 1))
                lists = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(place.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [lists] + [batch.column(c).slice(piece.rows.start, piece.n) for c in ("doc_id", *(f"y{i}" for i in range(len(names))))],
                    ["found", "doc_id", *(f"y{i}" for i in range(len(names)))],
                )

    got = mine.mapInArrow(
        gather, "found array<int>, doc_id long, " + ", ".join(f"y{i} int" for i in range(len(names)))
    ).toArrow().sort_by("doc_id")
    found = got.column("found").combine_chunks()
    lengths = found.value_lengths().to_numpy()
    rows = np.repeat(np.arange(len(lengths)), lengths)
    cols = found.flatten().to_numpy()
    y = np.stack([got.column(f"y{i}").to_numpy() for i in range(len(names))], axis=1).astype(float)
    # sorted by id, so folds do not depend on the order of arrival
    return fit_chain(names, chosen, rows, cols, np.arange(len(y)) % FOLDS, y)


def score(docs: DataFrame, chain: Chain | None, categories: list[str]) -> DataFrame:
    """doc_id, p_<category> and is_<category> for each category - one row per row of docs.

    A null text is scored as an empty one; null and repeated ids are scored like any other; other columns are
    not read; an empty table gives no rows. Without a chain all probabilities are null and flags false.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch.column("text")):
                if chain is not None:
                    p = chain.probabilities(*_hits(piece, chain.keys), piece.n)
                columns = [batch.column("doc_id").slice(piece.rows.start, piece.n)]
                for c in range(len(categories)):
                    columns.append(pa.nulls(piece.n, pa.float64()) if chain is None else pa.array(p[:, c]))
                for c in range(len(categories)):
                    columns.append(pa.array(np.zeros(piece.n, bool) if chain is None else p[:, c] >= chain.thresholds[c]))
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", *(f"p_{c}" for c in categories), *(f"is_{c}" for c in categories)]
    schema = "doc_id long, " + ", ".join([f"p_{c} double" for c in categories] + [f"is_{c} boolean" for c in categories])
    return only(docs, doc_id="long", text="string").mapInArrow(run, schema)
