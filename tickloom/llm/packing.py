"""Packing documents into training sequences: vector bin packing by the dot-product heuristic.

Every piece has three demands: tokens, segments (1) and loss-bearing tokens. An open sequence takes, of
the pieces that still fit in all three, the one with the largest weighted dot product of its demands and
the room left. Whole chunks of a long document are sequences of their own; what is left over of each
document waits in a bounded pool from which sequences are filled. Each task packs its own rows, so nothing
is shuffled, and a lost task is packed again the same way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.tables import only
from tickloom.llm.tokens import word_pool
from tickloom.llm.words import pieces

MAX_TOKENS = 2048
MAX_SEGMENTS = 512
MAX_LOSS = 2048
POOL_PIECES = 4096
"""Waiting pieces at which sequences are filled, down to half of it; the rest at the end."""
END_ID = 1


def pack(demands: np.ndarray, limits: np.ndarray, leave: int = 0) -> list[list[int]]:
    """Rows of ``demands`` (n, d) dealt into bins under ``limits``, until at most ``leave`` rows are left.

    Weights make scarce limits count more: the mean demand of the rows as a share of the limit.
    """
    if not len(demands):
        return []
    if (demands > limits).any():
        raise ValueError("a piece is larger than a limit")
    weight = (demands / limits).mean(axis=0)
    # rows with equal demands are one kind; kinds are sorted by the first demand, so the room left cuts them short
    kinds, kind_of, left = np.unique(demands, axis=0, return_inverse=True, return_counts=True)
    rows = np.argsort(kind_of.ravel(), kind="stable")
    share, next_row = kinds / limits, np.cumsum(left) - left
    waiting, bins = len(demands), []
    while waiting > leave:
        room, chosen, reach = np.ones(share.shape[1]), [], len(share)
        while True:
            reach = int(np.searchsorted(share[:reach, 0], room[0] + 1e-12, side="right"))
            part = share[:reach]
            scores = part @ (weight * room)
            scores[(left[:reach] == 0) | (part[:, 1:] > room[1:] + 1e-12).any(axis=1)] = -1.0
            best = int(np.argmax(scores)) if reach else 0
            if not reach or scores[best] < 0:
                break
            chosen.append(int(rows[next_row[best]]))
            next_row[best] += 1
            left[best] -= 1
            room = room - share[best]
        waiting -= len(chosen)
        bins.append(chosen)
        alive = left > 0
        if not alive.all():
            share, left, next_row = share[alive], left[alive], next_row[alive]
    return bins


def pack_documents(
    docs: DataFrame, tokenizer: str | None = None, max_tokens: int = MAX_TOKENS,
    max_segments: int = MAX_SEGMENTS, max_loss: int = MAX_LOSS, pool: int = POOL_PIECES,
) -> DataFrame:
    """One row per piece: doc_id, start, ids (unsigned 32-bit, little-endian), doc_tokens, loss_tokens,
    sequence_id, offset.

    A document is its ids and END_ID; a null or empty text is END_ID alone. It is cut after every
    ``min(max_tokens, max_loss)`` ids. All ids bear loss but a document's first, which nothing predicts. Rows
    with null or repeated ids are packed like any other; sequence ids hold the task's number in the upper
    half. Other columns are not read; an empty table gives no rows.
    """
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    chunk = min(max_tokens, max_loss)
    limits = np.array([max_tokens, max_segments, max_loss], dtype=float)
    names = ["doc_id", "start", "ids", "doc_tokens", "loss_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_pool(path)
        sequence = TaskContext.get().partitionId() << 32
        waiting: list[tuple] = []  # (doc_id, start, ids, doc_tokens)
        out: list[tuple] = []

        def emit() -> pa.RecordBatch:
            types = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            batch = pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*out), types)], names
            )
            out.clear()
            return batch

        def place(members: list[tuple]) -> None:
            nonlocal sequence
            offset = 0
            for doc_id, start, ids, total in members:
                n = len(ids) // 4
                out.append((doc_id, start, ids, total, n - (start == 0), sequence, offset))
                offset += n
            sequence += 1

        def fill(leave: int) -> None:
            demands = np.array([(len(p[2]) // 4, 1, len(p[2]) // 4 - (p[1] == 0)) for p in waiting], dtype=float)
            left = set(range(len(waiting)))
            for members in pack(demands.reshape(-1, 3), limits, leave):
                place([waiting[i] for i in members])
                left.difference_update(members)
            waiting[:] = [waiting[i] for i in sorted(left)]

        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            for piece in pieces(batch.column("text")):
                ids, edges = words.ids(piece)
                for i in range(piece.n):
                    own = np.append(ids[edges[i] : edges[i + 1]], np.uint32(END_ID)).astype("<u4").tobytes()
                    total, doc_id = len(own) // 4, doc_ids[piece.rows.start + i]
                    for start in range(0, total, chunk):
                        part = (doc_id, start, own[4 * start : 4 * (start + chunk)], total)
                        if len(part[2]) == 4 * chunk:
                            place([part])
                        else:
                            waiting.append(part)
                if len(waiting) >= pool:
                    fill(pool // 2)
                if out:
                    yield emit()
        fill(0)
        if out:
            yield emit()

    return only(docs, doc_id="long", text="string").mapInArrow(
        run,
        "doc_id long, start long, ids binary, doc_tokens long, loss_tokens long, sequence_id long, offset long",
    )


def digest(packed: DataFrame) -> DataFrame:
    """The pieces with length and CRC-32 of their ids in place of the ids."""
    return packed.select(
        "doc_id", "start", (F.length("ids") / 4).cast("long").alias("length"), F.crc32("ids").alias("ids_crc32"),
        "doc_tokens", "loss_tokens", "sequence_id", "offset",
    )
