"""Removing repeated passages: suffix automata of reference passages, documents streamed against them.

A window is ``WINDOW`` consecutive words. A window goes if its words also start earlier, in a smaller document
or before it in the same one; what goes is judged on the input. The steps:

1. Texts that hold the same words are found by a 128-bit hash; of each group only the first is looked at.
2. Every window has an anchor, the GRAM consecutive words in it with the least hash, so equal windows have equal
   anchors. Anchors are counted over the whole corpus, and only windows around a repeated anchor go on.
3. Neighbouring windows with one anchor form a segment. Equal segments are counted once; the first stays.
4. Distinct segments that share the words around their anchor form a reference shard. In order of
   document and place, each is streamed through the suffix automaton of those before it: where the matching
   statistic reaches the length of a window, that window started earlier. Then it joins the automaton.

A shard cannot be broadcast whole, as the references grow with the corpus; each shard goes to one task
together with the segments that can match it. Its rows are distinct segments around one place of a passage; at
the edge of a passage these are as many as the documents that hold it. A shard of more than SHARD_ROWS rows
is therefore not matched in one place: its windows are dealt by their own hashes, and of equal windows the
first stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import sidefiles
from tickloom.llm.automaton import SuffixAutomaton
from tickloom.llm.tables import only, small_batches
from tickloom.llm.words import Piece, Words, covered, gram_hashes, mix, pieces, range_hashes
from tickloom.session import stored

WINDOW = 20
GRAM = 6
SHARD_ROWS = 512
"""Segments that one automaton takes; the windows of a larger shard are compared by hash."""
_SECOND = np.uint64(0xA24BAED4963EE407)
_PLACE_BITS = np.uint64(28)


def second_hash(hashes: np.ndarray) -> np.ndarray:
    """Word hashes of an independent family."""
    return mix(hashes ^ _SECOND)


def anchors(words: Words, hashes: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first words of all windows, place of each window's anchor, anchor hash by place)."""
    starts = words.gram_starts(window)
    grams = words.gram_starts(gram)
    values = np.zeros(len(hashes), dtype=np.uint64)
    values[grams] = gram_hashes(hashes, grams, gram)
    # hash above, place below: the least is the leftmost of the least hashes
    keys = np.full(len(hashes) + window, np.iinfo(np.uint64).max, dtype=np.uint64)
    keys[grams] = (values[grams] >> _PLACE_BITS << _PLACE_BITS) | grams.astype(np.uint64)
    span, reach = window - gram + 1, 1
    while reach < span:
        step = min(reach, span - reach)
        keys[: len(keys) - step] = np.minimum(keys[: len(keys) - step], keys[step:])
        reach += step
    place = (keys[starts] & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)
    return starts, place, values


def _text_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of words and the hash of the word sequence of each text."""
    for batch, part, first in sidefiles.numbered(batches):
        for piece in pieces(batch.column("text")):
            words = piece.words()
            key1, key2 = _text_keys(words, words.hashes())
            n = piece.n
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, part, np.int32)), pa.array(first + piece.rows.start + np.arange(n)),
                 batch.column("doc_id").slice(piece.rows.start, n), pa.array(words.counts.astype(np.int64)),
                 pa.array(key1.view(np.int64)), pa.array(key2.view(np.int64))],
                ["part", "row", "doc_id", "n_words", "key1", "key2"],
            )


def _text_keys(words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of the word sequence of each text."""
    a, b = words.first[:-1], words.first[1:]
    size = (b - a).astype(np.uint64)
    return mix(range_hashes(hashes, a, b) + size), mix(range_hashes(second_hash(hashes), a, b) ^ size)


def _anchor_pass(window: int, gram: int, places: bool):
    """Distinct anchors of each text (with a flag for several places), or all places of anchors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, part, first in sidefiles.numbered(batches):
            for piece in pieces(batch.column("text")):
                words = piece.words()
                hashes = words.hashes()
                _, place, values = anchors(words, hashes, window, gram)
                if not len(place):
                    continue
                place = place[np.append(True, place[1:] != place[:-1])]
                text = np.searchsorted(words.first, place, side="right") - 1
                value = values[place]
                if places:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(value.view(np.int64)), pa.array(np.full(len(place), part, np.int32)),
                         pa.array(first + piece.rows.start + text),
                         batch.column("doc_id").slice(piece.rows.start, piece.n).take(pa.array(text)),
                         pa.array((place - words.first[text]).astype(np.int32))],
                        ["anchor", "part", "row", "doc_id", "place"],
                    )
                    continue
                key = _text_keys(words, hashes)[0].view(np.int64)
                order = np.lexsort((value, text))
                text, value = text[order], value[order]
                new = np.append(True, (text[1:] != text[:-1]) | (value[1:] != value[:-1]))
                many = np.diff(np.append(np.flatnonzero(new), len(new))) > 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(value[new].view(np.int64)), pa.array(key[text[new]]), pa.array(many)], ["anchor", "text", "many"]
                )
    return run


SEGMENTS = (
    "part int, row long, doc_id long, start int, n int, offset int, hash1 long, hash2 long"
)


def _segment_pass(folder: str, window: int, gram: int):
    """Segments around the anchors whose places are in the side folder."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        side = None
        for batch, part, first in sidefiles.numbered(batches):
            side = side or sidefiles.SideReader(folder, part)
            for piece in pieces(batch.column("text")):
                at = first + piece.rows.start
                facts = side.of(at, piece.n)
                if facts is None:
                    continue
                sidefiles.same_rows(facts, at, batch.column("doc_id").slice(piece.rows.start, piece.n))
                words = piece.words()
                hashes = words.hashes()
                starts, place, _ = anchors(words, hashes, window, gram)
                known = words.first[facts.column("row").to_numpy() - at] + facts.column("place").to_numpy()
                flags = np.zeros(len(words) + 1, dtype=bool)
                flags[known] = True
                keep = flags[place]
                starts, place = starts[keep], place[keep]
                if not len(starts):
                    continue
                a = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
                n = np.diff(np.append(a, len(place)))
                begin, anchor = starts[a], place[a]
                text = np.searchsorted(words.first, begin, side="right") - 1
                end = begin + n - 1 + window
                salt = n.astype(np.uint64)
                hash1 = mix(range_hashes(hashes, begin, end) + salt)
                hash2 = mix(range_hashes(second_hash(hashes), begin, end) ^ salt)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(a), part, np.int32)), pa.array(at + text),
                     batch.column("doc_id").slice(piece.rows.start, piece.n).take(pa.array(text)),
                     pa.array((begin - words.first[text]).astype(np.int32)), pa.array(n.astype(np.int32)),
                     pa.array((anchor - begin).astype(np.int32)), pa.array(hash1.view(np.int64)), pa.array(hash2.view(np.int64))],
                    [x.split()[0] for x in SEGMENTS.split(", ")],
                )
    return run


HALVES = (
    "key1 long, key2 long, part int, row long, doc_id long, start int, hash1 long, hash2 long, skip int, size int, "
    "tokens array<long>"
)


def _half_pass(folder: str, window: int, gram: int):
    """The two halves of first segments: windows with most of their words left, or right, of the anchor.

    All windows of a half hold the ``core``: the anchor and ``near`` words on one side. The core becomes one
    token, so a window is ``size`` tokens, and halves with equal cores can be compared.
    """
    spare = window - gram
    near_left, near_right = spare // 2, spare - spare // 2 + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        side = None
        names = [x.split()[0] for x in HALVES.split(", ")]
        for batch, part, first in sidefiles.numbered(batches):
            side = side or sidefiles.SideReader(folder, part)
            for piece in pieces(batch.column("text")):
                at = first + piece.rows.start
                facts = side.of(at, piece.n)
                if facts is None:
                    continue
                sidefiles.same_rows(facts, at, batch.column("doc_id").slice(piece.rows.start, piece.n))
                words = piece.words()
                hashes = words.hashes()
                others = second_hash(hashes)
                text = facts.column("row").to_numpy() - at
                start, n, offset = (facts.column(c).to_numpy().astype(np.int64) for c in ("start", "n", "offset"))
                begin = words.first[text] + start
                anchor = begin + offset
                for half in (0, 1):
                    if half == 0:  # window j has offset - j words left of the anchor
                        low, high = np.zeros_like(n), np.minimum(n - 1, offset - near_left)
                        core_a, core_b = anchor - near_left, anchor + gram
                    else:
                        low, high = np.maximum(0, offset - near_left + 1), n - 1
                        core_a, core_b = anchor, anchor + gram + near_right
                    some = high >= low
                    if not some.any():
                        continue
                    low, high, a, b = low[some], high[some], core_a[some], core_b[some]
                    left, right = begin[some] + low, begin[some] + high + window
                    salt = np.uint64(half + 1)
                    key1 = mix(range_hashes(hashes, a, b) + salt)
                    key2 = mix(range_hashes(others, a, b) ^ salt)
                    lengths = (a - left) + 1 + (right - b)
                    edges = np.append(0, np.cumsum(lengths))
                    inner = np.arange(edges[-1]) - np.repeat(edges[:-1], lengths)
                    before = np.repeat(a - left, lengths)
                    source = np.where(inner < before, np.repeat(left, lengths) + inner,
                                      np.repeat(b, lengths) + inner - before - 1)
                    tokens = hashes[np.minimum(source, len(hashes) - 1)].view(np.int64).copy()
                    tokens[inner == before] = 0
                    which = np.flatnonzero(some)
                    pick = pa.array(which)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key1.view(np.int64)), pa.array(key2.view(np.int64)),
                         pa.array(np.full(len(which), part, np.int32)), facts.column("row").combine_chunks().take(pick),
                         facts.column("doc_id").combine_chunks().take(pick), pa.array(start[some].astype(np.int32)),
                         facts.column("hash1").combine_chunks().take(pick), facts.column("hash2").combine_chunks().take(pick),
                         pa.array(low.astype(np.int32)), pa.array(np.full(len(which), window - (b - a)[0] + 1, np.int32)),
                         pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(tokens))],
                        names,
                    )
    return run


def _match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard and place: bit masks of the windows that started earlier in the shard."""
    shard, held, automaton = None, None, None

    def result(rows):
        a, b, m = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(m, pa.int32())], ["hash1", "hash2", "mask"]
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        key1, key2 = batch.column("key1").to_numpy(), batch.column("key2").to_numpy()
        same = np.append(False, (key1[1:] == key1[:-1]) & (key2[1:] == key2[:-1]))
        if shard is not None and (int(key1[0]), int(key2[0])) == shard:
            same[0] = True
        lone = ~same & ~np.append(same[1:], False)
        lone[-1] = False  # its shard may go on in the next batch
        tokens, skip, size = batch.column("tokens"), batch.column("skip").to_numpy(), batch.column("size").to_numpy()
        hash1, hash2 = batch.column("hash1").to_numpy(), batch.column("hash2").to_numpy()
        flat, edges = tokens.flatten().to_pylist(), tokens.offsets.to_numpy() - tokens.offsets[0].as_py()
        out = []
        for i in np.flatnonzero(~lone).tolist():
            passage = flat[edges[i] : edges[i + 1]]
            if not same[i]:
                shard, held, automaton = (int(key1[i]), int(key2[i])), passage, None
                continue
            if automaton is None:
                automaton = SuffixAutomaton()
                automaton.add(held)
            need, mask = int(size[i]), 0
            found = automaton.matches(passage)
            for j in range(need - 1, len(passage)):
                if found[j] >= need:
                    mask |= 1 << (j - need + 1)
            if mask != (1 << (len(passage) - need + 1)) - 1:
                automaton.add(passage)
            if mask:
                out.append((int(hash1[i]), int(hash2[i]), mask << int(skip[i])))
        if out:
            yield result(out)


def _single_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each window of the halves by two hashes, with its place and its bit in the segment's mask.

    Equal windows have their core at the same place, so they are equal tokens of one shard."""
    for batch in batches:
        if not batch.num_rows:
            continue
        tokens = batch.column("tokens")
        flat = tokens.flatten().to_numpy().view(np.uint64)
        edges = tokens.offsets.to_numpy().astype(np.int64)
        edges = edges - edges[0]
        size, skip = (batch.column(c).to_numpy().astype(np.int64) for c in ("size", "skip"))
        n = np.diff(edges) - size + 1
        row = np.repeat(np.arange(len(n)), n)
        j = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        a = edges[row] + j
        b = a + size[row]
        key1, key2 = (batch.column(c).to_numpy().view(np.uint64)[row] for c in ("key1", "key2"))
        window1 = mix(range_hashes(flat, a, b) ^ key1)
        window2 = mix(range_hashes(second_hash(flat), a, b) ^ key2)
        pick = pa.array(row)
        yield pa.RecordBatch.from_arrays(
            [pa.array(window1.view(np.int64)), pa.array(window2.view(np.int64)),
             *[batch.column(c).take(pick) for c in ("part", "row", "doc_id")],
             pa.array((batch.column("start").to_numpy()[row] + skip[row] + j).astype(np.int32)),
             *[batch.column(c).take(pick) for c in ("hash1", "hash2")],
             pa.array((np.int64(1) << (skip[row] + j)).astype(np.int32))],
            ["window1", "window2", "part", "row", "doc_id", "place", "hash1", "hash2", "bit"],
        )


def _crowded_masks(halves: DataFrame) -> DataFrame:
    """hash1, hash2, mask of the windows that started earlier, of halves in shards of any size.

    Only the first of equal windows is left after a pre-aggregated minimum, so no key gathers rows; what is
    not the first of its window goes.
    """
    windows = halves.mapInArrow(
        _single_windows,
        "window1 long, window2 long, part int, row long, doc_id long, place int, hash1 long, hash2 long, bit int",
    )
    begins = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "part", "row", "place", "hash1", "hash2", "bit")
    kept = windows.groupBy("window1", "window2").agg(F.min(begins).alias("first")).select(
        "first.hash1", "first.hash2", F.col("first.bit").alias("mask")
    )
    every = halves.select("hash1", "hash2", F.expr("cast(shiftleft(shiftleft(1, size(tokens) - size + 1) - 1, skip) as int)").alias("mask"))
    return every.unionByName(kept).groupBy("hash1", "hash2").agg(F.bit_xor("mask").alias("mask"))


def find_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> str:
    """Write what is to be removed from each row of docs (doc_id, text); gives the side folder.

    Facts are (part, row, doc_id, start, mask): bit j says that the window at word start + j goes;
    start = -1: all words go. Rows without an id come after all others, rows with one id in the order of the scan.
    """
    if window - gram > 29:
        raise ValueError("a segment's windows must fit a 32-bit mask")
    spark = docs.sparkSession
    sidefiles.pin_splits(spark)
    texts = stored(
        docs.mapInArrow(_text_pass, "part int, row long, doc_id long, n_words long, key1 long, key2 long"),
        "rep-texts",
    ).where(F.col("n_words") >= window)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "part", "row")
    firsts = stored(
        texts.groupBy("key1", "key2").agg(F.min(order).alias("first"), F.count("*").alias("copies"))
        .where("copies > 1").select(F.col("key1").alias("k1"), F.col("key2").alias("k2"), "first.part", "first.row")
        .withColumnsRenamed({"part": "first_part", "row": "first_row"}),
        "rep-firsts",
    )
    copies = stored(
        texts.join(firsts, (F.col("key1") == F.col("k1")) & (F.col("key2") == F.col("k2")))
        .where((F.col("part") != F.col("first_part")) | (F.col("row") != F.col("first_row")))
        .select("part", "row", "doc_id"),
        "rep-copies",
    )
    # anchors that two different texts hold, or one text at two places
    repeated = (
        docs.mapInArrow(_anchor_pass(window, gram, False), "anchor long, text long, many boolean")
        .groupBy("anchor").agg(F.min("text").alias("low"), F.max("text").alias("high"), F.max("many").alias("many"))
        .where("low < high or many").select(F.col("anchor").alias("known"))
    )
    repeated = stored(repeated, "rep-anchors")
    places = docs.mapInArrow(_anchor_pass(window, gram, True), "anchor long, part int, row long, doc_id long, place int")
    places = places.join(repeated, F.col("anchor") == F.col("known"), "left_semi").select("part", "row", "doc_id", "place")
    places = places.join(copies, ["part", "row"], "left_anti")
    side = sidefiles.write_side(places, "rep-places")
    segments = stored(docs.mapInArrow(_segment_pass(side, window, gram), SEGMENTS), "rep-segments")
    begins = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "part", "row", "start", "n", "offset")
    distinct = stored(
        segments.groupBy("hash1", "hash2").agg(F.min(begins).alias("first")).select("hash1", "hash2", "first.*"),
        "rep-distinct",
    )
    side = sidefiles.write_side(
        distinct.select("part", "row", "doc_id", "start", "n", "offset", "hash1", "hash2"), "rep-references"
    )
    halves = stored(docs.mapInArrow(_half_pass(side, window, gram), HALVES), "rep-halves")
    crowded = stored(
        halves.groupBy("key1", "key2").count().where(F.col("count") > SHARD_ROWS)
        .select(F.col("key1").alias("k1"), F.col("key2").alias("k2")),
        "rep-crowded",
    )
    in_crowded = (F.col("key1") == F.col("k1")) & (F.col("key2") == F.col("k2"))
    masks = (
        halves.join(crowded, in_crowded, "left_anti").repartition("key1", "key2")
        .sortWithinPartitions("key1", "key2", F.col("doc_id").asc_nulls_last(), "part", "row", "start")
        .mapInArrow(_match, "hash1 long, hash2 long, mask int")
    )
    if not crowded.isEmpty():
        large = stored(halves.join(crowded, in_crowded, "left_semi"), "rep-large")
        masks = masks.unionByName(_crowded_masks(large))
    masks = masks.groupBy("hash1", "hash2").agg(F.bit_or("mask").alias("mask"))
    verdict = stored(
        distinct.join(masks, ["hash1", "hash2"], "left").select(
            F.col("hash1").alias("h1"), F.col("hash2").alias("h2"), F.col("part").alias("first_part"),
            F.col("row").alias("first_row"), F.col("start").alias("first_start"), F.coalesce("mask", F.lit(0)).alias("mask"),
        ),
        "rep-verdict",
    )
    first = (
        (F.col("part") == F.col("first_part")) & (F.col("row") == F.col("first_row")) & (F.col("start") == F.col("first_start"))
    )
    every = (F.expr("shiftleft(1, n)") - 1).cast("int")
    gone = (
        segments.join(verdict, (F.col("hash1") == F.col("h1")) & (F.col("hash2") == F.col("h2")))
        .select("part", "row", "doc_id", "start", F.when(first, F.col("mask")).otherwise(every).alias("mask"))
        .where("mask <> 0")
    )
    gone = gone.unionByName(copies.select("part", "row", "doc_id", F.lit(-1).alias("start"), F.lit(0).alias("mask")))
    return sidefiles.write_side(gone, "rep-gone")


def _judged(piece: Piece, at: int, side: sidefiles.SideReader, doc_ids: pa.Array, window: int) -> tuple[Words, np.ndarray]:
    """Words of a piece, and flags of those to be removed."""
    words = piece.words()
    facts = side.of(at, piece.n)
    if facts is None:
        return words, np.zeros(len(words), dtype=bool)
    sidefiles.same_rows(facts, at, doc_ids)
    text = facts.column("row").to_numpy() - at
    start, mask = facts.column("start").to_numpy().astype(np.int64), facts.column("mask").to_numpy()
    whole = start < 0
    begins = [
        (words.first[text] + start + j)[~whole & ((mask >> j) & 1 > 0)] for j in range(30)
    ]
    gone = covered(np.concatenate(begins), window, len(words))
    for t in text[whole].tolist():
        gone[words.first[t] : words.first[t + 1]] = True
    return words, gone


def _kept(piece: Piece, words: Words, gone: np.ndarray) -> list[bytes]:
    """The kept words of each text, joined by one space."""
    raw = piece.data.tobytes()
    dirty = words.per_text(gone.astype(np.int64)) > 0
    out = []
    for i in range(piece.n):
        if dirty[i]:
            at = np.flatnonzero(~gone[words.first[i] : words.first[i + 1]]) + words.first[i]
            out.append(b" ".join([raw[a:b] for a, b in zip(words.start[at].tolist(), words.end[at].tolist())]))
        else:
            out.append(b" ".join(raw[piece.edges[i] : piece.edges[i + 1]].split()))
    return out


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the kept words joined by one space) - one row per row of docs.

    A null text has no words. Rows without an id count as later than all others; of rows with one id the
    scan's order decides. Other columns are not read; an empty table gives no rows. docs must scan alike each
    time (a table read from files does).
    """
    rows = only(docs, doc_id="long", text="string")
    folder = find_repeats(rows, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        side = None
        for batch, part, first in sidefiles.numbered(batches):
            side = side or sidefiles.SideReader(folder, part)
            for piece in pieces(batch.column("text")):
                ids = batch.column("doc_id").slice(piece.rows.start, piece.n)
                words, gone = _judged(piece, first + piece.rows.start, side, ids, window)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(words.counts.astype(np.int64)), pa.array(words.per_text(gone.astype(np.int64))),
                     pa.array([x.decode() for x in _kept(piece, words, gone)], pa.string())],
                    ["doc_id", "n_words", "n_removed", "kept"],
                )

    return rows.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """docs with repeated windows cut out of the text; a text that loses nothing stays as it is.

    A row that loses all its words is dropped. n_chars, where it is a column, follows the new text.
    """
    folder = find_repeats(only(docs, doc_id="long", text="string"), window)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        side = None
        for batch, part, first in sidefiles.numbered(batches):
            side = side or sidefiles.SideReader(folder, part)
            column = batch.schema.get_field_index("text")
            ids = batch.column(batch.schema.get_field_index("doc_id")).cast(pa.int64())
            texts, keep = batch.column(column).to_pylist(), np.ones(batch.num_rows, dtype=bool)
            for piece in pieces(batch.column(column)):
                at = piece.rows.start
                words, gone = _judged(piece, first + at, side, ids.slice(at, piece.n), window)
                lost = words.per_text(gone.astype(np.int64))
                if lost.any():
                    kept = _kept(piece, words, gone)
                    for i in np.flatnonzero(lost).tolist():
                        texts[at + i] = kept[i].decode()
                        keep[at + i] = lost[i] < words.counts[i]
            out = batch.set_column(column, "text", pa.array(texts, batch.schema.field(column).type))
            yield out.filter(pa.array(keep))

    cut = small_batches(docs).mapInArrow(run, docs.schema)
    if "n_chars" not in names:
        return cut
    length = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType)
    return cut.withColumn("n_chars", length).select(*names)
