"""Collocations from a weighted de Bruijn graph of words.

Texts are cut into pieces; four consecutive words of a piece are an edge from the node of its first three words to the
node of its last three. Edges are aggregated with their weights. Shorter phrases are not counted in the texts: every
place of a piece starts exactly one edge or, in its last three places, one shorter piece end, so the count of a node
is the flow that leaves it plus the piece ends at it, and the count of two words is the flow of the nodes that start
with them plus the ends of two words. Unary paths, on which node after node passes its whole flow on to the next, are
compacted into passages: their inner nodes have the weight of the path and lie inside longer phrases by definition.

No phrase of MIN_COUNT can span two words that stand side by side less often, so pieces are also cut there: pairs are
counted first, and a bitmap of fixed size marks the slots of frequent pairs. What is left of three words is counted and
marked likewise, and an edge goes no further than marked triples do. Both counts are of 40 bits of a hash, moved as
packed lists. A rare pair or triple that falls into a marked slot stays, which costs work but changes no count. Words
are 64-bit hashes until the phrases are ranked.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.tables import only
from tickloom.llm.words import Piece, Words, byte_table, mix, pieces, prefix
from tickloom.session import stored

LONGEST = 4
MIN_COUNT = 30
INSIDE = 80
"""Percent of a phrase's count at which a longer phrase that holds it stands for it."""
SCALE = 2_000_000
TOP = 2000
PAIR_SLOTS = 1 << 23
"""Slots of a bitmap of pairs or of triples."""
NO_LANG = "und"

_CHUNK = 1 << 11
"""Slots whose counts come to one place."""
_MORE_BITS = 17
"""Bits of a hash besides its slot by which counts are told apart."""
_KEPT = 1 << 21
_MARKS = byte_table(b".,;:!?\n\x0b\x0c\r")
_WORD = ~byte_table(b" \t.,;:!?\n\x0b\x0c\r")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_EMPTY = np.uint64(0)


def _read(piece: Piece) -> tuple[Piece, Words, np.ndarray, np.ndarray]:
    """Lower-cased piece, its words, their hashes (never 0), and whether the next word follows in the same piece."""
    lowered = Piece(_LOWER[piece.data], piece.edges, piece.rows)
    words = lowered.words(_WORD)
    marks = prefix(_MARKS[lowered.data])
    follows = np.zeros(len(words), dtype=bool)
    if len(words) > 1:
        text = words.text_of()
        follows[:-1] = (marks[words.start[1:]] == marks[words.end[:-1]]) & (text[1:] == text[:-1])
    return lowered, words, words.hashes() | np.uint64(1), follows


def _pair_hashes(lang: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(mix(first ^ (lang * np.uint64(0x9FB21C651E98DF25))) + second)


def _lang_codes(column: pa.Array) -> tuple[np.ndarray, list[str]]:
    coded = column.fill_null(NO_LANG).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_pylist()


def _lang_hashes(names: list[str]) -> np.ndarray:
    """A hash of each language, the same in every task."""
    piece = next(pieces(pa.array(names, pa.string())))
    return piece.hash_ranges(piece.edges[:-1], piece.edges[1:])


class _Sums:
    """Counts by key, merged as they come, so memory follows the distinct keys of a flush."""

    def __init__(self):
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, keys: np.ndarray) -> None:
        if len(keys):
            self.parts.append(keys)
            self.size += len(keys)

    def flush(self) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate(self.parts) if self.parts else np.zeros(0, np.uint64)
        self.parts, self.size = [], 0
        return np.unique(keys, return_counts=True)


def count_words(docs: DataFrame) -> DataFrame:
    """lang, word, hash, n: all words of each language; lang without a word has no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, bytes], list[int]] = {}
        for batch in batches:
            codes, names = _lang_codes(batch.column("lang"))
            for piece in pieces(batch.column("text")):
                lowered, words, hashes, _ = _read(piece)
                lang = codes[piece.rows][words.text_of()]
                salted = hashes ^ mix(lang.astype(np.uint64))
                _, at, n = np.unique(salted, return_index=True, return_counts=True)
                raw = lowered.data.tobytes()
                for i, code, m in zip(at.tolist(), lang[at].tolist(), n.tolist()):
                    key = names[code], raw[words.start[i] : words.end[i]]
                    known = counts.get(key)
                    if known is None:
                        counts[key] = [int(hashes[i].view(np.int64)), m]
                    else:
                        known[1] += m
                if len(counts) > 1 << 18:
                    yield _word_rows(counts)
                    counts.clear()
        if counts:
            yield _word_rows(counts)

    rows = docs.mapInArrow(run, "lang string, word string, hash long, n long")
    return rows.groupBy("lang", "word").agg(F.first("hash").alias("hash"), F.sum("n").alias("n"))


def _word_rows(counts: dict) -> pa.RecordBatch:
    langs, words = zip(*counts)
    hashes, n = zip(*counts.values())
    return pa.RecordBatch.from_arrays(
        [pa.array(langs), pa.array(words, pa.binary()).cast(pa.string()), pa.array(hashes, pa.int64()), pa.array(n, pa.int64())],
        ["lang", "word", "hash", "n"],
    )


def _frequent(docs: DataFrame, grams: Callable[[Words, np.ndarray, np.ndarray, np.ndarray], np.ndarray], min_count: int) -> np.ndarray:
    """Flags, packed, of the slots of the grams that occur at least ``min_count`` times: PAIR_SLOTS bits, however large
    the corpus. ``grams`` gives the hashes of those of a piece, from its words, their hashes, language and follows."""
    slot_bits = PAIR_SLOTS.bit_length() - 1
    rest = _MORE_BITS + _CHUNK.bit_length() - 1
    kind = np.min_scalar_type(min_count)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums()
        for batch in batches:
            codes, names = _lang_codes(batch.column("lang"))
            of = _lang_hashes(names) if names else np.zeros(0, np.uint64)
            for piece in pieces(batch.column("text")):
                _, words, hashes, follows = _read(piece)
                h = grams(words, hashes, of[codes[piece.rows][words.text_of()]], follows)
                slot, more = h & np.uint64(PAIR_SLOTS - 1), (h >> np.uint64(slot_bits)) & np.uint64((1 << _MORE_BITS) - 1)
                sums.add((slot << np.uint64(_MORE_BITS)) | more)
                if sums.size > _KEPT:
                    yield packed(*sums.flush())
        if sums.size:
            yield packed(*sums.flush())

    def packed(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        chunks, at = np.unique(keys >> np.uint64(rest), return_index=True)
        edges = [*at.tolist(), len(keys)]
        low, n = (keys & np.uint64((1 << rest) - 1)).astype(np.uint32), np.minimum(n, min_count).astype(kind)
        spans = list(zip(edges, edges[1:]))
        # byte by byte of all numbers, as the high bytes of sorted numbers hardly differ
        lists = [low[a:b].view(np.uint8).reshape(-1, 4).T.tobytes() for a, b in spans], [n[a:b].tobytes() for a, b in spans]
        return pa.RecordBatch.from_arrays(
            [pa.array(chunks.astype(np.int32)), *(pa.array(x, pa.binary()) for x in lists)], ["chunk", "low", "n"]
        )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for chunk, *lists in zip(*(batch.column(c).to_pylist() for c in ("chunk", "low", "n"))):
                if chunk != now and held:
                    yield flags(now, held)
                    held = []
                now = chunk
                held.append(lists)
        if held:
            yield flags(now, held)

    def flags(chunk: int, held: list) -> pa.RecordBatch:
        low = np.concatenate([np.frombuffer(x, np.uint8).reshape(4, -1).T.copy().view(np.uint32).ravel() for x, _ in held])
        n = np.concatenate([np.frombuffer(x, kind) for _, x in held]).astype(np.int64)
        order = np.argsort(low)
        low, n = low[order], n[order]
        first = np.flatnonzero(np.append(True, low[1:] != low[:-1]))
        bits = np.zeros(_CHUNK, dtype=bool)
        bits[low[first][np.add.reduceat(n, first) >= min_count] >> _MORE_BITS] = True
        return pa.RecordBatch.from_arrays(
            [pa.array([chunk], pa.int32()), pa.array([np.packbits(bits).tobytes()], pa.binary())], ["chunk", "bits"]
        )

    counts = docs.mapInArrow(run, "chunk int, low binary, n binary").repartition("chunk").sortWithinPartitions("chunk")
    marked = np.zeros(PAIR_SLOTS // 8, dtype=np.uint8)
    for chunk, bits in counts.mapInArrow(merge, "chunk int, bits binary").collect():
        marked[chunk * (_CHUNK // 8) : (chunk + 1) * (_CHUNK // 8)] = np.frombuffer(bits, dtype=np.uint8)
    return marked


def frequent_pairs(docs: DataFrame, min_count: int) -> np.ndarray:
    """Flags of the slots of word pairs that stand side by side at least ``min_count`` times in a language."""

    def grams(words: Words, hashes: np.ndarray, lang: np.ndarray, follows: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(follows)
        return _pair_hashes(lang[at], hashes[at], hashes[at + 1])

    return _frequent(docs, grams, min_count)


def frequent_triples(docs: DataFrame, min_count: int, marked: np.ndarray) -> np.ndarray:
    """As ``frequent_pairs``, of three words in a row whose pairs are both marked."""

    def grams(words: Words, hashes: np.ndarray, lang: np.ndarray, follows: np.ndarray) -> np.ndarray:
        return _triples(hashes, lang, _linked(hashes, lang, follows, marked))[1]

    return _frequent(docs, grams, min_count)


def _is_marked(marked: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = (hashes & np.uint64(PAIR_SLOTS - 1)).astype(np.int64)
    return (marked[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8) & 1).astype(bool)


def _linked(hashes: np.ndarray, lang: np.ndarray, follows: np.ndarray, marked: np.ndarray) -> np.ndarray:
    """Flags of the words that start a marked pair."""
    at = np.flatnonzero(follows)
    linked = np.zeros(len(hashes), dtype=bool)
    linked[at] = _is_marked(marked, _pair_hashes(lang[at], hashes[at], hashes[at + 1]))
    return linked


def _triples(hashes: np.ndarray, lang: np.ndarray, linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words from which two linked pairs go on, and the hashes of their three words."""
    at = np.flatnonzero(linked[:-1] & linked[1:])
    return at, mix(_pair_hashes(lang[at], hashes[at], hashes[at + 1]) + hashes[at + 2])


_WORDS = [f"w{i}" for i in range(1, LONGEST + 1)]


def edges(docs: DataFrame, marked: np.ndarray, triples: np.ndarray) -> DataFrame:
    """lang, w1 .. w4, n: the edges and, with 0 for the words that are not there, the piece ends of two or three words.

    Every place from which a frequent pair starts counts in exactly one row; the third and the fourth word are there if
    the triples that end with them are marked. ``marked``, ``triples``: see ``frequent_pairs``, ``frequent_triples``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, names = _lang_codes(batch.column("lang"))
            of = _lang_hashes(names) if names else np.zeros(0, np.uint64)
            for piece in pieces(batch.column("text")):
                _, words, hashes, follows = _read(piece)
                lang = codes[piece.rows][words.text_of()]
                linked = _linked(hashes, of[lang], follows, marked)
                start = np.flatnonzero(linked)
                if not len(start):
                    continue
                at, three = _triples(hashes, of[lang], linked)
                goes_on = np.zeros(len(words) + LONGEST, dtype=bool)
                goes_on[at] = _is_marked(triples, three)
                padded = np.append(hashes, np.zeros(LONGEST, dtype=np.uint64))
                columns, open_ = [padded[start], padded[start + 1]], np.ones(len(start), dtype=bool)
                for i in range(2, LONGEST):
                    open_ &= goes_on[start + i - 2]
                    columns.append(np.where(open_, padded[start + i], _EMPTY))
                key = lang[start].astype(np.uint64)
                for column in columns:
                    key = mix(key + column)
                _, first, n = np.unique(key, return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names).take(pa.array(lang[start][first])), *(pa.array(c[first].view(np.int64)) for c in columns),
                     pa.array(n.astype(np.int64))],
                    ["lang", *_WORDS, "n"],
                )

    rows = docs.mapInArrow(run, "lang string, " + ", ".join(f"{w} long" for w in _WORDS) + ", n long")
    return rows.groupBy("lang", *_WORDS).agg(F.sum("n").alias("n"))


def _flows(found: DataFrame, min_count: int) -> list[DataFrame]:
    """Counts of the phrases of 2 .. LONGEST words that occur ``min_count`` times (lang, words, a), from edges and ends.

    Each length is the flow of the next longer one plus its own piece ends.
    """
    out, level = [], found
    for size in range(LONGEST, 1, -1):
        keys = ["lang", *_WORDS[:size]]
        if size < LONGEST:
            level = stored(level.groupBy(*keys).agg(F.sum("n").alias("n")), "graph-flow")
        full = level.where((F.col(_WORDS[size - 1]) != 0) & (F.col("n") >= min_count))
        out.append(full.select("lang", F.array(*_WORDS[:size]).alias("words"), F.col("n").alias("a")))
    return out


def passages(nodes: DataFrame, arcs: DataFrame) -> DataFrame:
    """lang, words, inner (a node inside), path: the inner nodes of unary paths and the words of the compacted path.

    ``nodes`` and ``arcs``: lang, words, a of three and of four words. An arc goes on in the next if all flow of the
    node between comes from it and all leaves by the next. No path is a ring: what enters a ring is flow from outside.
    Places on a path are found by doubling steps, so a path of n arcs takes log2 n rounds.
    """
    node = nodes.select("lang", F.col("words").alias("node"), F.col("a").alias("f"))
    into = arcs.select("lang", F.slice("words", 2, LONGEST - 1).alias("node"), F.col("words").alias("before"), F.col("a").alias("f"))
    out = arcs.select("lang", F.slice("words", 1, LONGEST - 1).alias("node"), "words", F.col("a").alias("f"))
    keys = ["lang", "node", "f"]
    inner = stored(node.join(into, keys).join(out, keys).select("lang", "node", "before", "words", "f"), "graph-inner")
    # place of each arc: (head, steps behind it); an arc that continues none is a head
    steps = stored(inner.select("lang", "words", F.col("before").alias("head"), F.lit(1).cast("long").alias("steps")), "graph-steps")
    while not steps.isEmpty():
        then = steps.select("lang", F.col("words").alias("head"), F.col("head").alias("further"), F.col("steps").alias("more"))
        moved = stored(
            steps.join(then, ["lang", "head"], "left").select(
                "lang", "words", F.coalesce("further", "head").alias("head"),
                (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"), F.col("further").isNotNull().alias("moved"),
            ),
            "graph-steps",
        )
        steps = moved.drop("moved")
        if moved.where("moved").isEmpty():
            break
    lasts = F.transform(F.array_sort(F.collect_list(F.struct("steps", F.element_at("words", -1).alias("w")))), lambda x: x.w)
    paths = steps.groupBy("lang", "head").agg(lasts.alias("more")).select("lang", "head", F.concat("head", "more").alias("path"))
    placed = steps.join(stored(paths, "graph-paths"), ["lang", "head"])
    return stored(placed.select("lang", F.slice("words", 1, LONGEST - 1).alias("inner"), "words", "path"), "graph-passages")


def _scored(phrases: DataFrame, counts: DataFrame) -> DataFrame:
    """lang, words, a, score, l, r by the cut that scores lowest, ties to the first; decimals hold any product."""
    size = F.size("words")
    cuts = phrases.select("lang", "words", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select(
        "*", F.slice("words", 1, F.col("k")).alias("left"), F.slice("words", F.col("k") + 1, size - F.col("k")).alias("right")
    )
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(counts.select("lang", F.col("words").alias(side), F.col("a").alias(name)), ["lang", side])
    wide = "decimal(20,0)"
    score = F.expr(f"CAST({SCALE} AS decimal(10,0)) * CAST(a AS {wide}) div (CAST(l AS {wide}) + CAST(r AS {wide}))")
    least = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return cuts.groupBy("lang", "words", "a").agg(least).select("lang", "words", "a", "cut.score", "cut.l", "cut.r")


def _spelled(phrases: DataFrame, column: str, words: DataFrame, name: str) -> DataFrame:
    """``phrases`` with the text of a column of word hashes."""
    key = ["lang", column]
    parts = phrases.select(*key).distinct().select(*key, F.posexplode(column).alias("at", "hash"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x.word), " ")
    spelled = parts.join(words.select("lang", "hash", "word"), ["lang", "hash"]).groupBy(*key).agg(text.alias(name))
    return phrases.join(spelled, key, "left")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score, passage: the first ``top`` phrases of each language.

    A phrase of 2 to LONGEST words that occurs a >= ``min_count`` times inside pieces is cut into two parts that occur l
    and r times; its score is SCALE * a / (l + r), rounded down, of the lowest-scoring cut. Phrases inside a longer one
    with INSIDE percent of their count are dropped. ``n`` counts the words of the language; ``passage`` is the compacted
    unary path that a phrase of LONGEST words lies on, else null. Null and empty texts hold no words, a null lang is
    ``und``, very long texts are read whole, repeated rows count as often as they stand there, other columns are not
    read; an empty table gives no rows.
    """
    docs = only(docs, lang="string", text="string")
    every = stored(count_words(docs), "graph-words")
    totals = every.groupBy("lang").agg(F.sum("n").alias("n"))
    words = stored(every.where(F.col("n") >= min_count), "graph-frequent")
    marked = frequent_pairs(docs, min_count)
    found = stored(edges(docs, marked, frequent_triples(docs, min_count, marked)), "graph-edges")
    quads, triples, pairs = (stored(flow, "graph-phrases") for flow in _flows(found, min_count))
    single = words.select("lang", F.array("hash").alias("words"), F.col("n").alias("a"))
    counts = stored(single.unionByName(pairs).unionByName(triples), "graph-counts")
    phrases = pairs.unionByName(triples).unionByName(quads)
    paths = passages(triples, quads)
    inside = paths.select("lang", F.col("inner").alias("words")).distinct()
    # inner nodes of paths are inside longer phrases of their own count; others are held against those around them
    longer = triples.unionByName(quads)
    around = F.explode(F.flatten(F.transform(
        F.sequence(F.lit(2), F.size("words") - 1),
        lambda n: F.transform(F.sequence(F.lit(1), F.size("words") - n + 1), lambda i: F.slice("words", i, n)),
    ))).alias("words")
    most = longer.select("lang", around, F.col("a").alias("most")).groupBy("lang", "words").agg(F.max("most").alias("most"))
    key = ["lang", "words"]
    left = phrases.join(inside, key, "left_anti").join(most, key, "left")
    kept = stored(left.where("most IS NULL OR 100 * most < %d * a" % INSIDE).select("lang", "words", "a"), "graph-kept")
    spelled = _spelled(stored(_scored(kept, counts), "graph-scored"), "words", words, "phrase")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase"))
    ranked = stored(spelled.withColumn("rank", rank.cast("long")).where(F.col("rank") <= top), "graph-ranked")
    ends = paths.select("lang", "words", "path").unionByName(
        paths.select("lang", F.slice("path", 1, LONGEST).alias("words"), "path").distinct()
    )
    ranked = _spelled(ranked.join(ends, key, "left"), "path", words, "passage")
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "passage")

