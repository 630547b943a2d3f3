"""Spelling variants: words one edit apart, found in a trie over letter-group counts.

Words are arranged by the counts of their letters in the successive GROUPS. One inserted letter raises one count, one
deleted letter lowers one, one replaced letter does both (or neither, inside a group). A depth-first search walks the
trie for blocks of words at once with a budget of one surplus and one deficit, and compares the words of the leaves
it reaches letter by letter.

The vocabulary grows with the corpus, so the trie is cut into shards: a shard holds the words of one length with equal
counts of the first groups, as many as keep the largest shard within SHARD_WORDS. A word visits its own shard and those
that one edit can reach; of two words only one looks for the other, the shorter one or the one with smaller counts.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.tables import only
from tickloom.llm.words import Piece, Words, byte_table, pieces, prefix
from tickloom.session import stored

GROUPS = (
    "e", "t", "a", "n", "i", "s", "r", "o", "h", "l", "d", "c", "u", "m", "g", "w",
    "èéêë", "fb", "py", "kvj", "xqz", "àáâãäåæ", "ìíîïòóôõöø", "ùúûüç",
)
"""Letter groups, one level of the trie each; every other letter belongs to a last one."""
SHARD_WORDS = 50_000
MIN_LETTERS = 7
MIN_COUNT = 2
TIMES = 10
"""A form occurs at least this many times as often as its variant."""
TYPO_EVERY = 31

_KEPT = 200_000
_BLOCK = 4096
_FRONTIER = 1 << 17
_ROWS = 1 << 17
_WIDE = 64
_PAIRS = 1 << 15
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_LETTERS = byte_table([*range(0x61, 0x7B), 0xC3])


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_CRC = _crc_table()


def _runs(piece: Piece) -> tuple[Piece, Words, np.ndarray]:
    """The lower-cased piece, its runs of letters a-z and U+00C0 to U+00FF, and their lengths in code points."""
    data = _LOWER[piece.data]
    inside = _LETTERS[data]
    inside[1:] |= data[:-1] == 0xC3  # the second byte of a letter beyond z
    lowered = Piece(data, piece.edges, piece.rows)
    marked = Piece(inside.view(np.uint8), piece.edges, piece.rows).words(byte_table([1]))
    return lowered, marked, (marked.end - marked.start) - np.diff(
        prefix(data == 0xC3)[np.stack([marked.start, marked.end])], axis=0
    )[0]


def _shifted(heads: np.ndarray, width: int) -> np.ndarray:
    """For each CRC, what becomes of it after 0, 1, ... width bytes: (width + 1, len(heads))."""
    out = np.empty((width + 1, len(heads)), dtype=np.uint32)
    out[0] = heads
    for i in range(width):
        out[i + 1] = _CRC[out[i] & 0xFF] ^ (out[i] >> 8)
    return out


def _count_piece(piece: Piece, heads: list[bytes], counts: Counter) -> None:
    """Add the words of a piece. ``heads`` are the bytes before each run whose checksum decides on its typo."""
    lowered, runs, letters = _runs(piece)
    long = np.flatnonzero(letters >= MIN_LETTERS)
    if not len(long):
        return
    start, end, letters = runs.start[long], runs.end[long], letters[long]
    owner = np.searchsorted(runs.first, long, side="right") - 1
    _, at, which = np.unique(lowered.hash_ranges(start, end), return_index=True, return_inverse=True)
    raw = lowered.data.tobytes()
    words = [raw[a:b] for a, b in zip(start[at].tolist(), end[at].tolist())]
    size = end - start
    crc = np.array([zlib.crc32(head) for head in heads], dtype=np.uint32)
    width = int(min(size.max(), _WIDE))
    moved = _shifted(crc, width)
    own = np.array([zlib.crc32(w) for w in words], dtype=np.uint32)
    check = moved[np.minimum(size, width), owner] ^ own[which]
    for i in np.flatnonzero(size > width).tolist():
        check[i] = zlib.crc32(words[which[i]], int(crc[owner[i]]))
    typo = check % TYPO_EVERY == 0
    for word, n in zip(words, np.bincount(which[~typo], minlength=len(words)).tolist()):
        if n:
            counts[word] += n
    typo = np.flatnonzero(typo & (letters > MIN_LETTERS))
    for w, place in zip(which[typo].tolist(), (check[typo] % letters[typo]).tolist()):
        text = words[w].decode()
        counts[(text[:place] + text[place + 1 :]).encode()] += 1


def count_words(docs: DataFrame) -> DataFrame:
    """word, n: the runs of at least MIN_LETTERS letters over all texts, with one letter of some runs deleted.

    A run loses the letter at h % length where h, the CRC-32 of ``doc_id:run``, is a multiple of TYPO_EVERY. A null
    text has no runs; a null doc_id counts as no characters.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for piece in pieces(batch.column("text")):
                heads = [b":" if i is None else b"%d:" % i for i in ids[piece.rows]]
                _count_piece(piece, heads, counts)
                if len(counts) >= _KEPT:
                    yield _rows(counts)
                    counts.clear()
        if counts:
            yield _rows(counts)

    rows = only(docs, doc_id="long", text="string").mapInArrow(run, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def _rows(counts: Counter) -> pa.RecordBatch:
    words = pa.array(list(counts), pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], ["word", "n"])


class _Tails:
    """Numbers for the rests of count vectors: ``of[d]`` says which rest from level d on a vector has."""

    def __init__(self, vectors: np.ndarray, base: int):
        self.base = base
        self.known: list[np.ndarray] = []
        self.of = [np.zeros(len(vectors), dtype=np.int64)]
        for counts in vectors.T[::-1]:
            keys, rest = np.unique(self.of[0] * base + counts, return_inverse=True)
            self.known.insert(0, keys)
            self.of.insert(0, rest)

    def find(self, vectors: np.ndarray) -> list[np.ndarray]:
        """The numbers of other vectors, -1 for a rest that none here has."""
        found = [np.zeros(len(vectors), dtype=np.int64)]
        for keys, counts in zip(self.known[::-1], vectors.T[::-1]):
            place, hit = _look(keys, found[0] * self.base + counts)
            found.insert(0, np.where(hit & (found[0] >= 0) & (counts < self.base), place, -1))
        return found


def _look(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the wanted in sorted keys (not empty), and whether they are there."""
    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return place, keys[place] == wanted


class _Trie:
    """Sorted count vectors of words (not none); ``roots`` numbers the shard of each."""

    def __init__(self, roots: np.ndarray, vectors: np.ndarray):
        self.order = np.lexsort((*vectors.T[::-1], roots))
        self.base = int(vectors.max(initial=0)) + 3
        node, vectors = roots[self.order].astype(np.int64), vectors[self.order]
        nodes, self.levels = [], []
        for counts in vectors.T:
            keys = node * self.base + counts
            new = np.append(True, keys[1:] != keys[:-1])
            self.levels.append(keys[new])
            node = np.cumsum(new) - 1
            nodes.append(node)
        first = np.flatnonzero(new)
        self.leaf = np.append(first, len(node))
        self.tails = _Tails(vectors[first], self.base)
        self.ends = []  # of each level: the leaves by node and rest
        for d, here in enumerate(nodes, 1):
            keys = here[first] * len(first) + self.tails.of[d]
            order = np.argsort(keys)
            self.ends.append((keys[order], order))

    def search(self, roots: np.ndarray, vectors: np.ndarray, spent: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, leaf) within the budget, in parts. ``spent``: bit 1 the surplus, bit 2 the deficit.

        The part of the frontier that lies deepest is walked first, so few parts wait at a time. Where the budget is
        spent, the rest of a word's counts must be there as it is, which takes one look instead of a walk.
        """
        rests = self.tails.find(vectors)
        waiting = [(0, np.arange(len(roots)), roots.astype(np.int64), spent)]
        while waiting:
            level, query, node, used = waiting.pop()
            if len(query) > _FRONTIER:
                half = len(query) // 2
                waiting += [(level, query[s], node[s], used[s]) for s in (slice(half, None), slice(half))]
                continue
            if level == len(self.levels):
                yield query[used == 0], node[used == 0]
                continue
            count, parts = vectors[query, level], []
            for step, bit in ((0, 0), (1, 1), (-1, 2)):
                free = np.flatnonzero((used & bit == 0) & (count + step >= 0) & (count + step < self.base))
                place, hit = _look(self.levels[level], node[free] * self.base + count[free] + step)
                parts.append((query[free][hit], place[hit], used[free][hit] | bit))
            query, node, used = (np.concatenate(p) for p in zip(*parts))
            done = used == 3
            rest = rests[level + 1][query[done]]
            keys, leaves = self.ends[level]
            place, hit = _look(keys, node[done] * len(leaves) + rest)
            hit &= rest >= 0
            yield query[done][hit], leaves[place[hit]]
            waiting.append((level + 1, query[~done], node[~done], used[~done]))


def _ranges(first: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each i, the numbers first[i] .. stop[i] - 1, with their i."""
    size = stop - first
    owner = np.repeat(np.arange(len(first)), size)
    return owner, np.arange(len(owner)) - np.repeat(prefix(size)[:-1] - first, size)


def one_edit(short: bytes, long: bytes) -> bool:
    """Whether two words, of equal length or the second longer by one, differ by exactly one edit."""
    n, i = len(short), 0
    while i < n and short[i] == long[i]:
        i += 1
    return short != long and short[i + 1 :] == long[i + 1 :] if n == len(long) else short[i:] == long[i + 1 :]


def _verified(texts: list[bytes], sizes: np.ndarray, table: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Flags of the pairs (a, b) of words one edit apart; ``table`` holds the words that fit into its width."""
    out = np.zeros(len(a), dtype=bool)
    wide = sizes[b] >= table.shape[1]
    for i in np.flatnonzero(wide).tolist():
        out[i] = one_edit(texts[a[i]], texts[b[i]])
    for kind, longer in enumerate((sizes[a] == sizes[b], sizes[a] + 1 == sizes[b])):
        todo = np.flatnonzero(longer & ~wide)
        for s in range(0, len(todo), _PAIRS):
            at = todo[s : s + _PAIRS]
            x, y = table[a[at]], table[b[at]]
            same = x == y
            if kind == 0:
                out[at] = same.sum(axis=1) == x.shape[1] - 1
            else:
                moved = x[:, :-1] == y[:, 1:]
                last = x.shape[1] - 2 - np.argmin(moved[:, ::-1], axis=1)  # the last place that differs when shifted
                last[moved.all(axis=1)] = -1
                out[at] = last < np.argmin(same, axis=1)
    return out


def _vectors(texts: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """Counts of the letter groups of Latin-1 words."""
    group = np.full(256, len(GROUPS), dtype=np.int64)
    for g, letters in enumerate(GROUPS):
        group[list(letters.encode("latin-1"))] = g
    width = len(GROUPS) + 1
    owner = np.repeat(np.arange(len(texts)), sizes)
    flat = group[np.frombuffer(b"".join(texts), dtype=np.uint8)]
    return np.bincount(owner * width + flat, minlength=len(texts) * width).reshape(-1, width)


def _near(shards: np.ndarray, kinds: np.ndarray, texts: list[bytes], n: np.ndarray) -> pa.RecordBatch:
    """For the words of whole shards that have near words here: how many, and the most frequent of them."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    vectors = _vectors(texts, sizes)
    table = np.zeros((len(texts), _WIDE), dtype=np.uint8)
    fits = np.flatnonzero(sizes < _WIDE)
    inside = np.arange(_WIDE) < sizes[fits][:, None]
    rows = np.zeros(inside.shape, dtype=np.uint8)
    rows[inside] = np.frombuffer(b"".join(texts[i] for i in fits.tolist()), dtype=np.uint8)
    table[fits] = rows
    members = np.flatnonzero(kinds == 0)
    trie = _Trie(shards[members], vectors[members]) if len(members) else None
    found = []
    queries = np.lexsort((*vectors.T[::-1], shards))  # neighbours walk the same nodes
    for s in range(0, len(texts) if trie else 0, _BLOCK):
        block = queries[s : s + _BLOCK]
        spent = np.where(kinds[block] == 2, 2, 0)
        for query, leaf in trie.search(shards[block], vectors[block], spent):
            owner, place = _ranges(trie.leaf[leaf], trie.leaf[leaf + 1])
            a, b = block[query[owner]], members[trie.order[place]]
            once = (kinds[a] != 0) | (a < b)  # inside a shard either word finds the other
            a, b = a[once], b[once]
            for p in range(0, len(a), _ROWS):
                x, y = a[p : p + _ROWS], b[p : p + _ROWS]
                ok = _verified(texts, sizes, table, x, y)
                found.append((x[ok], y[ok]))
    a, b = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in (0, 1))
    word, other = np.append(a, b), np.append(b, a)
    rank = np.empty(len(texts), dtype=np.int64)
    rank[sorted(range(len(texts)), key=texts.__getitem__)] = np.arange(len(texts))
    order = np.lexsort((rank[other], -n[other], word))
    word, other = word[order], other[order]
    first = np.flatnonzero(np.append(True, word[1:] != word[:-1])[: len(word)])
    names = [pa.array([texts[i].decode("latin-1") for i in of[first].tolist()], pa.string()) for of in (word, other)]
    return pa.RecordBatch.from_arrays(
        [names[0], pa.array(np.diff(np.append(first, len(word)))), names[1], pa.array(n[other[first]])],
        ["word", "near", "best", "best_n"],
    )


def _counts(depth: int) -> list[Column]:
    """Length and the counts of the first letter groups of a word."""
    rest = [F.length("word") - F.length(F.translate("word", letters, "")) for letters in GROUPS[:depth]]
    return [F.length("word"), *rest]


def _depth(words: DataFrame, shard_words: int) -> int:
    """Letter groups that cut the trie into shards of at most ``shard_words`` words (all groups, if none does)."""
    for depth in range(len(GROUPS)):
        keys = [c.alias(f"c{i}") for i, c in enumerate(_counts(depth))]
        largest = words.groupBy(*keys).count().agg(F.max("count")).first()[0]
        if (largest or 0) <= shard_words:
            return depth
    return len(GROUPS)


def _visits(words: DataFrame, depth: int) -> DataFrame:
    """shard, kind, word, n: every word in its own shard (kind 0), and as a query in those of words of its length (1)
    and of words longer by one letter (2) that one edit can reach."""
    moves = [(0, np.zeros(depth + 1, np.int32)), (2, np.eye(1, depth + 1, dtype=np.int32)[0])]
    for i in range(1, depth + 1):
        up = np.eye(1, depth + 1, i, dtype=np.int32)[0]
        moves += [(1, up), (2, moves[1][1] + up)]
        moves += [(1, up - np.eye(1, depth + 1, j, dtype=np.int32)[0]) for j in range(i + 1, depth + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [w.encode("latin-1") for w in batch.column("word").to_pylist()]
            sizes = np.array([len(t) for t in texts], dtype=np.int64)
            own = np.column_stack([sizes, _vectors(texts, sizes)[:, :depth]]).astype(np.int32)
            for kind, move in moves:
                at = np.flatnonzero((own + move >= 0).all(axis=1))
                edges = pa.array(np.arange(len(at) + 1, dtype=np.int32) * (depth + 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(edges, pa.array((own[at] + move).ravel())),
                     pa.array(np.full(len(at), kind, np.int32)),
                     *(batch.column(c).take(pa.array(at)) for c in ("word", "n"))],
                    ["shard", "kind", "word", "n"],
                )

    return words.select("word", "n").mapInArrow(run, "shard array<int>, kind int, word string, n long")


def near_words(words: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """word, n_near, best, best_n of the words (word, n) that have words one edit away."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.num_rows
            if size >= _ROWS:
                rows = pa.Table.from_batches(held)
                keys = rows.column("shard").to_pylist()
                cut = len(keys)
                while cut and keys[cut - 1] == keys[-1]:  # the last shard may go on
                    cut -= 1
                if cut:
                    yield _search(rows.slice(0, cut))
                held = rows.slice(cut).to_batches()
                size = len(keys) - cut
        if size:
            yield _search(pa.Table.from_batches(held))

    visits = _visits(words, _depth(words, shard_words)).repartition("shard").sortWithinPartitions("shard")
    found = visits.mapInArrow(run, "word string, near long, best string, best_n long")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("b")
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best).select(
        "word", "n_near", "b.best", (-F.col("b.less")).alias("best_n")
    )


def _search(rows: pa.Table) -> pa.RecordBatch:
    keys = rows.column("shard").combine_chunks()
    lists = keys.flatten().to_numpy().reshape(len(keys), -1)
    shard = np.cumsum(np.append(False, (lists[1:] != lists[:-1]).any(axis=1))[: len(lists)])
    texts = [w.encode("latin-1") for w in rows.column("word").to_pylist()]
    return _near(shard, rows.column("kind").to_numpy(), texts, rows.column("n").to_numpy())


def _roots(forms: DataFrame) -> DataFrame:
    """word, root: forms (word, form) followed to the last. Steps double, and n grows tenfold along a chain, so a few
    rounds suffice."""
    ends = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        then = ends.select(F.col("word").alias("via"), F.col("root").alias("next"))
        moved = stored(
            ends.join(then, F.col("root") == F.col("via"), "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            ),
            "spelling-roots",
        )
        ends = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return ends


def group_variants(docs: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """word, form, root, n, n_near, form_n - one row per word of at least MIN_LETTERS letters that occurs MIN_COUNT times.

    ``form`` is the near word (one letter inserted, deleted or replaced) that occurs most, ties to the smallest, if it
    occurs TIMES as often; ``root`` the end of the chain of forms, the word itself if it has none. Null and empty texts
    hold no words, a null doc_id counts as no characters in the typo rule, repeated rows count as often as they stand
    there, words of any length are compared whole, other columns are not read, and an empty table gives no rows.
    """
    words = stored(count_words(docs).where(F.col("n") >= MIN_COUNT), "spelling-words")
    near = stored(near_words(words, shard_words), "spelling-near")
    known = near.select(F.col("word").alias("w"), "n_near", "best", "best_n")
    enough = F.col("best_n") >= TIMES * F.col("n")
    formed = stored(
        words.join(known, F.col("word") == F.col("w"), "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(enough, F.col("best")).alias("form"), F.when(enough, F.col("best_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = _roots(formed.where("form IS NOT NULL").select("word", "form")).select(F.col("word").alias("w"), "root")
    return formed.join(roots, F.col("word") == F.col("w"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
