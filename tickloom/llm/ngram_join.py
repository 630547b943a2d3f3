"""Jaccard join of documents over word shingles, as a blocked sparse matrix product.

The documents by shingles incidence matrix times its transpose holds every overlap. Only cells that can reach the size
bound are computed: of n shingles, ordered from rare to frequent words, a document that links with one at least as
large shares one of its first n - ceil(2 * 85 n / 185) + 1 with the first m - ceil(85 m / 100) + 1 of the larger one.
Documents with an equal shingle in those prefixes meet in a bucket, and blocks of rows of a bucket are held against each
other twice. First by parity bitmaps, a few bits for each shingle: two sets that differ in d shingles differ in at most
d bits, and a link allows d only (100 - 85) / (100 + 85) of both sizes. The pairs below that bound go, unmoved;
for the others, columns are looked up and overlaps accumulated in exact integers.

Classes need no full product: texts with equal sets are one row, a bucket's leader is its row whose buckets hold most
others, and each row is first held against the best leader of its buckets. The buckets whose leaders then are of one
class form a group, and only rows of another class, strays, are held against all rows of the group whose size allows a
link: a stray that few bitmaps are near to meets all those rows at once, another first the nearest row of the group's class
and the nearest other one, which brings most home, then, if it is still outside, every row within the bound. So every
two rows of a bucket are in one class or were compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import sidefiles
from tickloom.llm.neardup import WORD_SLOTS, components, count_documents
from tickloom.llm.tables import only
from tickloom.llm.words import SPACE_WORD, Piece, gram_hashes, mix, pieces, prefix
from tickloom.session import remove, stored, stored_at

SHINGLE = 4
PERCENT = 85
ROW_BLOCK = 1024
COLUMN_BLOCK = 8192
"""Bitmaps of a group that meet in one place: left ones in memory, right ones streamed past them."""
BITS = 4
"""Bits of a bitmap for each shingle: the more, the fewer differences fall together."""
STAR_BLOCK = 2048
"""Sets that are streamed past one set in one place."""
FEW = 8
"""Near bitmaps up to which a stray meets all of them in the first pass."""
_CELLS = 1 << 20
_SECOND = np.uint64(0x9FB21C651E98DF25)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _words(piece: Piece):
    words = Piece(_LOWER[piece.data], piece.edges, piece.rows).words(SPACE_WORD)
    return words, words.hashes()


def shingle_sets(piece: Piece, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(edges of each text's set, distinct shingles, rarity of each): sets sorted by shingle.

    Fewer than SHINGLE words are one shingle; no words, none.
    """
    words, hashes = _words(piece)
    starts = words.gram_starts(SHINGLE)
    value = idf[(hashes >> np.uint64(64 - WORD_SLOTS.bit_length() + 1)).astype(np.int64)].astype(np.float64)
    rarity = sum((value[starts + i] for i in range(1, SHINGLE)), value[starts])
    text = np.searchsorted(words.first, starts, side="right") - 1
    keys = gram_hashes(hashes, starts, SHINGLE)
    short = np.flatnonzero((words.counts > 0) & (words.counts < SHINGLE))
    for n in range(1, SHINGLE):
        some = short[words.counts[short] == n]
        text = np.append(text, some)
        keys = np.append(keys, gram_hashes(hashes, words.first[some], n))
        rarity = np.append(rarity, np.zeros(len(some)))
    order = np.lexsort((keys, text))
    text, keys, rarity = text[order], keys[order], rarity[order]
    new = np.append(True, (text[1:] != text[:-1]) | (keys[1:] != keys[:-1]))[: len(text)]
    text, keys, rarity = text[new], keys[new], rarity[new]
    return np.searchsorted(text, np.arange(piece.n + 1)), keys, rarity


def _set_keys(edges: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each set, equal for equal sets."""
    return tuple(np.diff(prefix(mix(keys ^ salt), np.uint64)[edges]) for salt in (np.uint64(0), _SECOND))


def _lists(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(values.view(np.int64)))


def _prefixes(edges: np.ndarray, keys: np.ndarray, rarity: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n - ceil(percent n / 100) + 1 shingles of each set, from rare to frequent: (edges, shingles)."""
    sizes = np.diff(edges)
    wanted = np.where(sizes > 0, sizes - -(-percent * sizes // 100) + 1, 0)
    text = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((keys, -rarity, text))
    inside = np.arange(len(keys)) - np.repeat(edges[:-1], sizes) < np.repeat(wanted, sizes)
    return prefix(wanted), keys[order][inside]


def _bitmaps(edges: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parity bitmaps of sets, in words of 64 bits: BITS bits a shingle, rounded up to a power of two."""
    sizes = np.diff(edges)
    words = (1 << np.ceil(np.log2(np.maximum(BITS * sizes, 64) / 64) - 1e-12).astype(np.int64)) * (sizes > 0)
    at = prefix(words)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    spread = mix(keys ^ _SECOND)
    place = (at[owner] << 6) + (spread & ((words[owner] << 6) - 1).astype(np.uint64)).astype(np.int64)
    odd = (np.bincount(place, minlength=int(at[-1]) << 6) & 1).astype(np.uint8)
    return at, np.packbits(odd, bitorder="little").view(np.uint64)


def _signed(docs: DataFrame, idf: np.ndarray, percent: int) -> DataFrame:
    """part, row, doc_id, n, key1, key2, rare, bits: place, set size, set keys, prefix and bitmap of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, part, first in sidefiles.numbered(batches):
            for piece in pieces(batch.column("text")):
                edges, keys, rarity = shingle_sets(piece, idf)
                key1, key2 = _set_keys(edges, keys)
                at, rare = _prefixes(edges, keys, rarity, percent)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(piece.n, part, np.int32)), pa.array(first + piece.rows.start + np.arange(piece.n)),
                     batch.column("doc_id").slice(piece.rows.start, piece.n), pa.array(np.diff(edges)),
                     pa.array(key1.view(np.int64)), pa.array(key2.view(np.int64)), _lists(rare, at),
                     _lists(*_bitmaps(edges, keys)[::-1])],
                    ["part", "row", "doc_id", "n", "key1", "key2", "rare", "bits"],
                )

    schema = "part int, row long, doc_id long, n long, key1 long, key2 long, rare array<long>, bits array<long>"
    return docs.mapInArrow(run, schema)


def _sets(docs: DataFrame, ids: DataFrame) -> tuple[DataFrame, str]:
    """id, n, body (its shingles) of the rows (id, key1), read by their place, and the folder they are in; a row
    with another set is an error."""
    here = F.col("id")
    side = sidefiles.write_side(
        ids.select(
            "id", "key1", F.shiftright(here, 40).cast("int").alias("part"), here.bitwiseAND((1 << 40) - 1).alias("row")
        ),
        "join-wanted",
    )
    flat = np.zeros(WORD_SLOTS, dtype=np.float32)  # the order does not matter here

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = None
        for batch, part, first in sidefiles.numbered(batches):
            reader = reader or sidefiles.SideReader(side, part)
            facts = reader.of(first, batch.num_rows)
            if facts is None:
                continue
            texts = batch.column("text").take(pa.array(facts.column("row").to_numpy() - first))
            facts = facts.combine_chunks()
            for piece in pieces(texts):
                edges, keys, _ = shingle_sets(piece, flat)
                mine = facts.slice(piece.rows.start, piece.n)
                if (_set_keys(edges, keys)[0].view(np.int64) != mine.column("key1").to_numpy()).any():
                    raise RuntimeError("the documents were split otherwise than in the first scan")
                yield pa.RecordBatch.from_arrays(
                    [mine.column("id").combine_chunks(), pa.array(np.diff(edges)), _lists(keys, edges)],
                    ["id", "n", "body"],
                )

    return stored_at(docs.mapInArrow(fetch, "id long, n long, body array<long>"), "join-sets")


class _Bits:
    """Bitmaps of a block of rows; ``against`` gives the pairs whose sizes and bitmaps allow a link."""

    def __init__(self, group: int):
        self.group = group
        self.ids: list[int] = []
        self.classes: list[int] = []
        self.sizes: list[int] = []
        self.words: list[np.ndarray] = []
        self.tables: dict[int, tuple[np.ndarray, np.ndarray]] | None = None

    def add(self, id_: int, class_: int, size: int, words: np.ndarray) -> None:
        self.ids.append(id_)
        self.classes.append(class_)
        self.sizes.append(size)
        self.words.append(words)

    def against(self, ids, classes, sizes, edges, words, percent):
        if self.tables is None:
            self.held = tuple(np.array(x) for x in (self.ids, self.classes, self.sizes))
            self.tables = _tables(np.array([len(w) for w in self.words]), np.concatenate(self.words))
            self.words = []
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for wide, (mine, own) in _tables(np.diff(edges), words[edges[0] : edges[-1]]).items():
            for width, (theirs, held) in self.tables.items():
                least = min(wide, width)
                left, right = _folded(held, least), _folded(own, least)
                step = max(_CELLS // (len(theirs) * least), 1)
                for a in range(0, len(mine), step):
                    part = mine[a : a + step]
                    differ = np.bitwise_count(right[a : a + step, None, :] ^ left[None, :, :]).sum(axis=2, dtype=np.int64)
                    x, y = sizes[part, None], self.held[2][theirs][None, :]
                    near = ((100 + percent) * differ <= (100 - percent) * (x + y)) & (100 * np.minimum(x, y) >= percent * np.maximum(x, y))
                    near &= classes[part, None] != self.held[1][theirs][None, :]
                    i, j = np.nonzero(near)
                    out.append(self._passed(theirs[j], ids[part[i]], classes[part[i]], (differ / (x + y))[i, j]))
        return tuple(np.concatenate(x) for x in zip(*out))

    def _passed(self, held, ids, classes, far):
        """The pairs to hand on now."""
        return self.held[0][held], ids

    def rest(self):
        """The pairs to hand on once all rows of the group have passed."""
        return np.zeros(0, np.int64), np.zeros(0, np.int64)


class _Nearest(_Bits):
    """All pairs of a row held pass if they are at most FEW; else at least those with the nearest row of the group's
    class and the nearest other one, and the row with itself, a sign that it is not done."""

    def __init__(self, group: int):
        super().__init__(group)
        self.best: np.ndarray | None = None

    def _passed(self, held, ids, classes, far):
        if self.best is None:
            self.best, self.who = np.full((2, len(self.ids)), np.inf), np.zeros((2, len(self.ids)), dtype=np.int64)
            self.seen = np.zeros(len(self.ids), dtype=np.int64)
        self.seen += np.bincount(held, minlength=len(self.seen))
        for kind in (0, 1):
            here = np.flatnonzero((classes == self.group) == (kind == 0))
            here = here[np.argsort(far[here], kind="stable")]
            row, first = np.unique(held[here], return_index=True)
            take = here[first][far[here[first]] < self.best[kind, row]]
            self.best[kind, held[take]], self.who[kind, held[take]] = far[take], ids[take]
        few = self.seen[held] <= FEW
        return self.held[0][held[few]], ids[few]

    def rest(self):
        if self.best is None:
            return super().rest()
        more = self.seen > FEW
        kind, row = np.nonzero(np.isfinite(self.best) & more)
        held = self.held[0]
        return np.append(held[row], held[more]), np.append(self.who[kind, row], held[more])


def _tables(widths: np.ndarray, words: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By width: the rows with bitmaps of that many words, and their bitmaps."""
    owner = np.repeat(widths, widths)
    return {
        int(w): (np.flatnonzero(widths == w), words[owner == w].reshape(-1, int(w))) for w in np.unique(widths)
    }


def _folded(bitmaps: np.ndarray, width: int) -> np.ndarray:
    """Bitmaps of fewer bits for the same sets: the parities of places that fall together."""
    return np.bitwise_xor.reduce(bitmaps.reshape(len(bitmaps), -1, width), axis=1)


class _Rows:
    """Rows of a block of the incidence matrix, held by column once the first product is asked for."""

    def __init__(self, group: int):
        self.ids: list[int] = []
        self.classes: list[int] = []
        self.sets: list[np.ndarray] = []
        self.columns: np.ndarray | None = None

    def add(self, id_: int, class_: int, size: int, shingles: np.ndarray) -> None:
        self.ids.append(id_)
        self.classes.append(class_)
        self.sets.append(shingles)

    def _transpose(self) -> None:
        self.held, self.of = np.array(self.ids), np.array(self.classes)
        self.sizes = np.array([len(s) for s in self.sets])
        keys, rows = np.concatenate(self.sets), np.repeat(np.arange(len(self.sets)), self.sizes)
        order = np.argsort(keys, kind="stable")
        self.columns, at = np.unique(keys[order], return_index=True)
        self.rows, self.edges = rows[order], np.append(at, len(keys))
        self.sets = []

    def against(self, ids, classes, sizes, edges, keys, percent):
        """Links of other rows (sets keys[edges[i]:edges[i + 1]]) with those held."""
        if self.columns is None:
            self._transpose()
        width, out = len(self.ids), [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        step = max(_CELLS // width, 1)
        for a in range(0, len(ids), step):
            b = min(a + step, len(ids))
            part = keys[edges[a] : edges[b]]
            place = np.minimum(np.searchsorted(self.columns, part), len(self.columns) - 1)
            hit = np.flatnonzero(self.columns[place] == part)
            column, other = place[hit], np.repeat(np.arange(b - a), np.diff(edges[a : b + 1]))[hit]
            times = self.edges[column + 1] - self.edges[column]
            cells = np.repeat(other * width, times) + self.rows[
                np.arange(int(times.sum())) + np.repeat(self.edges[column] - prefix(times)[:-1], times)
            ]
            overlap = np.bincount(cells, minlength=(b - a) * width).reshape(-1, width)
            whole = sizes[a:b, None] + self.sizes[None, :]
            near = ((100 + percent) * overlap >= percent * whole) & (classes[a:b, None] != self.of[None, :])
            i, j = np.nonzero(near)
            out.append((self.held[j], ids[a:b][i]))
        return tuple(np.concatenate(x) for x in zip(*out))

    def rest(self):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)


_GROUP = ("leader", "slice", "left", "right")


def _product(rows: DataFrame, bodies: DataFrame, block: type, percent: int) -> DataFrame:
    """Pairs (a, b) between the left (role 0) and right (role 1) rows of each group that ``block`` lets pass.

    ``rows``: the group, role, id, class; ``bodies``: id, n, body.
    """
    bodies = bodies.select(F.col("id").alias("i"), "n", "body")
    both = rows.join(bodies, F.col("id") == F.col("i")).select(*_GROUP, "role", "id", "class", "n", "body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, block(-1)
        for batch in batches:
            if not batch.num_rows:
                continue
            groups = np.stack([batch.column(c).to_numpy() for c in (*_GROUP, "role")])
            ids, classes, sizes = (batch.column(c).to_numpy() for c in ("id", "class", "n"))
            lists = batch.column("body")
            edges = lists.offsets.to_numpy().astype(np.int64)
            values = lists.values.to_numpy().view(np.uint64)
            stops = np.append(np.flatnonzero((groups[:, 1:] != groups[:, :-1]).any(axis=0)) + 1, batch.num_rows)
            a, out = 0, []
            for b in stops.tolist():
                group = tuple(groups[:-1, a].tolist())
                if group != now:
                    out.append(held.rest())
                    now, held = group, block(group[0])
                if groups[-1, a] == 0:
                    for i in range(a, b):
                        held.add(int(ids[i]), int(classes[i]), int(sizes[i]), values[edges[i] : edges[i + 1]].copy())
                elif held.ids:
                    out.append(held.against(ids[a:b], classes[a:b], sizes[a:b], edges[a : b + 1], values, percent))
                a = b
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], ["a", "b"])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in held.rest()], ["a", "b"])

    ordered = both.repartition(*_GROUP).sortWithinPartitions(*_GROUP, "role")
    return ordered.mapInArrow(run, "a long, b long")


def _block(n) -> F.Column:
    return F.pmod(F.xxhash64("id"), F.greatest(F.ceil(n), F.lit(1))).cast("int")


def _stars(pairs: DataFrame) -> DataFrame:
    """Rows for a product of each a with its b, which come in blocks; pairs: a, b, distinct."""
    pairs = pairs.select(F.col("a").alias("leader"), F.col("b").alias("id"))
    sizes = stored(
        pairs.groupBy("leader").agg(F.ceil(F.count("*") / STAR_BLOCK).cast("int").alias("blocks")), "join-sizes"
    )
    zero = [F.lit(0).alias("slice"), F.lit(0).alias("left")]
    right = pairs.join(sizes, "leader").select(
        "leader", *zero, _block(F.col("blocks")).alias("right"), F.lit(1).alias("role"), "id", F.col("id").alias("class")
    )
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("right")
    held = sizes.select("leader", *zero, every, F.lit(0).alias("role")).select(
        "*", F.col("leader").alias("id"), F.col("leader").alias("class")
    )
    return right.unionByName(held)


def _strays(placed: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Rows for a product of strays with all members of their group whose size is in reach.

    ``placed``: leader (the group's class), id, class, stray. A slice holds the strays of similar size, its logarithm over two
    links' reach, and a member comes to the one or two slices that hold every size that it can link with.
    """
    size = F.log("n") / float(np.log(100 / percent))

    def slice_of(shift: float):
        return F.floor((size + shift) / 2).cast("int")

    sized = stored(
        placed.join(texts.select(F.col("id").alias("i"), "n"), F.col("id") == F.col("i")).select(
            "leader", "id", "class", "stray", slice_of(0).alias("slice"),
            F.array_distinct(F.array(slice_of(-1.000001), slice_of(1.000001))).alias("near"),
        ),
        "join-sized",
    )
    astray = sized.where("stray")
    wanted = astray.groupBy("leader", "slice").agg(F.count("*").alias("s"))
    right = sized.select("leader", F.explode("near").alias("slice"), "id", "class")
    counts = right.groupBy("leader", "slice").agg(F.count("*").alias("m"))
    blocks = stored(
        wanted.join(counts, ["leader", "slice"]).select(
            "leader", "slice", F.ceil(F.col("s") / ROW_BLOCK).cast("int").alias("lefts"),
            F.ceil(F.col("m") / COLUMN_BLOCK).cast("int").alias("rights"),
        ),
        "join-blocks",
    )

    def every(count: str, name: str):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1)).alias(name)

    left = astray.join(blocks, ["leader", "slice"]).select(
        "leader", "slice", _block(F.col("lefts")).alias("left"), every("rights", "right"), F.lit(0).alias("role"), "id", "class"
    )
    right = right.join(blocks, ["leader", "slice"]).select(
        "leader", "slice", every("lefts", "left"), _block(F.col("rights")).alias("right"), F.lit(1).alias("role"), "id", "class"
    )
    return left.unionByName(right)


def _links(docs: DataFrame, texts: DataFrame, rows: DataFrame, percent: int, block: type = _Bits) -> tuple[DataFrame, DataFrame]:
    """The links (a, b) among the pairs of the rows: bitmaps first, then the product of what they leave; and the rows
    (id) that ``block`` has not done with."""
    bits = texts.select("id", "n", F.col("bits").alias("body"))
    found = stored(_product(rows, bits, block, percent).distinct(), "join-pairs")
    pairs, waiting = found.where("a <> b"), found.where("a = b").select(F.col("a").alias("id"))
    wanted = pairs.select(F.col("a").alias("w")).union(pairs.select("b")).distinct()
    sets, path = _sets(docs, texts.select("id", "key1").join(wanted, F.col("id") == F.col("w")).select("id", "key1"))
    links = stored(_product(_stars(pairs), sets, _Rows, percent), "join-links")
    remove(docs.sparkSession, path)
    return links, waiting


def _buckets(texts: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(bucket, id) of the buckets in which rows meet, and key (a bucket), leader, fame (of the leader)."""
    least = F.ceil(2 * percent * F.col("n") / (100 + percent) - 1e-9)
    banded = texts.select("id", F.posexplode("rare").alias("at", "bucket"), (F.col("n") - least + 1).alias("first"))
    counted = banded.groupBy("bucket").agg(F.count("*").alias("m"), F.max(F.col("at") < F.col("first")).alias("near"))
    crowded = stored(counted.where("m > 1 AND near").select(F.col("bucket").alias("key"), "m"), "join-buckets")
    shared, path = stored_at(banded.join(crowded, F.col("bucket") == F.col("key")).select("bucket", "id", "m"), "join-shared")
    fame = stored(shared.groupBy("id").agg(F.sum("m").alias("fame")).select(F.col("id").alias("i"), "fame"), "join-fame")
    famed = stored(shared.join(fame, F.col("id") == F.col("i")).select("bucket", "id", "fame"), "join-famed")
    remove(texts.sparkSession, path)
    top = F.max(F.struct("fame", (-F.col("id")).alias("less"))).alias("top")
    leaders = stored(
        famed.groupBy("bucket").agg(top).select(
            F.col("bucket").alias("key"), (-F.col("top.less")).alias("leader"), "top.fame"
        ),
        "join-leaders",
    )
    return famed.select("bucket", "id"), leaders


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels (id, comp, the least id of the class) once links (a, b) join classes; only those take part."""
    one, other = (labels.select(F.col("id").alias(end), F.col("comp").alias(c)) for end, c in (("a", "one"), ("b", "other")))
    ends = links.join(one, "a").join(other, "b").where("one <> other")
    ends = stored(ends.select(F.col("one").alias("a"), F.col("other").alias("b")), "join-ends")
    if ends.isEmpty():
        return labels
    now = components(ends.select("a").union(ends.select("b")).distinct().toDF("id"), ends)
    now = now.select(F.col("id").alias("was"), F.col("comp").alias("now"))
    named = labels.join(now, F.col("comp") == F.col("was"), "left")
    return stored(named.select("id", F.coalesce("now", "comp").alias("comp")), "join-merged")


def _placed(groups: DataFrame, labels: DataFrame, waiting: DataFrame) -> DataFrame:
    """leader (the class of the group), id, class as the labels are now, stray; groups: leader, id. A stray is a row of
    another class that is among the ``waiting`` (id)."""
    mains = labels.select(F.col("id").alias("leader"), F.col("comp").alias("main"))
    now = groups.join(mains, "leader").select(F.col("main").alias("leader"), "id").distinct()
    waits = waiting.select(F.col("id").alias("w")).distinct()
    classed = labels.join(waits, F.col("id") == F.col("w"), "left").select("id", F.col("comp").alias("class"), "w")
    astray = (F.col("class") != F.col("leader")) & F.col("w").isNotNull()
    return stored(now.join(classed, "id").select("leader", "id", "class", astray.alias("stray")), "join-classed")


def jaccard_classes(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id - one row per row of docs (doc_id, text).

    Two documents link when their sets of distinct SHINGLE-word shingles (lower-cased) overlap in at least ``percent``
    of their union; ``component_id`` is the smallest doc_id that links lead to. Null and empty texts have an empty set
    and link with nothing; very long texts are compared whole; repeated rows and ids are rows of their own; a null
    doc_id is passed over in the smallest, and null if it is alone. Other columns are not read; an empty table gives no
    rows. docs must scan alike each time (as from files).
    """
    docs = only(docs, doc_id="long", text="string")
    sidefiles.pin_splits(docs.sparkSession)
    (idf,) = count_documents(docs, _words)
    wide, path = stored_at(_signed(docs, idf, percent), "join-signed")
    signed = stored(wide.drop("rare", "bits"), "join-places")
    place = F.shiftleft(F.col("part").cast("long"), 40).bitwiseOR(F.col("row"))
    texts = stored(
        wide.where("n > 0").groupBy("key1", "key2").agg(
            F.min(place).alias("id"), F.first("n").alias("n"), F.first("rare").alias("rare"), F.first("bits").alias("bits")
        ),
        "join-texts",
    )
    remove(docs.sparkSession, path)
    shared, leaders = _buckets(texts, percent)
    here = F.col("bucket") == F.col("key")
    named = texts.select(F.col("key1").alias("k1"), F.col("key2").alias("k2"), "id")
    if not leaders.isEmpty():
        best = F.max(F.struct("fame", (-F.col("leader")).alias("less"))).alias("best")
        firsts = shared.join(leaders, here).groupBy("id").agg(best)
        firsts = stored(firsts.select((-F.col("best.less")).alias("a"), F.col("id").alias("b")), "join-firsts")
        ids = firsts.select(F.col("b").alias("id"))
        links, _ = _links(docs, texts, _stars(firsts.where("a <> b")), percent)
        labels = _merged(ids.select("id", F.col("id").alias("comp")), links)
        mains = labels.select(F.col("id").alias("leader"), F.col("comp").alias("main"))
        mains = stored(leaders.join(mains, "leader").select("key", F.col("main").alias("leader")), "join-mains")
        groups = stored(shared.join(mains, here).select("leader", "id").distinct(), "join-groups")
        waiting = ids
        for block in (_Nearest, _Bits):
            placed = _placed(groups, labels, waiting)
            if placed.where("stray").isEmpty():
                break
            links, waiting = _links(docs, texts, _strays(placed, texts, percent), percent, block)
            labels = _merged(labels, links)
            if waiting.isEmpty():
                break
        comps = labels.select(F.col("id").alias("i"), "comp")
        named = named.join(comps, F.col("id") == F.col("i"), "left").select("k1", "k2", F.coalesce("comp", "id").alias("comp"))
    else:
        named = named.withColumnRenamed("id", "comp")
    same = (F.col("n") > 0) & (F.col("key1") == F.col("k1")) & (F.col("key2") == F.col("k2"))
    rows = stored(
        signed.join(stored(named, "join-named"), same, "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("comp", place).alias("comp")),
        "join-rows",
    )
    heads = stored(
        rows.groupBy("comp").agg(F.min("doc_id").alias("component_id")).select(F.col("comp").alias("c"), "component_id"),
        "join-heads",
    )
    return rows.join(heads, F.col("comp") == F.col("c")).select("doc_id", "n_shingles", "component_id")
