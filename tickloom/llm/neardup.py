"""Near-duplicates by improved consistent weighted sampling over TF-IDF shingles.

A text is the weighted set of its SHINGLE-word shingles (lower-cased words of letters and digits). A shingle
weighs its count in the text times the mean inverse document frequency of its words: with the frequency of the
shingle itself, one changed word would weigh the more the more copies of a text there are. Two texts agree in one
sample with a probability equal to their weighted Jaccard similarity; BANDS bands of ROWS samples each give candidates,
which are verified with the exact similarity under the same weights. Classes are the connected components of the
verified links.

Texts with equal words are one text here, so copies are never compared. In a bucket of texts with an equal band, the
one whose bands most texts share is the leader, and every text is held against its leaders. Texts that end
outside the class of their leader are then held against all texts of that leader, in blocks inside tasks,
so every two texts of a bucket are in one class or have been compared; only links that join classes leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import sidefiles
from tickloom.llm.tables import only, small_batches
from tickloom.llm.words import Piece, byte_table, gram_hashes, mix, pieces, prefix, range_hashes
from tickloom.session import stored

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 12
ROWS = 4
WORD_SLOTS = 1 << 18
_CHUNK = 4096
SALTS = 64
STRAY_BLOCK = 256
MEMBER_BLOCK = 2048
"""Texts of a leader's group that meet in one place: strays in memory, members streamed past them."""
_CELLS = 1 << 22
_DRAWS = 1 << 16
_SECOND = np.uint64(0x9FB21C651E98DF25)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
WORD = byte_table([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])


@lru_cache(maxsize=1)
def _draws() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """r, ln c and beta of the sampling, drawn once: r, c ~ Gamma(2, 1), beta uniform."""
    rng = np.random.default_rng(20260101)
    r, c, beta = rng.gamma(2, 1, _DRAWS), rng.gamma(2, 1, _DRAWS), rng.random(_DRAWS)
    return r.astype(np.float32), np.log(c).astype(np.float32), beta.astype(np.float32)


def _words(piece: Piece):
    words = Piece(_LOWER[piece.data], piece.edges, piece.rows).words(WORD)
    return words, words.hashes()


def _slots(hashes: np.ndarray, slots: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - slots.bit_length() + 1)).astype(np.int64)


def count_documents(docs: DataFrame, words_of=_words) -> tuple[np.ndarray]:
    """Inverse document frequencies of the slots of words, counted over all docs: WORD_SLOTS numbers.

    ``words_of`` gives the words of a piece and their hashes.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, total = np.zeros(WORD_SLOTS, dtype=np.int64), 0
        for batch in batches:
            total += batch.num_rows
            for piece in pieces(batch.column("text")):
                words, hashes = words_of(piece)
                pairs = np.sort((words.text_of() << 18) | _slots(hashes, WORD_SLOTS))
                new = np.append(True, pairs[1:] != pairs[:-1])[: len(pairs)]
                counts += np.bincount(pairs[new] & (WORD_SLOTS - 1), minlength=WORD_SLOTS)
        if total:
            yield _chunks(np.append(counts, np.full(_CHUNK, total)))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            values = batch.column("counts").flatten().to_numpy().reshape(-1, _CHUNK)
            for chunk, value in zip(batch.column("chunk").to_pylist(), values):
                sums[chunk] = sums.get(chunk, 0) + value
        for chunk, value in sums.items():
            yield _chunks(value, chunk)

    schema = "chunk int, counts array<long>"
    summed = docs.mapInArrow(count, schema).repartition("chunk").mapInArrow(merge, schema).toArrow().sort_by("chunk")
    if not summed.num_rows:
        return (np.ones(WORD_SLOTS, dtype=np.float32),)
    counts = summed.column("counts").combine_chunks().flatten().to_numpy()
    return ((1 + np.log((1 + counts[-1]) / (1 + counts[:WORD_SLOTS]))).astype(np.float32),)


def _chunks(counts: np.ndarray, first: int = 0) -> pa.RecordBatch:
    n = len(counts) // _CHUNK
    lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * _CHUNK), pa.array(counts))
    return pa.RecordBatch.from_arrays([pa.array(np.arange(first, first + n, dtype=np.int32)), lists], ["chunk", "counts"])


def shingles(piece: Piece, idf: np.ndarray) -> tuple[np.ndarray, ...]:
    """(offsets of each text's shingles, distinct shingles in order, weights, two hashes of each text's words).

    A text of fewer than SHINGLE words is one shingle; one without letters or digits is its other characters;
    one of white space alone has no shingle.
    """
    words, hashes = _words(piece)
    starts = words.gram_starts(SHINGLE)
    values = idf[_slots(hashes, WORD_SLOTS)].astype(np.float64)
    sums = prefix(values, np.float64)
    a, b = words.first[:-1], words.first[1:]
    size = (b - a).astype(np.uint64)
    key1 = mix(range_hashes(hashes, a, b) + size)
    key2 = mix(range_hashes(mix(hashes ^ _SECOND), a, b) ^ size)
    text = np.searchsorted(words.first, starts, side="right") - 1
    keys, weight = gram_hashes(hashes, starts, SHINGLE), (values[starts] if len(starts) else np.zeros(0))
    for i in range(1, SHINGLE):  # in a fixed order, so equal shingles weigh the same everywhere
        weight = weight + values[starts + i]
    weight = weight / SHINGLE
    short = np.flatnonzero((words.counts > 0) & (words.counts < SHINGLE))
    text, keys = np.append(text, short), np.append(keys, key1[short])
    weight = np.append(weight, (sums[b[short]] - sums[a[short]]) / np.maximum(words.counts[short], 1))
    bare = np.flatnonzero(words.counts == 0)
    if len(bare):
        plain = piece.words()
        whole = mix(range_hashes(plain.hashes(), plain.first[:-1], plain.first[1:]))
        key1[bare], key2[bare] = mix(whole[bare] ^ _SECOND), whole[bare]
        bare = bare[plain.counts[bare] > 0]
        text, keys, weight = np.append(text, bare), np.append(keys, key1[bare]), np.append(weight, np.ones(len(bare)))
    order = np.lexsort((keys, text))
    text, keys, weight = text[order], keys[order], weight[order]
    new = np.append(True, (text[1:] != text[:-1]) | (keys[1:] != keys[:-1]))[: len(text)]
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(text)))
    return np.searchsorted(text[at], np.arange(piece.n + 1)), keys[at], weight[at] * times, key1, key2


def samples(edges: np.ndarray, keys: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    """n consistent weighted samples of every text that has shingles: (texts, n) 64-bit values."""
    r_table, c_table, beta_table = _draws()
    full = np.flatnonzero(np.diff(edges) > 0)
    starts, sizes = edges[:-1][full], np.diff(edges)[full]
    out = np.zeros((len(full), n), dtype=np.uint64)
    if not len(full):
        return out
    log = np.log(weights).astype(np.float32)
    step = mix(keys ^ _SECOND) | np.uint64(1)
    at = keys.copy()
    for i in range(n):
        at += step
        draw = (at >> np.uint64(48)).astype(np.int64)
        r, beta = r_table[draw], beta_table[draw]
        level = np.floor(log / r + beta)
        cost = c_table[draw] - r * (level - beta) - r
        least = np.minimum.reduceat(cost, starts)
        hit = np.flatnonzero(cost == np.repeat(least, sizes))
        # the first of equal costs: the smallest shingle
        first = hit[np.searchsorted(hit, starts)]
        out[:, i] = mix(keys[first] + level[first].astype(np.int64).astype(np.uint64) * _SECOND)
    return out


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Of two sorted (shingles, weights)."""
    place = np.minimum(np.searchsorted(b[0], a[0]), max(len(b[0]) - 1, 0))
    both = b[0][place] == a[0] if len(b[0]) else np.zeros(len(a[0]), dtype=bool)
    shared = float(np.minimum(a[1][both], b[1][place[both]]).sum())
    whole = float(a[1].sum() + b[1].sum()) - shared
    return shared / whole if whole > 0 else 0.0


def _signatures(docs: DataFrame, idf: np.ndarray, bands: int, rows: int) -> DataFrame:
    names = [f"b{i}" for i in range(bands)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, part, first in sidefiles.numbered(batches):
            for piece in pieces(batch.column("text")):
                edges, keys, weights, key1, key2 = shingles(piece, idf)
                full = np.diff(edges) > 0
                drawn = samples(edges, keys, weights, bands * rows)
                columns = []
                for i in range(bands):
                    band = np.zeros(piece.n, dtype=np.uint64)
                    mixed = np.full(len(drawn), i + 1, dtype=np.uint64)
                    for j in range(rows):
                        mixed = mix(mixed ^ drawn[:, i * rows + j])
                    band[full] = mixed
                    columns.append(pa.array(band.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(piece.n, part, np.int32)), pa.array(first + piece.rows.start + np.arange(piece.n)),
                     batch.column("doc_id").slice(piece.rows.start, piece.n), pa.array(full),
                     pa.array(key1.view(np.int64)), pa.array(key2.view(np.int64)), *columns],
                    ["part", "row", "doc_id", "full", "key1", "key2", *names],
                )

    schema = "part int, row long, doc_id long, full boolean, key1 long, key2 long, " + ", ".join(f"{n} long" for n in names)
    return docs.mapInArrow(run, schema)


def _texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """id, text of some rows (id, doc_id), read by their place."""
    here = F.col("id")
    side = sidefiles.write_side(
        ids.select("id", "doc_id", F.shiftright(here, 40).cast("int").alias("part"), here.bitwiseAND((1 << 40) - 1).alias("row")),
        "near-wanted",
    )

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = None
        for batch, part, first in sidefiles.numbered(batches):
            reader = reader or sidefiles.SideReader(side, part)
            facts = reader.of(first, batch.num_rows)
            if facts is not None:
                sidefiles.same_rows(facts, first, batch.column("doc_id"))
                place = pa.array(facts.column("row").to_numpy() - first)
                yield pa.RecordBatch.from_arrays(
                    [facts.column("id").combine_chunks(), batch.column("text").take(place)], ["id", "text"]
                )

    return stored(docs.mapInArrow(fetch, "id long, text string"), "near-texts")


def _verify(texts: DataFrame, pairs: DataFrame, idf: np.ndarray, similarity: float) -> DataFrame:
    """The pairs (leader, member) whose texts are similar enough.

    Each leader's members are dealt over SALTS groups, and its text goes to those that have members.
    """
    salt = F.pmod(F.xxhash64("member"), F.lit(SALTS)).cast("int").alias("salt")
    members = pairs.select("leader", salt, F.col("member").alias("id"))
    leaders = members.select("leader", "salt").distinct().withColumn("id", F.col("leader"))
    both = members.unionByName(leaders).join(texts, "id").select(
        "leader", "salt", "id", (F.col("id") != F.col("leader")).alias("later"), "text"
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader, known = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            owner, own = batch.column("leader").to_pylist(), batch.column("id").to_pylist()
            out = []
            for piece in pieces(batch.column("text")):
                edges, keys, weights = shingles(piece, idf)[:3]
                for i in range(piece.n):
                    mine = keys[edges[i] : edges[i + 1]], weights[edges[i] : edges[i + 1]]
                    at = piece.rows.start + i
                    if own[at] == owner[at]:
                        leader, known = owner[at], mine
                    elif leader == owner[at] and weighted_jaccard(known, mine) >= similarity:
                        out.append((owner[at], own[at]))
            if out:
                yield _links(out)

    return (
        both.repartition("leader", "salt").sortWithinPartitions("leader", "salt", "later")
        .mapInArrow(compare, "a long, b long")
    )


def _links(batch: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*batch)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


class _Strays:
    """Strays of one block, as dense rows over their shingles, in parts of at most _CELLS cells."""

    def __init__(self):
        self.ids: list[int] = []
        self.comps: list[int] = []
        self.sets: list[tuple[np.ndarray, np.ndarray]] = []
        self.parts: list | None = None
        self.joined: set[tuple[int, int]] = set()

    def add(self, id_: int, comp: int, keys: np.ndarray, weights: np.ndarray) -> None:
        self.ids.append(id_)
        self.comps.append(comp)
        self.sets.append((keys, weights))

    def _build(self) -> None:
        self.parts, at = [], 0
        while at < len(self.sets):
            end, cells = at, 0
            while end < len(self.sets):
                cells += len(self.sets[end][0])
                if end > at and (end + 1 - at) * cells > _CELLS:
                    break
                end += 1
            known = np.unique(np.concatenate([k for k, _ in self.sets[at:end]]))
            rows = np.zeros((len(known), end - at), dtype=np.float64)
            for i, (keys, weights) in enumerate(self.sets[at:end]):
                rows[np.searchsorted(known, keys), i] = weights
            self.parts.append((at, known, rows, np.array([w.sum() for _, w in self.sets[at:end]]), np.array(self.comps[at:end])))
            at = end

    def links(self, id_: int, comp: int, keys: np.ndarray, weights: np.ndarray, similarity: float):
        """Links of a text to strays of other classes, once per stray and class."""
        if self.parts is None:
            self._build()
        whole = weights.sum()
        for at, known, rows, sums, comps in self.parts:
            place = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            hit = known[place] == keys
            shared = np.minimum(rows[place[hit]], weights[hit][:, None]).sum(axis=0)
            near = (shared >= similarity * (sums + whole - shared)) & (comps != comp)
            for i in np.flatnonzero(near).tolist():
                if (at + i, comp) not in self.joined:
                    self.joined.add((at + i, comp))
                    yield self.ids[at + i], id_


def _settle(texts: DataFrame, placed: DataFrame, idf: np.ndarray, similarity: float) -> DataFrame:
    """Links (a, b) between classes, of strays with all texts of their leaders.

    ``placed`` has leader, id, comp and main (the class of the leader) for every text of a leader.
    """
    sizes = placed.groupBy("leader").agg(
        F.count_if(F.col("comp") != F.col("main")).alias("strays"), F.count("*").alias("n")
    ).where("strays > 0")
    sizes = stored(
        sizes.select(
            "leader", F.ceil(F.col("strays") / STRAY_BLOCK).cast("int").alias("sb"),
            F.ceil(F.col("n") / MEMBER_BLOCK).cast("int").alias("mb"),
        ),
        "near-sizes",
    )
    rows = stored(placed.join(sizes, "leader"), "near-open")

    def block(count: str):
        return F.pmod(F.xxhash64("id", F.lit(count)), F.col(count)).cast("int").alias(f"{count}_block")

    def every(count: str):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1)).alias(f"{count}_block")

    strays = rows.where("comp <> main").select("leader", "id", "comp", block("sb"), every("mb"), F.lit(0).alias("role"))
    members = rows.select("leader", "id", "comp", every("sb"), block("mb"), F.lit(1).alias("role"))
    both = strays.unionByName(members).join(texts, "id")
    group = ("leader", "sb_block", "mb_block")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, strays = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            owners = list(zip(*(batch.column(c).to_pylist() for c in group)))
            ids, comps, roles = (batch.column(c).to_pylist() for c in ("id", "comp", "role"))
            out = []
            for piece in pieces(batch.column("text")):
                edges, keys, weights = shingles(piece, idf)[:3]
                for i in range(piece.n):
                    at = piece.rows.start + i
                    if owners[at] != now:
                        now, strays = owners[at], _Strays()
                    mine = keys[edges[i] : edges[i + 1]], weights[edges[i] : edges[i + 1]]
                    if roles[at] == 0:
                        strays.add(ids[at], comps[at], *mine)
                    elif strays.ids:
                        out += strays.links(ids[at], comps[at], *mine, similarity)
            if out:
                yield _links(out)

    return both.repartition(*group).sortWithinPartitions(*group, "role").mapInArrow(compare, "a long, b long")


def components(ids: DataFrame, links: DataFrame) -> DataFrame:
    """id, comp: the least id of each connected component of the links (a, b)."""
    both = stored(links.union(links.select("b", "a")).toDF("a", "b").distinct(), "near-edges")
    labels = stored(ids.select("id", F.col("id").alias("comp")), "near-labels")
    while True:
        near = (
            both.join(labels.select(F.col("id").alias("b"), F.col("comp").alias("other")), "b")
            .groupBy("a").agg(F.min("other").alias("other"))
        )
        moved = labels.join(near, F.col("id") == F.col("a"), "left").select(
            "id", F.least("comp", "other").alias("comp"), F.col("comp").alias("was")
        )
        moved = stored(moved, "near-labels")
        # labels point to smaller ids of the same component: follow them one step
        jump = moved.select(F.col("id").alias("via"), F.col("comp").alias("next"))
        labels = stored(
            moved.join(jump, F.col("comp") == F.col("via"), "left")
            .select("id", F.coalesce("next", "comp").alias("comp"), "was"),
            "near-labels",
        )
        if labels.where("comp <> was").isEmpty():
            return labels.select("id", "comp")


def classes(
    docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """part, row (place in the scan), doc_id, class_id, class_size, kept - one row per row of docs (doc_id, text).

    ``class_id`` is the smallest doc_id of the class, ``kept`` marks its first row (by doc_id, null last, then
    by place). Texts without any word are classes of their own.
    """
    spark = docs.sparkSession
    sidefiles.pin_splits(spark)
    (idf,) = count_documents(docs)
    names = [f"b{i}" for i in range(bands)]
    signed = stored(_signatures(docs, idf, bands, rows), "near-signatures")
    place = F.shiftleft(F.col("part").cast("long"), 40).bitwiseOR(F.col("row"))
    # one text of each set of equal texts; its bands are those of all
    texts = stored(
        signed.where("full").groupBy("key1", "key2").agg(F.min(place).alias("id"), F.min_by("doc_id", place).alias("doc_id"), *[F.min(n).alias(n) for n in names]),
        "near-distinct",
    )
    banded = texts.select("id", F.explode(F.array(*names)).alias("bucket"))
    crowded = stored(
        banded.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select(F.col("bucket").alias("key"), "n"),
        "near-buckets",
    )
    shared = stored(banded.join(crowded, F.col("bucket") == F.col("key")).select("bucket", "id", "n"), "near-shared")
    fame = stored(shared.groupBy("id").agg(F.sum("n").alias("fame")).select(F.col("id").alias("i"), "fame"), "near-fame")
    shared = stored(shared.join(fame, F.col("id") == F.col("i")).select("bucket", "id", "fame"), "near-famed")
    leaders = stored(
        shared.groupBy("bucket").agg(F.max(F.struct("fame", (-F.col("id")).alias("less"))).alias("top"))
        .select(F.col("bucket").alias("key"), (-F.col("top.less")).alias("leader")),
        "near-leaders",
    )
    members = shared.join(leaders, F.col("bucket") == F.col("key")).select("leader", "id").distinct()
    members = stored(members, "near-members")
    links = None
    if not members.isEmpty():
        ids = stored(members.select("id").distinct(), "near-ids")
        bodies = _texts(docs, ids.join(texts.select("id", "doc_id"), "id"))
        pairs = members.where("id <> leader").select("leader", F.col("id").alias("member"))
        links = stored(_verify(bodies, pairs, idf, similarity), "near-links")
        labels = components(ids, links)
        mains = labels.select(F.col("id").alias("leader"), F.col("comp").alias("main"))
        placed = stored(members.join(labels, "id").join(mains, "leader"), "near-classed")
        if not placed.where("comp <> main").isEmpty():
            links = links.union(stored(_settle(bodies, placed, idf, similarity), "near-settled"))
            labels = components(ids, links)
    named = texts.select(F.col("key1").alias("k1"), F.col("key2").alias("k2"), "id")
    if links is not None:
        comps = labels.select(F.col("id").alias("i"), "comp")
        named = named.join(comps, F.col("id") == F.col("i"), "left").select("k1", "k2", F.coalesce("comp", "id").alias("comp"))
    else:
        named = named.withColumnRenamed("id", "comp")
    named = stored(named, "near-named")
    placed = signed.select("part", "row", "doc_id", "full", "key1", "key2").join(
        named, (F.col("full")) & (F.col("key1") == F.col("k1")) & (F.col("key2") == F.col("k2")), "left"
    )
    placed = stored(placed.select("part", "row", "doc_id", F.coalesce("comp", place).alias("comp")), "near-placed")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "part", "row"))
    heads = stored(
        placed.groupBy("comp").agg(first.alias("first"), F.count("*").alias("class_size")).select(
            F.col("comp").alias("c"), F.col("first.doc_id").alias("class_id"), F.col("first.part").alias("p"),
            F.col("first.row").alias("r"), "class_size",
        ),
        "near-heads",
    )
    return placed.join(heads, F.col("comp") == F.col("c")).select(
        "part", "row", "doc_id", "class_id", "class_size",
        ((F.col("part") == F.col("p")) & (F.col("row") == F.col("r"))).alias("kept"),
    )


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, class_id, class_size, kept - one row per row of docs; see ``classes``.

    A null text has no words and is a class of its own; a class of rows without ids has a null class_id. Other
    columns are not read; an empty table gives no rows. docs must scan alike each time (as from files).
    """
    found = classes(only(docs, doc_id="long", text="string"), similarity, bands, rows)
    return found.select("doc_id", "class_id", "class_size", "kept")


def one_of_each(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of docs that ``classes`` keeps, with all their columns.

    Texts without words, nulls among them, are all kept; of rows that repeat an id and a text one is kept. An empty
    table gives none. docs must scan alike each time; a scan that differs is an error.
    """
    found = classes(only(docs, doc_id="long", text="string"), similarity)
    side = sidefiles.write_side(found.where("not kept").select("part", "row", "doc_id"), "near-dropped")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = None
        for batch, part, first in sidefiles.numbered(batches):
            reader = reader or sidefiles.SideReader(side, part)
            facts = reader.of(first, batch.num_rows)
            if facts is not None:
                sidefiles.same_rows(facts, first, batch.column("doc_id"))
                keep = np.ones(batch.num_rows, dtype=bool)
                keep[facts.column("row").to_numpy() - first] = False
                batch = batch.filter(pa.array(keep))
            yield batch

    return small_batches(docs).mapInArrow(run, docs.schema)
