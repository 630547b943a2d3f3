"""Exact top-k search by inner product with a pivot-distance index.

Vectors become integers and get one more component that makes all of them equally long, so the largest
inner product is the smallest Euclidean distance. Each vector is keyed by its nearest pivot and the
distance to it, and cut into rings of near-equal distance per pivot. A ring knows between which distances
from every pivot its members lie, so for a query q the triangle inequality bounds all its distances to the
ring from below by the largest of d(q, p) - high(p), low(p) - d(q, p) over the pivots p. A first pass searches
the nearest rings until they hold k vectors, which bounds the k-th distance from above; the second pass expands
to the rings whose bound does not exceed that and leaves the others. Scores are exact integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.session import stored

SCALE = 1024
SAMPLE_ROWS = 4096
"""Most vectors that the pivots are fitted on."""
PIVOTS = 32
RING_ROWS = 2048
QUERY_BLOCK = 512
"""Queries whose scores are in memory at once."""
QUERY_PART = 65_536
"""Queries that meet a block of a ring in one group; more queries come in parts."""
_SLACK = 1e-6
_LOWEST = -(2**63)


def integer_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, v array<long>: floor(scale * x); vectors that are null, empty or hold a null or non-finite x left out."""
    x = F.col("embedding").cast("array<double>")
    sound = x.isNotNull() & (F.size(x) > 0) & F.forall(
        x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf")))
    )
    return (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("embedding")).where(sound)
        .select("vec_id", F.transform("embedding", lambda e: F.floor(e * F.lit(float(scale))).cast("long")).alias("v"))
    )


def fit_pivots(sample: np.ndarray, pivots: int = PIVOTS, rounds: int = 8) -> np.ndarray:
    """Farthest-first centres of a sample, moved to the means of their members."""
    chosen = [int(np.argmax((sample**2).sum(1)))]
    gap = ((sample - sample[chosen[0]]) ** 2).sum(1)
    while len(chosen) < min(pivots, len(sample)):
        far = int(np.argmax(gap))
        if gap[far] == 0:
            break
        chosen.append(far)
        gap = np.minimum(gap, ((sample - sample[far]) ** 2).sum(1))
    centres = sample[chosen]
    for _ in range(rounds):
        near = np.argmin(_squares(sample, centres), axis=1)
        centres = np.stack([sample[near == i].mean(0) if (near == i).any() else c for i, c in enumerate(centres)])
    return centres


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a**2).sum(1)[:, None] + (b**2).sum(1)[None] - 2 * a @ b.T, 0)


def _longs(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _matrix(column: pa.Array) -> np.ndarray:
    return _longs(column).astype(np.float64)


def products(q: np.ndarray, v: np.ndarray, longest2: float) -> np.ndarray:
    """Exact inner products of integer rows no longer than sqrt(longest2), cut to what a long holds."""
    if longest2 < 2**52:
        return (q.astype(np.float64) @ v.T.astype(np.float64)).astype(np.int64)
    if longest2 < 2**62:
        return q @ v.T
    return np.clip(q.astype(object) @ v.T.astype(object), 1 - 2**63, 2**63 - 1).astype(np.int64)


def ring_bounds(away: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least distance that a member of each ring can have to each query.

    away: distance of each query to each pivot; low, high: range of those distances over each ring's members.
    """
    bound = np.zeros((len(away), len(low)))
    for p in range(away.shape[1]):
        d = away[:, p, None]
        np.maximum(bound, np.maximum(d - high[:, p], low[:, p] - d), out=bound)
    return bound


def farthest(floor: np.ndarray, longest2: float) -> np.ndarray:
    """Distance up to which a vector can score ``floor`` or more."""
    away = np.sqrt(np.maximum(2 * longest2 - 2 * floor.astype(np.float64), 0))
    return np.where(floor <= 1 - 2**63, np.inf, away * (1 + _SLACK) + _SLACK * (np.sqrt(longest2) + 1))


def _lifted(v: np.ndarray, longest2: float) -> np.ndarray:
    """With the component that makes every squared length ``longest2``."""
    return np.hstack([v, np.sqrt(np.maximum(longest2 - (v**2).sum(1), 0))[:, None]])


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to smaller ids."""
    if len(scores) > 4 * k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= edge)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))][:k]


def search(vectors: DataFrame, is_query, k: int = 10, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest integer inner products of each query row.

    Candidates are all rows but the query's own, so repeated rows and repeated ids count as often as they come;
    ties go to smaller ids. Rows without an id take no part, shorter vectors are filled up with zeros, and a
    product beyond a long counts as the nearest long. An empty table gives no rows; other columns are not read.
    """
    spark = vectors.sparkSession
    points = stored(
        integer_vectors(vectors, scale).where("vec_id is not null").withColumn("rid", F.monotonically_increasing_id()),
        "knn-points",
    )
    length2 = F.aggregate("v", F.lit(0.0), lambda a, e: a + e.cast("double") * e.cast("double"))
    n, longest2, width, least = points.agg(F.count("*"), F.max(length2), F.max(F.size("v")), F.min(F.size("v"))).first()
    if not n:
        return points.select(
            F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score")
        ).limit(0)
    longest2 *= 1 + 1e-12  # an upper bound in spite of rounding
    if least < width:
        zeros = F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("v"))
        points = points.withColumn("v", F.concat("v", zeros))
    # at most SAMPLE_ROWS rows reach the driver
    sample = points.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(SAMPLE_ROWS).select("v").collect()
    lifted = _lifted(np.array([r.v for r in sample], dtype=np.float64), longest2)
    pivots = fit_pivots(lifted)
    near = np.sqrt(_squares(lifted, pivots))
    nearest = near.argmin(1)
    # ring edges from the sample: each ring holds about RING_ROWS of the n vectors
    edges = []
    for p in range(len(pivots)):
        own = np.sort(near[nearest == p, p])
        rings = max(1, min(len(own), round(len(own) / len(sample) * n / RING_ROWS)))
        edges.append(own[[len(own) * i // rings for i in range(1, rings)]] if rings > 1 else np.zeros(0))
    # cells: the rings of all pivots, numbered; at most PIVOTS + SAMPLE_ROWS
    first_cell = np.concatenate(([0], np.cumsum([len(e) + 1 for e in edges])))

    def distances(column: pa.Array) -> np.ndarray:
        return np.sqrt(_squares(_lifted(_matrix(column), longest2), pivots))

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            away = distances(batch.column("v"))
            pivot = away.argmin(1)
            gap = away[np.arange(len(pivot)), pivot]
            cell = np.empty(len(pivot), dtype=np.int32)
            for p in np.unique(pivot):
                mine = pivot == p
                cell[mine] = first_cell[p] + np.searchsorted(edges[p], gap[mine], side="right")
            yield pa.RecordBatch.from_arrays([*batch.select(["rid", "vec_id", "v"]).columns, pa.array(cell)], ["rid", "vec_id", "v", "cell"])

    keyed = stored(points.select("rid", "vec_id", "v").mapInArrow(key, "rid long, vec_id long, v array<long>, cell int"), "knn-index")

    def extent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row a cell and task: its rows, and the range of its distances to every pivot."""
        count = np.zeros(first_cell[-1], dtype=np.int64)
        low = np.full((first_cell[-1], len(pivots)), np.inf)
        high = np.full((first_cell[-1], len(pivots)), -np.inf)
        for batch in batches:
            if batch.num_rows:
                away, cell = distances(batch.column("v")), batch.column("cell").to_numpy()
                np.add.at(count, cell, 1)
                np.minimum.at(low, cell, away)
                np.maximum.at(high, cell, away)
        held = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held.astype(np.int32)), pa.array(count[held])]
            + [pa.array(list(x[held]), pa.list_(pa.float64())) for x in (low, high)],
            ["cell", "n", "low", "high"],
        )

    spans = keyed.select("v", "cell").mapInArrow(extent, "cell int, n long, low array<double>, high array<double>")
    sizes = spans.select("cell", "n", F.posexplode(F.arrays_zip("low", "high")).alias("p", "r")).groupBy("cell", "p").agg(
        F.sum("n").alias("n"), F.min("r.low").alias("low"), F.max("r.high").alias("high")
    )
    # at most (PIVOTS + SAMPLE_ROWS) * PIVOTS rows of three numbers reach the driver
    got = sizes.orderBy("cell", "p").toArrow()
    shape = (-1, len(pivots))
    cells, held = (got.column(c).to_numpy().reshape(shape)[:, 0] for c in ("cell", "n"))
    low, high = (got.column(c).to_numpy().reshape(shape) for c in ("low", "high"))
    # a ring that holds far more than the sample promised is cut into blocks by a hash of the row
    blocks = -(-held // (2 * RING_ROWS))
    queries = keyed.where(is_query).select("rid", F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
    parts = queries.count() // QUERY_PART + 1

    def ask(second: bool):
        """The rings of the first pass (the nearest that hold more than k rows), or those the second still needs."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for at in range(0, whole.num_rows, QUERY_BLOCK):
                    batch = whole.slice(at, QUERY_BLOCK)
                    bound = ring_bounds(distances(batch.column("q")), low, high)
                    order = np.argsort(bound, axis=1, kind="stable")
                    rows = held[order]
                    seed = np.empty(bound.shape, dtype=bool)
                    np.put_along_axis(seed, order, np.cumsum(rows, axis=1) - rows < k + 1, axis=1)
                    floor = batch.column("floor").to_numpy()
                    pick = ~seed & (bound <= farthest(floor, longest2)[:, None]) if second else seed
                    query, ring = np.nonzero(pick)
                    times = blocks[ring]
                    query, ring = np.repeat(query, times), np.repeat(ring, times)
                    block = np.arange(len(ring)) - np.repeat(np.cumsum(times) - times, times)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("rid").take(pa.array(query)), pa.array(floor[query]), pa.array(cells[ring]), pa.array(block.astype(np.int32))],
                        ["rid", "floor", "cell", "block"],
                    )

        return run

    of_cell = dict(zip(cells.tolist(), blocks.tolist()))
    cut = spark.createDataFrame(list(of_cell.items()), "cell int, blocks int")
    members = keyed.join(cut, "cell").select(
        "cell", F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int").alias("block"), "rid", "vec_id", "v"
    )

    def visit(second: bool, floors: DataFrame) -> DataFrame:
        """Scores of the queries against the rings they visit, k of each block at most."""
        pairs = stored(
            floors.mapInArrow(ask(second), "rid long, floor long, cell int, block int")
            .withColumn("part", F.pmod(F.xxhash64("rid"), F.lit(parts)).cast("int")),
            "knn-asked",
        )
        asked = pairs.join(queries, "rid")
        # only the blocks that some query asks for are read, once for each part of the queries that do
        names = ("cell", "block", "part")
        asked_of = pairs.select(*[F.col(c).alias(c) for c in names]).distinct()
        wanted = members.join(asked_of, ["cell", "block"])

        def score(asked: pa.Table, held: pa.Table) -> pa.Table:
            found: list[tuple] = []
            if held.num_rows and asked.num_rows:
                ids, rids = held.column("vec_id").to_numpy(), held.column("rid").to_numpy()
                v = _longs(held.column("v").combine_chunks())
                for at in range(0, asked.num_rows, QUERY_BLOCK):
                    block = asked.slice(at, QUERY_BLOCK)
                    scores = products(_longs(block.column("q").combine_chunks()), v, longest2)
                    own, query, floor = (block.column(c).to_numpy() for c in ("rid", "query_id", "floor"))
                    for i in range(block.num_rows):
                        fit = np.flatnonzero((scores[i] >= floor[i]) & (rids != own[i]))
                        best = fit[_best(scores[i][fit], ids[fit], k)] if len(fit) else fit
                        found += [(int(own[i]), int(query[i]), int(ids[j]), int(scores[i][j])) for j in best]
            columns = zip(*found) if found else ((), (), (), ())
            return pa.table([pa.array(c, pa.int64()) for c in columns], names=["rid", "query_id", "vec_id", "score"])

        return asked.groupBy(*names).cogroup(wanted.groupBy(*names)).applyInArrow(
            score, "rid long, query_id long, vec_id long, score long"
        )

    def top(found: DataFrame) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy("rid").orderBy(F.desc("score"), "vec_id"))
        return found.withColumn("rank", rank).where(F.col("rank") <= k)

    lowest = F.lit(_LOWEST).cast("long")
    first = stored(top(visit(False, queries.select("rid", "q", lowest.alias("floor")))), "knn-seeds")
    # the k-th best so far; fewer than k: no bound
    kth = first.groupBy("rid").agg(F.max("rank").alias("got"), F.min("score").alias("kth")).select(
        "rid", F.when(F.col("got") >= k, F.col("kth")).otherwise(lowest).alias("known")
    )
    floors = queries.join(kth, "rid", "left").select("rid", "q", F.coalesce("known", lowest).alias("floor"))
    return top(visit(True, floors).unionByName(first.drop("rank"))).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )
