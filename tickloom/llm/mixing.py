"""Mixing sources to target token counts by entropy balancing, in DataFrame operations only.

Each document gets a rate ``min(cap, exp(lambda * size / mean size))`` of its source: of all rates between
0 and the cap, those nearest to one (in relative entropy over documents) whose tokens meet the source's
target. ``lambda`` solves the convex dual, sum of rate * size = target, by safeguarded Newton steps for
all sources at once. Every step is one aggregation of the counts per (source, size).

Rates become whole copies by ``floor(rate + u + shift)`` with ``u`` a hash of the row and ``shift`` the
offset per source and level of size that brings the words taken nearest to the target, so no document
needs its neighbours and nothing is sampled. Equal rows are counted first; the k-th of them has ``u`` moved on
by k golden sections, so however many there are, they spread evenly over both sides of the rounding.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.tables import SPACE_WORDS, unit_hash
from tickloom.session import stored

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
CAP = 2.0
SLOTS = 4096
"""Steps of the shift that evens out rounding."""
NEWTON_STEPS = 20
"""Steps after which every other one halves the interval, so the search ends for any sizes."""
BLOCK = 4096
"""Equal rows, or copies of one row, that one task writes out at a time."""
_GOLDEN = 0.6180339887498949


def size_of(text: Column) -> Column:
    """Number of words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(SPACE_WORDS)), F.lit(0)).cast("long")


def source_totals(sizes: DataFrame) -> DataFrame:
    """source, source_size, place (from 0, by code point, null last).

    Places come from a range sort: place inside the partition plus the rows of the partitions before.
    """
    totals = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    ordered = stored(
        totals.repartitionByRange(F.col("source").isNull(), F.col("source")).withColumn("part", F.spark_partition_id()),
        "mix-sources",
    )
    inside = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    parts = ordered.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"))
    return ordered.join(parts, "part").select(
        "source", "source_size", (F.row_number().over(inside) - 1 + F.col("rows_before")).alias("place")
    )


def fill_targets(totals: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Adds weight and target: the share is dealt by weight, and what exceeds cap * source_size is dealt again."""
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    now = stored(
        totals.select(
            "source", "source_size", weight.alias("weight"),
            (F.col("source_size") * cap).alias("most"), F.lit(None).cast("double").alias("target"),
        ),
        "mix-targets",
    )
    whole = (now.agg(F.sum("source_size")).first()[0] or 0) * share
    while True:
        state = now.agg(
            F.sum(F.when(F.col("target").isNull(), F.col("weight"))), F.coalesce(F.sum("target"), F.lit(0.0))
        ).first()
        if not state[0]:
            break
        level = (whole - state[1]) / state[0]
        over = F.col("target").isNull() & (F.col("weight") * level > F.col("most"))
        full = stored(now.withColumn("target", F.when(over, F.col("most")).otherwise(F.col("target"))), "mix-targets")
        if full.where("target is null").count() == now.where("target is null").count():
            now = full.withColumn("target", F.coalesce("target", F.col("weight") * level))
            break
        now = full
    return now.drop("most")


def _rate(size: Column, tilt: Column, mean: Column, cap: float) -> Column:
    # beyond the cap's logarithm the exponential is not needed, and could overflow
    power = tilt * size / mean
    return F.when(power >= F.log(F.lit(cap)), F.lit(cap)).otherwise(F.exp(power))


def balance(sizes: DataFrame, targets: DataFrame, cap: float = CAP, tolerance: float = 1e-9) -> DataFrame:
    """source, source_size, target, tilt, mean: the solved dual.

    Sources whose target is the most they can give get an infinite tilt (every rate is the cap), those
    without words a tilt of 0.
    """
    counts = stored(
        sizes.where("size > 0").groupBy("source", "size").agg(F.sum("n").alias("n")), "mix-counts"
    )
    means = counts.groupBy("source").agg(
        (F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"), F.min("size").alias("least")
    )
    infinity = F.lit(float("inf"))
    rest = F.col("target") < F.col("source_size") * cap * (1 - 1e-12)
    now = targets.join(means, targets["source"].eqNullSafe(means["source"]), "left").drop(means["source"]).select(
        "source", "source_size", "target", "mean",
        F.when(F.col("mean").isNull() | (F.col("target") == F.col("source_size")), F.lit(0.0))
        .when(F.col("target") <= 0, -infinity).when(~rest, infinity)
        .otherwise(F.lit(0.0)).alias("tilt"),
        (F.col("mean").isNull() | ~rest | (F.col("target") <= 0)).alias("done"),
        # the root lies between these: all rates at the cap above, unknown below
        (F.log(F.lit(cap)) * F.col("mean") / F.col("least")).alias("high"), (-infinity).alias("low"),
    )
    now = stored(now, "mix-dual")
    for step in count():
        open_ = now.where("not done")
        if open_.isEmpty():
            break
        power = F.col("tilt") * F.col("size") / F.col("mean")
        rate = _rate(F.col("size"), F.col("tilt"), F.col("mean"), cap)
        tokens = F.col("n") * F.col("size") * rate
        joined = counts.join(
            open_.select(F.col("source").alias("s"), "tilt", "mean"), F.col("source").eqNullSafe(F.col("s"))
        )
        sums = joined.groupBy("s").agg(
            F.sum(tokens).alias("value"),
            F.sum(F.when(power < F.log(F.lit(cap)), tokens * F.col("size") / F.col("mean")).otherwise(0.0)).alias("slope"),
        )
        gap = F.col("value") - F.col("target")
        newton = F.col("tilt") - F.try_divide(gap, F.col("slope"))
        low = F.when(gap < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("tilt")).otherwise(F.col("high"))
        middle = F.when(low == -infinity, high - 2.0**min(step, 900)).otherwise((low + high) / 2)
        trust = step < NEWTON_STEPS or step % 2 == 0
        moved = F.when((newton > low) & (newton < high), newton).otherwise(middle) if trust else middle
        close = (F.abs(gap) <= F.col("target") * tolerance) | (moved == F.col("tilt"))
        now = stored(
            now.join(sums, now["source"].eqNullSafe(sums["s"]), "left").select(
                "source", "source_size", "target", "mean",
                F.when(F.col("done") | close, F.col("tilt")).otherwise(moved).alias("tilt"),
                (F.col("done") | F.coalesce(close, F.lit(True))).alias("done"),
                F.when(F.col("done"), F.col("high")).otherwise(high).alias("high"),
                F.when(F.col("done"), F.col("low")).otherwise(low).alias("low"),
            ),
            "mix-dual",
        )
    # sums differ in their last digits with the order of rows; the tilt shall not
    return now.select("source", "source_size", "target", F.round("tilt", 12).alias("tilt"), "mean")


def _rate_of(size: Column, tilt: Column, mean: Column, cap: float) -> Column:
    """Rate of a document of a source; an empty document has rate 1."""
    return (
        F.when(size == 0, F.lit(1.0)).when(tilt == float("inf"), F.lit(cap)).when(tilt == float("-inf"), F.lit(0.0))
        .otherwise(_rate(size, tilt, mean, cap))
    )


def _level(size: Column, mean: Column) -> Column:
    """0 for long documents of a source, then shorter ones: rounding goes from long to short."""
    return F.when(size >= mean, 0).when(size >= mean / 8, 1).otherwise(2)


def _slot(place: Column) -> Column:
    """Shift (in SLOTS) from which floor(place + shift) is one more."""
    return F.floor((1 - (place - F.floor(place))) * SLOTS).cast("int")


def _whole(copies: Column, cap: float) -> Column:
    return F.greatest(F.least(copies, F.lit(int(cap))), F.lit(0))


def shifts(sizes: DataFrame, dual: DataFrame, cap: float = CAP) -> DataFrame:
    """The dual with ``slots``: the rounding shift of each level of size of each source, in SLOTS.

    A document takes floor(rate + u) copies, and one more from the shift 1 - fraction(rate + u) on. With
    the sizes summed per shift, running sums give the words taken at every shift, and the shift nearest
    to the goal is taken. Long documents are settled first; the shorter ones make up what those missed.
    """
    joined = sizes.where("size > 0").join(
        dual.select(F.col("source").alias("s"), "tilt", "mean"), F.col("source").eqNullSafe(F.col("s"))
    )
    rate = _rate_of(F.col("size"), F.col("tilt"), F.col("mean"), cap)
    place = rate + F.col("u")
    below, above = _whole(F.floor(place), cap), _whole(F.floor(place) + 1, cap)
    steps = stored(
        joined.groupBy("s", _level(F.col("size"), F.col("mean")).alias("level"), _slot(place).alias("slot")).agg(
            F.sum(F.col("size") * below).alias("fixed"), F.sum(F.col("size") * (above - below)).alias("more"),
            F.sum(F.col("size") * rate).alias("goal"),
        ),
        "mix-steps",
    )
    # at most SLOTS + 1 rows per source and level
    running = Window.partitionBy("s").orderBy("slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    plan = dual.select("*", F.lit(0.0).alias("missed"), F.array().cast("array<int>").alias("slots"))
    for level in range(3):
        mine = steps.where(F.col("level") == level)
        base = mine.groupBy("s").agg(F.sum("fixed").alias("fixed"), F.sum("goal").alias("goal"))
        options = mine.select("s", "slot", F.sum("more").over(running).alias("gain")).unionByName(
            base.select("s", F.lit(-1).alias("slot"), F.lit(0).cast("long").alias("gain"))
        )
        wanted = base.join(
            plan.select(F.col("source").alias("p"), "missed"), F.col("s").eqNullSafe(F.col("p"))
        ).select(F.col("s").alias("w"), "fixed", (F.col("goal") + F.col("missed")).alias("goal"))
        missed = F.col("goal") - F.col("fixed") - F.col("gain")
        best = (
            options.join(wanted, F.col("s").eqNullSafe(F.col("w")))
            .groupBy("s").agg(F.min_by(F.struct("slot", missed.alias("missed")), F.struct(F.abs(missed), "slot")).alias("best"))
        )
        plan = stored(
            plan.join(best, F.col("source").eqNullSafe(F.col("s")), "left").select(
                *dual.columns, F.coalesce("best.missed", "missed").alias("missed"),
                F.concat("slots", F.array(F.coalesce("best.slot", F.lit(-1)))).alias("slots"),
            ),
            "mix-shift",
        )
    return plan.drop("missed")


def _copies(size: Column, u: Column, rate: Column, mean: Column, slots: Column, cap: float) -> Column:
    place = rate + u
    shift = F.element_at(slots, _level(size, mean) + 1)
    copies = _whole(F.floor(place) + F.when(_slot(place) <= shift, 1).otherwise(0), cap)
    return F.when(size == 0, F.lit(1)).otherwise(copies).cast("int")


def _row_key(docs: DataFrame) -> Column:
    """A hash of the whole row."""
    def hashable(name: str, kind: str) -> Column:
        value = F.col(f"`{name}`")
        return F.to_json(F.struct(value)) if "map" in kind or "variant" in kind else value

    return F.xxhash64(*[hashable(f.name, f.dataType.simpleString()) for f in docs.schema.fields])


def _chance(key: Column, place: Column) -> Column:
    """In [-0.5, 0.5): by the hash of the row, moved on for each further row that equals it."""
    turn = unit_hash(key) + place * F.lit(_GOLDEN)
    return turn - F.floor(turn) - 0.5


def _dealt(rows: DataFrame, n: Column, name: str) -> DataFrame:
    """Each row (with its ``key``) n times, numbered from 0; large numbers are dealt over tasks in blocks."""
    def each(rows: DataFrame, first: Column, last: Column) -> DataFrame:
        return rows.withColumn(name, F.explode(F.sequence(first, last)))

    one = F.lit(1).cast("long")
    few = each(rows.where((n > 0) & (n <= BLOCK)), one - 1, n - 1)
    many = rows.where(n > BLOCK).withColumn("first", F.explode(F.sequence(one - 1, n - 1, F.lit(BLOCK).cast("long"))))
    many = many.repartition("key", "first")
    return few.unionByName(each(many, F.col("first"), F.least(F.col("first") + BLOCK, n) - 1).drop("first"))


def _counted(docs: DataFrame) -> DataFrame:
    """key, doc_id, source, size, n: the distinct rows of docs and how often each comes."""
    rows = docs.select(
        _row_key(docs).alias("key"), F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        size_of(F.col("text").cast("string")).alias("size"),
    )
    return stored(rows.groupBy(*rows.columns).agg(F.count("*").alias("n")), "mix-sizes")


def _each_row(counted: DataFrame) -> DataFrame:
    """The counted rows one by one, with their u."""
    return _dealt(counted, F.col("n"), "place").withColumn("u", _chance(F.col("key"), F.col("place")))


def solve(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The counted rows of docs, and the solved table of sources."""
    counted = _counted(docs)
    dual = balance(counted, fill_targets(source_totals(counted)))
    return counted, shifts(_each_row(counted), dual)


def _taken(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows (source, size, u) with their source's plan, rate and copies."""
    both = rows.join(plan.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
    rate = _rate_of(F.col("size"), F.col("tilt"), F.col("mean"), CAP)
    copies = _copies(F.col("size"), F.col("u"), rate, F.col("mean"), F.col("slots"), CAP)
    return both.withColumns({"rate": rate, "copies": copies})


def mix(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, source, size, source_size, target, rate, copies, taken.

    Sources are dealt by code point with null last. A null or empty text has size 0 and takes no words.
    Repeated rows share the source's target evenly; rows are told apart by all their columns. An empty table
    gives no rows.
    """
    counted, plan = solve(docs)
    return _taken(_each_row(counted), plan).select(
        "doc_id", "source", "size", F.col("source_size").cast("long").alias("source_size"), "target", "rate", "copies",
        (F.col("copies") * F.col("size")).cast("long").alias("taken"),
    )


def mixed_rows(docs: DataFrame) -> DataFrame:
    """The rows of docs, each as often as the mix takes it, with their own columns.

    Rows with a null or empty text are kept once each. Of rows that are equal in every column one is copied as often
    as the mix takes them all. Column names of docs cannot clash; an empty table gives no rows.
    """
    counted, plan = solve(docs)
    rows = docs.select(
        _row_key(docs).alias("key"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"),
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"),
    )
    repeated = counted.where("n > 1")
    any_repeated = not repeated.isEmpty()
    if any_repeated:
        again = stored(_taken(_each_row(repeated), plan).groupBy("key").agg(F.sum("copies").alias("total")), "mix-repeated")
        first = rows.join(again, "key").select("key", "row", "total").dropDuplicates(["key"])
        copied = _dealt(first, F.col("total"), "place").select("row.*")
        rows = rows.join(again, "key", "left_anti")
    singles = rows.select(
        "source", "row", size_of(F.col("text")).alias("size"), _chance(F.col("key"), F.lit(0)).alias("u")
    )
    out = _taken(singles, plan).withColumn("copy", F.explode(F.array_repeat(F.lit(1), F.col("copies")))).select("row.*")
    return out.unionByName(copied) if any_repeated else out
