import math

import pytest

from tests.llm import brute
from tickloom.llm import mixing

SF = "/root/testdata/sf0.01"


def _targets(totals: dict) -> dict:
    order = sorted(totals, key=lambda s: (s is None, s or ""))
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(order)}
    whole, done = 1.5 * sum(totals.values()), {}
    while True:
        free = [s for s in order if s not in done]
        if not free:
            return done
        level = (whole - sum(done.values())) / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * level > 2 * totals[s]]
        if not over:
            return done | {s: weight[s] * level for s in free}
        done |= {s: 2.0 * totals[s] for s in over}


def _totals(rows):
    totals = {}
    for r in rows:
        totals[r.source] = totals.get(r.source, 0) + len(brute.words(r.text))
    return totals


def test_targets_sizes_and_taken_words(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.collect()
    got = mixing.mix(docs).collect()
    assert sorted((r.doc_id, r.size) for r in got) == sorted((r.doc_id, len(brute.words(r.text))) for r in rows)
    totals, targets = _totals(rows), _targets(_totals(rows))
    taken = dict.fromkeys(totals, 0)
    for r in got:
        assert r.source_size == totals[r.source]
        assert math.isclose(r.target, targets[r.source], rel_tol=1e-9)
        assert r.taken == r.copies * r.size <= 2 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - targets[s]) <= 0.01 * targets[s] for s in totals)
    assert sorted(r.taken for r in mixing.mix(docs).collect()) == sorted(r.taken for r in got)


def test_rates_are_one_exponential_tilt_that_meets_the_target(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    by_source: dict = {}
    for r in mixing.mix(docs).collect():
        by_source.setdefault(r.source, []).append(r)
    for rows in by_source.values():
        assert math.isclose(sum(r.rate * r.size for r in rows), rows[0].target, rel_tol=1e-6)
        tilts = [math.log(r.rate) / r.size for r in rows if r.size and 0 < r.rate < 2 and r.rate != 1]
        assert not tilts or max(tilts) == pytest.approx(min(tilts), rel=1e-6)


def test_edge_rows_and_clashing_columns(spark):
    rows = [(1, "b", None), (2, None, "x y z"), (2, None, "x y z"), (None, "", "p q"), (5, "b", "r " * 50), (6, "a", ""),
            (7, "é", "s t u v")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").selectExpr(
        "*", "1 as size", "2 as tilt", "3 as slots", "'t' as target", "7 as copies"
    )
    got = mixing.mix(docs).collect()
    targets = _targets(_totals(docs.collect()))
    assert len(got) == len(rows)
    assert all(math.isclose(r.target, targets[r.source], abs_tol=1e-9) for r in got)
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    kept = mixing.mixed_rows(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.copies for r in got)
    assert mixing.mix(docs.limit(0)).count() == 0
    assert mixing.mixed_rows(docs.limit(0)).count() == 0


def test_one_source_holds_a_third(spark):
    docs = spark.range(3000).selectExpr(
        "id as doc_id", "case when id % 3 = 0 then 'hot' else concat('s', id % 40) end as source",
        "repeat('w ', cast(1 + pow(id % 97, 2) as int)) as text",
    )
    rows = mixing.mix(docs).collect()
    taken: dict = {}
    for r in rows:
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[r.source] - r.target) <= 0.02 * r.target for r in rows)


def test_repeated_rows_that_weigh(spark):
    docs = spark.range(9000).selectExpr(
        "case when id < 6000 then 7 else id end as doc_id", "case when id < 7500 then 'hot' else 'b' end as source",
        "case when id < 6000 then repeat('w ', 20) else repeat('v ', cast(1 + id % 60 as int)) end as text",
        "id as `mix size`",
    ).drop("mix size").selectExpr("*", "1 as `mix size`", "map('a', 1) as key", "2 as row", "3 as u", "4 as total")
    rows = mixing.mix(docs).collect()
    assert len(rows) == 9000
    for source in ("hot", "b"):
        mine = [r for r in rows if r.source == source]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 0.002 * mine[0].target
        assert math.isclose(sum(r.rate * r.size for r in mine), mine[0].target, rel_tol=1e-6)
    kept = mixing.mixed_rows(docs)
    assert kept.columns == docs.columns
    got: dict = {}
    for r in kept.collect():
        got[r.doc_id, r.text] = got.get((r.doc_id, r.text), 0) + 1
    want: dict = {}
    for r in rows:
        word = "w " if r.doc_id == 7 else "v "
        want[r.doc_id, word * r.size] = want.get((r.doc_id, word * r.size), 0) + r.copies
    assert got == {k: n for k, n in want.items() if n}
    again = mixing.mix(docs.repartition(13)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, rows))
