import random

import numpy as np
import pytest

from tests.llm import brute
from tickloom.llm import ngram_join

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def _set(text):
    w = brute.words((text or "").translate(LOWER))
    return {tuple(w[i : i + 4]) for i in range(max(len(w) - 3, 1))} if w else set()


def _brute(rows, percent=85):
    sets = [_set(text) for _, text in rows]
    comp = list(range(len(rows)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                comp[root(i)] = root(j)
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(doc_id)
    least = {g: min((x for x in ids if x is not None), default=None) for g, ids in groups.items()}
    return sorted(((rows[i][0], len(sets[i]), least[root(i)]) for i in range(len(rows))), key=str)


def _check(spark, tmp_path, rows, percent=85, parts=3):
    path = str(tmp_path / "docs.parquet")
    frame = spark.createDataFrame([(*r, 1, "clash") for r in rows], "doc_id long, text string, n int, bucket string")
    frame.repartition(parts).write.mode("overwrite").parquet(path)
    got = ngram_join.jaccard_classes(spark.read.parquet(path), percent).collect()
    assert sorted((tuple(r) for r in got), key=str) == _brute(rows, percent)


def test_edge_rows(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(brute.TRICKY)] + [(None, "a b c"), (None, "A B C"), (70, "a b  c"), (70, None)]
    rows += [(80, "alone here with nobody"), (None, "the only row of its kind today"), (5, "a b c"), (5, "a b c")]
    _check(spark, tmp_path, rows)


@pytest.mark.parametrize("percent", [85, 50])
def test_sizes_at_the_bound(spark, tmp_path, percent):
    """Pairs that miss or meet the bound by one shingle, one set inside the other and edits inside."""
    rng = random.Random(5)
    rows = []
    for n in (8, 20, 23, 43, 100):
        base = [f"w{n}x{rng.randrange(10**6)}" for _ in range(n)]
        for cut in range(0, n // 2, max(n // 20, 1)):
            rows.append((len(rows), " ".join(base[: n - cut])))
            rows.append((len(rows), " ".join(base[cut:])))
            spoiled = [w if i >= cut else w + "!" for i, w in enumerate(base)]
            rng.shuffle(spoiled[: cut or None])
            rows.append((len(rows), " ".join(spoiled)))
    rng.shuffle(rows)
    _check(spark, tmp_path, rows, percent)


def test_large_groups_of_near_copies(spark, tmp_path, monkeypatch):
    """A third of all rows near one text, at similarities on both sides of the bound, with blocks smaller than it."""
    monkeypatch.setattr(ngram_join, "ROW_BLOCK", 8)
    monkeypatch.setattr(ngram_join, "COLUMN_BLOCK", 16)
    monkeypatch.setattr(ngram_join, "STAR_BLOCK", 16)
    rng = random.Random(9)
    base = [f"b{i}" for i in range(70)]
    rows = []
    for _ in range(150):
        text = list(base)
        for _ in range(rng.randrange(1, 5)):
            text[rng.randrange(len(text))] = f"x{rng.randrange(40)}"
        rows.append((len(rows) + 1000, " ".join(text[: rng.randrange(50, 71)])))
    line = " ".join(f"l{i}" for i in range(12))
    for _ in range(150):  # a common line in texts that differ else
        rows.append((len(rows) + 1000, line + " " + " ".join(f"o{rng.randrange(10**9)}" for _ in range(rng.randrange(2, 9)))))
    rows += [(i, rows[i % 40][1]) for i in range(100)]
    rng.shuffle(rows)
    _check(spark, tmp_path, rows, parts=4)


def test_one_pass_over_strays_that_few_rows_are_near_to(spark, tmp_path, monkeypatch):
    """Rows that share a rare line and nothing else stay outside their leader's class; all is known after one pass."""
    passes, links = [], ngram_join._links
    monkeypatch.setattr(ngram_join, "_links", lambda *args: passes.append(args[-1]) or links(*args))
    rng = random.Random(8)
    rows = []
    for i in range(40):
        line = [f"seldom{i // 4}x{k}" for k in range(7)]
        rows.append((i, " ".join(line + [f"v{rng.randrange(30)}" for _ in range(60)])))
    rows.append((40, rows[3][1] + " tail"))
    _check(spark, tmp_path, rows)
    assert len(passes) == 2 and passes[-1] is ngram_join._Nearest


def test_strays_with_many_near_rows_wait():
    few, own = ngram_join.FEW, np.array([7, 9], dtype=np.uint64)
    for n in (0, 1, few, few + 1, 3 * few):
        block = ngram_join._Nearest(5)
        block.add(100, 100, 32, own)
        found = []
        for at in range(0, n, 4):
            m = min(4, n - at)
            words = np.tile(own, m)
            words[::2] ^= np.uint64(1) << np.arange(m, dtype=np.uint64) % np.uint64(2)
            ids = np.arange(at, at + m)
            classes = np.where(ids == 2, 5, ids)
            out = block.against(ids, classes, np.full(m, 32), 2 * np.arange(m + 1), words, 85)
            found += list(zip(*(x.tolist() for x in out)))
        found += list(zip(*(x.tolist() for x in block.rest())))
        if n <= few:
            assert sorted(found) == [(100, i) for i in range(n)]
        else:
            assert (100, 100) in found and (100, 2) in found and len(set(found)) >= 3


def test_empty(spark, tmp_path):
    _check(spark, tmp_path, [])
    _check(spark, tmp_path, [(1, None), (2, " ")])
