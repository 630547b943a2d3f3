import hashlib
import random

import pytest

from tests.llm import brute
from tickloom.llm import substrings
from tickloom.llm.automaton import SuffixAutomaton

SF = "/root/testdata/sf0.01"


def _table(spark, tmp_path, rows, schema="doc_id long, text string", parts=3):
    """Written and read again, as every scan must see the same splits."""
    path = str(tmp_path / "docs.parquet")
    spark.createDataFrame(rows, schema).repartition(parts).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _got(docs, window=20):
    return {
        r.doc_id: (r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest())
        for r in substrings.remove_repeats(docs, window).collect()
    }


def test_automaton_matches_a_plain_search():
    rng = random.Random(4)
    for _ in range(60):
        passages = [[rng.randrange(3) for _ in range(rng.randrange(1, 14))] for _ in range(5)]
        automaton = SuffixAutomaton()
        for i, passage in enumerate(passages):
            known = {tuple(p[a:b]) for p in passages[:i] for a in range(len(p)) for b in range(a + 1, len(p) + 1)}
            expected = [
                max((n for n in range(1, j + 2) if tuple(passage[j + 1 - n : j + 1]) in known), default=0)
                for j in range(len(passage))
            ]
            assert automaton.matches(passage) == expected
            automaton.add(passage)


def test_matches_brute_force_on_the_corpus(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert _got(docs) == brute.repeats([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("seed", range(3))
def test_matches_brute_force_on_small_alphabets(spark, tmp_path, seed):
    rng = random.Random(seed)
    passage = [f"w{rng.randrange(6)}" for _ in range(60)]
    rows = []
    for i in range(60):
        words = [f"w{rng.randrange((2, 6, 40)[seed])}" for _ in range(rng.randrange(0, 90))]
        if rng.random() < 0.6:
            at = rng.randrange(40)
            words[len(words) // 2 : len(words) // 2] = passage[at : at + rng.randrange(10, 60)]
        rows.append((i, " ".join(words)))
    rows += [(100 + i, t) for i, t in enumerate(brute.TRICKY)] + [(200 + i, rows[i][1].replace(" ", "\n")) for i in range(9)]
    docs = _table(spark, tmp_path, rows)
    assert _got(docs) == brute.repeats(rows)


def test_other_windows(spark, tmp_path):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randrange(60)))) for i in range(40)]
    docs = _table(spark, tmp_path, rows)
    for window in (8, 9, 30):
        got = {k: v[:2] for k, v in _got(docs, window).items()}
        assert got == {k: v[:2] for k, v in brute.repeats(rows, window).items()}


def test_hot_passage_and_copies(spark, tmp_path):
    rng = random.Random(1)
    word = lambda: f"v{rng.randrange(5000)}"
    passage = " ".join(word() for _ in range(50))
    rows = [(i, " ".join([word() for _ in range(30)] + [passage] + [word() for _ in range(30)])) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(300)]
    docs = _table(spark, tmp_path, rows, parts=5)
    assert _got(docs) == brute.repeats(rows)


def test_null_ids_repeated_rows_and_whole_rows(spark, tmp_path):
    text = " ".join(f"x{i}" for i in range(40))
    rows = [(None, text, 1, "a"), (5, text, 2, "b"), (5, text, 3, "c"), (6, None, 4, "d"), (7, "short one", 9, "e"),
            (2, "y " + text, 5, "f"), (None, None, None, None), (9, "", 0, "g")]
    docs = _table(spark, tmp_path, rows, "doc_id long, text string, n_chars long, row string", 2)
    got = substrings.remove_repeats(docs).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in got) == [
        (0, 0, 0), (0, 40, 40), (2, 41, 0), (5, 40, 40), (5, 40, 40), (6, 0, 0), (7, 2, 0), (9, 0, 0)
    ]
    left = substrings.without_repeats(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id or 0, r.n_chars or 0) for r in left.collect()) == [(0, 0), (2, len(text) + 2), (6, 4), (7, 9), (9, 0)]
    assert substrings.remove_repeats(docs.where("doc_id = -1")).count() == 0


def test_no_automaton_takes_a_whole_hot_edge(spark, tmp_path, monkeypatch):
    bound, match = 16, substrings._match
    monkeypatch.setattr(substrings, "SHARD_ROWS", bound, raising=False)

    def bounded(batches):
        sizes = {}

        def watched():
            for batch in batches:
                for key in zip(batch.column("key1").to_pylist(), batch.column("key2").to_pylist()):
                    sizes[key] = sizes.get(key, 0) + 1
                    if sizes[key] > bound:
                        raise RuntimeError("a shard is larger than the bound")
                yield batch

        yield from match(watched())

    monkeypatch.setattr(substrings, "_match", bounded)
    rng = random.Random(3)
    word = lambda: f"v{rng.randrange(3000)}"
    passage = [word() for _ in range(50)]
    rows = []
    for i in range(240):
        words = [word() for _ in range(rng.randrange(60))]
        if i % 3 == 0:  # a third holds the passage, some with equal words next to it
            words[len(words) // 2 : len(words) // 2] = ["a"] * (i % 4) + passage[i % 2 :] + ["b"] * (i % 5) + passage[:24]
        rows.append((i, " ".join(words)))
    rows += [(300 + i, " ".join(rng.choice("abc") for _ in range(60))) for i in range(40)]
    docs = _table(spark, tmp_path, rows)
    assert _got(docs) == brute.repeats(rows)
