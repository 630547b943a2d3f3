import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from tests.llm import brute
from tickloom.llm import neardup
from tickloom.llm.words import pieces

SF = "/root/testdata/sf0.01"


def _weights(text, idf_of_word):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[0-9a-z\x80-\U0010ffff]+", low)
    if not words:
        return {brute_key: 1.0} if (brute_key := tuple(brute.words(text))) else {}
    k = min(neardup.SHINGLE, len(words))
    grams = Counter(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return {g: n * sum(idf_of_word(w) for w in g) / k for g, n in grams.items()}


def _classes(rows, idf, similarity=0.8):
    """Classes by comparing every two texts that share a shingle."""
    def idf_of_word(word, known={}):
        if word not in known:
            piece = next(pieces(pa.array([word])))
            known[word] = float(idf[neardup._slots(piece.words(neardup.WORD).hashes(), neardup.WORD_SLOTS)][0])
        return known[word]

    sets = [_weights(text, idf_of_word) for _, text in rows]
    comp = list(range(len(rows)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    holders: dict = {}
    for i, s in enumerate(sets):
        for j in {j for g in s for j in holders.get(g, ())}:
            shared = sum(min(w, sets[j].get(g, 0.0)) for g, w in s.items())
            if shared / (sum(s.values()) + sum(sets[j].values()) - shared) >= similarity:
                a, b = sorted((root(i), root(j)))
                comp[b] = a
        for g in s:
            holders.setdefault(g, []).append(i)
    groups: dict = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(rows[i][0])
    return {doc: min(g) for g in groups.values() for doc in g}


def _table(spark, tmp_path, rows, schema="doc_id long, text string", parts=3):
    path = str(tmp_path / "docs.parquet")
    spark.createDataFrame(rows, schema).repartition(parts).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_classes_match_all_pairs_on_the_corpus(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    idf = neardup.count_documents(docs.select("doc_id", "text"))[0]
    got = neardup.near_duplicates(docs).collect()
    assert {r.doc_id: r.class_id for r in got} == _classes(rows, idf)
    sizes = Counter(r.class_id for r in got)
    assert all(r.class_size == sizes[r.class_id] and r.kept == (r.doc_id == r.class_id) for r in got)
    assert max(sizes.values()) > 1


def test_samples_agree_as_often_as_texts_are_similar():
    rng = np.random.default_rng(8)
    keys = np.sort(rng.integers(0, 2**63, 300).astype(np.uint64))
    a, b = rng.gamma(2, 1, 300), rng.gamma(2, 1, 300)
    b = np.where(rng.random(300) < 0.7, a, b)
    expected = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    edges = np.array([0, 300])
    n = 4000
    same = neardup.samples(edges, keys, a, n) == neardup.samples(edges, keys, b, n)
    assert abs(same.mean() - expected) < 0.03
    assert abs(neardup.weighted_jaccard((keys, a), (keys, b)) - expected) < 1e-9


def test_chains_hot_groups_and_strays(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(neardup, "STRAY_BLOCK", 8)
    monkeypatch.setattr(neardup, "MEMBER_BLOCK", 16)
    monkeypatch.setattr(neardup, "_CELLS", 2000)
    rng = random.Random(6)
    word = lambda: f"q{rng.randrange(10000)}"
    base = [word() for _ in range(120)]
    rows = [(0, " ".join(base))]
    for i in range(1, 200):  # near copies of one text
        words = list(base)
        words[rng.randrange(120)] = word()
        rows.append((i, " ".join(words)))
    chain = [word() for _ in range(150)]
    for i in range(30):  # each like the next, the ends unlike
        chain = chain[5:] + [word() for _ in range(5)]
        rows.append((300 + i, " ".join(chain)))
    rows += [(500 + i, " ".join(base[:60] + [word() for _ in range(60)])) for i in range(40)]
    rows += [(700 + i, rows[0][1].upper()) for i in range(60)]
    docs = _table(spark, tmp_path, rows)
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(docs).collect()}
    idf = neardup.count_documents(docs)[0]
    assert got == _classes(rows, idf)
    assert len({got[i] for i in range(300, 330)}) == 1


def test_edge_rows(spark, tmp_path):
    text = "one two three four five six seven"
    rows = [(4, text, "a"), (2, text, "b"), (None, text, "c"), (2, text, "b"), (5, None, "d"), (6, "", "e"), (7, " \n", "f"),
            (8, "hi there", "g"), (9, "Hi, there!", "h"), (10, "!!!", "i"), (11, "!!!", "j"), (None, None, None), (12, "?", "k")]
    docs = _table(spark, tmp_path, rows, "doc_id long, text string, bucket string", 2)
    got = sorted((r.doc_id or 0, r.class_id or 0, r.class_size, r.kept) for r in neardup.near_duplicates(docs).collect())
    assert [g[:3] for g in got] == [
        (0, 0, 1), (0, 2, 4), (2, 2, 4), (2, 2, 4), (4, 2, 4), (5, 5, 1), (6, 6, 1), (7, 7, 1), (8, 8, 2), (9, 8, 2),
        (10, 10, 2), (11, 10, 2), (12, 12, 1),
    ]
    assert sum(g[3] for g in got) == 8
    left = neardup.one_of_each(docs)
    assert left.columns == docs.columns and left.count() == 8
    assert neardup.near_duplicates(docs.where("doc_id = -1")).count() == 0
    assert neardup.near_duplicates(docs.where("doc_id in (5, 6)")).count() == 2


def test_copies_at_the_edge_of_similarity_in_a_hot_group(spark, tmp_path):
    rng = random.Random(21)
    word = lambda: f"q{rng.randrange(20000)}"
    base = [word() for _ in range(118)]
    rows = [(0, " ".join(base))]
    for i in range(1, 200):  # a third of all rows: 10 of 114 shingles changed, about 0.81 of the base
        words = list(base)
        for at in (rng.randrange(5, 40), rng.randrange(45, 113)):
            words[at] = word()
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(word() for _ in range(118))) for i in range(400)]
    docs = _table(spark, tmp_path, rows)
    idf = neardup.count_documents(docs)[0]
    expected = _classes(rows, idf)
    near = [i for i in range(200) if expected[i] == 0]
    assert len(near) > 100
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(docs).collect()}
    assert [i for i in near if got[i] != 0] == []
    assert got == expected
