import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from tests.llm import brute
from tickloom.llm import boosting, quality
from tickloom.llm.tables import labelled_sample, sampled_texts
from tickloom.llm.words import pieces

SF = "/root/testdata/sf0.01"


def _counts(texts, size=1 << 20):
    out = []
    for piece in pieces(pa.array(texts, pa.string()), size):
        got, _ = quality.statistics(piece)
        out += list(zip(*(got[name].tolist() for name in quality.STATISTICS)))
    return out


def test_counts_match_a_plain_count():
    texts = pq.read_table(f"{SF}/documents.parquet").column("text").to_pylist()[:300] + brute.TRICKY
    expected = [brute.quality(t) for t in texts]
    assert _counts(texts) == expected
    assert _counts(texts, 50) == expected


def test_trees_obey_their_signs():
    rng = np.random.default_rng(3)
    x = rng.random((3000, 3))
    y = (x[:, 0] + 0.5 * np.sin(9 * x[:, 1]) + rng.normal(0, 0.3, 3000) > 0.6).astype(float)
    trees = boosting.fit(x, y, np.array([1, 0, -1]))
    assert ((trees.probability(x) > 0.5) == (y > 0.5)).mean() > 0.8
    grid = np.linspace(0, 1, 60)
    for f, sign in ((0, 1), (2, -1)):
        for _ in range(20):
            probe = np.repeat(rng.random((1, 3)), 60, axis=0)
            probe[:, f] = grid
            assert (sign * np.diff(trees.probability(probe)) >= -1e-12).all()


def test_held_out_accuracy_and_verdict(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    fit_on, held = labels.where("doc_id % 3 > 0"), labels.where("doc_id % 3 = 0")
    got = quality.score(docs, quality.train(docs, fit_on)).join(held, "doc_id").toPandas()
    assert ((got.score >= 0.5) == (got.quality == 1)).mean() > 0.9


def test_edge_rows(spark):
    rows = [(None, "a b"), (1, None), (1, None), (2, "word " * 30), (3, " ".join(f"w{i}" for i in range(40)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as score", "1 as kept")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.train(docs, none) is None
    got = {(r.doc_id, r.n_words): r.kept for r in quality.score(docs, None).collect()}
    assert got == {(None, 2): False, (1, 0): False, (2, 30): False, (3, 40): True}
    assert quality.score(docs, None).count() == 5
    assert quality.score(docs.limit(0), None).count() == 0
    assert quality.keep_good(docs, None).collect() == [r for r in docs.collect() if r.doc_id == 3]


def test_a_repeated_id_gives_the_sample_one_row(spark):
    docs = spark.createDataFrame(
        [(1, f"text {i % 7}") for i in range(500)] + [(2, None), (2, "b"), (3, "c"), (None, "d")], "doc_id long, text string"
    ).selectExpr("*", "5 as label", "6 as hash", "7 as least")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 10)] + [(1, 0)], "doc_id long, quality int")
    sample = labelled_sample(labels, "quality", 100)
    got = sampled_texts(docs, sample).collect()
    assert sorted((r.doc_id, r.label) for r in got) == [(1, 1), (2, 0), (3, 1)]
    again = sampled_texts(docs.orderBy("text").repartition(5, "text"), sample).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))
    assert sampled_texts(docs.limit(0), sample).count() == 0
