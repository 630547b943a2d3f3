import math
import re
from functools import cache

import numpy as np
import pyarrow as pa

from tests.llm import brute
from tickloom.llm import toxicity
from tickloom.llm.words import pieces

SF = "/root/testdata/sf0.1"
CHAIN = {"poor": "quality = 0", "toxic": "toxic = 1"}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    chain = toxicity.train(docs, labels.where("doc_id % 3 > 0"), CHAIN)
    held = labels.where("doc_id % 3 = 0")
    got = toxicity.score(docs, chain, list(CHAIN)).join(held, "doc_id").toPandas()
    toxic, flagged = got.toxic == 1, got.is_toxic
    assert flagged[toxic].mean() > 0.88  # some labelled toxic hold no word that marks them
    assert flagged[~toxic].mean() < 0.01


def test_a_later_model_uses_the_earlier_category():
    rng = np.random.default_rng(2)
    n, width = 1500, 6
    x = rng.random((n, width)) < 0.3
    first = x[:, 0] | x[:, 1] | x[:, 2]
    y = np.stack([first, first & x[:, 3]], axis=1).astype(float)
    rows, cols = np.nonzero(x)
    chain = toxicity.fit_chain(["a", "b"], np.arange(width, dtype=np.uint64), rows, cols, np.arange(n) % 3, y)
    p = chain.probabilities(rows, cols, n)
    assert (((p >= chain.thresholds) == (y == 1)).mean(axis=0) > 0.97).all()
    assert len(chain.weights[0]) == width + 1 and len(chain.weights[1]) == width + 2
    assert chain.weights[1][width] > 1
    # out-of-fold: a row's own label had no part in the probability that trains the next model
    flipped = y.copy()
    flipped[0, 0] = 1 - flipped[0, 0]
    again = toxicity.fit_chain(["a", "b"], np.arange(width, dtype=np.uint64), rows, cols, np.arange(n) % 3, flipped)
    assert again.held_out[0][0] == chain.held_out[0][0]


def test_edge_rows(spark):
    docs = spark.createDataFrame(
        [(i, "you moron" if i % 2 else "fine day") for i in range(60)] + [(None, "moron"), (7, None), (7, None), (8, "")],
        "doc_id long, text string",
    ).selectExpr("*", "1 as y0", "2 as key", "3 as label")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    chain = toxicity.train(docs.where("text is not null"), labels, {"toxic": "toxic = 1"})
    got = toxicity.score(docs, chain, ["toxic"]).collect()
    assert len(got) == 64
    assert all(r.is_toxic == bool(r.doc_id % 2) for r in got if r.doc_id is not None and r.doc_id not in (7, 8))
    assert [r.is_toxic for r in got if r.doc_id is None] == [True]
    assert toxicity.score(docs.limit(0), chain, ["toxic"]).count() == 0
    assert toxicity.train(docs, labels.limit(0), {"toxic": "toxic = 1"}) is None
    assert {r.is_toxic for r in toxicity.score(docs, None, ["toxic"]).collect()} == {False}


@cache
def _hash(word: str) -> int:
    """The library's hash of one word; everything else below is plain."""
    (piece,) = pieces(pa.array([word]))
    return int(toxicity.features(piece)[1][0])


def _plain_scores(chain, text):
    weight = [dict(zip(chain.keys.tolist(), w.tolist())) for w in chain.weights]
    seen: dict = {}
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    for word in re.findall(r"[0-9a-z\x80-\U0010ffff]+", lower):
        raw = word.encode()
        keys = [_hash(word)]
        for n in (4, 5, 6):
            if len(raw) > n and raw.isascii():
                keys.append((_hash(word[:n]) + n) % 2**64)
        for k in keys:
            seen[k] = seen.get(k, 0) + 1
    held = [*seen, *(k ^ int(toxicity._OFTEN_MARK) for k, n in seen.items() if n >= toxicity.OFTEN)]
    out: list = []
    for c, w in enumerate(chain.weights):
        z = sum(weight[c].get(k, 0.0) for k in held) + sum(a * b for a, b in zip(out, w[len(chain.keys):])) + w[-1]
        out.append(1 / (1 + math.exp(-min(30, max(-30, z)))))
    return out


def test_scores_match_a_plain_walk_over_each_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    chain = toxicity.train(docs, labels, CHAIN)
    texts = [r.text for r in docs.limit(300).collect()] + [t for t in brute.TRICKY if (t or "").isascii()] + ["Moron! " * 200_000]
    texts = [t for t in texts if t is None or t.isascii()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.score(df, chain, list(CHAIN)).collect()}
    assert len(texts) > 100
    for i, text in enumerate(texts):
        want = _plain_scores(chain, text)
        assert np.allclose([got[i].p_poor, got[i].p_toxic], want, atol=1e-9)
        assert got[i].is_toxic == (want[1] >= chain.thresholds[1]) or abs(want[1] - chain.thresholds[1]) < 1e-9
