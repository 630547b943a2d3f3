import math

import public_tokenizers

from tests.llm import brute
from tickloom.llm import token_counts

SF = "/root/testdata/sf0.01"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def _plain(word, scores, unknown):
    """(score, count) of the best segmentation, over every split."""
    token = token_counts.MARK + word
    best = [(0.0, 0)]
    for end in range(1, len(token) + 1):
        n = len(token[end - 1].encode())
        options = [(best[end - 1][0] + n * unknown, -(best[end - 1][1] + n))]
        for start in range(end):
            if (s := scores.get(token[start:end])) is not None:
                options.append((best[start][0] + s, -(best[start][1] + 1)))
        top = max(options)
        best.append((top[0], -top[1]))
    return best[-1]


def test_counts_match_plain_segmentation(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id % 9 = 0").select("doc_id", "text").union(
        spark.createDataFrame([(-1 - i, t and t[:400]) for i, t in enumerate(brute.TRICKY)], "doc_id long, text string")
    )
    scores = token_counts.vocabulary(MODEL)
    unknown = token_counts.TrieCounter(scores).unknown
    known: dict = {}
    got = {r.doc_id: r for r in token_counts.count_tokens(docs).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    for r in rows:
        words = brute.words(r.text)
        for w in words:
            if w not in known:
                known[w] = _plain(w, scores, unknown)
        assert got[r.doc_id].n_words == len(words)
        assert got[r.doc_id].n_tokens == sum(known[w][1] for w in words)
        assert math.isclose(got[r.doc_id].log_prob, sum(known[w][0] for w in words), rel_tol=1e-9, abs_tol=1e-9)


def test_shared_prefixes_are_scored_once():
    counter = token_counts.TrieCounter({"a": -1.0, "ab": -1.5, "b": -2.0, "abc": -9.0, "c": -1.0})
    words = sorted(["abc", "abca", "abcb", "abcbb", "b"])
    counts, scores = counter.run(words)
    prefixes = {w[:i] for w in words for i in range(1, len(w) + 1)}
    assert counter.steps == len(prefixes)
    assert dict(zip(words, zip(counts, scores)))["abc"] == (2, -2.5)


def test_the_store_starts_anew_when_full(monkeypatch):
    import pyarrow as pa

    from tickloom.llm.words import pieces
    monkeypatch.setattr(token_counts, "POOL_WORDS", 3)
    store, fresh = (token_counts.CountStore({"▁": -1.0, "a": -1.0, "aa": -1.2}) for _ in range(2))
    texts = [" ".join("a" * j for j in range(i, i + 3)) for i in range(1, 9)]
    for text in texts:
        piece = next(pieces(pa.array([text])))
        fresh._clear()
        assert store.totals(piece)[1].tolist() == fresh.totals(piece)[1].tolist()


def test_edge_rows(spark):
    docs = spark.createDataFrame([(None, "a"), (1, None), (1, None), (2, "")], "doc_id long, text string")
    docs = docs.selectExpr("*", "1 as n_tokens")
    got = sorted((r.doc_id or 0, r.n_words) for r in token_counts.count_tokens(docs).collect())
    assert got == [(0, 1), (1, 0), (1, 0), (2, 0)]
    assert token_counts.count_tokens(docs.limit(0)).count() == 0
