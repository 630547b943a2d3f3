import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tests.llm import brute
from tickloom.llm import packing
from tickloom.llm.tokens import WordPool
from tickloom.llm.words import pieces

SF = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("word_bpe_49k.json")
HARD = ["It's. don't, <|startoftext|> X.<|endoftext|>.", "<|STARTOFTEXT|> É. Ñandú, İstanbul ΣΑΣ. áb é. ́x 3.14, a1. ß. x÷y ×",
        "a b. c, ", "'s. 's", "...a., b.."]


def _check(docs, tokenizer=None, **limits):
    rows = docs.collect()
    tokens = Tokenizer.from_file(tokenizer or PATH)
    expected = sorted(
        (r.doc_id, np.array([*tokens.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4").tobytes()) for r in rows
    )
    packed = packing.pack_documents(docs, tokenizer, **limits)
    got = packed.collect()
    by_doc: dict = {}
    for r in sorted(got, key=lambda r: (r.doc_id, r.start)):
        by_doc.setdefault(r.doc_id, b"")
        assert len(by_doc[r.doc_id]) == 4 * r.start
        by_doc[r.doc_id] += r.ids
    assert sorted(by_doc.items()) == expected
    sequences: dict = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append(r)
    for members in sequences.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += len(r.ids) // 4
        assert at <= limits.get("max_tokens", 2048)
        assert len(members) <= limits.get("max_segments", 512)
        assert sum(r.loss_tokens for r in members) <= limits.get("max_loss", 2048)
    digest = {(r.doc_id, r.start, r.length, r.ids_crc32) for r in packing.digest(packed).collect()}
    assert digest == {(r.doc_id, r.start, len(r.ids) // 4, zlib.crc32(r.ids)) for r in got}
    return sum(len(r.ids) for r in got) / 4 / len(sequences)


def test_every_id_lies_in_one_piece_and_little_is_padded(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").union(
        spark.createDataFrame([(-1 - i, t) for i, t in enumerate(brute.TRICKY + HARD)], "doc_id long, text string")
    )
    assert _check(docs) > 0.95 * 2048


@pytest.mark.parametrize("limits", [{"max_segments": 2}, {"max_loss": 300}, {"max_tokens": 64, "max_segments": 3}])
def test_each_limit_binds(spark, limits):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").where("doc_id % 7 = 0")
    _check(docs, **limits)


def test_a_tokenizer_that_looks_across_words(spark):
    docs = spark.createDataFrame([(1, "Hello  there, you."), (2, "")], "doc_id long, text string")
    _check(docs, public_tokenizers.path("byte_bpe_50k.json"))


def test_edge_rows(spark):
    docs = spark.createDataFrame([(None, "a b"), (1, "c"), (1, "c"), (2, None)], "doc_id long, text string")
    docs = docs.selectExpr("*", "1 as ids", "2 as offset")
    got = packing.pack_documents(docs, max_tokens=8).collect()
    assert sorted((r.doc_id or 0, r.doc_tokens) for r in got) == [(0, 3), (1, 2), (1, 2), (2, 1)]
    assert len({(r.sequence_id, r.offset) for r in got}) == 4
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_dot_product_order():
    demands = np.array([[9.0, 1], [5, 1], [4, 6], [1, 2], [1, 9]])
    bins = packing.pack(demands, np.array([10.0, 10.0]))
    assert sorted(i for b in bins for i in b) == [0, 1, 2, 3, 4]
    assert all((demands[b].sum(axis=0) <= 10).all() for b in bins)
    with pytest.raises(ValueError):
        packing.pack(np.array([[11.0, 1]]), np.array([10.0, 10.0]))


@pytest.mark.parametrize("text", ["one <|STARTOFTEXT|> two.", "Three<|EndOfText|>. four"])
def test_upper_case_makes_no_special_token(text):
    """Alone in its piece: a true special token beside it would keep the piece from being lower-cased."""
    ids, edges = WordPool(PATH).ids(next(pieces(pa.array([text]))))
    assert ids.tolist() == Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    assert edges.tolist() == [0, len(ids)]
