import re

import pytest

from tests.llm import brute
from tickloom.llm import licenses

SF = "/root/testdata/sf0.01"
PHRASES = {("cc", "by"): "cc-by", ("general", "public", "license"): "gpl", ("all", "rights", "reserved"): "reserved"}


def _words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def _base(text):
    w = _words(text)
    hits = [(i, label) for p, label in PHRASES.items() for i in range(len(w)) if tuple(w[i : i + len(p)]) == p]
    at = [i for i, _ in hits]
    return (len(w), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in hits})))


def test_base_matches_a_plain_scan(spark):
    extra = [(-1 - i, t) for i, t in enumerate([
        *brute.TRICKY, "CC-BY cc by, CC by", "cc éby", "cc", "by cc", "Général public license general  public\nLICENSE",
        "all rights reserved all rights reserved", "cc", "by nc", "K general public license",
    ])]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").union(
        spark.createDataFrame(extra, "doc_id long, text string")
    )
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = licenses.scan(docs).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == _base(texts[r.doc_id]), texts[r.doc_id]
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1


def _expand(parts):
    """All word sequences of a template given as nested lists (a list: optional)."""
    out = [[]]
    for part in parts:
        if isinstance(part, list):
            out = [a + b for a in out for b in [[], *_expand(part)]]
        else:
            out = [a + [part] for a in out]
    return out


def test_optional_regions_match_every_expansion_and_nothing_else(spark):
    automaton = licenses.Automaton("a [[b [[c]] d]] e [[f]]")
    allowed = _expand(["a", ["b", ["c"], "d"], "e", ["f"]])
    ids = {w: licenses._ids([w])[0] for w in "abcdefx"}
    import itertools

    import numpy as np
    for n in range(1, 7):
        for words in itertools.product("abcdefx", repeat=n) if n < 5 else allowed:
            words = list(words)
            best = max((len(s) for s in allowed if words[: len(s)] == s), default=0)
            assert automaton.longest(np.array([ids[w] for w in words], dtype=np.uint64)) == best


def test_replaceable_regions_have_bounds(spark):
    docs = spark.createDataFrame(
        [(1, "Copyright (c) 2020 Jane Doe. All rights reserved."), (2, "copyright all rights reserved"),
         (3, "copyright one two three four five six seven eight nine all rights reserved")],
        "doc_id long, text string",
    ).selectExpr("*", "1 as score", "'l' as labels")
    got = {r.doc_id: r.labels for r in licenses.scan(docs).collect()}
    assert got == {1: "copyright,reserved", 2: "reserved", 3: "reserved"}
    one_word_off = licenses.scan(
        spark.createDataFrame([(1, "Licensed under the Apache Licence, Version 2.0")], "doc_id long, text string")
    ).first()
    assert one_word_off.labels == ""
    with pytest.raises(ValueError):
        licenses.Automaton("[[a]]")
    with pytest.raises(ValueError):
        licenses.Automaton("a [[b")


def test_empty_table(spark):
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_a_long_text_of_openers_takes_time_in_proportion(spark):
    import time

    import pyarrow as pa

    from tickloom.llm.words import pieces

    scanner = licenses.Scanner(licenses.TEMPLATES)
    word = "under "
    took = {}
    for n in (20_000, 200_000):
        began = time.process_time()
        scanner.scan(next(pieces(pa.array([word * n]))))
        took[n] = time.process_time() - began
    assert took[200_000] < 4


def test_matches_longer_than_any_fixed_bound(spark):
    import numpy as np

    automaton = licenses.Automaton("open {{body:1-70000}} close")
    words = np.array(licenses._ids(["open"]) + licenses._ids(["x"]) * 69_000 + licenses._ids(["close", "x"]), dtype=np.uint64)
    assert automaton.longest(words) == 69_002


def test_empty_table(spark):
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []
