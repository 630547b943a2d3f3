import re
import zlib
from collections import Counter

import pytest

from tickloom.llm import spelling
from tickloom.llm.tables import table

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def _words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def _brute(rows):
    words = _words(rows)
    near = {w: set() for w in words}
    holes = {}
    for w in words:  # two words are one edit apart if they agree without one letter, or one is the other's rest
        for i in range(len(w)):
            holes.setdefault((i, w[:i] + w[i + 1 :]), []).append(w)
            rest = w[:i] + w[i + 1 :]
            if rest in near and rest != w:
                near[w].add(rest)
                near[rest].add(w)
    for group in holes.values():
        for a in group:
            near[a].update(b for b in group if b != a)
    out = {}
    forms = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        forms[w] = best if best is not None and words[best] >= 10 * n else None
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        out[w] = (forms[w], root, n, len(near[w]), words[forms[w]] if forms[w] else None)
    return out


def _got(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def test_whole_table_against_every_pair(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    brute = _brute(rows)
    assert any(v[0] for v in brute.values())
    assert _got(spelling.group_variants(docs)) == brute


@pytest.mark.parametrize("shard_words", [1, 40, 50_000])
def test_edges_of_words_and_shards(spark, shard_words):
    many = "straßburg strassburg strasburg straßbürg ÉCOLIÈRE écolière écoliere ecoliere aaaaaaa aaaaaaaa aaaaaaaaa bananas"
    rows = [
        (1, None), (2, ""), (None, many), (None, many), (3, many + " " + "x" * 5000 + " " + "x" * 4999 + " " + "x" * 70),
        (3, "x" * 5000 + "-" + "x" * 4999 + "’" + "x" * 69 + "y x" + "x" * 70), (4, "BANANAS bananax bañanas " * 40),
        (5, "bananax banana's bananas÷bananas×bananasa"), (6, "aebdcfg abedcfg " * 3 + "gfcdeba " * 30), (7, "x" * 69 + "y"),
        (8, "harbours harbours " + "harbourss " * 30 + "harboursss " * 400), (-9, many * 50),
    ]
    docs = spark.createDataFrame([(*r, 7, "clash") for r in rows], "doc_id long, text string, n int, word string")
    brute = _brute(rows)
    assert brute["harbours"][:2] == ("harbourss", "harboursss")
    assert _got(spelling.group_variants(docs, shard_words)) == brute


def test_empty(spark):
    assert spelling.group_variants(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_checksums_of_runs_of_any_length():
    heads = [b"1:", b"-77:", b":"]
    moved = spelling._shifted(spelling.np.array([zlib.crc32(h) for h in heads], dtype="uint32"), 9)
    for i, head in enumerate(heads):
        for word in (b"", b"a", b"longword"):
            assert int(moved[len(word), i]) ^ zlib.crc32(word) == zlib.crc32(head + word)
