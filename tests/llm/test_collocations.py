import random
import re
from collections import Counter

from tests.llm import brute
from tickloom.llm import collocations
from tickloom.llm.tables import table

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def _brute(rows, min_count, top):
    f, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    key = lang, tuple(words[i : i + size])
                    f[key] = f.get(key, 0) + 1
    found = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= min_count}
    gone = set()
    for (lang, words), a in found.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                part = lang, words[i : i + size]
                if 100 * a >= 80 * found[part]:
                    gone.add(part)
    out = {}
    for (lang, words), a in found.items():
        if (lang, words) in gone:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = f[lang, words[:k]], f[lang, words[k:]]
            cuts.append((2000000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), a, left, right, n[lang], score))
    return [
        (lang, rank, x[2].decode(), *x[3:])
        for lang, found in sorted(out.items()) for rank, x in enumerate(sorted(found)[:top], 1)
    ]


def _got(df):
    rows = df.collect()
    return sorted(tuple(r)[:8] for r in rows), {(r.lang, r.phrase): r.passage for r in rows if r.passage}


def test_whole_table_against_every_phrase(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = [tuple(r) for r in docs.select("lang", "text").collect()]
    got, paths = _got(collocations.collocations(docs))
    assert got == _brute(rows, 30, 2000)
    assert any(len(p.split()) > 4 for p in paths.values())
    for (lang, phrase), path in paths.items():
        assert f" {phrase} " in f" {path} "


def test_edge_rows_paths_and_ties(spark):
    rng = random.Random(3)
    line = " ".join(f"p{i}" for i in range(40))
    rows = [("en", t) for t in brute.TRICKY] + [(None, "a b c d e"), ("und", "a B c! D e")] * 3
    rows += [("en", f"x{i} {line} y{i}. {line}") for i in range(3)] + [("de", line + " z")]
    rows += [("fr", " ".join(rng.choice("abc") for _ in range(rng.randrange(30)))) for _ in range(60)]
    rows += [("loop", "a a a a a a\x0ba a a a, a b a b a b a b"), ("loop", "q r s t q r s t q r s t q r s t")] * 2
    docs = spark.createDataFrame(
        [(*r, 1, "clash") for r in rows], "lang string, text string, n int, phrase string"
    ).repartition(3)
    for top in (2000, 7):
        got, paths = _got(collocations.collocations(docs, 3, top))
        assert got == _brute(rows, 3, top)
    assert {p for (lang, _), p in paths.items() if lang == "en"} <= {line} | set(paths.values())
    long = _got(collocations.collocations(docs, 6, 2000))[1]
    assert line in long.values()


def test_rare_pairs_in_marked_slots_change_nothing(spark, monkeypatch):
    rng = random.Random(4)
    rows = [("en", " ".join(rng.choice("abcdefgh") for _ in range(12))) for _ in range(80)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    everything = collocations.np.full(collocations.PAIR_SLOTS // 8, 255, dtype=collocations.np.uint8)
    plain = _got(collocations.collocations(docs, 9))[0]
    monkeypatch.setattr(collocations, "frequent_pairs", lambda docs, n: everything)
    assert _got(collocations.collocations(docs, 9))[0] == plain == _brute(rows, 9, 2000)


def test_only_frequent_pairs_and_triples_are_marked(spark):
    """Counts of one slot come together from all tasks, also above what a byte holds; rare phrases make no edges."""
    rng = random.Random(9)
    line = "one two three"
    rows = [("en", " ".join(rng.choice("abcdef") for _ in range(40)) + ", " + line) for _ in range(400)]
    docs = spark.createDataFrame(rows + [(None, line)], "lang string, text string").repartition(5)
    found = Counter()
    for _, text in rows:
        for piece in text.split(","):
            words = piece.split()
            for size in (2, 3):
                found.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    for least in (300, 400, 401):
        pairs = collocations.frequent_pairs(docs, least)
        triples = collocations.frequent_triples(docs, least, pairs)
        for size, marks in ((2, pairs), (3, triples)):
            assert int(collocations.np.bitwise_count(marks).sum()) == sum(n >= least for k, n in found.items() if len(k) == size)
        edges = collocations.edges(docs, pairs, triples).where("lang = 'en'").collect()
        assert sum(r.n for r in edges) == sum(n for k, n in found.items() if len(k) == 2 and n >= least)
        long = [r for r in edges if r.w3]
        assert sum(r.n for r in long) == sum(n for k, n in found.items() if len(k) == 3 and n >= least)
        assert len(edges) == sum(n >= least for k, n in found.items() if len(k) == 2)


def test_empty(spark):
    assert collocations.collocations(spark.createDataFrame([], "lang string, text string")).collect() == []
    assert collocations.collocations(spark.createDataFrame([(None, None)], "lang string, text string")).collect() == []


def test_scores_past_64_bits(spark):
    big = 1 << 61
    phrases = spark.createDataFrame([("en", [1, 2], big)], "lang string, words array<long>, a long")
    counts = spark.createDataFrame([("en", [1], big + 5), ("en", [2], big)], "lang string, words array<long>, a long")
    assert collocations._scored(phrases, counts).first().score == 2_000_000 * big // (2 * big + 5)
