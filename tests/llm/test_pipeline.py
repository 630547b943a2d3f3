from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tests.compare import connect, difference, spark_table, sql_table
from tests.llm import brute
from tests.llm.test_mixing import _targets, _totals
from tests.llm.test_neardup import _classes
from tickloom.llm import neardup, quality, registry

SF = "/root/testdata/sf0.001"


def test_each_stage_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tables = [docs]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(number))
        stage(spark, tables[-1], SF).write.parquet(path)
        tables.append(spark.read.parquet(path))
    rows = [t.collect() for t in tables]
    assert all(t.columns == docs.columns for t in tables[:5])

    trees = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    kept = {r.doc_id for r in quality.score(docs, trees).collect() if r.kept}
    for r in rows[0]:
        n, _, _, _, repeat = brute.quality(r.text)
        assert not (r.doc_id in kept and (n < 20 or 100 * repeat > 30 * n))
    assert sorted(rows[1]) == sorted(r for r in rows[0] if r.doc_id in kept)

    idf = neardup.count_documents(tables[1].select("doc_id", "text"))[0]
    found = _classes([(r.doc_id, r.text) for r in rows[1]], idf)
    assert sorted(rows[2]) == sorted(r for r in rows[1] if found[r.doc_id] == r.doc_id)

    cut = brute.repeats([(r.doc_id, r.text) for r in rows[2]])
    before = {r.doc_id: r for r in rows[2]}
    after = {r.doc_id: r for r in rows[3]}
    for doc_id, (n_words, n_removed, _) in cut.items():
        if n_removed == 0:
            assert after[doc_id] == before[doc_id]
        else:
            left = brute.words(after[doc_id].text) if doc_id in after else []
            assert len(left) == n_words - n_removed
            assert not left or after[doc_id].n_chars == len(after[doc_id].text)

    targets = _targets(_totals(rows[3]))
    taken = Counter()
    for r in rows[4]:
        taken[r.source] += len(brute.words(r.text))
    longest = max(len(brute.words(r.text)) for r in rows[3])
    assert all(abs(taken[s] - targets[s]) <= max(0.05 * targets[s], longest) for s in targets)
    assert max(Counter(r.doc_id for r in rows[4]).values()) <= 2

    tokens = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    wanted = Counter(np.array([*tokens.encode(r.text, add_special_tokens=False).ids, 1], "<u4").tobytes() for r in rows[4])
    sequences: dict = {}
    for r in rows[5]:
        sequences.setdefault(r.sequence_id, []).append(r)
    assert all(sum(len(r.ids) for r in s) <= 4 * 2048 for s in sequences.values())
    assert sum(len(r.ids) for r in rows[5]) == sum(len(k) * n for k, n in wanted.items())
    whole = Counter(r.ids for r in rows[5] if len(r.ids) == 4 * r.doc_tokens)
    assert all(wanted[bytes(k)] == n for k, n in whole.items())


def test_run_is_the_stages_in_turn(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_empty_and_clashing_tables_pass_every_stage(spark, tmp_path):
    path = str(tmp_path / "odd")
    rows = [(None, "a", None), (1, None, None), (1, "word " * 50, "s"), (2, " ".join(f"w{i}" for i in range(50)), None),
            (2, " ".join(f"w{i}" for i in range(50)), None), (3, "", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr(
        "*", "'x' as id", "1L as part", "2L as row", "3 as size", "4 as mask", "5 as tilt"
    )
    docs.write.parquet(path)
    for keep in ("true", "false"):
        docs = spark.read.parquet(path).where(keep)
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, docs, SF).write.parquet(f"{path}-{keep}-{number}")
            docs = spark.read.parquet(f"{path}-{keep}-{number}")


def test_queries_with_sql_match_it(spark):
    sf_dir = "/root/testdata/sf0.01"
    con = connect(sf_dir)
    for name, sql in registry.SQL.items():
        assert difference(spark_table(registry.QUERIES[name](spark, sf_dir)), sql_table(con, sql)) is None, name
