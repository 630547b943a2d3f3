"""Boosting and forest over packed rows against Spark's own trainers and plain counting."""

import re

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tickloom.operators.indicators import FEATURES
from tickloom.plans import boosting, forest, model

NUMBER = re.compile(r"-?\d+\.\d+(?:E-?\d+)?")


def points(spark, n, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, len(FEATURES)))
    x[:, 3] = np.round(x[:, 3])  # few values, zeros among them
    x[:, 5] = 7.0  # no threshold
    label = (x[:, 0] + x[:, 1] * x[:, 3] + rng.normal(size=n) > 0).astype(float)
    rows = [(*map(float, r), float(y)) for r, y in zip(x, label)]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in (*FEATURES, "label"))).repartition(3).cache()


@pytest.fixture
def small_blocks(spark, monkeypatch):
    monkeypatch.setattr(boosting, "BLOCK", 100)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "40")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def packed(booster, vectors):
    return boosting.fit(booster, boosting.points_of(booster, vectors, list(FEATURES)))


def outline(fitted):
    """(text of the trees without numbers, their numbers)"""
    text = fitted.toDebugString
    return NUMBER.sub("#", text), [float(v) for v in NUMBER.findall(text)]


@pytest.mark.parametrize(("every", "sums"), [(boosting.STORED_EVERY, boosting.TO_DRIVER), (2, 1)])
def test_packed_boosting_grows_the_trees_of_spark(spark, monkeypatch, small_blocks, every, sums):
    monkeypatch.setattr(boosting, "STORED_EVERY", every)
    monkeypatch.setattr(boosting, "TO_DRIVER", sums)
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 27))  # a task a file
    monkeypatch.setattr(model, "BOOST_DEPTH", 3)  # nodes of few rows have equally good splits, which rounding decides
    assembler, booster, _ = model.ensemble(5).getStages()
    vectors = assembler.transform(points(spark, 3000))
    want, got = booster.fit(vectors), packed(booster, vectors)
    spark.conf.unset("spark.sql.files.openCostInBytes")
    (shape, values), (own_shape, own_values) = outline(want), outline(got)
    assert own_shape == shape and own_values == pytest.approx(values, abs=1e-9)
    assert got.treeWeights == want.treeWeights and got.uid == want.uid
    assert got.featureImportances.toArray() == pytest.approx(want.featureImportances.toArray())
    up = [[r.p for r in m.transform(vectors).select(vector_to_array("prob_gb")[1].alias("p")).collect()] for m in (want, got)]
    assert up[1] == pytest.approx(up[0])


def test_long_histories_are_trained_in_packed_blocks(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(model, "BOOST_DEPTH", 3)
    rows = points(spark, 2000)
    usual = model.train(rows, 8)
    monkeypatch.setattr(model, "PACKED_ROWS", 2000)
    for trainer in ("GBTClassifier", "RandomForestClassifier"):
        monkeypatch.setattr(f"pyspark.ml.classification.{trainer}._fit", lambda *a: pytest.fail("rows were kept as objects"))
    model.train(rows, 8).write().save(str(tmp_path / "model"))
    packed = model.PipelineModel.load(str(tmp_path / "model"))
    (shape, values), (own_shape, own_values) = (outline(m.stages[1]) for m in (usual, packed))
    assert own_shape.split("\n", 1)[1] == shape.split("\n", 1)[1] and own_values == pytest.approx(values, abs=1e-9)
    held = points(spark, 2000, seed=4)
    want, got = (model.evaluation(model.soft_vote(m, held)).first() for m in (usual, packed))
    assert got.row_count == want.row_count and got.accuracy == pytest.approx(want.accuracy, abs=0.03)


def test_packed_forest_predicts_as_well_as_spark(spark):
    assembler, booster, trees = model.ensemble(20).getStages()
    vectors, held = (assembler.transform(points(spark, 3000, seed)) for seed in (3, 4))
    want = trees.fit(vectors)
    got = forest.fit(trees, boosting.points_of(booster, vectors, list(FEATURES)))
    right = [m.transform(held).agg(F.avg((F.col("pred_rf") == F.col("label")).cast("double"))).first()[0] for m in (want, got)]
    assert right[1] == pytest.approx(right[0], abs=0.03) and right[0] > 0.65
    assert got.featureImportances.toArray() == pytest.approx(want.featureImportances.toArray(), abs=0.06)
    assert len(got.trees) == 20 and got.totalNumNodes == pytest.approx(want.totalNumNodes, rel=0.1)
    assert max(t.depth for t in got.trees) == model.FOREST_DEPTH


def test_forest_nodes_hold_the_drawn_rows_and_the_best_of_the_tried_splits(spark, monkeypatch, small_blocks):
    assembler, booster, _ = model.ensemble(3).getStages()
    packed = boosting.points_of(booster, assembler.transform(points(spark, 900)), list(FEATURES))
    plans, inner = [], forest.level_splits
    monkeypatch.setattr(forest, "level_splits", lambda p, trees, tried, seed: plans.append(tried) or inner(p, trees, tried, seed))
    grown = forest.grow(packed, 3, 4, seed=5)
    blocks = packed.table.collect()
    assert len(blocks) > 6
    for t, tree in enumerate(grown):
        bins, up, times = [], [], []
        for b in blocks:
            sign = np.frombuffer(b.sign, np.int8)
            codes = np.frombuffer(b.codes, np.uint16).reshape(-1, len(sign))
            bins.append(np.stack([boosting.bin_of(codes, f, packed.bits) for f in range(len(FEATURES))], axis=1))
            up.append(sign > 0)
            times.append(forest.drawn(5, t, b.part, b.block, len(sign)))
        bins, up, times = np.concatenate(bins), np.concatenate(up), np.concatenate(times)

        def counted(rows):
            return np.array([times[rows & ~up].sum(), times[rows & up].sum()], dtype=float)

        level = [(0, np.ones(len(up), bool))]
        for tried in plans:
            following, tried = [], dict(zip(sorted(k for k, r in level if forest.gini(counted(r)) >= boosting.PURE), tried[t], strict=True))
            for k, rows in level:
                assert counted(rows).tolist() == list(tree.counts[k])
                if k not in tried:
                    continue
                sizes = {f: counted(rows).sum() for f in tried[k]}
                gains = {}
                for f in tried[k]:
                    for cut in range(len(packed.thresholds[f])):
                        sides = [counted(rows & (bins[:, f] <= cut)), counted(rows & (bins[:, f] > cut))]
                        if min(s.sum() for s in sides) >= 1:
                            gains[f, cut] = forest.gini(counted(rows)) - sum(s.sum() / sizes[f] * forest.gini(s) for s in sides)
                if not tree.left[k]:
                    assert max(gains.values(), default=0) <= 1e-12
                    continue
                split = tree.feature[k], tree.cut[k]
                assert tree.gain[k] == pytest.approx(max(gains.values())) == pytest.approx(gains[split])
                right = bins[:, split[0]] > split[1]
                following += [(tree.left[k], rows & ~right), (tree.left[k] + 1, rows & right)]
            level = following


def test_draws_are_poisson_and_the_same_in_every_pass():
    times = forest.drawn(1, 2, 3, 4, 200_000)
    assert (times == forest.drawn(1, 2, 3, 4, 200_000)).all() and (times != forest.drawn(1, 3, 3, 4, 200_000)).any()
    assert times.mean() == pytest.approx(1, abs=0.01) and times.var() == pytest.approx(1, abs=0.02)
    assert (times == 0).mean() == pytest.approx(np.exp(-1), abs=0.01)


@pytest.mark.parametrize("label", [0.0, 1.0])
def test_one_class_and_equal_rows_give_single_leaves(spark, label):
    assembler, booster, _ = model.ensemble(2).getStages()
    alike = points(spark, 60).withColumn("label", F.lit(label))
    same = points(spark, 60).select(*[F.lit(1.0).alias(c) for c in FEATURES], "label")
    for rows in (alike, same):
        vectors = assembler.transform(rows)
        (shape, values), (own_shape, own_values) = map(outline, (booster.fit(vectors), packed(booster, vectors)))
        assert own_shape == shape and own_values == pytest.approx(values, abs=1e-9)


def test_missing_features_and_empty_tables_are_refused_as_by_spark(spark):
    assembler, booster, _ = model.ensemble(2).getStages()
    holed = points(spark, 60).withColumn("rsi", F.lit(float("nan")))
    for rows in (holed, points(spark, 60).where("false")):
        with pytest.raises(Exception):
            booster.fit(assembler.transform(rows))
        with pytest.raises(Exception):
            packed(booster, assembler.transform(rows))
