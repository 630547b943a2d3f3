"""Price-direction model: split, train, evaluate, score (Spark ML)."""

from __future__ import annotations

import json
from dataclasses import dataclass, replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.functions.numeric import fixed
from tickloom.operators.indicators import FEATURES, feature_table, training_rows
from tickloom.operators.series import TickSeries, one_block
from tickloom.plans import boosting, forest as packed_forest
from tickloom.plans.serve import enough_or_history
from tickloom.schema import symbol_dim
from tickloom.session import add_file, children, file_names, read_file, remove, stored

# Ensemble settings, rows needed before a symbol is scored.
TREES = 50
BOOST_DEPTH = 5
FOREST_DEPTH = 10
SEED = 42
MIN_ROWS = 25
SCORED_ROWS = 60
# From so many rows on both train on packed blocks; fewer fit the executors as Spark's objects, which is quicker.
PACKED_ROWS = 1_500_000


def time_split(series: TickSeries, rows: DataFrame, train_share: float = 0.8) -> DataFrame:
    """Add split = train / test: the first share of each symbol's history trains.

    The cut is a place in the series (percent rank of the tick), so it needs no sort.
    """
    rank = F.coalesce(F.try_divide(F.col("pos"), F.col("n") - 1), F.lit(0.0))
    return (
        rows.join(series.lengths, "symbol")
        .withColumn("split", F.when(rank <= train_share, "train").otherwise("test"))
        .drop("n")
    )


def random_split(rows: DataFrame, train_share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """The shuffled alternative: neighbours in time may land on both sides."""
    train, test = rows.randomSplit([train_share, 1.0 - train_share], seed=SEED)
    return train, test


def ensemble(trees: int = TREES) -> Pipeline:
    """Gradient boosting and random forest on the same vector; soft_vote averages them."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(FEATURES), outputCol="features"),
            GBTClassifier(maxIter=trees, maxDepth=BOOST_DEPTH, stepSize=0.1, seed=SEED, predictionCol="pred_gb")
            .setRawPredictionCol("raw_gb")
            .setProbabilityCol("prob_gb"),
            RandomForestClassifier(
                numTrees=trees, maxDepth=FOREST_DEPTH, seed=SEED,
                rawPredictionCol="raw_rf", probabilityCol="prob_rf", predictionCol="pred_rf",
            ),
        ]
    )


def train(rows: DataFrame, trees: int = TREES) -> PipelineModel:
    """Fit the stages of ``ensemble`` in turn."""
    columns = [F.col(c).cast("double") for c in FEATURES]
    points = rows.select(*columns, F.col("label").cast("double").alias("label"))
    assembler, booster, forest = ensemble(trees).getStages()
    vectors = assembler.transform(points)
    if points.count() < PACKED_ROWS:
        boosted = booster.fit(vectors)
        return PipelineModel([assembler, boosted, forest.fit(boosted.transform(vectors))])
    packed = boosting.points_of(booster, vectors, list(FEATURES))  # both have the same bins and seed
    models = [boosting.fit(booster, packed), packed_forest.fit(forest, packed)]
    remove(rows.sparkSession, packed.path)
    return PipelineModel([assembler, *models])


def soft_vote(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """rows plus prob_up, prob_down, prediction (1 = UP)."""
    up = (vector_to_array("prob_gb")[1] + vector_to_array("prob_rf")[1]) / 2.0
    scored = model.transform(rows).withColumn("prob_up", up)
    return scored.withColumns(
        {
            "prob_down": F.lit(1.0) - F.col("prob_up"),
            "prediction": (F.col("prob_up") > 0.5).cast("int"),
        }
    ).drop("features", "raw_gb", "prob_gb", "pred_gb", "raw_rf", "prob_rf", "pred_rf")


def evaluation(scored: DataFrame) -> DataFrame:
    """accuracy, base_rate (share of UP) and row count of labelled, scored rows."""
    return scored.agg(
        F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"),
        F.avg(F.col("label").cast("double")).alias("base_rate"),
        F.count(F.lit(1)).alias("row_count"),
    )


def newest_features(series: TickSeries) -> DataFrame:
    """Feature row of the last tick of each symbol that has at least MIN_ROWS ticks.

    Only the last MIN_ROWS places are read into the window.
    """
    tail = replace(series, table=series.table.where(series.newest(MIN_ROWS, least=MIN_ROWS)))
    return feature_table(tail).where(series.newest(1) & F.col("own") & F.col("ready"))


@dataclass(frozen=True)
class Bundle:
    """A stored model with its card: version, accuracy, base_rate, row_count (of the held-out rows) and features."""

    model: PipelineModel
    card: dict


def _versions(spark: SparkSession, folder: str) -> list[int]:
    names = [n for n in children(spark, folder) if n.startswith("version=")]
    return sorted(int(n.partition("=")[2]) for n in names if "card.json" in file_names(spark, f"{folder}/{n}"))


def publish(spark: SparkSession, folder: str, model: PipelineModel, scores: dict) -> int:
    """Store a model as the next version. The card is written last and makes the version count; of two writers of
    one version the second is an error."""
    version = max(_versions(spark, folder), default=0) + 1
    path = f"{folder}/version={version}"
    model.write().overwrite().save(f"{path}/model")
    card = {"version": version, "features": list(FEATURES), **scores}
    if not add_file(spark, f"{path}/card.json", json.dumps(card)):
        raise RuntimeError(f"version {version} was written at the same time")
    return version


def load_bundle(spark: SparkSession, folder: str, version: int | None = None) -> Bundle:
    """The newest version, or a given one. A model made for other features is refused."""
    known = _versions(spark, folder)
    if not known or version not in (None, *known):
        raise ValueError(f"no model version {version or ''} in {folder}")
    path = f"{folder}/version={version or known[-1]}"
    card = json.loads(read_file(spark, f"{path}/card.json"))
    if card["features"] != list(FEATURES):
        raise ValueError(f"{path} was trained on other features")
    return Bundle(PipelineModel.load(f"{path}/model"), card)


def train_bundle(
    series: TickSeries, folder: str, trees: int = TREES, shuffled: bool = False, rows: DataFrame | None = None
) -> Bundle:
    """Train on the first part of every history (or on a random part), hold out the rest, store model and scores.

    ``rows``: the stored ``labelled_rows`` of the series, if there are any yet.
    """
    spark = series.table.sparkSession
    rows = stored(labelled_rows(series), "labelled") if rows is None else rows
    if shuffled:
        fit, held = random_split(rows.drop("split"))
    else:
        fit, held = rows.where("split = 'train'"), rows.where("split = 'test'")
    model = train(fit, trees)
    publish(spark, folder, model, evaluation(soft_vote(model, held)).first().asDict())
    return load_bundle(spark, folder)


def scored_series(series: TickSeries, history: TickSeries | None) -> TickSeries:
    """The newest ticks that are scored: a symbol with fewer than MIN_ROWS live ticks is filled from its history."""
    if history is None:
        return series
    columns = [c for c in series.rows.columns if c in history.rows.columns and c not in ("pos", "block")]
    live, past = (s.rows.where(s.newest(SCORED_ROWS)).select(*columns) for s in (series, history))
    return one_block(stored(enough_or_history(live, past, MIN_ROWS, SCORED_ROWS).drop("source"), "scored-ticks"))


def predict_newest(series: TickSeries, bundle: Bundle, history: TickSeries | None = None) -> DataFrame:
    """Direction call per symbol with the accuracy of the model that made it; 'not enough data' below MIN_ROWS ticks,
    live and (if given) historic ones together."""
    ticks = scored_series(series, history)
    scored = soft_vote(bundle.model, newest_features(ticks)).select("symbol", "prediction", "prob_up", "prob_down")
    dim = symbol_dim(series.table.sparkSession)
    return dim.join(scored, "symbol", "left").select(
        "symbol", "name",
        F.when(F.col("prediction") == 1, "UP").when(F.col("prediction") == 0, "DOWN")
        .otherwise("not enough data").alias("prediction"),
        fixed(F.coalesce(F.greatest("prob_up", "prob_down"), F.lit(0.0)), 3).alias("confidence"),
        fixed(F.coalesce("prob_up", F.lit(0.0)), 3).alias("prob_up"),
        fixed(F.coalesce("prob_down", F.lit(0.0)), 3).alias("prob_down"),
        fixed(F.lit(bundle.card["accuracy"]).cast("double"), 4).alias("accuracy"),
        F.lit(bundle.card["version"]).alias("model_version"),
    )


def prediction_flips(predictions: DataFrame) -> DataFrame:
    """Predictions that differ from the symbol's previous one.

    Inside a block a lag finds the previous prediction; the first prediction of a block takes the
    last one of the nearest earlier block, found over one summary row per block.
    """
    inside = F.lag("prediction").over(Window.partitionBy("symbol", "block").orderBy("pos"))
    ends = predictions.groupBy("symbol", "block").agg(F.max_by("prediction", "pos").alias("_end"))
    carried = ends.withColumn(
        "_carry", F.lag("_end").over(Window.partitionBy("symbol").orderBy("block"))
    ).drop("_end")
    return (
        predictions.withColumn("_inside", inside)
        .join(carried, ["symbol", "block"], "left")
        .withColumn("previous", F.coalesce("_inside", "_carry"))
        .where(F.col("previous") != F.col("prediction"))
        .drop("_inside", "_carry")
    )


def labelled_rows(series: TickSeries) -> DataFrame:
    return time_split(series, training_rows(series))
