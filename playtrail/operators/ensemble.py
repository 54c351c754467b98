"""The style-1 ensemble (F15 with F23): six fitted models over one stored feature
table, scored side by side and voted.

The table holds the train sessions, the hold-out sessions and the test players'
sessions, all standardised with train statistics. Every model is fitted on its
train part; scoring adds one prediction column per model to the other rows, so
the votes stand in one row and need no shuffle of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import OneVsRest
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtrail.operators import features as FT
from playtrail.operators import knn as K
from playtrail.operators import models as M
from playtrail.operators.relational import session_starts
from playtrail.schema import KEY, SESSION
from playtrail.session import materialize

ROW, PART = "row_key", "part"
#: The four models of the vote; the dense net is scored beside them.
VOTERS = ("ovr", "multinomial", "knn", "forest")
ALL_MODELS = (*VOTERS, "vote", "mlp")
KNN_K, TREES = 150, 50


def feature_table(train_clicks: DataFrame, test_clicks: DataFrame, labels: DataFrame, specs: DataFrame) -> tuple[DataFrame, int]:
    """(table, width): one row per session (and world) with ``part`` train, holdout or
    test, the label (null on test) and the standardised features; written once."""
    known = FT.thin_class(FT.session_features(FT.style1_events(train_clicks, labels, specs)), SESSION)
    known = materialize(known, "style1-train")       # read for the worlds, the scaler and the table
    worlds = FT.fit_values(known, "world")
    cols = FT.FEATURE_COLS + [f"world_{w}" for w in worlds]
    known = M.with_label(FT.split(FT.dummies(known, "world", worlds, drop=False), SESSION)).withColumn(
        PART, F.when(F.col("split") == "train", "train").otherwise("holdout"))
    scaler = FT.Standardizer.fit(known.where(F.col(PART) == "train"), cols)
    events = FT.style1_events(test_clicks, labels, specs, train=False)
    test = FT.session_features(events, [SESSION, "world", KEY])
    test = FT.dummies(test, "world", worlds, drop=False).withColumns({PART: F.lit("test"), M.LABEL: F.lit(None).cast("double")})
    keep = [KEY, SESSION, "world", PART, M.LABEL, *cols]
    both = known.select(*keep).unionByName(test.select(*keep))
    starts = session_starts(train_clicks.unionByName(test_clicks))
    both = scaler.transform(both).join(starts, [KEY, SESSION]).withColumn(ROW, F.concat_ws("|", KEY, SESSION, "world"))
    return materialize(M.assemble(both, cols).drop(*cols, "world"), "style1-features"), len(cols)


def _named(estimator, name: str):
    """``estimator`` with output columns of its own."""
    if isinstance(estimator, M.Forest):
        return estimator.named(f"predictionCol_{name}")
    for param in ("predictionCol", "probabilityCol", "rawPredictionCol"):
        if estimator.hasParam(param) and not isinstance(estimator, OneVsRest) or param == "predictionCol":
            estimator = estimator.copy({estimator.getParam(param): f"{param}_{name}"})
    return estimator


def majority(votes: Sequence[Column]) -> Column:
    """The most frequent of a row's votes, ties to the smaller label."""
    every = F.array(*votes)
    counted = F.transform(every, lambda v: F.struct(F.size(F.filter(every, lambda x: x == v)).alias("n"), (-v).alias("neg")))
    return -F.array_max(counted)["neg"]


def fitted(estimators: dict, train: DataFrame) -> dict:
    """The models of independent estimators, fitted as concurrent Spark jobs: the many
    short jobs of one leave no task slot idle that another can use."""
    from multiprocessing.pool import ThreadPool

    from pyspark.util import inheritable_thread_target

    def one(name: str):
        return _named(estimators[name], name).fit(train)

    pool = ThreadPool(processes=max(1, len(estimators)))
    try:
        return dict(zip(estimators, pool.map(inheritable_thread_target(train.sparkSession)(one), list(estimators))))
    finally:
        pool.close()


def score_all(table: DataFrame, width: int, k: int = KNN_K, trees: int = TREES) -> DataFrame:
    """Rows outside the train part with a prediction column per model of ``ALL_MODELS``."""
    train, rows = table.where(F.col(PART) == "train"), table.where(F.col(PART) != "train")
    estimators = {"ovr": M.logistic_ovr(), "multinomial": M.logistic_multinomial(), "forest": M.narrow_forest(trees), "mlp": M.mlp(width)}
    scored = rows
    for name, model in fitted(estimators, train).items():
        held = scored.columns
        scored = model.transform(scored)
        scored = scored.select(*held, F.col(f"predictionCol_{name}").cast("int").alias(name))
    near = K.knn_vote(train, rows, ROW, M.FEATURES, k, M.LABEL, out="knn").withColumn("knn", F.col("knn").cast("int"))
    scored = scored.drop(M.FEATURES).join(near, ROW)
    return scored.withColumn("vote", majority([F.col(c) for c in VOTERS]))


def last_by_model(scored: DataFrame) -> DataFrame:
    """Of each test player and model, the prediction of the last session: player, model,
    accuracy_group."""
    from playtrail.operators.scoring import last_prediction
    test = scored.where(F.col(PART) == "test")
    long = test.select(KEY, "start", SESSION, F.explode(F.array(*[
        F.struct(F.lit(m).alias("model"), F.col(m).alias("prediction")) for m in ALL_MODELS])).alias("m")).select(
        F.struct(KEY, "m.model").alias("of"), "start", SESSION, "m.prediction")
    last = last_prediction(long, "of", ["start", SESSION])
    return last.select(f"of.{KEY}", "of.model", F.col("prediction").alias("accuracy_group"))
