"""Style 3 from train players to the submission for test players.

What is fitted on the train players is saved as tables (and a model folder) under
one path: the vocabulary, the sequence model, the rounded mean score per title,
and the cluster centres with the result group each stands for. The test half needs
no label: it reads the saved state and the test players' events.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playtrail.operators import features as FT
from playtrail.operators import models as M
from playtrail.operators import sequences as S
from playtrail.operators.labelling import assessment_starts
from playtrail.operators.relational import first_per_key, only_type, session_starts
from playtrail.operators.scoring import cluster_to_group
from playtrail.schema import ASSESSMENT_TITLES, KEY, SESSION
from playtrail.session import materialize

VOCABULARY, FILLS, CENTRES, MODEL = "vocabulary", "fills", "centres", "model"


def _save(df: DataFrame, path: str, name: str) -> None:
    df.write.mode("overwrite").parquet(os.path.join(path, name))


def _load(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(path, name))


def fit_vocabulary(clicks: DataFrame, labels: DataFrame, path: str) -> DataFrame:
    """Vocabulary of the train players' assessment sequences; returns their table (Z3)."""
    table, vocab = S.style3_sequences(clicks, labels)
    _save(vocab, path, VOCABULARY)
    return table


def fit_profiles(clicks: DataFrame, labels: DataFrame, path: str, titles: Sequence[str] = ASSESSMENT_TITLES, k: int = 4) -> None:
    """Fills and cluster centres of the train players' profiles."""
    spark = clicks.sparkSession
    profile = materialize(FT.score_profile(assessment_starts(clicks, labels), titles), "style3-profiles")
    fills = FT.fit_profile_fill(profile, titles)
    _save(spark.createDataFrame([(t, fills[t]) for t in titles], "title string, value double").coalesce(1), path, FILLS)
    assigned, model = M.cluster_profiles(FT.fill_profile(profile, fills).drop("accuracy_group"), titles, k)
    groups = {r["cluster"]: r["accuracy_group"] for r in                # one row per cluster
              cluster_to_group(assigned, "cluster", titles).select("cluster", "accuracy_group").distinct().collect()}
    rows = [(i, groups.get(i), [float(v) for v in c]) for i, c in enumerate(model.clusterCenters())]
    _save(spark.createDataFrame(rows, "cluster int, accuracy_group int, centre array<double>").coalesce(1), path, CENTRES)


def fit_style3(clicks: DataFrame, labels: DataFrame, path: str) -> None:
    """All fitted state of style 3 under ``path``."""
    table = materialize(fit_vocabulary(clicks, labels, path), "style3-sequences")
    M.sequence_classifier().fit(M.with_label(M.sequence_tokens(table))).write().overwrite().save(os.path.join(path, MODEL))
    fit_profiles(clicks, labels, path)


def test_sequences(clicks: DataFrame, path: str) -> DataFrame:
    """Z3, test half: padded sequences of every assessment session of ``clicks`` in the
    saved vocabulary's ids, with the session's title and start. No label is read."""
    vocab = _load(clicks.sparkSession, path, VOCABULARY)
    played = only_type(clicks)                                                   # P10
    about = first_per_key(played, [KEY, SESSION], ["ts", "event_count", "src_id"], ["title"]).join(session_starts(played), [KEY, SESSION])
    return S.unlabelled_sequences(played, vocab, [KEY, SESSION]).join(about, [KEY, SESSION])


def test_profiles(scored: DataFrame, path: str, titles: Sequence[str] = ASSESSMENT_TITLES) -> DataFrame:
    """Z4, test half up to F5: first predicted score per title (A13), filled with the
    saved train means; ``<title> filled`` tells which scores were filled."""
    fills = {r["title"]: r["value"] for r in _load(scored.sparkSession, path, FILLS).collect()}       # one row per title
    profile = materialize(FT.score_profile(scored, titles), "style3-test-profiles")
    flags = {f"{t} filled": F.col(f"`{t}`").isNull() for t in titles}
    return FT.fill_profile(profile.withColumns(flags), {t: fills[t] for t in titles})


def apply_clusters(profiles: DataFrame, path: str, titles: Sequence[str] = ASSESSMENT_TITLES) -> DataFrame:
    """F18, F19 applied: the result group of the nearest saved centre (ties to the
    smaller cluster number)."""
    centres = _load(profiles.sparkSession, path, CENTRES).collect()                                   # k rows
    near = [F.struct(sum((F.col(f"`{t}`") - F.lit(v)) * (F.col(f"`{t}`") - F.lit(v)) for t, v in zip(titles, c["centre"])).alias("d"),
                     F.lit(c["cluster"]).alias("cluster"), F.lit(c["accuracy_group"]).alias("accuracy_group")) for c in centres]
    return profiles.drop("accuracy_group").withColumn("_near", F.array_min(F.array(*near))).select(
        "*", "_near.cluster", "_near.accuracy_group").drop("_near")


def score_style3(clicks: DataFrame, path: str) -> DataFrame:
    """Predicted result of every assessment session of the test players."""
    model = PipelineModel.load(os.path.join(path, MODEL))
    scored = model.transform(M.sequence_tokens(test_sequences(clicks, path)))
    return scored.select(KEY, SESSION, "title", "start", F.col("prediction").cast("int").alias("accuracy_group"))


def submission(clicks: DataFrame, path: str) -> DataFrame:
    """Test players with their predicted group, as the submission lists them."""
    profiles = test_profiles(materialize(score_style3(clicks, path), "style3-scored"), path)
    return apply_clusters(profiles, path).select(KEY, "accuracy_group")
