"""Scoring (F15, F19-F22, F24): votes, cluster-to-group mapping, accuracy,
cross-entropy, confusion counts, last prediction per player."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playtrail.operators.relational import last_per_key


def hard_vote(votes: DataFrame, keys: Sequence[str], vote: str = "prediction", out: str = "prediction") -> DataFrame:
    """the most frequent vote per key, ties to the smaller label. Votes come
    in long form (one row per key and model); both steps are partial aggregates."""
    counts = votes.groupBy(*keys, vote).agg(F.count(F.lit(1)).alias("_n"))
    best = counts.groupBy(*keys).agg(F.max(F.struct(F.col("_n"), (-F.col(vote)).alias("_neg"))).alias("_b"))
    return best.select(*keys, (-F.col("_b")["_neg"]).cast(votes.schema[vote].dataType).alias(out))


def cluster_to_group(assigned: DataFrame, cluster: str, cols: Sequence[str], out: str = "accuracy_group") -> DataFrame:
    """clusters ranked by the mean score of their members (mean over ``cols``):
    the best cluster becomes the highest group. The ranking runs over one row
    per cluster (k rows)."""
    row_mean = sum(F.col(f"`{c}`").cast("double") for c in cols) / len(cols)
    means = assigned.groupBy(cluster).agg(F.avg(row_mean).alias("_m"))
    n = Window.orderBy(F.desc("_m"), F.asc(cluster))
    ranked = means.withColumn("_rank", F.row_number().over(n)).withColumn("_k", F.count(F.lit(1)).over(Window.partitionBy()))
    mapping = ranked.select(cluster, (F.col("_k") - F.col("_rank")).cast("int").alias(out))
    return assigned.drop(out).join(F.broadcast(mapping), cluster)


def accuracy(df: DataFrame, prediction: str = "prediction", label: str = "label", keys: Sequence[str] = ()) -> DataFrame:
    """share of rows whose prediction equals the label."""
    hit = F.avg((F.col(prediction).cast("double") == F.col(label).cast("double")).cast("double")).alias("accuracy")
    return df.groupBy(*keys).agg(hit, F.count(F.lit(1)).alias("n")) if keys else df.agg(hit, F.count(F.lit(1)).alias("n"))


def cross_entropy(df: DataFrame, probability: str, label: str = "label", keys: Sequence[str] = ()) -> DataFrame:
    """mean of -log p(true class); ``probability`` is an array (or ML vector) indexed by class."""
    dtype = df.schema[probability].dataType.typeName()
    probs = F.col(probability) if dtype == "array" else _vector_to_array(probability)
    p = F.element_at(probs, F.col(label).cast("int") + 1)
    loss = F.avg(-F.log(p)).alias("cross_entropy")
    return df.groupBy(*keys).agg(loss) if keys else df.agg(loss)


def _vector_to_array(col: str):
    from pyspark.ml.functions import vector_to_array
    return vector_to_array(F.col(col))


def confusion(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """counts per (label, prediction); predicted-class counts follow by summing over label."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))


def last_prediction(preds: DataFrame, key: str, order: Sequence[str], prediction: str = "prediction") -> DataFrame:
    """one prediction per player, the last in ``order``."""
    return last_per_key(preds, [key], list(order), [prediction])
