"""Models (F7, F10-F14, F16-F18, F23, F25, F26) on Spark ML.

Estimators run distributed in Spark ML. The deep nets of the reference are
re-aimed (see README): the dense net is a multilayer perceptron, the LSTM a
code n-gram + multinomial logistic model, Ward clustering a weighted k-means
on distinct profiles, kernel SVMs are landmark kernel features + linear SVM.
kNN (F12) is in ``knn``, the forest of narrow rows (F13) in ``forest``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import (LogisticRegression, MultilayerPerceptronClassifier, OneVsRest,
                                       RandomForestClassifier)
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import CountVectorizer, NGram, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playtrail.functions.scalar import hash_fraction
from playtrail.operators import svm
from playtrail.operators.forest import Forest
from playtrail.operators.knn import knn_vote  # noqa: F401  (F12)
from playtrail.session import materialize

LABEL = "label"
FEATURES = "features"


# ---------------------------------------------------------------- features in

def assemble(df: DataFrame, cols: Sequence[str], out: str = FEATURES) -> DataFrame:
    """named feature columns into one vector."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


def array_features(df: DataFrame, col: str, out: str = FEATURES) -> DataFrame:
    """An array column (padded ids, flat matrix) as an ML vector."""
    return df.withColumn(out, array_to_vector(F.transform(col, lambda x: x.cast("double"))))


def category_codes(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """codes 0, 1, ... in value order (``pd.Categorical`` codes)."""
    idx = StringIndexer(inputCol=col, outputCol=out or f"{col}_code", stringOrderType="alphabetAsc")
    return idx.fit(df).transform(df)


def with_label(df: DataFrame, col: str = "accuracy_group") -> DataFrame:
    return df.withColumn(LABEL, F.col(col).cast("double"))


# ---------------------------------------------------------------- classifiers

def logistic_ovr(max_iter: int = 100):
    """one-vs-rest logistic regression."""
    return OneVsRest(classifier=LogisticRegression(maxIter=max_iter), labelCol=LABEL, featuresCol=FEATURES,
                     parallelism=4)


def logistic_multinomial(max_iter: int = 100):
    """F11."""
    return LogisticRegression(family="multinomial", maxIter=max_iter, labelCol=LABEL, featuresCol=FEATURES)


def random_forest(trees: int = 100, seed: int = 1, depth: int = 30, bins: int = 256):
    """F13. The reference grows full trees with a threshold between any two values;
    Spark ends at depth 30 and takes at most ``bins`` thresholds of a column."""
    return RandomForestClassifier(numTrees=trees, seed=seed, maxDepth=depth, maxBins=bins, labelCol=LABEL, featuresCol=FEATURES)


def narrow_forest(trees: int = 100, seed: int = 1, depth: int = 30, bins: int = 256) -> Forest:
    """F13 with the same depth and thresholds: small nodes are grown from their rows (see
    ``forest``). Spark's forest sums a table of columns, bins and classes per node and
    task, which full trees fill with empty cells, and holds all trees in the driver."""
    return Forest(trees, seed, depth, bins, label=LABEL, features=FEATURES)


def mlp(n_features: int, hidden: Sequence[int] = (30, 30), classes: int = 4, seed: int = 1, max_iter: int = 100):
    """F16: dense net, two hidden layers of 30, softmax over the classes."""
    return MultilayerPerceptronClassifier(layers=[n_features, *hidden, classes], seed=seed, maxIter=max_iter,
                                          labelCol=LABEL, featuresCol=FEATURES)


def sequence_classifier(n: int = 2, ids: int = 199, max_iter: int = 100):
    """F17 (re-aimed LSTM): unigram + n-gram counts of the id sequence into a
    multinomial logistic model. Input column ``tokens`` (array<string>). The
    vocabularies have room for every id and every n-gram of ids: nothing is cut."""
    grams = NGram(n=n, inputCol="tokens", outputCol="_grams")
    cv1 = CountVectorizer(inputCol="tokens", outputCol="_uni", vocabSize=ids)
    cv2 = CountVectorizer(inputCol="_grams", outputCol="_bi", vocabSize=ids ** n)
    asm = VectorAssembler(inputCols=["_uni", "_bi"], outputCol=FEATURES)
    lr = LogisticRegression(family="multinomial", maxIter=max_iter, labelCol=LABEL, featuresCol=FEATURES)
    return Pipeline(stages=[grams, cv1, cv2, asm, lr])


def sequence_tokens(df: DataFrame, col: str = "sequence") -> DataFrame:
    """Padded ids to tokens for F17 (pads dropped)."""
    return df.withColumn("tokens", F.transform(F.filter(col, lambda x: x > 0), lambda x: x.cast("string")))


# ---------------------------------------------------------------- kernel SVM

def pick_landmarks(train: DataFrame, key: str, col: str, m: int = 64, seed: int = 7) -> np.ndarray:
    """``m`` training rows chosen by a repeatable hash: the kernel basis."""
    rows = (train.select(key, col, hash_fraction(key, seed).alias("_h")).orderBy("_h", key)
            .limit(m).select(col).collect())
    return np.array([np.asarray(r[0].toArray() if hasattr(r[0], "toArray") else r[0], dtype=float) for r in rows])


def _values(df: DataFrame, col: str):
    return F.col(col) if df.schema[col].dataType.typeName() == "array" else vector_to_array(F.col(col))


def auto_gamma(train: DataFrame, col: str) -> float:
    """The 'auto' rule for gamma: 1 / number of features."""
    return 1.0 / (train.agg(F.max(F.size(_values(train, col)))).first()[0] or 1)


def scale_gamma(train: DataFrame, col: str) -> float:
    """The 'scale' rule for gamma: 1 / (number of features * variance of all feature
    values). Each row gives its count, sum and sum of squares: one narrow aggregate,
    no row per value."""
    arr = _values(train, col)
    total = lambda f: F.sum(F.aggregate(arr, F.lit(0.0), lambda acc, v: acc + f(v)))
    r = train.agg(F.max(F.size(arr)).alias("width"), F.sum(F.size(arr)).alias("n"), total(lambda v: v).alias("s"),
                  total(lambda v: v * v).alias("ss")).first()
    if not r["n"]:
        return 1.0
    var = r["ss"] / r["n"] - (r["s"] / r["n"]) ** 2
    return 1.0 / (r["width"] * var) if var > 0 else 1.0


def fold_landmarks(df: DataFrame, key: str, col: str, fold: str, k: int, m: int = 64, seed: int = 7) -> list[np.ndarray]:
    """The landmarks of :func:`pick_landmarks` for the train part of every fold. The first
    ``m`` rows outside a fold are among the first ``m`` of the other folds, which are
    found on the keys alone; the wide rows are read once."""
    narrow = df.select(F.col(key), F.col(fold), hash_fraction(key, seed).alias("_h"))
    first = narrow.withColumn("_r", F.row_number().over(Window.partitionBy(fold).orderBy("_h", key))).where(F.col("_r") <= m)
    rows = df.select(key, col).join(F.broadcast(first.drop("_r")), key).select(key, fold, "_h", col).collect()
    rows = sorted(rows, key=lambda r: (r["_h"], r[key]))
    values = lambda v: np.asarray(v.toArray() if hasattr(v, "toArray") else v, dtype=float)
    return [np.array([values(r[col]) for r in [r for r in rows if r[fold] != i][:m]]) for i in range(1, k + 1)]


class KernelSVM:
    """F14 as an estimator: landmarks are rows of the train part it is fitted on, and
    the rows to score get the same kernel values; the classifier on them is a
    one-vs-rest linear SVM (see ``svm``). ``gamma`` is a number, ``auto`` or ``scale``."""

    def __init__(self, key: str, kernel: str = "rbf", gamma: float | str = "auto", landmarks: int = 64, max_iter: int = 50):
        self.key, self.kernel, self.gamma, self.landmarks, self.max_iter = key, kernel, gamma, landmarks, max_iter

    def fit(self, train: DataFrame) -> KernelSVMModel:
        rules = {"auto": auto_gamma, "scale": scale_gamma}
        gamma = rules[self.gamma](train, FEATURES) if isinstance(self.gamma, str) else self.gamma
        marks = pick_landmarks(train, self.key, FEATURES, self.landmarks)
        rows = train.select(F.lit(0).alias("fold"), LABEL, FEATURES)
        made = materialize(svm.kernel_rows(rows, FEATURES, [marks], self.kernel, [gamma]), "kernel-values")
        return KernelSVMModel(marks, self.kernel, gamma, svm.fit_hinge(made, [len(marks)], self.max_iter))

    def score_folds(self, df: DataFrame, fold: str, k: int, keep: Sequence[str]) -> DataFrame:
        """:func:`kfold_evaluate` with the kernel values of all folds from one pass over
        the wide rows, and their classifiers fitted together."""
        marks = fold_landmarks(df, self.key, FEATURES, fold, k, self.landmarks)
        if self.gamma == "scale":
            gammas = [scale_gamma(df.where(F.col(fold) != i), FEATURES) for i in range(1, k + 1)]
        else:       # kernel values need rows of one width, so a landmark tells it
            gammas = [1.0 / max(L.shape[-1], 1) if self.gamma == "auto" else self.gamma for L in marks]
        rows = df.select(*keep, F.col(fold).alias("fold"), LABEL, FEATURES)
        made = materialize(svm.kernel_rows(rows, FEATURES, marks, self.kernel, gammas), "kernel-values")
        model = svm.fit_hinge(made, [len(L) for L in marks], self.max_iter)
        return model.predicted(made, "fold").withColumnRenamed("fold", fold).select(*keep, LABEL, "prediction", fold)


class KernelSVMModel:
    def __init__(self, marks: np.ndarray, kernel: str, gamma: float, model: svm.HingeModel):
        self.marks, self.kernel, self.gamma, self.model = marks, kernel, gamma, model

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.predicted(svm.kernel_rows(df, FEATURES, [self.marks], self.kernel, [self.gamma]))


# ---------------------------------------------------------------- clustering

def cluster_profiles(profiles: DataFrame, cols: Sequence[str], k: int = 4, seed: int = 1,
                     out: str = "cluster") -> tuple[DataFrame, object]:
    """F18 (re-aimed Ward): weighted k-means on the distinct profiles (a profile
    of five scores in 0..3 has few distinct values), then every player gets the
    cluster of its profile. Returns (assignments, model)."""
    quoted = [f"`{c}`" for c in cols]
    distinct = profiles.groupBy(*quoted).agg(F.count(F.lit(1)).cast("double").alias("_w"))
    vec = VectorAssembler(inputCols=list(cols), outputCol=FEATURES)
    km = KMeans(k=k, seed=seed, weightCol="_w", featuresCol=FEATURES, predictionCol=out)
    model = km.fit(vec.transform(distinct))
    assigned = model.transform(vec.transform(profiles)).drop(FEATURES)
    return assigned, model


# ---------------------------------------------------------------- evaluation loops

def fit_predict(estimator, train: DataFrame, test: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """fit on train, score test, keep keys, label and prediction."""
    scored = estimator.fit(train).transform(test)
    cols = [*keep, LABEL, "prediction", "probability"]
    return scored.select(*[c for c in cols if c in scored.columns])


def kfold_evaluate(df: DataFrame, make_estimator: Callable[[], object], fold: str = "fold", k: int = 5,
                   keep: Sequence[str] = (), parallelism: int = 5) -> DataFrame:
    """fit on k-1 folds, score the held-out fold, for each fold; the
    predictions of all folds, tagged with their fold. The fits are independent
    and run as concurrent Spark jobs (as ``CrossValidator(parallelism=...)``), or in one
    way where the estimator has one (``score_folds``)."""
    from multiprocessing.pool import ThreadPool

    from pyspark.util import inheritable_thread_target

    if hasattr(together := make_estimator(), "score_folds"):
        return together.score_folds(df, fold, k, keep)

    def one(i: int) -> DataFrame:
        train, test = df.where(F.col(fold) != i), df.where(F.col(fold) == i)
        return fit_predict(make_estimator(), train, test, keep).withColumn(fold, F.lit(i))

    pool = ThreadPool(processes=max(1, min(parallelism, k)))
    try:
        parts = pool.map(inheritable_thread_target(df.sparkSession)(one), range(1, k + 1))
    finally:
        pool.close()
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
