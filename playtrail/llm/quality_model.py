"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics come from the whole text of each document. The trees are fitted on
at most ``TRAIN_ROWS`` labelled rows (a documented bound; the rows are the
smallest by key hash), with features cut into quantile bins and gradient
histograms per node. Each tree is complete and flattened into arrays, so a
batch of documents walks all trees with a few numpy operations per level.

Labels only come from rows with crc32(key as text) mod 5 other than 0; the key,
the labels, lang and source are never features.

Defined results: a null or empty text is scored by its all-zero statistics;
repeated rows get equal scores; rows without a label (or a null one) are scored
like all others; without any usable label, or with labels of one class only,
every score is the share of label 1 (0.5 without labels); an empty table gives
no rows; a null key counts as held out: false; other columns are not carried.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtrail.llm.common import whole_text
from playtrail.llm.quality_rules import STOP_WORDS
from playtrail.session import materialize

TRAIN_ROWS = 20_000
TREES, DEPTH, BINS, RATE, L2, MIN_ROWS = 60, 4, 64, 0.15, 1.0, 20
FEATURES = ("log_words", "word_bytes", "symbols", "stops", "distinct", "distinct_triples", "upper", "digits", "marks",
            "non_ascii", "lines", "dup_lines", "words_per_line", "longest_word", "top_word", "open_ended")
_STOPS = frozenset(w.encode() for t in STOP_WORDS.values() for w in t.split())
_KINDS = {"symbols": b"#*$%&|<>", "upper": bytes(range(65, 91)), "digits": b"0123456789",
          "marks": b".,;:!?", "non_ascii": bytes(range(128, 256))}


def statistics(text: bytes) -> list[float]:
    """The features of one UTF-8 text, in the order of ``FEATURES``."""
    w = text.lower().split()
    if not w:
        return [0.0] * len(FEATURES)
    n, size = len(w), len(text)
    counts: dict[bytes, int] = {}
    for x in w:
        counts[x] = counts.get(x, 0) + 1
    lines = [x for x in text.split(b"\n") if x.strip()]
    triples = max(1, n - 2)
    kinds = {k: (size - len(text.translate(None, chars))) / size for k, chars in _KINDS.items()}
    return [math.log1p(n), sum(map(len, w)) / n, kinds["symbols"], sum(c for x, c in counts.items() if x in _STOPS) / n,
            len(counts) / n, len(set(zip(w, w[1:], w[2:]))) / triples, kinds["upper"], kinds["digits"], kinds["marks"],
            kinds["non_ascii"], math.log1p(len(lines)), 1 - len(set(lines)) / len(lines), n / len(lines),
            math.log1p(max(map(len, counts))), max(counts.values()) / n,
            sum(not x.rstrip().endswith((b".", b"!", b"?")) for x in lines) / len(lines)]


@dataclass(frozen=True)
class Model:
    """``base + sum of leaves`` in log odds. ``feature`` and ``cut`` hold the inner
    nodes of each complete tree level by level, ``leaf`` its leaves."""
    base: float
    feature: np.ndarray   # trees x (2 ** depth - 1), int
    cut: np.ndarray       # the same shape; a row goes right if its value is above
    leaf: np.ndarray      # trees x 2 ** depth

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        depth = int(math.log2(self.leaf.shape[1])) if len(self.leaf) else 0
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += leaf[node - (len(feature))]
        return 1 / (1 + np.exp(-np.clip(total, -60, 60)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS,
        rate: float = RATE, l2: float = L2, min_rows: int = MIN_ROWS) -> Model:
    """Fit by second-order boosting of the logistic loss over binned features."""
    share = float(y.mean()) if len(y) else 0.5
    none = np.zeros((0, 2 ** depth))
    if not len(y) or not 0 < share < 1:
        return Model(math.copysign(60, share - 0.5) if len(y) else 0.0, none[:, 1:].astype(int), none[:, 1:], none)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    code = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    base = math.log(share / (1 - share))
    total = np.full(len(y), base)
    inner = 2 ** depth - 1
    features, limits, leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        grad, hess = p - y, p * (1 - p)
        feature, limit = np.zeros(inner, int), np.full(inner, np.inf)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            best = np.zeros(width)
            for f, c in enumerate(cuts):
                if not len(c):
                    continue
                place = (node - first) * bins + code[:, f]
                g, h, n = (np.bincount(place, v, width * bins).reshape(width, bins).cumsum(axis=1) for v in (grad, hess, None))
                gain = (g ** 2 / (h + l2) + (g[:, -1:] - g) ** 2 / (h[:, -1:] - h + l2) - g[:, -1:] ** 2 / (h[:, -1:] + l2))
                gain[(n < min_rows) | (n[:, -1:] - n < min_rows)] = 0
                at = gain[:, :len(c)].argmax(axis=1)
                for k in np.nonzero(gain[np.arange(width), at] > best + 1e-9)[0]:
                    best[k], feature[first + k], limit[first + k] = gain[k, at[k]], f, c[at[k]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > limit[node])
        place = node - inner
        leaf = -rate * np.bincount(place, grad, inner + 1) / (np.bincount(place, hess, inner + 1) + l2)
        total += leaf[place]
        features.append(feature), limits.append(limit), leaves.append(leaf)
    return Model(base, np.array(features), np.array(limits), np.array(leaves))


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays(
            [b.column("label"), pa.array([statistics(t) for t in b.column("t").cast(pa.binary()).to_pylist()],
                                         pa.list_(pa.float64()))], ["label", "x"])


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", most: int = TRAIN_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of at most ``most`` labelled rows that are not held out."""
    usable = labels.select(F.col(id_col).alias("k"), F.col(label_col).cast("double").alias("label")).where(
        "k is not null and label is not null").where(~held_out(F.col("k")))
    chosen = materialize(usable.orderBy(F.xxhash64("k"), "k", "label").limit(most), "training-labels")
    rows = (docs.select(F.col(id_col).alias("k"), whole_text(text_col).alias("t"))
            .join(F.broadcast(chosen), "k").select("label", "t")
            .mapInArrow(_statistics, "label double, x array<double>").limit(2 * most).toPandas())  # short rows
    x = np.array(rows["x"].tolist(), dtype=float).reshape(len(rows), len(FEATURES))
    y = (rows["label"].to_numpy() > 0).astype(float)
    order = np.lexsort((*x.T[::-1], y))   # the fit does not depend on the order of tasks
    return x[order], y[order]


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [statistics(t) for t in b.column("t").cast(pa.binary()).to_pylist()]
            score = model.score(np.array(x, dtype=float).reshape(len(x), len(FEATURES)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(score)],
                                             ["doc_id", "held_out", "score"])
    return run


def score_quality(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
                  cut: float = 0.3) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row."""
    df = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), whole_text(text_col).alias("t"))
    key = df.schema["doc_id"].dataType.simpleString()
    out = df.mapInArrow(_score(model), f"doc_id {key}, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= cut).cast("int"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on the labels that are not held out and score every document."""
    return score_quality(docs, fit(*training_rows(docs, labels)))
