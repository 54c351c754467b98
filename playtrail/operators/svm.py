"""One-vs-rest linear SVMs on kernel values (F14), all fits in step with each other.

The objective is Spark's ``LinearSVC``: the mean hinge loss of standardised columns
with an intercept. That estimator runs a Spark job for every loss it looks at, some
500 a fit where the loss is flat, and a cross-validation has folds times classes fits.
Here one job looks at several step lengths of every fit: a pass over the rows of
kernel values, in numpy per Arrow batch, returns one sum per task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Step lengths that one pass looks at.
STEPS = (4.0, 1.0, 0.5, 0.2, 0.05, 0.01)
HISTORY = 10
KERNEL_ROWS = 2048


def kernel_values(X: np.ndarray, L: np.ndarray, kernel: str, gamma: float, degree: int = 10, coef0: float = 0.0) -> np.ndarray:
    if kernel == "rbf":
        d2 = (X ** 2).sum(1)[:, None] - 2 * X @ L.T + (L ** 2).sum(1)[None, :]
        return np.exp(-gamma * np.maximum(d2, 0))
    if kernel == "poly":
        return (gamma * X @ L.T + coef0) ** degree
    if kernel == "sigmoid":
        return np.tanh(gamma * X @ L.T + coef0)
    raise ValueError(kernel)


def kernel_rows(df: DataFrame, col: str, marks: list, kernel: str, gammas: list) -> DataFrame:
    """The other columns of ``df`` and ``_k``: the kernel values of a row with the landmarks
    of every set, as packed doubles. The wide rows are read once for all sets."""
    wide = vector_to_array(F.col(col)) if df.schema[col].dataType.typeName() != "array" else F.col(col).cast("array<double>")
    narrow = [f for f in df.schema.fields if f.name != col]
    names = [f.name for f in narrow]
    marks = [np.asarray(L, dtype=float) for L in marks]

    def fn(batches):
        for whole in batches:
            for at in range(0, len(whole), KERNEL_ROWS):
                batch = whole.slice(at, KERNEL_ROWS)
                rows = batch.column(len(names))
                X = rows.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False).reshape(len(batch), -1)
                if set(rows.value_lengths().unique().to_pylist()) != {X.shape[1]}:
                    raise ValueError(f"rows of {col} differ in length")
                K = np.hstack([kernel_values(X, L, kernel, gamma) for L, gamma in zip(marks, gammas)])
                ends = np.arange(len(batch) + 1, dtype=np.int32) * (8 * K.shape[1])
                packed = pa.Array.from_buffers(pa.binary(), len(batch), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(K))])
                yield pa.RecordBatch.from_arrays([*batch.columns[:len(names)], packed], names=[*names, "_k"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow)
    return df.select(*names, wide.alias("_kx")).mapInArrow(fn, f"{schema}, _k binary")


def unpacked(batch, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("_k").to_pylist())).reshape(len(batch), width)


class _Fit:
    """L-BFGS on one fit: ``trial`` names the points to look at, ``seen`` takes their
    losses and gradients."""

    def __init__(self, width: int, tol: float):
        self.x, self.f, self.g = np.zeros(width), None, None
        self.pairs, self.base, self.tol, self.done = [], 1.0, tol, False

    def _direction(self) -> np.ndarray:
        q, kept = self.g.copy(), []
        for s, y in reversed(self.pairs):
            a = s @ q / (s @ y)
            q -= a * y
            kept.append(a)
        if self.pairs:
            s, y = self.pairs[-1]
            q *= (s @ y) / (y @ y)
        else:
            q /= max(np.linalg.norm(self.g), 1e-12)
        for (s, y), a in zip(self.pairs, reversed(kept)):
            q += (a - y @ q / (s @ y)) * s
        return -q

    def trial(self) -> np.ndarray:
        if self.f is None or self.done:
            return np.repeat(self.x[None, :], len(STEPS), axis=0)
        d = self._direction()
        if d @ self.g >= 0:
            self.pairs = []
            d = self._direction()
        return self.x + self.base * np.outer(STEPS, d)

    def seen(self, at: np.ndarray, losses: np.ndarray, grads: np.ndarray) -> None:
        if self.done:
            return
        i = int(np.argmin(losses))
        if self.f is None:
            self.f, self.g = losses[0], grads[0]
            self.done = not self.g.any()
        elif losses[i] < self.f:
            s, y = at[i] - self.x, grads[i] - self.g
            if s @ y > 1e-10 * (y @ y):
                self.pairs = [*self.pairs, (s, y)][-HISTORY:]
            gain = self.f - losses[i]
            self.x, self.f, self.g, self.base = at[i], losses[i], grads[i], 1.0
            self.done = gain <= self.tol * max(abs(self.f), gain) or not self.g.any()
        elif self.base > 1e-3:
            self.base *= 0.01
        elif self.pairs:
            self.pairs, self.base = [], 1.0
        else:
            self.done = True


def _summed(rows: DataFrame, per_batch) -> np.ndarray:
    """The sum of ``per_batch`` over all rows: one array per task reaches the driver."""
    def fn(batches):
        total = None
        for batch in batches:
            if len(batch):
                part = per_batch(batch)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sum"])

    parts = rows.select("fold", "label", "_k").mapInArrow(fn, "sum binary").collect()
    return sum(np.frombuffer(r["sum"]) for r in parts)


class HingeModel:
    """Of each set: the classes, their weights (a column each) and intercepts."""

    def __init__(self, classes: list, weights: list, intercepts: list):
        self.classes, self.weights, self.intercepts = classes, weights, intercepts

    def predicted(self, rows: DataFrame, which: str | None = None) -> DataFrame:
        """``rows`` without ``_k``, with ``prediction``: the class of the greatest margin, by
        the set numbered in column ``which`` (from 1), or the only one."""
        names = [c for c in rows.columns if c != "_k"]
        sizes = [len(w) for w in self.weights]
        starts = np.concatenate([[0], np.cumsum(sizes)])
        classes, weights, intercepts = self.classes, self.weights, self.intercepts

        def fn(batches):
            for batch in batches:
                K = unpacked(batch, int(starts[-1]))
                of = np.asarray(batch.column(which)) if which else np.ones(len(batch), dtype=int)
                out = np.zeros(len(batch))
                for i, w in enumerate(weights):
                    mine = of == i + 1
                    if mine.any():
                        margins = K[mine, starts[i]:starts[i + 1]] @ w + intercepts[i]
                        out[mine] = np.asarray(classes[i])[margins.argmax(1)]
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(out)], names=[*names, "prediction"])

        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "_k")
        return rows.mapInArrow(fn, f"{schema}, prediction double")


def fit_hinge(rows: DataFrame, sizes: list[int], max_iter: int = 50, tol: float = 1e-6) -> HingeModel:
    """One-vs-rest fits of every set on the rows (fold, label, _k) outside its own fold
    (sets are numbered from 1); ``sizes`` are the landmarks of the sets in ``_k``."""
    starts = np.concatenate([[0], np.cumsum(sizes)])
    width, sets = int(starts[-1]), range(len(sizes))
    counts = rows.groupBy("fold", "label").agg(F.count(F.lit(1)).alias("n")).collect()
    classes = [sorted({r["label"] for r in counts if r["fold"] != i + 1}) for i in sets]
    n = [sum(r["n"] for r in counts if r["fold"] != i + 1) for i in sets]
    folds = sorted({r["fold"] for r in counts})

    def moments(batch):
        K, of = unpacked(batch, width), np.asarray(batch.column("fold"))
        return np.concatenate([np.concatenate([K[of == f].sum(0), (K[of == f] ** 2).sum(0)]) for f in folds])

    sums = _summed(rows, moments)
    sums = sums.reshape(len(folds), 2, width)
    mean, inv = [], []
    for i in sets:
        s, ss = sums[[j for j, f in enumerate(folds) if f != i + 1], :, starts[i]:starts[i + 1]].sum(0)
        m = s / max(n[i], 1)
        var = ss / max(n[i], 1) - m ** 2
        mean.append(m)
        inv.append(np.where(var > 1e-14 * np.maximum(m ** 2, 1e-300), 1 / np.sqrt(np.maximum(var, 1e-300)), 0.0))
    fits = [[_Fit(sizes[i] + 1, tol) for _ in classes[i]] for i in sets]

    def plain(i, points):
        """Weights and intercepts for the columns as they are."""
        w = points[:, :-1] * inv[i]
        return w.T, points[:, -1] - w @ mean[i]

    for _ in range(max_iter + 1):
        if all(fit.done for of_set in fits for fit in of_set):
            break
        at = [[fit.trial() for fit in of_set] for of_set in fits]
        open_sets = [i for i in sets if not all(fit.done for fit in fits[i])]
        looked = {i: plain(i, np.concatenate(at[i])) for i in open_sets}

        def losses(batch):
            K, of, label = unpacked(batch, width), np.asarray(batch.column("fold")), np.asarray(batch.column("label"))
            out = []
            for i, (w, b) in looked.items():
                train = of != i + 1
                X = K[train, starts[i]:starts[i + 1]]
                y = np.repeat(np.where(label[train][:, None] == np.asarray(classes[i])[None, :], 1.0, -1.0), len(STEPS), axis=1)
                slack = 1 - y * (X @ w + b)
                pull = np.where(slack > 0, -y, 0.0)
                out += [np.maximum(slack, 0).sum(0), pull.sum(0), (X.T @ pull).ravel()]
            return np.concatenate(out)

        total, taken = _summed(rows, losses), 0
        for i in open_sets:
            cols, m = len(classes[i]) * len(STEPS), sizes[i]
            loss, pull = total[taken:taken + cols] / n[i], total[taken + cols:taken + 2 * cols] / n[i]
            grad = total[taken + 2 * cols:taken + (2 + m) * cols].reshape(m, cols) / n[i]
            taken += (2 + m) * cols
            grad = np.vstack([inv[i][:, None] * (grad - mean[i][:, None] * pull), pull[None, :]]).T
            for j, fit in enumerate(fits[i]):
                own = slice(j * len(STEPS), (j + 1) * len(STEPS))
                fit.seen(at[i][j], loss[own], grad[own])
    ends = [plain(i, np.array([fit.x for fit in fits[i]]).reshape(-1, sizes[i] + 1)) for i in sets]
    return HingeModel(classes, [w for w, _ in ends], [b for _, b in ends])
