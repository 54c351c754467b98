"""Session features (A1-A6), score profiles (A12, A13) and feature
preparation (F1-F6, F8, F9, F25, F26).

Estimators follow a fit/apply split: ``fit_*`` computes a few numbers with one
aggregate (a bounded result: one value per column or per category), and the
returned model applies them as literals, so train statistics carry to test.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playtrail.functions.scalar import hash_fraction, round_half_even, safe_divide
from playtrail.operators.relational import (complete_labelled_events, drop_codes, drop_idle, first_per_key,
                                            position_bucket, time_to_next, with_specs)
from playtrail.schema import (ASSESSMENT_TITLES, CLASS_WEIGHTS, COUNT_FEATURES, HOLDOUT_SHARE, KEY,
                              SESSION, THIN_CLASS, THIN_SHARE, TIME_FEATURES)

FEATURE_KEYS = [SESSION, "world", KEY, "accuracy_group"]
SHARE_COLS = [n for n, _, _ in TIME_FEATURES]
FEATURE_COLS = ["total_time", *SHARE_COLS] + [n for n, _, _ in COUNT_FEATURES]


def _pair(action: int, etype: int) -> Column:
    return (F.col("event_action") == action) & (F.col("event_type") == etype)


def style1_events(clicks: DataFrame, labels: DataFrame, specs: DataFrame, train: bool = True) -> DataFrame:
    """Events ready for session features: complete rows of labelled sessions (J1,
    J7, P6), specs (J6), time to the next event (W1) with idle gaps dropped (P8),
    and on the train side attempt codes removed (P11) after the gaps are taken.
    A session's events are spread by ranges of positions from the label join on."""
    d = clicks.withColumn("_range", position_bucket())
    if train:
        d = complete_labelled_events(d, labels, ["accuracy_group"], "_range").drop("ts")
    d = time_to_next(with_specs(d.drop("title", "type"), specs), bucket="_range").drop("_range")
    d = drop_idle(d)
    return drop_codes(d) if train else d


def total_time() -> Column:
    """A1."""
    return F.sum("game_time").alias("total_time")


def conditional_times() -> list[Column]:
    """A2: time spent per (action, type) pair; null where a key has no such event."""
    return [F.sum(F.when(_pair(a, t), F.col("game_time"))).alias(name) for name, a, t in TIME_FEATURES]


def conditional_counts() -> list[Column]:
    """A4."""
    return [F.count_if(_pair(a, t)).alias(name) for name, a, t in COUNT_FEATURES]


def time_share(name: str, total: str = "total_time") -> Column:
    """A3: a time as a share of the session's total; 0 when the session has no time (0/0)."""
    return F.coalesce(safe_divide(F.col(name), F.col(total)), F.lit(0.0))


def session_features(events: DataFrame, keys: Sequence[str] = FEATURE_KEYS, session: str = SESSION) -> DataFrame:
    """A5: one row per distinct ``keys`` (session, world, player, result), each with
    all fourteen features of its whole *session*.

    Two levels: one aggregate per ``keys`` (partial on the map side, so a huge
    session costs one row per map task and world), then the session's totals over
    those few rows, aligned to each of them by the session key (J11: a key without
    a value keeps 0). A session that spans two worlds gives two rows with equal
    features."""
    parts = events.groupBy(*keys).agg(total_time(), *conditional_times(), *conditional_counts())
    whole = Window.partitionBy(session)
    totals = parts.withColumns({c: F.sum(c).over(whole) for c in FEATURE_COLS})
    zeros = {c: F.coalesce(F.col(c), F.lit(0)) for c in FEATURE_COLS if c not in SHARE_COLS}
    return totals.withColumns({**zeros, **{c: time_share(c) for c in SHARE_COLS}})


def mean_label(df: DataFrame, keys: Sequence[str], col: str = "accuracy_group", mixed: str = "mean") -> DataFrame:
    """One label per key; ``mixed='last'`` takes the label of the key's last row
    instead of a (possibly fractional) mean."""
    if mixed == "mean":
        return df.groupBy(*keys).agg(F.avg(col).alias(col))
    return df.groupBy(*keys).agg(F.max_by(col, F.struct("ts", "event_count", "src_id")).alias(col))


def rounded_mean(labels: DataFrame, col: str = "accuracy_group") -> DataFrame:
    """Per player mean, rounded half to even."""
    return labels.groupBy(KEY).agg(round_half_even(F.avg(col)).alias(col))


def score_profile(labels: DataFrame, titles: Sequence[str] = ASSESSMENT_TITLES,
                  order: Sequence[str] = ("start", SESSION), col: str = "accuracy_group") -> DataFrame:
    """Per player, the first result on each assessment title (null if never
    played) next to the rounded mean result (A12). The pivot values are given,
    so no pass over the data collects them."""
    # One row per player and title, found by hashing; the pivot then has one score to take.
    first = first_per_key(labels.where(F.col("title").isin(*titles)), [KEY, "title"], list(order), [col])
    wide = first.groupBy(KEY).pivot("title", list(titles)).agg(F.max(col))
    # Players without any of the titles have a mean and no score.
    return rounded_mean(labels, col).join(wide, KEY, "left").select(KEY, *[F.col(f"`{t}`") for t in titles], col)


# ---------------------------------------------------------------- F: preparation

def fit_values(df: DataFrame, col: str) -> list:
    """Sorted distinct values of a category column (bounded by its cardinality)."""
    return fit_values_of(df, [col])[col]


def fit_values_of(df: DataFrame, cols: Sequence[str]) -> dict[str, list]:
    """Sorted distinct non-null values of several category columns in one pass:
    one partial ``collect_set`` per column, each bounded by that column's
    cardinality (code-book columns: event codes, titles, types, worlds)."""
    row = df.agg(*[F.array_sort(F.collect_set(c)).alias(c) for c in cols]).first()
    return {c: list(row[c] or []) for c in cols}


def dummies(df: DataFrame, col: str, values: Sequence, prefix: str | None = None, drop: bool = True) -> DataFrame:
    """one 0/1 column per value, named ``prefix_value``."""
    p = prefix or col
    out = df.withColumns({f"{p}_{v}": F.when(F.col(col) == F.lit(v), 1).otherwise(0) for v in values})
    return out.drop(col) if drop else out


def label_onehot(df: DataFrame, col: str = "accuracy_group", classes: Sequence[int] = (0, 1, 2, 3)) -> DataFrame:
    """F2."""
    return dummies(df, col, classes, drop=False)


@dataclass
class Standardizer:
    """``(x - mean) / std`` with population std; zero std scales by 1."""
    stats: dict

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str]) -> Standardizer:
        row = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols],
                     *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
        return cls({c: (row[f"m_{c}"] or 0.0, row[f"s_{c}"] or 0.0) for c in cols})

    def transform(self, df: DataFrame, prefix: str = "") -> DataFrame:
        return df.withColumns({prefix + c: (F.col(c) - F.lit(m)) / F.lit(s if s else 1.0)
                               for c, (m, s) in self.stats.items()})


def mean_normalize(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """``(x - mean) / (max - min)`` with statistics from one aggregate."""
    m, hi, lo = df.agg(F.avg(col), F.max(col), F.min(col)).first()
    return df.withColumn(out or col, safe_divide(F.col(col) - F.lit(m), F.lit((hi - lo) if hi is not None else None)))


def fit_profile_fill(profile: DataFrame, titles: Sequence[str] = ASSESSMENT_TITLES) -> dict:
    """F5 fit: the rounded (half to even) mean of each title column."""
    row = profile.agg(*[round_half_even(F.avg(F.col(f"`{t}`"))).alias(f"c{i}") for i, t in enumerate(titles)]).first()
    return {t: row[f"c{i}"] for i, t in enumerate(titles)}


def fill_profile(profile: DataFrame, fills: dict) -> DataFrame:
    """F5 apply: missing title scores take the fitted rounded mean."""
    return profile.withColumns({t: F.coalesce(F.col(f"`{t}`").cast("double"), F.lit(v).cast("double"))
                                for t, v in fills.items()})


def split(df: DataFrame, key: str, share: float = HOLDOUT_SHARE, seed: int = 1,
          name: str = "split") -> DataFrame:
    """repeatable hold-out: a row is ``test`` when the hash of its key falls
    below ``share``. Independent of partitioning and row order."""
    return df.withColumn(name, F.when(hash_fraction(key, seed) < share, "test").otherwise("train"))


def class_weights(df: DataFrame, col: str = "accuracy_group", weights: Sequence[float] = CLASS_WEIGHTS,
                  name: str = "weight") -> DataFrame:
    """F8."""
    w = F.lit(None).cast("double")
    for cls, v in reversed(list(enumerate(weights))):
        w = F.when(F.col(col) == cls, F.lit(float(v))).otherwise(w)
    return df.withColumn(name, w)


def thin_class(df: DataFrame, key: str, cls: int = THIN_CLASS, share: float = THIN_SHARE, seed: int = 0,
               col: str = "accuracy_group") -> DataFrame:
    """drop a repeatable ``share`` of the rows of one class (hash of the key)."""
    return df.where(~((F.col(col) == cls) & (hash_fraction(key, seed) < share)))


def style1_features(clicks: DataFrame, labels: DataFrame, specs: DataFrame, seed: int = 0,
                    worlds: Sequence[str] | None = None) -> DataFrame:
    """Balanced, one-hot session features of labelled assessment sessions."""
    feats = session_features(style1_events(clicks, labels, specs))
    feats = thin_class(feats, SESSION, seed=seed)
    values = list(worlds) if worlds is not None else fit_values(feats, "world")
    return dummies(feats, "world", values)
