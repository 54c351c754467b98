"""Forward labelling of play history (J10), assessment groups (W6) and the
labelled event table of styles 4 and 5 (Z5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtrail.operators.relational import labelled_players, left_labels, session_starts
from playtrail.plans.ordered import HOUR_US, asof_next, global_row_number
from playtrail.schema import KEY, LABEL_COLS, SESSION
from playtrail.session import materialize

GROUP = "group"


def assessment_starts(clicks: DataFrame, labels: DataFrame) -> DataFrame:
    """Labels with the start time (first event, W4) of their session. Labels
    whose session has no events are dropped."""
    sess = clicks.join(labels.select(KEY, SESSION), [KEY, SESSION], "left_semi")
    return labels.join(session_starts(sess), [KEY, SESSION], "inner")


def assessment_groups(starts: DataFrame, order: Sequence[str] = ("start", KEY, SESSION)) -> DataFrame:
    """Number the assessments 1, 2, ... by start time over all players
    (null means "no group"; the reference's 0 doubled as both). The global
    rank is computed without a single-task window (see ``global_row_number``)."""
    return global_row_number(starts, list(order), GROUP).withColumn(GROUP, F.col(GROUP).cast("long"))


def label_by_next(clicks: DataFrame, labels: DataFrame, with_groups: bool = True,
                  include_assessment: bool = False, width_us: int = HOUR_US) -> DataFrame:
    """J10 (+ J1, J8, W6): events of labelled players; every event without a
    label of its own takes the result of its player's earliest assessment
    that starts strictly later (ties in start: smaller session id). Events
    after a player's last assessment stay unlabelled.

    Adds ``label_title`` (own label only), the label columns and ``group``:
    the assessment group of filled rows; assessment rows get their own group
    only with ``include_assessment``.
    """
    players = labelled_players(clicks, labels)
    events = left_labels(players, labels)
    marks = assessment_starts(clicks, labels)
    if with_groups:
        marks = assessment_groups(marks)
    else:
        marks = marks.withColumn(GROUP, F.lit(None).cast("long"))
    packed = F.struct(F.col("start").alias("start"), F.col(SESSION).alias("session"),
                      F.col(GROUP).alias(GROUP), *[F.col(c).alias(c) for c in LABEL_COLS])
    markers = marks.select(KEY, F.col("start").alias("ts"), packed.alias("_mark"))
    out = asof_next(events, markers, KEY, "ts", "_mark", "_next", width_us,
                    event_times=players.select(KEY, "ts"))
    own_label = F.col("accuracy_group").isNotNull()
    fills = {c: F.when(own_label, F.col(c)).otherwise(F.col("_next")[c]) for c in LABEL_COLS}
    if include_assessment:
        own_group = marks.select(KEY, SESSION, F.col(GROUP).alias("_own_group"))
        out = out.join(own_group, [KEY, SESSION], "left")
        fills[GROUP] = F.when(own_label, F.col("_own_group")).otherwise(F.col("_next")[GROUP])
    else:
        fills[GROUP] = F.when(own_label, F.lit(None)).otherwise(F.col("_next")[GROUP])
    out = out.withColumns(fills).drop("_next", "_own_group")
    return out


def label_history(clicks: DataFrame, labels: DataFrame, materialized: bool = True, **kw) -> DataFrame:
    """The labelled and grouped event table. The reference saves it between
    scripts; here it is written to the checkpoint folder once and reused."""
    out = label_by_next(clicks, labels, **kw)
    return materialize(out) if materialized else out
