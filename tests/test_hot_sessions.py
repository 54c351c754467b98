"""Session features per session, hot sessions spread over tasks, and where the
per-player limit stands in the plan."""

import contextlib
import re

import pytest
from conftest import SF_MID
from pyspark.sql import functions as F
from test_edges import CLICK, LABEL, _t

from playtrail.operators import features as FT
from playtrail.operators import relational as R
from playtrail.operators import sequences as S
from playtrail.plans import ordered as O
from playtrail.schema import EVENT_ORDER, KEY, SESSION
from playtrail.sources.fixtures import Tables


@contextlib.contextmanager
def settings(spark, **conf):
    conf = {f"spark.sql.{k.replace('__', '.')}": v for k, v in conf.items()}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


NO_BROADCAST = {"autoBroadcastJoinThreshold": "-1", "adaptive__autoBroadcastJoinThreshold": "-1"}


def plan_nodes(df):
    """(depth, text) of every operator of the physical plan."""
    text = df._jdf.queryExecution().executedPlan().toString()
    out = []
    for line in text.splitlines():
        m = re.match(r"^([\s:+|-]*)(\S.*)$", line)
        if m:
            out.append((len(m[1]), m[2]))
    return out


def above(nodes, i):
    """Texts of the operators above node ``i``, nearest first."""
    depth, out = nodes[i][0], []
    for d, text in reversed(nodes[:i]):
        if d < depth:
            out.append(text)
            depth = d
    return out


# ---------------------------------------------------------------- A5, J7

def specs(spark):
    return spark.createDataFrame([(6, 1), (5, 2)], "event_action int, event_type int").select(
        (F.col("event_action") - 5).alias("event_id"), "event_type", "event_action")


def session(spark, rows):
    """rows: (session, world, count, spec, time, title)"""
    out = [(1, s, _t(i), n, i, 2000, e, g, title, "Assessment", w) for i, (s, w, n, e, g, title) in enumerate(rows, 1)]
    return spark.createDataFrame(out, CLICK)


def test_session_totals_repeat_on_each_world(spark):
    # spec 1 = action 6, type 1 (game action); spec 0 = action 5, type 2 (round start)
    clicks = session(spark, [("a", "X", 1, 1, 0, "T"), ("a", "X", 2, 0, 10, "T"), ("a", "Y", 3, 1, 40, "T"),
                             ("a", "Y", 4, 0, 100, "T"), ("b", "X", 1, 0, 0, "T")])
    labels = spark.createDataFrame([("a", 1, "T", 1, 0, 1.0, 3), ("b", 1, "T", 0, 0, 0.0, 0)], LABEL)
    rows = {(r[SESSION], r["world"]): r for r in FT.session_features(FT.style1_events(clicks, labels, specs(spark))).collect()}
    assert set(rows) == {("a", "X"), ("a", "Y"), ("b", "X")}
    for w in "XY":      # gaps 10 (game), 30, 60 (game), 0: of the whole session, on both rows
        r = rows["a", w]
        assert (r["total_time"], r["game_action_time"], r["num_rounds"]) == (100, 0.7, 2)
    assert (rows["b", "X"]["total_time"], rows["b", "X"]["game_action_time"], rows["b", "X"]["num_rounds"]) == (0, 0.0, 1)


def test_incomplete_rows_go_before_the_gaps(spark):
    clicks = session(spark, [("a", "X", 1, 1, 0, "T"), ("a", "X", 2, 1, 10, None), ("a", "X", 3, 1, None, "T"),
                             ("a", None, 4, 1, 30, "T"), ("a", "X", 5, 1, 70, "T"), ("c", "X", 1, 1, 5, "T"), ("d", "X", 1, 1, 5, "T")])
    labels = spark.createDataFrame([("a", 1, None, None, None, None, 3), ("c", 1, "T", 1, 0, 1.0, None)], LABEL)
    ev = FT.style1_events(clicks, labels, specs(spark)).collect()
    # rows 2, 3 and 4 have nulls, c has no result, d no label; the gap of row 1 ends at row 5
    assert sorted((r[SESSION], r["event_count"], r["game_time"]) for r in ev) == [("a", 1, 70), ("a", 5, 0)]


def test_history_rows_drop_any_null(spark):
    df = spark.createDataFrame([(1, "w", 3, "t", None), (2, None, 3, "t", 1), (3, "w", None, "t", 1), (4, "w", 3, None, 2)],
                               "src_id int, world string, accuracy_group int, label_title string, group long")
    assert sorted(r.src_id for r in S._history_rows(df).collect()) == [1, 4]


# ---------------------------------------------------------------- hot sessions

def hot_clicks(spark, rows=3000):
    """One session of one player holds a third of all rows."""
    base = spark.range(rows).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 97).alias(KEY), F.col("id"))
    sess = F.when(F.col("id") % 3 == 0, "0-hot").otherwise(F.concat_ws("-", KEY, (F.col("id") % 5).cast("string")))
    out = base.withColumn(SESSION, sess)
    ts = F.timestamp_micros(F.lit(1_700_000_000_000_000) + F.col("id") * 60_000_000).cast("timestamp_ntz")
    return out.select(KEY, SESSION, ts.alias("ts"), (F.col("id") / 2).cast("int").alias("event_count"),
                      F.col("id").alias("src_id"), F.lit(2000).alias("event_code"), (F.col("id") % 2).cast("int").alias("event_id"),
                      (F.col("id") * 7 % 1000).alias("game_time"), F.lit("T").alias("title"),
                      F.lit("Assessment").alias("type"), F.lit("X").alias("world"))


def hot_labels(clicks):
    return clicks.select(SESSION, KEY).distinct().withColumn("title", F.lit("T")).withColumn("num_correct", F.lit(1)).withColumn(
        "num_incorrect", F.lit(0)).withColumn("accuracy", F.lit(1.0)).withColumn("accuracy_group", F.lit(3))


def tasks_of_hot_session(df):
    d = df.where(F.col(SESSION) == "0-hot").groupBy(F.spark_partition_id().alias("p")).count().collect()
    return sorted(r["count"] for r in d)


def test_hot_session_is_spread_and_equal(spark, monkeypatch):
    clicks = hot_clicks(spark)
    labels = hot_labels(clicks)
    plain = FT.session_features(FT.style1_events(clicks, labels, specs(spark)))
    want = sorted(map(tuple, plain.collect()))
    monkeypatch.setattr(R, "POSITION_BUCKET", 100)
    with settings(spark, adaptive__coalescePartitions__enabled="false", **NO_BROADCAST):
        events = FT.style1_events(clicks, labels, specs(spark))
        counts = tasks_of_hot_session(events)
        assert sum(counts) == 1000 and len(counts) >= 5 and max(counts) <= 500, counts
        got = sorted(map(tuple, FT.session_features(FT.style1_events(clicks, labels, specs(spark))).collect()))
    assert got == want and any(r[1] == "X" for r in got)


def test_hot_session_tokens_are_spread_and_equal(spark):
    clicks = hot_clicks(spark)
    labels = hot_labels(clicks)
    want = sorted(map(tuple, S.code_tokens(R.events_with_labels(clicks, labels), [KEY, SESSION]).collect()))
    with settings(spark, adaptive__coalescePartitions__enabled="false", **NO_BROADCAST):
        tokens = S.labelled_tokens(clicks, labels)
        counts = tasks_of_hot_session(tokens)
        got = sorted(map(tuple, tokens.collect()))
    assert got == want
    assert sum(counts) == 1000 and len(counts) >= 5 and max(counts) <= 500, counts


@pytest.mark.parametrize("what", ["style1", "tokens"])
def test_bucketed_windows_stand_on_an_exchange_by_bucket(spark, what):
    """With no broadcast, whatever shuffles events below a bucketed window does so
    by (player, session, bucket), never by the session alone."""
    t = Tables(spark, SF_MID)
    bucket = {"style1": "_range", "tokens": "_tb"}[what]
    with settings(spark, **NO_BROADCAST):
        df = (FT.style1_events(t.clicks, t.labels, t.specs) if what == "style1" else S.labelled_tokens(t.clicks, t.labels))
        nodes = plan_nodes(df)
    checked = 0
    for i, (_, text) in enumerate(nodes):
        if text.startswith("FileScan") and ("game_time" in text or "event_code" in text):
            over = above(nodes, i)
            windows = [x for x in over if x.startswith("Window ") and re.search(r"windowspecdefinition\([^)]*_bkt#\d+L, [^)]* ASC", x)]
            exchange = next(x for x in over if x.startswith("Exchange hashpartitioning"))
            if not windows or "Aggregate" in "".join(over[:over.index(exchange)]):
                continue         # the per-bucket summaries
            window = windows[0]
            assert re.search(rf"{bucket}#|_bkt#", exchange), exchange
            # no second exchange of events between the join and the window
            between = over[over.index(exchange) + 1:over.index(window)]
            assert not any(x.startswith("Exchange") for x in between), between
            checked += 1
    assert checked


# ---------------------------------------------------------------- Z2

def test_last_events_are_limited_before_the_label_joins(spark):
    t = Tables(spark, SF_MID)
    with settings(spark, **NO_BROADCAST):
        rows, _ = S.style2_rows(t.clicks, t.labels, 300, values={c: [] for c in S.MATRIX_CATEGORIES})
        nodes = plan_nodes(rows)
    limits = [i for i, (_, x) in enumerate(nodes) if x.startswith("WindowGroupLimit")]
    assert [re.search("(Partial|Final)", nodes[i][1])[1] for i in limits] == ["Final", "Partial"]
    between = [x for d, x in nodes[limits[0]:limits[1]] if x.startswith("Exchange")]
    assert len(between) == 1 and KEY in between[0]
    joins = [x for x in above(nodes, limits[0]) if "Join" in x]
    assert len(joins) == 2 and "LeftSemi" in joins[0] and "LeftOuter" in joins[1]      # J1, then J9 over it
    below = [x for x in [y for _, y in nodes[limits[1]:]] if "Join" in x]
    assert "LeftAnti" in below[0]                                                      # J2
    # the events that reach J1 and J9 are partitioned by player already
    assert not any(x.startswith("Exchange") for x in above(nodes, limits[0]))


def test_last_events_equal_limit_after_joins(spark):
    from playtrail.operators.labelling import assessment_starts
    t = Tables(spark, SF_MID)
    rows, values = S.style2_rows(t.clicks, t.labels, 7)
    play = R.prior_play(R.labelled_players(t.clicks, t.labels), t.labels)
    late = R.last_events(R.player_last_label(play, assessment_starts(t.clicks, t.labels), order=("start", SESSION)), 7, order=EVENT_ORDER)
    want = sorted((r[KEY], r["rn_desc"], r["accuracy_group"], r["event_count"]) for r in late.collect())
    assert sorted((r[KEY], r["rn_desc"], r["accuracy_group"], int(r["row"][0])) for r in rows.collect()) == want
