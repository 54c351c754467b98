"""Hand-made edge tables (10-20 rows each)."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playtrail.operators import features as FT
from playtrail.operators import labelling as L
from playtrail.operators import models as M
from playtrail.operators import relational as R
from playtrail.operators import scoring as SC
from playtrail.operators import sequences as S

CLICK = T.StructType([
    T.StructField("installation_id", T.LongType()), T.StructField("game_session", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()), T.StructField("event_count", T.IntegerType()),
    T.StructField("src_id", T.LongType()), T.StructField("event_code", T.IntegerType()),
    T.StructField("event_id", T.IntegerType()), T.StructField("game_time", T.LongType()),
    T.StructField("title", T.StringType()), T.StructField("type", T.StringType()),
    T.StructField("world", T.StringType())])
LABEL = T.StructType([
    T.StructField("game_session", T.StringType()), T.StructField("installation_id", T.LongType()),
    T.StructField("title", T.StringType()), T.StructField("num_correct", T.IntegerType()),
    T.StructField("num_incorrect", T.IntegerType()), T.StructField("accuracy", T.DoubleType()),
    T.StructField("accuracy_group", T.IntegerType())])
T0 = dt.datetime(2024, 1, 1)


def _t(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def _click(spark, rows):
    out, src = [], 0
    for inst, sess, minute, count, code, gtime in rows:
        src += 1
        out.append((inst, sess, _t(minute), count, src, code, 1, gtime, "T", "Game", "W"))
    return spark.createDataFrame(out, CLICK)


def test_label_by_next_edges(spark):
    clicks = _click(spark, [
        (1, "a", 0, 1, 2000, 0),      # before both assessments -> earliest later one
        (1, "a", 10, 2, 2000, 5),     # exactly at the start of x/y -> not theirs, none later -> null
        (1, "x", 10, 1, 2000, 0),     # assessment x starts at 10
        (1, "y", 10, 1, 2000, 0),     # assessment y starts at 10 too (tie: smaller session wins)
        (1, "b", 5, 1, 2000, 0),
        (2, "c", 0, 1, 2000, 0),      # player without label: dropped
    ])
    labels = spark.createDataFrame([("x", 1, "T", 1, 0, 1.0, 3), ("y", 1, "T", 1, 1, 0.5, 2)], LABEL)
    out = {r["src_id"]: (r["accuracy_group"], r["group"]) for r in L.label_by_next(clicks, labels).collect()}
    assert set(out) == {1, 2, 3, 4, 5}
    assert out[1] == (3, 1)            # tie on start -> session "x" (group 1)
    assert out[2] == (None, None)      # event at the start instant
    assert out[5] == (3, 1)
    assert out[3] == (3, None) and out[4] == (2, None)   # assessment rows keep their own label


def test_time_to_next_single_event_and_share_zero(spark, ):
    clicks = _click(spark, [(1, "s", 0, 1, 2000, 7), (1, "t", 0, 1, 2000, 0), (1, "t", 1, 2, 2000, 0)])
    gaps = {r["src_id"]: r["gap"] for r in R.time_to_next(clicks, out="gap").collect()}
    assert gaps == {1: 0, 2: 0, 3: 0}
    ev = R.time_to_next(clicks).withColumn("event_action", F.lit(6)).withColumn("event_type", F.lit(1)).withColumn(
        "accuracy_group", F.lit(1))
    feats = {r["game_session"]: r for r in FT.session_features(ev).collect()}
    assert feats["t"]["total_time"] == 0 and feats["t"]["game_action_time"] == 0.0


def _seq_rows(spark, lengths):
    rows = []
    for i, n in enumerate(lengths):
        for j in range(n):
            rows.append((i, f"s{i}", j, j + 1, 2000 + (j % 3), 0))
    return _click(spark, rows)


def test_length_filter_and_padding(spark):
    clicks = _seq_rows(spark, [10, 11, 399, 400, 401])
    keys = ["installation_id", "game_session"]
    tokens = S.code_tokens(clicks, keys)
    lengths = {r[0]: r[2] for r in R.min_length(S.sequence_lengths(tokens, keys), "n_codes", 10).collect()}
    assert set(lengths) == {1, 2, 3, 4}
    vocab = S.fit_vocabulary(tokens, keys)
    ids = {r["code"]: r["id"] for r in vocab.collect()}
    assert sorted(ids.values()) == [1, 2, 3]
    padded = {r[0]: r[2] for r in S.pad_sequences(S.encode(tokens, vocab), keys, 400).collect()}
    for inst, n in enumerate([10, 11, 399, 400, 401]):
        seq = padded[inst]
        assert len(seq) == 400
        expect = [ids[str(2000 + (j % 3))] for j in range(n)][-400:]
        assert seq == [0] * (400 - len(expect)) + expect


def test_player_matrix_sizes(spark):
    rows = []
    for inst, n in enumerate([29, 30, 31]):
        for j in range(n):
            rows.append((inst, f"g{inst}", j, j + 1, 2000, j))
    clicks = _click(spark, rows)
    labels = spark.createDataFrame([(f"a{i}", i, "T", 1, 0, 1.0, 3) for i in range(3)], LABEL)
    assess = _click(spark, [(i, f"a{i}", 1000, 1, 4100, 0) for i in range(3)])
    allc = clicks.unionByName(assess.withColumn("src_id", F.col("src_id") + 1000))
    rws, values = S.style2_rows(allc, labels, 30)
    full = {r["installation_id"]: r["n_rows"] for r in S.player_matrix(rws, 30, pad=False).collect()}
    assert full == {1: 30, 2: 30}
    padded = {r["installation_id"]: r["matrix"] for r in S.player_matrix(rws, 30, pad=True).collect()}
    assert len(padded[0]) == 30 and padded[0][-1] == [-1.0] * len(padded[0][0])
    assert padded[2][0][0] == 2.0      # player with 31 events starts at its 2nd event


def test_profile_all_missing_gets_means(spark):
    labels = spark.createDataFrame([
        ("a", 1, "Bird Measurer (Assessment)", 1, 0, 1.0, 3),
        ("b", 2, "Bird Measurer (Assessment)", 1, 1, 0.5, 2),
    ], LABEL).withColumn("start", F.lit(_t(0)))
    prof = FT.score_profile(labels)
    fills = FT.fit_profile_fill(prof)
    assert fills["Bird Measurer (Assessment)"] == 2.0      # round half to even of 2.5
    assert fills["Cart Balancer (Assessment)"] is None
    filled = FT.fill_profile(prof, fills).collect()
    assert all(r["Bird Measurer (Assessment)"] in (2.0, 3.0) for r in filled)


def test_hard_vote_ties_to_smaller(spark):
    votes = spark.createDataFrame([("s", 2), ("s", 1), ("s", 2), ("s", 1), ("t", 0), ("t", 3), ("t", 3)],
                                  "game_session string, prediction int")
    got = {r[0]: r[1] for r in SC.hard_vote(votes, ["game_session"]).collect()}
    assert got == {"s": 1, "t": 3}


def test_knn_blocked_equals_single_block(spark):
    emb = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    train, test = emb.where(F.col("vec_id") % 4 != 0), emb.where(F.col("vec_id") % 4 == 0)
    one = {r[0]: r[1] for r in M.knn_vote(train, test, "vec_id", "embedding", k=5).collect()}
    many = {r[0]: r[1] for r in M.knn_vote(train, test, "vec_id", "embedding", k=5, block_rows=37).collect()}
    assert one == many
    tr = train.orderBy("vec_id").collect()
    X = np.array([r["embedding"] for r in tr], dtype=float)
    y = np.array([r["label"] for r in tr])
    ids = np.array([r["vec_id"] for r in tr])
    for r in test.collect():
        d = np.round(((X - np.array(r["embedding"], dtype=float)) ** 2).sum(1), 9)
        nn = np.lexsort((ids, d))[:5]
        counts = np.bincount(y[nn], minlength=10)
        assert one[r["vec_id"]] == int(np.argmax(counts))


def test_cluster_to_group_ranks_by_mean(spark):
    df = spark.createDataFrame([(1, 0, 3.0), (2, 0, 2.0), (3, 1, 0.0), (4, 2, 1.0), (5, 3, 2.0)],
                               "installation_id long, cluster int, score double")
    got = {r[0]: r[2] for r in SC.cluster_to_group(df, "cluster", ["score"]).select(
        "installation_id", "cluster", "accuracy_group").collect()}
    assert got == {1: 3, 2: 3, 5: 2, 4: 1, 3: 0}


def test_kfold_sizes(spark):
    for n in (5, 7, 23, 64):
        df = spark.range(n).withColumnRenamed("id", "installation_id").withColumn("game_session", F.lit("s"))
        folds = [r[0] for r in R.kfold(df, 5).orderBy("installation_id").select("fold").collect()]
        q, m = divmod(n, 5)
        expect = [f for f in range(1, 6) for _ in range(q + 1 if f <= m else q)]
        assert folds == expect


def test_knn_exact_with_many_ties(spark):
    """Small integer vectors: many equal distances, so the k-th place is often
    shared and the train key must settle it, as in the brute-force order."""
    rng = np.random.default_rng(3)
    X = rng.integers(0, 3, size=(300, 6)).astype(float)
    y = rng.integers(0, 4, size=300)
    rows = [(int(i), X[i].tolist(), float(y[i])) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label double")
    train, test = df.where(F.col("vec_id") >= 60), df.where(F.col("vec_id") < 60)
    for block in (20000, 23):
        got = {r[0]: r[1] for r in M.knn_vote(train, test, "vec_id", "embedding", k=7, block_rows=block).collect()}
        for q in range(60):
            d = np.round(((X[60:] - X[q]) ** 2).sum(1), 9)
            nn = np.lexsort((np.arange(60, 300), d))[:7]
            counts = np.bincount(y[60:][nn], minlength=4)
            assert got[q] == int(np.argmax(counts)), (block, q)


def test_vocabulary_ties_follow_first_appearance(spark):
    """Codes with equal counts are ranked by their first appearance in
    (player, session, position) order, the session being a string."""
    rng = np.random.default_rng(11)
    rows = []
    for inst in (5, 3, 9):
        for sess in ("b", "a", "c"):
            for pos in range(1, 8):
                rows.append((inst, sess, pos, str(2000 + int(rng.integers(0, 12)))))
    tokens = spark.createDataFrame(rows, "installation_id long, game_session string, pos long, code string")
    got = {r["code"]: r["id"] for r in S.fit_vocabulary(tokens, ["installation_id", "game_session"], 8).collect()}
    n, first = {}, {}
    for inst, sess, pos, code in rows:
        n[code] = n.get(code, 0) + 1
        first[code] = min(first.get(code, (inst, sess, pos)), (inst, sess, pos))
    ranked = sorted(n, key=lambda c: (-n[c], first[c]))
    assert got == {c: i + 1 for i, c in enumerate(ranked) if i + 1 < 8}


def test_exact_median_without_one_task_buffer(spark):
    """A15 against numpy: odd and even counts, a value held by a third of the
    rows, nulls ignored, and the empty column."""
    rng = np.random.default_rng(5)
    for n in (1, 2, 7, 300, 301):
        vals = rng.integers(0, 50, size=n).astype(float)
        vals[: n // 3] = 0.0
        rows = [(float(x),) for x in vals] + [(None,)]
        df = spark.createDataFrame(rows, "game_time double").repartition(4)
        got = R.column_median(df, "game_time").first()[0]
        assert got == float(np.median(vals)), n
    empty = spark.createDataFrame([(None,)], "game_time double")
    assert R.column_median(empty, "game_time").first()[0] is None


def test_kfold_keeps_every_row_with_duplicate_and_null_keys(spark):
    rows = [(i % 7 if i != 3 else None, float(i)) for i in range(20)]
    df = spark.createDataFrame(rows, "k long, x double")
    out = R.kfold(df, 3, ["k"]).collect()
    assert len(out) == 20
    by_key = {}
    for r in out:
        by_key.setdefault(r["k"], set()).add(r["fold"])
    assert all(len(f) == 1 for f in by_key.values())        # a key has one fold
    assert len(by_key) == 8                                  # 7 keys and the null key
