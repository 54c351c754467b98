"""Invariants of the trained models (rows in = rows out, labels in 0..3, repeatable)
and the reference file formats."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF_MID
from playtrail import sources as SRC

MODEL_QUERIES = ["f10_style4_logistic", "f14_style4_svm", "f10_logistic_ovr", "f11_logistic_multinomial", "f13_random_forest", "f16_mlp",
                 "f14_kernel_svm", "f17_sequence_classifier"]


@pytest.mark.parametrize("name", MODEL_QUERIES)
def test_model_predictions_are_valid_and_repeatable(spark, name):
    q = entry.queries()[name]
    a = q(spark, SF_MID)
    rows = a.collect()
    assert rows, name
    assert all(r["prediction"] in (0.0, 1.0, 2.0, 3.0) for r in rows)
    assert all(r["label"] in (0.0, 1.0, 2.0, 3.0) for r in rows)
    b = q(spark, SF_MID).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, b))


def test_kfold_evaluate_covers_every_row_once(spark):
    preds = entry.queries()["f7_kfold_evaluate"](spark, SF_MID)
    keys = preds.groupBy("installation_id", "game_session").count()
    assert keys.where(F.col("count") != 1).count() == 0
    assert sorted(r[0] for r in preds.select("fold").distinct().collect()) == [1, 2, 3, 4, 5]


def test_forest_separates_what_needs_deep_trees(spark):
    from playtrail.operators import models as M
    # 64 runs of one label each: 32 leaves or 32 thresholds cannot tell them apart.
    rows = spark.createDataFrame([(i, float(i), i // 4 % 2) for i in range(256) for _ in range(4)], "id long, x double, accuracy_group int")
    df = M.with_label(M.assemble(rows, ["x"]))
    out = M.fit_predict(M.random_forest(20), df, df, ["id"])
    assert out.where("prediction = label").count() > 0.95 * 1024


def test_cluster_profiles_assigns_all_players(spark):
    out = entry.queries()["f18_cluster_profiles"](spark, SF_MID).collect()
    assert len(out) == 150
    assert {r["accuracy_group"] for r in out} <= {0, 1, 2, 3}


def test_forest_folds_cover_every_player_once(spark):
    preds = entry.queries()["f7_style2_kfold_forest"](spark, SF_MID).collect()
    assert len(preds) == len({r["installation_id"] for r in preds}) == 150
    assert {r["fold"] for r in preds} == {1, 2, 3, 4, 5}
    assert all(r["prediction"] in (0.0, 1.0, 2.0, 3.0) for r in preds)


def test_score_test_gives_each_test_player_one_group(spark):
    from playtrail.sources.fixtures import Tables
    out = entry.queries()["f23_score_test"](spark, SF_MID).collect()
    players = {r[0] for r in Tables(spark, SF_MID).player_clicks(test=True).select("installation_id").distinct().collect()}
    assert len(out) == len({r["installation_id"] for r in out}) and {r["installation_id"] for r in out} <= players
    assert {r["accuracy_group"] for r in out} <= {0, 1, 2, 3}


def test_style3_profiles_are_complete(spark):
    out = entry.queries()["z4_style3_profiles"](spark, SF_MID).collect()
    assert len(out) == len({r["installation_id"] for r in out}) == 150
    by_cluster = {}
    for r in out:
        by_cluster.setdefault(r["cluster"], set()).add(r["accuracy_group"])
        assert all(v is not None for v in r)
    assert all(len(g) == 1 for g in by_cluster.values()) and len(by_cluster) == len({min(g) for g in by_cluster.values()})


def test_row_votes_equal_the_long_vote(spark):
    from playtrail.operators import ensemble as E
    from playtrail.operators import scoring as SC
    rows = [(a * 64 + b * 16 + c * 4 + d, a, b, c, d) for a in range(4) for b in range(4) for c in range(4) for d in range(4)]
    df = spark.createDataFrame(rows, "id int, a int, b int, c int, d int")
    wide = {r.id: r.v for r in df.select("id", E.majority([F.col(x) for x in "abcd"]).alias("v")).collect()}
    long = df.select("id", F.explode(F.array("a", "b", "c", "d")).alias("prediction"))
    assert wide == {r.id: r.prediction for r in SC.hard_vote(long, ["id"]).collect()}


def test_saved_style3_state_is_enough(spark):
    """Scoring reads the saved tables and the events of unlabelled players only."""
    from playtrail.operators import style3
    from playtrail.sources.fixtures import Tables
    t = Tables(spark, SF_MID)
    path = tempfile.mkdtemp(prefix="playtrail-style3-")
    style3.fit_style3(t.player_clicks(test=False), t.labels, path)
    assert set(os.listdir(path)) == {style3.VOCABULARY, style3.FILLS, style3.CENTRES, style3.MODEL}
    test = t.player_clicks(test=True).select("installation_id", "game_session", "ts", "event_count", "src_id", "event_code", "title", "type")
    one, two = (sorted(map(tuple, style3.submission(test, path).collect())) for _ in range(2))
    assert one == two and len(one) == test.where("type = 'Assessment'").select("installation_id").distinct().count()
    assert {g for _, g in one} <= {0, 1, 2, 3}


SAMPLE = '''event_id,game_session,timestamp,event_data,installation_id,event_count,event_code,game_time,title,type,world
aa01,sess-one,2021-03-04T05:06:07.250Z,"{""code"": 9}",player-x,1,9,0,Opening,Clip,NONE
aa02,sess-two,2021-03-04T05:07:00.000Z,"{""items"":[1,2],""note"":""first, second""}",player-x,1,9,0,Opening,Clip,NONE
aa03,sess-two,2021-03-04T05:07:30.125Z,"{""say"":""one, two"",""deep"":{""k"":""v,w""}}",player-x,2,11,77,Workshop (Activity),Activity,NONE
'''


def test_read_clicks_csv_with_json_quotes(spark):
    d = tempfile.mkdtemp(prefix="playtrail-csv-")
    p = os.path.join(d, "train.csv")
    with open(p, "w") as f:
        f.write(SAMPLE)
    rows = SRC.read_clicks(spark, p).orderBy("src_id").collect()
    assert len(rows) == 3
    assert rows[2]["event_data"] == '{"say":"one, two","deep":{"k":"v,w"}}'
    assert rows[2]["game_time"] == 77 and rows[2]["title"] == "Workshop (Activity)"
    assert rows[0]["ts"].isoformat().startswith("2021-03-04T05:06:07.250")
    assert [r["src_id"] for r in rows] == sorted(r["src_id"] for r in rows)


def test_labelled_round_trip_keeps_rows(spark):
    t = SRC.Tables(spark, SF_MID)
    from playtrail.operators import labelling as L
    hist = L.label_history(t.clicks, t.labels, materialized=False)
    d = tempfile.mkdtemp(prefix="playtrail-pq-")
    SRC.write_labelled(hist, d + "/h", buckets=4)
    back = SRC.read_labelled(spark, d + "/h")
    assert back.count() == hist.count()
    assert set(back.columns) == set(hist.columns)


def test_code_chunks_keep_every_code(spark):
    from pyspark.sql import functions as F

    from playtrail.operators import sequences as S
    for n in (1, 399, 400, 401, 2000):
        t = spark.range(n).select(F.lit("p").alias("k"), (F.col("id") + 1).alias("pos"), (F.col("id") + 1000).cast("string").alias("code"))
        rows = S.code_chunks(t, ["k"], 400).orderBy("chunk_no").collect()
        assert [c for r in rows for c in r["codes"]] == [str(1000 + i) for i in range(n)]
        assert [r["chunk_no"] for r in rows] == list(range(-(-n // 400)))


def test_ensemble_fits_its_models_side_by_side(spark):
    """Each fit waits until all four have begun: one after another they would never end."""
    from threading import Barrier

    from playtrail.operators import ensemble as E
    begun = Barrier(4, timeout=20)

    class Waits:
        hasParam = lambda self, name: False
        getParam = lambda self, name: name
        copy = lambda self, more: self

        def fit(self, train):
            begun.wait()
            return train.count()

    assert E.fitted({n: Waits() for n in "abcd"}, spark.range(3)) == dict.fromkeys("abcd", 3)
