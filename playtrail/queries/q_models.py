"""Queries for models and scoring."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from playtrail.functions.scalar import hash_fraction, round6, round_half_even
from playtrail.operators import ensemble as E
from playtrail.operators import features as FT
from playtrail.operators import knn as K
from playtrail.operators import models as M
from playtrail.operators import relational as R
from playtrail.operators import scoring as SC
from playtrail.operators import sequences as S
from playtrail.operators import style3 as ST3
from playtrail.queries import query
from playtrail.queries.q_sequences import HIST, _seq_sql, _style2_sql
from playtrail.schema import ASSESSMENT_TITLES, COUNT_FEATURES, KEY, SESSION, TIME_FEATURES
from playtrail.session import materialize, scratch_path
from playtrail.sources.fixtures import TEST_PLAYER_SQL

FRAC = "(('0x' || substr(md5(concat('{seed}:', cast({key} as varchar))), 1, 8))::bigint / 4294967296.0)"
STARTS = ("st as (select l.*, s.start from assessment_labels l join (select installation_id, game_session, "
          "min(ts) start from clicks group by installation_id, game_session) s using (installation_id, game_session))")


# ---------------------------------------------------------------- F12 exact kNN on embeddings

KNN = f"""emb as (select vec_id, cast(embedding as double[]) x, label, {FRAC.format(seed=1, key='vec_id')} < 0.15 is_test
  from embeddings),
d as (select q.vec_id q_key, t.vec_id t_key, t.label t_y, round(list_sum(list_transform(list_zip(q.x, t.x),
  lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 9) dist from emb q, emb t where q.is_test and not t.is_test),
b as (select * from (select *, row_number() over (partition by q_key order by dist, t_key) r from d) q where r <= 15),
c as (select q_key, t_y, count(*) n from b group by all),
v as (select q_key, t_y, row_number() over (partition by q_key order by n desc, t_y) r from c)"""


def _emb_split(t):
    e = t.embeddings.withColumn("is_test", hash_fraction("vec_id", 1) < 0.15)
    return e.where(~F.col("is_test")), e.where(F.col("is_test"))


@query("f12_knn_vote", "select q_key vec_id, cast(t_y as int) prediction from v where r = 1", ctes=KNN)
def f12(t):
    train, test = _emb_split(t)
    pred = M.knn_vote(train, test, "vec_id", "embedding", k=15, label="label")
    return pred.withColumn("prediction", F.col("prediction").cast("int"))


# ---------------------------------------------------------------- F15, F19-F22, F24 on deterministic votes

VOTES = STARTS + """,
pm as (select installation_id, round_even(avg(accuracy_group), 0) v from st group by installation_id),
pf as (select installation_id, arg_min(accuracy_group, (start, game_session)) vf,
  arg_max(accuracy_group, (start, game_session)) vl from st group by installation_id),
tm as (select title, round_even(avg(accuracy_group), 0) v from st group by title),
votes as (select game_session, cast(pm.v as int) v from st join pm using (installation_id)
  union all select game_session, vf from st join pf using (installation_id)
  union all select game_session, vl from st join pf using (installation_id)
  union all select game_session, cast(tm.v as int) from st join tm using (title)),
vc as (select game_session, v, count(*) n from votes group by all),
hv as (select game_session, v prediction from (select *, row_number() over (partition by game_session
  order by n desc, v) r from vc) q where r = 1),
scored as (select st.installation_id, st.game_session, st.start, st.accuracy_group label, hv.prediction
  from st join hv using (game_session))"""


def _votes(t):
    st = t.starts
    order = F.struct("start", SESSION)
    per_player = st.groupBy(KEY).agg(round_half_even(F.avg("accuracy_group")).cast("int").alias("vm"),
                                     F.min_by("accuracy_group", order).alias("vf"),
                                     F.max_by("accuracy_group", order).alias("vl"))
    per_title = st.groupBy("title").agg(round_half_even(F.avg("accuracy_group")).cast("int").alias("vt"))
    base = st.join(per_player, KEY).join(per_title, "title")
    # one row per (session, model) in a single projection, not a union of four
    # branches that would each re-derive the joined table
    votes = base.select(SESSION, F.explode(F.array(*[F.col(c).cast("int") for c in ("vm", "vf", "vl", "vt")]))
                        .alias("prediction"))
    return st, votes


def _scored(t):
    st, votes = _votes(t)
    hv = SC.hard_vote(votes, [SESSION])
    return st.select(KEY, SESSION, "start", F.col("accuracy_group").alias("label")).join(hv, SESSION)


@query("f15_hard_vote", "select game_session, prediction from hv", ctes=VOTES)
def f15(t):
    _, votes = _votes(t)
    return SC.hard_vote(votes, [SESSION])


@query("f20_accuracy", "select round(avg(case when prediction = label then 1.0 else 0.0 end), 6) accuracy, "
       "count(*) n from scored", ctes=VOTES)
def f20(t):
    return SC.accuracy(_scored(t)).withColumn("accuracy", round6("accuracy"))


@query("f22_confusion", "select label, prediction, count(*) n from scored group by all", ctes=VOTES)
def f22(t):
    return SC.confusion(_scored(t))


@query("f24_last_prediction", "select installation_id, arg_max(prediction, (start, game_session)) prediction "
       "from scored group by installation_id", ctes=VOTES)
def f24(t):
    return SC.last_prediction(_scored(t), KEY, ["start", SESSION])


PC = STARTS + ", pc as (select installation_id, count(*) n, " + ", ".join(
    f"count(*) filter (where accuracy_group = {c}) c{c}" for c in range(4)) + " from st group by installation_id)"


@query("f21_cross_entropy", """select round(avg(-ln((case st.accuracy_group when 0 then c0 when 1 then c1
  when 2 then c2 else c3 end + 1.0) / (n + 4.0))), 6) cross_entropy from st join pc using (installation_id)""", ctes=PC)
def f21(t):
    st = t.starts
    pc = st.groupBy(KEY).agg(F.count(F.lit(1)).alias("n"),
                             *[F.count_if(F.col("accuracy_group") == c).alias(f"c{c}") for c in range(4)])
    probs = F.array(*[(F.col(f"c{c}") + 1.0) / (F.col("n") + 4.0) for c in range(4)])
    d = st.join(pc, KEY).withColumn("p", probs)
    return SC.cross_entropy(d, "p", "accuracy_group").withColumn("cross_entropy", round6("cross_entropy"))


PROFILE = (STARTS + ", fr as (select *, row_number() over (partition by installation_id, title order by start, "
           "game_session) r from st), prof as (select installation_id, "
           + ", ".join(f"max(case when title = '{tt}' and r = 1 then accuracy_group end) \"{tt}\""
                       for tt in ASSESSMENT_TITLES)
           + ", round_even(avg(accuracy_group), 0) accuracy_group from fr group by installation_id), "
           "filled as (select installation_id, cast(accuracy_group as int) cluster, "
           + ", ".join(f"coalesce(cast(\"{tt}\" as double), (select round_even(avg(\"{tt}\"), 0) from prof)) \"{tt}\""
                       for tt in ASSESSMENT_TITLES) + " from prof)")


def _filled(t):
    prof = FT.score_profile(t.starts)
    return FT.fill_profile(prof, FT.fit_profile_fill(prof))


@query("f19_cluster_to_group", """
select f.installation_id, f.cluster, cast(k - r as int) accuracy_group from filled f join (
  select cluster, row_number() over (order by m desc, cluster) r, count(*) over () k from (
    select cluster, avg((""" + " + ".join(f"\"{tt}\"" for tt in ASSESSMENT_TITLES) + f""") / {len(ASSESSMENT_TITLES)}.0) m
    from filled group by cluster) q) c using (cluster)""", ctes=PROFILE)
def f19(t):
    f = _filled(t).withColumn("cluster", F.col("accuracy_group").cast("int")).drop("accuracy_group")
    return SC.cluster_to_group(f, "cluster", ASSESSMENT_TITLES).select(KEY, "cluster", "accuracy_group")


# ---------------------------------------------------------------- F25, F26

FEATS_COLS = FT.FEATURE_COLS


@query("f25_assemble", "select game_session, " + ", ".join(
    f"round(cast({c} as double), 6) f{i}" for i, c in enumerate(FEATS_COLS)) + " from feats",
    ctes="""s1 as (select c.installation_id, c.game_session, c.world, c.event_code, l.accuracy_group, c.event_count,
  c.src_id, s.event_type, s.event_action, c.game_time from clicks c join assessment_labels l using (installation_id,
  game_session) join specs s using (event_id)),
s1g as (select * exclude (game_time), coalesce(abs(game_time - lead(game_time) over (partition by installation_id,
  game_session order by event_count, src_id)), 0) game_time from s1),
s1c as (select * from s1g where game_time < 600000 and event_code not in (4100, 4110)),
feats as (select game_session, cast(sum(game_time) as bigint) total_time, """ + ", ".join(
        f"coalesce(cast(sum(case when event_action = {a} and event_type = {tt} then game_time end) as double) "
        f"/ nullif(cast(sum(game_time) as double), 0), 0) {n}" for n, a, tt in TIME_FEATURES) + ", " + ", ".join(
        f"count(*) filter (where event_action = {a} and event_type = {tt}) {n}" for n, a, tt in COUNT_FEATURES)
        + " from s1c group by game_session)")
def f25(t):
    feats = FT.session_features(FT.style1_events(t.clicks, t.labels, t.specs))
    v = M.assemble(feats, FEATS_COLS).withColumn("_a", vector_to_array("features"))
    return v.select(SESSION, *[round6(F.col("_a")[i]).alias(f"f{i}") for i in range(len(FEATS_COLS))])


@query("f26_category_codes", "select game_session, cast(dense_rank() over (order by title) - 1 as int) title_code "
       "from assessment_labels")
def f26(t):
    return M.category_codes(t.labels, "title").select(SESSION, F.col("title_code").cast("int").alias("title_code"))


# ---------------------------------------------------------------- trained models (rows and invariants only)

def _style1_ml(t):
    """Style 1 training rows: balanced one-hot session features, standardised
    with train statistics, split 85/15 by session hash."""
    feats = M.with_label(FT.split(FT.style1_features(t.clicks, t.labels, t.specs), SESSION))
    cols = FEATS_COLS + [c for c in feats.columns if c.startswith("world_")]
    scaler = FT.Standardizer.fit(feats.where(F.col("split") == "train"), cols)
    data = materialize(M.assemble(scaler.transform(feats), cols))
    return data.where(F.col("split") == "train"), data.where(F.col("split") == "test"), len(cols)


def _fit_score(est, t):
    train, test, _ = _style1_ml(t)
    return M.fit_predict(est, train, test, [SESSION]).select(SESSION, "label", "prediction")


@query("f10_logistic_ovr")
def f10(t):
    return _fit_score(M.logistic_ovr(), t)


@query("f11_logistic_multinomial")
def f11(t):
    return _fit_score(M.logistic_multinomial(), t)


@query("f13_random_forest")
def f13(t):
    return _fit_score(M.narrow_forest(100), t)


@query("f16_mlp")
def f16(t):
    train, test, width = _style1_ml(t)
    return M.fit_predict(M.mlp(width), train, test, [SESSION]).select(SESSION, "label", "prediction")


@query("f14_kernel_svm")
def f14(t):
    return _fit_score(M.KernelSVM(SESSION, "rbf", "scale"), t)


def _style5_ml(t):
    table, _ = S.style5_sequences(t.history())
    return materialize(M.with_label(M.sequence_tokens(table).withColumn("accuracy_group", F.round("accuracy_group"))))


@query("f17_sequence_classifier")
def f17(t):
    data = FT.split(_style5_ml(t), SESSION)
    train, test = data.where(F.col("split") == "train"), data.where(F.col("split") == "test")
    return M.fit_predict(M.sequence_classifier(), train, test, [KEY, SESSION]).select(KEY, SESSION, "label",
                                                                                        "prediction")


@query("f7_kfold_evaluate")
def f7(t):
    data = materialize(R.kfold(_style5_ml(t), 5, [KEY, SESSION]), "style5-folds")  # read by every fold
    preds = M.kfold_evaluate(data, M.sequence_classifier, keep=[KEY, SESSION])
    return preds.select(KEY, SESSION, "fold", "label", "prediction")


@query("f18_cluster_profiles")
def f18(t):
    filled = _filled(t)
    assigned, _ = M.cluster_profiles(filled, ASSESSMENT_TITLES, 4)
    return SC.cluster_to_group(assigned, "cluster", ASSESSMENT_TITLES).select(KEY, "cluster", "accuracy_group")


@query("f23_score_test")
def f23(t):
    """Fit on the train players' sessions, score the test players' sessions,
    keep each test player's last scored session."""
    train_players, test_players = t.player_clicks(test=False), t.player_clicks(test=True)
    feats = FT.session_features(FT.style1_events(train_players, t.labels, t.specs))
    worlds = FT.fit_values(feats, "world")
    train = M.with_label(FT.dummies(feats, "world", worlds))
    cols = FEATS_COLS + [f"world_{w}" for w in worlds]
    scaler = FT.Standardizer.fit(train, cols)
    model = M.logistic_multinomial().fit(M.assemble(scaler.transform(train), cols))
    tev = FT.style1_events(test_players, t.labels, t.specs, train=False)
    tfeat = FT.session_features(tev, [SESSION, "world", KEY]).join(R.session_starts(test_players), [KEY, SESSION])
    scored = model.transform(M.assemble(scaler.transform(FT.dummies(tfeat, "world", worlds)), cols))
    return SC.last_prediction(scored, KEY, ["start", SESSION]).withColumn(
        "accuracy_group", F.col("prediction").cast("int")).select(KEY, "accuracy_group")


@query("z4_style3_profiles")
def z4(t):
    """Score profiles (A12, A13), filled (F5), clustered (F18), mapped to groups."""
    filled = _filled(t).drop("accuracy_group")
    assigned, _ = M.cluster_profiles(filled, ASSESSMENT_TITLES, 4)
    return SC.cluster_to_group(assigned, "cluster", ASSESSMENT_TITLES)


# ---------------------------------------------------------------- model x style combinations of the reference

def _style2_ml(t):
    """Style 2 rows: one flat, padded last-300 matrix per labelled player, 5 folds by player."""
    flat = S.style2_last_events(t.clicks, t.labels, 300)
    data = M.with_label(M.array_features(flat, "features", "vec")).drop("features").withColumnRenamed("vec", "features")
    return materialize(R.kfold(data, 5, [KEY]), "style2-ml")


# style-2 rows as in z2's oracle, five contiguous folds by player (SQL ntile),
# then the exact kNN (k = 15, ties by the train key) and vote of F12 per fold
KNN2 = (f"{_style2_sql(300)}, "
        "f2 as (select installation_id, cast(accuracy_group as double) label, "
        "cast(string_split(features, ' ') as double[]) x, "
        "cast(ntile(5) over (order by installation_id) as int) fold from mat), "
        "d2 as (select q.installation_id q_key, q.fold, t.installation_id t_key, t.label t_y, "
        "round(list_sum(list_transform(list_zip(q.x, t.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 9) dist "
        "from f2 q join f2 t on q.fold <> t.fold), "
        "b2 as (select * from (select *, row_number() over (partition by q_key order by dist, t_key) r from d2) q "
        "where r <= 15), "
        "c2 as (select q_key, fold, t_y, count(*) n from b2 group by all), "
        "v2 as (select q_key, fold, t_y, row_number() over (partition by q_key order by n desc, t_y) r from c2)")


@query("f7_style2_kfold_knn", "select v2.q_key installation_id, v2.fold, f2.label, cast(v2.t_y as double) prediction "
       "from v2 join f2 on f2.installation_id = v2.q_key where v2.r = 1", ctes=KNN2)
def f7_knn2(t):
    """Style 2, k = 15 nearest neighbours, five contiguous folds: one search over the
    whole table in which a player's own fold is left out."""
    data = _style2_ml(t)
    pred = K.fold_vote(data, KEY, "features", "fold", 15, "label")
    return pred.join(data.select(KEY, "fold", "label"), KEY).select(
        KEY, "fold", "label", F.col("prediction").cast("double").alias("prediction"))


@query("f7_style2_kfold_forest")
def f7_rf2(t):
    """Style 2, random forest of 100 trees, five contiguous folds."""
    preds = M.kfold_evaluate(_style2_ml(t), lambda: M.narrow_forest(100), keep=[KEY])
    return preds.select(KEY, "fold", "label", "prediction")


def _style4_ml(t):
    """Style 4 rows: padded id sequence per assessment group, 15 % hold-out by group."""
    table, _ = S.style4_sequences(t.history())
    data = M.with_label(M.array_features(table.withColumn("accuracy_group", F.round("accuracy_group")), "sequence"))
    data = FT.split(data.withColumn("gkey", F.concat_ws("-", KEY, "group")), "gkey")
    data = materialize(data.select(KEY, "group", "gkey", "label", "features", "split"), "style4-ml")
    return data.where(F.col("split") == "train"), data.where(F.col("split") == "test")


@query("f10_style4_logistic")
def f10_s4(t):
    train, test = _style4_ml(t)
    return M.fit_predict(M.logistic_ovr(), train, test, [KEY, "group"]).select(KEY, "group", "label", "prediction")


# style-4 rows as in z6's oracle, split by the hash of "installation_id-group",
# then the same exact kNN (ties by the train key) and vote as F12
STYLE4_K = (5, 20, 50, 100)
KNN4 = (f"{HIST}, hg as (select * from h where grp is not null), {_seq_sql('hg', 'grp', 10)}, "
        "s4 as (select installation_id, k2 grp, concat_ws('-', installation_id, k2) gkey, "
        "round(accuracy_group) label, cast(string_split(sequence, ' ') as double[]) x from seqs), "
        f"s4s as (select *, {FRAC.format(seed=1, key='gkey')} < 0.15 is_test from s4), "
        "d4 as (select q.gkey q_key, t.gkey t_key, t.label t_y, round(list_sum(list_transform(list_zip(q.x, t.x), "
        "lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 9) dist from s4s q, s4s t where q.is_test and not t.is_test), "
        f"ks as (select unnest([{', '.join(map(str, STYLE4_K))}]) k), "
        "b4 as (select q.*, k from (select *, row_number() over (partition by q_key order by dist, t_key) r from d4) q, ks "
        "where r <= k), "
        "c4 as (select q_key, k, t_y, count(*) n from b4 group by all), "
        "v4 as (select q_key, k, t_y, row_number() over (partition by q_key, k order by n desc, t_y) r from c4)")


@query("f12_style4_knn", "select s.installation_id, s.grp \"group\", s.label, cast(v4.t_y as double) prediction "
       "from v4 join s4s s on s.gkey = v4.q_key where v4.r = 1 and v4.k = 5", ctes=KNN4)
def f12_s4(t):
    train, test = _style4_ml(t)
    pred = M.knn_vote(train, test, "gkey", "features", k=5, label="label")
    return pred.join(test.select("gkey", KEY, "group", "label"), "gkey").select(
        KEY, "group", "label", F.col("prediction").cast("double").alias("prediction"))


@query("f12_style4_knn_by_k", "select s.installation_id, s.grp \"group\", cast(v4.k as int) k, s.label, cast(v4.t_y as double) "
       "prediction from v4 join s4s s on s.gkey = v4.q_key where v4.r = 1", ctes=KNN4)
def f12_s4_by_k(t):
    """Style 4, k = 5, 20, 50 and 100 from one search."""
    train, test = _style4_ml(t)
    pred = K.knn_votes(train, test, "gkey", "features", STYLE4_K, "label")
    return pred.join(test.select("gkey", KEY, "group", "label"), "gkey").select(
        KEY, "group", "k", "label", F.col("prediction").cast("double").alias("prediction"))


@query("f14_style4_svm")
def f14_s4(t):
    train, test = _style4_ml(t)
    return M.fit_predict(M.KernelSVM("gkey"), train, test, [KEY, "group"]).select(KEY, "group", "label", "prediction")


# ---------------------------------------------------------------- fitted on train players, applied to test players

# First score per title of the train players, and which titles the test players played.
TRAIN_PROFILE = (STARTS + ", fr as (select *, row_number() over (partition by installation_id, title order by start, game_session) r "
                 f"from st where not ({TEST_PLAYER_SQL})), prof as (select installation_id, "
                 + ", ".join(f"max(case when title = '{tt}' and r = 1 then accuracy_group end) \"{tt}\"" for tt in ASSESSMENT_TITLES)
                 + " from fr group by installation_id), played as (select distinct installation_id, title from clicks "
                 f"where type = 'Assessment' and {TEST_PLAYER_SQL})")


@query("z4_style3_test_profiles", "select installation_id, " + ", ".join(
    f"case when count(*) filter (where title = '{tt}') = 0 then (select round_even(avg(\"{tt}\"), 0) from prof) else -1.0 end \"{tt}\""
    for tt in ASSESSMENT_TITLES) + " from played group by installation_id", ctes=TRAIN_PROFILE)
def z4_test_profiles(t):
    """Profiles of the test players from predicted scores, with the train players'
    fills; a predicted score (a whole number from 0 to 3) is shown as -1."""
    path = scratch_path(t.spark, "style3-state")
    ST3.fit_style3(t.player_clicks(test=False), t.labels, path)
    prof = ST3.test_profiles(ST3.score_style3(t.player_clicks(test=True), path), path)
    score = lambda c: F.when(F.col(f"`{c} filled`") | ~F.col(f"`{c}`").isin(0.0, 1.0, 2.0, 3.0), F.col(f"`{c}`")).otherwise(-1.0)
    return prof.select(KEY, *[score(c).alias(c) for c in ASSESSMENT_TITLES])


@query("z4_style3_submission", f"select distinct installation_id, true valid from clicks where type = 'Assessment' and {TEST_PLAYER_SQL}")
def z4_submission(t):
    """The whole style-3 way from train players to one group per test player."""
    path = scratch_path(t.spark, "style3-state")
    ST3.fit_style3(t.player_clicks(test=False), t.labels, path)
    out = ST3.submission(t.player_clicks(test=True), path)
    return out.select(KEY, F.coalesce(F.col("accuracy_group").between(0, 3), F.lit(False)).alias("valid"))


def _ensemble(t):
    table, width = E.feature_table(t.player_clicks(test=False), t.player_clicks(test=True), t.labels, t.specs)
    return materialize(E.score_all(table, width), "style1-scored")


ENSEMBLE = """s1 as (select c.installation_id, c.game_session, c.world, c.event_code, l.accuracy_group, c.event_count, c.src_id,
  c.game_time from clicks c join assessment_labels l using (installation_id, game_session) join specs s using (event_id)),
s1g as (select * exclude (game_time), coalesce(abs(game_time - lead(game_time) over (partition by installation_id,
  game_session order by event_count, src_id)), 0) game_time from s1),
train_rows as (select distinct installation_id, game_session from s1g where game_time < 600000 and event_code not in (4100, 4110)
  and not (%(test)s) and not (accuracy_group = 3 and %(thin)s < 0.65) and %(split)s < 0.15),
t1 as (select c.installation_id, c.game_session, c.event_count, c.src_id, c.game_time from clicks c join specs s using (event_id)
  where %(test)s),
t1g as (select * exclude (game_time), coalesce(abs(game_time - lead(game_time) over (partition by installation_id,
  game_session order by event_count, src_id)), 0) game_time from t1),
test_rows as (select distinct installation_id, game_session from t1g where game_time < 600000)""" % {
    "test": TEST_PLAYER_SQL, "thin": FRAC.format(seed=0, key="game_session"), "split": FRAC.format(seed=1, key="game_session")}


@query("f15_style1_ensemble", "select installation_id, game_session, 'holdout' as part, 1 one, true voted from train_rows union all "
       "select installation_id, game_session, 'test', 1, true from test_rows", ctes=ENSEMBLE)
def f15_ensemble(t):
    """Hold-out and test sessions with the vote of two logistics, kNN and forest:
    ``voted`` where the vote is a label that no other label of the four outnumbers
    and no smaller one equals."""
    scored = _ensemble(t)
    votes = F.array(*[F.col(m) for m in E.VOTERS])
    times = lambda v: F.size(F.filter(votes, lambda x: x == v))
    won = F.lit(True)
    for label in range(4):
        won = won & F.when(F.col("vote") <= label, times(F.col("vote")) >= times(F.lit(label))).otherwise(
            times(F.col("vote")) > times(F.lit(label)))
    counts = scored.groupBy(KEY, SESSION, "part").agg(F.count(F.lit(1)).cast("int").alias("one"), F.min(
        won & F.col("vote").between(0, 3)).alias("voted"))
    return counts


@query("f23_test_players_by_model", "select installation_id, model, true valid from (select distinct installation_id from test_rows) p, "
       "(select unnest(['" + "', '".join(E.ALL_MODELS) + "']) model) m", ctes=ENSEMBLE)
def f23_by_model(t):
    """Each test player's last session scored by every style-1 model."""
    last = E.last_by_model(_ensemble(t))
    return last.select(KEY, "model", F.coalesce(F.col("accuracy_group").between(0, 3), F.lit(False)).alias("valid"))


# ---------------------------------------------------------------- the other models of styles 2 to 5

STYLE4_KEYS = f"{HIST}, hg as (select * from h where grp is not null), {_seq_sql('hg', 'grp', 10)}, " \
    f"s4 as (select installation_id, k2, concat_ws('-', installation_id, k2) gkey from seqs), " \
    f"held as (select * from s4 where {FRAC.format(seed=1, key='gkey')} < 0.15)"
KERNELS = ("rbf", "poly", "sigmoid")


def _valid(df, *keys):
    """Keys of scored rows, each with whether its prediction is one of the four groups."""
    return df.select(*keys, F.col("prediction").isin(0.0, 1.0, 2.0, 3.0).alias("valid"))


@query("f11_style4_multinomial", "select installation_id, k2 \"group\", true valid from held", ctes=STYLE4_KEYS)
def f11_s4(t):
    train, test = _style4_ml(t)
    return _valid(M.fit_predict(M.logistic_multinomial(), train, test, [KEY, "group"]), KEY, "group")


@query("f14_style4_kernels", "select installation_id, k2 \"group\", kernel, true valid from held, (select unnest(["
       + ", ".join(f"'{k}'" for k in KERNELS) + "]) kernel) q", ctes=STYLE4_KEYS)
def f14_kernels(t):
    """Style 4, kernel SVMs with rbf, poly (degree 10) and sigmoid kernels, gamma 1 / width."""
    train, test = _style4_ml(t)
    out = None
    for kernel in KERNELS:
        preds = M.fit_predict(M.KernelSVM("gkey", kernel), train, test, [KEY, "group"]).withColumn("kernel", F.lit(kernel))
        out = preds if out is None else out.unionByName(preds)
    return _valid(out, KEY, "group", "kernel")


@query("f7_style2_kfold_svm", "select installation_id, fold, true valid from (select installation_id, cast(ntile(5) over "
       "(order by installation_id) as int) fold from mat) q", ctes=_style2_sql(300))
def f7_svm2(t):
    """Style 2, rbf kernel SVM over five contiguous folds; the landmarks of a fold are
    rows of its own train part."""
    preds = M.kfold_evaluate(_style2_ml(t), lambda: M.KernelSVM(KEY), keep=[KEY])
    return _valid(preds, KEY, "fold")


def _style3_ml(t):
    table, _ = S.style3_sequences(t.clicks, t.labels)
    return FT.split(M.with_label(M.sequence_tokens(table)), SESSION)


def _style4_tokens(t):
    table, _ = S.style4_sequences(t.history())
    data = M.with_label(M.sequence_tokens(table).withColumn("accuracy_group", F.round("accuracy_group")))
    return FT.split(data.withColumn("gkey", F.concat_ws("-", KEY, "group")), "gkey")


@query("f17_sequence_losses", "select 3 style, (select count(*) from assessment_labels where "
       + FRAC.format(seed=1, key="game_session") + " < 0.15) n, true valid union all select 4, (select count(*) from held), true",
       ctes=STYLE4_KEYS)
def f17_losses(t):
    """The sequence model on styles 3 and 4: hold-out accuracy and cross-entropy are
    shares and losses (``valid``); their values are printed by the bench."""
    out = None
    for style, data in ((3, _style3_ml(t)), (4, _style4_tokens(t))):
        one = sequence_scores(data).withColumn("style", F.lit(style))
        out = one if out is None else out.unionByName(one)
    return out.select("style", "n", (F.col("accuracy").between(0, 1) & (F.col("cross_entropy") >= 0) & ~F.isnan("cross_entropy")
                                     & (F.col("cross_entropy") < 1e6)).alias("valid"))


def sequence_scores(data):
    """One row: n, accuracy and cross-entropy of the sequence model on the test split."""
    data = materialize(data.select("tokens", "label", "split"), "sequence-split")
    scored = M.sequence_classifier().fit(data.where(F.col("split") == "train")).transform(data.where(F.col("split") == "test"))
    p = F.element_at(vector_to_array("probability"), F.col("label").cast("int") + 1)
    return scored.agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"),
                      F.avg(-F.log(F.greatest(p, F.lit(1e-15)))).alias("cross_entropy"))
