"""Queries for session features (A1-A6, A12, A13) and feature preparation."""

from pyspark.sql import functions as F

from playtrail.functions.scalar import hash_fraction, round6
from playtrail.operators import features as FT
from playtrail.operators import relational as R
from playtrail.queries import query
from playtrail.schema import ASSESSMENT_TITLES, COUNT_FEATURES, KEY, SESSION, TIME_FEATURES
from playtrail.session import materialize

S1 = """s1 as (select c.installation_id, c.game_session, c.world, c.event_code, l.accuracy_group, c.event_count, c.src_id,
  s.event_type, s.event_action, c.game_time from clicks c join assessment_labels l using (installation_id, game_session)
  join specs s using (event_id)),
s1g as (select * exclude (game_time), coalesce(abs(game_time - lead(game_time) over (partition by installation_id,
  game_session order by event_count, src_id)), 0) game_time from s1),
s1c as (select * from s1g where game_time < 600000 and event_code not in (4100, 4110))"""


def _feature_sql(src: str = "s1c") -> str:
    """One row per identity, each with its whole session's features."""
    shares = ", ".join(
        f"round(coalesce(cast(sum(case when event_action = {a} and event_type = {t} then game_time end) as double) "
        f"/ nullif(cast(sum(game_time) as double), 0), 0), 6) {n}" for n, a, t in TIME_FEATURES)
    counts = ", ".join(f"count(*) filter (where event_action = {a} and event_type = {t}) {n}"
                       for n, a, t in COUNT_FEATURES)
    return (f"select * from (select distinct game_session, world, installation_id, accuracy_group from {src}) i join "
            f"(select game_session, cast(sum(game_time) as bigint) total_time, {shares}, {counts} from {src} "
            f"group by game_session) t using (game_session)")


FEATS = f"{S1}, feats as ({_feature_sql()})"
FRAC = "(('0x' || substr(md5(concat('{seed}:', cast({key} as varchar))), 1, 8))::bigint / 4294967296.0)"
SHARES = [n for n, _, _ in TIME_FEATURES]


def _feats(t):
    return FT.session_features(FT.style1_events(t.clicks, t.labels, t.specs))


def _rounded(df):
    return df.withColumns({c: round6(c) for c in SHARES if c in df.columns})


@query("a1_total_time", "select game_session, cast(sum(game_time) as bigint) total_time from s1c group by game_session",
       ctes=S1)
def a1(t):
    return FT.style1_events(t.clicks, t.labels, t.specs).groupBy(SESSION).agg(FT.total_time())


@query("a2_conditional_time", "select game_session, " + ", ".join(
    f"cast(coalesce(sum(case when event_action = {a} and event_type = {tt} then game_time end), 0) as bigint) {n}"
    for n, a, tt in TIME_FEATURES) + " from s1c group by game_session", ctes=S1)
def a2(t):
    ev = FT.style1_events(t.clicks, t.labels, t.specs)
    return ev.groupBy(SESSION).agg(*[F.coalesce(F.sum(F.when(FT._pair(a, tt), F.col("game_time"))), F.lit(0))
                                     .alias(n) for n, a, tt in TIME_FEATURES])


@query("a3_time_share", f"select game_session, {', '.join(SHARES)} from feats", ctes=FEATS)
def a3(t):
    return _rounded(_feats(t)).select(SESSION, *SHARES)


@query("a4_conditional_counts", "select game_session, " + ", ".join(n for n, _, _ in COUNT_FEATURES) + " from feats",
       ctes=FEATS)
def a4(t):
    return _feats(t).select(SESSION, *[n for n, _, _ in COUNT_FEATURES])


@query("a5_session_features", "select * from feats", ctes=FEATS)
def a5(t):
    return _rounded(_feats(t))


# Sessions that span worlds, and events and labels with nulls: every sixth event is
# in another world, and some rows have no time, no title or a label without result.
ODD = """wc as (select * replace (case when src_id % 6 = 0 then 'NONE' else world end as world,
  case when src_id % 11 = 0 then null else game_time end as game_time,
  case when src_id % 17 = 0 then null else title end as title) from clicks),
wl as (select * replace (case when installation_id % 13 = 0 then null else accuracy_group end as accuracy_group)
  from assessment_labels),
w1 as (select c.installation_id, c.game_session, c.world, c.event_code, l.accuracy_group, c.event_count, c.src_id,
  c.event_id, c.game_time from wc c join wl l using (installation_id, game_session)
  where c.game_time is not null and c.title is not null and l.accuracy_group is not null)"""
ODD_GAPS = """w1g as (select w1.* exclude (game_time), s.event_type, s.event_action, coalesce(abs(game_time - lead(game_time) over (
  partition by installation_id, game_session order by event_count, src_id)), 0) game_time from w1 join specs s using (event_id)),
w1c as (select * from w1g where game_time < 600000 and event_code not in (4100, 4110))"""


def _odd(t):
    blank = lambda cond, c: F.when(~cond, F.col(c))
    c = t.clicks.withColumns({
        "world": F.when(F.col("src_id") % 6 == 0, "NONE").otherwise(F.col("world")),
        "game_time": blank(F.col("src_id") % 11 == 0, "game_time"),
        "title": blank(F.col("src_id") % 17 == 0, "title")})
    return c, t.labels.withColumn("accuracy_group", blank(F.col(KEY) % 13 == 0, "accuracy_group"))


@query("a5_features_of_mixed_worlds", f"select * from ({_feature_sql('w1c')})", ctes=f"{ODD}, {ODD_GAPS}")
def a5_worlds(t):
    return _rounded(FT.session_features(FT.style1_events(*_odd(t), t.specs)))


@query("j7_drop_incomplete", "select src_id, accuracy_group from w1", ctes=ODD)
def j7_incomplete(t):
    c, labels = _odd(t)
    d = R.complete_labelled_events(c.withColumn("_range", R.position_bucket()), labels, ["accuracy_group"], "_range")
    return d.select("src_id", "accuracy_group")


HIST = """lp as (select * from clicks where installation_id in (select installation_id from assessment_labels)),
j8 as (select c.*, l.title label_title, l.num_correct, l.num_incorrect, l.accuracy, l.accuracy_group
  from lp c left join assessment_labels l using (installation_id, game_session)),
st as (select l.*, s.start from assessment_labels l join (select installation_id, game_session, min(ts) start
  from clicks group by installation_id, game_session) s using (installation_id, game_session)),
hist as (select j.src_id, j.installation_id, j.game_session, j.ts, j.event_count, j.event_code,
  coalesce(j.accuracy_group, n.accuracy_group) accuracy_group
  from j8 j asof left join st n on j.installation_id = n.installation_id and j.ts < n.start)"""


@query("a6_mean_label", "select installation_id, game_session, round(avg(accuracy_group), 6) accuracy_group "
       "from hist where accuracy_group is not null group by installation_id, game_session", ctes=HIST)
def a6(t):
    h = R.complete_rows(t.history(), ["accuracy_group"])
    return FT.mean_label(h, [KEY, SESSION]).withColumn("accuracy_group", round6("accuracy_group"))


@query("a12_rounded_mean", "select installation_id, round_even(avg(accuracy_group), 0) accuracy_group "
       "from assessment_labels group by installation_id")
def a12(t):
    return FT.rounded_mean(t.labels)


STARTS = ("st as (select l.*, s.start from assessment_labels l join (select installation_id, game_session, "
          "min(ts) start from clicks group by installation_id, game_session) s using (installation_id, game_session))")
PROFILE = (STARTS + ", fr as (select *, row_number() over (partition by installation_id, title order by start, "
           "game_session) r from st), prof as (select installation_id, "
           + ", ".join(f"max(case when title = '{tt}' and r = 1 then accuracy_group end) \"{tt}\""
                       for tt in ASSESSMENT_TITLES)
           + ", round_even(avg(accuracy_group), 0) accuracy_group from fr group by installation_id)")


def _profile(t):
    return FT.score_profile(t.starts)


@query("a13_score_profile", "select * from prof", ctes=PROFILE)
def a13(t):
    return _profile(t)


@query("f5_fill_profile", "select installation_id, accuracy_group, " + ", ".join(
    f"coalesce(cast(\"{tt}\" as double), (select round_even(avg(\"{tt}\"), 0) from prof)) \"{tt}\""
    for tt in ASSESSMENT_TITLES) + " from prof", ctes=PROFILE)
def f5(t):
    prof = _profile(t)
    return FT.fill_profile(prof, FT.fit_profile_fill(prof))


@query("f1_dummies", "select src_id, " + ", ".join(
    f"case when event_code = {c} then 1 else 0 end event_code_{c}" for c in (2000, 3010, 4020, 4070, 4100))
    + " from clicks")
def f1(t):
    values = FT.fit_values(t.clicks, "event_code")
    return FT.dummies(t.clicks, "event_code", values).select("src_id", *[f"event_code_{v}" for v in values])


@query("f2_label_onehot", "select game_session, " + ", ".join(
    f"case when accuracy_group = {c} then 1 else 0 end accuracy_group_{c}" for c in range(4))
    + " from assessment_labels")
def f2(t):
    return FT.label_onehot(t.labels).select(SESSION, *[f"accuracy_group_{c}" for c in range(4)])


_NUMBERS = ["total_time", *SHARES, *[n for n, _, _ in COUNT_FEATURES]]
_UNROUNDED = f"{S1}, feats as ({_feature_sql().replace('round(', '(').replace(', 6)', ')')})"


@query("f3_standardize", "select f.game_session, " + ", ".join(
    f"round(({c} - m_{c}) / case when s_{c} = 0 then 1 else s_{c} end, 6) {c}" for c in _NUMBERS)
    + " from feats f, (select " + ", ".join(f"avg({c}) m_{c}, stddev_pop({c}) s_{c}" for c in _NUMBERS)
    + " from feats where " + FRAC.format(seed=1, key="game_session") + " >= 0.15) st", ctes=_UNROUNDED)
def f3(t):
    feats = FT.split(_feats(t), SESSION)
    model = FT.Standardizer.fit(feats.where(F.col("split") == "train"), FT.FEATURE_COLS)
    return model.transform(feats).select(SESSION, *[round6(c).alias(c) for c in FT.FEATURE_COLS])


@query("f4_mean_normalize", "select src_id, round((game_time - m) / nullif(hi - lo, 0), 6) game_time from clicks, "
       "(select avg(game_time) m, max(game_time) hi, min(game_time) lo from clicks) s")
def f4(t):
    return FT.mean_normalize(t.clicks, "game_time").select("src_id", round6("game_time").alias("game_time"))


@query("f6_split", "select game_session, case when " + FRAC.format(seed=1, key="game_session")
       + " < 0.15 then 'test' else 'train' end split from assessment_labels")
def f6(t):
    return FT.split(t.labels, SESSION).select(SESSION, "split")


@query("f8_class_weights", "select game_session, case accuracy_group when 0 then 3.0 when 1 then 100.0 when 2 then 10.0 "
       "when 3 then 2.0 end weight from assessment_labels")
def f8(t):
    return FT.class_weights(t.labels).select(SESSION, "weight")


THIN = "not (accuracy_group = 3 and " + FRAC.format(seed=0, key="game_session") + " < 0.65)"


@query("f9_thin_class", f"select game_session, accuracy_group from feats where {THIN}", ctes=FEATS)
def f9(t):
    return FT.thin_class(_feats(t), SESSION).select(SESSION, "accuracy_group")


@query("u2_remove_sampled", f"select game_session from feats where {THIN}", ctes=FEATS)
def u2(t):
    feats = materialize(_feats(t), "style1-feats")      # read by both sides of the anti join
    sampled = feats.where((F.col("accuracy_group") == 3) & (hash_fraction(SESSION, 0) < 0.65))
    return R.remove_rows(feats, sampled, [SESSION]).select(SESSION)


@query("z1_style1_features", "select * exclude (world), " + ", ".join(
    f"case when world = '{w}' then 1 else 0 end world_{w}" for w in ("CRYSTALCAVES", "MAGMAPEAK", "TREETOPCITY"))
    + f" from feats where {THIN}", ctes=FEATS)
def z1(t):
    return _rounded(FT.style1_features(t.clicks, t.labels, t.specs))
