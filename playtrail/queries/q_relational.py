"""Queries for projection/filter (P), joins (J), simple aggregates (A7-A17),
windows (W) and frame operations (U)."""

from pyspark.sql import functions as F

from playtrail.functions.scalar import code_text, round6, round_half_even, to_int
from playtrail.operators import labelling as L
from playtrail.operators import relational as R
from playtrail.operators import sketches as SK
from playtrail.queries import query
from playtrail.session import materialize
from playtrail.schema import KEY, SESSION

LP = "lp as (select * from clicks where installation_id in (select installation_id from assessment_labels))"
J8 = ("j8 as (select c.*, l.title label_title, l.num_correct, l.num_incorrect, l.accuracy, l.accuracy_group "
      "from lp c left join assessment_labels l using (installation_id, game_session))")
STARTS = ("st as (select l.*, s.start from assessment_labels l join (select installation_id, game_session, "
          "min(ts) start from clicks group by installation_id, game_session) s using (installation_id, game_session))")
GROUPS = "grp as (select *, row_number() over (order by start, installation_id, game_session) grp from st)"
GAPS = ("gaps as (select *, coalesce(abs(game_time - lead(game_time) over (partition by installation_id, "
        "game_session order by event_count, src_id)), 0) gap from clicks)")


def _j8(t):
    return R.left_labels(R.labelled_players(t.clicks, t.labels), t.labels)


# ---------------------------------------------------------------- P

@query("p1_project", "select src_id, installation_id, game_session, event_code from clicks")
def p1(t):
    return R.project(t.clicks, ["src_id", KEY, SESSION, "event_code"])


@query("p2_without", "select event_id, src_id, game_session, installation_id, sno, event_count, event_code, "
                     "src_type, game_time from clicks")
def p2(t):
    return R.without(t.clicks, ["ts", "title", "type", "world"])


@query("p3_rename", "select src_id, game_time elapsed, event_code code from clicks")
def p3(t):
    return R.rename(t.clicks, {"game_time": "elapsed", "event_code": "code"}).select("src_id", "elapsed", "code")


@query("p4_code_text", "select src_id, cast(event_code as varchar) code_text from clicks")
def p4(t):
    return t.clicks.select("src_id", code_text("event_code").alias("code_text"))


@query("p5_constant", "select src_id, 'train' part from clicks")
def p5(t):
    return R.with_constant(t.clicks, "part", "train").select("src_id", "part")


@query("p6_complete_rows", "select src_id, installation_id, game_session, label_title, num_correct, num_incorrect, "
       "round(accuracy, 6) accuracy, accuracy_group from j8 where label_title is not null and num_correct is not null "
       "and num_incorrect is not null and accuracy is not null and accuracy_group is not null", ctes=f"{LP}, {J8}")
def p6(t):
    cols = ["src_id", KEY, SESSION, "label_title", "num_correct", "num_incorrect", "accuracy", "accuracy_group"]
    return R.complete_rows(_j8(t).select(*cols)).withColumn("accuracy", round6("accuracy"))


@query("p7_fill_zero", "select src_id, coalesce(num_correct, 0) num_correct, coalesce(num_incorrect, 0) num_incorrect, "
       "round(coalesce(accuracy, 0), 6) accuracy, coalesce(accuracy_group, 0) accuracy_group from j8",
       ctes=f"{LP}, {J8}")
def p7(t):
    d = R.fill_zero(_j8(t), ["num_correct", "num_incorrect", "accuracy", "accuracy_group"])
    return d.select("src_id", "num_correct", "num_incorrect", round6("accuracy").alias("accuracy"), "accuracy_group")


@query("p8_drop_idle", "select src_id, gap from gaps where gap < 600000", ctes=GAPS)
def p8(t):
    return R.drop_idle(R.time_to_next(t.clicks, out="gap"), "gap").select("src_id", "gap")


@query("p9_pair_filter", "select c.src_id, c.event_id from clicks c join specs s using (event_id) "
       "where s.event_action = 5 and s.event_type = 2")
def p9(t):
    return R.pair_filter(R.with_specs(t.clicks, t.specs), 5, 2).select("src_id", "event_id")


@query("p10_only_type", "select src_id, game_session from clicks where type = 'Assessment'")
def p10(t):
    return R.only_type(t.clicks).select("src_id", SESSION)


@query("p11_drop_codes", "select src_id, event_code from clicks where event_code not in (4100, 4110)")
def p11(t):
    return R.drop_codes(t.clicks).select("src_id", "event_code")


@query("p14_update_where", "select src_id, coalesce(accuracy_group, -1) accuracy_group, "
       "case when accuracy_group is null then 'none' else label_title end label_title from j8", ctes=f"{LP}, {J8}")
def p14(t):
    d = _j8(t)
    d = R.update_where(d, R.is_unlabelled(), {"accuracy_group": -1, "label_title": "none"})
    return d.select("src_id", "accuracy_group", "label_title")


@query("p15_null_test", "select installation_id, cast(count(*) filter (where accuracy_group is null) as bigint) "
       "n_unlabelled from j8 group by installation_id", ctes=f"{LP}, {J8}")
def p15(t):
    return _j8(t).groupBy(KEY).agg(F.count_if(R.is_unlabelled()).alias("n_unlabelled"))


@query("p16_distinct_rows", "select distinct game_session, world, installation_id from clicks")
def p16(t):
    return R.distinct_rows(t.clicks, [SESSION, "world", KEY])


@query("p17_first_per_key", "select installation_id, game_session, src_id, event_code, ts from "
       "(select *, row_number() over (partition by installation_id, game_session order by event_count, src_id) r "
       "from clicks) q where r = 1")
def p17(t):
    return R.first_per_key(t.clicks, [KEY, SESSION], ["event_count", "src_id"], ["src_id", "event_code", "ts"])


@query("p18_count_equal", "select cast(count(*) as bigint) n_equal from (select installation_id, game_session from "
       "clicks join assessment_labels using (installation_id, game_session) group by installation_id, game_session "
       "having count(*) = 1 and min(event_code) = 2000) q")
def p18(t):
    seq = R.events_with_labels(t.clicks, t.labels).groupBy(KEY, SESSION).agg(
        F.count(F.lit(1)).alias("n"), F.min("event_code").alias("c"))
    return seq.agg(F.count_if((F.col("n") == 1) & (F.col("c") == 2000)).alias("n_equal"))


@query("p19_cast_round", "select installation_id, cast(round_even(avg(accuracy_group), 0) as int) mean_group "
       "from assessment_labels group by installation_id")
def p19(t):
    return t.labels.groupBy(KEY).agg(to_int(round_half_even(F.avg("accuracy_group"))).alias("mean_group"))


# ---------------------------------------------------------------- J

@query("j1_labelled_players", "select src_id, installation_id from lp", ctes=LP)
def j1(t):
    return R.labelled_players(t.clicks, t.labels).select("src_id", KEY)


@query("j2_prior_play", "select src_id, game_session from lp where game_session not in "
       "(select game_session from assessment_labels)", ctes=LP)
def j2(t):
    return R.prior_play(R.labelled_players(t.clicks, t.labels), t.labels).select("src_id", SESSION)


@query("j3_multi_event_sessions", "select src_id from clicks where type = 'Assessment' and "
       "(installation_id, game_session) in (select installation_id, game_session from clicks where type = "
       "'Assessment' group by all having count(*) > 1)")
def j3(t):
    return R.multi_event_sessions(R.only_type(t.clicks)).select("src_id")


@query("j4_events_x_labels", "select c.src_id, installation_id, game_session, l.accuracy_group, l.num_correct "
       "from clicks c join assessment_labels l using (installation_id, game_session)")
def j4(t):
    return R.events_with_labels(t.clicks, t.labels).select("src_id", KEY, SESSION, "accuracy_group", "num_correct")


@query("j6_specs_join", "select c.src_id, event_id, s.event_type, s.event_action from clicks c join specs s using (event_id)")
def j6(t):
    return R.with_specs(t.clicks, t.specs).select("src_id", "event_id", "event_type", "event_action")


@query("j7_outer_then_complete", "select c.src_id, l.accuracy_group, c.world from lp c join assessment_labels l "
       "using (installation_id, game_session)", ctes=LP)
def j7(t):
    d = R.events_with_labels(R.labelled_players(t.clicks, t.labels), t.labels)
    return R.complete_rows(d.select("src_id", "accuracy_group", "world"))


@query("j8_left_join_both_keys", "select src_id, title, label_title, accuracy_group from j8", ctes=f"{LP}, {J8}")
def j8(t):
    return _j8(t).select("src_id", "title", "label_title", "accuracy_group")


@query("j9_player_last_label", "select c.src_id, q.game_session label_session, q.accuracy_group from lp c left join "
       "(select *, row_number() over (partition by installation_id order by start desc, game_session desc) r from st) q "
       "on q.installation_id = c.installation_id and q.r = 1", ctes=f"{LP}, {STARTS}")
def j9(t):
    starts = L.assessment_starts(t.clicks, t.labels)
    clicks = R.labelled_players(t.clicks, t.labels)
    return R.player_last_label(clicks, starts, order=("start", SESSION)).select("src_id", "label_session",
                                                                                "accuracy_group")


@query("j10_label_by_next", """
select j.src_id, j.installation_id, j.game_session, j.label_title,
  coalesce(j.num_correct, n.num_correct) num_correct, coalesce(j.num_incorrect, n.num_incorrect) num_incorrect,
  round(coalesce(j.accuracy, n.accuracy), 6) accuracy, coalesce(j.accuracy_group, n.accuracy_group) accuracy_group,
  case when j.accuracy_group is null then n.grp end "group"
from j8 j asof left join grp n on j.installation_id = n.installation_id and j.ts < n.start""",
       ctes=f"{LP}, {J8}, {STARTS}, {GROUPS}")
def j10(t):
    d = L.label_by_next(t.clicks, t.labels)
    return d.select("src_id", KEY, SESSION, "label_title", "num_correct", "num_incorrect",
                    round6("accuracy").alias("accuracy"), "accuracy_group", "group")


@query("j11_key_aligned_update", "select s.installation_id, s.game_session, coalesce(a.total_time, 0) total_time from "
       "(select distinct installation_id, game_session from clicks) s left join (select installation_id, game_session, "
       "cast(sum(game_time) as bigint) total_time from clicks where type = 'Assessment' group by all) a "
       "using (installation_id, game_session)")
def j11(t):
    base = R.distinct_rows(t.clicks, [KEY, SESSION]).withColumn("total_time", F.lit(0).cast("long"))
    upd = R.only_type(t.clicks).groupBy(KEY, SESSION).agg(F.sum("game_time").alias("total_time"))
    return R.key_aligned_update(base, upd, [KEY, SESSION], ["total_time"])


# ---------------------------------------------------------------- A (simple)

@query("a7_rows_per_key", "select installation_id, game_session, count(*) n from clicks group by all")
def a7(t):
    return R.rows_per_key(t.clicks, [KEY, SESSION])


@query("a8_having_count", "select installation_id, game_session, count(*) n from clicks where type = 'Assessment' "
       "group by all having count(*) > 1")
def a8(t):
    return R.having_count(R.only_type(t.clicks), [KEY, SESSION], 1)


@query("a9_distinct_counts", "select count(distinct game_session) n_game_session, count(distinct installation_id) "
       "n_installation_id from clicks where type = 'Assessment'")
def a9(t):
    return R.distinct_counts(R.only_type(t.clicks), [SESSION, KEY])


@query("a9_distinct_sketches", "select world, count(distinct game_session) exact_game_session, count(distinct installation_id) "
       "exact_installation_id, true near from clicks group by world")
def a9_sketches(t):
    """Sketches stored per (world, type), merged per world, next to the exact counts:
    ``near`` where both estimates are within four standard errors."""
    stored = materialize(SK.distinct_sketches(t.clicks, ["world", "type"], [SESSION, KEY]), "distinct-sketches")
    rough = SK.distinct_estimates(SK.merge_distinct(stored, ["world"], [SESSION, KEY]), [SESSION, KEY])
    exact = t.clicks.groupBy("world").agg(*[F.countDistinct(c).alias(f"exact_{c}") for c in (SESSION, KEY)])
    off = lambda c: F.abs(F.col(f"n_{c}") - F.col(f"exact_{c}")) <= 4 * 1.04 / 2 ** (SK.HLL_LG_K / 2) * F.col(f"exact_{c}") + 1
    return exact.join(rough, "world").select("world", f"exact_{SESSION}", f"exact_{KEY}", (off(SESSION) & off(KEY)).alias("near"))


@query("a10_distinct_keys", "select distinct installation_id from assessment_labels")
def a10(t):
    return R.distinct_rows(t.labels, [KEY])


@query("a14_column_stats", "select round(avg(game_time), 6) mean_game_time, max(game_time) max_game_time, "
       "min(game_time) min_game_time, round(avg(event_count), 6) mean_event_count, max(event_count) max_event_count, "
       "min(event_count) min_event_count from clicks")
def a14(t):
    d = R.column_stats(t.clicks, ["game_time", "event_count"])
    return d.withColumns({c: round6(c) for c in ("mean_game_time", "mean_event_count")})


@query("a15_median", "select round(median(game_time), 6) median_game_time from clicks")
def a15(t):
    return R.column_median(t.clicks, "game_time").withColumn("median_game_time", round6("median_game_time"))


@query("a15_quantile_sketches", "select type, count(game_time) n, true near from clicks group by type")
def a15_sketches(t):
    """Sketches stored per (type, world), merged per type: ``near`` where the ranks of
    the estimated quartiles are within the rank error of the sketch."""
    stored = materialize(SK.quantile_sketches(t.clicks, ["type", "world"], "game_time"), "quantile-sketches")
    whole = SK.merge_quantiles(stored, ["type"], "game_time")
    shares = (0.25, 0.5, 0.75)
    rough = whole.select("type", SK.sketched_rows("game_time").alias("n"),
                         *[SK.quantile("game_time", p).alias(f"q{i}") for i, p in enumerate(shares)])
    rows = t.clicks.select("type", "game_time").join(F.broadcast(rough), "type")       # one row per type
    ranks = rows.groupBy("type", "n").agg(*[f(F.col("game_time") - F.col(f"q{i}")).alias(f"{name}{i}")
                                            for i in range(len(shares)) for name, f in (("below", lambda d: F.count_if(d < 0)),
                                                                                        ("upto", lambda d: F.count_if(d <= 0)))])
    near = F.lit(True)
    for i, p in enumerate(shares):
        slack = F.col("n") * SK.KLL_RANK_ERROR + 1
        near = near & (F.col(f"below{i}") <= F.col("n") * p + slack) & (F.col(f"upto{i}") >= F.col("n") * p - slack)
    return ranks.select("type", "n", near.alias("near"))


@query("a16_histogram", """
select cast(bin as int) bin, round(lo + bin * w, 6) lower, count(*) n from (
  select lo, w, least(floor((accuracy - lo) / w), 9) bin from assessment_labels,
    (select min(accuracy) lo, case when max(accuracy) > min(accuracy) then (max(accuracy) - min(accuracy)) / 10
      else 1.0 end w from assessment_labels) b) q group by bin, lo, w""")
def a16(t):
    return R.histogram(t.labels, "accuracy", 10).withColumn("lower", round6("lower"))


@query("a17_counts", "select count(*) n_rows, count(distinct event_code) n_codes, count(distinct game_session) "
       "n_sessions from clicks")
def a17(t):
    return t.clicks.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("event_code").alias("n_codes"),
                        F.countDistinct(SESSION).alias("n_sessions"))


# ---------------------------------------------------------------- W

@query("w1_time_to_next", "select src_id, gap from gaps", ctes=GAPS)
def w1(t):
    return R.time_to_next(t.clicks, out="gap").select("src_id", "gap")


@query("w2_last_n", "select installation_id, src_id, cast(rn as int) rn_desc from (select *, row_number() over "
       "(partition by installation_id order by ts desc, event_count desc, src_id desc) rn from clicks) q where rn <= 40")
def w2(t):
    return R.last_events(t.clicks, 40).select(KEY, "src_id", "rn_desc")


@query("w3_last_per_key", "select installation_id, game_session, accuracy_group from (select *, row_number() over "
       "(partition by installation_id order by start desc, game_session desc) r from st) q where r = 1", ctes=STARTS)
def w3(t):
    return R.last_label(L.assessment_starts(t.clicks, t.labels), ("start", SESSION))


@query("w4_session_start", "select installation_id, game_session, min(ts) start from clicks group by all")
def w4(t):
    return R.session_starts(t.clicks)


@query("w5_sort_sessions", "select src_id, game_session, event_count, row_number() over (partition by installation_id, "
       "game_session order by event_count, src_id) as position from clicks")
def w5(t):
    return R.sorted_positions(t.clicks).select("src_id", SESSION, "event_count", "position")


@query("w6_assessment_groups", "select installation_id, game_session, start, grp \"group\" from grp",
       ctes=f"{STARTS}, {GROUPS}")
def w6(t):
    return L.assessment_groups(L.assessment_starts(t.clicks, t.labels)).select(KEY, SESSION, "start", "group")


@query("w7_kfold", "select installation_id, game_session, cast(ntile(5) over (order by installation_id, game_session) "
       "as int) fold from assessment_labels")
def w7(t):
    return R.kfold(t.labels, 5).select(KEY, SESSION, "fold")


# ---------------------------------------------------------------- U

@query("u1_side_by_side", "select src_id, case when type = 'Activity' then 1 else 0 end type_Activity, "
       "case when type = 'Assessment' then 1 else 0 end type_Assessment, case when type = 'Game' then 1 else 0 end "
       "type_Game from clicks")
def u1(t):
    cols = {f"type_{v}": F.when(F.col("type") == v, 1).otherwise(0) for v in ("Activity", "Assessment", "Game")}
    return R.side_by_side(t.clicks, cols).select("src_id", *cols)


# ---------------------------------------------------------------- X1-X5 (scalar functions over clicks and labels)

from playtrail.functions.scalar import abs_value, parse_timestamp, safe_divide  # noqa: E402

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


@query("x1_abs", "select src_id, abs(game_time - 600000) to_idle from clicks")
def x1(t):
    return t.clicks.select("src_id", abs_value(F.col("game_time") - 600000).alias("to_idle"))


@query("x2_divide", "select game_session, round(case when num_incorrect = 0 then null else "
       "cast(num_correct as double) / num_incorrect end, 6) ratio from assessment_labels")
def x2(t):
    return t.labels.select(SESSION, round6(safe_divide("num_correct", "num_incorrect")).alias("ratio"))


@query("x3_round_half_even", "select game_session, round_even(accuracy * 4, 0) r from assessment_labels")
def x3(t):
    return t.labels.select(SESSION, round_half_even(F.col("accuracy") * 4).alias("r"))


@query("x4_to_timestamp", "select src_id, date_trunc('millisecond', ts) ts from clicks")
def x4(t):
    iso = F.date_format(F.col("ts").cast("timestamp"), ISO)
    return t.clicks.select("src_id", parse_timestamp(iso).cast("timestamp_ntz").alias("ts"))


@query("x5_iso_order", "select installation_id, game_session, strftime(min(ts), '%Y-%m-%dT%H:%M:%S.%g') || 'Z' "
       "first_iso from clicks group by all")
def x5(t):
    iso = F.date_format(F.col("ts").cast("timestamp"), ISO)
    return t.clicks.groupBy(KEY, SESSION).agg(F.min(iso).alias("first_iso"))
