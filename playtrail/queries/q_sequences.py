"""Queries for sequences (A11, P12, P13, J5, X6-X14, U3) and the
sequence/matrix jobs (Z2, Z3, Z5-Z7)."""

from pyspark.sql import functions as F

from playtrail.functions.scalar import argmax, events_add, normalize_text, round6, sliced
from playtrail.operators import features as FT
from playtrail.operators import relational as R
from playtrail.operators import sequences as S
from playtrail.operators import style3 as ST3
from playtrail.queries import query
from playtrail.sources.fixtures import TEST_PLAYER_SQL, is_test_player
from playtrail.schema import ASSESSMENT_TITLES, KEY, MIN_SEQUENCE_CODES, SESSION, TOKEN_FILTERS
from playtrail.session import materialize, scratch_path

LP = "lp as (select * from clicks where installation_id in (select installation_id from assessment_labels))"
J8 = ("j8 as (select c.*, l.title label_title, l.num_correct, l.num_incorrect, l.accuracy, l.accuracy_group "
      "from lp c left join assessment_labels l using (installation_id, game_session))")
STARTS = ("st as (select l.*, s.start from assessment_labels l join (select installation_id, game_session, "
          "min(ts) start from clicks group by installation_id, game_session) s using (installation_id, game_session))")
GROUPS = "grp as (select *, row_number() over (order by start, installation_id, game_session) grp from st)"
HIST = f"""{LP}, {J8}, {STARTS}, {GROUPS},
hist as (select j.src_id, j.installation_id, j.game_session, j.ts, j.event_count, j.event_code,
  coalesce(j.num_correct, n.num_correct) num_correct, coalesce(j.accuracy_group, n.accuracy_group) accuracy_group,
  case when j.accuracy_group is null then n.grp end grp
  from j8 j asof left join grp n on j.installation_id = n.installation_id and j.ts < n.start),
h as (select * from hist where accuracy_group is not null)"""


def _seq_sql(src: str, k2: str, min_codes: int | None, label: str = "avg(accuracy_group)") -> str:
    """Oracle CTEs of P13 + J5 + X9-X11 over event rows ``src`` keyed by (installation_id, k2)."""
    having = f"having count(*) > {min_codes}" if min_codes is not None else ""
    return f"""
tok as (select installation_id, {k2} k2, cast(event_code as varchar) code, row_number() over
  (partition by installation_id, {k2} order by ts, event_count, src_id) pos from {src}),
len as (select installation_id, k2, count(*) n_codes from tok group by installation_id, k2 {having}),
lab as (select installation_id, {k2} k2, {label} accuracy_group from {src} group by installation_id, {k2}),
docs as (select * from len join lab using (installation_id, k2)),
kept as (select t.* from tok t semi join docs d using (installation_id, k2)),
fv as (select * from (select *, row_number() over (partition by code order by installation_id, k2, pos) r
  from kept) q where r = 1),
voc as (select code, count(*) n from kept group by code),
vocab as (select v.code, v.n, row_number() over (order by v.n desc, f.installation_id, f.k2, f.pos) id
  from voc v join fv f using (code)),
enc as (select k.*, v.id from kept k join vocab v using (code) where v.id < 200),
lastk as (select * from (select *, row_number() over (partition by installation_id, k2 order by pos desc) r
  from enc) q where r <= 400),
padded as (select installation_id, k2, count(*) c, string_agg(cast(id as varchar), ' ' order by pos) s
  from lastk group by installation_id, k2),
seqs as (select d.installation_id, d.k2, d.n_codes, d.accuracy_group,
  case when p.c is null then rtrim(repeat('0 ', 400)) else concat(repeat('0 ', 400 - p.c), p.s) end sequence
  from docs d left join padded p using (installation_id, k2))"""


def _seq_out(df, k2):
    return df.select(KEY, k2, "n_codes", round6("accuracy_group").alias("accuracy_group"),
                     F.array_join(F.transform("sequence", lambda x: x.cast("string")), " ").alias("sequence"))


def _history(t, **kw):
    return t.history(**kw)


def _style5(t):
    return S.style5_sequences(_history(t))


STYLE5 = f"{HIST}, {_seq_sql('h', 'game_session', 10)}"


@query("a11_code_sequence", "select installation_id, game_session, cast(row_number() over (partition by "
       "installation_id, game_session order by ts, event_count, src_id) as bigint) pos, cast(event_code as varchar) code "
       "from clicks")
def a11(t):
    return S.code_tokens(t.clicks, [KEY, SESSION])


@query("p12_positive_groups", "select src_id, grp \"group\" from hist where grp is not null", ctes=HIST)
def p12(t):
    return R.positive_groups(_history(t)).select("src_id", "group")


@query("p13_min_length", "select installation_id, game_session, count(*) n_codes from clicks group by all "
       "having count(*) > 10")
def p13(t):
    tokens = S.code_tokens(t.clicks, [KEY, SESSION])
    return R.min_length(S.sequence_lengths(tokens, [KEY, SESSION]), "n_codes", 10)


@query("j5_sequences_x_labels", "select installation_id, k2 game_session, n_codes, round(accuracy_group, 6) "
       "accuracy_group from docs", ctes=STYLE5)
def j5(t):
    rows = S._history_rows(_history(t))
    tokens = S.code_tokens(rows, [KEY, SESSION])
    lengths = R.min_length(S.sequence_lengths(tokens, [KEY, SESSION]), "n_codes", 10)
    docs = lengths.join(FT.mean_label(rows, [KEY, SESSION]), [KEY, SESSION], "inner")
    return docs.withColumn("accuracy_group", round6("accuracy_group"))


CHUNKS = ("ch as (select installation_id, game_session, cast((pos - 1) // 400 as bigint) chunk_no, "
          "string_agg(cast(event_code as varchar), ' ' order by pos) s "
          "from (select *, row_number() over (partition by installation_id, game_session order by "
          "ts, event_count, src_id) pos from clicks) q group by all)")


def _chunks(t):
    return S.code_chunks(S.code_tokens(t.clicks, [KEY, SESSION]), [KEY, SESSION])


@query("x6_sliced", "select installation_id, game_session, chunk_no, s codes from ch", ctes=CHUNKS)
def x6(t):
    d = _chunks(t).withColumn("_joined", F.array_join("codes", ""))
    return d.select(KEY, SESSION, "chunk_no", events_add(sliced("_joined", 4)).alias("codes"))


@query("x7_events_add", "select installation_id, game_session, chunk_no, s codes from ch", ctes=CHUNKS)
def x7(t):
    return _chunks(t).select(KEY, SESSION, "chunk_no", events_add("codes").alias("codes"))


_FILTERS_SQL = "'" + TOKEN_FILTERS.replace("\t", "").replace("\n", "") + "' || chr(9) || chr(10)"


@query("x8_normalize_text", f"select src_id, translate(lower(title), {_FILTERS_SQL}, "
       f"repeat(' ', {len(TOKEN_FILTERS)})) title from clicks")
def x8(t):
    return t.clicks.select("src_id", normalize_text("title").alias("title"))


@query("x9_fit_vocabulary", "select code, n, cast(id as int) id from vocab where id < 200", ctes=STYLE5)
def x9(t):
    rows = S._history_rows(_history(t))
    keys = [KEY, SESSION]
    tokens = S.code_tokens(rows, keys)
    docs = R.min_length(S.sequence_lengths(tokens, keys), "n_codes", 10).join(FT.mean_label(rows, keys), keys)
    return S.fit_vocabulary(tokens.join(docs.select(*keys), keys, "left_semi"), keys)


@query("x10_encode", "select installation_id, k2 game_session, pos, cast(id as int) id from enc", ctes=STYLE5)
def x10(t):
    rows = S._history_rows(_history(t))
    keys = [KEY, SESSION]
    tokens = S.code_tokens(rows, keys)
    docs = R.min_length(S.sequence_lengths(tokens, keys), "n_codes", 10).join(FT.mean_label(rows, keys), keys)
    kept = S.kept_tokens(tokens, docs, keys)
    return S.encode(kept, S.fit_vocabulary(kept, keys)).select(*keys, "pos", "id")


@query("x11_pad_sequence", "select installation_id, k2 game_session, sequence from seqs", ctes=STYLE5)
def x11(t):
    table, _ = _style5(t)
    return _seq_out(table, SESSION).select(KEY, SESSION, "sequence")


@query("z7_style5_sequences", "select installation_id, k2 game_session, n_codes, round(accuracy_group, 6) "
       "accuracy_group, sequence from seqs", ctes=STYLE5)
def z7(t):
    table, _ = _style5(t)
    return _seq_out(table, SESSION)


@query("z6_style4_sequences", "select installation_id, k2 \"group\", n_codes, round(accuracy_group, 6) accuracy_group, "
       "sequence from seqs", ctes=f"{HIST}, hg as (select * from h where grp is not null), {_seq_sql('hg', 'grp', 10)}")
def z6(t):
    table, _ = S.style4_sequences(_history(t))
    return _seq_out(table, "group")


@query("z3_style3_sequences", "select installation_id, k2 game_session, n_codes, round(accuracy_group, 6) "
       "accuracy_group, sequence from seqs",
       ctes="ev as (select c.*, l.accuracy_group from clicks c join assessment_labels l using (installation_id, "
            "game_session)), " + _seq_sql("ev", "game_session", None, "min(accuracy_group)"))
def z3(t):
    table, _ = S.style3_sequences(t.clicks, t.labels)
    return _seq_out(table, SESSION)


@query("z5_label_history", """
select src_id, installation_id, game_session, ts, event_count, event_code, num_correct, accuracy_group, grp "group"
from hist""", ctes=HIST)
def z5(t):
    # builds (or reads) the dataset's label history: the table styles 4 and 5 read
    return t.history().select("src_id", KEY, SESSION, "ts", "event_count", "event_code",
                                                      "num_correct", "accuracy_group", "group")


# ---------------------------------------------------------------- style 2 matrices

CODES = (2000, 3010, 4020, 4070, 4100)
TYPES2 = ("Activity", "Game")


def _style2_sql(n: int) -> str:
    dums = ([f"case when event_code = {c} then 1 else 0 end" for c in CODES]
            + [f"case when title = '{x}' then 1 else 0 end" for x in ASSESSMENT_TITLES]
            + [f"case when type = '{x}' then 1 else 0 end" for x in TYPES2])
    width = 2 + len(dums)
    pad = " ".join(["-1"] * width)
    return f"""{LP}, {STARTS},
play as (select * from lp where game_session not in (select game_session from assessment_labels)),
ll as (select installation_id, accuracy_group from (select *, row_number() over (partition by installation_id
  order by start desc, game_session desc) r from st) q where r = 1),
d as (select p.*, ll.accuracy_group from play p left join ll using (installation_id)),
lastn as (select * from (select *, row_number() over (partition by installation_id order by ts desc,
  event_count desc, src_id desc) rn from d) q where rn <= {n}),
rws as (select installation_id, accuracy_group, rn, concat_ws(' ', event_count, game_time, {", ".join(dums)}) rs
  from lastn),
m as (select installation_id, min(accuracy_group) accuracy_group, count(*) n_rows,
  string_agg(rs, ' ' order by rn desc) s from rws group by installation_id),
mat as (select installation_id, accuracy_group, n_rows,
  concat(s, repeat(' {pad}', {n} - cast(n_rows as int))) features from m)"""


def _flat_text(col):
    return F.array_join(F.transform(col, lambda x: x.cast("long").cast("string")), " ")


@query("x14_player_matrix", "select installation_id, accuracy_group, s features from m where n_rows = 40",
       ctes=_style2_sql(40))
def x14(t):
    rows, _ = S.style2_rows(t.clicks, t.labels, 40)
    m = S.player_matrix(rows, 40, pad=False)
    return m.select(KEY, "accuracy_group", _flat_text(F.flatten("matrix")).alias("features"))


@query("u3_pad_rows", "select installation_id, cast(70 - n_rows as int) pad_rows from m", ctes=_style2_sql(70))
def u3(t):
    rows, _ = S.style2_rows(t.clicks, t.labels, 70)
    m = S.player_matrix(rows, 70, pad=True)
    return m.select(KEY, (F.size("matrix") - F.col("n_rows")).cast("int").alias("pad_rows"))


@query("x13_flatten_player", "select installation_id, accuracy_group, features from mat", ctes=_style2_sql(70))
def x13(t):
    rows, _ = S.style2_rows(t.clicks, t.labels, 70)
    flat = S.flatten_player(S.player_matrix(rows, 70, pad=True))
    return flat.select(KEY, "accuracy_group", _flat_text("features").alias("features"))


@query("z2_style2_last_events", "select installation_id, accuracy_group, features from mat", ctes=_style2_sql(300))
def z2(t):
    flat = S.style2_last_events(t.clicks, t.labels, 300)
    return flat.select(KEY, "accuracy_group", _flat_text("features").alias("features"))


PROFILE = (STARTS + ", fr as (select *, row_number() over (partition by installation_id, title order by start, "
           "game_session) r from st), prof as (select installation_id, "
           + ", ".join(f"max(case when title = '{tt}' and r = 1 then accuracy_group end) \"{tt}\""
                       for tt in ASSESSMENT_TITLES)
           + " from fr group by installation_id), filled as (select installation_id, "
           + ", ".join(f"coalesce(cast(\"{tt}\" as double), (select round_even(avg(\"{tt}\"), 0) from prof)) \"{tt}\""
                       for tt in ASSESSMENT_TITLES) + " from prof)")


@query("x12_argmax", "select installation_id, cast(list_position(l, list_max(l)) - 1 as int) best_title from "
       "(select installation_id, [" + ", ".join(f"\"{tt}\"" for tt in ASSESSMENT_TITLES) + "] l from filled) q",
       ctes=PROFILE)
def x12(t):
    prof = FT.score_profile(t.starts)
    filled = FT.fill_profile(prof, FT.fit_profile_fill(prof))
    arr = F.array(*[F.col(f"`{tt}`") for tt in ASSESSMENT_TITLES])
    return filled.select(KEY, argmax(arr).alias("best_title"))




# ---------------------------------------------------------------- fit on train, apply to test (style 3)

def _seq_sql_split(src: str, train: str, test: str) -> str:
    """Style-3 oracle CTEs: vocabulary fitted on the ``train`` sessions of ``src``,
    applied to the ``test`` sessions."""
    return f"""
tok as (select installation_id, game_session k2, cast(event_code as varchar) code, row_number() over
  (partition by installation_id, game_session order by ts, event_count, src_id) pos from {src}),
tr as (select * from tok where {train}),
fv as (select * from (select *, row_number() over (partition by code order by installation_id, k2, pos) r
  from tr) q where r = 1),
voc as (select code, count(*) n from tr group by code),
vocab as (select v.code, v.n, row_number() over (order by v.n desc, f.installation_id, f.k2, f.pos) id
  from voc v join fv f using (code)),
te as (select * from tok where {test}),
len as (select installation_id, k2, count(*) n_codes from te group by installation_id, k2),
enc as (select k.*, v.id from te k join vocab v using (code) where v.id < 200),
lastk as (select * from (select *, row_number() over (partition by installation_id, k2 order by pos desc) r
  from enc) q where r <= 400),
padded as (select installation_id, k2, count(*) c, string_agg(cast(id as varchar), ' ' order by pos) s
  from lastk group by installation_id, k2),
seqs as (select l.installation_id, l.k2, l.n_codes,
  case when p.c is null then rtrim(repeat('0 ', 400)) else concat(repeat('0 ', 400 - p.c), p.s) end sequence
  from len l left join padded p using (installation_id, k2))"""


@query("z3_style3_test_sequences", "select installation_id, k2 game_session, n_codes, sequence from seqs",
       ctes="ev as (select c.* from clicks c left join assessment_labels l using (installation_id, game_session) "
            f"where case when {TEST_PLAYER_SQL} then c.type = 'Assessment' else l.accuracy_group is not null end), "
            + _seq_sql_split("ev", f"not ({TEST_PLAYER_SQL})", TEST_PLAYER_SQL))
def z3_test(t):
    """Z3 on held-out players, whose labels are not read: the vocabulary of the train
    players' assessment sequences is saved and applied to the test players' ones."""
    path = scratch_path(t.spark, "style3-state")
    ST3.fit_vocabulary(t.player_clicks(test=False), t.labels, path)
    table = ST3.test_sequences(t.player_clicks(test=True), path)
    return table.select(KEY, SESSION, "n_codes",
                        F.array_join(F.transform("sequence", lambda x: x.cast("string")), " ").alias("sequence"))


@query("z7_style5_test_sequences", "select installation_id, k2 game_session, n_codes, sequence from seqs",
       ctes=HIST + ", both_ as (select installation_id, game_session, ts, event_count, src_id, event_code from h "
            f"where not ({TEST_PLAYER_SQL}) union all select installation_id, game_session, ts, event_count, src_id, event_code "
            f"from clicks where {TEST_PLAYER_SQL}), "
            "ev as (select * from both_ qualify count(*) over (partition by installation_id, game_session) > 10), "
            + _seq_sql_split("ev", f"not ({TEST_PLAYER_SQL})", TEST_PLAYER_SQL))
def z7_test(t):
    """Z7 on held-out players, whose labels are not read: every session of more than
    ten codes, in the ids of the train players' vocabulary."""
    _, vocab = S.style5_sequences(t.history().where(~is_test_player(KEY)))
    table = S.unlabelled_sequences(t.player_clicks(test=True), materialize(vocab, "vocabulary"), [KEY, SESSION], MIN_SEQUENCE_CODES)
    return table.select(KEY, SESSION, "n_codes",
                        F.array_join(F.transform("sequence", lambda x: x.cast("string")), " ").alias("sequence"))


@query("a6_last_label", "select installation_id, game_session, arg_max(accuracy_group, (ts, event_count, src_id)) accuracy_group "
       "from h group by installation_id, game_session", ctes=HIST)
def a6_last(t):
    """A6 with the label of a session's last event in place of the mean."""
    return FT.mean_label(S._history_rows(_history(t)), [KEY, SESSION], mixed="last")


@query("z5_history_with_assessments", "select j.src_id, coalesce(j.accuracy_group, n.accuracy_group) accuracy_group, "
       "coalesce(o.grp, case when j.accuracy_group is null then n.grp end) \"group\" from j8 j asof left join grp n "
       "on j.installation_id = n.installation_id and j.ts < n.start left join grp o on j.accuracy_group is not null "
       "and o.installation_id = j.installation_id and o.game_session = j.game_session", ctes=HIST)
def z5_with(t):
    """Z5 where an assessment's own events belong to its group."""
    return t.history(include_assessment=True).select("src_id", "accuracy_group", "group")
