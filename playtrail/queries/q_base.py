"""Fixture views and sources/sinks."""

from pyspark.sql import functions as F

from playtrail.queries import query

CLICK_COLS = ("event_id, src_id, game_session, ts, installation_id, sno, event_count, event_code, "
              "src_type, game_time, title, type, world")


@query("fx_clicks", f"select {CLICK_COLS} from clicks")
def fx_clicks(t):
    return t.clicks


@query("fx_assessment_labels", "select * from assessment_labels")
def fx_assessment_labels(t):
    return t.labels


# ---------------------------------------------------------------- S1-S8: sources and sinks (round trips)

from pyspark.sql import types as T  # noqa: E402

from playtrail import sources as SRC  # noqa: E402
from playtrail.operators import labelling as L  # noqa: E402
from playtrail.operators import relational as R  # noqa: E402
from playtrail.schema import EVENT_ACTIONS, EVENT_TYPES  # noqa: E402
from playtrail.session import materialize, scratch_path  # noqa: E402
from playtrail.sources.fixtures import TEST_PLAYER_SQL  # noqa: E402

EVENT_DATA = "concat('{\"src_id\":', cast(src_id as varchar), ',\"src_type\":\"', src_type, '\"}')"
CSV_OUT = ("cast(event_id as varchar) event_id, game_session, date_trunc('millisecond', ts) ts, "
           f"{EVENT_DATA} event_data, cast(installation_id as varchar) installation_id, event_count, event_code, "
           "game_time, title, type, world")


def _as_reference_csv(df):
    """Events in the reference's file layout (ISO timestamp with Z, JSON event_data)."""
    return df.select(
        F.col("event_id").cast("string").alias("event_id"), "game_session",
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("timestamp"),
        F.concat(F.lit('{"src_id":'), F.col("src_id").cast("string"), F.lit(',"src_type":"'), F.col("src_type"),
                 F.lit('"}')).alias("event_data"),
        F.col("installation_id").cast("string").alias("installation_id"), "event_count", "event_code",
        "game_time", "title", "type", "world")


def _read_back(t, df, name, more=()):
    path = scratch_path(t.spark, name)
    SRC.write_csv(_as_reference_csv(df), path)
    back = SRC.read_clicks(t.spark, path)
    return back.select(*more, "event_id", "game_session", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_data",
                       "installation_id", "event_count", "event_code", "game_time", "title", "type", "world")


@query("s1_read_clicks", f"select place src_id, {CSV_OUT} from (select *, row_number() over (order by src_id) - 1 place from clicks) c")
def s1(t):
    """Files written in the order of ``src_id``; ids read back are places in the files."""
    return _read_back(t, t.clicks.orderBy("src_id"), "clicks-csv", ["src_id"])


TEST_SHAPE = ("lastas as (select installation_id, arg_max(game_session, (start, game_session)) game_session from "
              "(select installation_id, game_session, min(ts) start from clicks where type = 'Assessment' group by all) q "
              "group by installation_id)")


@query("s2_read_test_clicks", f"select {CSV_OUT} from clicks where {TEST_PLAYER_SQL} and event_count = 1 "
       "and (installation_id, game_session) in (select installation_id, game_session from lastas)", ctes=TEST_SHAPE)
def s2(t):
    return _read_back(t, t.test_clicks(), "test-csv")


@query("s3_read_labels", "select game_session, cast(installation_id as varchar) installation_id, title, num_correct, "
       "num_incorrect, round(accuracy, 6) accuracy, accuracy_group from assessment_labels")
def s3(t):
    path = scratch_path(t.spark, "labels-csv")
    SRC.write_csv(t.labels.withColumn("installation_id", F.col("installation_id").cast("string")), path)
    back = SRC.read_labels(t.spark, path)
    return back.withColumn("accuracy", F.round("accuracy", 6))


@query("s4_read_specs", "select c.src_id, s.event_type, s.event_action from clicks c join specs s using (event_id)")
def s4(t):
    path = scratch_path(t.spark, "specs-csv")
    SRC.write_csv(t.specs.withColumn("event_id", F.col("event_id").cast("string")), path)
    specs = SRC.read_specs(t.spark, path)
    clicks = t.clicks.withColumn("event_id", F.col("event_id").cast("string"))
    return R.with_specs(clicks, specs).select("src_id", "event_type", "event_action")


def _names(col, names):
    return "case " + col + " " + " ".join(f"when {k} then '{v}'" for k, v in names.items()) + " end"


@query("s4_read_named_specs", f"select c.src_id, {_names('s.event_type', EVENT_TYPES)} event_type, "
       f"{_names('s.event_action', EVENT_ACTIONS)} event_action from clicks c join specs s using (event_id)")
def s4_named(t):
    name = lambda c, names: F.create_map(*[F.lit(x) for kv in names.items() for x in kv])[F.col(c)].alias(c)
    path = scratch_path(t.spark, "named-specs-csv")
    SRC.write_csv(t.specs.select(F.col("event_id").cast("string"), name("event_type", EVENT_TYPES), name("event_action", EVENT_ACTIONS)), path)
    clicks = t.clicks.withColumn("event_id", F.col("event_id").cast("string"))
    return R.with_specs(clicks, SRC.read_specs(t.spark, path, named=True)).select("src_id", "event_type", "event_action")


HIST = """lp as (select * from clicks where installation_id in (select installation_id from assessment_labels)),
j8 as (select c.*, l.title label_title, l.num_correct, l.num_incorrect, l.accuracy, l.accuracy_group
  from lp c left join assessment_labels l using (installation_id, game_session)),
st as (select l.*, s.start from assessment_labels l join (select installation_id, game_session, min(ts) start
  from clicks group by installation_id, game_session) s using (installation_id, game_session)),
grp as (select *, row_number() over (order by start, installation_id, game_session) grp from st),
hist as (select j.src_id, j.installation_id, j.game_session, j.ts, j.type, coalesce(j.accuracy_group, n.accuracy_group)
  accuracy_group, case when j.accuracy_group is null then n.grp end grp
  from j8 j asof left join grp n on j.installation_id = n.installation_id and j.ts < n.start)"""


LABELLED = 'src_id, installation_id, game_session, ts, type, accuracy_group, grp "group"'


def _stored(t, name):
    path = scratch_path(t.spark, name)
    SRC.write_labelled(L.label_history(t.clicks, t.labels, materialized=False), path)
    return path


def _labelled(df):
    return df.select("src_id", "installation_id", "game_session", "ts", "type", "accuracy_group", "group")


@query("s5_write_labelled", f"select {LABELLED} from hist", ctes=HIST)
def s5(t):
    return _labelled(SRC.read_labelled(t.spark, _stored(t, "labelled-s5")))


@query("s5_overwrite_one_type", f"select {LABELLED.replace('grp', 'case when type <> ' + chr(39) + 'Game' + chr(39) + ' then grp end')} "
       "from hist", ctes=HIST)
def s5_overwrite(t):
    """The Game events are written anew without their groups; other types stay."""
    path = _stored(t, "labelled-s5o")
    games = SRC.read_labelled(t.spark, path, ["Game"])
    SRC.overwrite_labelled(materialize(games.withColumn("group", F.lit(None).cast("long")), "games"), path)
    return _labelled(SRC.read_labelled(t.spark, path))


@query("s6_read_labelled", f"select {LABELLED} from hist where type in ('Assessment', 'Activity')", ctes=HIST)
def s6(t):
    return _labelled(SRC.read_labelled(t.spark, _stored(t, "labelled-s6"), ["Assessment", "Activity"]))


SUBMISSION = T.StructType([T.StructField("installation_id", T.StringType()),
                           T.StructField("accuracy_group", T.IntegerType())])


@query("s7_write_submission", "select cast(installation_id as varchar) installation_id, cast(round_even(avg("
       "accuracy_group), 0) as int) accuracy_group from assessment_labels group by installation_id")
def s7(t):
    from playtrail.operators.features import rounded_mean
    pred = rounded_mean(t.labels).withColumn("accuracy_group", F.col("accuracy_group").cast("int"))
    path = scratch_path(t.spark, "submission")
    SRC.write_submission(pred, path)
    return t.spark.read.option("header", True).schema(SUBMISSION).csv(path)


@query("s8_preview", "select src_id, ts, installation_id, game_session, event_code from clicks "
       "order by ts, event_count, src_id limit 20")
def s8(t):
    return SRC.preview(t.clicks, 20).select("src_id", "ts", "installation_id", "game_session", "event_code")
