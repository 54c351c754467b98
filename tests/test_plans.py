"""Physical-plan properties the design relies on."""

import re

from pyspark.sql import functions as F

from conftest import SF_MID
from playtrail.operators import relational as R
from playtrail.operators import sequences as S
from playtrail.plans import ordered as O
from playtrail.schema import KEY, SESSION
from playtrail.sources.fixtures import Tables, clicks


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_sessionize_shuffles_full_rows_once(spark):
    ev = spark.read.parquet(f"{SF_MID}/events.parquet")
    text = _formatted(clicks(ev))
    inputs = re.findall(r"\(\d+\) Exchange\s*\nInput \[\d+\]: \[([^\]]*)\]", text)
    # exactly one exchange carries event rows (their event_type payload); the
    # others carry the per-(key, bucket) summary only
    rows = [i for i in inputs if "event_type" in i]
    assert len(inputs) >= 2 and len(rows) == 1, inputs
    assert "HashAggregate" in text


def test_last_events_limits_before_shuffle(spark):
    t = Tables(spark, SF_MID)
    text = _formatted(R.last_events(t.clicks, 300))
    part = text.index("WindowGroupLimit")
    assert "Partial" in text and text.index("Exchange") > 0
    assert re.search(r"WindowGroupLimit \(\d+\)\n.*\n.*Partial", text) or "Partial" in text[part:]


def test_pad_sequences_limits_before_shuffle(spark):
    t = Tables(spark, SF_MID)
    tok = S.code_tokens(t.clicks, [KEY, SESSION])
    vocab = S.fit_vocabulary(tok, [KEY, SESSION])
    text = _formatted(S.pad_sequences(S.encode(tok, vocab), [KEY, SESSION], 400))
    assert "Partial" in text and "Final" in text
    assert "TakeOrderedAndProject" in text      # vocabulary rank is a bounded top-k


def test_filters_reach_the_scan(spark):
    t = Tables(spark, SF_MID)
    text = _formatted(R.only_type(t.clicks).select("src_id", SESSION))
    assert re.search(r"PushedFilters: \[.*EqualTo\(type,Assessment\)", text)
    assert re.search(r"ReadSchema: struct<src_id:bigint,game_session:string,type:string>", text)


def test_spec_join_is_broadcast(spark):
    t = Tables(spark, SF_MID)
    assert "BroadcastHashJoin" in _plan(R.with_specs(t.clicks, t.specs))


def test_no_cartesian_products(spark):
    import __spark_entry__ as entry
    t_names = ["j10_label_by_next", "z7_style5_sequences", "z2_style2_last_events", "f12_knn_vote",
               "a16_histogram", "w7_kfold", "f3_standardize"]
    for name in t_names:
        df = entry.queries()[name](spark, SF_MID)
        plan = _plan(df)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_global_row_number_has_no_single_partition_window_on_rows(spark):
    ev = spark.read.parquet(f"{SF_MID}/events.parquet")
    out = O.global_row_number(ev, ["ts", "event_id"], "rn")
    text = _formatted(out)
    # the only window without PARTITION BY runs over per-partition counts
    assert "SinglePartition" not in text.split("BroadcastExchange")[0]
    assert out.where(F.col("rn") == 1).count() == 1


def test_median_has_no_percentile_buffer(spark):
    t = Tables(spark, SF_MID)
    plan = _plan(R.column_median(t.clicks, "game_time"))
    assert "percentile" not in plan.lower() and "median(" not in plan.lower()
    # the single-partition steps carry one row per partition or the final average
    assert plan.count("Exchange SinglePartition") <= 2


def test_kfold_sorts_only_the_key(spark):
    ev = spark.read.parquet(f"{SF_MID}/events.parquet").select("event_id", "user_id", "ts", "event_type")
    folds = R.kfold(ev, 5, ["event_id"])
    text = _formatted(folds)
    # the written, range-sorted copy behind the fold numbers holds the key only
    scans = re.findall(r"ReadSchema: (struct<[^\n]*>)", text)
    assert any(s.startswith("struct<event_id:") and "user_id" not in s and "_mid" in s for s in scans), scans
    assert folds.count() == ev.count()


def test_asof_inputs_share_one_hot_bucket_copy(spark):
    from playtrail.operators import labelling as L
    t = Tables(spark, SF_MID)
    text = _formatted(L.label_by_next(t.clicks, t.labels, with_groups=False))
    # every scan of the hot-bucket table reads the one copy written for this join
    locations = set(re.findall(r"hot-buckets-[0-9a-f]+", text))
    assert len(locations) == 1, locations
