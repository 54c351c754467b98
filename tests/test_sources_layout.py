"""Row numbers under any split, the layout of the labelled table, hash-only first and
last rows, and mergeable sketches."""

import os
import random
import re
import tempfile

import pytest
from conftest import SF_MID
from pyspark.sql import functions as F
from test_hot_sessions import NO_BROADCAST, above, plan_nodes, settings

from playtrail import sources as SRC
from playtrail.operators import features as FT
from playtrail.operators import labelling as L
from playtrail.operators import relational as R
from playtrail.operators import sequences as S
from playtrail.operators import sketches as SK
from playtrail.schema import KEY, SESSION
from playtrail.sources.fixtures import Tables

HEADER = "event_id,game_session,timestamp,event_data,installation_id,event_count,event_code,game_time,title,type,world\n"


def write_files(rows_per_file):
    folder, n = tempfile.mkdtemp(prefix="playtrail-split-"), 0
    for f, rows in enumerate(rows_per_file):
        with open(os.path.join(folder, f"part-{f:05d}.csv"), "w") as out:
            out.write(HEADER)
            for _ in range(rows):
                out.write(f'e{n},s,2019-09-06T17:53:46.{n % 1000:03d}Z,"{{""n"":{n},""x"":""{"y" * (n % 37)}""}}",p,{n},2000,0,T,Clip,NONE\n')
                n += 1
    return folder, n


@pytest.mark.parametrize("split_bytes", ["300", "4096", "128m"])
@pytest.mark.parametrize("rows_per_file", [[600], [1, 0, 200, 37, 300]])
def test_ids_are_places_in_the_files(spark, split_bytes, rows_per_file):
    folder, n = write_files(rows_per_file)
    with settings(spark, files__maxPartitionBytes=split_bytes, files__openCostInBytes="200"):
        rows = SRC.read_clicks(spark, folder).select("src_id", "event_count").collect()
    assert sorted(tuple(r) for r in rows) == [(i, i) for i in range(n)]


def labelled(spark):
    t = Tables(spark, SF_MID)
    path = os.path.join(tempfile.mkdtemp(prefix="playtrail-labelled-"), "h")
    SRC.write_labelled(L.label_history(t.clicks, t.labels), path, buckets=4)
    return t, path


def test_labelled_table_is_pruned_and_joined_without_exchange(spark):
    t, path = labelled(spark)
    games = SRC.read_labelled(spark, path, ["Game"])
    text = games._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*type#\d+ = Game", text)
    with settings(spark, **NO_BROADCAST):
        both = SRC.read_labelled(spark, path)
        joined = both.join(both.groupBy(KEY).agg(F.max("ts").alias("latest")), KEY)
        nodes = plan_nodes(joined)
    assert any("SortMergeJoin" in x for _, x in nodes) and not any(x.startswith("Exchange") for _, x in nodes)
    assert joined.count() == both.count() == t.history().count()


def test_layout_is_read_back_in_another_session(spark):
    _, path = labelled(spark)
    from playtrail.sources import files
    spark.sql(f"drop table {files._table_name(path)}")       # as a new session, which knows no table
    with settings(spark, **NO_BROADCAST):
        nodes = plan_nodes(SRC.read_labelled(spark, path).groupBy(KEY).count())
    assert not any(x.startswith("Exchange") for _, x in nodes)


def test_overwrite_replaces_one_type(spark):
    _, path = labelled(spark)
    before = SRC.read_labelled(spark, path).groupBy("type").count().collect()
    half = SRC.read_labelled(spark, path, ["Game"]).where("src_id % 2 = 0")
    from playtrail.session import materialize
    half = materialize(half, "half")
    SRC.overwrite_labelled(half, path)
    after = {r["type"]: r["count"] for r in SRC.read_labelled(spark, path).groupBy("type").count().collect()}
    assert after.pop("Game") == half.count()
    assert after == {r["type"]: r["count"] for r in before if r["type"] != "Game"}


def test_hot_player_is_written_by_several_tasks(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="playtrail-hot-"), "h")
    df = spark.range(4000).select(F.lit(1).alias(KEY), F.timestamp_micros(F.col("id") * 1000000).alias("ts"),
                                  F.col("id").cast("int").alias("event_count"), F.col("id").alias("src_id"), F.lit("Game").alias("type"))
    with settings(spark, adaptive__coalescePartitions__enabled="false"):
        SRC.write_labelled(df, path, buckets=4)
    files = os.listdir(os.path.join(path, "type=Game"))
    assert len([f for f in files if f.endswith(".parquet")]) >= 4
    assert SRC.read_labelled(spark, path).count() == 4000


# ---------------------------------------------------------------- first and last rows without sorting

def test_first_and_last_rows_equal_plain_order(spark):
    rng = random.Random(8)
    null = lambda v: None if rng.random() < 0.15 else v
    rows = [(null(rng.randint(0, 5)), null(rng.choice("ab")), null(rng.choice(["30-2", "30-21", "long-prefix-1", "long-prefix-2", "", "é"])),
             null(rng.randint(0, 3)), i) for i in range(400)]
    df = spark.createDataFrame(rows, "k1 int, k2 string, s string, n int, v long")
    least = lambda v: (v is not None, v)
    for order in (["s", "n", "v"], ["n", "s", "v"]):
        at = {"s": 2, "n": 3, "v": 4}
        groups = {}
        for r in rows:
            groups.setdefault(r[:2], []).append(r)
        key = lambda r: [least(r[at[c]].encode() if isinstance(r[at[c]], str) else r[at[c]]) for c in order]
        for fn, pick in ((R.first_per_key, min), (R.last_per_key, max)):
            got = {(r.k1, r.k2): (r.s, r.n, r.v) for r in fn(df, ["k1", "k2"], order, ["s", "n", "v"]).collect()}
            assert got == {g: pick(rs, key=key)[2:] for g, rs in groups.items()}, (order, fn)


def test_no_sort_aggregate_over_all_rows(spark):
    t = Tables(spark, SF_MID)
    tokens = S.code_tokens(t.clicks, [KEY, SESSION])
    from playtrail.session import materialize
    tokens = materialize(tokens, "tokens")
    plans = {
        "P17": R.first_per_key(t.clicks, [KEY], ["ts", "event_count", "src_id"], [SESSION]),
        "W3": R.last_per_key(t.labels, [KEY], [SESSION], ["accuracy_group"]),
        "A13": FT.score_profile(t.starts),
        "X9": S.fit_vocabulary(tokens, [KEY, SESSION]),
    }
    for name, df in plans.items():
        nodes = plan_nodes(df)
        for i, (_, text) in enumerate(nodes):
            if text.startswith("FileScan"):
                over = above(nodes, i)
                sorts = [j for j, x in enumerate(over) if x.startswith("SortAggregate")]
                # a join with the ends of the keys, or a hash aggregate, comes first
                assert not sorts or any("Join" in x or x.startswith("HashAggregate") for x in over[:sorts[0]]), (name, over)


# ---------------------------------------------------------------- sketches

def test_merged_sketches_equal_sketches_of_the_whole(spark):
    t = Tables(spark, SF_MID)
    cols = [SESSION, KEY]
    parts = SK.distinct_sketches(t.clicks, ["world", "type"], cols)
    merged = SK.distinct_estimates(SK.merge_distinct(parts, [], cols), cols).first()
    whole = SK.distinct_estimates(SK.merge_distinct(SK.distinct_sketches(t.clicks, [], cols), [], cols), cols).first()
    assert merged == whole
    exact = t.clicks.agg(F.countDistinct(SESSION), F.countDistinct(KEY)).first()
    assert all(abs(m - e) <= 0.04 * e + 1 for m, e in zip(merged, exact))


def test_quantile_sketches_keep_the_rank_error(spark):
    rng = random.Random(9)
    values = [rng.choice([0.0, rng.random() ** 4, rng.gauss(5, 2)]) for _ in range(60_000)]
    df = spark.createDataFrame([(i % 7, v) for i, v in enumerate(values)] + [(1, None)], "k int, x double").repartition(6)
    stored = SK.quantile_sketches(df, ["k"], "x")
    whole = SK.merge_quantiles(stored, [], "x")
    row = whole.select(SK.sketched_rows("x"), *[SK.quantile("x", p) for p in (0.1, 0.5, 0.99)]).first()
    assert row[0] == len(values)
    for p, v in zip((0.1, 0.5, 0.99), row[1:]):
        below, upto = sum(x < v for x in values), sum(x <= v for x in values)
        slack = SK.KLL_RANK_ERROR * 2 * len(values)
        assert below <= p * len(values) + slack and upto >= p * len(values) - slack
