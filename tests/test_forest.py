"""The forest of narrow rows: full trees, bags and nodes that do not depend on partitions."""

import numpy as np
from pyspark.sql import functions as F

from playtrail.operators import forest as FO
from playtrail.operators import models as M


def frame(spark, x, y):
    rows = [(i, [float(v) for v in r], float(c)) for i, (r, c) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, features array<double>, label double")


def predictions(model, df):
    return {r.id: r.prediction for r in model.transform(df).select("id", "prediction").collect()}


def test_best_cut_equals_every_cut_tried():
    rng = np.random.default_rng(3)
    code, label, w = rng.integers(0, 9, 60).astype(np.uint8), rng.integers(0, 3, 60), rng.integers(1, 4, 60)
    hot = np.zeros((60, 3))
    hot[np.arange(60), label] = w
    node = rng.integers(0, 4, 60)
    whole = np.stack([hot[node == n].sum(0) for n in range(4)])
    of, _, score = FO.best_cuts(node, code, hot, whole)
    for n, s in zip(of, score):
        mine = [(hot[(node == n) & (code <= c)].sum(0), hot[(node == n) & (code > c)].sum(0)) for c in range(8)]
        assert abs(s - max((a ** 2).sum() / a.sum() + (b ** 2).sum() / b.sum() for a, b in mine if a.sum() and b.sum())) < 1e-9


def test_small_and_large_nodes_and_any_partitions_give_full_trees(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 40, (600, 4))
    y = (x[:, 0] // 3 + x[:, 1] // 7) % 4                   # many runs: needs deep trees
    df = frame(spark, x, y)
    for kw in ({}, {"node_rows": 150}):                     # the second splits its first levels by histograms
        a = FO.Forest(15, **kw).fit(df.repartition(1))
        b = FO.Forest(15, **kw).fit(df.repartition(7))
        assert bool(kw) == any(len(t.column) > 1 for t in a.tops)
        pa, pb = predictions(a, df.repartition(5)), predictions(b, df)
        assert pa == pb and len(pa) == 600
        assert sum(pa[i] == y[i] for i in range(600)) > 0.95 * 600


def test_as_good_as_sparks_forest_on_rows_not_seen(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(900, 5))
    y = (x[:, 0] + 0.5 * x[:, 1] ** 2 + 0.3 * rng.normal(size=900) > 0.3).astype(int)
    df = frame(spark, x, y).withColumn("v", M.array_to_vector("features")).drop("features").withColumnRenamed("v", "features")
    train, test = df.where("id % 3 > 0"), df.where("id % 3 = 0")
    share = lambda est: est.fit(train).transform(test).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    assert share(M.narrow_forest(40)) > share(M.random_forest(40)) - 0.04


def test_null_features_and_one_label(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], 3.0), (2, [5.0, 2.0], 3.0), (3, None, 3.0)], "id long, features array<double>, label double")
    assert predictions(FO.Forest(5).fit(df), df) == {1: 3.0, 2: 3.0, 3: None}
    assert predictions(FO.Forest(5, node_rows=1).fit(df), df) == {1: 3.0, 2: 3.0, 3: None}


def test_cells_and_sorted_rows_find_the_same_cuts():
    rng = np.random.default_rng(8)
    node, sizes = rng.integers(0, 5, 80), np.array([3, 9, 2, 6, 9])
    node[:5] = np.arange(5)
    code, label, w = (rng.integers(0, sizes[node])).astype(np.uint8), rng.integers(0, 3, 80), rng.integers(1, 4, 80).astype(float)
    hot = np.zeros((80, 3))
    hot[np.arange(80), label] = w
    whole = np.stack([hot[node == n].sum(0) for n in range(5)])
    _, byte, score = FO.best_cuts(node, code, hot, whole)
    byte2, score2 = FO.cell_cuts(node, code, label, w, sizes, whole)
    assert np.allclose(score, score2) and (byte == byte2)[score > 0].all()


def test_wide_rows_of_mostly_constant_columns(spark, monkeypatch):
    """Padded rows: columns of one value are never tried, and nodes are bounded by bytes."""
    rng = np.random.default_rng(9)
    x = np.full((400, 900), -1.0)
    x[:, 300:306] = rng.integers(0, 4, (400, 6))
    y = (x[:, 300] + 2 * x[:, 303]) % 4
    df = frame(spark, x, y)
    assert len(FO.Forest(2).fit(df).cuts) == 6
    whole = predictions(FO.Forest(8).fit(df.repartition(3)), df)
    assert sum(whole[i] == y[i] for i in range(400)) > 0.95 * 400
    monkeypatch.setattr(FO, "NODE_BYTES", 100 * 8)
    model = FO.Forest(8).fit(df.repartition(3))
    assert all(len(t.column) > 1 for t in model.tops)
    parts = predictions(model, df.repartition(5))
    assert sum(parts[i] == y[i] for i in range(400)) > 0.95 * 400


def test_style2_folds_grow_no_forest_in_the_driver(spark, monkeypatch):
    import __spark_entry__ as entry
    from tests.conftest import SF_SMALL
    monkeypatch.setattr(M, "RandomForestClassifier", None)   # Spark's forest keeps every tree in the driver
    assert entry.queries()["f7_style2_kfold_forest"](spark, SF_SMALL).count() > 0
