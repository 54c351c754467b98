"""What the Jaccard join leaves on the shared folder."""

import os
import random

import numpy as np
import pyarrow as pa

from playtrail.llm import jaccard_join


def test_token_tables_go_when_the_links_are_written(spark):
    rng = random.Random(3)
    base = [" ".join(rng.choice("abcdefgh") + str(rng.randint(0, 500)) for _ in range(80)) for _ in range(30)]
    rows = [(10 * i + j, t + " tail" * j) for i, t in enumerate(base) for j in range(3)]
    folder = os.path.join(spark.sparkContext.getCheckpointDir().removeprefix("file:"), "tables")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    found = jaccard_join.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90)
    left = {t.rsplit("-", 1)[0] for t in set(os.listdir(folder)) - before}
    assert not left & {"token-sets", "signatures", "signature-members", "part-tokens", "mixed-part-tokens"}, left
    # The result does not read them.
    assert {r.doc_id: r.component_id for r in found.collect()} == {i: i - i % 10 for i, _ in rows}


def near_copies(rng, groups, copies):
    """Groups of texts that lose one word each; another group shares a passage with it."""
    for i in range(groups):
        text = [rng.choice("abcdefgh") + str(rng.randint(0, 5000)) for _ in range(90)]
        for j in range(copies):
            yield 100 * i + j, " ".join(text[:j] + text[j + 1:])


def test_slices_and_tiles_find_the_same_groups_with_one_copy_of_the_tokens(spark, monkeypatch):
    rows = list(near_copies(random.Random(5), 12, 5))
    d = spark.createDataFrame(rows, "doc_id long, text string")
    folder = os.path.join(spark.sparkContext.getCheckpointDir().removeprefix("file:"), "tables")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    want = {i: i - i % 100 for i, _ in rows}
    calls, opened = [], jaccard_join._opened

    def spy(cells, left, right, percent, name):
        calls.append((name, {t.rsplit("-", 1)[0] for t in set(os.listdir(folder)) - before}))
        assert "union" not in right.columns
        return opened(cells, left, right, percent, name)
    monkeypatch.setattr(jaccard_join, "_opened", spy)
    for tokens, signatures, tiles in ((1 << 26, 1 << 25, 1), (2000, 300, 3)):
        monkeypatch.setattr(jaccard_join, "TILE_TOKENS", tokens)
        monkeypatch.setattr(jaccard_join, "SLICE_SIGNATURES", signatures)
        calls.clear()
        assert {r.doc_id: r.component_id for r in jaccard_join.jaccard_join(d, 5, 80).collect()} == want
        assert sum(name == "head-links" for name, _ in calls) == tiles ** 2
        for name, tables in calls:
            assert "token-sets" not in tables and "signatures" not in tables, (name, tables)


def test_hits_are_one_row_per_bucket_and_receiver():
    """Many texts that share tokens: lists, not a row per text and bucket."""
    rng, deals = np.random.default_rng(1), 4
    tids = rng.integers(-2 ** 62, 2 ** 62, 500)
    toks = [np.sort(rng.choice(60, 9, replace=False)).astype(np.int32) for _ in tids]
    batch = pa.RecordBatch.from_arrays([
        pa.array([b for b in range(3)], pa.int32()), pa.array([tids] * 3, pa.list_(pa.int64())),
        pa.array([[3] * len(tids)] * 3, pa.list_(pa.int32())),
        pa.array([np.concatenate([t[3 * b:3 * b + 3] + 100 * b for t in toks]) for b in range(3)], pa.list_(pa.int32())),
        pa.array([[]] * 3, pa.list_(pa.int32()))], ["bucket", "tids", "counts", "toks", "known"])
    got = list(jaccard_join._hits(deals)([batch]))
    assert sum(b.num_rows for b in got) <= 3 * deals
    sums = {t: h for b in jaccard_join._summed(got) for t, h in zip(b["tid"].to_pylist(), b["hits"].to_pylist())}
    held = [{} for _ in range(3)]
    for t in toks:
        for i, x in enumerate(t.tolist()):
            held[i // 3][x] = held[i // 3].get(x, 0) + 1
    assert sums == {int(i): n for i, t in zip(tids, toks) if (n := sum(held[k // 3][x] > 1 for k, x in enumerate(t.tolist())))}


def test_links_of_a_task_are_a_forest_over_all_its_cells():
    """Heads of the same near copies: each cell links every member, a task only as many as join groups."""
    def part(*tids):
        return jaccard_join.Part(pa.array([{"tid": t, "grp": t, "toks": list(range(40))} for t in tids]))
    root, links = {}, []
    for head in (1, 2, 3, 4):
        links += jaccard_join.cell_links(part(head), part(*range(1, 30)), 80, False, root)
    assert len(links) == 28
    assert len({x for pair in links for x in pair}) == 29


def test_matrices_hold_the_tokens_of_the_queries_only(monkeypatch):
    """A part of many different tokens: links as by sets, in matrices of a bounded size."""
    rng = np.random.default_rng(2)
    sets = [np.sort(rng.choice(10 ** 6, 30 + i % 4, replace=False)) for i in range(60)]
    sets += [np.sort(np.r_[s[2:], 10 ** 6 + i]) for i, s in enumerate(sets)]
    ids = list(range(len(sets)))

    def part(some):
        return jaccard_join.Part(pa.array([{"tid": i, "grp": i, "toks": sets[i].tolist()} for i in some]))
    made, zeros = [], np.zeros
    monkeypatch.setattr(jaccard_join, "QUERY_TOKENS", 100)
    monkeypatch.setattr(jaccard_join, "MATRIX", 2000)
    monkeypatch.setattr(jaccard_join.np, "zeros", lambda shape, *a: made.append(np.prod(shape)) or zeros(shape, *a))
    got = jaccard_join.cell_links(part(ids[:60]), part(ids[60:]), 80, False)
    monkeypatch.undo()
    want = [(i, j) for i in ids[:60] for j in ids[60:]
            if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))]
    assert sorted(got) == want and len(want) == 60
    assert max(made) <= 2000, max(made)
