"""Approximate nearest neighbours by inner product over an NN-descent graph.

Build: vectors are put in order by random projections several times; runs of
``BLOCK`` consecutive vectors give each vector its first neighbours. A block is a
smaller share of more vectors, so the number of orders and of the cells of an
order grow with the vectors (``effort``). Then rounds
of NN-descent: the neighbours of a vector (and those that name it) meet each
other, so that each sees neighbours of its neighbours, and each keeps its best
``DEGREE``, until a round renews few entries. Search: a query starts from
its neighbours in the graph and greedily expands those of its best ``BEAM``
candidates that are new, until no beam gains any. Lists and beams only ever
change for better scores, so both end.

A round works by blocks of similar vectors: vectors that the members of a block
need are joined once per block, not once per member, and only scores that beat
a node's present list leave the block, so a round's shuffle is the graph and a
few copies of the vectors.

Equal vectors are one node of the graph; each node keeps its ``k + 1`` smallest
ids, which is all that a result of ``k`` rows can use (equal scores go to the
smaller id).

Defined results: null, empty and all-zero vectors and those with a null or
non-finite component take no part, neither do vectors of another length than
most, nor rows with a null id; repeated rows count as one; an empty table gives
no rows; fewer candidates than ``k`` are all returned; other columns are not
carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playtrail.session import materialize

DEGREE = 24      # neighbours of a node
NAMED_BY = 16    # nodes that name a node, kept besides
ORDERS = 4       # random orders of the first graph at least; one more for each doubling beyond 16 blocks
BLOCK = 4096     # vectors of a block
SLICE = 512      # vectors of a block that are scored at once
SIGNS = 5        # coarse cells of an order at least: 2 ** SIGNS; beyond, about one for each block
RENEWED = 50     # a round of NN-descent that renews fewer than one in so many entries is the last
BEAM = 128       # candidates of a query
BEST = "array<struct<s:float,nb:long>>"


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Distinct ``(vec_id, vec)`` that take part."""
    df = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    df = df.where("vec_id is not null and vec is not null").where(~bad & F.exists("vec", lambda x: x != 0))
    size = df.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").limit(1)
    return df.join(F.broadcast(size), F.size("vec") == F.col("d")).select("vec_id", "vec").dropDuplicates(["vec_id"])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _lists(values: list) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values) if values else [], pa.int64()))


def effort(rows: int, block: int = BLOCK) -> tuple[int, int]:
    """Number of orders, and of the signs that make the cells of an order."""
    doublings = (max(rows - 1, 0) // block).bit_length()     # of a block until it holds all rows
    return max(ORDERS, ORDERS + doublings - 4), max(SIGNS, doublings)


def _orders(orders: int, signs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each vector once per random order, with its place in it."""
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column("vec"))
            for t in range(orders):
                lines = np.random.default_rng(7 + t).standard_normal((x.shape[1], signs + 1))
                y = x @ lines
                cell = ((y[:, :signs] > 0) << np.arange(signs)).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), t)), pa.array(cell), pa.array(y[:, signs]), b.column("id"), b.column("vec")],
                    ["t", "cell", "line", "id", "vec"])
    return run


def _first(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    """Best neighbours within each run of ``block`` rows of an order."""
    held: list[pa.RecordBatch] = []

    def solve(table: pa.Table) -> pa.RecordBatch:
        ids, x = table.column("id").to_numpy(), _matrix(table.column("vec").combine_chunks())
        n, k = len(ids), min(DEGREE, len(ids) - 1)
        best, score = np.empty((n, k), np.int64), np.empty((n, k), np.float32)
        for at in range(0, n, SLICE):      # scores of a slice against the run: 16 MB for a run of 8,191
            s = x[at:at + SLICE] @ x.T
            own = np.arange(len(s))[:, None]
            s[own[:, 0], at + own[:, 0]] = -np.inf
            near = np.argpartition(s, n - k, axis=1)[:, n - k:] if k else np.empty((len(s), 0), np.int64)
            best[at:at + SLICE], score[at:at + SLICE] = near, s[own, near]
        offsets = pa.array(np.arange(n + 1, dtype=np.int32) * k)
        pairs = pa.StructArray.from_arrays([pa.array(score.ravel()), pa.array(ids[best].ravel())], ["s", "nb"])
        return pa.RecordBatch.from_arrays(
            [table.column("t").combine_chunks(), table.column("id").combine_chunks(),
             pa.array(np.full(len(ids), ids.min())), pa.ListArray.from_arrays(offsets, pairs)], ["t", "id", "block", "best"])

    def blocks(final: bool):
        table = pa.Table.from_batches(held)
        held.clear()
        t = table.column("t").to_numpy()
        for v in np.unique(t):
            part = table.filter(pa.array(t == v))
            last = v == t[-1] and not final
            while part.num_rows >= 2 * block or (part.num_rows and not last):
                n = block if part.num_rows >= 2 * block else part.num_rows
                yield solve(part.slice(0, n))
                part = part.slice(n)
            if last and part.num_rows:
                held.extend(part.combine_chunks().to_batches())

    for b in batches:
        if b.num_rows:
            held.append(b)
            if sum(h.num_rows for h in held) >= 4 * block:
                yield from blocks(False)
    if held:
        yield from blocks(True)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The best ``DEGREE`` neighbours of each id, from rows ``(id, best)`` sorted by id."""
    def solve(table: pa.Table) -> pa.RecordBatch:
        lists = table.column("best").combine_chunks()
        of = table.column("id").to_numpy()
        u = np.repeat(of, lists.value_lengths().to_numpy(zero_copy_only=False))
        s, w = (c.to_numpy(zero_copy_only=False) for c in lists.flatten().flatten())
        at = np.lexsort((-s, w, u))      # a neighbour scored in two blocks counts once
        u, w, s = u[at], w[at], s[at]
        new = np.ones(len(u), dtype=bool)
        new[1:] = (u[1:] != u[:-1]) | (w[1:] != w[:-1])
        u, w, s = u[new], w[new], s[new]
        at = np.lexsort((w, -s, u))
        u, w, s = u[at], w[at], s[at]
        near = np.arange(len(u)) - np.searchsorted(u, u) < DEGREE
        u, w, s = u[near], w[near], s[near]
        ids = np.unique(of)
        offsets = pa.array(np.append(np.searchsorted(u, ids), len(u)).astype(np.int32))
        pairs = pa.StructArray.from_arrays([pa.array(s), pa.array(w)], ["s", "nb"])
        return pa.RecordBatch.from_arrays(
            [pa.array(ids), pa.ListArray.from_arrays(offsets, pairs), pa.ListArray.from_arrays(offsets, pa.array(w))], ["id", "best", "nbs"])

    held: list[pa.RecordBatch] = []
    for b in batches:
        if b.num_rows:
            held.append(b)
            table = pa.Table.from_batches(held)
            ids = table.column("id").to_numpy()
            done = int(np.searchsorted(ids, ids[-1]))    # the last id may go on
            if done:
                yield solve(table.slice(0, done))
                held = table.slice(done).to_batches()
    if held:
        yield solve(pa.Table.from_batches(held))


def _best(found: DataFrame) -> DataFrame:
    """The graph ``(id, best, nbs)`` from rows ``(id, best)`` with scored neighbours."""
    return found.select("id", "best").repartition("id").sortWithinPartitions("id").mapInArrow(
        _merged, f"id long, best {BEST}, nbs array<long>")


def first_graph(nodes: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """The first graph ``(id, best, nbs)`` and the block of each node ``(id, block)``."""
    runs = (nodes.mapInArrow(_orders(*effort(nodes.count(), block)), "t long, cell long, line double, id long, vec array<float>")
            .repartitionByRange("t", "cell", "line").sortWithinPartitions("t", "cell", "line", "id"))
    found = materialize(runs.mapInArrow(lambda batches: _first(batches, block), f"t long, id long, block long, best {BEST}"), "first-neighbours")
    return materialize(_best(found), "graph"), materialize(found.where("t = 0").select("id", "block"), "blocks")


def _meet(table: pa.Table) -> pa.Table:
    """Scores among the members of each list of a block. Returned are, for each node
    met, the best ``DEGREE`` that beat the worst of its present list."""
    kind = table.column("kind").to_numpy()
    lists, vecs = (table.filter(pa.array(kind == k)).combine_chunks() for k in (0, 1))
    order = np.argsort(vecs.column("id").to_numpy())
    ids, x = vecs.column("id").to_numpy()[order], _matrix(vecs.column("vec").combine_chunks())[order]
    floor = vecs.column("floor").to_numpy()[order]
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def trimmed() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        u, w, s = (np.concatenate(c) for c in zip(*found)) if found else (np.empty(0, np.int64),) * 2 + (np.empty(0, np.float32),)
        _, first = np.unique(u * len(ids) + w, return_index=True)
        u, w, s = u[first], w[first], s[first]
        at = np.lexsort((w, -s, u))
        u, w, s = u[at], w[at], s[at]
        nth = np.arange(len(u)) - np.searchsorted(u, u)
        return u[nth < DEGREE], w[nth < DEGREE], s[nth < DEGREE]

    held = 0
    for own, v in zip(lists.column("ids").combine_chunks(), lists.column("id").to_numpy()):
        at = np.searchsorted(ids, np.append(np.asarray(own.values), v))
        s = x[at] @ x[at].T
        np.fill_diagonal(s, -np.inf)
        i, j = np.nonzero(s > floor[at][:, None])
        found.append((at[i], at[j], s[i, j]))
        held += len(i)
        if held > 4_000_000:
            found[:] = [trimmed()]
            held = len(found[0][0])
    u, w, s = trimmed()
    met, start = np.unique(u, return_index=True)
    pairs = pa.StructArray.from_arrays([pa.array(s.astype(np.float32)), pa.array(ids[w])], ["s", "nb"])
    offsets = pa.array(np.append(start, len(u)).astype(np.int32))
    return pa.table({"id": pa.array(ids[met]), "best": pa.ListArray.from_arrays(offsets, pairs)})


def _none(kind: str) -> Column:
    """An empty value of a column that rows of one kind lack: runs of null arrays take
    Arrow's writer time in the square of their length."""
    return F.array().cast(kind) if kind.startswith("array") else F.lit(0).cast(kind)


def descend(graph: DataFrame, blocks: DataFrame, nodes: DataFrame, name: str) -> DataFrame:
    """One round of NN-descent: the members of a two-way list meet each other, and
    each keeps what beats its list. A block holds each vector it needs once."""
    lists = materialize(both_ways(graph).join(blocks, "id"), name + "-lists")
    floor = F.when(F.size("best") >= DEGREE, F.get("best", F.lit(DEGREE - 1))["s"]).otherwise(F.lit(float("-inf")))
    needed = lists.select("block", F.explode(F.concat("nbs", F.array("id"))).alias("id")).distinct()
    vectors = nodes.join(graph.select("id", floor.cast("float").alias("floor")), "id")
    rows = (lists.select("block", F.lit(0).alias("kind"), "id", F.col("nbs").alias("ids"),
                         _none("array<float>").alias("vec"), F.lit(0.0).cast("float").alias("floor"))
            .union(needed.join(vectors, "id").select("block", F.lit(1), "id", _none("array<long>"), "vec", "floor")))
    met = rows.groupBy("block").applyInArrow(_meet, f"id long, best {BEST}")
    return materialize(_best(graph.select("id", "best").union(met)), name)


def _expand(keep: int, k: int):
    """Of each centre of a block: the best ``keep`` of its beam, of its fresh nodes and
    of the lists of those."""
    def run(table: pa.Table) -> pa.Table:
        kind = table.column("kind").to_numpy()
        part = {n: table.filter(pa.array(kind == n)).combine_chunks() for n in range(3)}
        out = {c: [] for c in ("id", "nbs", "s", "fresh", "norm", "sure")}
        none = np.empty(0, np.int64)
        ids = part[2].column("id").to_numpy()
        order = np.argsort(ids)
        ids = ids[order]
        x = _matrix(part[2].column("vec").combine_chunks())[order] if len(ids) else None
        norms = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1)) if len(ids) else None
        near = dict(zip(part[1].column("id").to_pylist(), (np.asarray(v.values) for v in part[1].column("ids"))))
        for u, own, own_s, fresh, norm, v in zip(*(part[0].column(c) for c in ("id", "ids", "s", "fresh", "norm", "vec"))):
            u, own, own_s, fresh, norm = u.as_py(), *(np.asarray(c.values) for c in (own, own_s, fresh)), norm.as_py()
            q = np.asarray(v.values)
            seen = np.setdiff1d(np.concatenate([fresh, *[near.get(i, none) for i in fresh.tolist()]]), own)
            seen = seen[seen != u]
            if len(seen) and len(ids):
                at = np.minimum(np.searchsorted(ids, seen), len(ids) - 1)
                seen, at = seen[ids[at] == seen], at[ids[at] == seen]
                nbs, s = np.concatenate([own, seen]), np.concatenate([own_s, x[at] @ q]).astype(np.float32)
                norm = max(norm, norms[at].max(initial=0.0))
            else:
                nbs, s = own, own_s
            best = np.lexsort((nbs, -s))[:keep]
            nbs, s = nbs[best], s[best]
            # Single precision may be off by this much: what can be among the best ``k`` is sure to be scored exactly.
            off = (len(q) + 4) * 2.0 ** -23 * float(np.linalg.norm(q.astype(np.float64))) * norm
            sure = int((~(s < s[k - 1] - 2 * off)).sum()) if len(s) > k else len(s)
            for c, value in zip(out, (u, nbs, s, np.setdiff1d(nbs, own), norm, sure)):
                out[c].append(value)
        lists = {c: _lists(out[c]) for c in ("nbs", "fresh")}
        scores = pa.ListArray.from_arrays(lists["nbs"].offsets, pa.array(np.concatenate(out["s"]) if out["s"] else [], pa.float32()))
        return pa.table({"id": pa.array(out["id"], pa.int64()), "nbs": lists["nbs"], "s": scores, "fresh": lists["fresh"],
                         "norm": pa.array(out["norm"], pa.float64()), "sure": pa.array(out["sure"], pa.int32())})
    return run


def hop(beams: DataFrame, lists: DataFrame, nodes: DataFrame, keep: int, k: int, name: str) -> DataFrame:
    """One round for beams ``(id, block, nbs, s, fresh, norm, vec)``: only nodes that are
    fresh in a beam are expanded, and only nodes not yet in it are scored."""
    wanted = beams.select("block", F.explode("fresh").alias("id")).distinct()
    near = wanted.join(lists.select("id", F.col("nbs").alias("ids")), "id")
    reach = near.select("block", F.explode("ids").alias("id")).union(wanted.select("block", "id")).distinct()
    state = {"s": "array<float>", "fresh": "array<long>", "norm": "double", "vec": "array<float>"}

    def without(*given: str):
        return [_none(kind).alias(c) for c, kind in state.items() if c not in given]
    rows = (beams.select("block", F.lit(0).alias("kind"), "id", F.col("nbs").alias("ids"), *state)
            .unionByName(near.select("block", F.lit(1).alias("kind"), "id", "ids", *without()))
            .unionByName(reach.join(nodes, "id").select(
                "block", F.lit(2).alias("kind"), "id", _none("array<long>").alias("ids"), "vec", *without("vec"))))
    return materialize(rows.groupBy("block").applyInArrow(
        _expand(keep, k), "id long, nbs array<long>, s array<float>, fresh array<long>, norm double, sure int"), name)


def both_ways(graph: DataFrame) -> DataFrame:
    """Neighbour lists extended by up to ``NAMED_BY`` of the nodes that name a node,
    those that rank it highest first."""
    named = graph.select(F.posexplode("nbs").alias("rank", "to"), "id")
    named = named.withColumn("r", F.row_number().over(Window.partitionBy("to").orderBy("rank", F.xxhash64("id"))))
    named = named.where(F.col("r") <= NAMED_BY).groupBy(F.col("to").alias("id")).agg(F.collect_list("id").alias("more"))
    return graph.select("id", "nbs").join(named, "id", "left").select(
        "id", F.array_distinct(F.concat("nbs", F.coalesce("more", F.array().cast("array<long>")))).alias("nbs"))


def build(nodes: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """NN-descent over ``nodes`` (id, vec): the graph ``(id, best, nbs)`` and the
    blocks. It ends when a round renews fewer than one in ``RENEWED`` list entries."""
    graph, blocks = first_graph(nodes, block)
    for r in count():
        new = descend(graph, blocks, nodes, f"descent-{r}")
        renewed, entries = new.join(graph.select("id", F.col("nbs").alias("was")), "id").agg(
            F.sum(F.size(F.array_except("nbs", "was"))), F.sum(F.size("nbs"))).first()
        graph = new
        if (renewed or 0) * RENEWED < (entries or 1):
            break
    return graph, blocks


def nearest(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20,
            every: int = 20, block: int = BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found for every row whose
    id is divisible by ``every``, among all rows but the query's own."""
    base = materialize(usable(vectors, id_col, vec_col).withColumn("h", F.xxhash64("vec")), "vectors")
    # The k + 1 smallest ids of equal vectors: limited before the shuffle, so a vector that many rows share is no task of its own.
    place = Window.partitionBy("h", "vec")
    same = base.withColumn("nth", F.row_number().over(place.orderBy("vec_id"))).where(F.col("nth") <= k + 1)
    same = materialize(same.withColumn("id", F.min("vec_id").over(place)), "vector-classes")
    one = same.where("nth = 1")
    exact = one.select("id", "vec")
    nodes = exact.select("id", F.col("vec").cast("array<float>").alias("vec"))   # graph and search; scores are exact
    graph, blocks = build(nodes, block)
    lists = materialize(both_ways(graph), "search-lists")
    asked = base.where(F.col("vec_id") % every == 0).select("vec_id", "h", "vec").join(one.select("h", "vec", "id"), ["h", "vec"])
    asked = materialize(asked.select("vec_id", "id"), "queries")
    centres = materialize(asked.select("id").distinct().join(blocks, "id").join(nodes, "id"), "centres")
    beams = lists.join(centres.select("id"), "id").selectExpr(
        "id", "cast(array() as array<long>) nbs", "cast(array() as array<float>) s", "nbs fresh", "double(0) norm")
    for h in count():
        beams = hop(beams.select("id", "nbs", "s", "fresh", "norm").join(centres, "id"), lists, nodes, BEAM, k, f"hop-{h}")
        if beams.where("size(fresh) > 0").limit(1).count() == 0:
            break
    # Exact scores of what can be among the best k and of the node itself (its other ids).
    found = beams.select("id", F.explode(F.concat(F.slice("nbs", F.lit(1), F.col("sure")), F.array("id"))).alias("node"))
    found = centres.select("id", F.col("id").alias("node")).union(found).distinct()
    dot = F.aggregate(F.zip_with("qv", "vec", lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)
    scored = (found.join(exact.select(F.col("id"), F.col("vec").alias("qv")), "id")
              .join(exact.withColumnRenamed("id", "node"), "node").select("id", "node", dot.alias("score")))
    # Ranked once per distinct query vector; k + 1, as a query's own id goes.
    members = scored.join(same.select(F.col("id").alias("node"), "vec_id"), "node").withColumn(
        "nth", F.row_number().over(Window.partitionBy("id").orderBy(F.desc("score"), "vec_id"))).where(F.col("nth") <= k + 1)
    rows = (asked.withColumnRenamed("vec_id", "query_id").join(members.select("id", "vec_id", "score"), "id")
            .where("vec_id <> query_id"))
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return rows.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
