"""N-gram Jaccard join: a token-group matrix over sets of word shingles.

Two documents link when the Jaccard similarity of their shingle sets is at
least ``percent`` / 100. The result is one row per document with the smallest
key it can reach by links. The steps:

1. *Partners.* Of two linked sets, the smallest tokens they share stand among the
   first of either (a prefix of each sorted set). A text goes on only if enough
   tokens of its prefix are in the prefix of another text: a count per text, no pairs.
2. *Signatures.* Sets of similar size can only differ in ``H`` tokens, so of
   ``H + 1 + s`` hash segments of the token space at least ``s + 1`` hold equal
   tokens in both. A document's signatures are the hashes of its segments, for the
   size level it is in and for the one below. With at most ``s`` empty segments one
   of the equal ones has tokens, so only sets with more of them sign empty ones.
3. *Parts.* Documents that share signatures are dealt into parts of similar
   documents (by family: the smallest head they share a signature with) of bounded
   size. A part is stored with its members' tokens, from then on their only copy.
4. *Heads against parts.* The head of each signature is a query to the parts that
   hold its members (a head and a part, never a head and a member, are a row). The
   union of a part's tokens bounds the overlap of the query with any member; only
   parts it can reach are opened and give exact links, which form groups.
5. *Parts against parts.* What is left are signatures that hold several groups. Two
   parts with a common one are a cell: unions bound the overlap of each query of one
   part with the other, and the overlaps of the queries left are one matrix product.
   A task returns a spanning forest of the links its cells add, so pairs never become rows.
6. Components are formed again.

Signatures meet in slices of about ``SLICE_SIGNATURES``, and cells are opened tile by tile: the
parts are dealt to so many tiles that the tokens of one, and those that the cells of a pair
of tiles send, are about ``TILE_TOKENS``. Only one slice or pair of tiles is shuffled at a time.

Tokens, and texts as a whole, are addressed by 64-bit hashes. Copies of a text
share an address and are one member everywhere.

Defined results: a text without words (null or empty) has an empty set and links
with nothing; with fewer words than a shingle the whole sequence is its one
shingle; repeated rows share a component; a null key never becomes a component
id while the component has another one; an empty table gives no rows; other
columns are not carried.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtrail.llm.common import components, discard, fresh, whole_text
from playtrail.session import bounded_broadcast, materialize, materialize_at, scratch_path

PART_TOKENS = 32_768  # mean number of tokens in a part
TILE_TOKENS = 1 << 26  # tokens of the parts of a tile, or sent by the cells of two tiles, about
SLICE_SIGNATURES = 1 << 25  # signatures of texts that meet at a time, about
SUMMED = 4_000_000  # counts of hits that a task holds before it adds them up
QUERY_TOKENS = 16_384  # tokens of the queries that are compared at once, about
MATRIX = 4_000_000  # values of a matrix of members by tokens
JOINED = 1_000_000  # groups whose links a task remembers
CELLS_PER_BATCH = 32  # cells sent to Python at once
ENTRIES = 2_000_000  # prefix tokens that one step of the count of partners holds, about
NEED_ROWS = 500_000  # ids that may be broadcast to pick texts; a shuffle join beyond


class _WordIds(dict):
    """64-bit ids of words, with a bounded memory of recent ones."""

    def __missing__(self, word: bytes) -> int:
        import xxhash
        if len(self) > 500_000:
            self.clear()
        self[word] = x = xxhash.xxh64_intdigest(word)
        return x


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _weights(k: int) -> np.ndarray:
    return _mix(np.arange(1, k + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def token_set(text: bytes, words: int, ids: dict, weights: np.ndarray) -> np.ndarray:
    """Sorted distinct 64-bit tokens of a UTF-8 text: one per shingle of ``words``
    words, A-Z lowered. Bytes split at exactly the six separators of a word."""
    w = text.lower().split()
    if not w:
        return np.empty(0, np.uint64)
    x = np.array([ids[v] for v in w], dtype=np.uint64)
    if len(w) < words:
        return _mix(np.array([(x * weights[:len(w)]).sum(dtype=np.uint64) + np.uint64(len(w))], dtype=np.uint64))
    n = len(w) - words + 1
    h = x[:n] * weights[0]
    for j in range(1, words):
        h = h + x[j:j + n] * weights[j]
    return np.unique(_mix(h))


class Levels:
    """Size levels: linked sets are in one level or in neighbours. ``starts[k]``
    is the smallest size of level ``k``; pairs of level ``k`` have their smaller
    set in it and differ in at most ``differ(k)`` tokens."""

    def __init__(self, percent: int):
        self.percent, self.starts = percent, [1]

    def start(self, k: int) -> int:
        while len(self.starts) <= k:
            self.starts.append(self.starts[-1] * 100 // self.percent + 1)
        return self.starts[k]

    def of(self, n: int) -> int:
        k = 0
        while self.start(k + 1) <= n:
            k += 1
        return k

    def differ(self, k: int) -> int:
        most = self.start(k + 1) - 1 + self.start(k + 2) - 1
        return (100 - self.percent) * most // (100 + self.percent)

    def spare(self, k: int) -> int:
        """Segments beyond ``differ(k) + 1``: so many more are equal in linked sets."""
        return (self.differ(k) + 5) // 6


def signatures(tokens: np.ndarray, levels: Levels) -> np.ndarray:
    """The segment hashes of a non-empty sorted token set, for both its pair levels."""
    own = levels.of(len(tokens))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(tokens ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)])
    out = []
    for k in range(max(0, own - 1), own + 1):
        parts = levels.differ(k) + 1 + levels.spare(k)
        segment = ((tokens >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        edge = np.searchsorted(segment, np.arange(parts + 1, dtype=np.uint64))
        place = np.arange(parts, dtype=np.uint64) + np.uint64(k << 32)
        hashes = _mix(total[edge[1:]] - total[edge[:-1]] + _mix(place + np.uint64(1)))
        held = edge[1:] > edge[:-1]
        out.append(hashes[held] if (~held).sum() <= levels.spare(k) else hashes)
    return np.concatenate(out)


def _needed(n: int, percent: int) -> int:
    """Tokens that a set of ``n`` shares with any set it links to, at least."""
    return -(-n * percent // 100)


def _surplus(n: int, percent: int) -> int:
    """Shared tokens that the prefix of a set of ``n`` is long enough to hold."""
    return min(1 + n // 8, _needed(n, percent))


def prefix(n: int, percent: int) -> int:
    """Length of the prefix of a sorted set of ``n`` tokens. Outside it are fewer than
    the shared tokens by the surplus, so the first ``_surplus`` shared ones are in it."""
    return n - _needed(n, percent) + _surplus(n, percent) if n else 0


def least_shared(n: int, percent: int) -> int:
    """Tokens that the prefix of a set of ``n`` shares with that of any set it links to:
    the surplus of the smallest set it can link to."""
    return _surplus(_needed(n, percent), percent)


def _signed(values: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values) if values else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def _digest(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, weights = _WordIds(), _weights(words)
        for b in batches:
            sizes = [len(token_set(t, words, ids, weights)) for t in b.column("t").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("tid"), pa.array(sizes, pa.int64())], ["doc_id", "tid", "n"])
    return run


def _lists(values: np.ndarray, of: np.ndarray, buckets: int) -> pa.ListArray:
    """``values`` as one list per bucket; ``of`` is the sorted bucket of each value."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(buckets + 1)).astype(np.int32)), pa.array(values))


def _prefixes(words: int, percent: int, buckets: int):
    """Prefix tokens of a batch's different texts, dealt to buckets. A token of several
    texts of the batch is a hit of each of them here already and is sent once, as known."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, weights = _WordIds(), _weights(words)
        for b in batches:
            tids, first = np.unique(b.column("tid").to_numpy(), return_index=True)
            texts = b.column("t").take(pa.array(first)).cast(pa.binary()).to_pylist()
            sets = [token_set(t, words, ids, weights) for t in texts]
            sets = [x[:prefix(len(x), percent)] for x in sets]
            doc = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
            mixed = _mix(np.concatenate([*sets, np.empty(0, np.uint64)]) ^ np.uint64(0x9E3779B97F4A7C15))
            token, which, count = np.unique(mixed, return_inverse=True, return_counts=True)
            several = count[which] > 1
            hits = np.bincount(doc[several], minlength=len(sets))

            def bucket(x):
                return (((x >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)

            def low(x):
                return (x & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)
            alone, known = mixed[~several], token[count > 1]
            order = np.lexsort((doc[~several], bucket(alone)))
            alone, at = alone[order], doc[~several][order]
            run_, length = np.unique(bucket(alone) * len(sets) + at, return_counts=True)
            holder = run_ // max(len(sets), 1)
            rows = pa.RecordBatch.from_arrays([
                pa.array(np.arange(buckets, dtype=np.int32)), _lists(tids[run_ % max(len(sets), 1)], holder, buckets),
                _lists(length.astype(np.int32), holder, buckets), _lists(low(alone), bucket(alone), buckets),
                _lists(low(known), bucket(known), buckets)], ["bucket", "tids", "counts", "toks", "known"])
            some = (rows.column("toks").value_lengths().to_numpy() > 0) | (rows.column("known").value_lengths().to_numpy() > 0)
            yield rows.filter(pa.array(some))
            own, none = np.flatnonzero(hits), pa.array([[]], pa.list_(pa.int32()))
            if len(own):   # hits found here; any bucket passes them on
                yield pa.RecordBatch.from_arrays([
                    pa.array([int(tids[0]) % buckets], pa.int32()), pa.array([tids[own]], pa.list_(pa.int64())),
                    pa.array([hits[own]], pa.list_(pa.int32())), none, none], ["bucket", "tids", "counts", "toks", "known"])
    return run


def _hits(deals: int):
    """``(deal, tids, hits)``: how many prefix tokens of a text another text has too, as lists of
    the texts of a bucket that are dealt to the same task. Rows come sorted by bucket."""
    def found(tid, hits):
        deal = (_mix(tid.view(np.uint64)) % np.uint64(deals)).astype(np.int64)
        order = np.argsort(deal, kind="stable")
        rows = pa.RecordBatch.from_arrays([pa.array(np.arange(deals, dtype=np.int32)), _lists(tid[order], deal[order], deals),
                                           _lists(hits[order].astype(np.int32), deal[order], deals)], ["deal", "tids", "hits"])
        return rows.filter(pa.array(rows.column("tids").value_lengths().to_numpy() > 0))

    def settle(held):
        tid = np.concatenate([np.repeat(t, c) for t, c, _, _ in held])
        tok = np.concatenate([x for _, _, x, _ in held])
        known = np.concatenate([k for _, _, _, k in held])
        order = np.lexsort((tid, tok))
        tid, tok = tid[order], tok[order]
        new = np.ones(len(tok), bool)   # copies in other batches send the same pair
        new[1:] = (tid[1:] != tid[:-1]) | (tok[1:] != tok[:-1])
        tid, tok = tid[new], tok[new]
        token, which, count = np.unique(tok, return_inverse=True, return_counts=True)
        return found(*np.unique(tid[((count > 1) | np.isin(token, known))[which]], return_counts=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, passed, n = None, [], [], 0
        for b in batches:
            flat = [(b.column(c).flatten().to_numpy(), np.concatenate([[0], np.cumsum(b.column(c).value_lengths().to_numpy())]))
                    for c in ("tids", "counts", "toks", "known")]
            for i, bucket in enumerate(b.column("bucket").to_pylist()):
                row = [values[ends[i]:ends[i + 1]] for values, ends in flat]
                if not len(row[2]) and not len(row[3]):
                    passed.append((row[0], row[1]))
                    n += len(row[0])
                    if n > SUMMED:
                        yield found(*(np.concatenate(x) for x in zip(*passed)))
                        passed, n = [], 0
                    continue
                if bucket != at and held:
                    yield settle(held)
                    held = []
                at = bucket
                held.append(row)
        if held:
            yield settle(held)
        if passed:
            yield found(*(np.concatenate(x) for x in zip(*passed)))
    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(tid, hits)`` of the lists dealt to a task, one row per text."""
    tids, hits, held, n = np.empty(0, np.int64), np.empty(0, np.int64), [], 0

    def added():
        tid, which = np.unique(np.concatenate([tids, *(t for t, _ in held)]), return_inverse=True)
        sums = np.zeros(len(tid), np.int64)
        np.add.at(sums, which, np.concatenate([hits, *(h for _, h in held)]))
        return tid, sums
    for b in batches:
        held.append(tuple(b.column(c).flatten().to_numpy() for c in ("tids", "hits")))
        n += len(held[-1][0])
        if n > SUMMED:
            (tids, hits), held, n = added(), [], 0
    tids, hits = added()
    yield pa.RecordBatch.from_arrays([pa.array(tids), pa.array(hits)], ["tid", "hits"])


def _signs(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = Levels(percent)
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):  # bounds what one output batch holds
                b = whole.slice(at, 1000)
                toks, size = b.column("toks").flatten().to_numpy().view(np.uint64), b.column("toks").value_lengths().to_numpy()
                ends = np.cumsum(size)
                yield pa.RecordBatch.from_arrays([b.column("tid"), _signed(
                    [signatures(toks[e - k:e], levels) for e, k in zip(ends, size)])], ["tid", "sigs"])
    return run


def _tokens(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, weights = _WordIds(), _weights(words)
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                b = whole.slice(at, 1000)
                yield pa.RecordBatch.from_arrays([b.column("tid"), _signed(
                    [token_set(t, words, ids, weights) for t in b.column("t").cast(pa.binary()).to_pylist()])], ["tid", "toks"])
    return run


class Part:
    """Members of a part: ids, groups, token sets (``tokens`` end to end) and their union."""

    def __init__(self, held: pa.StructArray, union: pa.Array | None = None):
        toks = held.field("toks")
        self.tid, self.grp = held.field("tid").to_pylist(), held.field("grp").to_pylist()
        self.size, self.tokens = toks.value_lengths().to_numpy(), toks.flatten().to_numpy()
        self.union = np.unique(self.tokens) if union is None else union.to_numpy()


def _matches(left: Part, right: Part, queries: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Members of ``right`` that the queries of ``left`` link to: places of both. The matrices have
    the tokens of the queries only, and so many members at once that they stay small."""
    ends = np.cumsum(left.size)
    tokens = [left.tokens[ends[q] - left.size[q]:ends[q]] for q in queries]
    vocabulary = np.unique(np.concatenate(tokens))
    has = np.zeros((len(queries), len(vocabulary)), np.float32)
    for row, own in zip(has, tokens):
        row[np.searchsorted(vocabulary, own)] = 1
    at = np.minimum(np.searchsorted(vocabulary, right.tokens), len(vocabulary) - 1)
    hit = np.flatnonzero(vocabulary[at] == right.tokens)
    member, at = np.repeat(np.arange(len(right.size)), right.size)[hit], at[hit]
    step, out = max(1, MATRIX // len(vocabulary)), []
    for first in range(0, len(right.size), step):
        here = slice(*np.searchsorted(member, [first, first + step]))
        size = right.size[first:first + step]
        held = np.zeros((len(size), len(vocabulary)), np.float32)
        held[member[here] - first, at[here]] = 1
        overlap = has @ held.T
        q, m = np.nonzero(100 * overlap >= percent * (left.size[queries][:, None] + size[None, :] - overlap))
        out += zip(queries[q].tolist(), (m + first).tolist())
    return out


def cell_links(left: Part, right: Part, percent: int, same: bool, root: dict[int, int] | None = None) -> list[tuple[int, int]]:
    """Links between the members of two parts that join different groups, as a
    spanning forest over the groups; ``root`` has the links of earlier cells."""
    reached = np.concatenate([[0], np.cumsum(np.isin(left.tokens, right.union))])
    ends = np.cumsum(left.size)
    queries = np.flatnonzero(100 * (reached[ends] - reached[ends - left.size]) >= percent * left.size)
    if not len(queries):
        return []     # no query reaches the part: it stays closed
    found = (_matches(left, right, some, percent) for some in np.split(
        queries, np.flatnonzero(np.diff(np.cumsum(left.size[queries]) // QUERY_TOKENS)) + 1))
    root = {} if root is None else root

    def find(x: int) -> int:
        at = x
        while root.get(at, at) != at:
            at = root[at]
        while x != at:       # shorter next time
            root[x], x = at, root[x]
        return at
    out = []
    for i, j in (pair for pairs in found for pair in pairs):
        if same and i >= j or left.tid[i] == right.tid[j]:
            continue
        x, y = find(left.grp[i]), find(right.grp[j])
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append((left.tid[i], right.tid[j]))
    return out


def _cells(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root: dict[int, int] = {}
        for batch in batches:
            links = []
            if len(root) > JOINED:
                root = {}
            for i in range(batch.num_rows):
                x, y = (Part(batch.column(side)[i].values) for side in ("left", "right"))
                links += cell_links(x, y, percent, batch.column("same")[i].as_py(), root)
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["a", "b"])
    return run


def _opened(cells: DataFrame, left: DataFrame, right: DataFrame, percent: int, name: str) -> DataFrame:
    """Links that the cells ``(x, y)`` add; ``left`` and ``right`` are ``(part, held)``."""
    spark, conf = cells.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(conf)
    spark.conf.set(conf, str(CELLS_PER_BATCH))
    try:
        return materialize(
            cells.join(left.select(F.col("part").alias("x"), F.col("held").alias("left")), "x")
            .join(right.select(F.col("part").alias("y"), F.col("held").alias("right")), "y")
            .select("left", "right", (F.col("x") == F.col("y")).alias("same"))
            .mapInArrow(_cells(percent), "a long, b long"), name)
    finally:
        spark.conf.set(conf, before)


def _tile(part: str, tiles: int):
    return F.pmod(F.col(part), F.lit(tiles)).cast("int")


def _stored(parts: DataFrame, tokens: DataFrame, cells: DataFrame, heads: bool, name: str) -> tuple[str, int]:
    """The parts' members with their tokens, ``(part, held)`` by ``tile``: path and number of tiles."""
    all_ = parts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts"), F.count_distinct("part").alias("parts")).first()
    total = all_["n"] or 0
    sent = cells.count() * total // max(1, all_["texts"] if heads else all_["parts"])     # a cell sends a text or a part
    tiles = max(1, -(-total // TILE_TOKENS), math.isqrt(sent // TILE_TOKENS))
    path = scratch_path(parts.sparkSession, name)
    (tokens.join(bounded_broadcast(parts.drop("n"), NEED_ROWS), "tid").groupBy("part")
     .agg(F.collect_list(F.struct("tid", "grp", "toks")).alias("held")).withColumn("tile", _tile("part", tiles))
     .write.partitionBy("tile").parquet(path))
    return path, tiles


def _parts_at(spark, path: str) -> DataFrame:
    return spark.read.schema("part long, held array<struct<tid: long, grp: long, toks: array<long>>>, tile int").parquet(path)


def _members(stored: DataFrame) -> DataFrame:
    """``(tid, toks)`` of stored parts."""
    return stored.select(F.explode("held").alias("h")).select("h.tid", "h.toks")


def _by_tile(cells: DataFrame, path: str, tiles: int, heads: bool, percent: int, name: str) -> DataFrame:
    """Links that the cells ``(x, at, y)`` add, one pair of tiles at a time; ``at`` is the part that
    holds ``x``, a member (``heads``) or the part itself."""
    spark, links = cells.sparkSession, None
    stored = _parts_at(spark, path)
    for i in range(tiles):
        for j in range(tiles):
            some = cells.where((_tile("at", tiles) == i) & (_tile("y", tiles) == j)).select("x", "y")
            left, right = stored.where(F.col("tile") == i), stored.where(F.col("tile") == j)
            if heads:
                ids = bounded_broadcast(some.select(F.col("x").alias("tid")).distinct(), NEED_ROWS)
                left = _members(left).join(ids, "tid", "left_semi").select(
                    F.col("tid").alias("part"), F.array(F.struct("tid", F.col("tid").alias("grp"), "toks")).alias("held"))
            found = _opened(some, left, right, percent, name)
            links = found if links is None else links.union(found)
    return links


def _parts(members: DataFrame, info: DataFrame) -> DataFrame:
    """``(tid, n, part)``: families cut into parts of bounded size."""
    family = members.groupBy("tid").agg(F.min("head").alias("fam")).join(info, "tid")
    per = family.groupBy("fam").agg(F.ceil(F.sum("n") / PART_TOKENS).alias("cuts"))
    return materialize(family.join(per, "fam").select(
        "tid", "n", F.xxhash64("fam", F.pmod(F.xxhash64("tid"), F.col("cuts"))).alias("part")), "parts")


def _head_cells(members: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """``(x, at, y)``: the head of each signature, its part and the parts on the signature that
    hold sizes which allow a link."""
    near = members.where("tid <> head").join(parts.select("tid", F.col("part").alias("y")), "tid").select(
        F.col("head").alias("x"), "y").distinct()
    sizes = parts.groupBy(F.col("part").alias("y")).agg(F.min("n").alias("least"), F.max("n").alias("most"))
    near = near.join(parts.select(F.col("tid").alias("x"), "n", F.col("part").alias("at")), "x").join(sizes, "y")
    return materialize(near.where((100 * F.col("n") >= percent * F.col("least")) & (100 * F.col("most") >= percent * F.col("n")))
                       .select("x", "at", "y"), "head-cells")


def _matrix_links(members: DataFrame, groups: DataFrame, info: DataFrame, tokens: DataFrame, percent: int) -> DataFrame:
    """Links between different groups, found cell by cell."""
    spark = members.sparkSession
    grouped, grouped_at = materialize_at(
        members.join(groups.select(F.col("id").alias("tid"), "comp"), "tid", "left")
        .select("sig", "tid", "head", F.coalesce("comp", "tid").alias("grp")), "grouped-members")
    mixed = grouped.groupBy("sig").agg(F.min("grp").alias("x"), F.max("grp").alias("y")).where("x < y").select("sig")
    left, left_at = materialize_at(grouped.join(mixed, "sig", "left_semi"), "mixed-members")
    discard(spark, grouped_at)
    parts = _parts(left, info)
    seen = left.select("sig", "tid").join(parts, "tid").select("sig", "part").distinct()
    cells = materialize(
        seen.withColumnRenamed("part", "x").join(seen.withColumnRenamed("part", "y"), "sig")
        .where("x <= y").select("x", F.col("x").alias("at"), "y").distinct(), "cells")
    path, tiles = _stored(parts.join(left.select("tid", "grp").distinct(), "tid"), tokens, cells, False, "mixed-part-tokens")
    discard(spark, left_at)
    links = _by_tile(cells, path, tiles, False, percent, "matrix-links")
    discard(spark, path)
    return links


def _with_partners(texts: DataFrame, digest: DataFrame, info: DataFrame, words: int, percent: int) -> DataFrame:
    """``tid`` of the texts that share enough prefix tokens with other texts."""
    spark = texts.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = digest.agg(F.sum("n")).first()[0] or 0
    buckets = max(tasks, prefix(total, percent) // ENTRIES)
    hits = (texts.select("tid", "t").mapInArrow(
        _prefixes(words, percent, buckets),
        "bucket int, tids array<long>, counts array<int>, toks array<int>, known array<int>")
        .repartition(tasks, "bucket").sortWithinPartitions("bucket").mapInArrow(_hits(tasks), "deal int, tids array<long>, hits array<int>")
        .repartition(tasks, "deal").mapInArrow(_summed, "tid long, hits long"))

    def needed(n):
        return F.floor((n * percent + 99) / 100)
    n = needed(F.col("n"))
    enough = F.least(1 + F.floor(n / 8), needed(n))     # least_shared()
    return hits.join(info, "tid").where(F.col("hits") >= enough).select("tid")


def addressed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Key, content address and whole text of every document."""
    df = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("t"))
    return df.select("doc_id", F.xxhash64("t").alias("tid"), "t")


def jaccard_join(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``(doc_id, tid, n_shingles, component_id)``, one row per row of ``docs``."""
    texts = addressed(docs, id_col, text_col)
    key = texts.schema["doc_id"].dataType.simpleString()
    digest = materialize(texts.mapInArrow(_digest(words), f"doc_id {key}, tid long, n long"), "shingle-digest")
    sizes = digest.where("n > 0").select("tid", "n").dropDuplicates(["tid"])
    need = materialize(_with_partners(texts, digest, sizes, words, percent), "text-ids")
    tokens, tokens_at = materialize_at(
        texts.join(bounded_broadcast(need, NEED_ROWS), "tid", "left_semi").select("tid", "t")
        .mapInArrow(_tokens(words), "tid long, toks array<long>")
        .groupBy("tid").agg(F.first("toks").alias("toks")), "token-sets")
    info = materialize(tokens.select("tid", F.size("toks").cast("long").alias("n")), "token-sizes")

    # Members of signatures that different texts share.
    spark = docs.sparkSession
    rows, rows_at = materialize_at(tokens.mapInArrow(_signs(percent), "tid long, sigs array<long>"), "signatures")
    slices = max(1, -(-(rows.agg(F.sum(F.size("sigs"))).first()[0] or 0) // SLICE_SIGNATURES))
    rows, members_at = rows.select(F.explode("sigs").alias("sig"), "tid"), scratch_path(spark, "signature-members")
    for i in range(slices):
        some = rows.where(F.pmod("sig", F.lit(slices)) == i)
        shared = (some.groupBy("sig").agg(F.min("tid").alias("head"), F.max("tid").alias("last"))
                  .where("head < last").select("sig", "head"))
        some.join(shared, "sig").select("sig", "tid", "head").distinct().write.mode("append").parquet(members_at)
    members = spark.read.schema("sig long, tid long, head long").parquet(members_at)
    discard(spark, rows_at)

    parts = _parts(members, info)
    cells = _head_cells(members, parts, percent)
    path, tiles = _stored(parts.withColumn("grp", F.col("tid")), tokens, cells, True, "part-tokens")
    discard(spark, tokens_at)      # the parts have those that are left
    links = _by_tile(cells, path, tiles, True, percent, "head-links")
    groups = components(links, "groups")
    more = _matrix_links(members, groups, info, _members(_parts_at(spark, path)), percent)
    for path in (path, members_at):     # the links are written
        discard(spark, path)
    comp = components(materialize(links.union(more), "links"), "components")

    # One row per document; the component's smallest key.
    rows = (digest.select("doc_id", "tid", "n").join(comp.withColumnRenamed("id", "tid"), "tid", "left")
            .select("doc_id", "tid", "n", F.coalesce("comp", "tid").alias("comp")))
    least = rows.where("n > 0").groupBy("comp").agg(F.min("doc_id").alias("least"))
    return rows.join(least, "comp", "left").select(
        "doc_id", "tid", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"))


def one_per_group(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` (all columns) with only the smallest key of each
    component kept, and of equal rows one."""
    cols = docs.columns
    found = materialize(jaccard_join(docs, words, percent), "near-duplicates")
    ranked = found.groupBy("component_id", "doc_id", "tid").agg(F.count(F.lit(1)).alias("copies"))
    first = (ranked.where("doc_id <=> component_id").groupBy("component_id", "doc_id")
             .agg(F.min("tid").alias("tid")))
    gone = ranked.join(first, ["component_id", "doc_id", "tid"], "left_anti").where("component_id is not null")
    key, at, held = fresh(docs, "text_key", "dropped_id", "dropped_key")
    gone = materialize(gone.select(F.col("doc_id").alias(at), F.col("tid").alias(held)), "dropped")
    keyed = docs.withColumn(key, F.xxhash64(whole_text("text")))
    same = F.col("doc_id").eqNullSafe(F.col(at)) & (F.col(key) == F.col(held))
    kept = keyed.join(bounded_broadcast(gone, NEED_ROWS), same, "left_anti")
    if ranked.where("copies > 1").limit(1).count():
        again = ranked.where("copies > 1").select(F.col("doc_id").alias(at), F.col("tid").alias(held))
        kept = kept.join(again, same, "left_anti").union(kept.join(again, same, "left_semi").dropDuplicates(["doc_id", key]))
    return kept.select(*cols)
