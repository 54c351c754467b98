"""Periodic runs of words: descending-LCP Kruskal over the suffixes of each text.

A run is a stretch of consecutive words with smallest period q and length of at
least ``max(MIN_LENGTH, EXPONENT * q)`` that no neighbouring word extends. For
two positions i < j of a text whose suffixes agree on l words, the words from i
to j + l have period j - i; when no position between them agrees with both on l
words, that period is the smallest one. So the texts' neighbouring suffixes (in
suffix order, with the length of their agreement, the LCP) are united by
decreasing LCP with union-find. Each class keeps its positions in order, and a
pair that becomes adjacent in a class at a distance within the LCP seeds a run.
Of the seeds of a run only the leftmost counts: the one whose two positions
follow unequal words. LCPs shorter than any run needs end the descent.

Texts are handled in Arrow batches, some hundred thousand words at a time; one
suffix order serves all texts of such a group, as words of different texts never
agree. Only texts that repeat some five words enter it. Nothing is shuffled.

Defined results: a null or empty text has no words, no run and the empty
collapsed text; a text of any length is handled whole, in memory linear in its
length (times the logarithm of its longest repetition); repeated rows are
handled one by one; an empty table gives no rows; the key is carried as it is
(null included) and other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playtrail.llm.common import whole_text, word_array

MIN_LENGTH, EXPONENT = 6, 4
#: Two copies of a run's words, one period apart, agree on length - period words: 5 at least.
MIN_LCP = min(max(MIN_LENGTH, EXPONENT * q) - q for q in range(1, MIN_LENGTH + 1))
GROUP_WORDS = 200_000     # words of texts that share one suffix order
BLOCK = 2048              # positions of a class that share one list

RUN = T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")])


class Positions:
    """A class's positions in ascending order, in blocks of bounded length."""
    __slots__ = ("blocks", "firsts", "size")

    def __init__(self, position: int):
        self.blocks, self.firsts, self.size = [[position]], [position], 1

    def around(self, x: int) -> tuple[int, int]:
        """The nearest positions below and above ``x``; -1 where there is none."""
        i = bisect_right(self.firsts, x) - 1
        if i < 0:
            return -1, self.firsts[0]
        block = self.blocks[i]
        at = bisect_right(block, x)
        if at < len(block):
            return block[at - 1], block[at]
        return block[-1], self.firsts[i + 1] if i + 1 < len(self.firsts) else -1

    def add(self, x: int) -> None:
        i = max(bisect_right(self.firsts, x) - 1, 0)
        block = self.blocks[i]
        insort(block, x)
        if len(block) > BLOCK:
            half = block[BLOCK // 2:]
            del block[BLOCK // 2:]
            self.blocks.insert(i + 1, half)
            self.firsts.insert(i + 1, half[0])
        self.firsts[i] = block[0]
        self.size += 1

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block


def neighbours_by_lcp(ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours in suffix order with an LCP of at least ``MIN_LCP``, longest LCP
    first. ``ids`` are the words of all texts, different in different texts;
    ``ends[i]`` is the end of the text that word i belongs to."""
    n = len(ids)
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64)
    at, ranks, step = np.arange(n), [rank.astype(np.int32)], 1
    order = np.argsort(rank, kind="stable")
    while True:
        later = np.zeros(n, np.int64)
        inside = at + step < ends
        later[inside] = rank[at[inside] + step] + 1
        key = rank * (n + 1) + later
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        rank, step = new, step * 2
        if rank[order[-1]] == n - 1:
            break
        ranks.append(rank.astype(np.int32))
    a, b = order[:-1], order[1:]
    lcp = np.zeros(n - 1, np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        x, y = a + lcp, b + lcp
        ok = (x < ends[a]) & (y < ends[b])
        r = ranks[level]
        ok[ok] = r[x[ok]] == r[y[ok]]
        lcp[ok] += 1 << level
    keep = np.flatnonzero(lcp >= MIN_LCP)
    keep = keep[np.argsort(-lcp[keep], kind="stable")]
    return a[keep], b[keep], lcp[keep]


def seeds(a: np.ndarray, b: np.ndarray, lcp: np.ndarray) -> list[tuple[int, int, int]]:
    """(position, later position, LCP) of pairs that become adjacent in a class and
    are near enough for a run."""
    root: dict[int, int] = {}
    members: dict[int, Positions] = {}
    out: list[tuple[int, int, int]] = []

    def find(x: int) -> int:
        if x not in root:
            root[x], members[x] = x, Positions(x)
            return x
        top = x
        while root[top] != top:
            top = root[top]
        while root[x] != top:
            root[x], x = top, root[x]
        return top

    def seed(i: int, j: int, agree: int) -> None:
        if j - i + agree >= max(MIN_LENGTH, EXPONENT * (j - i)):
            out.append((i, j, agree))

    for i, j, agree in zip(a.tolist(), b.tolist(), lcp.tolist()):
        big, small = find(i), find(j)
        if members[big].size < members[small].size:
            big, small = small, big
        large, added = members[big], list(members.pop(small))
        # A pair is new when one side comes from either class and nothing lies between.
        for k, x in enumerate(added):
            low, high = large.around(x)
            if low >= 0 and (k == 0 or added[k - 1] < low):
                seed(low, x, agree)
            if high >= 0 and (k + 1 == len(added) or added[k + 1] > high):
                seed(x, high, agree)
        for x in added:
            large.add(x)
        root[small] = big
    return out


def group_runs(ids: np.ndarray, lengths: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
    """Runs (start, length, period) by text number, by start and then period. ``ids``
    are the words of all texts in a row, ``lengths`` the texts' numbers of words."""
    text = np.repeat(np.arange(len(lengths)), lengths)
    ends = np.repeat(np.cumsum(lengths), lengths)
    # Texts that repeat some MIN_LCP words; a chance agreement of hashes only adds a text.
    hashed = np.zeros(max(len(ids) - MIN_LCP + 1, 0), np.uint64)
    for k in range(MIN_LCP):
        hashed = (hashed * np.uint64(0x9E3779B97F4A7C15)) ^ (ids[k:k + len(hashed)].astype(np.uint64) + np.uint64(1))
    hashed = hashed * np.uint64(0xBF58476D1CE4E5B9)
    whole = np.arange(len(hashed)) + MIN_LCP <= ends[:len(hashed)]
    keys = np.sort((text[:len(hashed)][whole].astype(np.uint64) << np.uint64(40)) | (hashed[whole] >> np.uint64(24)))
    repeating = np.unique(keys[1:][keys[1:] == keys[:-1]] >> np.uint64(40)).astype(np.int64)
    out: dict[int, list[tuple[int, int, int]]] = {}
    if not len(repeating):
        return out
    chosen = np.flatnonzero(np.isin(text, repeating))
    sub, of = ids[chosen], text[chosen]
    first = np.searchsorted(of, of, side="left")
    distinct = of * (int(ids.max()) + 1) + sub
    least: dict[tuple[int, int], int] = {}
    for i, j, agree in seeds(*neighbours_by_lcp(distinct, np.searchsorted(of, of, side="right"))):
        if i == first[i] or sub[i - 1] != sub[j - 1]:
            # Pairs of one LCP that meet before a position between them does: the smaller period counts.
            run = (i, j - i + agree)
            least[run] = min(j - i, least.get(run, j - i))
    for (i, length), period in least.items():
        out.setdefault(int(of[i]), []).append((i - int(first[i]), length, period))
    for runs in out.values():
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period."""
    if not runs:
        return b" ".join(words)
    depth = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return b" ".join(words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist())


def _groups(texts: pa.Array) -> Iterator[tuple[int, list[list[bytes]]]]:
    """Consecutive texts as words, cut after ``GROUP_WORDS`` words."""
    start, group, held = 0, [], 0
    for i in range(len(texts)):
        text = texts[i].as_py()
        group.append(text.split() if text else [])    # bytes split at the six ASCII separators
        held += len(group[-1])
        if held >= GROUP_WORDS:
            yield start, group
            start, group, held = i + 1, [], 0
    if group:
        yield start, group


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    runs_type = pa.list_(pa.struct([pa.field(n, pa.int64(), False) for n in RUN.names]))
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for start, group in _groups(texts):
            lengths = np.array([len(w) for w in group])
            ids = pa.array([x for w in group for x in w], pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
            found = group_runs(ids, lengths)
            runs = [found.get(k, []) for k in range(len(group))]
            yield pa.record_batch({
                "doc_id": batch.column("doc_id").slice(start, len(group)),
                "n_words": pa.array(lengths, pa.int64()),
                "runs": pa.array([[dict(zip(RUN.names, r)) for r in rs] for rs in runs], runs_type),
                "collapsed": pa.array([collapse(w, rs) for w, rs in zip(group, runs)], pa.binary()).cast(pa.string())})


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per text: ``doc_id``, ``n_words``, ``runs`` (start, length, period; by start and
    then period) and ``collapsed``, the words no run holds after its first period,
    joined by one space."""
    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("n_words", T.LongType()),
                           T.StructField("runs", T.ArrayType(RUN, False)), T.StructField("collapsed", T.StringType())])
    return rows.mapInArrow(_scan, schema)


def with_planted_periods(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text``, where a tenth of the texts (by h = crc32 of the decimal
    key, h % 10 = 0) repeat from word a on: with g = h // 10 and n words, a = g % n
    and the period is 1 + (n - a) // (3 + g % 8). A null key changes nothing."""
    text = whole_text(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.crc32(F.col(id_col).cast("string")).alias("h"))
    g, n = F.floor(F.col("h") / 10), F.size("w")
    # Words only of the texts that change.
    rows = rows.withColumn("w", F.when(F.col("h") % 10 == 0, word_array(F.col("text"))))
    rows = rows.withColumn("a", F.when(n > 0, g % n))
    rows = rows.withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + g % 8)))
    back = lambda i: (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")
    changed = F.array_join(F.transform("w", lambda x, i: F.when(i < F.col("a"), x).otherwise(F.get("w", back(i)))), " ")
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), changed).otherwise(F.col("text")).alias("text"))


def digest_columns(found: DataFrame) -> DataFrame:
    """Number of runs, the run of the greatest length / period (ties: smallest start,
    then period) and the digests of all runs and of the collapsed text."""
    def better(best: Column, r: Column) -> Column:
        return F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)
    best = F.aggregate("runs", F.lit(None).cast(RUN), better)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"),
                                                              r["period"].cast("string")), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
