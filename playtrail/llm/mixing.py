"""Mixing sources to target weights by proportionate-fair scheduling.

Rows of a source, in hash order, form blocks. Block ``i`` of a source of weight
``w`` is released at slot ``floor((i - 1) / w)`` and due at ``ceil(i / w)``; of the
released blocks the one due first takes the slot. Every prefix of the schedule
then holds each source's share to within less than one block, for as long as
every source has blocks left.

Weights are whole shares ``a`` of a cycle of ``Q`` slots, and such a schedule
repeats each cycle. So one cycle is computed once (``Q`` rows, a parameter and
not a function of the data) and each block finds its slot by a lookup:
``cycle * Q + slot of its number within the cycle``. A source that runs out
leaves its slots empty; nothing is dropped or repeated.

Defined results: a null source is a source of its own; repeated rows take places
of their own; a source without a given weight shares what is left like the
smallest one; an empty table gives no rows; other columns are not carried.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtrail.llm.common import fresh, whole_text
from playtrail.plans.ordered import global_row_number
from playtrail.session import materialize

CYCLE = 10_000        # slots of a cycle
BLOCK_ROWS = 16       # rows of a block
POWER = 0.5           # default weights: number of rows to this power
MAX_SOURCES = 5_000   # more must be grouped by the caller


def shares(weights: dict, cycle: int = CYCLE) -> dict:
    """Whole shares of the cycle, at least one each, by largest remainder."""
    if len(weights) > min(MAX_SOURCES, cycle // 2):
        raise ValueError(f"{len(weights)} sources; group them to at most {min(MAX_SOURCES, cycle // 2)}")
    if any(not w > 0 or math.isinf(w) for w in weights.values()):
        raise ValueError("weights must be positive and finite")
    total, free = math.fsum(weights.values()), cycle - len(weights)
    exact = {s: w / total * free for s, w in weights.items()}
    out = {s: 1 + math.floor(x) for s, x in exact.items()}
    rest = sorted(exact, key=lambda s: (math.floor(exact[s]) - exact[s], s is not None, s or ""))
    for s in rest[:cycle - sum(out.values())]:
        out[s] += 1
    return out


def pfair_cycle(share: dict, cycle: int = CYCLE) -> list[tuple]:
    """``(source, number within the cycle, slot)`` for one cycle: earliest
    deadline first among released blocks, ties by source."""
    order = sorted(share, key=lambda s: (s is not None, s or ""))
    waiting, ready, out = [(0, i, 1) for i in range(len(order))], [], []
    heapq.heapify(waiting)
    for slot in range(cycle):
        while waiting and waiting[0][0] <= slot:
            _, i, k = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-k * cycle // share[order[i]]), i, k))
        due, i, k = heapq.heappop(ready)
        if due <= slot:
            raise AssertionError("missed deadline")
        out.append((order[i], k, slot))
        if k < share[order[i]]:
            heapq.heappush(waiting, (k * cycle // share[order[i]], i, k + 1))
    return out


def default_weights(docs: DataFrame, source_col: str = "source", power: float = POWER) -> dict:
    """Number of rows of each source to the given power (one row per source)."""
    rows = docs.groupBy(F.col(source_col).cast("string").alias("s")).count().limit(MAX_SOURCES + 1).collect()
    return {r["s"]: float(r["count"]) ** power for r in rows}


def mix(docs: DataFrame, weights: dict | None = None, id_col: str = "doc_id", source_col: str = "source",
        block_rows: int = BLOCK_ROWS, cycle: int = CYCLE, carry: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, source, block, slot, place)``: the block of each row, the slot of
    the block in the mixture and the row's place in the block (all from 0)."""
    spark = docs.sparkSession
    own = default_weights(docs, source_col)
    if weights is not None:
        least = min(weights.values(), default=1.0)
        own = {s: weights.get(s, least) for s in own}
    share = shares(own, cycle) if own else {}
    rows = pfair_cycle(share, cycle) if own else []
    # Numbering by a range-partitioned sort, so a hot source is many tasks; keys only.
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), *carry)
    narrow = narrow.withColumn("h", F.xxhash64(F.col("doc_id").cast("string"), "source"))
    numbered = global_row_number(narrow, ["source", "h", "doc_id", *carry], "rn")
    start = numbered.groupBy(F.col("source").alias("s")).agg(F.min("rn").alias("start"))
    placed = (numbered.join(F.broadcast(start), F.col("source").eqNullSafe(F.col("s")))  # at most MAX_SOURCES rows
              .withColumn("i", F.col("rn") - F.col("start"))
              .withColumn("block", F.floor(F.col("i") / block_rows).cast("long")))
    table = spark.createDataFrame(
        [(s, share[s], k, slot) for s, k, slot in rows], "ps string, share long, k long, at long")
    placed = placed.join(F.broadcast(table.select(F.col("ps").alias("ss"), "share").distinct()), F.col("source").eqNullSafe(F.col("ss")))
    placed = placed.withColumn("k_", F.col("block") % F.col("share") + 1)
    out = placed.join(F.broadcast(table.select("ps", "k", "at")), F.col("source").eqNullSafe(F.col("ps")) & (F.col("k_") == F.col("k")))
    return out.select("doc_id", "source", "block",
                      (F.floor(F.col("block") / F.col("share")).cast("long") * cycle + F.col("at")).alias("slot"),
                      (F.col("i") % block_rows).alias("place"), *carry)


def in_mixture_order(docs: DataFrame, weights: dict | None = None) -> DataFrame:
    """All rows and columns of ``docs``, sorted by slot and place over the output
    files: reading them in order reads the mixture."""
    key, at = fresh(docs, "text_key", "mixture_at")
    keyed = docs.withColumn(key, F.md5(whole_text("text").cast("binary")))
    order = mix(keyed.select("doc_id", "source", key), weights, carry=(key,))
    ids = fresh(keyed, "mixture_id", "mixture_source", "mixture_key")
    order = materialize(order.groupBy(*[F.col(c).alias(n) for c, n in zip(("doc_id", "source", key), ids)])
                        .agg(F.min(F.struct("slot", "place")).alias(at)), "mixture-order")
    same = (F.col("doc_id").eqNullSafe(F.col(ids[0])) & F.col("source").cast("string").eqNullSafe(F.col(ids[1]))
            & (F.col(key) == F.col(ids[2])))
    return keyed.join(order, same).orderBy(at).select(*docs.columns)
