"""Sharding by a permutation-filled lookup table (DataFrame and SQL functions only).

The table has a prime number of slots. Each shard has a preference order over
the slots, ``(offset + j * skip) mod slots``, from hashes of its name. Shards
take turns; at its turn a shard claims the first slot of its order that is
still free, until all slots are claimed. A key is placed by one hash and one
lookup, and a lost shard moves few keys of the others.

The table has a fixed number of slots (a parameter, not a function of the
data), so its broadcast is bounded: one row of two integers per slot.

Defined results: a null key is placed by the hash of the row's text, so null
keys do not pile up on one shard (a null text counts as empty); equal keys
share a shard; an empty table gives no rows; other columns are not carried.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 65_537
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


def _number(s: str) -> int:
    return int(hashlib.md5(s.encode()).hexdigest()[:15], 16)


def lookup_table(shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> list[int]:
    """The shard number of each slot. ``slots`` must be prime and at least the
    number of shards, so that every preference order visits every slot."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct and at least one")
    if slots < max(2, len(shards)) or any(slots % d == 0 for d in range(2, int(slots ** 0.5) + 1)):
        raise ValueError("slots must be prime and not fewer than the shards")
    offset = [_number("offset:" + s) % slots for s in shards]
    skip = [_number("skip:" + s) % (slots - 1) + 1 for s in shards]
    at, owner, left = list(offset), [-1] * slots, slots
    while True:
        for i in range(len(shards)):
            while owner[at[i]] >= 0:
                at[i] = (at[i] + skip[i]) % slots
            owner[at[i]] = i
            left -= 1
            if not left:
                return owner


def table_frame(spark: SparkSession, owner: list[int]) -> DataFrame:
    """The lookup table as a DataFrame ``(slot, shard)``: one literal array, exploded."""
    text = ",".join(map(str, owner))
    return spark.range(1).select(F.posexplode(F.split(F.lit(text), ",")).alias("slot", "s")).select(
        "slot", F.col("s").cast("int").alias("shard"))


def slot_of(key: Column, slots: int) -> Column:
    """Slot of a key: the first 60 bits of its MD5, modulo the number of slots."""
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long"), F.lit(slots)).cast("int")


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """``(doc_id, slot, shard)`` for every row."""
    key = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text:"), F.md5(F.coalesce(F.col(text_col), F.lit("")))))
    df = docs.select(F.col(id_col).alias("doc_id"), slot_of(key, slots).alias("slot"))
    return df.join(F.broadcast(table_frame(docs.sparkSession, lookup_table(shards, slots))), "slot").select(
        "doc_id", "slot", "shard")
