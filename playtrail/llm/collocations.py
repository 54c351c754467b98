"""Phrase collocation mining with stripes.

A stripe is one structure per prefix (a phrase of m - 1 words): an associative
counter of the words that follow it inside a piece. Each task counts stripes of
its texts and gives them out as arrays; stripes of a prefix are merged
elementwise, and the merged stripes yield all that mining needs: the extensions
(phrases of m words with their counts), the prefix totals (the entry of a prefix
in the stripe of its own first words; the sum of the empty prefix's stripe is the
number of words) and the largest extension of a prefix, which tells whether a
longer phrase subsumes it.

Stripes are made level by level, m = 1 to ``WORDS``, in one pass over the texts
each. A stripe is kept only for a frequent prefix, and takes in a next word only
where a sketch of the pass before lets the longer phrase through: counters of
hashed phrases (16-bit places in blocks, merged elementwise), whose frequent
places become a bitmap. A frequent phrase always passes; one that a chance hash
lets through is dropped by its exact count. Sketch and bitmaps have at most
``FILTER_BITS`` places (a bitmap of 128 MB), so what is broadcast is bounded; on
more text they let more through, and nothing is lost.

Prefixes are dealt to ``GROUPS`` groups by a checksum, and a task gives out the
stripes of a group in one row. The stripe of a heavy prefix (more than ``HEAVY``
occurrences and a 100,000th of all words; so there are at most 100,000) is cut
by a checksum of the next word into parts that go to different groups, and the
stripe of the empty prefix, which counts the words, into all groups. Counts meet in Spark's hash aggregate, which
spills; a task holds the words of ``CHUNK_BYTES`` of text (of one piece, if that
is longer) and nothing else.

Defined results: a null text is empty and a null language is ``und``; words and
pieces of any length count whole; repeated rows count each time; ties are
ordered by phrase; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playtrail.llm.common import discard, whole_text
from playtrail.plans.ordered import allow_partial_limit
from playtrail.session import materialize, materialize_at

WORDS = 4                 # words of the longest phrase
LEAST = 30                # occurrences of a candidate
TOP = 2000                # phrases given a language
SCALE = 2_000_000
SUBSUMED = (80, 100)      # a longer phrase with this share of the count subsumes

CHUNK_BYTES = 8 << 20     # text whose words are counted at once
GROUPS = 1024             # groups of stripes of a language, blocks of a sketch
HEAVY = 100_000           # occurrences of a prefix that are one part of its stripe
FILTER_BITS = 1 << 30     # places of a sketch, bits of a bitmap
LEAST_BITS = 1 << 18

MARK = b"\xff"            # ends a piece; no byte of UTF-8
# A-Z to a-z, the ends of pieces to the mark, tab to space.
TABLE = bytes(ord(MARK) if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Rows of a pass: a group's stripes (next words joined by spaces), or a block of the
#: sketch of phrases one word longer (places in their low and high 16 bits, and counts).
PASS = ("lang string, group int, stripes array<struct<prefix: string, nexts: string, counts: array<int>>>, "
        "block int, low binary, high binary, hits binary")
STRIPE = pa.struct([("prefix", pa.string()), ("nexts", pa.string()), ("counts", pa.list_(pa.int32()))])
PASS_TYPES = {"lang": pa.string(), "group": pa.int32(), "stripes": pa.list_(STRIPE),
              "block": pa.int32(), "low": pa.binary(), "high": pa.binary(), "hits": pa.binary()}
MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def _finish(mixed: np.ndarray) -> np.ndarray:
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return mixed ^ (mixed >> np.uint64(29))


def phrase_hash(lang: str, words: list[bytes]) -> int:
    """The hash of a phrase, as :meth:`Chunk.hashes_at` has it for all its places."""
    mixed = np.array([xxhash.xxh64_intdigest(lang.encode())], np.uint64)
    for k, word in enumerate(words):
        mixed += np.array([xxhash.xxh64_intdigest(word)], np.uint64) * np.uint64(MIX[k])
    return int(_finish(mixed)[0])


def places_for(n: int) -> int:
    """A power of two of about ``n``, within the bounds of a sketch."""
    return min(FILTER_BITS, max(LEAST_BITS, 1 << max(n - 1, 1).bit_length()))


class Filter:
    """A bitmap of hashes: no frequent phrase fails it."""

    def __init__(self, bits: int, bytes_: np.ndarray):
        self.bits, self.bytes = bits, bytes_

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        at = (hashes & np.uint64(self.bits - 1)).astype(np.int64)
        return (self.bytes[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _phrase_places(bits: int):
    def places(batches):
        for batch in batches:
            pairs = zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist())
            yield pa.record_batch({"place": pa.array([phrase_hash(g, [w.encode() for w in p.split(" ")]) & (bits - 1)
                                                      for g, p in pairs], pa.int64())})
    return places


def frequent_filter(phrases: DataFrame):
    """A broadcast :class:`Filter` of the table ``phrases`` (lang, phrase), with 16 to 32
    bits a phrase, put together in blocks by Spark's bitmap aggregate."""
    bits = places_for(16 * phrases.count())
    # Buckets count from 1 and hold 32,768 bits each, so place 0 goes in as 1; a bucket is 4,096 bytes.
    place = F.col("place") + 1
    blocks = phrases.select("lang", "phrase").mapInArrow(_phrase_places(bits), "place long").select(
        F.bitmap_bucket_number(place).alias("b"), F.bitmap_bit_position(place).alias("p"))
    held = np.zeros(max(bits // 8, 4096), np.uint8)
    for row in blocks.groupBy("b").agg(F.bitmap_construct_agg("p").alias("m")).collect():
        held[(row.b - 1) * 4096:row.b * 4096] = np.frombuffer(bytes(row.m), np.uint8)
    return phrases.sparkSession.sparkContext.broadcast(Filter(bits, held))


def _merge_sketch(places: int, least: int):
    """``places`` are the places of a block."""
    def merge(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, *parts, hits in zip(*(batch.column(c).to_pylist() for c in ("block", "low", "high", "hits"))):
                low, high = (np.frombuffer(p, np.uint16).astype(np.int64) for p in parts)
                at = high << 16 | low
                counter = held.setdefault(block, np.zeros(places, _hit_type(least)))
                # Places differ within a row; a counter stops at ``least``.
                counter[at] = np.minimum(counter[at].astype(np.int64) + np.frombuffer(hits, _hit_type(least)), least)
        found = {b: np.packbits(c >= least, bitorder="little") for b, c in held.items() if (c >= least).any()}
        yield pa.record_batch({"block": pa.array(list(found), pa.int32()),
                               "bits": pa.array([zlib.compress(v.tobytes(), 1) for v in found.values()], pa.binary())})
    return merge


def _hit_type(least: int):
    return np.uint8 if least < 256 else np.uint32


def block_places(bits: int) -> int:
    """Places of a block: ``bits`` in ``GROUPS`` blocks, at least a byte of bits each."""
    return max(bits // GROUPS, 8)


def sketch_filter(rows: DataFrame, bits: int, least: int):
    """A broadcast :class:`Filter` of the sketch's places that reach ``least``. Each block
    (at most a million counters) is merged by one task; what comes back is the bitmap."""
    places = block_places(bits)
    blocks = rows.where("block is not null").select("block", "low", "high", "hits").repartition("block")
    held = np.zeros(bits // 8, np.uint8)
    for row in blocks.mapInArrow(_merge_sketch(places, least), "block int, bits binary").collect():
        held[row.block * places // 8:(row.block + 1) * places // 8] = np.frombuffer(zlib.decompress(bytes(row.bits)), np.uint8)
    return rows.sparkSession.sparkContext.broadcast(Filter(bits, held))


class Chunk:
    """Words of some text of one language, as numbers."""

    def __init__(self, lang: str, data: bytes):
        self.lang = lang
        split = pc.split_pattern(pa.array([data.replace(MARK, b" \xff ")], pa.large_binary()), " ").flatten()
        split = split.filter(pc.not_equal(pc.binary_length(split), 0)).dictionary_encode()
        self.ids = split.indices.to_numpy().astype(np.int64)
        self.words: list[bytes] = split.dictionary.to_pylist()
        self.hashes = np.array([xxhash.xxh64_intdigest(w) for w in self.words], np.uint64)
        self.mark = self.words.index(MARK) if MARK in self.words else -1
        self.breaks = np.concatenate([[0], np.cumsum(self.ids == self.mark)])

    def starts(self, m: int) -> np.ndarray:
        """Places where ``m`` words in a row begin, inside one piece."""
        at = np.arange(max(len(self.ids) - m + 1, 0))
        return at[self.breaks[at + m] == self.breaks[at]]

    def hashes_at(self, at: np.ndarray, m: int) -> np.ndarray:
        mixed = np.full(len(at), xxhash.xxh64_intdigest(self.lang.encode()), np.uint64)
        for k in range(m):
            mixed += self.hashes[self.ids[at + k]] * np.uint64(MIX[k])
        return _finish(mixed)

    def sketch(self, at: np.ndarray, m: int, bits: int, least: int) -> dict:
        """Counters of the phrases of ``m`` words at ``at``: a row per block of places."""
        places, hits = np.unique(self.hashes_at(at, m) & np.uint64(bits - 1), return_counts=True)
        block, inner = np.divmod(places.astype(np.int64), block_places(bits))
        hits = np.minimum(hits, least).astype(_hit_type(least))
        first = _runs(block)
        spans = list(zip(first, np.append(first[1:], len(block))))
        low, high = (inner & 0xFFFF).astype(np.uint16), (inner >> 16).astype(np.uint16)
        return {"block": block[first], **{c: [v[i:j].tobytes() for i, j in spans] for c, v in (("low", low), ("high", high), ("hits", hits))}}

    def stripes(self, names: list[bytes], prefix: np.ndarray, following: np.ndarray, counts: np.ndarray, parts: np.ndarray) -> dict:
        """Groups of stripes. Each prefix has a name and a number of parts; its entries
        are (prefix number, next word, count) in arrays."""
        sums = np.array([zlib.crc32(w) for w in self.words], np.int64)
        home = np.array([zlib.crc32(w) for w in names], np.int64)
        group = (home[prefix] + sums[following] % parts[prefix]) % GROUPS
        order = np.lexsort((prefix, group))
        group, prefix, following, counts = group[order], prefix[order], following[order], counts[order]
        first = _runs(group * (len(names) + 1) + prefix)              # stripes
        offsets = np.append(first, len(order))
        words = pa.array(self.words, pa.binary()).take(pa.array(following))
        nexts = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), words), b" ").cast(pa.string())
        held = pa.array(names, pa.binary()).take(pa.array(prefix[first])).cast(pa.string())
        per_stripe = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(counts, pa.int32()))
        whole = pa.StructArray.from_arrays([held, nexts, per_stripe], fields=list(STRIPE))
        rows = _runs(group[first])
        return {"lang": [self.lang] * len(rows), "group": group[first][rows],
                "stripes": pa.ListArray.from_arrays(pa.array(np.append(rows, len(first)), pa.int32()), whole)}


def _runs(sorted_values: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values."""
    if not len(sorted_values):
        return np.zeros(0, np.int64)
    return np.concatenate([[0], np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1])


def _count(chunk: Chunk, level: int, known, passing, heavy: dict, bits: int, least: int, longest: int) -> Iterator[dict]:
    """Stripes of one level, and the sketch of the next. ``known`` holds the frequent
    prefixes of the level, ``passing`` the sketch of its phrases, ``heavy`` the parts
    of heavy prefixes."""
    at = chunk.starts(level)
    none = len(chunk.words)
    if level == 1:
        numbers, counts = np.unique(chunk.ids[at], return_counts=True)
        yield chunk.stripes([b""], np.zeros(len(numbers), np.int64), numbers, counts, np.array([GROUPS]))
        longer = chunk.starts(2)
    else:
        m = level - 1
        starts = chunk.starts(m)
        starts = starts[known.holds(chunk.hashes_at(starts, m))]
        frequent = np.zeros(len(chunk.ids) + 1, bool)
        frequent[starts] = True
        at = at[frequent[at] & frequent[at + 1]]
        at = at[passing.holds(chunk.hashes_at(at, level))]
        # Numbers of the distinct prefixes, word by word.
        number = chunk.ids[at]
        for k in range(1, m):
            number = np.unique(number * none + chunk.ids[at + k], return_inverse=True)[1]
        _, first, number = np.unique(number, return_index=True, return_inverse=True)
        names = [b" ".join(chunk.words[j] for j in chunk.ids[i:i + m].tolist()) for i in at[first].tolist()]
        parts = np.array([heavy.get((chunk.lang, name), 1) for name in names], np.int64)
        pairs, counts = np.unique(number * none + chunk.ids[at + m], return_counts=True)
        yield chunk.stripes(names, pairs // max(none, 1), pairs % max(none, 1), counts, parts)
        passed = np.zeros(len(chunk.ids) + 1, bool)
        passed[at] = True
        longer = chunk.starts(level + 1)
        longer = longer[passed[longer] & passed[longer + 1]]
    if level < longest:
        yield chunk.sketch(longer, level + 1, bits, least)


def _chunks(batches: Iterator[pa.RecordBatch], chunk_bytes: int) -> Iterator[Chunk]:
    """Texts of a task by language, about ``chunk_bytes`` at a time, cut at ends of pieces."""
    waiting: dict[str, list[bytes]] = {}
    size = 0

    def full() -> Iterator[Chunk]:
        for lang, texts in waiting.items():
            data, start = MARK.join(texts), 0
            while start < len(data):
                end = data.find(MARK, start + chunk_bytes)
                end = len(data) if end < 0 else end + 1
                yield Chunk(lang, data[start:end])
                start = end

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary())):
            data = text.as_py().translate(TABLE)
            waiting.setdefault(lang, []).append(data)
            size += len(data)
            if size >= chunk_bytes:
                yield from full()
                waiting, size = {}, 0
    yield from full()


def _pass(level: int, known, passing, heavy, bits: int, least: int, longest: int, chunk_bytes: int = CHUNK_BYTES):
    def run(batches):
        shared = [b.value if b is not None else None for b in (known, passing, heavy)]
        for chunk in _chunks(batches, chunk_bytes):
            for rows in _count(chunk, level, *shared, bits, least, longest):
                n = len(rows[next(iter(rows))])
                columns = {c: pa.array(rows[c], t) if c in rows and not isinstance(rows[c], pa.Array) else
                           rows[c] if c in rows else pa.nulls(n, t) for c, t in PASS_TYPES.items()}
                batch = pa.record_batch(columns)
                for i in range(0, n, 64):
                    yield batch.slice(i, 64)
    return run


def merged_stripes(rows: DataFrame) -> DataFrame:
    """Merged stripes of a pass in long form: lang, prefix, next, n."""
    # A group of stripes meets once; the elementwise sum needs no further exchange.
    groups = rows.where("group is not null").select("lang", "group", "stripes").repartition("lang", "group")
    one = groups.select("lang", "group", F.explode("stripes").alias("s"))
    entries = F.explode(F.arrays_zip(F.split("s.nexts", " ").alias("next"), F.col("s.counts").alias("n")))
    long = one.select("lang", "group", "s.prefix", entries.alias("e")).select("lang", "group", "prefix", "e.next", "e.n")
    return long.groupBy("lang", "group", "prefix", "next").agg(F.sum("n").alias("n")).drop("group")


def heavy_prefixes(phrases: DataFrame, words: int, per_part: int = HEAVY):
    """A broadcast dict from (lang, phrase) of heavy phrases to the parts of their
    stripes. A phrase is heavy above a 100,000th of all ``words``, so they are few."""
    heavy = phrases.where(F.col("n") > max(per_part, words // 100_000)).select("lang", "phrase", "n").collect()
    return phrases.sparkSession.sparkContext.broadcast({(r.lang, r.phrase.encode()): 1 + r.n // per_part for r in heavy})


def phrase_counts(docs: DataFrame, words: int = WORDS, least: int = LEAST, text_col: str = "text",
                  lang_col: str = "lang", chunk_bytes: int = CHUNK_BYTES, per_part: int = HEAVY) -> tuple[DataFrame, list[DataFrame]]:
    """(totals, levels): ``totals`` has ``lang`` and ``n``, its number of words;
    ``levels[m - 1]`` the frequent part of the merged stripes of level m: lang,
    prefix, phrase, n."""
    if not 2 <= words < len(MIX):
        raise ValueError(f"phrases have 2 to {len(MIX) - 1} words")
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), whole_text(text_col).alias("text"))
    # Words have some six bytes, so this is about one place a word.
    bits = places_for((rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // 6)
    levels: list[DataFrame] = []
    known = passing = heavy = None
    for level in range(1, words + 1):
        given, path = materialize_at(rows.mapInArrow(_pass(level, known, passing, heavy, bits, least, words, chunk_bytes), PASS), f"stripes-{level}")
        merged = merged_stripes(given)
        if level == 1:
            merged = materialize(merged, "words")
            totals = materialize(merged.groupBy("lang").agg(F.sum("n").alias("n")), "words-by-lang")
            n_words = totals.agg(F.sum("n")).first()[0] or 0
        phrase = F.concat(F.when(F.col("prefix") == "", "").otherwise(F.concat("prefix", F.lit(" "))), "next")
        phrases = materialize(merged.where(F.col("n") >= least).select("lang", "prefix", phrase.alias("phrase"), "n"), f"phrases-{level}")
        levels.append(phrases)
        if level < words:
            known, passing = frequent_filter(phrases), sketch_filter(given, bits, least)
            heavy = heavy_prefixes(phrases, n_words, per_part)
        discard(docs.sparkSession, path)          # merged and written, or sent out
    return totals, levels


def _big(name: str):
    return F.col(name).cast("decimal(20,0)")


def collocations(docs: DataFrame, words: int = WORDS, least: int = LEAST, top: int = TOP, **options) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a (its count), l and r
    (the counts of the two parts of its weakest cut), n (words of the language) and
    score = floor(2000000 a / (l + r)). Phrases that a longer candidate subsumes go."""
    totals, levels = phrase_counts(docs, words, least, **options)
    spark = docs.sparkSession
    candidates = materialize(_union([df.select("lang", "phrase", F.col("n").alias("a"), "prefix", F.lit(m).alias("m"))
                                     for m, df in enumerate(levels[1:], 2)]), "phrases")
    part_counts = _union([df.select("lang", F.col("phrase").alias("part"), F.col("n").alias("f")) for df in levels[:-1]])
    # The largest extension of a phrase to the right (its stripe's maximum) and to the left.
    left_out = F.expr("substring(phrase, instr(phrase, ' ') + 1)")
    longer = candidates.where("m > 2")
    longest = longer.groupBy("lang", F.col("prefix").alias("phrase")).agg(F.max("a").alias("x")).unionByName(
        longer.groupBy("lang", left_out.alias("phrase")).agg(F.max("a").alias("x"))).groupBy("lang", "phrase").agg(F.max("x").alias("longest"))
    share, whole = SUBSUMED
    kept = candidates.join(longest, ["lang", "phrase"], "left").where(
        F.col("longest").isNull() | (_big("longest") * whole < _big("a") * share)).drop("longest", "prefix")
    # Every cut as two parts, each frequent as the whole is.
    w = F.split("phrase", " ")
    cut = F.explode(F.expr("sequence(1, m - 1)")).alias("k")
    cuts = kept.select("lang", "phrase", "a", "m", cut).withColumns({
        "first": F.array_join(F.slice(w, F.lit(1), F.col("k")), " "),
        "rest": F.array_join(F.slice(w, F.col("k") + 1, F.col("m") - F.col("k")), " ")})
    sides = cuts.select("lang", "phrase", "a", "k", F.explode(F.array(
        F.struct(F.lit(True).alias("is_l"), F.col("first").alias("part")),
        F.struct(F.lit(False).alias("is_l"), F.col("rest").alias("part")))).alias("s")).select("lang", "phrase", "a", "k", "s.*")
    counted = sides.join(part_counts, ["lang", "part"]).groupBy("lang", "phrase", "a", "k").agg(
        F.max(F.when(F.col("is_l"), F.col("f"))).alias("l"), F.max(F.when(~F.col("is_l"), F.col("f"))).alias("r"))
    score = F.expr(f"cast(cast(a as decimal(20,0)) * cast({SCALE} as decimal(7,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0))) as long)")
    best = counted.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
    allow_partial_limit(spark, top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase")))
    ranked = best.select("lang", "phrase", "a", "b.l", "b.r", "b.score").withColumn("rank", rank.cast("long")).where(F.col("rank") <= top)
    return ranked.join(F.broadcast(totals), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out
