"""SentencePiece encoding and decoding over a relational lattice of words.

A text is cut into words wherever no piece holds the two neighbouring characters
side by side: no piece can cross there, so the words have the codes they have in
the text. Each frequent word of the corpus is encoded once: its substrings (up to
the longest piece) are exploded and equi-joined to the piece table, the edges are
grouped by word, and a Spark higher-order ``aggregate`` folds the lattice.
Characters without a piece become byte pieces.

The fold depends on the model type. ``unigram`` tables fold Viterbi: the best
sum of scores up to each position. A BPE model assigns other pieces than the
best sum of its scores, so for ``bpe`` the fold applies, step by step, the best
scored edge that spans two neighbouring pieces, leftmost first: these are the
codes the model's own library gives.

Words are counted over the whole corpus. The most frequent (at most ``COMMON``, of
up to ``SHORT`` characters) make the word table, which is broadcast. A word beyond
it stands in few texts, so its lattice (the same join and folds over arrays,
``Lattice``) is made in the task that codes the text: neither texts nor the
corpus's rare words are shuffled, whatever their number.

Defined results: a null or empty text has no codes; repeated rows get equal
codes; an empty table gives no rows; a null key is kept; other columns are not
carried. Decoding joins the pieces, turns word marks to spaces and drops the
one in front; unknown codes raise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playtrail.llm.common import whole_text
from playtrail.session import materialize

MODEL = "/opt/tokenizers/piece_bpe_32k.model"   # a public vocabulary file; the path is a parameter
MARK = "▁"
COMMON = 300_000     # words of the broadcast table at most
SHORT = 64           # characters of its words at most
BYTE0 = 3            # code of byte piece <0x00>
BYTES = 2_000_000    # of texts coded together
HELD = 150_000       # words that a task counts before it sends them, about
WIDEN = 4            # tasks of the lattice, times the shuffle partitions


class Pieces:
    """The piece table of a model file: (text, code, score) of ordinary pieces."""

    def __init__(self, path: str = MODEL):
        import sentencepiece
        p = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(p.get_piece_size()) if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i) or p.is_unused(i))]
        self.rows = [(p.id_to_piece(i), i, float(p.get_score(i))) for i in ids]
        self._ready()

    @classmethod
    def of(cls, rows: list[tuple[str, int, float]]) -> Pieces:
        new = cls.__new__(cls)
        new.rows = rows
        new._ready()
        return new

    def _ready(self) -> None:
        self.longest = max(len(t) for t, _, _ in self.rows)
        # [last byte of a character, first byte of the next]: no piece holds the two side by side.
        self.cut = np.ones((256, 256), dtype=bool)
        self.cut[:, 0x80:0xC0] = False
        for a, b in {(x, y) for t, _, _ in self.rows for x, y in zip(t, t[1:])}:
            self.cut[_as_text(a)[-1], _as_text(b)[0]] = False

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, "sub string, code int, score double")


def _as_text(piece: str) -> bytes:
    """The bytes a piece stands for: a word mark is a space."""
    return piece.replace(MARK, " ").encode("utf-8")


def _words(texts: pa.Array, cut: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The words of all ``texts`` in a row, word marks as spaces, and the number of each text."""
    texts = pc.replace_substring(texts, MARK, " ")
    texts = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(" ", texts, ""))
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
    ends = ends - ends[0]
    start = np.zeros(len(data) + 1, dtype=bool)
    if len(data):
        start[1:-1] = cut.ravel()[(data[:-1].astype(np.uint16) << 8) | data[1:]]
    start[ends] = True
    at = np.flatnonzero(start).astype(np.int32)    # the last is the end of the data
    words = pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(data)))
    return words, np.diff(np.searchsorted(at, ends))


def _slices(batches: Iterator[pa.RecordBatch], col: str, most: int) -> Iterator[pa.RecordBatch]:
    """Batches cut into runs of rows of about ``most`` bytes or elements of ``col``."""
    for b in batches:
        if not b.num_rows:
            continue
        c = b.column(col)
        size = pc.binary_length(c) if pa.types.is_string(c.type) else pc.list_value_length(c)
        part = np.cumsum(size.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)) // most
        edges = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [b.num_rows]])
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
            yield b.slice(lo, hi - lo)


def _counts(cut: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def summed() -> pa.Table:
            both = pa.concat_tables(held).group_by("word").aggregate([("n", "sum")])
            return pa.table({"word": both.column("word"), "n": both.column("n_sum")})
        for b in _slices(batches, "t", BYTES):
            found = _words(b.column("t"), cut)[0].value_counts()
            held.append(pa.table({"word": pc.replace_substring(found.field("values"), " ", MARK), "n": found.field("counts")}))
            if sum(h.num_rows for h in held) > 2 * HELD:
                held[:] = [summed()]
                if held[0].num_rows > HELD:
                    yield from held.pop().to_batches()
        if held:
            yield from summed().to_batches()
        pa.default_memory_pool().release_unused()    # the worker goes on with other tasks
    return run


def _bytes_of(ch: Column) -> Column:
    h = F.hex(F.encode(ch, "UTF-8"))
    return F.transform(F.sequence(F.lit(0), (F.length(h) / 2 - 1).cast("int")), lambda i: F.conv(
        F.substr(h, (2 * i + 1).cast("int"), F.lit(2)), 16, 10).cast("int") + BYTE0)


def fold_bpe(n: Column, edges: Column) -> Column:
    """Start positions of the pieces, ended by ``n``; ``edges`` best first. The state
    holds the positions left and the edges between them that can still be used."""
    def joins(b, e):
        i = F.array_position(b, e["s"]).cast("int")
        return (i > 0) & (F.get(b, i + 1) == e["e"])

    def step(state, _):
        b, alive = state["b"], state["e"]
        best = F.slice(F.filter(alive, lambda e: joins(b, e)), 1, 1)   # arrays of one or none bind a value once
        gone = F.transform(best, lambda x: F.get(b, F.array_position(b, x["s"]).cast("int")))
        after = F.transform(gone, lambda g: F.struct(
            F.array_remove(b, g).alias("b"), F.filter(alive, lambda e: (e["s"] != g) & (e["e"] != g)).alias("e")))
        return F.coalesce(F.get(after, F.lit(0)), F.struct(b.alias("b"), F.slice(alive, 1, 0).alias("e")))
    wide = F.filter(edges, lambda e: e["e"] - e["s"] > 1)              # one character spans no two pieces
    state = F.struct(F.sequence(F.lit(0), n).alias("b"), wide.alias("e"))
    return F.aggregate(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), state, step, lambda done: done["b"])


def fold_viterbi(n: Column, edges: Column) -> Column:
    """As ``fold_bpe``, for the best sum of scores: the state holds, for each
    position so far, the best sum up to it and where its last piece starts.
    A character without an edge costs ``UNKNOWN``."""
    state = F.array(F.struct(F.lit(0.0).alias("v"), F.lit(-1).alias("p")))

    def step(acc, i):
        ends = F.transform(F.filter(edges, lambda e: e["e"] == i), lambda e: F.struct(
            (F.get(acc, e["s"])["v"] - e["cost"]).alias("v"), e["s"].alias("p")))
        fallback = F.struct((F.get(acc, i - 1)["v"] + UNKNOWN).alias("v"), (i - 1).alias("p"))
        return F.concat(acc, F.array(F.array_max(F.concat(ends, F.array(fallback)))))
    table = F.aggregate(F.sequence(F.lit(1), n), state, step)
    back = F.aggregate(F.sequence(F.lit(1), n), F.array(n), lambda path, _: F.when(
        F.get(path, F.lit(0)) <= 0, path).otherwise(F.concat(F.array(F.get(table, F.get(path, F.lit(0)))["p"]), path)))
    return back


UNKNOWN = -1e6


def word_table(words: DataFrame, pieces: Pieces, model: str = "bpe") -> DataFrame:
    """Codes of each distinct word: ``(word, n, codes)``."""
    n = F.length("word")
    subs = words.select("word", "n", F.explode(F.sequence(F.lit(0), n - 1)).alias("s")).select(
        "word", "n", "s", F.explode(F.sequence(F.lit(1), F.least(F.lit(pieces.longest), n - F.col("s")))).alias("len"))
    subs = subs.withColumn("sub", F.substr("word", F.col("s") + 1, F.col("len")))
    edge = F.struct((-F.col("score")).alias("cost"), F.col("s").alias("s"), (F.col("s") + F.col("len")).alias("e"),
                    F.col("code").alias("code"))
    table = F.broadcast(pieces.frame(words.sparkSession))    # the vocabulary: a fixed size
    # A word keeps its edges, and its first substring should it have none. The
    # word's partitioning is kept, so grouping moves nothing.
    found = (subs.join(table, "sub", "left").where("code is not null or (s = 0 and len = 1)")
             .select("word", "n", "s", "len", "code", "score").groupBy("word", "n")
             .agg(F.sort_array(F.collect_list(F.when(F.col("code").isNotNull(), edge))).alias("edges")))
    fold = {"bpe": fold_bpe, "unigram": fold_viterbi}[model]
    found = found.withColumn("cuts", fold(F.length("word"), F.col("edges")))

    def code(s, i):
        e = F.get("cuts", i + 1)
        hit = F.get(F.filter("edges", lambda x: (x["s"] == s) & (x["e"] == e)), F.lit(0))
        return F.when(hit.isNotNull(), F.array(hit["code"])).otherwise(_bytes_of(F.substr("word", s + 1, e - s)))
    spans = F.slice("cuts", F.lit(1), F.size("cuts") - 1)
    return found.select("word", "n", F.flatten(F.transform(spans, code)).alias("codes"))


class Table:
    """Words and their codes, in flat arrays."""

    def __init__(self, words: pa.Array, codes: pa.ListArray):
        self.words = words
        self.size = codes.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.codes = codes.flatten().to_numpy(zero_copy_only=False).astype(np.int32)

    def where(self, words: pa.Array) -> np.ndarray:
        """The row of each word, -1 for none."""
        return pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy(zero_copy_only=False)


def _gather(pool: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs ``pool[start:start + size]``, one after another."""
    shift = (start - (np.cumsum(size) - size)).astype(np.int32)
    return pool[np.repeat(shift, size) + np.arange(size.sum(), dtype=np.int32)]


def common_words(counts: DataFrame, most: int = COMMON) -> DataFrame:
    """The most frequent short words of ``(word, n)``, at most ``most``. The least
    count of a common word follows from a histogram of the counts."""
    step = F.floor(F.log2("n") * 16)
    short = counts.where(F.length("word") <= SHORT)
    least, total = None, 0
    for bar in short.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():  # some hundred rows
        if total + bar["count"] > most:
            break
        least, total = bar["step"], total + bar["count"]
    return short.where(step >= F.lit(least)) if least is not None else short.limit(0)


def as_table(words: DataFrame) -> Table:
    """The word table ``(word, codes)`` in flat arrays: at most ``COMMON`` short words."""
    got = words.select("word", "codes").toArrow().combine_chunks()
    codes = got.column("codes")
    codes = codes.chunk(0) if codes.num_chunks else pa.array([], pa.list_(pa.int32()))
    texts = got.column("word").cast(pa.string())
    texts = texts.chunk(0) if texts.num_chunks else pa.array([], pa.string())
    return Table(pc.replace_substring(texts, MARK, " "), codes)


class Lattice:
    """The lattice of the words of a slice, over arrays. The piece table is a sorted
    array of prefixes: substrings are joined to it one character after another, and
    those that begin no piece go."""

    def __init__(self, pieces: Pieces, model: str):
        known: dict[tuple[int, int], int] = {}
        ends = []
        for text, code, score in pieces.rows:
            node = 0
            for ch in text.replace(MARK, " "):
                node = known.setdefault((node, ord(ch)), len(known) + 1)
            ends.append((node, code, score))
        self.model, self.longest = model, pieces.longest
        key = np.array([(node << 21) | ch for node, ch in known] or [-1], np.int64)
        order = np.argsort(key)
        self.key, self.child = key[order], np.array([*known.values()] or [0], np.int64)[order]
        self.code, self.score = np.full(len(known) + 1, -1, np.int32), np.zeros(len(known) + 1)
        for node, code, score in ends:
            self.code[node], self.score[node] = code, score

    def _edges(self, chars: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, length and node of every substring that is a piece."""
        at, node = np.arange(len(chars)), np.zeros(len(chars), np.int64)
        out = [(at[:0], at[:0], at[:0])]
        for n in range(1, self.longest + 1):
            fits = room[at] >= n
            at, node = at[fits], node[fits]
            key = (node << 21) | chars[at + n - 1]
            i = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            hit = self.key[i] == key
            at, node = at[hit], self.child[i[hit]]
            piece = self.code[node] >= 0
            out.append((at[piece], np.full(piece.sum(), n), node[piece]))
            if not len(at):
                break
        return tuple(np.concatenate(c) for c in zip(*out))

    @staticmethod
    def _bpe(word: np.ndarray, s: np.ndarray, e: np.ndarray, score: np.ndarray, places: int) -> np.ndarray:
        """As ``fold_bpe``, for all words in step: each applies its best edge that spans
        two neighbouring pieces, leftmost first. Returned is where pieces start or end."""
        cut, after = np.ones(places, dtype=bool), np.arange(1, places + 1)
        wide = np.flatnonzero(e - s > 1)           # one character spans no two pieces
        wide = wide[np.lexsort((e[wide], s[wide], -score[wide], word[wide]))]
        word, s, e = word[wide], s[wide], e[wide]
        while len(s):
            joins = np.flatnonzero(after[after[s]] == e)
            of = word[joins]
            best = joins[np.flatnonzero(np.append(True, of[1:] != of[:-1]))] if len(of) else joins
            cut[after[s[best]]] = False
            after[s[best]] = e[best]
            busy = np.zeros(word[-1] + 1, dtype=bool)
            busy[word[best]] = True
            left = busy[word] & cut[s] & cut[e]
            word, s, e = word[left], s[left], e[left]
        return cut

    @staticmethod
    def _viterbi(first: np.ndarray, size: np.ndarray, word: np.ndarray, s: np.ndarray, e: np.ndarray,
                 score: np.ndarray, places: int) -> np.ndarray:
        """As ``fold_viterbi``, for all words in step."""
        best, back = np.zeros(places), np.full(places, -1)
        order = np.argsort(e - first[word], kind="stable")
        s, e, score, rank = s[order], e[order], score[order], (e - first[word])[order]
        for n in range(1, size.max(initial=0) + 1):
            end = first[size >= n] + n
            lo, hi = np.searchsorted(rank, [n, n + 1])
            at = np.concatenate([end, e[lo:hi]])
            value = np.concatenate([best[end - 1] + UNKNOWN, best[s[lo:hi]] + score[lo:hi]])
            via = np.concatenate([end - 1, s[lo:hi]])
            up = np.lexsort((via, value, at))
            last = up[np.append(at[up][1:] != at[up][:-1], True)]
            best[at[last]], back[at[last]] = value[last], via[last]
        cut = np.zeros(places, dtype=bool)
        at = first + size
        while len(at):
            cut[at] = True
            at = back[at]
            at = at[at >= 0]
        return cut

    def table(self, words: pa.Array) -> Table:
        """Codes of distinct non-empty words."""
        size = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        chars = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), np.uint32).astype(np.int64)
        of = np.repeat(np.arange(len(size)), size)
        ends = np.cumsum(size)
        at, n, node = self._edges(chars, np.repeat(ends, size) - np.arange(len(chars)))
        # A word of n characters has n + 1 places, so no place is of two words.
        word, s = of[at], at + of[at]
        e, places = s + n, len(chars) + len(size)
        first = ends - size + np.arange(len(size))
        if self.model == "bpe":
            cut = self._bpe(word, s, e, self.score[node], places)
        else:
            cut = self._viterbi(first, size, word, s, e, self.score[node], places)
        ends_here = np.zeros(places, dtype=bool)
        ends_here[first + size] = True
        at_cut = np.flatnonzero(cut)
        inner = np.flatnonzero(~ends_here[at_cut])
        start, stop = at_cut[inner], at_cut[inner + 1] if len(inner) else at_cut[:0]
        # The piece of each span; a character without a piece is its bytes.
        key = s * (self.longest + 1) + n
        order = np.argsort(key)
        want = start * (self.longest + 1) + stop - start
        i = np.minimum(np.searchsorted(key[order], want), max(len(key) - 1, 0))
        hit = key[order][i] == want if len(key) else np.zeros(len(want), dtype=bool)
        place_of = np.searchsorted(first, start, "right") - 1       # the word of a span
        lone, which = np.unique(chars[(start - place_of)[~hit]], return_inverse=True)
        raw = [chr(c).encode("utf-8") for c in lone.tolist()]
        wide = np.array([len(r) for r in raw], np.int64)
        pool = np.concatenate([self.code[node], np.frombuffer(b"".join(raw), np.uint8).astype(np.int32) + BYTE0]).astype(np.int32)
        run, long = np.zeros(len(start), np.int64), np.ones(len(start), np.int64)
        run[hit] = order[i[hit]] if len(key) else 0
        run[~hit], long[~hit] = (len(node) + np.cumsum(wide) - wide)[which], wide[which]
        codes = _gather(pool, run, long) if len(run) else np.empty(0, np.int32)
        per = np.bincount(place_of, weights=long, minlength=len(size)).astype(np.int64)
        offsets = np.concatenate([[0], np.cumsum(per)]).astype(np.int32)
        return Table(words, pa.ListArray.from_arrays(pa.array(offsets), pa.array(codes)))


def _encode(shared, cut: np.ndarray):
    """Codes of each document, through the common words and the lattice of the others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, lattice = shared.value
        for b in _slices(batches, "t", BYTES):
            words, count = _words(b.column("t"), cut)
            coded = words.dictionary_encode()
            at = known.where(coded.dictionary).copy()
            rare = at < 0
            own = lattice.table(coded.dictionary.filter(pa.array(rare)))
            at[rare] = len(known.start) + np.arange(len(own.start))
            pool, start, size = (np.concatenate(x) for x in (
                (known.codes, own.codes), (known.start, own.start + len(known.codes)), (known.size, own.size)))
            which = at[coded.indices.to_numpy()]
            sizes = size[which]
            codes = _gather(pool, start[which], sizes) if len(which) else np.empty(0, np.int32)
            offsets = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(count)])].astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("t"), pa.ListArray.from_arrays(
                pa.array(offsets), pa.array(codes))], ["doc_id", "text", "codes"])
    return run


def encode(docs: DataFrame, pieces: Pieces | None = None, model: str = "bpe", id_col: str = "doc_id",
           text_col: str = "text", common: int = COMMON) -> DataFrame:
    """``(doc_id, text, codes)`` for every row."""
    pieces = pieces or Pieces()
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("t"))
    # The lattice is some twenty times its words, so they are dealt to more tasks than their bytes ask for.
    tasks = WIDEN * int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = materialize(texts.select("t").mapInArrow(_counts(pieces.cut), "word string, n long")
                         .groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    table = word_table(common_words(counts, common).repartition(tasks, "word"), pieces, model)
    shared = spark.sparkContext.broadcast((as_table(table), Lattice(pieces, model)))
    key = texts.schema["doc_id"].dataType.simpleString()
    return texts.select("doc_id", "t").mapInArrow(_encode(shared, pieces.cut), f"doc_id {key}, text string, codes array<int>")


def _decode(data: np.ndarray, start: np.ndarray, size: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches, "codes", BYTES // 4):
            lists = b.column("codes")
            codes = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            if len(codes) and (codes.min() < 0 or codes.max() >= len(size) or (size[codes] < 0).any()):
                raise ValueError("an unknown code")
            raw = _gather(data, start[codes], size[codes])
            per_doc = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
            ends = np.concatenate([[0], np.cumsum(size[codes])])[per_doc]
            keep = np.ones(len(raw) + 1, dtype=bool)       # without the word mark in front of a text
            first = ends[:-1][ends[:-1] < ends[1:]]
            keep[first] = raw[first] != 32
            ends -= np.concatenate([[0], np.cumsum(~keep)])[ends]
            raw = raw[keep[:-1]]
            out = pa.StringArray.from_buffers(b.num_rows, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(raw))
            try:
                out.validate(full=True)
            except pa.ArrowInvalid:     # bytes that are no UTF-8
                out = pa.array([raw[i:j].tobytes().decode("utf-8", "replace") for i, j in zip(ends[:-1], ends[1:])], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, out], [*b.schema.names, "decoded"])
    return run


def decode(coded: DataFrame, pieces: Pieces | None = None) -> DataFrame:
    """All columns of ``coded`` and the text of ``codes``, as ``decoded``."""
    pieces = pieces or Pieces()
    table: list[bytes | None] = [None] * max(max(i for _, i, _ in pieces.rows) + 1, BYTE0 + 256)
    table[BYTE0:BYTE0 + 256] = [bytes([i]) for i in range(256)]
    for text, i, _ in pieces.rows:
        table[i] = _as_text(text)
    size = np.array([-1 if t is None else len(t) for t in table])
    long = np.maximum(size, 0)
    data = np.frombuffer(b"".join(t or b"" for t in table), np.uint8)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in coded.schema)
    return coded.mapInArrow(_decode(data, np.cumsum(long) - long, size), f"{fields}, decoded string")
