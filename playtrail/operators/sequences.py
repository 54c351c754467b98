"""Event-code sequences (A11, X6-X11, J5), last-N event matrices (W2, X13,
X14, U3) and the sequence training tables of styles 2-5 (Z2, Z3, Z6, Z7).

A sequence is kept in long form -- one row per (key, position, code) --
so no key's events are ever gathered into one row. Only bounded shapes
are collected: the last ``maxlen`` known tokens of a key, or the last
``n`` events of a player. Those limits are the features themselves
(front truncation of ``pad_sequences``, the last-300 matrix), and both are
planned as a per-key top-k that already runs before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playtrail.functions.scalar import code_text, normalize_text, pad_front
from playtrail.operators.features import dummies, fit_values_of, label_onehot, mean_label
from playtrail.operators.labelling import GROUP
from playtrail.operators.relational import (complete_rows, labelled_events, labelled_players, last_events,
                                            player_last_label, positive_groups, prior_play)
from playtrail.plans.ordered import HOUR_US, allow_partial_limit, hot_keys, positions, with_key_bucket
from playtrail.session import materialize
from playtrail.schema import (EVENT_ORDER, KEY, LAST_EVENTS, MAX_SEQUENCE_LENGTH,
                              MIN_SEQUENCE_CODES, NUM_WORDS, PAD_VALUE, SESSION)


def code_tokens(df: DataFrame, keys: Sequence[str], order: Sequence[str] = tuple(EVENT_ORDER),
                width_us: int = HOUR_US, bucket: str | None = None) -> DataFrame:
    """A11 (long form) + P4 + X8: one row per event with its 1-based position in
    the key's time order and its code as a normalised token. ``bucket`` names the
    time bucket where the events are spread by it already."""
    if bucket is None:
        bucket = "_tb"
        df = with_key_bucket(df, keys[0], "ts", hot_keys(df.select(keys[0], "ts"), keys[0], "ts", width_us), width_us,
                             name=bucket).drop("_hk")
    pos = positions(df, list(keys), list(order), F.col(bucket), name="pos").drop(bucket)
    return pos.select(*keys, "pos", F.trim(normalize_text(code_text("event_code"))).alias("code"))


def sequence_lengths(tokens: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Codes per key (A17), for the length filter P13."""
    return tokens.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_codes"))


def fit_vocabulary(tokens: DataFrame, keys: Sequence[str], num_words: int = NUM_WORDS) -> DataFrame:
    """Token ids by frequency (ties: first appearance in key order, then
    position), ids 1..num_words-1 kept. The ranking window runs over distinct
    codes only: a four-digit code book, a bounded table."""
    # Counts and first positions per code and key take a hash aggregate; the struct, for
    # which Spark sorts, sees one row per code and key.
    parts = tokens.groupBy("code", *keys).agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("pos"))
    voc = parts.groupBy("code").agg(F.sum("n").alias("n"), F.min(F.struct(*keys, "pos")).alias("_first"))
    voc = voc.withColumn("id", F.row_number().over(Window.orderBy(F.desc("n"), F.asc("_first"))))
    return voc.where(F.col("id") < num_words).select("code", "n", "id")


def encode(tokens: DataFrame, vocab: DataFrame) -> DataFrame:
    """Tokens to ids; unknown tokens are dropped. The vocabulary has at most
    ``num_words`` rows and is broadcast."""
    return tokens.join(F.broadcast(vocab.select("code", "id")), "code", "inner")


def pad_sequences(encoded: DataFrame, keys: Sequence[str], maxlen: int = MAX_SEQUENCE_LENGTH) -> DataFrame:
    """X11: per key the last ``maxlen`` ids in order, padded in front with 0."""
    allow_partial_limit(encoded.sparkSession, maxlen)
    last = encoded.withColumn("_r", F.row_number().over(
        Window.partitionBy(*keys).orderBy(F.desc("pos")))).where(F.col("_r") <= maxlen)
    seq = last.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("pos", "id"))).alias("_s"))
    return seq.select(*keys, pad_front(F.transform("_s", lambda x: x["id"]), maxlen, 0).alias("sequence"))


def code_chunks(tokens: DataFrame, keys: Sequence[str], size: int = MAX_SEQUENCE_LENGTH) -> DataFrame:
    """All codes of each key in order, as rows ``chunk_no`` (from 0) of ``size``
    codes each, so a key of any length is bounded arrays in many groups."""
    chunk = F.floor((F.col("pos") - 1) / size).cast("long").alias("chunk_no")
    seq = tokens.groupBy(*keys, chunk).agg(F.array_sort(F.collect_list(F.struct("pos", "code"))).alias("_s"))
    return seq.select(*keys, "chunk_no", F.transform("_s", lambda x: x["code"]).alias("codes"))


def kept_tokens(tokens: DataFrame, docs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Tokens of the kept documents, written once: the vocabulary fit and the
    encoding both read them."""
    return materialize(tokens.join(docs.select(*keys), list(keys), "left_semi"), "tokens")


def sequence_table(tokens: DataFrame, labels: DataFrame, keys: Sequence[str], min_codes: int | None,
                   vocab: DataFrame | None = None, maxlen: int = MAX_SEQUENCE_LENGTH) -> tuple[DataFrame, DataFrame]:
    """P13 + J5 + X9-X11 + F2: padded id sequences of the keys with more than
    ``min_codes`` codes and a label. Returns (table, vocabulary)."""
    lengths = sequence_lengths(tokens, keys)
    if min_codes is not None:
        lengths = lengths.where(F.col("n_codes") > min_codes)
    docs = lengths.join(labels, list(keys), "inner")                     # J5
    kept = kept_tokens(tokens, docs, keys)
    vocab = vocab if vocab is not None else fit_vocabulary(kept, keys)
    padded = pad_sequences(encode(kept, vocab), keys, maxlen)
    table = docs.join(padded, list(keys), "left").withColumn(
        "sequence", F.coalesce(F.col("sequence"), F.array_repeat(F.lit(0), maxlen)))
    return label_onehot(table), vocab


def unlabelled_sequences(events: DataFrame, vocab: DataFrame, keys: Sequence[str], min_codes: int | None = None,
                         maxlen: int = MAX_SEQUENCE_LENGTH) -> DataFrame:
    """A11, P13, X10 and X11 for events without labels, in the ids of a vocabulary
    fitted elsewhere: keys, ``n_codes`` and the padded ``sequence``. A key without a
    known code is all padding."""
    tokens = materialize(code_tokens(events, keys), "unlabelled-tokens")     # counted and encoded
    lengths = sequence_lengths(tokens, keys)
    if min_codes is not None:
        lengths = lengths.where(F.col("n_codes") > min_codes)
    padded = pad_sequences(encode(tokens, vocab), keys, maxlen)
    return lengths.join(padded, list(keys), "left").withColumn(
        "sequence", F.coalesce("sequence", F.array_repeat(F.lit(0), maxlen)))


def labelled_tokens(clicks: DataFrame, labels: DataFrame) -> DataFrame:
    """J4 + A11: tokens of labelled sessions. The time bucket is set before the
    label join, which spreads the events by it (:func:`labelled_events`)."""
    timed = with_key_bucket(clicks, KEY, "ts", hot_keys(clicks.select(KEY, "ts"), KEY, "ts"), name="_tb").drop("_hk")
    return code_tokens(labelled_events(timed, labels, [], "_tb"), [KEY, SESSION], bucket="_tb")


def style3_sequences(clicks: DataFrame, labels: DataFrame, vocab: DataFrame | None = None):
    """Z3: one row per assessment session: its own code sequence and result."""
    tokens = labelled_tokens(clicks, labels)
    lab = labels.select(KEY, SESSION, "accuracy_group")
    return sequence_table(tokens, lab, [KEY, SESSION], None, vocab)


def _history_rows(history: DataFrame) -> DataFrame:
    """P2 + P6: drop the label's title, keep rows without any null. A row without a
    group (an assessment's own events) is complete: null is our "no group"."""
    rows = history.drop("label_title")
    return complete_rows(rows, [c for c in rows.columns if c != GROUP])


def style4_sequences(history: DataFrame, vocab: DataFrame | None = None):
    """One row per assessment group (all play before one assessment)."""
    rows = positive_groups(_history_rows(history), GROUP)                  # P12
    keys = [KEY, GROUP]
    tokens = code_tokens(rows, keys)
    lab = mean_label(rows, keys)                                           # A6
    return sequence_table(tokens, lab, keys, MIN_SEQUENCE_CODES, vocab)


def style5_sequences(history: DataFrame, vocab: DataFrame | None = None, mixed: str = "mean"):
    """One row per session, labelled by the next assessment."""
    rows = _history_rows(history)
    keys = [KEY, SESSION]
    tokens = code_tokens(rows, keys)
    lab = mean_label(rows, keys, mixed=mixed)
    return sequence_table(tokens, lab, keys, MIN_SEQUENCE_CODES, vocab)


# ---------------------------------------------------------------- style 2: last-N event matrices

MATRIX_CATEGORIES = ("event_code", "title", "type")


def style2_rows(clicks: DataFrame, labels: DataFrame, n: int = LAST_EVENTS,
                values: dict | None = None, label_order: Sequence[str] = ("start", SESSION)) -> tuple[DataFrame, dict]:
    """J1, J2, J9, P1, W2, F1 x3, U1: the last ``n`` prior-play events of each
    labelled player as numeric rows ``[event_count, game_time, dummies...]``.
    Returns (rows, fitted dummy values).

    J1 and J9 keep or drop whole players and add one value to each of a player's
    rows, so the last ``n`` events are taken before them: each map task sends at
    most ``n`` rows of a player, and the joins see no more than that. Only J2,
    which removes single sessions, has to come first."""
    from playtrail.operators.labelling import assessment_starts
    play = prior_play(clicks, labels).select(KEY, "event_code", "event_count", "game_time", "title", "type", "ts", "src_id")
    d = labelled_players(last_events(play, n), labels)
    d = player_last_label(d, assessment_starts(clicks, labels), order=label_order).drop("label_session", "ts", "src_id")
    values = values or fit_values_of(d, MATRIX_CATEGORIES)
    for c in MATRIX_CATEGORIES:
        d = dummies(d, c, values[c])
    feats = ["event_count", "game_time"] + [f"{c}_{v}" for c in MATRIX_CATEGORIES for v in values[c]]
    row = F.array(*[F.col(f).cast("double") for f in feats])
    return d.select(KEY, "accuracy_group", "rn_desc", row.alias("row")), values


def player_matrix(rows: DataFrame, n: int = LAST_EVENTS, pad: bool = False) -> DataFrame:
    """X14 (``pad=False``: players with fewer than ``n`` rows are skipped) and U3
    (``pad=True``: rows of -1 are appended up to ``n``). Rows in time order."""
    m = rows.groupBy(KEY).agg(F.first("accuracy_group").alias("accuracy_group"),
                              F.sort_array(F.collect_list(F.struct(F.col("rn_desc"), F.col("row"))), False).alias("_m"),
                              F.count(F.lit(1)).alias("n_rows"))
    m = m.withColumn("matrix", F.transform("_m", lambda x: x["row"])).drop("_m")
    if not pad:
        return m.where(F.col("n_rows") == n)
    width = F.size(F.col("matrix")[0])
    pad_row = F.array_repeat(F.lit(PAD_VALUE), width)
    return m.withColumn("matrix", F.concat("matrix", F.array_repeat(pad_row, (F.lit(n) - F.col("n_rows")).cast("int"))))


def flatten_player(matrix: DataFrame) -> DataFrame:
    """The padded matrix as one flat row."""
    return matrix.withColumn("features", F.flatten("matrix")).drop("matrix")


def style2_last_events(clicks: DataFrame, labels: DataFrame, n: int = LAST_EVENTS) -> DataFrame:
    """One flat, padded row of the last ``n`` events per labelled player."""
    rows, _ = style2_rows(clicks, labels, n)
    return flatten_player(player_matrix(rows, n, pad=True))
