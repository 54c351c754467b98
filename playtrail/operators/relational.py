"""Projection, filter, update (P), joins (J1-J9, J11), aggregation (A7-A10,
A14-A17), windows (W1-W5, W7) and frame-shape operations (U)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtrail.plans.ordered import (global_row_number, global_running_total, join_in_buckets, last_n,
                                     next_values, ntile_column, positions, value_bucket)
from playtrail.session import bounded_broadcast, materialize
from playtrail.schema import ATTEMPT_CODES, EVENT_ORDER, KEY, MAX_GAP, SESSION

# Sessions longer than this many events are split into position ranges for W1.
POSITION_BUCKET = 100_000


# ---------------------------------------------------------------- P: projection, filter, update

def project(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P1."""
    return df.select(*cols)


def without(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P2."""
    return df.drop(*cols)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """P3."""
    return df.withColumnsRenamed(dict(mapping))


def with_constant(df: DataFrame, name: str, value) -> DataFrame:
    """P5."""
    return df.withColumn(name, F.lit(value))


def complete_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with any null."""
    return df.na.drop("any", subset=list(subset) if subset else None)


def fill_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Nulls (and NaN) in ``cols`` become 0."""
    return df.withColumns({c: F.coalesce(F.nanvl(F.col(c), F.lit(0)) if dict(df.dtypes)[c] in ("double", "float")
                                         else F.col(c), F.lit(0)) for c in cols})


def drop_idle(df: DataFrame, col: str = "game_time", max_gap: int = MAX_GAP) -> DataFrame:
    """Keep gaps below ``max_gap``."""
    return df.where(F.col(col) < max_gap)


def pair_filter(df: DataFrame, action: int, etype: int) -> DataFrame:
    """Rows of one (event_action, event_type) pair."""
    return df.where((F.col("event_action") == action) & (F.col("event_type") == etype))


def only_type(df: DataFrame, value: str = "Assessment", col: str = "type") -> DataFrame:
    """P10."""
    return df.where(F.col(col) == value)


def drop_codes(df: DataFrame, codes: Iterable[int] = ATTEMPT_CODES, col: str = "event_code") -> DataFrame:
    """P11."""
    return df.where(~F.col(col).isin(list(codes)))


def positive_groups(df: DataFrame, col: str = "group") -> DataFrame:
    """Rows that belong to an assessment group (ids are 1-based, null = none)."""
    return df.where(F.col(col).isNotNull())


def min_length(df: DataFrame, col: str, n: int = 10) -> DataFrame:
    """More than ``n`` codes."""
    return df.where(F.col(col) > n)


def update_where(df: DataFrame, pred: Column, values: Mapping[str, object]) -> DataFrame:
    """Set ``values`` on the rows where ``pred`` holds."""
    return df.withColumns({c: F.when(pred, v if isinstance(v, Column) else F.lit(v)).otherwise(F.col(c))
                           for c, v in values.items()})


def is_unlabelled(col: str = "accuracy_group") -> Column:
    """P15."""
    return F.col(col).isNull()


def distinct_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P16 / A10."""
    return df.select(*cols).distinct()


def _hash_order(df: DataFrame, col: str) -> Column:
    """A fixed-width value that grows with ``col``: the column itself, or of a string
    its first seven bytes as a number (equal for strings that begin alike)."""
    if df.schema[col].dataType.typeName() not in ("string", "char", "varchar"):
        return F.col(col)
    head = F.rpad(F.hex(F.substring(F.col(col).cast("binary"), 1, 7)), 14, "0")
    return F.when(F.col(col).isNotNull(), F.conv(head, 16, 10).cast("long"))


def _pick_by(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str], first: bool) -> DataFrame:
    """The first or last row of each key, without sorting all rows.

    Spark sorts its input to aggregate a struct or a string. So the smallest (or
    largest) leading order value per key comes first, which is of fixed width and
    takes a hash aggregate; only the rows that hold it, one per key but for ties,
    go into the struct aggregate. Nulls come first in the order, as in a struct."""
    d = df.select(*keys, *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                  *[F.col(c).alias(f"_v{i}") for i, c in enumerate(cols)])
    d = d.withColumn("_lead", _hash_order(d, "_o0"))
    ends = d.groupBy(*keys).agg((F.min if first else F.max)("_lead").alias("_end"),
                                F.count_if(F.col("_lead").isNull()).alias("_nulls"))
    ends = ends.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                       (F.when(F.col("_nulls") == 0, F.col("_end")) if first else F.col("_end")).alias("_end"))
    at = F.col("_lead").eqNullSafe(F.col("_end"))
    for i, k in enumerate(keys):
        at = at & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    near = d.join(ends, at)
    packed = F.struct(*[f"_o{i}" for i in range(len(order))], *[f"_v{i}" for i in range(len(cols))])
    out = near.groupBy(*keys).agg((F.min if first else F.max)(packed).alias("_p"))
    return out.select(*keys, *[F.col("_p")[f"_v{i}"].alias(c) for i, c in enumerate(cols)])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """The first row of each key in ``order``."""
    return _pick_by(df, keys, order, cols, first=True)


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """The last row of each key in ``order``."""
    return _pick_by(df, keys, order, cols, first=False)


# ---------------------------------------------------------------- J: joins

def labelled_players(clicks: DataFrame, labels: DataFrame) -> DataFrame:
    """Events of players that have at least one label. The key set is
    de-duplicated first (a map-side distinct), so a player with many labels
    adds one row to the join, not one per label."""
    return clicks.join(labels.select(KEY).distinct(), KEY, "left_semi")


def prior_play(clicks: DataFrame, labels: DataFrame) -> DataFrame:
    """Drop the assessment sessions themselves."""
    return clicks.join(labels.select(SESSION).distinct(), SESSION, "left_anti")


def multi_event_sessions(df: DataFrame, keys: Sequence[str] = (KEY, SESSION)) -> DataFrame:
    """J3 (with A8): rows of sessions with more than one event."""
    return df.join(having_count(df, keys, 1).select(*keys), list(keys), "left_semi")


def events_with_labels(clicks: DataFrame, labels: DataFrame) -> DataFrame:
    """Events of labelled sessions with their label (inner join on both keys)."""
    lab = labels.select(KEY, SESSION, *[c for c in labels.columns if c not in (KEY, SESSION, "title")])
    return clicks.join(lab, [KEY, SESSION], "inner")


def complete_labelled_events(clicks: DataFrame, labels: DataFrame, cols: Sequence[str], bucket: str) -> DataFrame:
    """A full outer join whose incomplete rows are dropped. A row without its
    other side is incomplete, so that is an inner join (Catalyst does not see it by
    itself) of which rows with any null, in the event or in ``cols``, go (P6)."""
    return complete_rows(labelled_events(clicks, labels, cols, bucket))


def labelled_events(clicks: DataFrame, labels: DataFrame, cols: Sequence[str], bucket: str) -> DataFrame:
    """J4 for ordered work: events of labelled sessions with the label columns
    ``cols``, spread over tasks by (player, session, ``bucket``). An event of a
    labelled session belongs to a labelled player, so J1 needs no join of its own."""
    return join_in_buckets(clicks, labels.select(KEY, SESSION, *cols), [KEY, SESSION], bucket)


def with_specs(df: DataFrame, specs: DataFrame) -> DataFrame:
    """Attach event_type/event_action; events without a spec row vanish.
    The spec table is a code book (one row per event id, a few hundred rows);
    it is broadcast after its size is checked."""
    return df.join(bounded_broadcast(specs), "event_id", "inner")


def left_labels(clicks: DataFrame, labels: DataFrame) -> DataFrame:
    """Left join on both keys; the label's title is kept as ``label_title``."""
    lab = labels.withColumnRenamed("title", "label_title")
    return clicks.join(lab, [KEY, SESSION], "left")


def last_label(labels: DataFrame, order: Sequence[str] = (SESSION,)) -> DataFrame:
    """W3 on labels: one label per player, the last in ``order``. The reference
    takes file order, i.e. the largest session id (``order=(SESSION,)``); pass
    ``("start", SESSION)`` after :func:`with_session_start` for the time order."""
    return last_per_key(labels, [KEY], list(order), [SESSION, "accuracy_group"])


def player_last_label(clicks: DataFrame, labels: DataFrame, order: Sequence[str] = (SESSION,)) -> DataFrame:
    """Every event gets its player's last label."""
    lab = last_label(labels, order).withColumnRenamed(SESSION, "label_session")
    return clicks.join(lab, KEY, "left")


def key_aligned_update(base: DataFrame, update: DataFrame, keys: Sequence[str],
                       cols: Sequence[str]) -> DataFrame:
    """Take ``cols`` from ``update`` where it has a non-null value for the key."""
    u = update.select(*keys, *[F.col(c).alias("_u_" + c) for c in cols])
    out = base.join(u, list(keys), "left")
    return out.withColumns({c: F.coalesce(F.col("_u_" + c), F.col(c)) for c in cols}).drop(
        *["_u_" + c for c in cols])


# ---------------------------------------------------------------- A: simple aggregates

def rows_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A7."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def having_count(df: DataFrame, keys: Sequence[str], more_than: int = 1) -> DataFrame:
    """A8."""
    return rows_per_key(df, keys).where(F.col("n") > more_than)


def distinct_counts(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """A9."""
    f = F.approx_count_distinct if approx else F.countDistinct
    return df.agg(*[f(c).alias(f"n_{c}") for c in cols])


def column_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean, max, min of each column in one pass."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"mean_{c}"), F.max(c).alias(f"max_{c}"), F.min(c).alias(f"min_{c}")]
    return df.agg(*aggs)


def column_median(df: DataFrame, col: str, exact: bool = True) -> DataFrame:
    """Exact median (the mean of the two middle values, as pandas), or
    ``percentile_approx``.

    The exact form does not use the ``median`` aggregate, whose buffer holds
    every distinct value and whose final merge runs in one task. Values are
    counted first (a value shared by a third of the rows is one row), the
    running total of the counts in value order is computed with a distributed
    sort (``global_running_total``), and the value(s) holding the one or two
    middle ranks are averaged."""
    out = f"median_{col}"
    if not exact:
        return df.agg(F.percentile_approx(col, 0.5).alias(out))
    v = F.col(col).cast("double")
    counts = df.where(v.isNotNull()).groupBy(v.alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    n = df.agg(F.count(v)).first()[0]
    lo, hi = (n + 1) // 2, (n + 2) // 2
    cum = global_running_total(counts, ["_v"], "_c", "_cum")
    holds = lambda k: (F.col("_cum") - F.col("_c") < F.lit(k)) & (F.col("_cum") >= F.lit(k))
    picked = cum.where(holds(lo) | holds(hi))
    # one row when both middle ranks fall on the same value
    return picked.agg(F.avg("_v").alias(out))


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """Equal-width bins between min and max; the maximum falls in the last bin
    (as pandas ``hist``). The bounds are one global aggregate, fetched as two scalars."""
    c = F.col(col).cast("double")
    lo, hi = df.agg(F.min(c), F.max(c)).first()
    d = df.select(c.alias("_x")).where(F.col("_x").isNotNull())
    if lo is None:
        return d.select(F.lit(0).alias("bin"), F.lit(0.0).alias("lower"), F.lit(0).cast("long").alias("n")).limit(0)
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((F.col("_x") - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    return (d.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
             .select("bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lower"), "n"))


# ---------------------------------------------------------------- W: windows and order

def position_bucket(col: str = "event_count") -> Column:
    """The range of positions that W1 handles in one task."""
    return value_bucket(col, POSITION_BUCKET)


def time_to_next(df: DataFrame, keys: Sequence[str] = (KEY, SESSION), col: str = "game_time",
                 order: Sequence[str] = ("event_count", "src_id"), out: str | None = None,
                 bucket: str | None = None) -> DataFrame:
    """``abs(t[i] - t[i+1])`` within each session in event order, 0 on the last row. A null time counts as 0 before the difference.

    Sessions are cut into ranges of event_count so a huge session is not one task;
    ``bucket`` names the range where the events are spread by it already."""
    df = df.withColumn(col, F.coalesce(F.col(col), F.lit(0).cast(df.schema[col].dataType)))
    ranges = F.col(bucket) if bucket else position_bucket(order[0])
    nxt = next_values(df, keys, order, ranges, [col], prefix="_next_")
    return nxt.withColumn(out or col, F.coalesce(F.abs(F.col(col) - F.col("_next_" + col)), F.lit(0)).cast(
        df.schema[col].dataType)).drop("_next_" + col)


def last_events(df: DataFrame, n: int, keys: Sequence[str] = (KEY,),
                order: Sequence[str] = tuple(EVENT_ORDER), name: str = "rn_desc") -> DataFrame:
    """The last ``n`` events of each player (partial top-n before the shuffle)."""
    return last_n(df, list(keys), list(order), n, name)


def session_starts(df: DataFrame, keys: Sequence[str] = (KEY, SESSION), ts: str = "ts") -> DataFrame:
    """First timestamp of each session (a partial aggregate)."""
    return df.groupBy(*keys).agg(F.min(ts).alias("start"))


def sort_sessions(df: DataFrame) -> DataFrame:
    """Events of a session together and in event order. Range partitioning
    spreads a huge session over several tasks instead of one hash bucket."""
    order = [KEY, SESSION, "event_count", "src_id"]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def sorted_positions(df: DataFrame, name: str = "position") -> DataFrame:
    """W5 with each row's 1-based place in its session, read off the sorted rows:
    ids that grow along the sorted table are pinned by writing it, and the place
    is counted within a table partition plus the session's rows in earlier ones."""
    pinned = materialize(sort_sessions(df).withColumn("_mid", F.monotonically_increasing_id()), "sorted-sessions")
    return positions(pinned, [KEY, SESSION], ["_mid"], F.shiftright("_mid", 33), name).drop("_mid")


def kfold(df: DataFrame, k: int = 5, order: Sequence[str] = (KEY, SESSION),
          name: str = "fold", order_is_key: bool = True) -> DataFrame:
    """Contiguous folds in ``order`` without shuffling (unshuffled k-fold):
    fold sizes differ by at most one, the larger folds first.

    When the ``order`` columns identify a row (``order_is_key``, true for every
    caller: labels per session, training rows per player or session), only
    that narrow key projection is sorted and numbered, and the fold is joined
    back on the key; the wide rows (feature vectors) are never range-sorted
    or written for it. Keys are numbered once each (rows sharing a key share
    its fold, no row is repeated) and joined null-safely (no row is lost)."""
    cols = list(order)
    src = df.select(*cols).distinct() if order_is_key else df
    ranked = global_row_number(src, cols, "_rank")
    n = ranked.agg(F.max("_rank")).first()[0] or 0
    folds = ranked.withColumn(name, ntile_column(F.col("_rank"), F.lit(n), k)).drop("_rank")
    if not order_is_key:
        return folds
    keyed = folds.select(*[F.col(c).alias(f"_fk_{c}") for c in cols], name)
    cond = [df[c].eqNullSafe(keyed[f"_fk_{c}"]) for c in cols]
    return df.join(keyed, cond, "inner").drop(*[f"_fk_{c}" for c in cols])


def test_shape(df: DataFrame) -> DataFrame:
    """Test-set shape: per player only the first event of the last Assessment session."""
    starts = session_starts(only_type(df))
    last = last_per_key(starts, [KEY], ["start", SESSION], [SESSION])
    return df.where(F.col("event_count") == 1).join(last, [KEY, SESSION], "left_semi")


# ---------------------------------------------------------------- U: frame shape

def side_by_side(df: DataFrame, cols: Mapping[str, Column]) -> DataFrame:
    """Add aligned columns (the row key stays a column)."""
    return df.withColumns(dict(cols))


def remove_rows(df: DataFrame, removed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Set difference on a key."""
    return df.join(removed.select(*keys), list(keys), "left_anti")
