"""Game-clickstream views derived from the driver's ``events`` table.

``clicks`` sessionizes ``events`` (new session after a gap of more than a
day) and maps event types to game codes; ``assessment_labels`` scores every
Assessment session; ``specs`` is the coded event dimension. The mapping
constants below are fixed values shared with the DuckDB oracles.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playtrail.plans.ordered import DAY_US, micros, sessionize
from playtrail.session import checkpoint_dir, configure, listing, materialize_at, path_exists

# Fixed values of the fixture mapping.
EVENT_CODES = {"signup": 2000, "view": 3010, "click": 4070, "error": 4020}
OTHER_CODE = 4100
TITLES = ["Bird Measurer (Assessment)", "Cart Balancer (Assessment)",
          "Cauldron Filler (Assessment)", "Chest Sorter (Assessment)",
          "Mushroom Sorter (Assessment)"]
TYPES = ["Assessment", "Game", "Activity"]
WORLDS = ["TREETOPCITY", "MAGMAPEAK", "CRYSTALCAVES"]
SPEC_ROWS = [(0, 1, 0), (1, 0, 1), (2, 4, 1), (3, 1, 2), (4, 1, 3), (5, 1, 4), (6, 2, 4),
             (7, 0, 5), (8, 1, 5), (9, 2, 5), (10, 3, 5), (11, 4, 5), (12, 2, 6), (13, 0, 7),
             (14, 1, 7), (15, 2, 7), (16, 3, 7), (17, 4, 7)]
GAME_TIME_UNIT_US = 100_000   # game_time counts tenths of a second
SPEC_ID_MOD = 20              # event ids 18 and 19 have no spec row


def _pick(index, values):
    expr = None
    for i, v in enumerate(values[:-1]):
        expr = (F.when(index == i, F.lit(v)) if expr is None else expr.when(index == i, F.lit(v)))
    return expr.otherwise(F.lit(values[-1]))


def clicks(events: DataFrame) -> DataFrame:
    ev = events.select("event_id", "ts", "user_id", "event_type")
    s = sessionize(ev, "user_id", "ts", "event_id", gap_us=DAY_US)
    code = F.lit(OTHER_CODE)
    for name, c in reversed(list(EVENT_CODES.items())):
        code = F.when(F.col("event_type") == name, F.lit(c)).otherwise(code)
    us_from_start = micros("ts") - micros("session_start")
    return s.select(
        (F.col("event_id") % SPEC_ID_MOD).cast("int").alias("event_id"),
        F.col("event_id").alias("src_id"),
        F.concat(F.col("user_id").cast("string"), F.lit("-"), F.col("sno").cast("string")).alias("game_session"),
        F.col("ts"),
        F.col("user_id").alias("installation_id"),
        F.col("sno"),
        F.col("session_pos").alias("event_count"),
        code.alias("event_code"),
        F.col("event_type").alias("src_type"),
        F.floor(us_from_start / F.lit(GAME_TIME_UNIT_US)).cast("long").alias("game_time"),
        _pick((F.col("user_id") + F.col("sno")) % 5, TITLES).alias("title"),
        _pick(F.col("sno") % 3, TYPES).alias("type"),
        _pick((F.col("user_id") + F.col("sno")) % 3, WORLDS).alias("world"),
    )


def assessment_labels(clicks_df: DataFrame) -> DataFrame:
    """One result row per Assessment session: correct = any purchase, incorrect = errors."""
    # Spark sorts its input for the smallest of strings: sums per title take a hash
    # aggregate, and a session has few titles.
    parts = (clicks_df.where(F.col("type") == "Assessment")
             .groupBy("game_session", "installation_id", "title")
             .agg(F.max(F.when(F.col("src_type") == "purchase", 1).otherwise(0)).alias("num_correct"),
                  F.sum(F.when(F.col("src_type") == "error", 1).otherwise(0)).alias("num_incorrect")))
    q = (parts.groupBy("game_session", "installation_id")
         .agg(F.min("title").alias("title"), F.max("num_correct").alias("num_correct"),
              F.sum("num_incorrect").cast("int").alias("num_incorrect")))
    return q.select(
        "game_session", "installation_id", "title", "num_correct", "num_incorrect",
        F.when(F.col("num_correct") == 0, F.lit(0.0))
         .otherwise(F.lit(1.0) / (F.col("num_incorrect") + 1)).alias("accuracy"),
        F.when(F.col("num_correct") == 0, 0).when(F.col("num_incorrect") == 0, 3)
         .when(F.col("num_incorrect") == 1, 2).otherwise(1).alias("accuracy_group"))


def specs(spark: SparkSession) -> DataFrame:
    schema = T.StructType([T.StructField(n, T.IntegerType(), False)
                           for n in ("event_id", "event_type", "event_action")])
    return spark.createDataFrame(SPEC_ROWS, schema)


# Written copies of derived tables, per dataset version: (events path, its files
# with sizes and times, checkpoint folder, view, options) -> parquet path.
_BUILT: dict[tuple, str] = {}


# Held-out players: a repeatable hash of the player id picks about a fifth of
# the players, whatever their ids; TEST_PLAYER_SQL is the same rule in DuckDB.
TEST_PLAYER_SHARE = 0.2
TEST_PLAYER_SEED = 5
TEST_PLAYER_SQL = ("(('0x' || substr(md5(concat('{seed}:', cast({key} as varchar))), 1, 8))::bigint / 4294967296.0)"
                   " < {share}").format(seed=TEST_PLAYER_SEED, key="installation_id", share=TEST_PLAYER_SHARE)


def is_test_player(key: str) -> Column:
    from playtrail.functions.scalar import hash_fraction
    return hash_fraction(key, TEST_PLAYER_SEED) < F.lit(TEST_PLAYER_SHARE)


class Tables:
    """Lazy access to the driver tables and the derived views of one scale factor.

    The sessionized ``clicks`` view plays the part of the reference's source
    event file: it is built once per dataset version and written to the
    checkpoint folder; later queries in the process read the written copy.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")

    def _version(self) -> tuple:
        p = f"{self.sf_dir}/events.parquet"
        stamp = listing(self.spark, p)
        # the shuffle width is part of the key so that partition-independence
        # checks rebuild the views instead of reading an earlier copy
        return (p, stamp, checkpoint_dir(self.spark), self.spark.conf.get("spark.sql.shuffle.partitions"))

    def built(self, view: str, build, **options) -> DataFrame:
        """Read the written copy of a derived view, building it first if needed."""
        key = (*self._version(), view, tuple(sorted(options.items())))
        path = _BUILT.get(key)
        if path is not None and path_exists(self.spark, path):
            return self.spark.read.parquet(path)
        df, path = materialize_at(build(), view)
        _BUILT[key] = path
        return df

    @cached_property
    def clicks(self) -> DataFrame:
        return self.built("clicks", lambda: clicks(self.events))

    def history(self, **options) -> DataFrame:
        """The labelled event table (Z5) of this dataset, built once."""
        from playtrail.operators.labelling import label_by_next
        return self.built("history", lambda: label_by_next(self.clicks, self.labels, **options), **options)

    @cached_property
    def starts(self) -> DataFrame:
        """Assessment results with the start of their session (one row per
        assessment), built once: profiles, votes and folds all read it."""
        from playtrail.operators.labelling import assessment_starts
        return self.built("starts", lambda: assessment_starts(self.clicks, self.labels))

    @cached_property
    def labels(self) -> DataFrame:
        """Assessment results (the reference's label file), built once."""
        return self.built("labels", lambda: assessment_labels(self.clicks))

    @cached_property
    def specs(self) -> DataFrame:
        return specs(self.spark)

    @cached_property
    def embeddings(self) -> DataFrame:
        return self.table("embeddings")

    def player_clicks(self, test: bool) -> DataFrame:
        """Clicks of the held-out players (``test``) or of all the others."""
        held_out = is_test_player("installation_id")
        return self.clicks.where(held_out if test else ~held_out)

    def train_clicks(self) -> DataFrame:
        """Players outside the held-out share."""
        return self.player_clicks(test=False)

    def test_clicks(self) -> DataFrame:
        """Test players, reduced to the first event of their last Assessment session."""
        from playtrail.operators.relational import test_shape
        return test_shape(self.player_clicks(test=True))
