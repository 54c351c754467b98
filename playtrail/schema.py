"""Declared schemas and fixed code values.

Nothing is inferred: every reader takes one of these StructTypes.
"""

from pyspark.sql import types as T

# Raw event file, as published (one row per game event).
CLICKS_CSV = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("game_session", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("event_data", T.StringType()),
    T.StructField("installation_id", T.StringType()),
    T.StructField("event_count", T.IntegerType()),
    T.StructField("event_code", T.IntegerType()),
    T.StructField("game_time", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("world", T.StringType()),
])

# Assessment results, one row per assessment session.
LABELS_CSV = T.StructType([
    T.StructField("game_session", T.StringType()),
    T.StructField("installation_id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("num_correct", T.IntegerType()),
    T.StructField("num_incorrect", T.IntegerType()),
    T.StructField("accuracy", T.DoubleType()),
    T.StructField("accuracy_group", T.IntegerType()),
])

# Coded event specification (event_type 0-4, event_action 0-7).
SPECS_CODED = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("event_type", T.IntegerType()),
    T.StructField("event_action", T.IntegerType()),
])

SPECS_NAMED = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("event_action", T.StringType()),
])

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for the same results)
# ---------------------------------------------------------------------------

# Code book of the coded specs file.
EVENT_TYPES = {0: "movie", 1: "game", 2: "round", 3: "rules", 4: "tutorial"}
EVENT_ACTIONS = {0: "quit", 1: "skip", 2: "mistake", 3: "help", 4: "replay",
                 5: "start", 6: "action", 7: "end"}

# Session features of style 1: (name, event_action, event_type).
TIME_FEATURES = [
    ("game_action_time", 6, 1),
    ("round_action_time", 6, 2),
    ("help_time", 3, 2),
    ("movie_time", 5, 0),
    ("game_mistake_time", 2, 1),
    ("round_mistake_time", 2, 2),
    ("rules_time", 5, 3),
    ("tutor_time", 5, 4),
]
COUNT_FEATURES = [
    ("num_quit", 0, 1),
    ("num_skips", 1, 4),
    ("num_replays", 4, 1),
    ("num_ends", 7, 1),
    ("num_rounds", 5, 2),
]
# Event gaps of this many game_time units or more are idle time.
MAX_GAP = 600000
# Attempt codes of an assessment (the thing style 1 predicts).
ATTEMPT_CODES = (4100, 4110)

# The five assessment titles of the score profile (style 3).
ASSESSMENT_TITLES = [
    "Bird Measurer (Assessment)",
    "Cart Balancer (Assessment)",
    "Cauldron Filler (Assessment)",
    "Chest Sorter (Assessment)",
    "Mushroom Sorter (Assessment)",
]

# Tokenizer settings of the sequence styles.
NUM_WORDS = 200          # ids 1..NUM_WORDS-1 are kept
MAX_SEQUENCE_LENGTH = 400
MIN_SEQUENCE_CODES = 10  # sequences need more than this many codes
TOKEN_FILTERS = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~\t\n'

# Style 2: last events per player and the pad value of short players.
LAST_EVENTS = 300
PAD_VALUE = -1.0

# Style 2 class weights, indexed by accuracy group 0..3.
CLASS_WEIGHTS = [3.0, 100.0, 10.0, 2.0]

# Style 1 majority thinning: drop this share of group 3.
THIN_CLASS = 3
THIN_SHARE = 0.65

# Hold-out share of the single-split styles.
HOLDOUT_SHARE = 0.15

# Canonical event columns used by every operator. ``src_id`` is a unique
# row id (file order for CSV sources), the last tie-breaker of EVENT_ORDER.
KEY = "installation_id"
SESSION = "game_session"
EVENT_ORDER = ["ts", "event_count", "src_id"]
LABEL_COLS = ["num_correct", "num_incorrect", "accuracy", "accuracy_group"]
