"""Data model of the event log: fixed values, column lists and the raw schema."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: these must equal the original project's values -----------
# Page that marks a cancelled subscription (the churn event).
CANCEL_PAGE = "Cancellation Confirmation"
# Pages used as plan-change flags in the exploration.
UPGRADE_PAGE = "Submit Upgrade"
DOWNGRADE_PAGE = "Submit Downgrade"
# Page that carries a song length.
SONG_PAGE = "NextSong"
# Pages whose average monthly click counts become features, in training order.
FEATURE_PAGES = [
    "About", "Add Friend", "Add to Playlist", "Downgrade", "Error", "Help",
    "Home", "Logout", "NextSong", "Roll Advert", "Save Settings", "Settings",
    "Submit Downgrade", "Submit Upgrade", "Thumbs Down", "Thumbs Up", "Upgrade",
]
# Regular expression that pulls the system name out of a user agent.
USER_SYSTEM_PATTERN = r"\(([a-zA-Z 0-9.]+)"
# Columns kept by the cleaning step, in order.
KEPT_COLUMNS = [
    "userId", "page", "level", "sessionId", "ts", "gender", "itemInSession",
    "userSystem", "length", "auth",
]
# Scalar per-user features, in training order.
SCALAR_FEATURES = [
    "avg_sess_p_day", "avg_length", "avg_items_p_sess", "acc_age",
    "avg_sess_len", "bin_gender",
]
# Category used when a user has no usable system name.
UNKNOWN_SYSTEM = "unknown"
# Gender value that maps to 1 in the gender flag.
FEMALE = "F"
# Validation share of the train/validation split and its seed.
VALIDATION_FRACTION = 0.1
SPLIT_SEED = 42
# -----------------------------------------------------------------------------

#: Feature column names of the page pivot (spaces replaced by underscores).
PAGE_COLUMNS = [p.replace(" ", "_") for p in FEATURE_PAGES]
#: Every page value the exploration knows about.
ALL_PAGES = FEATURE_PAGES + [CANCEL_PAGE]
#: Vector-assembler input columns, in order.
FEATURE_COLS = SCALAR_FEATURES + ["pref_user_system_ohe"] + PAGE_COLUMNS

#: Raw event-log schema. The log is JSON; reading it with an explicit schema
#: avoids an inference pass over the whole input. Columns the jobs never use
#: (names, song, HTTP method) are listed so they can be read when present.
EVENT_LOG = T.StructType([
    T.StructField("userId", T.StringType()),
    T.StructField("page", T.StringType()),
    T.StructField("level", T.StringType()),
    T.StructField("sessionId", T.LongType()),
    T.StructField("ts", T.LongType()),
    T.StructField("gender", T.StringType()),
    T.StructField("itemInSession", T.LongType()),
    T.StructField("userAgent", T.StringType()),
    T.StructField("length", T.DoubleType()),
    T.StructField("auth", T.StringType()),
    T.StructField("firstName", T.StringType()),
    T.StructField("lastName", T.StringType()),
    T.StructField("song", T.StringType()),
    T.StructField("artist", T.StringType()),
    T.StructField("method", T.StringType()),
])

#: Columns of the raw log that the jobs read.
RAW_COLUMNS = [
    "userId", "page", "level", "sessionId", "ts", "gender", "itemInSession",
    "userAgent", "length", "auth",
]
