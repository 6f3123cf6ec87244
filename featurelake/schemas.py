"""Declared schemas and fixed values.

The interaction columns are declared and land as text, so a cell that does
not parse is still there to be reported.  Only product metadata, whose schema
nobody declares, is inferred by the JSON reader.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the behaviour being reproduced)
# ---------------------------------------------------------------------------
# Click actions that count as interactions, and their implicit ratings.
RELEVANT_ACTIONS = ("view", "click", "add_to_cart")
IMPLICIT_RATING = {"view": 2, "click": 3, "add_to_cart": 4}
# Keys an event must carry to be stored by the speed layer.
REQUIRED_EVENT_KEYS = ("user_id", "product_id", "action", "timestamp")
# Prefix of synthetic ids given to stream rows in the merged table.
STREAM_ID_PREFIX = "STREAM_"
# Constant amount of stream rows (no money changes hands on a click).
STREAM_AMOUNT_TEXT = "0.0"
# Rating contract: inclusive range.
RATING_MIN, RATING_MAX = 1.0, 5.0
# Feature-store version tag.
STORE_VERSION = "v1.0_combined"
# Score weights.
USER_ENGAGEMENT_WEIGHTS = {"avg_rating": 0.4, "log_activity": 0.3, "recency": 0.3}
USER_RECENCY_CAP_DAYS = 30
USER_RECENCY_DIVISOR = 6.0
USER_RECENCY_BASE = 5.0
ITEM_QUALITY_WEIGHTS = {"avg_rating": 0.5, "log_popularity": 0.3, "diversity": 0.2}
# Recommender defaults.
SVD_COMPONENTS = 12
TOP_K = 5
RELEVANCE_THRESHOLD = 3.5

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------
# Raw transactions as landed: all text, the raw zone keeps what arrived.
TX_RAW = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("amount", T.StringType()),
    T.StructField("rating", T.StringType()),
    T.StructField("timestamp", T.StringType()),
])

TX_COLUMNS = [f.name for f in TX_RAW.fields]

LINEAGE = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("step", T.StringType()),
    T.StructField("input_hash", T.StringType()),
    T.StructField("output_hash", T.StringType()),
    T.StructField("parameters", T.MapType(T.StringType(), T.StringType())),
])

STAGE_LOG = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("stage", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("started", T.TimestampType()),
    T.StructField("ended", T.TimestampType()),
    T.StructField("rows_out", T.LongType()),
    T.StructField("message", T.StringType()),
])

RUN_LOG = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("tag", T.StringType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
])
