"""User, item and user-item features.

Each table is one hash aggregation over the prepared interactions.  All
aggregates are algebraic (count/sum/avg/stddev/min/max) and get a map-side
partial step, so a hot user or product shuffles one partial row per map task.
The single distinct count per table is planned by Spark as an aggregation on
(key, value) first, which spreads a hot key's distinct values over partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurelake.functions import (
    as_timestamp,
    clip,
    elapsed_days,
    fill_numeric_zero,
    safe_div,
    ts_literal,
)
from featurelake.schemas import (
    ITEM_QUALITY_WEIGHTS,
    USER_ENGAGEMENT_WEIGHTS,
    USER_RECENCY_BASE,
    USER_RECENCY_CAP_DAYS,
    USER_RECENCY_DIVISOR,
)


def _with_ts(df: DataFrame, ts: str) -> DataFrame:
    """Parse the timestamp text once (C7) unless it is already a timestamp."""
    return df.withColumn("_ts", as_timestamp(ts))


def user_features(df: DataFrame, as_of=None, ts: str = "timestamp") -> DataFrame:
    """U1-U12 per ``user_id`` (null users are not a group), missing -> 0."""
    g = (_with_ts(df, ts).filter(F.col("user_id").isNotNull())
         .groupBy("user_id").agg(
            F.count("transaction_id").alias("user_total_interactions"),
            F.avg("rating").alias("user_avg_rating"),
            F.coalesce(F.sum("amount"), F.lit(0.0)).alias("user_total_spent"),
            F.avg("amount").alias("user_avg_spent"),
            F.stddev_samp("rating").alias("user_rating_std"),
            F.countDistinct("product_id").alias("user_unique_products"),
            F.min("_ts").alias("user_first_interaction"),
            F.max("_ts").alias("user_last_interaction"),
         ))
    return user_scores(g, as_of)


def user_scores(g: DataFrame, as_of=None) -> DataFrame:
    """U9-U12, what follows from a user's aggregates; missing -> 0."""
    now = ts_literal(as_of)
    g = (g.withColumn("user_tenure_days", elapsed_days(now, "user_first_interaction"))
          .withColumn("user_recency_days", elapsed_days(now, "user_last_interaction"))
          .withColumn("user_activity_rate",
                      safe_div("user_total_interactions", F.col("user_tenure_days") + 1)))
    w = USER_ENGAGEMENT_WEIGHTS
    recency_term = (F.lit(USER_RECENCY_BASE)
                    - clip(F.col("user_recency_days").cast("double"), 0, USER_RECENCY_CAP_DAYS)
                    / F.lit(USER_RECENCY_DIVISOR))
    g = g.withColumn(
        "user_engagement_score",
        F.col("user_avg_rating") * w["avg_rating"]
        + F.log1p(F.col("user_total_interactions").cast("double")) * w["log_activity"]
        + recency_term * w["recency"])
    return fill_numeric_zero(g)


def item_features(df: DataFrame, as_of=None, ts: str = "timestamp") -> DataFrame:
    """I1-I12 per ``product_id``, missing -> 0."""
    positive_amount = F.when(F.col("amount") > 0, F.col("amount"))
    g = (_with_ts(df, ts).filter(F.col("product_id").isNotNull())
         .groupBy("product_id").agg(
            F.avg("rating").alias("item_avg_rating"),
            F.count("transaction_id").alias("item_popularity_score"),
            F.coalesce(F.sum("amount"), F.lit(0.0)).alias("item_total_revenue"),
            F.avg(positive_amount).alias("item_avg_price"),
            F.stddev_samp("rating").alias("item_rating_std"),
            F.countDistinct("user_id").alias("item_unique_users"),
            F.min("_ts").alias("item_first_interaction"),
            F.max("_ts").alias("item_last_interaction"),
         ))
    return item_scores(g, as_of)


def item_scores(g: DataFrame, as_of=None) -> DataFrame:
    """I9-I12, what follows from an item's aggregates; missing -> 0."""
    now = ts_literal(as_of)
    g = (g.withColumn("item_age_days", elapsed_days(now, "item_first_interaction"))
          .withColumn("item_recency_days", elapsed_days(now, "item_last_interaction"))
          .withColumn("item_velocity",
                      safe_div("item_popularity_score", F.col("item_age_days") + 1)))
    w = ITEM_QUALITY_WEIGHTS
    g = g.withColumn(
        "item_quality_score",
        F.col("item_avg_rating") * w["avg_rating"]
        + F.log1p(F.col("item_popularity_score").cast("double")) * w["log_popularity"]
        + safe_div("item_unique_users", "item_popularity_score") * w["diversity"])
    return fill_numeric_zero(g)


def interaction_features(df: DataFrame, as_of=None, ts: str = "timestamp") -> DataFrame:
    """X1-X8 per (``user_id``, ``product_id``), missing -> 0."""
    g = (_with_ts(df, ts)
         .filter(F.col("user_id").isNotNull() & F.col("product_id").isNotNull())
         .groupBy("user_id", "product_id").agg(
            F.count("transaction_id").alias("interaction_count"),
            F.avg("rating").alias("interaction_avg_rating"),
            F.coalesce(F.sum("amount"), F.lit(0.0)).alias("interaction_total_spent"),
            F.min("_ts").alias("interaction_first"),
            F.max("_ts").alias("interaction_last"),
         ))
    return pair_scores(g, as_of)


def pair_scores(g: DataFrame, as_of=None) -> DataFrame:
    """X6-X8, what follows from a pair's aggregates; missing -> 0."""
    now = ts_literal(as_of)
    g = (g.withColumn("interaction_recency_days", elapsed_days(now, "interaction_last"))
          .withColumn("interaction_span_days", elapsed_days("interaction_last", "interaction_first")))
    return fill_numeric_zero(g)
