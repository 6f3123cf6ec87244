"""Lambda merge (M1-M6): speed-layer events -> interaction rows -> union with batch."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurelake.functions import as_timestamp
from featurelake.operators.indexing import with_position
from featurelake.schemas import (
    IMPLICIT_RATING,
    RELEVANT_ACTIONS,
    STREAM_AMOUNT_TEXT,
    STREAM_ID_PREFIX,
    TX_COLUMNS,
)


def relevant_events(ev: DataFrame, actions: Sequence[str] = RELEVANT_ACTIONS) -> DataFrame:
    """M1: keep interaction actions only (pushed down to the scan as an IN filter)."""
    return ev.filter(F.col("action").isin(list(actions)))


def implicit_rating(ev: DataFrame, mapping: Mapping[str, int] = IMPLICIT_RATING) -> DataFrame:
    """M2: action -> implicit rating (text, like the raw feed's) through a
    literal map lookup."""
    lookup = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(str(int(v))))])
    return ev.withColumn("rating", F.element_at(lookup, F.col("action")))


def stream_ids(ev: DataFrame, mode: str = "rank", ts: str = "ts") -> DataFrame:
    """M4: synthetic ``transaction_id`` for stream rows.

    ``rank``: ``STREAM_<i>``, i = 0-based position by event time, newest first
    (ties broken by the remaining event columns).  Computed with a distributed
    positional index, not a single-task window.
    ``key``: ``STREAM_<event_id>`` — stable across runs, no global order needed.
    """
    if mode == "key":
        return ev.withColumn("transaction_id", F.concat(F.lit(STREAM_ID_PREFIX), F.col("event_id")))
    if mode != "rank":
        raise ValueError(f"unknown id mode {mode!r}")
    order = [as_timestamp(ts).desc_nulls_last(), F.col(ts).desc_nulls_last(),
             F.col("user_id").asc_nulls_first(), F.col("product_id").asc_nulls_first(),
             F.col("action").asc_nulls_first()]
    if "event_id" in ev.columns:
        order.append(F.col("event_id").asc_nulls_first())
    out = with_position(ev, order, name="_pos")
    return (out.withColumn("transaction_id",
                           F.concat(F.lit(STREAM_ID_PREFIX), F.col("_pos").cast("string")))
               .drop("_pos"))


def align(ev: DataFrame, ts: str = "ts") -> DataFrame:
    """M3 + M5: constant amount, rename ``ts`` and keep the six transaction columns."""
    return ev.select(
        "transaction_id", "user_id", "product_id",
        F.lit(STREAM_AMOUNT_TEXT).alias("amount"),
        F.col("rating").cast("string").alias("rating"),
        F.col(ts).alias("timestamp"),
    )


def stream_interactions(speed: DataFrame, id_mode: str = "rank") -> DataFrame:
    """M1, M2, M4, M3, M5 over a speed-table snapshot."""
    ev = relevant_events(speed)
    ev = implicit_rating(ev)
    ev = stream_ids(ev, mode=id_mode)
    return align(ev)


def merge_layers(batch: DataFrame, stream: DataFrame) -> DataFrame:
    """M6: bag union by column *name*; a column missing on one side is null."""
    return batch.unionByName(stream, allowMissingColumns=True).select(
        *[c for c in TX_COLUMNS] + [c for c in batch.columns if c not in TX_COLUMNS])


def combine(batch: DataFrame, speed: DataFrame | None, id_mode: str = "rank") -> DataFrame:
    """Whole merge: batch transactions plus the relevant stream events."""
    if speed is None:
        return batch
    return merge_layers(batch, stream_interactions(speed, id_mode=id_mode))
