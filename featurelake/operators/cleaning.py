"""Cleaning (C1-C7). Order is fixed: coerce -> impute -> drop -> clip -> dedupe."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurelake.functions import as_timestamp, clip as clip_col, to_double
from featurelake.schemas import RATING_MAX, RATING_MIN


def coerce_numeric(df: DataFrame, column: str) -> DataFrame:
    """Text -> DOUBLE, anything that is not a number (``ERROR_VAL``, NaN,
    ``1.0d``) -> null."""
    return df.withColumn(column, to_double(column))


def impute_mean(df: DataFrame, column: str) -> DataFrame:
    """Null -> mean of the column over *all* rows of ``df``.

    The mean is a scalar subquery (one partial/final aggregate, evaluated once
    before the main stage) — no join and nothing collected row-wise.
    """
    c = F.col(column).cast("double")
    c = F.when(~F.isnan(c), c)
    mean = df.select(F.avg(c)).scalar()
    return df.withColumn(column, F.coalesce(c, mean))


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows where any of ``columns`` is null (plain IS NOT NULL
    predicates, which reach the Parquet scan as pushed filters)."""
    cond = F.lit(True)
    for c in columns:
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond)


def clip(df: DataFrame, column: str, lo: float, hi: float) -> DataFrame:
    """C4: clip into [lo, hi]; null stays null."""
    return df.withColumn(column, clip_col(column, lo, hi))


def dedupe_rows(df: DataFrame) -> DataFrame:
    """Drop identical full rows (nulls compare equal).

    Planned as a hash aggregate with a map-side partial step, so even a group of
    copies holding a large share of all rows collapses before the shuffle.
    """
    return df.dropDuplicates()


def prepare(df: DataFrame, rating: str = "rating", amount: str = "amount",
            keys: Sequence[str] = ("user_id", "product_id")) -> DataFrame:
    """The whole cleaning chain over raw interactions."""
    out = coerce_numeric(coerce_numeric(df, amount), rating)
    out = impute_mean(out, rating)          # mean before drops, clip and dedupe
    out = drop_missing(out, keys)
    out = clip(out, rating, RATING_MIN, RATING_MAX)
    return dedupe_rows(out)


def parse_ts(df: DataFrame, column: str = "timestamp", into: str | None = None) -> DataFrame:
    """Mixed-format timestamp text -> TIMESTAMP (UTC); unparseable -> null."""
    return df.withColumn(into or column, as_timestamp(column))
