"""Dense positions in a global order without funnelling rows into one task.

A window ``row_number() OVER (ORDER BY ...)`` with no partition moves every
row into a single task.  Instead: range-partition and sort (``orderBy``), tag
each row with its partition and in-partition position
(``monotonically_increasing_id`` packs both), write the tagged rows to the
shared scratch folder, count rows per partition, and add each partition's
running offset.  The offset table has one row per partition, so it is bounded
by the partition count and safe to broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featurelake.session import fresh_dir, freed_shuffles

_LOW_BITS = (1 << 33) - 1


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: computed
    once, lineage cut, nothing held in executor memory."""
    path = fresh_dir(df.sparkSession, name)
    with freed_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_position(df: DataFrame, order: Sequence[Column], name: str = "position",
                  start: int = 0) -> DataFrame:
    """Add ``name`` = 0-based (or ``start``-based) rank of each row in ``order``.

    ``order`` must be a total order (add tie-breaking columns) for the result
    to be deterministic.  The tagged rows are stored, so both passes (counts,
    positions) see the same tags whatever executors are lost.
    """
    tagged = kept(df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id()), "positions")
    part = F.shiftright(F.col("_mid"), 33)
    counts = (tagged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n")))
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_offset"))
    pos = (F.col("_offset") + F.col("_mid").bitwiseAND(F.lit(_LOW_BITS)) + F.lit(start)).cast("long")
    return (tagged.withColumn("_part", part)
                  .join(F.broadcast(offsets), "_part")
                  .withColumn(name, pos)
                  .drop("_part", "_offset", "_mid"))
