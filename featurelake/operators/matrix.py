"""The user x item matrix in sparse form (R2), whole catalogs and all users.

``sparse_rows`` gives each user's vector, ``sparse_columns`` each item's (the
transpose), as ascending positions with their values.  A vector is cut into
segments of a fixed range of positions, so the row of a product that a third
of all users rated stays bounded.  Each form is one combining aggregation.

``tiles`` cuts the same matrix into blocks for products with thin matrices:
a tile holds the cells of one block of items (or users) in arrays, and large
blocks are dealt into several tiles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurelake.operators.indexing import with_position

# Positions that one segment of a vector covers.
SEGMENT = 65_536
# Rows of an index that Spark may send through the driver to all tasks, if it likes.
INDEX_ROWS = 200_000
# Rows of a thin matrix in a block, and cells of a tile at about most.
BLOCK, TILE_CELLS = 2048, 65_536


def positions(cells: DataFrame, column: str, name: str) -> DataFrame:
    """(column, name): dense 0-based positions of the distinct values, in
    their order."""
    return with_position(cells.select(column).distinct(), [F.col(column).asc()], name=name)


def looked_up(index: DataFrame, rows: int) -> DataFrame:
    """An index of that many rows, to be joined.  Sorted keys take a few bytes
    in files, by which Spark would broadcast millions of them, and the driver
    holds each in over a hundred; beyond INDEX_ROWS the join asks for a shuffle."""
    return index if rows <= INDEX_ROWS else index.hint("merge")


def _vectors(cells: DataFrame, key: str, index: DataFrame, other: str, position: str, segment: int) -> DataFrame:
    cell = F.struct(F.col(position).alias("at"), "rating")
    grouped = cells.join(index.select(other, position), other).groupBy(
        key, F.floor(F.col(position) / segment).cast("long").alias("segment")).agg(F.sort_array(F.collect_list(cell)).alias("c"))
    return grouped.select(key, "segment", F.col("c.at").alias("indices"), F.col("c.rating").alias("values"))


def sparse_rows(cells: DataFrame, items: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """R2: (user_id, segment, indices, values): the user's rated items by
    ``items`` position (product_id, item_idx), ascending, with the ratings;
    positions not listed are 0.  ``cells`` has a row per (user, item)."""
    return _vectors(cells, "user_id", items, "product_id", "item_idx", segment)


def sparse_columns(cells: DataFrame, users: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """The transpose: (product_id, segment, indices, values) by ``users``
    position (user_id, user_idx)."""
    return _vectors(cells, "product_id", users, "user_id", "user_idx", segment)


def cells_of(vectors: DataFrame, key: str) -> DataFrame:
    """(key, position, rating): sparse vectors taken apart again."""
    pairs = F.inline(F.arrays_zip(F.col("indices").alias("position"), F.col("values").alias("rating")))
    return vectors.select(key, pairs)


def numbered(cells: DataFrame, users: DataFrame, items: DataFrame, n_users: int, n_items: int) -> DataFrame:
    """(u, i, r): cells by position in the indexes of ``n_users`` and
    ``n_items`` rows; zeros carry nothing and go."""
    u = looked_up(users.select("user_id", F.col("user_idx").alias("u")), n_users)
    i = looked_up(items.select("product_id", F.col("item_idx").alias("i")), n_items)
    return cells.filter(F.col("rating") != 0).join(u, "user_id").join(i, "product_id").select("u", "i", F.col("rating").alias("r"))


def tiles(cells: DataFrame, by: str, other: str, block: int = BLOCK, tile_cells: int = TILE_CELLS,
          group: int | None = None) -> DataFrame:
    """(block, at, other, r): the numbered cells of each block of ``by``
    positions, sorted by ``other``; ``at`` is the position inside the block.
    A block of many cells becomes as many tiles as it needs, by a hash of
    ``other``, so one hot row or column is spread as well.  With ``group`` a
    tile holds cells of one range of that many ``other`` positions only, whose
    number is its ``group``."""
    own = cells.withColumn("block", F.floor(F.col(by) / block).cast("long"))
    keys = ["block"]
    if group:
        own, keys = own.withColumn("group", F.floor(F.col(other) / group).cast("long")), ["group", "block"]
    parts = own.groupBy(*keys).agg(F.ceil(F.count("*") / tile_cells).cast("long").alias("parts"))
    cell = F.struct(F.col(other).alias("other"), (F.col(by) % block).cast("int").alias("at"), "r")
    # a row per block, which all rows of few blocks need not be shuffled for
    grouped = own.join(F.broadcast(parts), keys).groupBy(*keys, F.pmod(F.xxhash64(other), F.col("parts")).alias("part")).agg(
        F.sort_array(F.collect_list(cell)).alias("c"))
    return grouped.select(*keys, F.col("c.at").alias("at"), F.col("c.other").alias("other"), F.col("c.r").alias("r"))
