"""Views of the driver's TPC-H-style tables in the pipeline's input shapes.

``interactions_raw`` is the raw transaction feed (lineitem joined to orders),
with the fault kinds the pipeline must survive injected by fixed arithmetic
rules on the keys: missing users, missing and non-numeric amounts, missing and
out-of-range ratings and exact duplicate rows.  Every source row is kept; the
rules only decide which *value* a row carries.

``click_events`` is the click stream (the ``events`` table).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fault-injection rules of the transaction fixture.
NULL_USER_PARTKEY_MOD = 97       # user_id missing when l_partkey % 97 = 0
NULL_AMOUNT_ORDERKEY_MOD = 101   # amount missing when l_orderkey % 101 = 0
BAD_AMOUNT_ORDERKEY_MOD = 103    # amount 'ERROR_VAL' when l_orderkey % 103 = 0
BAD_AMOUNT_TEXT = "ERROR_VAL"
NULL_RATING_ORDERKEY_MOD = 107   # rating missing when l_orderkey % 107 = 0
BIG_RATING_ORDERKEY_MOD = 109    # rating 99 when l_orderkey % 109 = 0
BIG_RATING = 99
RATING_FROM_QUANTITY_MOD = 7     # else rating = int(l_quantity) % 7  (0..6)
HALF_RATING_ORDERKEY_MOD = 113   # rating with a half when l_orderkey % 113 = 0
BAD_RATING_ORDERKEY_MOD = 127    # rating 'n/a' when l_orderkey % 127 = 0
BAD_RATING_TEXT = "n/a"
FINE_AMOUNT_ORDERKEY_MOD = 131   # amount with a third decimal when l_orderkey % 131 = 0
HUGE_AMOUNT_ORDERKEY_MOD = 1501  # amount '1e20' when l_orderkey % 1501 = 0
INF_AMOUNT_ORDERKEY_MOD = 2003   # amount 'inf' when l_orderkey % 2003 = 0
US_TIME_ORDERKEY_MOD = 137       # timestamp as month/day/year when l_orderkey % 137 = 0
LONG_TIME_ORDERKEY_MOD = 139     # timestamp with the month's name when l_orderkey % 139 = 0
DIGIT_TIME_ORDERKEY_MOD = 149    # timestamp as eight digits when l_orderkey % 149 = 0
BAD_TIME_ORDERKEY_MOD = 1511     # timestamp 'yesterday' when l_orderkey % 1511 = 0
BAD_TIME_TEXT = "yesterday"
DUPLICATE_ORDERKEY_MOD = 50      # row appears twice when l_orderkey % 50 = 0
# Event types renamed to the click actions of the stream.
EVENT_ACTION_RENAME = {"purchase": "add_to_cart"}

BATCH_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
STREAM_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _txt(c: Column) -> Column:
    return c.cast("string")


def interactions_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transactions, all text: transaction_id, user_id, product_id,
    amount, rating, timestamp."""
    return _raw_with_partkey(spark, sf_dir).drop("l_partkey")


def _raw_with_partkey(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    # Both sides are large at scale: a shuffle (sort-merge) join on the order
    # key; AQE turns it into a broadcast only when the runtime size is small,
    # and splits a hot order key through its skew-join handling.
    j = li.join(od, li.l_orderkey == od.o_orderkey, "inner")
    ok, pk = F.col("l_orderkey"), F.col("l_partkey")
    price = _txt(F.col("l_extendedprice").cast("decimal(18,2)"))
    rating = _txt(F.col("l_quantity").cast("int") % RATING_FROM_QUANTITY_MOD)
    shipped = F.col("l_shipdate").cast("timestamp")
    row = j.select(
        F.concat(F.lit("TXN-"), _txt(ok), F.lit("-"), _txt(F.col("l_linenumber"))).alias("transaction_id"),
        F.when(pk % NULL_USER_PARTKEY_MOD == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("U"), _txt(F.col("o_custkey")))).alias("user_id"),
        F.concat(F.lit("P"), _txt(pk)).alias("product_id"),
        F.when(ok % NULL_AMOUNT_ORDERKEY_MOD == 0, F.lit(None).cast("string"))
         .when(ok % BAD_AMOUNT_ORDERKEY_MOD == 0, F.lit(BAD_AMOUNT_TEXT))
         .when(ok % HUGE_AMOUNT_ORDERKEY_MOD == 0, F.lit("1e20"))
         .when(ok % INF_AMOUNT_ORDERKEY_MOD == 0, F.lit("inf"))
         .when(ok % FINE_AMOUNT_ORDERKEY_MOD == 0, F.concat(price, F.lit("4")))
         .otherwise(price).alias("amount"),
        F.when(ok % NULL_RATING_ORDERKEY_MOD == 0, F.lit(None).cast("string"))
         .when(ok % BIG_RATING_ORDERKEY_MOD == 0, F.lit(str(BIG_RATING)))
         .when(ok % BAD_RATING_ORDERKEY_MOD == 0, F.lit(BAD_RATING_TEXT))
         .when(ok % HALF_RATING_ORDERKEY_MOD == 0, F.concat(rating, F.lit(".5")))
         .otherwise(rating).alias("rating"),
        F.when(ok % US_TIME_ORDERKEY_MOD == 0, F.date_format(shipped, "MM/dd/yyyy HH:mm"))
         .when(ok % LONG_TIME_ORDERKEY_MOD == 0, F.date_format(shipped, "MMM d, yyyy HH:mm:ss"))
         .when(ok % DIGIT_TIME_ORDERKEY_MOD == 0, F.date_format(shipped, "yyyyMMdd"))
         .when(ok % BAD_TIME_ORDERKEY_MOD == 0, F.lit(BAD_TIME_TEXT))
         .otherwise(F.date_format(shipped, BATCH_TS_FORMAT)).alias("timestamp"),
        # copies: 2 for duplicated rows, else 1 (a generator, not a second scan)
        F.when(ok % DUPLICATE_ORDERKEY_MOD == 0, F.lit(2)).otherwise(F.lit(1)).alias("_copies"),
        pk,
    )
    return (row.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
               .drop("_copies", "_copy"))


def click_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Click events as they arrive: event_id, user_id, product_id, action,
    timestamp (ISO-8601 text with offset)."""
    ev = table(spark, sf_dir, "events")
    action = F.col("event_type")
    for src, dst in EVENT_ACTION_RENAME.items():
        action = F.when(F.col("event_type") == src, F.lit(dst)).otherwise(action)
    return ev.select(
        _txt(F.col("event_id")).alias("event_id"),
        F.concat(F.lit("U"), _txt(F.col("user_id"))).alias("user_id"),
        F.concat(F.lit("P"), F.get_json_object("props", "$.k")).alias("product_id"),
        action.alias("action"),
        F.date_format(F.col("ts").cast("timestamp"), STREAM_TS_FORMAT).alias("timestamp"),
    )


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The click stream as JSON text lines (``value``), the wire format."""
    ev = click_events(spark, sf_dir)
    return ev.select(F.to_json(F.struct(*ev.columns)).alias("value"))


def faulty_event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wire format with faults by event id: every 11th line is cut short,
    every 13th has text after the object, every 17th lacks its product, every
    19th has it null, every 23rd names its action twice."""
    ev = click_events(spark, sf_dir)
    n = F.col("event_id").cast("long")
    line = F.to_json(F.struct(*ev.columns))
    lacking = F.to_json(F.struct(*[c for c in ev.columns if c != "product_id"]))
    head = F.regexp_replace(lacking, r"\}$", "")
    return ev.select(
        F.when(n % 11 == 0, F.substring(line, 1, 20)).when(n % 13 == 0, F.concat(line, F.lit(" trailing")))
         .when(n % 17 == 0, lacking).when(n % 19 == 0, F.concat(head, F.lit(',"product_id":null}')))
         .when(n % 23 == 0, F.concat(F.regexp_replace(line, r"\}$", ""), F.lit(',"action":"view"}'))).otherwise(line).alias("value"))


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The speed table of a feed that arrives in the order of event ids, a
    thousand events a micro-batch."""
    ev = speed_snapshot(spark, sf_dir)
    n = F.col("event_id").cast("long")
    return ev.select("*", F.timestamp_seconds(F.floor(n / 1000)).alias("arrived"), F.floor(n / 1000).alias("arrival_batch"),
                     (n % 1000).alias("arrival_seq"))


def speed_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The speed table as the streaming ingest stores it (batch equivalent):
    user_id, product_id, action, ts, event_id."""
    ev = click_events(spark, sf_dir)
    return ev.select("event_id", "user_id", "product_id", "action", F.col("timestamp").alias("ts"))


def by_brand(spark: SparkSession, sf_dir: str, interactions: DataFrame) -> DataFrame:
    """Interactions with the part's brand in place of the product."""
    part = table(spark, sf_dir, "part").select(F.concat(F.lit("P"), _txt(F.col("p_partkey"))).alias("product_id"), "p_brand")
    return interactions.join(part, "product_id").drop("product_id").withColumnRenamed("p_brand", "product_id")
