from pyspark.sql import functions as F

from featurelake.operators import merge, quality
from conftest import tx_rows


def _speed(spark):
    return spark.createDataFrame([
        ("e1", "U1", "P1", "view", "2024-01-01T00:00:01.000000+00:00"),
        ("e2", "U1", "P2", "add_to_cart", "2024-01-01T00:00:03.000000+00:00"),
        ("e3", "U2", "P1", "click", "2024-01-01T00:00:02.000000+00:00"),
        ("e4", "U2", "P3", "signup", "2024-01-01T00:00:04.000000+00:00"),
    ], "event_id string, user_id string, product_id string, action string, ts string")


def test_stream_rank_ids_newest_first(spark):
    out = {r.user_id + r.product_id: r for r in merge.stream_interactions(_speed(spark), "rank").collect()}
    assert len(out) == 3                                   # signup filtered
    assert out["U1P2"].transaction_id == "STREAM_0" and out["U1P2"].rating == "4"
    assert out["U2P1"].transaction_id == "STREAM_1" and out["U2P1"].rating == "3"
    assert out["U1P1"].transaction_id == "STREAM_2" and out["U1P1"].rating == "2"
    assert {r.amount for r in out.values()} == {"0.0"}


def test_stream_key_ids(spark):
    ids = {r.transaction_id for r in merge.stream_interactions(_speed(spark), "key").collect()}
    assert ids == {"STREAM_e1", "STREAM_e2", "STREAM_e3"}


def test_rank_ids_match_window_on_many_partitions(spark):
    from featurelake.operators.indexing import with_position
    from pyspark.sql import Window
    df = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 7919 % 5003).alias("k"))
    got = with_position(df, [F.col("k").desc()], "pos")
    ref = df.withColumn("ref", F.row_number().over(Window.orderBy(F.col("k").desc())) - 1)
    assert got.join(ref, "k").filter(F.col("pos") != F.col("ref")).count() == 0
    assert got.count() == 5000


def test_union_by_name_keeps_duplicates(spark):
    batch = tx_rows(spark, [("t1", "U1", "P1", "1", 3, "2024-01-01 00:00:00")] * 2)
    out = merge.combine(batch, _speed(spark), "key")
    assert out.count() == 5 and out.columns[:6] == ["transaction_id", "user_id", "product_id", "amount",
                                                    "rating", "timestamp"]


def test_dq_metrics_and_failures(spark):
    rows = [("t1", "U1", "P1", "1", 3, "2024-01-01 00:00:00"),
            ("t1", "U1", "P1", "1", 3, "2024-01-01 00:00:00"),
            ("t1", "U1", "P1", "1", 3, "2024-01-01 00:00:00"),
            ("t2", None, "P1", None, 99, "2024-01-01 00:00:00"),
            ("t3", "U2", "P2", "x", None, "not a time")]
    df = tx_rows(spark, rows)
    m = quality.dq_metrics(df).first()
    assert (m.total_rows, m.duplicates, m.missing_values) == (5, 2, 3)
    f = sorted((r.column, r.check, r.failure_case, r.row_key) for r in quality.validate(df).collect())
    assert f == [("rating", "in_range(1, 5)", "99", "t2"),
                 ("timestamp", "castable(timestamp)", "not a time", "t3"),
                 ("user_id", "not_null", None, "t2")]
    ext = {(r.column, r.check) for r in quality.validate(df, quality.EXTENDED_CONTRACT).collect()}
    assert ("amount", "castable(double)") in ext
    summary, _ = quality.dq_report(df)
    assert summary.first().status == "FAILED"


def test_schema_failure_for_missing_column(spark):
    df = tx_rows(spark, [("t1", "U1", "P1", "1", 3, "2024-01-01 00:00:00")]).drop("rating")
    f = [(r.column, r.check) for r in quality.validate(df).collect()]
    assert f == [("rating", "column_present")]
    clean = tx_rows(spark, [("t1", "U1", "P1", "1", 3, "2024-01-01 00:00:00")])
    assert quality.dq_report(clean)[0].first().status == "PASSED"
