from pyspark.sql import functions as F

from featurelake.functions import clip, elapsed_days, to_double
from featurelake.operators import cleaning
from conftest import tx_rows


def test_to_double_edge_cases(spark):
    vals = [("12.50",), (" 12 ",), ("1e3",), ("inf",), ("-inf",), ("1.0d",), ("2f",), ("ERROR_VAL",),
            ("nan",), ("1,000",), ("0x10",), (None,)]
    df = spark.createDataFrame(vals, "s string").select(to_double("s").alias("d"))
    got = [r.d for r in df.collect()]
    assert got[:5] == [12.5, 12.0, 1000.0, float("inf"), float("-inf")]
    assert got[5:] == [None] * 7


def test_impute_uses_mean_of_all_rows_before_drops(spark):
    # mean over ratings 1, 5, 99 and the duplicate -> (1 + 5 + 99 + 99) / 4
    rows = [("t1", "U1", "P1", "10", 1, "2024-01-01 00:00:00"),
            ("t2", None, "P1", "10", 5, "2024-01-01 00:00:00"),
            ("t3", "U2", "P2", "10", 99, "2024-01-01 00:00:00"),
            ("t3", "U2", "P2", "10", 99, "2024-01-01 00:00:00"),
            ("t4", "U3", "P3", "10", None, "2024-01-01 00:00:00")]
    out = cleaning.prepare(tx_rows(spark, rows))
    got = {r.transaction_id: r.rating for r in out.collect()}
    assert got == {"t1": 1.0, "t3": 5.0, "t4": 5.0}   # mean 51 clipped to 5
    assert out.count() == 3                           # null user dropped, duplicate removed


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (0.0,), (3.0,), (9.0,)], "r double")
    got = [r.c for r in df.select(clip("r", 1, 5).alias("c")).collect()]
    assert got == [None, 1.0, 3.0, 5.0]


def test_dedupe_treats_nulls_equal(spark):
    rows = [("t1", "U1", "P1", None, None, "x"), ("t1", "U1", "P1", None, None, "x")]
    assert cleaning.dedupe_rows(tx_rows(spark, rows)).count() == 1


def test_prepare_idempotent_on_complete_data(spark):
    rows = [("t1", "U1", "P1", "10.5", 4, "2024-01-01 00:00:00"),
            ("t2", "U1", "P2", "3", 2, "2024-01-02 00:00:00"),
            ("t2", "U1", "P2", "3", 2, "2024-01-02 00:00:00")]
    once = cleaning.prepare(tx_rows(spark, rows))
    twice = cleaning.prepare(once)
    assert sorted(once.collect()) == sorted(twice.collect())


def test_parse_mixed_timestamps(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00",), ("2024-01-01T10:00:00.5+00:00",),
                                ("2024-01-01T12:00:00+02:00",), ("garbage",)], "timestamp string")
    out = cleaning.parse_ts(df, into="ts").select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.S").alias("t"))
    assert [r.t for r in out.collect()] == ["2024-01-01 10:00:00.0", "2024-01-01 10:00:00.5",
                                           "2024-01-01 10:00:00.0", None]


def test_elapsed_days_floor(spark):
    df = spark.createDataFrame([("2024-01-02 00:00:00", "2024-01-02 01:00:00"),
                                ("2024-01-02 00:30:00", "2024-01-01 23:30:00"),
                                ("2024-01-03 00:00:00", "2024-01-01 00:00:00")], "a string, b string")
    got = [r.d for r in df.select(elapsed_days("a", "b").alias("d")).collect()]
    assert got == [-1, 0, 2]
