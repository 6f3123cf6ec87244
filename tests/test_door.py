"""What comes in must be kept and reported: text, money, snapshots, streams."""
import datetime as dt
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from featurelake.operators import cleaning, features, lineage, quality, store
from featurelake.sources import lake
from featurelake.streaming import speed_layer
from conftest import tx_rows

AS_OF = "2024-02-01 00:00:00"


def _files(spark, folder, name, text):
    spark.createDataFrame([(x,) for x in text.splitlines()], "value string").coalesce(1).write.text(f"{folder}/{name}")


def test_columns_come_by_header_and_quotes_survive(spark, scratch):
    _files(spark, scratch, "a", 'transaction_id,user_id,product_id,amount,rating,timestamp\nt1,U1,"P ""x"", y",1.5,4.0,2024-01-01 00:00:00')
    _files(spark, scratch, "b", "product_id,channel,user_id,transaction_id,rating,timestamp\nP2,web,U2,t2,abc,20240105\nP3,app,U3,t3,3.5,bad")
    df = lake.read_transactions(spark, f"{scratch}/*")
    rows = {r.transaction_id: r for r in df.collect()}
    assert rows["t1"].product_id == 'P "x", y' and rows["t1"].rating == "4.0" and rows["t1"].channel is None
    assert (rows["t2"].user_id, rows["t2"].product_id, rows["t2"].channel, rows["t2"].amount) == ("U2", "P2", "web", None)
    got = {(r.column, r.check, r.row_key) for r in quality.validate(df).collect()}
    assert got == {("rating", "castable(double)", "t2"), ("timestamp", "castable(timestamp)", "t3")}
    clean = {r.transaction_id: r.rating for r in cleaning.prepare(df).collect()}
    assert clean == {"t1": 4.0, "t2": 3.75, "t3": 3.5}
    lake.land_raw(df, f"{scratch}/lake", "internal", "transactions", dt.datetime(2024, 1, 1))
    back = lake.latest_snapshot(spark, f"{scratch}/lake")
    assert sorted(map(str, back.select(df.columns).collect())) == sorted(map(str, df.collect()))


def test_missing_column_is_a_failure(spark, scratch):
    _files(spark, scratch, "a", "transaction_id,user_id,rating,timestamp\nt1,U1,3,2024-01-01")
    assert [(r.column, r.check) for r in quality.validate(lake.read_transactions(spark, f"{scratch}/*")).collect()] == [
        ("product_id", "column_present")]


def test_timestamp_formats(spark):
    texts = ["01/02/2024 10:00", "Jan 5, 2024 10:00:00", "20240105", "2024-01-05T10:00:00.5+02:00", "2024/01/05", "yesterday", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, timestamp string")
    got = {r.i: r.t for r in cleaning.parse_ts(df).select("i", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.S").alias("t")).collect()}
    assert [got[i] for i in range(7)] == ["2024-01-02 10:00:00.0", "2024-01-05 10:00:00.0", "2024-01-05 00:00:00.0", "2024-01-05 08:00:00.5",
                                          "2024-01-05 00:00:00.0", None, None]


def test_amounts_are_not_cut(spark):
    rows = [(f"a{i}", "U1", "P1", "0.004", 3, "2024-01-01") for i in range(10)]
    rows += [("b1", "U2", "P2", "1.0", 3, "2024-01-01"), ("b2", "U2", "P2", "inf", 3, "2024-01-01"), ("c1", "U3", "P3", "1e20", 3, "2024-01-01")]
    p = cleaning.prepare(tx_rows(spark, rows))
    spent = {r.user_id: r.user_total_spent for r in features.user_features(p, as_of=AS_OF).collect()}
    assert spent["U1"] == pytest.approx(0.04) and spent["U2"] == float("inf") and spent["U3"] == 1e20
    prices = {r.product_id: r.item_avg_price for r in features.item_features(p, as_of=AS_OF).collect()}
    assert prices["P1"] == pytest.approx(0.004) and prices["P2"] == float("inf")


def test_half_written_snapshot_is_not_read(spark, scratch):
    row = [("t1", "U1", "P1", "1", 3, "x")]
    lake.land_raw(tx_rows(spark, row), scratch, "internal", "transactions", dt.datetime(2024, 1, 1))
    base = lake.raw_path(scratch, "internal", "transactions")
    tx_rows(spark, [("t9", "U9", "P9", "1", 3, "x")]).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").option(
        "header", True).csv(f"{base}/ingest_date=2024-01-02/ingest_ts=20240102_000000000000")
    assert [r.transaction_id for r in lake.latest_snapshot(spark, scratch).collect()] == ["t1"]


def test_failed_zone_write_keeps_the_former_version(spark, scratch):
    lake.write_zone(tx_rows(spark, [("t1", "U1", "P1", "1", 3, "x"), ("STREAM_1", "U1", "P1", "0.0", 2, "x")]), scratch, "combined")
    broken = spark.range(3).select(F.raise_error(F.lit("disk full")).alias("transaction_id"))
    with pytest.raises(Exception):
        lake.write_zone(broken, scratch, "combined")
    assert lake.resolve_interactions(spark, scratch).count() == 2
    with pytest.raises(Exception):
        lake.write_zone(broken, f"{scratch}/other", "combined")
    lake.land_raw(tx_rows(spark, [("t1", "U1", "P1", "1", 3, "x")]), f"{scratch}/other", "internal", "transactions")
    with pytest.raises(FileNotFoundError):
        lake.resolve_interactions(spark, f"{scratch}/other")


def _event(i, **more):
    return json.dumps({"event_id": f"e{i}", "user_id": f"u{i}", "product_id": "P", "action": "view", "timestamp": "2024-01-01T00:00:00+00:00", **more})


def test_second_checkpoint_does_not_replace_events(spark, scratch):
    for n, lines in (("1", [_event(1), _event(2)]), ("2", [_event(3)])):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{scratch}/in{n}")
        speed_layer.ingest_folder(spark, f"{scratch}/in{n}", f"{scratch}/clicks", f"{scratch}/dead", f"{scratch}/ckpt{n}")
    got = lake.read_speed(spark, f"{scratch}/clicks")
    assert sorted(r.event_id for r in got.collect()) == ["e1", "e2", "e3"]
    assert got.filter("arrived is null").count() == 0
    assert speed_layer.latest_events(got, 1).first().event_id == "e3"
    assert speed_layer.read_dead_letters(spark, f"{scratch}/dead").count() == 0


def test_json_is_taken_strictly(spark):
    lines = [_event(1) + " and more", _event(2) + _event(3), "{'user_id': 'a', 'product_id': 'b', 'action': 'c', 'timestamp': 'd'}",
             _event(4)[:-1] + ', "action": "click"}', _event(5)]
    good, dead = speed_layer.split_events(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert sorted((r.event_id, r.action) for r in good.collect()) == [("e4", "click"), ("e5", "view")]
    assert [r.reason for r in dead.collect()] == ["malformed_json"] * 3


def test_fingerprints_tell_similar_rows_apart(spark):
    def fp(rows):
        return lineage.fingerprint(spark.createDataFrame(rows, "a string, b string")).first().fingerprint

    pairs = [[("x\x1fy", "z")], [("x", "y\x1fz")], [(None, "q")], [("\\N", "q")], [("-", "q")], [("1:x", None)], [("x", None)]]
    assert len({fp(p) for p in pairs}) == len(pairs)


def test_file_digest_is_the_files_md5(spark, scratch):
    spark.createDataFrame([("hello",)], "value string").coalesce(1).write.text(scratch)
    assert [r.md5 for r in lineage.file_digests(spark, scratch, "*.txt").collect()] == [hashlib.md5(b"hello\n").hexdigest()]


def test_store_switches_all_tables_together(spark, scratch):
    u = spark.createDataFrame([(f"U{i}", i) for i in range(50)], "user_id string, user_total_interactions long")
    i = spark.createDataFrame([("P1", 1)], "product_id string, item_popularity_score long")
    store.update_feature_store(scratch, u, i, as_of=AS_OF)
    broken = i.withColumn("item_popularity_score", F.raise_error(F.lit("no")).cast("long"))
    with pytest.raises(Exception):
        store.update_feature_store(scratch, u.limit(1), broken, as_of=AS_OF)
    assert store.read_table(spark, scratch, "user_features").count() == 50
    assert store.fetch_features(spark, scratch, "U7", "user").first().user_total_interactions == 7
