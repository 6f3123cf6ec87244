import gzip
import hashlib
import os
import tracemalloc

from featurelake.operators import lineage
from featurelake.sources import files, lake


def test_many_small_files_with_three_headers(spark, scratch):
    os.makedirs(scratch)
    heads = ["transaction_id,user_id,rating", "user_id,transaction_id,channel", "﻿transaction_id,product_id"]
    for i in range(300):
        with open(f"{scratch}/f{i:04d}.csv", "w") as f:
            f.write(heads[i % 3] + ("\r\n" if i % 2 else "\n") + f"a{i},b{i},c{i}\n"[: 3 * (3 - (i % 3 == 2)) + 99].replace(f",c{i}", "" if i % 3 == 2 else f",c{i}"))
    open(f"{scratch}/empty.csv", "w").close()
    with gzip.open(f"{scratch}/g.csv.gz", "wt") as f:
        f.write(heads[0] + "\nz1,z2,z3\n")
    df = lake.read_csv_by_header(spark, scratch)
    assert set(df.columns) == {"transaction_id", "user_id", "rating", "channel", "product_id"}
    rows = {r.transaction_id: r for r in df.collect()}
    assert len(rows) == 301 and rows["a0"].user_id == "b0" and rows["b1"].user_id == "a1" and rows["a2"].product_id == "b2"
    assert rows["z1"].rating == "z3" and rows["a2"].rating is None
    assert len(df.inputFiles()) == 301


def test_digests_of_a_large_file_stay_in_chunks(spark, scratch, monkeypatch):
    os.makedirs(f"{scratch}/sub")
    block, digest = os.urandom(1 << 20), hashlib.md5()
    with open(f"{scratch}/sub/large.bin", "wb") as f:
        for _ in range(96):
            f.write(block)
            digest.update(block)
    open(f"{scratch}/none.bin", "w").close()
    got = {os.path.basename(r.path): (r.length, r.md5) for r in lineage.file_digests(spark, scratch, "*.bin").collect()}
    assert got == {"large.bin": (96 << 20, digest.hexdigest())}          # Spark lists no empty files
    tracemalloc.start()
    assert files._md5(f"file:{scratch}/sub/large.bin") == digest.hexdigest()
    assert tracemalloc.get_traced_memory()[1] < 40 << 20
    tracemalloc.stop()


def test_files_beyond_two_gigabytes_are_listed(spark, scratch):
    os.makedirs(scratch)
    with open(f"{scratch}/sparse.bin", "wb") as f:
        f.truncate((1 << 31) + 5)                # takes no room on disk
    assert [r.length for r in files.listing(spark, scratch).collect()] == [(1 << 31) + 5]
    got = lineage.file_digests(spark, scratch).collect()[0]
    want = hashlib.md5()
    for _ in range(256):
        want.update(bytes(1 << 23))
    want.update(bytes(5))
    assert (got.length, got.md5) == ((1 << 31) + 5, want.hexdigest())


def test_schemes_only_spark_knows_are_told_apart():
    assert files.readable("file:/tmp/x") and not files.readable("strange-scheme://host/x")
