import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from featurelake.llm import vector_codes as vc

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                       T.StructField("label", T.IntegerType()), T.StructField("codes", T.StringType()), T.StructField("error", T.StringType()),
                       T.StructField("of", T.StringType()), T.StructField("rid", T.LongType())])


def make(spark, rows):
    return spark.createDataFrame([(i, v, la, "x", "y", "z", 1) for i, v, la in rows], SCHEMA)


def brute(rows, parts=8, entries=16, rounds=6):
    """Plain Python, one vector length."""
    kept = [(i, v, la) for i, v, la in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    ints = [[4096 * int(x) if abs(x) > 2**50 else math.floor(4096 * x) for x in v] for _, v, _ in kept]
    w = len(ints[0]) // parts
    first = sorted(range(len(kept)), key=lambda j: (kept[j][0] is None, kept[j][0], kept[j][1]))[:entries]
    books = [[ints[j][p * w:p * w + w] for j in first] for p in range(parts)]

    def near(p, v):
        return min((sum((a - b) ** 2 for a, b in zip(v[p * w:p * w + w], e)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for v in ints:
                groups.setdefault(near(p, v)[1], []).append(v[p * w:p * w + w])
            for e, vs in groups.items():
                books[p][e] = [sum(c) // len(vs) for c in zip(*vs)]
    coded = [[near(p, v) for p in range(parts)] for v in ints]
    errors = [sum(d for d, _ in c) for c in coded]
    by_label = {}
    for (_, _, la), e in zip(kept, errors):
        by_label[la] = by_label.get(la, 0) + e
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted([(i, [e for _, e in c], min(err, vc.LARGEST), min(by_label[la], vc.LARGEST), sha)
                   for (i, _, la), c, err in zip(kept, coded, errors)], key=str)


def rows_of(df):
    return sorted([(r["vec_id"], r["codes"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in df.collect()], key=str)


def sample(seed, n=90, dim=16, scale=0.3):
    rng = random.Random(seed)
    rows = [(rng.randrange(10_000), [rng.gauss(0, scale) for _ in range(dim)], rng.choice([0, 1, None])) for _ in range(n)]
    rows += [rows[0], rows[1], (rows[2][0], rows[3][1], 1), (None, rows[4][1], 0)]                  # repeated rows, ids, vectors
    rows += [(1, None, 0), (2, [None] + [0.0] * (dim - 1), 0), (3, [float("nan")] * dim, 0), (4, [float("inf")] + [0.0] * (dim - 1), None)]
    return rows + [(5, [0.0] * dim, 1), (6, [-1e-9] * dim, 1)]


@pytest.mark.parametrize("seed,scale", [(1, 0.3), (2, 0.001), (3, 1e5), (4, 1e200)])
def test_equals_brute_force(spark, seed, scale):
    rows = sample(seed, scale=scale)
    assert rows_of(vc.compressed(make(spark, rows).repartition(5))) == brute(rows)


def test_fewer_rows_than_entries_and_other_lengths(spark):
    rows = [(i, [i / 7, -i / 3] * 4, 0) for i in range(5)]
    assert rows_of(vc.compressed(make(spark, rows))) == brute(rows)
    mixed = vc.compressed(make(spark, rows + [(9, [0.5] * 3, 0), (10, [], 1)])).collect()
    assert {r["vec_id"]: len(r["codes"]) for r in mixed} == {**{i: 8 for i in range(5)}, 9: 8, 10: 8}
    assert rows_of(vc.compressed(make(spark, [(9, [0.5] * 3, 0)])))[0][2] == 0


def test_empty_table(spark):
    assert vc.compressed(make(spark, [])).count() == 0
    assert vc.compressed(make(spark, [(1, None, 0)])).count() == 0


@pytest.mark.parametrize("kind", ["random", "ties", "huge"])
def test_tree_finds_the_nearest_with_the_lowest_index(kind):
    rng = np.random.default_rng(7)
    for _ in range(30):
        span = 4 if kind == "ties" else 3000
        book, x = (rng.integers(-span, span, (n, 3)) for n in (int(rng.integers(1, 60)), 200))
        if kind == "huge":
            book, x = book.astype(object) * 10**40, x.astype(object) * 10**40
        d = [[int(((a - b) ** 2).sum()) for b in book] for a in x]
        index, found, _ = vc.Gnat(book).nearest(x)
        assert index.tolist() == [row.index(min(row)) for row in d]
        assert [int(v) for v in found] == [min(row) for row in d]


def test_subtrees_are_left_out_on_clustered_entries():
    rng = np.random.default_rng(8)
    centres = rng.integers(-100_000, 100_000, (8, 8))
    book = np.repeat(centres, 16, axis=0) + rng.integers(-50, 50, (128, 8))
    x = book[rng.integers(0, 128, 1000)] + rng.integers(-20, 20, (1000, 8))
    assert vc.Gnat(book).nearest(x)[2] < 0.4 * 128 * 1000


def test_approximation_is_nearer_than_the_mean(spark):
    rows = [(i, v, 0) for i, v, _ in sample(5) if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    vectors = make(spark, rows).select("vec_id", "embedding")
    books = vc.fit(vectors)
    back = vc.decode(vc.encode(vectors.withColumn("kept", vectors["embedding"][0]), books), books).collect()
    assert all(len(r["approximation"]) == 16 for r in back)
    x = {i: np.array(v) for i, v, _ in rows}
    err = sum(((x[r["vec_id"]] - np.array(r["approximation"])) ** 2).sum() for r in back if r["vec_id"] is not None)
    assert err < sum((v ** 2).sum() for v in x.values())
