import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that the operators use themselves
    T.StructField("th", T.LongType()), T.StructField("spans", T.StringType()), T.StructField("score", T.DoubleType()),
    T.StructField("_row_id", T.LongType()), T.StructField("token", T.StringType()), T.StructField("n", T.LongType()),
])
WORDS = [a + b for a in ("ba", "de", "fi", "go", "lu", "mo", "ra", "ti") for b in ("n", "rk", "st", "lve", "mmer", "x", "nto")]


def make_docs(spark, pairs):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 7, "x", 0.5, 1, "t", 3) for i, t in pairs], DOCS)


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "a", "o", "is"]) for _ in range(n))


@pytest.fixture(scope="session")
def corpus(spark):
    """Copies, near copies, shared passages, nulls, repeats and a long text."""
    rng = random.Random(5)
    base = [prose(rng, rng.randint(30, 90)) for _ in range(12)]
    pairs = [(i, t) for i, t in enumerate(base)]
    shared = prose(rng, 60)
    for k in range(30):
        words = rng.choice(base).split()
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = prose(rng, 1)
        pairs.append((100 + k, " ".join(words)))
    pairs += [(200 + k, shared + " " + prose(rng, 20)) for k in range(8)]
    pairs += [(300, None), (301, ""), (302, " \t\n "), (303, "one two"), (304, "One two"), (305, base[0].upper()),
              (306, base[0]), (306, base[0]), (None, base[1]), (None, None), (307, prose(rng, 9000)), (308, "é日😀 ß ١٢"), (309, "x" * 70000)]
    return make_docs(spark, pairs)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def pairs_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
