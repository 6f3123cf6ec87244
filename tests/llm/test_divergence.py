import random
import re
from collections import Counter

import pytest
from pyspark.sql import Row

from featurelake.llm import divergence
from tests.llm.conftest import DOCS, prose

TERM = re.compile(divergence.TERM)
UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def brute(rows, min_docs, top):
    docs = [(lang or "", source or "", TERM.findall((text or "").translate(UPPER))) for lang, source, text in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [(s, ws) for la, s, ws in docs if la == lang]
        df = Counter(w for _, ws in own for w in set(ws))
        kept = sorted(w for w, n in df.items() if n >= min_docs)
        v = len(kept)

        def shares(words):
            c = Counter(w for w in words if w in set(kept))
            return c, {w: 1 + 10**9 * (c[w] + 2) // (sum(c.values()) + 2 * v) for w in kept}

        whole = shares([w for _, ws in own for w in ws])[1]
        groups = {s: shares([w for t, ws in own if t == s for w in ws]) for s in {s for s, _ in own}}
        for s, (count, p) in groups.items():
            found = [("pair", t, sum((p[w] - q[w]) ** 2 // (p[w] + q[w]) for w in kept)) for t, (_, q) in groups.items() if t != s]
            terms = [("term", w, (p[w] - whole[w]) ** 2 // (p[w] + whole[w])) for w in kept if count[w] and p[w] > whole[w]]
            for part in (found, terms):
                part.sort(key=lambda r: (-r[2], r[1].encode()))
                out += [(lang, s, *r, n) for n, r in enumerate(part, 1) if r[0] == "pair" or n <= top]
    return sorted(out)


def make(spark, rows):
    return spark.createDataFrame([Row(doc_id=i, text=t, lang=la, source=s, n_chars=0, th=1, spans="", score=0.0, _row_id=1, token="", n=i)
                                  for i, (la, s, t) in enumerate(rows)], DOCS)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "b", None]), rng.choice(["s1", "s2", "s3", "é", None]), prose(rng, rng.randint(0, 40))) for _ in range(120)]
    rows += [("a", "s1", rows[0][2].upper()), ("a", "s2", None), ("b", "s9", ""), ("c", "alone", "one two"), ("d", "x", "12 ."), ("d", "y", "q")]
    rows += [("a", s, "Copy ÀÉ copy copies 日本") for s in ["s1"] * 30 + ["s2"] * 12 + ["s3"]]     # a large group of copies
    rows += [("a", "s1", prose(rng, 9000))]
    got = divergence.divergence(make(spark, rows), min_docs=6, top=4)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 6, 4)


def test_ties_rank_by_item_in_bytes(spark):
    rows = [("a", "s", "one two"), ("a", "é", "one two"), ("a", "z", "one two")]
    got = divergence.divergence(make(spark, rows), min_docs=1).filter("part = 'pair' AND source = 's'").orderBy("rank").collect()
    assert [(r["item"], r["value"], r["rank"]) for r in got] == [("z", 0, 1), ("é", 0, 2)]


def test_large_counts_stay_exact(spark):
    big = 9_300_000_000
    row = spark.createDataFrame([(big, 3 * big, 7)], "count long, total long, terms long")
    assert row.select(divergence.share("count", "total", "terms")).first()[0] == 1 + 10**9 * (big + 2) // (3 * big + 14)


def test_copies_are_split_into_terms_once(spark):
    texts = divergence.distinct_texts(make(spark, [("a", "s", "same text")] * 50 + [("a", "t", "same text"), ("b", "s", "same text")]))
    got = {r["lang"]: sorted(map(tuple, r["sources"])) for r in texts.collect()}
    assert got == {"a": [("s", 50), ("t", 1)], "b": [("s", 1)]}


def test_empty_table(no_docs):
    assert divergence.divergence(no_docs).count() == 0
