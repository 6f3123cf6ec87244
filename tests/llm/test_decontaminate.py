import hashlib
import re

from featurelake.llm import decontaminate
from tests.llm.conftest import make_docs, pairs_of

ITEMS = "item_id long, text string, th long"


def words(t):
    lower = (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(pairs, items):
    wins = {}
    for i, t in items:
        w = words(t)
        n = min(10, len(w))
        for s in range(len(w) - n + 1 if w else 0):
            wins.setdefault(tuple(w[s:s + n]), set()).add(i)
    out = []
    for d, t in pairs:
        w, hit, found = words(t), set(), set()
        for win, ids in wins.items():
            for s in range(len(w) - len(win) + 1):
                if tuple(w[s:s + len(win)]) == win:
                    hit |= set(range(s, s + len(win)))
                    found |= {str(i) for i in ids if i is not None}
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def test_matches_brute_force(spark, corpus):
    pairs = pairs_of(corpus)
    text = dict(pairs)
    items = [(1, " ".join(text[0].split()[3:22])), (2, "TWO"), (11, text[201].upper()), (3, None), (4, ""), (5, "nowhere at all"),
             (6, " ".join(text[307].split()[-12:])), (6, " ".join(text[307].split()[-12:])), (7, "é日😀, ß"), (None, text[2])]
    got = decontaminate.contamination(corpus, spark.createDataFrame([(i, t, 1) for i, t in items], ITEMS)).drop("th")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(pairs, items)


def test_repeated_words_and_overlaps(spark):
    pairs = [(1, "a a a a a a a a a a a a b"), (2, "a a a"), (3, "b a a")]
    items = [(1, "a a a a a a a a a a a"), (2, "a a b"), (3, "b")]
    docs = make_docs(spark, pairs)
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], ITEMS)
    got = decontaminate.contamination(docs, bench).drop("th")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(pairs, items)
    assert [r["doc_id"] for r in decontaminate.clean(docs, bench).collect()] == [2]


def test_empty_tables(spark, corpus, no_docs):
    none = spark.createDataFrame([], ITEMS)
    assert decontaminate.contamination(no_docs, none).count() == 0
    assert decontaminate.clean(corpus, none).count() == corpus.count()
    assert decontaminate.clean(corpus, none).columns == corpus.columns
