import random

import pytest

from featurelake.llm import shingle_join
from featurelake.llm.shingle_join import NEAR_COPY, Measure
from tests.llm.conftest import make_docs, pairs_of, prose


def brute(pairs, measure):
    def sets(t):
        w = (t or "").encode().lower().split()
        k = measure.words
        return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()

    s = [sets(t) for _, t in pairs]
    root = list(range(len(s)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(s)):
        for j in range(i):
            if s[i] and s[j] and 100 * len(s[i] & s[j]) >= measure.percent * len(s[i] | s[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(pairs):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(s[i]), least.get(find(i)) if s[i] else d) for i, (d, _) in enumerate(pairs)), key=str)


@pytest.mark.parametrize("measure", [Measure(), NEAR_COPY, Measure(2, 60)])
def test_components_match_brute_force(corpus, measure):
    got = shingle_join.jaccard_components(corpus, measure)
    rows = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()), key=str)
    assert rows == brute(pairs_of(corpus), measure)


def test_one_of_each_keeps_one_a_component_and_all_blanks(corpus):
    kept = shingle_join.one_of_each(corpus)
    assert kept.columns == corpus.columns
    ids = [r["doc_id"] for r in kept.collect()]
    expect = {c for d, n, c in brute(pairs_of(corpus), Measure()) if n}
    blank = {300, 301, 302, None}
    assert {i for i in ids if i not in blank} == expect - blank
    assert {300, 301, 302} <= set(ids) and ids.count(306) == 0 and ids.count(None) == 1


def test_one_of_each_keeps_unlike_texts_without_an_id_or_under_one_id(spark):
    rng = random.Random(6)
    base = [prose(rng, 40) for _ in range(6)]
    pairs = [(None, base[0]), (None, base[1]), (None, base[1] + " more"), (None, base[2]), (None, base[2]), (7, base[3]), (7, base[4]),
             (8, base[4]), (9, base[5]), (None, base[5])]
    kept = pairs_of(shingle_join.one_of_each(make_docs(spark, pairs)))
    assert len(kept) == 6 and {t.removesuffix(" more") for _, t in kept} == set(base)
    assert sorted((i for i, _ in kept if i is not None)) == [7, 7, 9]


def test_large_group_of_edited_copies_is_linked(spark):
    text = " ".join(f"w{i}" for i in range(200))
    pairs = [(i, text.replace(f"w{i} ", f"e{i} ") if i else text) for i in range(190)]
    got = shingle_join.jaccard_components(make_docs(spark, pairs))
    assert {r["component_id"] for r in got.collect()} == {0}


def test_prefixes_of_different_cuts(spark):
    """Random sets near the threshold over a small vocabulary."""
    rng = random.Random(8)
    pairs = []
    for i in range(150):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randint(12, 40))] if i % 5 == 0 else pairs[i - i % 5][1].split()
        for _ in range(rng.randint(0, 2)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(400)}"
        if rng.random() < 0.5:
            words += [f"w{rng.randrange(400)}" for _ in range(rng.randint(0, 3))]
        pairs.append((i, " ".join(words)))
    docs = make_docs(spark, pairs)
    for measure in (Measure(1, 80), Measure(2, 70)):
        got = shingle_join.jaccard_components(docs, measure)
        assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()), key=str) == brute(pairs, measure)


def test_empty_table(no_docs):
    assert shingle_join.jaccard_components(no_docs).count() == 0
    assert shingle_join.one_of_each(no_docs).count() == 0
