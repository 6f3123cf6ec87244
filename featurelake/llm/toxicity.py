"""Toxicity by nearest labelled examples over an exact block-max index.

A bounded sample of labelled texts gives the examples.  Terms are whole words
and word beginnings (``^abc``), so that inflected forms meet; those whose
share of toxic examples is reliably high make up the vocabulary.  A text is
its TF-IDF vector over that vocabulary, with document frequencies counted
over every document.  The examples' vectors form an inverted index in blocks
with the largest weight of each term per block: a query visits blocks in
descending order of their score bound and stops once no block can reach its
k-th neighbour, so the k nearest by cosine are exact.  Their votes, weighted
by closeness and shrunk towards the base rate, give the score; the nearest
examples are returned as evidence.

The index holds at most ``MAX_EXAMPLES`` vectors over at most ``MAX_TERMS``
terms, whatever the corpus, and is broadcast; documents are scored where they
are read, without a shuffle of texts.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurelake.llm.common import checked_broadcast, map_rows, row_keys, rows_in, stored

MAX_EXAMPLES = 12_000    # labelled rows that are fitted on, at most
MAX_TERMS = 4_000        # vocabulary
PREFIXES = (3, 4, 5, 6, 7)
MIN_TOXIC = 6            # toxic examples a term must occur in
MIN_SHARE = 0.5          # lower 99 % bound of its share of toxic examples
K = 25                   # neighbours that vote
PRIOR_WEIGHT = 1.0
BLOCK = 64
EVIDENCE = 5

_WORD = re.compile(r"\w+")


def terms_of(word: str) -> list[str]:
    return [word, *("^" + word[:n] for n in PREFIXES if len(word) >= n)]


def held_out(doc_id):
    """True for the rows labels may not be learned from (null ids: as '')."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def examples(docs: DataFrame, labels: DataFrame, limit: int = MAX_EXAMPLES) -> DataFrame:
    """(example, text, toxic) of at most ``limit`` labelled rows, chosen by a
    hash of the id; equal texts once, under their smallest id.  Rows without
    id, label or text and the held-out ones give none; of contradicting
    labels of an id or a text the highest counts."""
    chosen = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(labels["doc_id"])).groupBy(
        "doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    rows = docs.select("doc_id", "text").filter("text is not null").join(F.broadcast(chosen), "doc_id")  # limit rows
    once = rows.groupBy("text").agg(F.min("doc_id").alias("example"), F.max("toxic").cast("int").alias("toxic"))
    return stored(once.select("example", "text", "toxic"), "toxic-examples")


def vocabulary(sample: DataFrame, limit: int = MAX_TERMS) -> list[str]:
    """The terms that mark toxic examples, strongest first."""
    def count(rows):
        seen: Counter = Counter()
        for text, toxic in rows:
            found = {t for w in set(_WORD.findall(text.lower())) for t in terms_of(w)}
            seen.update((t, toxic) for t in found)
            if len(seen) > 200_000:
                yield from ((t, n * y, n * (1 - y)) for (t, y), n in seen.items())
                seen.clear()
        yield from ((t, n * y, n * (1 - y)) for (t, y), n in seen.items())

    counts = map_rows(sample.select("text", "toxic"), count, "term string, pos long, neg long").groupBy("term").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    n, z = F.col("pos") + F.col("neg"), 2.576
    share = F.col("pos") / n
    low = (share + z * z / (2 * n) - z * F.sqrt(share * (1 - share) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    best = counts.filter((F.col("pos") >= MIN_TOXIC) & (low >= MIN_SHARE)).orderBy(F.desc("pos"), "term").limit(limit)
    return [r["term"] for r in best.select("term").collect()]


def vectors(docs: DataFrame, terms: list[str]) -> DataFrame:
    """(doc_id, th, ids, tf) of every row: the vocabulary terms of its whole
    text and how often each occurs."""
    number = {t: i for i, t in enumerate(terms)}

    def run(rows):
        known: dict[str, tuple[int, ...]] = {}
        for doc_id, th, text in rows:
            tf: dict[int, int] = {}
            for w in _WORD.findall(text.lower()) if text else ():
                ids = known.get(w)
                if ids is None:
                    if len(known) > 150_000:
                        known.clear()
                    ids = known[w] = tuple(number[t] for t in terms_of(w) if t in number)
                for i in ids:
                    tf[i] = tf.get(i, 0) + 1
            yield doc_id, th, list(tf), list(tf.values())

    texts = docs.select("doc_id", F.xxhash64("text").alias("th"), "text")
    return stored(map_rows(texts, run, "doc_id long, th long, ids array<int>, tf array<int>"), "toxic-vectors")


class BlockMaxIndex:
    """Exact top-k by cosine over sparse vectors of the examples."""

    def __init__(self, rows: list[tuple[int, int, list[int], list[int]]], idf: np.ndarray, block: int = BLOCK):
        rows = [r for r in rows if r[2]]
        # neighbours in a block share their weightiest term, which keeps bounds low
        rows.sort(key=lambda r: (max(r[2], key=lambda i: (idf[i], i)), r[0]))
        self.idf = idf
        self.ids = np.array([r[0] for r in rows], np.int64)
        self.toxic = np.array([r[1] for r in rows], np.float64)
        self.block = block
        self.blocks = -(-len(rows) // block)
        postings: dict[int, list[tuple[int, float]]] = {}
        for at, (_, _, ids, tf) in enumerate(rows):
            for i, w in zip(ids, self.weights(ids, tf)):
                postings.setdefault(i, []).append((at, w))
        self.postings, self.bounds = {}, {}
        for i, p in postings.items():
            at, w = np.array([x for x, _ in p]), np.array([x for _, x in p])
            b, first = np.unique(at // block, return_index=True)
            self.postings[i] = (at, w, dict(zip(b.tolist(), zip(first.tolist(), [*first[1:].tolist(), len(at)]))))
            self.bounds[i] = (b, np.maximum.reduceat(w, first))

    def weights(self, ids, tf) -> np.ndarray:
        w = (1 + np.log(np.array(tf, np.float64))) * self.idf[list(ids)]
        norm = math.sqrt(float(w @ w))
        return w / norm if norm else w

    def nearest(self, ids: list[int], tf: list[int], k: int) -> list[tuple[float, int]]:
        """(cosine, row) of the k nearest, ties by example id."""
        q = [(i, w) for i, w in zip(ids, self.weights(ids, tf)) if i in self.postings]
        bound = np.zeros(self.blocks)
        for i, w in q:
            b, m = self.bounds[i]
            bound[b] += w * m
        best: list[tuple[float, int, int]] = []
        for b in np.argsort(-bound, kind="stable"):
            if bound[b] <= 0 or len(best) >= k and bound[b] < -best[k - 1][0] - 1e-9:
                break
            score = np.zeros(self.block)
            for i, w in q:
                at, ws, spans = self.postings[i]
                if (span := spans.get(int(b))) is not None:
                    score[at[span[0]:span[1]] - b * self.block] += w * ws[span[0]:span[1]]
            hit = np.flatnonzero(score)
            best.extend((-round(float(score[h]), 9), int(self.ids[h + b * self.block]), int(h + b * self.block)) for h in hit)
            best = sorted(best)[:k]
        return [(-s, row) for s, _, row in best]


def score_vectors(rows: DataFrame, sample: DataFrame, n_terms: int, k: int = K) -> DataFrame:
    """Scores for ``vectors`` rows, by votes of the nearest of ``sample``."""
    spark = rows.sparkSession
    total = rows.count()
    df = dict(map(tuple, rows.select(F.explode("ids").alias("i")).groupBy("i").count().collect()))  # n_terms rows
    idf = np.array([math.log((1 + total) / (1 + df.get(i, 0))) + 1 for i in range(n_terms)])
    th = F.xxhash64("text").alias("s_th")
    taken = sample.select("example", th, "toxic")
    known = rows.join(F.broadcast(taken), (rows["doc_id"] == taken["example"]) & (rows["th"] == taken["s_th"])).select(
        "example", "toxic", "ids", "tf").dropDuplicates(["example"]).collect()  # MAX_EXAMPLES rows
    index = BlockMaxIndex([tuple(r) for r in known], idf)
    rate = sum(r["toxic"] for r in known) / max(1, len(known))
    plain = [r["toxic"] for r in known if not r["ids"]]
    # texts without a marked term: the rate of such examples
    no_terms = (sum(plain) + PRIOR_WEIGHT * rate) / (len(plain) + PRIOR_WEIGHT)
    shared = spark.sparkContext.broadcast(index)

    def run(batch):
        index, memo = shared.value, {}
        for doc_id, th, ids, tf in batch:
            key = (tuple(ids), tuple(tf))
            if key not in memo:
                if len(memo) > 50_000:
                    memo.clear()
                near = index.nearest(ids, tf, k) if ids else []
                if near:
                    w = [1 / (0.05 + max(0.0, 1 - s)) for s, _ in near]
                    # the weight of the prior is that of one neighbour at distance 1
                    prior = PRIOR_WEIGHT / 1.05
                    vote = (sum(x * index.toxic[r] for x, (_, r) in zip(w, near)) + prior * rate) / (sum(w) + prior)
                else:
                    vote = no_terms
                memo[key] = (min(1.0, max(0.0, float(vote))), [int(index.ids[r]) for _, r in near[:EVIDENCE]],
                             [float(s) for s, _ in near[:EVIDENCE]])
            yield doc_id, th, *memo[key]

    return map_rows(rows, run, "doc_id long, th long, score double, evidence array<long>, similarity array<double>")


def toxicity(docs: DataFrame, labels: DataFrame, limit: int = MAX_EXAMPLES, k: int = K) -> DataFrame:
    """(doc_id, th, score, evidence, similarity, held_out, predicted) for
    every row of ``docs``; only ``text`` enters the score.

    Null and empty texts and those without a vocabulary term score the rate
    of such examples; without any examples every score is 0.  Repeated rows
    keep a row each.  Neighbours at one distance rank by example id; very long
    texts count whole; an empty table gives no rows; further columns of
    ``docs`` are not carried.
    """
    sample = examples(docs, labels, limit)
    terms = vocabulary(sample)
    rows = vectors(docs, terms)
    return score_vectors(rows, sample, len(terms), k).withColumns({
        "held_out": held_out(F.col("doc_id")), "predicted": (F.col("score") >= 0.5).cast("int")})


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows predicted toxic."""
    bad = stored(row_keys(toxicity(docs, labels).filter("predicted = 1")).distinct(), "toxic-found")
    return rows_in(docs, checked_broadcast(bad), "left_anti")
