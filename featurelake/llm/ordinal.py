"""Quality by ordinal cumulative-link regression on graded ratings.

Grades are ordered; the model has one weight vector over hashed text features
that all grades share, and a threshold between each two grades:

    P(grade <= k) = 1 / (1 + exp(w x - b_k)),    b_0 < b_1 < ...

Thresholds stay ordered by construction (each is the one before plus a
positive step).  The result is the expected grade and the tail probabilities
P(grade >= k), on which documents are selected.

Labels hold a quality and a toxicity mark; together they rate a text 0 (poor),
1 (sound but toxic) or 2 (sound).  The model is fitted on a bounded sample of
labelled rows; every document is scored where it is read.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurelake.llm.common import map_rows, stored
from featurelake.llm.toxicity import held_out

MAX_ROWS = 8_000        # labelled rows fitted on, at most
BITS = 16               # hashed features: 2**16
STEPS = 200
RATE = 0.05
RIDGE = 1e-3
GRADES = 3

_TOKEN = re.compile(r"\w+|[^\w\s]+")


def _slot(token: str) -> int:
    return zlib.crc32(token.encode("utf-8", "surrogatepass")) & ((1 << BITS) - 1)


def _tenth(x: float) -> int:
    return int(min(9, max(0, x * 10)))


class Features:
    """Text to (slots, values): the words, punctuation runs and prefixes of a
    text by log frequency, of unit length together, and its shape in steps."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def __call__(self, text: str | None) -> tuple[list[int], list[float]]:
        tokens = _TOKEN.findall(text or "")
        counts: dict[str, int] = {}
        for t in tokens:
            counts[t] = counts.get(t, 0) + 1
        slots: dict[int, float] = {}
        words = marks = upper = most = letters = digits = 0
        known = self.known
        for t, c in counts.items():
            if t[0].isalnum() or t[0] == "_":
                words += c
                most = max(most, c)
                letters += c * len(t)
                upper += c * (len(t) > 1 and t.isupper())
                digits += c * t.isdigit()
                t = t.lower()
            else:
                marks += c
                t = t[:3]
            i = known.get(t)
            if i is None:
                if len(known) > 150_000:
                    known.clear()
                i = known[t] = _slot(t)
            slots[i] = slots.get(i, 0.0) + 1 + math.log(c)
        norm = math.sqrt(sum(v * v for v in slots.values())) or 1.0
        out = {i: v / norm for i, v in slots.items()}
        n = max(1, words)
        lines = (text or "").split("\n")
        shape = (f"\0size{int(math.log2(words + 1))}", f"\0distinct{_tenth(len(counts) / max(1, len(tokens)))}",
                 f"\0most{_tenth(most / n)}", f"\0marks{_tenth(marks / n)}", f"\0upper{_tenth(upper / n)}",
                 f"\0digits{_tenth(digits / n)}", f"\0length{int(min(20, letters / n))}",
                 f"\0lines{_tenth(len(set(lines)) / len(lines))}", f"\0words{_tenth(n / (10 * len(lines)))}")
        for s in shape:
            i = known.get(s)
            if i is None:
                i = known[s] = _slot(s)
            out[i] = out.get(i, 0.0) + 0.3
        return list(out), list(out.values())


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade): 0 poor, 1 sound but toxic, 2 sound.  Rows without id
    or quality give none, a null toxicity counts as 0, and of contradicting
    rows of one id the lowest grade counts."""
    grade = F.when(F.col("quality") == 0, 0).when(F.coalesce("toxic", F.lit(0)) == 1, 1).otherwise(2)
    return labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(
        F.min(grade).cast("int").alias("grade"))


def training_rows(docs: DataFrame, labels: DataFrame, limit: int = MAX_ROWS) -> DataFrame:
    """(grade, slots, values) of at most ``limit`` labelled rows that are not
    held out, chosen by a hash of the id."""
    chosen = graded(labels).filter(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("grade", "text")  # limit rows

    def run(batch):
        features = Features()
        for grade, text in batch:
            yield grade, *features(text)

    return map_rows(rows, run, "grade int, slots array<int>, values array<float>")


class CumulativeLink:
    """Weights and thresholds, fitted by Adam on the likelihood."""

    def __init__(self, grades: int = GRADES):
        self.w = np.zeros(1 << BITS)
        self.b = np.arange(grades - 1, dtype=np.float64)
        self.grades = grades

    def fit(self, rows: list[tuple[int, list[int], list[float]]], steps: int = STEPS, rate: float = RATE) -> CumulativeLink:
        if not rows:
            return self
        y = np.array([r[0] for r in rows])
        starts = np.cumsum([0, *(len(r[1]) for r in rows)])[:-1]
        at = np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows])
        slots = np.concatenate([np.array(r[1], np.int64) for r in rows])
        values = np.concatenate([np.array(r[2], np.float64) for r in rows])
        share = np.clip(np.cumsum(np.bincount(y, minlength=self.grades))[:-1] / len(y), 1e-3, 1 - 1e-3)
        b = np.log(share / (1 - share))
        theta = np.concatenate([b[:1], np.log(np.maximum(1e-2, np.diff(b)))])   # first threshold, log steps
        w = self.w.copy()
        state = [[np.zeros_like(w), np.zeros_like(w)], [np.zeros_like(theta), np.zeros_like(theta)]]
        for step in range(1, steps + 1):
            z = np.add.reduceat(values * w[slots], starts)
            b = np.cumsum(np.concatenate([theta[:1], np.exp(theta[1:])]))
            cut = np.concatenate([[-np.inf], b, [np.inf]])
            s = 1 / (1 + np.exp(np.clip(z[:, None] - cut[None, :], -40, 40)))    # P(grade <= k)
            s[:, 0], s[:, -1] = 0.0, 1.0
            p = np.maximum(1e-12, s[np.arange(len(y)), y + 1] - s[np.arange(len(y)), y])
            d = s * (1 - s)
            hi, lo = d[np.arange(len(y)), y + 1], d[np.arange(len(y)), y]
            dz = (hi - lo) / p                                                   # of minus log p
            db = np.zeros(len(b))
            for k in range(len(b)):
                db[k] = -(hi / p)[y == k].sum() + (lo / p)[y == k + 1].sum()
            gw = np.bincount(slots, weights=values * dz[at], minlength=len(w)) / len(y) + RIDGE * w
            back = np.cumsum(db[::-1])[::-1] / len(y)
            gt = np.concatenate([back[:1], back[1:] * np.exp(theta[1:])])
            for x, g, (m, v) in ((w, gw, state[0]), (theta, gt, state[1])):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                x -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        self.w, self.b = w, np.cumsum(np.concatenate([theta[:1], np.exp(theta[1:])]))
        return self

    def tails(self, slots: list[int], values: list[float]) -> list[float]:
        """P(grade >= k) for k from 1."""
        z = float(self.w[slots] @ np.array(values)) if slots else 0.0
        return [1 / (1 + math.exp(min(40.0, max(-40.0, float(b) - z)))) for b in self.b]


def quality(docs: DataFrame, labels: DataFrame, limit: int = MAX_ROWS, least_tail: float = 0.5) -> DataFrame:
    """(doc_id, th, held_out, expected_grade, p_ge_1, p_ge_2,
    predicted_grade, kept) for every row of ``docs``.

    ``kept`` selects by the tail probability of grade 1.  Null and empty
    texts score by their shape alone; without labelled rows the thresholds
    are the initial ones.  Repeated rows keep a row each.
    """
    model = CumulativeLink().fit([tuple(r) for r in stored(training_rows(docs, labels, limit), "quality-rows").collect()])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS weights

    def run(batch):
        features, model = Features(), shared.value
        for doc_id, th, text in batch:
            tails = model.tails(*features(text))
            points = [a - b for a, b in zip([1.0, *tails], [*tails, 0.0])]
            yield doc_id, th, sum(tails), *tails, int(np.argmax(points))

    texts = docs.select("doc_id", F.xxhash64("text").alias("th"), "text")
    return map_rows(texts, run, "doc_id long, th long, expected_grade double, p_ge_1 double, p_ge_2 double, predicted_grade int").withColumns(
        {"held_out": held_out(F.col("doc_id")), "kept": F.col("p_ge_1") >= least_tail})
