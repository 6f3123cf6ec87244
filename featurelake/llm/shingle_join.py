"""N-gram Jaccard join with filters from several global token orders.

Texts become sets of hashed 4-word shingles.  Equal sets collapse into one
class first, so exact copies cost one row each.  Over the classes:

1. Two global orders of all shingles are fixed.  Both put shingles that are
   frequent in the corpus last (by a count sketch of fixed size over every
   text); each breaks ties by a hash of its own.  Any total order is valid for
   prefix filtering, so an inexact count costs time, never a link.
2. Under order k two sets with Jaccard >= t share a shingle among their first
   ``n - ceil(t n) + 1``.  Shingles that two classes have in their prefixes
   under the first order make buckets.  Each class is first compared with its
   buckets' leaders: the classes that have the fewest shingles in the prefix
   which they cannot have in common with others there.  Of a group of
   edited copies that is the least edited one, so this links the group
   through a number of pairs linear in its size.
3. What shares a bucket but is not connected yet is all compared.  Buckets
   inside one component are dropped by a combining aggregation before any
   pair is made.
4. A pair goes on only if *every* order allows it: the shingles the two
   prefixes have in common, plus all that can follow the cut, must reach the
   overlap the threshold needs.  The survivors are verified on whole sets.

Links between classes of one component that were never compared are not
needed for components; no link between components is missed.
"""

from __future__ import annotations

from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from featurelake.llm.common import checked_broadcast, map_rows, stored, with_row_keys
from featurelake.llm.components import components

SKETCH_BITS = 21        # counters of the frequency sketch: 2**21, whatever the corpus
SKETCH_BLOCKS = 32
BLOCK = 64              # classes in a block of the verification
ORDERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)

_U = np.uint64


class Measure(NamedTuple):
    """Shingles of so many words; linked from so many percent of the union."""

    words: int = 4
    percent: int = 85


NEAR_COPY = Measure(5, 80)


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser: one pseudo-random order of the tokens a seed."""
    x = x ^ _U(seed)
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


class WordHashes(dict):
    """Word to 64-bit hash, remembered up to a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 50_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(text: bytes | None, hashes: WordHashes, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles of a UTF-8 text.  ASCII
    letters are lowered and words split at ASCII white space; a text of fewer
    than k words is one shingle, one without words has none."""
    words = text.lower().split() if text else ()
    if not words:
        return np.empty(0, _U)
    w = np.fromiter(map(hashes.__getitem__, words), _U, len(words))
    size = min(k, len(w))
    h = np.full(len(w) - size + 1, _U(size))
    for i in range(size):
        h = h * _U(0x9DDFEA08EB382D69) + w[i:len(w) - size + 1 + i]
        h ^= h >> _U(29)
    return np.unique(_mix(h, 0))


def batch_shingles(rows, hashes: WordHashes, k: int, limit: int = 50_000):
    """(row, ``shingles`` of its last field) for many rows at a time: the
    hashes of all windows of a batch are computed together."""
    held, texts, size = [], [], 0

    def flush():
        flat = np.fromiter(map(hashes.__getitem__, chain.from_iterable(texts)), _U, size)
        n = max(0, size - k + 1)
        h = np.full(n, _U(k))
        for i in range(k):
            h = h * _U(0x9DDFEA08EB382D69) + flat[i:i + n]
            h ^= h >> _U(29)
        h = _mix(h, 0)
        at = 0
        for row, words in zip(held, texts):
            if len(words) >= k:
                s = np.sort(h[at:at + len(words) - k + 1])
                if len(s) > 1:
                    s = s[np.concatenate(([True], s[1:] != s[:-1]))]
            else:
                s = shingles(row[-1], hashes, k)
            at += len(words)
            yield row, s

    for row in rows:
        held.append(row)
        texts.append(row[-1].lower().split() if row[-1] else ())
        size += len(texts[-1])
        if size > limit:
            yield from flush()
            held, texts, size = [], [], 0
    yield from flush()


def need(n, m, percent: int):
    """Smallest overlap of sets of n and m tokens that reaches the threshold."""
    return -(-percent * (n + m) // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"], F.xxhash64(docs["text"]).alias("th"), docs["text"].cast("binary").alias("text"))


def signatures(docs: DataFrame, measure: Measure = Measure()) -> DataFrame:
    """One pass over all texts: rows of kind 0 hold (doc_id, th, n, sig), the
    size and 128-bit hash of the set; rows of kind 1 hold blocks of the
    partition's part of the frequency sketch."""
    size = 1 << SKETCH_BITS

    def run(rows):
        hashes, counts, one = WordHashes(), np.zeros(size, np.uint32), np.uint32(1)
        for (doc_id, th, _), s in batch_shingles(rows, hashes, measure.words):
            np.add.at(counts, (s & _U(size - 1)).astype(np.int64), one)     # in place
            yield 0, doc_id, th, len(s), xxhash.xxh3_128_digest(s.tobytes())
        if counts.any():
            for i, block in enumerate(np.split(counts, SKETCH_BLOCKS)):
                yield 1, i, None, 0, block.tobytes()

    return map_rows(_texts(docs), run, "kind int, doc_id long, th long, n long, sig binary")


def sketch_classes(parts: DataFrame) -> bytes:
    """Frequency class per counter, a byte each (2**SKETCH_BITS in all, the
    only thing that reaches the driver): 0 up to twice the mean count, one
    more with each doubling."""
    def add(key, pdf):
        import pandas as pd

        total = np.zeros((1 << SKETCH_BITS) // SKETCH_BLOCKS, np.uint64)
        for b in pdf["sig"]:
            total += np.frombuffer(b, np.uint32)
        return pd.DataFrame({"i": [int(key[0])], "b": [total.tobytes()]})

    def add64(key, pdf):
        import pandas as pd

        total = np.zeros((1 << SKETCH_BITS) // SKETCH_BLOCKS, np.uint64)
        for b in pdf["b"]:
            total += np.frombuffer(b, np.uint64)
        return pd.DataFrame({"i": [int(key[0])], "b": [total.tobytes()]})

    # in two steps, so that no task gathers the parts of all partitions
    some = parts.withColumn("g", F.pmod(F.spark_partition_id(), F.lit(512))).groupBy("doc_id", "g").applyInPandas(add, "i long, b binary")
    blocks = dict(map(tuple, some.groupBy("i").applyInPandas(add64, "i long, b binary").collect()))
    if not blocks:
        return bytes(1 << SKETCH_BITS)
    counts = np.concatenate([np.frombuffer(blocks[i], np.uint64) for i in range(SKETCH_BLOCKS)])
    mean = max(1.0, counts.sum() / len(counts))
    return np.minimum(31, np.log2(np.maximum(counts / mean, 1.0)).astype(np.int64)).astype(np.uint8).tobytes()


def prefixes(docs: DataFrame, classes: DataFrame, frequency: bytes, measure: Measure = Measure()) -> DataFrame:
    """(cid, n, p0, p1): the prefix of each class under both orders, as
    ascending order keys (frequency class in the high bits, then the hash):
    8 bytes a key under the first order, which is joined on; 4 under the
    second, which only filters, so that a clash of keys can only let a pair
    pass."""
    freq = docs.sparkSession.sparkContext.broadcast(frequency)  # 2 MB, fixed

    def run(rows):
        hashes, seen = WordHashes(), set()
        level = np.frombuffer(freq.value, np.uint8)
        mask = _U((1 << SKETCH_BITS) - 1)
        for _, s in batch_shingles(rows, hashes, measure.words):
            if not len(s):
                continue
            sig = xxhash.xxh3_128_digest(s.tobytes())
            if sig in seen:
                continue
            if len(seen) > 30_000:
                seen.clear()
            seen.add(sig)
            high = level[(s & mask).astype(np.int64)].astype(_U) << _U(58)
            p = prefix_length(len(s), measure.percent)
            first, second = (np.sort(np.partition(high | (_mix(s, seed) >> _U(6)), p - 1)[:p]) for seed in ORDERS)
            yield sig, first.tobytes(), (second >> _U(31)).astype(np.uint32).tobytes()

    found = map_rows(_texts(docs), run, "sig binary, p0 binary, p1 binary")
    return found.join(classes.select("sig", "cid", "n"), "sig").groupBy("cid").agg(
        F.first("n").alias("n"), F.first("p0").alias("p0"), F.first("p1").alias("p1"))


def prefix_entries(prefix: DataFrame) -> DataFrame:
    """(token, cid, at): the first order's prefix, a row a shingle; ``at``
    packs the size of the set and the rank in the prefix, which keeps the
    exchange narrow."""
    def run(batches):
        for b in batches:
            parts = b.column("p0").to_pylist()
            lens = np.array([len(x) // 8 for x in parts], np.int64)
            if not lens.sum():
                continue
            rank = np.arange(lens.sum()) - np.repeat(np.cumsum(lens) - lens, lens)
            cid, n = (np.repeat(b.column(c).to_numpy(), lens) for c in ("cid", "n"))
            full = pa.RecordBatch.from_arrays([pa.array(x) for x in (
                np.frombuffer(b"".join(parts), np.int64), cid, (n << 32) | rank)], names=["token", "cid", "at"])
            for at in range(0, full.num_rows, 100_000):
                yield full.slice(at, 100_000)

    return prefix.select("cid", "n", "p0").mapInArrow(run, "token long, cid long, at long")


def met_entries(prefix: DataFrame, measure: Measure) -> DataFrame:
    """(token, cid, at, lost, cut): the entries whose shingle other prefixes
    have too.

    ``cut`` is the last key of the class's prefix.  ``lost`` counts, for a
    pair met at this shingle for the first time, what the class cannot have in
    common with a class of a higher cut: shingles that rank lower, and those
    of higher rank in the prefix that no other prefix has (the other class
    has all of its shingles up to this cut in its own prefix).
    """
    entries = prefix_entries(prefix)
    met = entries.groupBy("token").agg(F.count("*").alias("size")).filter("size > 1").select("token")
    shared = stored(entries.join(met, "token"), "shingle-shared")

    def last_key(rows):
        for cid, p0 in rows:
            yield cid, int.from_bytes(p0[-8:], "little", signed=True)

    cuts = map_rows(prefix.select("cid", "p0"), last_key, "cid long, cut long")
    length = _size("at") - F.floor((_size("at") * measure.percent + 99) / 100) + 1
    later = F.row_number().over(W.partitionBy("cid").orderBy(F.desc("at"))) - 1
    return stored(shared.join(cuts, "cid").select("token", "cid", "at", (length - 1 - later).cast("long").alias("lost"), "cut"), "shingle-met")


def _size(x: str):
    return F.shiftright(x, 32)


def _rank(x: str):
    return F.col(x).bitwiseAND(F.lit((1 << 32) - 1))


def _may_link(x: str, y: str, percent: int):
    """Length and positional bounds at a common token of two ``met_entries``
    with the given column prefixes.  At the first common token of a linked
    pair both hold."""
    n, m = _size(f"{x}at"), _size(f"{y}at")
    low = F.col(f"{x}cut") <= F.col(f"{y}cut")
    lost_x = F.when(low, F.col(f"{x}lost")).otherwise(_rank(f"{x}at"))
    lost_y = F.when(low, _rank(f"{y}at")).otherwise(F.col(f"{y}lost"))
    after = F.least(n - lost_x, m - lost_y)
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (after * (100 + percent) >= percent * (n + m))


def _allowed(percent: int):
    """Step 4 for rows (a, b, n, p0, p1, m, q0, q1)."""
    def run(rows):
        for a, b, n, p0, p1, m, q0, q1 in rows:
            alpha = need(n, m, percent)
            for p, q, kind in ((p0, q0, np.int64), (p1, q1, np.uint32)):
                p, q = np.frombuffer(p, kind), np.frombuffer(q, kind)
                cut = min(p[-1], q[-1])
                i, j = np.searchsorted(p, cut, "right"), np.searchsorted(q, cut, "right")
                common = np.isin(p[:i], q[:j]).sum()
                if not common or common + min(n - i, m - j) < alpha:
                    break
            else:
                yield a, b

    return run


def verified(docs: DataFrame, classes: DataFrame, prefix: DataFrame, pairs: DataFrame, measure: Measure = Measure()) -> DataFrame:
    """Those of ``pairs`` (a, b) of class ids that link.

    The sets of the pairs that pass the prefix bounds are compared in blocks:
    the classes of a connected group of pairs are dealt into blocks of about
    BLOCK, and the pairs of two blocks meet in one task with the sets of
    both, so a set travels once for each block and not for each pair.
    """
    left = prefix.select(F.col("cid").alias("a"), "n", "p0", "p1")
    right = prefix.select(F.col("cid").alias("b"), F.col("n").alias("m"), F.col("p0").alias("q0"), F.col("p1").alias("q1"))
    # only the prefixes of pairs are moved
    right = right.join(checked_broadcast(pairs.select("b").distinct()), "b", "left_semi")
    joined = left.join(checked_broadcast(pairs), "a").join(right, "b").select("a", "b", "n", "p0", "p1", "m", "q0", "q1")
    some = stored(map_rows(joined, _allowed(measure.percent), "a long, b long"), "shingle-pairs")

    group = components(some)
    sizes = group.groupBy("root").agg(F.count("*").alias("size"))
    spread = max(1, group.count() // (4 * BLOCK))
    placed = stored(group.join(sizes, "root").select(
        F.col("node").alias("cid"), F.when(F.col("size") <= BLOCK, F.pmod(F.xxhash64("root"), F.lit(spread))).otherwise(F.col("root")).alias("g"),
        F.when(F.col("size") <= BLOCK, 0).otherwise(F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / BLOCK))).alias("i")), "shingle-blocks")
    tasks = stored(some.join(placed.select(F.col("cid").alias("a"), "g", F.col("i").alias("x")), "a").join(
        placed.select(F.col("cid").alias("b"), F.col("i").alias("y")), "b").select(
        "g", F.least("x", "y").alias("i"), F.greatest("x", "y").alias("j"), "a", "b"), "shingle-tasks")
    blocks = tasks.select(F.col("g").alias("bg"), F.col("i").alias("bi"), F.col("j").alias("bj")).distinct()
    sent = blocks.select("*", F.explode(F.array_distinct(F.array("bi", "bj"))).alias("own")).join(
        placed.select("cid", F.col("g").alias("bg"), F.col("i").alias("own")), ["bg", "own"]).select("bg", "bi", "bj", "cid")

    wanted = placed.select("cid").join(classes, "cid").select("cid", F.col("rep.doc_id").alias("rep_id"), F.col("rep.th").alias("th"))
    texts = _texts(docs)
    wanted = checked_broadcast(stored(wanted, "shingle-wanted"))
    texts = texts.join(wanted, texts["doc_id"].eqNullSafe(wanted["rep_id"]) & (texts["th"] == wanted["th"])).select("cid", "text")

    def sets(rows):
        for (cid, _), s in batch_shingles(rows, WordHashes(), measure.words):
            yield cid, s.tobytes()

    found = map_rows(texts, sets, "cid long, s binary").groupBy("cid").agg(F.first("s").alias("s"))
    sent = sent.join(found, "cid")

    def exact(pairs, sets):
        import pandas as pd

        by = {c: np.frombuffer(s, _U) for c, s in zip(sets["cid"], sets["s"])}
        out = []
        for a, b in zip(pairs["a"], pairs["b"]):
            x, y = by[a], by[b]
            common = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * common >= measure.percent * (len(x) + len(y) - common):
                out.append((a, b))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return stored(tasks.groupBy("g", "i", "j").cogroup(sent.groupBy("bg", "bi", "bj")).applyInPandas(exact, "a long, b long"), "shingle-links")


def jaccard_components(docs: DataFrame, measure: Measure = Measure()) -> DataFrame:
    """(doc_id, th, n_shingles, component_id) for every row of ``docs``
    (doc_id, text, any more columns).

    ``component_id`` is the smallest doc_id reachable.  Null, empty and blank
    texts have no shingles and stay alone; null ids are ignored in the
    minimum (null only if a whole component has none); repeated rows keep a
    row each.  ``th`` is xxhash64 of the text, to tell rows of one id apart.
    """
    return rooted(docs, measure).drop("root")


def rooted(docs: DataFrame, measure: Measure = Measure()) -> DataFrame:
    """The rows of ``jaccard_components`` with ``root``, which is a
    component's own: ids may be null or stand in several components.  Rows
    without shingles have none."""
    parts = stored(signatures(docs, measure), "shingle-signatures")
    rows = parts.filter("kind = 0").select("doc_id", "th", "n", "sig")
    classes = stored(rows.filter("n > 0").groupBy("sig").agg(
        F.first("n").alias("n"), F.min(F.struct("doc_id", "th")).alias("rep"), F.min("doc_id").alias("least_id")
    ).withColumn("cid", F.monotonically_increasing_id()), "shingle-classes")
    prefix = stored(prefixes(docs, classes, sketch_classes(parts.filter("kind = 1")), measure), "shingle-prefixes")

    shared = met_entries(prefix, measure)
    fields = ("at", "lost", "cut")
    lead = shared.groupBy("token").agg(F.min(F.struct("lost", "cid", "at", "cut")).alias("lead")).select(
        "token", F.col("lead.cid").alias("a"), *[F.col(f"lead.{f}").alias(f"a_{f}") for f in fields])
    first = stored(shared.join(lead, "token").filter((F.col("cid") != F.col("a")) & _may_link("", "a_", measure.percent)).select(
        F.least("a", "cid").alias("a"), F.greatest("a", "cid").alias("b")).distinct(), "shingle-leaders")
    links = verified(docs, classes, prefix, first, measure)
    roots = components(links)

    known = shared.join(roots, shared["cid"] == roots["node"], "left").select("token", "cid", *fields, F.coalesce("root", "cid").alias("root"))
    mixed = known.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("token")
    rest = stored(known.join(mixed, "token"), "shingle-mixed")
    a, b = (rest.select("token", *[F.col(c).alias(f"{x}_{c}") for c in ("cid", "root", *fields)]) for x in "ab")
    pairs = a.join(b, "token").filter((F.col("a_cid") < F.col("b_cid")) & (F.col("a_root") != F.col("b_root"))
                                      & _may_link("a_", "b_", measure.percent))
    pairs = stored(pairs.select(F.col("a_cid").alias("a"), F.col("b_cid").alias("b")).distinct().join(
        first, ["a", "b"], "left_anti"), "shingle-candidates")
    roots = components(links.union(verified(docs, classes, prefix, pairs, measure)))

    named = classes.join(roots, classes["cid"] == roots["node"], "left").select(
        "sig", "least_id", F.coalesce("root", "cid").alias("root"))
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = named.join(least, "root").select("sig", "root", "component_id")
    return rows.join(named, "sig", "left").select(
        "doc_id", "th", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("n") > 0, F.col("root")).alias("root"))


def one_of_each(docs: DataFrame, measure: Measure = Measure()) -> DataFrame:
    """``docs`` with one document of each group: the row whose id names the
    component, a row without id only where the whole component has none.
    Documents without words all stay; of rows that repeat an id in one
    component the smallest text hash stays, once."""
    found = rooted(docs, measure)
    keep = found.filter("n_shingles > 0").groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th")).alias("k")).select(
        F.xxhash64("k.doc_id").alias("id"), F.col("k.th").alias("th"))
    blank = F.regexp_replace(F.coalesce(docs["text"], F.lit("")), r"[\x20\x09-\x0D]", "") == ""
    keyed, names = with_row_keys(docs.filter(~blank))
    # after the join only rows that repeat both id and text are left to drop, and they are together
    stay = keyed.join(keep.toDF(*names), names, "left_semi").dropDuplicates(names).drop(*names)
    return stay.union(docs.filter(blank))
