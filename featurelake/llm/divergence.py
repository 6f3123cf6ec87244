"""How far the sources of a language lie apart, term by term.

Texts that repeat are collapsed first: one row per (lang, text) with the
number of copies per source.  Each distinct text is split into terms once,
and what it counts for is weighted by its copies.  Terms that stand in enough
documents of a language are kept; a group (lang, source) gives each a smoothed
share of its occurrences, and two groups differ by the sum of
floor((p - q)^2 / (p + q)) over all kept terms.

That sum is never taken over all terms: a group gives every term that it lacks
one and the same share.  So a pair starts from "both lack all terms", each
group adds what its own terms change (by distinct shares, not by terms), and
only terms that both hold need a correction per pair.

Every number is an integer, and all are exact.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from featurelake.llm.common import IN_ROWS, checked_broadcast, stored

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"       # the fixed pattern of a term
MIN_DOCS, TOP_TERMS = 10, 10


def share(count: str, total: str, terms: str):
    """1 + floor(10^9 (count + 2) / (total + 2 terms)); null without terms."""
    below = f"nullif({total} + 2 * {terms}, 0)"
    return F.expr(f"1 + CASE WHEN {count} < 9000000000 THEN (1000000000L * ({count} + 2)) div {below} "
                  f"ELSE cast((cast(1000000000 AS decimal(38,0)) * ({count} + 2)) div {below} AS bigint) END")


def gap(p: str, q: str) -> str:
    """floor((p - q)^2 / (p + q)); shares are at most 10^9 + 1."""
    return f"((({p}) - ({q})) * (({p}) - ({q}))) div (({p}) + ({q}))"


def distinct_texts(docs: DataFrame) -> DataFrame:
    """(lang, text, sources): each distinct text of a language once, with
    (source, copies) of the sources that hold it.

    Copies are counted by digest, so a group of any size ships one small row
    per task.  A text that is there once goes on from the scan as it is; only
    those that repeat are shuffled, and one of each is kept.
    """
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    rows = rows.withColumn("digest", F.unhex(F.sha2("text", 256)))
    copies = rows.groupBy("lang", "digest", "source").agg(F.count("*").alias("copies"))
    repeated = stored(copies.groupBy("lang", "digest").agg(
        F.collect_list(F.struct("source", "copies")).alias("sources"), F.sum("copies").alias("n")).filter("n > 1").drop("n"), "repeated")
    known = checked_broadcast(repeated.select("lang", "digest"))
    once = rows.join(known, ["lang", "digest"], "left_anti").select(
        "lang", "text", F.array(F.struct("source", F.lit(1).cast("long").alias("copies"))).alias("sources"))
    texts = rows.join(known, ["lang", "digest"], "left_semi").groupBy("lang", "digest").agg(F.first("text").alias("text"))
    return once.union(texts.join(repeated, ["lang", "digest"]).select("lang", "text", "sources"))


#: Terms counted in a task before they go on.
HELD_TERMS = 300_000
#: What is no term becomes a space: bytes of the fixed class, as all of a
#: character beyond ASCII has its bytes above 0x7F.
_SPACED = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256))


def term_counts(texts: DataFrame) -> DataFrame:
    """(lang, source, term, count, docs): occurrences, and documents that hold
    the term, copies counted.  A text is split once, for all its copies; a
    task counts up to HELD_TERMS terms before it hands them on."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("count", pa.int64()), ("docs", pa.int64())])

    def handed(held):
        for (lang, source), (count, docs) in held.items():
            n = len(count)
            whole = pa.RecordBatch.from_arrays([
                pa.repeat(pa.scalar(lang, pa.string()), n), pa.repeat(pa.scalar(source, pa.string()), n), pa.array(count.keys(), pa.binary()),
                pa.array(count.values(), pa.int64()), pa.array(map(docs.__getitem__, count), pa.int64())], schema=schema)
            yield from (whole.slice(at, 10_000) for at in range(0, n, 10_000))

    def run(batches):
        held, waiting = {}, 0
        for batch in batches:
            for at in range(0, batch.num_rows, IN_ROWS):
                for lang, text, sources in zip(*(c.to_pylist() for c in batch.slice(at, IN_ROWS).columns)):
                    words = text.lower().translate(_SPACED).split()
                    once, own = set(words), None
                    for s in sources:
                        count, docs = held.setdefault((lang, s["source"]), (Counter(), Counter()))
                        if s["copies"] == 1:
                            count.update(words)
                            docs.update(once)
                        else:
                            own = own or Counter(words)
                            count.update({w: n * s["copies"] for w, n in own.items()})
                            docs.update(dict.fromkeys(once, s["copies"]))
                    waiting += len(once) * len(sources)
                    if waiting > HELD_TERMS:
                        waiting = sum(len(c) for c, _ in held.values())
                        if waiting > HELD_TERMS // 2:
                            yield from handed(held)
                            held, waiting = {}, 0
        yield from handed(held)

    found = texts.select("lang", F.col("text").cast("binary").alias("text"), "sources").mapInArrow(
        run, "lang string, source string, term binary, count long, docs long")
    return found.groupBy("lang", "source", F.col("term").cast("string").alias("term")).agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank) for ``docs`` (text, lang,
    source, any more columns).

    ``pair`` rows: every other source of the language with the summed gap.
    ``term`` rows: the ``top`` kept terms that the source holds with a larger
    share than its language does.  Equal values rank by item.

    Null text, lang and source read as ''.  Empty texts have no terms but
    their group exists; without kept terms all pairs are 0.  Repeated rows
    count as documents of their own.  Very long texts are split in one row; a
    language with a single source has no pairs; an empty table gives none.
    """
    counts = stored(term_counts(distinct_texts(docs)), "term-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("d"), F.sum("count").alias("lang_count")).filter(
        F.col("d") >= min_docs).drop("d")
    rows = stored(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "count", "lang_count"), "kept-terms")

    langs = rows.select("lang", "term", "lang_count").distinct().groupBy("lang").agg(
        F.count("*").alias("terms"), F.sum("lang_count").alias("lang_total"))
    totals = rows.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    groups = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    groups = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["total", "terms", "lang_total"])
    groups = stored(groups.withColumn("p0", share("0", "total", "terms")), "groups")

    held = stored(rows.join(checked_broadcast(groups), ["lang", "source"]).withColumns({
        "p": share("count", "total", "terms"), "q": share("lang_count", "lang_total", "terms")}).select(
        "lang", "source", "term", "count", "p", "q", "p0"), "shares")
    return _pairs(groups, held).unionByName(_terms(held, top))


def _terms(held: DataFrame, top: int) -> DataFrame:
    w = W.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item").asc())
    found = held.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr(gap("p", "q")).alias("value"))
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)


def _pairs(groups: DataFrame, held: DataFrame) -> DataFrame:
    own = groups.select("lang", "source", "p0", "terms")
    other = checked_broadcast(groups.select("lang", F.col("source").alias("other"), F.col("p0").alias("q0")))
    # the pairs themselves are rows of the result
    none = own.join(other, "lang").filter("source < other").select(
        "lang", F.col("source").alias("a"), F.col("other").alias("b"), F.expr(f"coalesce(terms * ({gap('p0', 'q0')}), 0)").alias("value"))
    shares = held.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("n"))
    single = shares.join(other, "lang").filter("source <> other").select(
        "lang", F.least("source", "other").alias("a"), F.greatest("source", "other").alias("b"),
        F.expr(f"n * (({gap('p', 'q0')}) - ({gap('p0', 'q0')}))").alias("value"))
    left = held.select("lang", "term", F.col("source").alias("a"), "p", "p0")
    right = held.select("lang", "term", F.col("source").alias("b"), F.col("p").alias("r"), F.col("p0").alias("r0"))
    both = left.join(right, ["lang", "term"]).filter("a < b").select(
        "lang", "a", "b", F.expr(f"({gap('p', 'r')}) - ({gap('p', 'r0')}) - ({gap('p0', 'r')}) + ({gap('p0', 'r0')})").alias("value"))
    total = none.union(single).union(both).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    sides = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                              F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("side")
    w = W.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item").asc())
    return total.select("lang", "value", sides).select("lang", "side.source", F.lit("pair").alias("part"), "side.item", "value").withColumn(
        "rank", F.row_number().over(w))
