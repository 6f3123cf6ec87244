"""Benchmark decontamination by a prefix-filtered set join.

A benchmark item becomes windows of consecutive words (10, or the whole item
if it is shorter).  A document holds a window only if it holds all of its
words, so under an order of the words by rarity in the corpus the *first*
word of a window is a necessary prefix: documents are joined on that word
alone.  A join row then passes length and positional bounds (the window must
fit around the word's position) and exact containment (the document's words
at that place equal the window's).

Only built-in functions run here.  The document's word array stays inside one
generated stage from the scan to the join, so it is never copied per word.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from featurelake.llm.common import checked_broadcast, lower_ascii, row_keys, rows_in, stored

WINDOW = 10


def words(text):
    """Array of the words: runs of digits, letters and non-ASCII characters,
    ASCII letters lowered.  Null has none."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Distinct (win, length, item_ids) of all items."""
    items = benchmark.select("item_id", words(benchmark["text"]).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - size + 1))
    cut = items.select("item_id", "w", F.explode(starts).alias("s")).select(
        "item_id", F.slice("w", F.col("s"), size).alias("win"))
    return cut.groupBy("win").agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids")).withColumn(
        "length", F.size("win"))


def anchored(docs: DataFrame, wins: DataFrame) -> DataFrame:
    """Each window with its rarest word by corpus count, and where the word
    first stands in the window (``offset``, from 0)."""
    vocabulary = checked_broadcast(stored(wins.select(F.explode("win").alias("word")).distinct(), "window-words"))
    counts = docs.select(F.explode(words(docs["text"])).alias("word")).join(vocabulary, "word", "left_semi").groupBy(
        "word").agg(F.count("*").alias("n"))
    # a window with a word that the corpus lacks cannot occur, hence the inner join
    ranked = wins.select("win", "item_ids", "length", F.posexplode("win").alias("offset", "word")).join(counts, "word")
    return ranked.groupBy("win").agg(
        F.first("item_ids").alias("item_ids"), F.first("length").alias("length"), F.count("*").alias("known"),
        F.min(F.struct("n", "word", "offset")).alias("a")).filter("known = length").select(
        "win", "item_ids", "length", F.col("a.word").alias("word"), F.col("a.offset").alias("offset"))


def occurrences(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(doc_id, th, start, stop, item_ids): every place where a window stands,
    in words from 0, ``stop`` exclusive; ``th`` is xxhash64 of the text."""
    wins = stored(windows(benchmark, size), "windows")
    anchors = checked_broadcast(stored(anchored(docs, wins), "anchors"))
    ws = docs.select("doc_id", F.xxhash64("text").alias("th"), words(docs["text"]).alias("ws"))
    # the positions of all words; the array column is shared, not copied
    spread = ws.select("doc_id", "th", "ws", F.posexplode("ws").alias("pos", "word"))
    fits = (F.col("pos") >= F.col("offset")) & (F.col("pos") - F.col("offset") + F.col("length") <= F.size("ws"))
    place = F.slice("ws", F.col("pos") - F.col("offset") + 1, F.col("length"))
    return spread.join(anchors, "word").filter(fits).filter(place == F.col("win")).select(
        "doc_id", "th", (F.col("pos") - F.col("offset")).alias("start"),
        (F.col("pos") - F.col("offset") + F.col("length")).alias("stop"), "item_ids")


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(doc_id, th, n_words, n_hit, n_items, items_sha256, contaminated), a
    row for each row of ``docs``.

    Null and empty texts have no words and no hits; empty items match
    nothing; items or documents that repeat count as they stand; null ids are
    kept (null item ids cannot be named and are left out of the list).  Very
    long texts are searched whole; of equally rare words a window is found by
    its first; without documents there are no rows, without items no hits;
    further columns are not carried.
    """
    found = stored(occurrences(docs, benchmark, size).distinct(), "occurrences")
    order = W.partitionBy("doc_id", "th").orderBy("start", "stop").rowsBetween(W.unboundedPreceding, -1)
    covered = found.groupBy("doc_id", "th", "start", "stop").count().withColumn("reach", F.coalesce(F.max("stop").over(order), F.lit(0)))
    hits = covered.groupBy("doc_id", "th").agg(
        F.sum(F.greatest(F.lit(0), F.col("stop") - F.greatest("start", "reach"))).alias("n_hit"))
    items = found.select("doc_id", "th", F.explode("item_ids").alias("item")).groupBy("doc_id", "th").agg(
        F.sort_array(F.collect_set("item")).alias("items"))
    marks = hits.join(items, hits["doc_id"].eqNullSafe(items["doc_id"]) & (hits["th"] == items["th"]), "left").select(
        hits["doc_id"].alias("m_id"), hits["th"].alias("m_th"), "n_hit", "items")
    base = docs.select("doc_id", F.xxhash64("text").alias("th"), F.size(words(docs["text"])).cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    return base.join(marks, base["doc_id"].eqNullSafe(marks["m_id"]) & (base["th"] == marks["m_th"]), "left").select(
        "doc_id", "th", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.coalesce("items", none)), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs`` without the documents that hold a benchmark window; all columns
    and repeated rows stay as they are, null and empty texts too."""
    bad = stored(row_keys(occurrences(docs, benchmark, size)).distinct(), "contaminated")
    return rows_in(docs, checked_broadcast(bad), "left_anti")
