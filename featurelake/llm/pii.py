"""Personal data: pattern spans, and terms that give protected entities away.

The patterns find protected entities (mail, IP, card and phone numbers).
Corpus co-occurrence then estimates how strongly a word reveals an entity:
with D(t), D(e) the documents that hold word t or entity e, D(t, e) those
that hold e and, anywhere outside their entities, t, and N all documents,

    disclosure(t, e) = ln(N D(t, e) / (D(t) D(e))) / ln(N / D(e)),

the pointwise mutual information as a share of the entity's information
content: 1 when every document with t names e.  Words whose disclosure
reaches ``threshold`` are sanitised like the entity itself: wherever they
stand in a document that holds it they become spans of kind ``term``.
Numbers are generalised to digits' places, words removed.

An entity is often in one document only, which says nothing about the words
there.  So the same is computed for pools of entities, and a pool stands for
each entity in it: those of one mail domain, network, card issuer or number
range, and all of a kind.  Copies of a text are documents in the formula but
no evidence: a pair needs ``support`` unlike texts (for an entity in two or
three, all of them), and in a pool as many as chance would not give.

Only built-in functions run here.  ``regexp`` functions give matched texts
without positions, so the text is also split at the matches: the lengths of
the pieces between them give the positions.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurelake.llm.common import checked_broadcast, stored, unused, with_row_keys

# Possessive and anchored forms of the fixed patterns: the same matches
# without retries inside a run that has failed, hence in linear time.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = list(PATTERNS)
#: What a text must hold for a pattern to be tried (others: a first match).
NEEDS = {"email": "@", "phone": "+"}
THRESHOLD = 0.8
SUPPORT = 4
CHANCE = 1e-6           # that a pool's texts with a term all hold the pool by chance, at most
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
NO_WORD = WORD.replace("[^", "[")
SPAN = "struct<kind:string,start:int,stop:int,value:string>"


def _luhn(digits):
    n = F.length(digits)
    doubled = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda acc, i: acc + F.when(
        (n - i) % 2 == 1,
        F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]),
                     F.substring(digits, i, F.lit(1)).cast("int") + 1)).otherwise(F.substring(digits, i, F.lit(1)).cast("int")))
    return doubled % 10 == 0


def _valid(kind: str, value):
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(999)) <= 255))
    if kind == "card":
        return F.length(digits).between(13, 19) & F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _is_valid(kind: str):
    return lambda span: _valid(kind, span["value"])


def _is(kind: str):
    return lambda span: span["kind"] == kind


#: Matches whose positions are added up together; then those of such blocks.
STRETCH = 256


def _placed(text, pattern: str, kind: str, value):
    """All matches as spans with their code-point positions, from the lengths
    of the matches and of the gaps between them.

    The sums run in two levels, inside blocks of STRETCH matches and over the
    blocks, as an array that grows match by match would be copied each time.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    # a split never yields an empty piece before a match at the start of the
    # text unless the match has a width, and all of ours have
    pairs = F.zip_with(found, F.slice(F.split(text, pattern, -1), 1, F.size(found)), lambda m, g: F.struct(m.alias("m"), F.length(g).alias("g")))
    none = F.array().cast(f"array<{SPAN}>")

    def step(acc, m):
        at = acc["at"] + m["g"]
        stop = at + F.length(m["m"])
        one = F.struct(F.lit(kind).alias("kind"), at.alias("start"), stop.alias("stop"), value(m["m"]).alias("value"))
        return F.struct(stop.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    def in_blocks(all_pairs):
        count = F.ceil(F.size(all_pairs) / STRETCH).cast("int")
        return F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda b: F.aggregate(
            F.slice(all_pairs, (b - 1) * STRETCH + 1, F.lit(STRETCH)), F.struct(F.lit(0).alias("at"), none.alias("out")), step))

    # bound to a name by a transform of one element: worked out once
    def moved(blocks):
        starts = F.aggregate(blocks, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), lambda acc, b: F.struct(
            (acc["at"] + b["at"]).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")))["out"]
        return F.flatten(F.zip_with(blocks, starts, lambda b, start: F.transform(b["out"], lambda s: F.struct(
            s["kind"].alias("kind"), (s["start"] + start).alias("start"), (s["stop"] + start).alias("stop"), s["value"].alias("value")))))

    once = F.transform(F.array(pairs), in_blocks)
    return F.flatten(F.transform(once, moved))


def _located(text, pattern: str, kind: str):
    return _placed(text, pattern, kind, lambda m: m)


def base_spans(text):
    """Spans of the four fixed patterns, by kind as listed, then start."""
    none = F.array().cast(f"array<{SPAN}>")
    parts = []
    for kind, pattern in PATTERNS.items():
        spans = F.filter(_located(text, pattern, kind), _is_valid(kind))
        # most texts hold no match at all: find that out before splitting them
        tried = F.contains(text, F.lit(NEEDS[kind])) if kind in NEEDS else F.rlike(text, F.lit(pattern))
        parts.append(F.when(tried, spans).otherwise(none))
    return F.concat(*parts)


def with_spans(docs: DataFrame) -> DataFrame:
    """``docs`` rows as (doc_id, th, text, spans); null texts are empty."""
    text = F.coalesce(docs["text"], F.lit(""))
    return docs.select("doc_id", F.xxhash64("text").alias("th"), text.alias("text")).withColumn("spans", base_spans(F.col("text")))


def _pool(span):
    """What entities of one origin have in common."""
    digits = F.regexp_replace(span["value"], "[^0-9]", "")
    return F.when(span["kind"] == "email", F.lower(F.substring_index(span["value"], "@", -1))).when(
        span["kind"] == "ip", F.substring_index(span["value"], ".", 3)).otherwise(F.substring(digits, 1, 6))


def entity_texts(found: DataFrame) -> DataFrame:
    """(th, copies, text, fine, kinds, terms) of each distinct text of rows
    (th, text, spans): its entities and pools, the kinds, and the words
    outside the entities."""
    fine = F.flatten(F.transform("spans", lambda s: F.array(
        F.concat_ws(":", F.lit("one"), s["kind"], s["value"]), F.concat_ws(":", F.lit("pool"), s["kind"], _pool(s)))))
    kinds = F.transform("spans", lambda s: F.concat(F.lit("kind:"), s["kind"]))
    bare = F.aggregate(F.array_distinct(F.transform("spans", lambda s: s["value"])), F.col("text"),
                       lambda left, value: F.replace(left, value, F.lit(" ")))
    copies = found.groupBy("th").agg(F.count("*").alias("copies"))
    return found.dropDuplicates(["th"]).join(copies, "th").select(
        "th", "copies", "text", F.array_distinct(fine).alias("fine"), F.array_distinct(kinds).alias("kinds"),
        F.array_remove(F.array_distinct(F.split(F.lower(bare), NO_WORD)), "").alias("terms"))


def grouped(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``entity_texts`` as (th, copies, groups, terms), and (g, d_e, s_e): the
    documents and texts of each entity, pool and kind.  Groups of a single
    text are left out, no term can be told from the others there."""
    pairs = texts.select("th", "copies", F.explode("fine").alias("g"))
    sums = (F.sum("copies").alias("d_e"), F.count("*").alias("s_e"))
    fine = stored(pairs.groupBy("g").agg(*sums).filter("s_e > 1"), "pii-groups")
    kinds = texts.select("copies", F.explode("kinds").alias("g")).groupBy("g").agg(*sums)
    some = pairs.join(checked_broadcast(fine.select("g")), "g").groupBy("th").agg(F.collect_list("g").alias("more"))
    rows = texts.join(some, "th", "left").select("th", "copies", "terms", F.concat(
        "kinds", F.coalesce("more", F.array().cast("array<string>"))).alias("groups"))
    return stored(rows, "pii-grouped"), fine.union(kinds)


def disclosing(docs: DataFrame, rows: DataFrame, groups: DataFrame,
               threshold: float = THRESHOLD, support: int = SUPPORT) -> DataFrame:
    """(g, term, disclosure) over the threshold, from ``grouped`` rows.
    Counts cover all documents."""
    n = docs.count()
    together = rows.select("groups", "copies", F.explode("terms").alias("term")).select(
        "term", "copies", F.explode("groups").alias("g")).groupBy("g", "term").agg(
        F.sum("copies").alias("d_te"), F.count("*").alias("s_te")).filter("s_te > 1")
    together = together.join(groups.filter(F.col("d_e") < n), "g")
    own = F.col("g").startswith("one:")
    enough = F.when(own, F.col("s_te") >= F.least(F.lit(support), F.col("s_e"))).otherwise(
        (F.col("s_te") >= support) & (F.col("s_te") * F.log(n / F.col("d_e")) >= -math.log(CHANCE)))
    # the threshold as a bound on d_t, which is at least the documents that have the term beside any entity
    least = rows.select("copies", F.explode("terms").alias("term")).groupBy("term").agg(F.sum("copies").alias("least"))
    together = stored(together.filter(enough).withColumn(
        "most", F.col("d_te") * F.pow(n / F.col("d_e"), F.lit(1 - threshold))).join(least, "term").filter(
        F.col("least") <= F.col("most") + 0.5).drop("least", "most"), "pii-together")
    d_t = docs.select(F.explode(F.array_distinct(F.split(F.lower(F.coalesce("text", F.lit(""))), NO_WORD))).alias("term")).groupBy(
        "term").agg(F.count("*").alias("d_t"))
    scored = together.join(d_t, "term").withColumn(
        "disclosure", F.log(n * F.col("d_te") / (F.col("d_t") * F.col("d_e"))) / F.log(n / F.col("d_e")))
    return scored.filter(F.col("disclosure") >= threshold).select("g", "term", "disclosure")


def _standing(text, terms):
    """Spans of all places in ``text`` where a word of ``terms`` stands."""
    return F.filter(_placed(text, WORD, "term", F.lower), lambda s: F.array_contains(terms, s["value"]))


def term_spans(docs: DataFrame, found: DataFrame, threshold: float = THRESHOLD, support: int = SUPPORT) -> DataFrame:
    """(th, terms): the added spans of each text that has some.  ``found``
    holds the rows with entities: (th, text, spans)."""
    texts = stored(entity_texts(found), "pii-texts")
    rows, groups = grouped(texts)
    strong = stored(disclosing(docs, rows, groups, threshold, support), "pii-strong")
    words = rows.select("th", "groups", F.explode("terms").alias("term")).join(
        checked_broadcast(strong.select("term").distinct()), "term", "left_semi")
    hits = words.select("th", "term", F.explode("groups").alias("g")).join(
        checked_broadcast(strong.select("g", "term")), ["g", "term"], "left_semi").groupBy("th").agg(F.collect_set("term").alias("words"))
    return texts.join(hits, "th").select("th", _standing(F.col("text"), F.col("words")).alias("terms"))


def listed(spans):
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))))


def personal_data(docs: DataFrame, threshold: float = THRESHOLD, support: int = SUPPORT) -> DataFrame:
    """(doc_id, th, spans, terms) for every row of ``docs``; ``spans`` are the
    fixed patterns', ``terms`` the added ones, both empty arrays for null,
    empty and clean texts.  Copies count as documents, as evidence once.
    Repeated rows keep a row each; a very long text is located in one row, in
    time linear in its matches; terms exactly at the threshold count; an empty
    table gives no rows; further columns of ``docs`` are not carried."""
    slim = stored(with_spans(docs).select(
        "doc_id", "th", "spans", F.when(F.size("spans") > 0, F.col("text")).alias("text")), "pii-spans")
    terms = stored(term_spans(docs, slim.filter(F.size("spans") > 0).select("th", "text", "spans"), threshold, support), "pii-terms")
    none = F.array().cast(f"array<{SPAN}>")
    apart = F.filter("terms", lambda t: ~F.exists("spans", lambda s: (s["start"] < t["stop"]) & (t["start"] < s["stop"])))
    return slim.join(checked_broadcast(terms), "th", "left").select("doc_id", "th", "spans", F.coalesce(apart, none).alias("terms"))


def digest(found: DataFrame) -> DataFrame:
    """The columns of the query from ``personal_data`` rows."""
    return found.select(
        "doc_id", *[F.size(F.filter("spans", _is(k))).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(listed(F.col("spans")), 256).alias("base_sha256"), listed(F.concat("spans", "terms")).alias("spans"),
        F.size("terms").cast("long").alias("n_term"))


MASKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}


def sanitised(docs: DataFrame, threshold: float = THRESHOLD, support: int = SUPPORT) -> DataFrame:
    """``docs`` with every span of the text replaced: entities by their kind,
    disclosing numbers by ``#`` for each digit, other disclosing words
    removed.  Overlapping spans merge into the earliest.  Texts without spans
    are returned as they are; all columns and rows stay."""
    none = F.array().cast(f"array<{SPAN}>")
    found = personal_data(docs, threshold, support).filter(F.size("terms") > 0)
    keyed, names = with_row_keys(docs)
    terms, every = unused(docs, "_terms"), unused(docs, "_spans")
    found = stored(found.select(
        F.xxhash64("doc_id").alias(names[0]), F.col("th").alias(names[1]), F.col("terms").alias(terms)).dropDuplicates(names), "pii-found")
    rows = keyed.join(checked_broadcast(found), names, "left").withColumn(
        every, F.concat(F.when(F.col("text").isNull(), none).otherwise(base_spans(F.col("text"))), F.coalesce(terms, none)))
    ordered = F.sort_array(F.transform(every, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"))))

    def step(acc, s):
        mask = F.lit("")
        for kind, m in MASKS.items():
            mask = F.when(s["kind"] == kind, F.lit(m)).otherwise(mask)
        value = F.substring(docs["text"], s["start"] + 1, s["stop"] - s["start"])
        mask = F.when((s["kind"] == "term") & value.rlike("^[0-9]+$"), F.regexp_replace(value, "[0-9]", "#")).otherwise(mask)
        before = F.substring(docs["text"], acc["at"] + 1, F.greatest(F.lit(0), s["start"] - acc["at"]))
        return F.when(s["stop"] <= acc["at"], acc).otherwise(F.struct(
            s["stop"].alias("at"),
            F.concat(acc["out"], F.array(F.concat(before, F.when(s["start"] >= acc["at"], mask).otherwise(F.lit(""))))).alias("out")))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    done = F.aggregate(ordered, start, step)
    clean = F.concat(F.array_join(done["out"], ""), F.substring(docs["text"], done["at"] + 1, F.length(docs["text"])))
    return rows.withColumn("text", F.when(F.size(every) == 0, F.col("text")).otherwise(clean)).select(*docs.columns)
