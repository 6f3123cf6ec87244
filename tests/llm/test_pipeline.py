"""The pipeline's rows against a plain-Python version of its five stages."""
import math
import re
from collections import Counter, defaultdict

import pytest
import sentencepiece
import zlib
from pyspark.sql import functions as F

import corpus_pipeline
from featurelake.llm import pieces, pii, toxicity
from featurelake.llm.common import table
from tests.llm.test_pii import BASE, valid

SF = "/root/testdata/sf0.001"
LIB = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The smallest tables with rows that are null, blank, copied, repeated or
    very long."""
    out = str(tmp_path_factory.mktemp("sf"))
    docs = table(spark, SF, "documents")
    rows = docs.orderBy("doc_id").limit(12).collect()
    kind = docs.schema
    more = [rows[0].asDict() | {"doc_id": 900_001}, rows[1].asDict(), rows[1].asDict(), rows[2].asDict() | {"doc_id": 900_002, "text": None},
            rows[2].asDict() | {"doc_id": 900_003, "text": " \t\n"}, rows[2].asDict() | {"doc_id": 900_004, "text": ""},
            rows[3].asDict() | {"doc_id": 900_005, "text": " ".join(f"{w}{i % 997}" for i, w in enumerate((rows[3]["text"] or "x y z").split() * 60))},
            rows[4].asDict() | {"doc_id": None, "text": "no id but words of its own, and them only here"}]
    more += [rows[5].asDict() | {"doc_id": 900_100 + i, "text": f"Zorblatt number {i} {chr(97 + i) * 9} sends mail{i}@corp.example item{i} word{i * i}"} for i in range(9)]
    docs.union(spark.createDataFrame([[r[f.name] for f in kind] for r in more], kind)).coalesce(3).write.parquet(f"{out}/documents.parquet")
    for name in ("labels", "benchmark"):
        table(spark, SF, name).write.parquet(f"{out}/{name}.parquet")
    return out


def toxic(docs, labels):
    label = {}
    for r in labels:
        if r["doc_id"] is not None and r["toxic"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5:
            label[r["doc_id"]] = max(r["toxic"], label.get(r["doc_id"], 0))
    by_text = {}
    for i, t in docs:
        if i in label and t is not None:
            e, y = by_text.get(t, (i, 0))
            by_text[t] = min(e, i), max(y, label[i])
    every = [Counter(x for w in re.findall(r"\w+", (t or "").lower()) for x in toxicity.terms_of(w)) for _, t in docs]
    own = {t: Counter(x for w in re.findall(r"\w+", t.lower()) for x in toxicity.terms_of(w)) for t in by_text}
    pos, neg, z = Counter(), Counter(), 2.576
    for t, (_, y) in by_text.items():
        (pos if y else neg).update(set(own[t]))

    def low(x):
        n = pos[x] + neg[x]
        s = pos[x] / n
        return (s + z * z / (2 * n) - z * math.sqrt(s * (1 - s) / n + z * z / (4 * n * n))) / (1 + z * z / n)

    terms = {x for x in pos if pos[x] >= toxicity.MIN_TOXIC and low(x) >= toxicity.MIN_SHARE}
    df = Counter(x for c in every for x in set(c) & terms)

    def vector(c):
        v = {x: (1 + math.log(n)) * (math.log((1 + len(docs)) / (1 + df[x])) + 1) for x, n in c.items() if x in terms}
        norm = math.sqrt(sum(w * w for w in v.values()))
        return {x: w / norm for x, w in v.items()}

    examples = [(e, y, vector(own[t])) for t, (e, y) in by_text.items()]
    rate = sum(y for _, y, _ in examples) / max(1, len(examples))
    plain = [y for _, y, v in examples if not v]
    out = []
    for c in every:
        v = vector(c)
        near = sorted((-round(sum(w * u[x] for x, w in v.items() if x in u), 9), e, y) for e, y, u in examples if set(u) & set(v))[:toxicity.K]
        if near:
            w = [1 / (0.05 + max(0.0, 1 + s)) for s, _, _ in near]
            vote = (sum(a * y for a, (_, _, y) in zip(w, near)) + rate / 1.05) / (sum(w) + 1 / 1.05)
        else:
            vote = (sum(plain) + rate) / (len(plain) + 1)
        out.append(vote >= 0.5)
    return out


def near_copies(docs, k=5, percent=80):
    """Indices that stay: the smallest id of each component, all blank texts."""
    sets = []
    for _, t in docs:
        ws = [w for w in re.split(r"[\x20\x09-\x0D]+", (t or "").translate(LOWER)) if w]
        sets.append({tuple(ws[i:i + k]) for i in range(max(1, len(ws) - k + 1))} if ws else set())
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        common = Counter(j for g in s for j in holders[g])
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                root[find(i)] = find(j)
        for g in s:
            holders[g].append(i)
    groups = defaultdict(list)
    for i, s in enumerate(sets):
        groups[find(i) if s else -1 - i].append(i)
    return sorted(min(g, key=lambda i: (docs[i][0] is None, docs[i][0] or 0)) for g in groups.values())


def contaminated(text, items):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return any(tuple(words[i:i + n]) in wins for n, wins in items.items() for i in range(len(words) - n + 1))


def windows(texts):
    out = defaultdict(set)
    for t in texts:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
        for i in range(max(1, len(words) - 9) if words else 0):
            out[min(10, len(words))].add(tuple(words[i:i + 10]))
    return out


def sanitised(docs):
    def words_of(t):
        return {w for w in re.split(pii.NO_WORD, t.lower()) if w}

    def groups_of(kind, v):
        d = re.sub("[^0-9]", "", v)
        pool = v.rsplit("@", 1)[1].lower() if kind == "email" else ".".join(v.split(".")[:3]) if kind == "ip" else d[:6]
        return {f"one:{kind}:{v}", f"pool:{kind}:{pool}", f"kind:{kind}"}

    base = [[(m.start(), m.end(), k, m[0]) for k, p in BASE.items() for m in re.finditer(p, t or "") if valid(k, m[0])] for _, t in docs]
    copies = Counter(t for (_, t), s in zip(docs, base) if s)
    held = {t: (set().union(*(groups_of(k, v) for _, _, k, v in s))) for (_, t), s in zip(docs, base) if s}
    terms = {}
    for (_, t), s in zip(docs, base):
        if s:
            bare = t
            for v in dict.fromkeys(v for _, _, _, v in s):
                bare = bare.replace(v, " ")
            terms[t] = words_of(bare)
    n, d_t = len(docs), Counter(w for _, t in docs for w in words_of(t or ""))
    d_e, s_e, d_te, s_te = Counter(), Counter(), Counter(), Counter()
    for t, gs in held.items():
        for g in gs:
            d_e[g] += copies[t]
            s_e[g] += 1
            for w in terms[t]:
                d_te[g, w] += copies[t]
                s_te[g, w] += 1
    strong = set()
    for (g, w), d in d_te.items():
        s = s_te[g, w]
        if s < 2 or d_e[g] >= n:
            continue
        enough = s >= min(pii.SUPPORT, s_e[g]) if g.startswith("one:") else s >= pii.SUPPORT and s * math.log(n / d_e[g]) >= -math.log(pii.CHANCE)
        if enough and math.log(n * d / (d_t[w] * d_e[g])) / math.log(n / d_e[g]) >= pii.THRESHOLD:
            strong.add((g, w))
    out = []
    for (i, t), s in zip(docs, base):
        spans = [(a, b, k) for a, b, k, _ in s]
        if s:
            bad = {w for g in held[t] for w in terms[t] if (g, w) in strong}
            spans += [(m.start(), m.end(), "term") for m in re.finditer(pii.WORD, t) if m[0].lower() in bad
                      and not any(a < m.end() and m.start() < b for a, b, _, _ in s)]
        at, done = 0, []
        for a, b, k in sorted(spans):
            if b > at:
                done.append(t[at:a] if a > at else "")
                if a >= at:
                    done.append(re.sub("[0-9]", "#", t[a:b]) if k == "term" and re.fullmatch("[0-9]+", t[a:b]) else pii.MASKS.get(k, ""))
                at = b
        out.append((i, t if not spans else "".join(done) + t[at:]))
    return out


def test_rows_equal_the_plain_version(spark, folder):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, folder, "documents").select("doc_id", "text").collect()]
    kept = [d for d, bad in zip(docs, toxic(docs, table(spark, folder, "labels").collect())) if not bad]
    kept = [kept[i] for i in near_copies(kept)]
    items = windows(r["text"] for r in table(spark, folder, "benchmark").collect())
    kept = [d for d in kept if not contaminated(d[1], items)]
    clean = sanitised(kept)
    want = sorted(((i, LIB.encode(t or "")) for i, t in clean), key=str)
    got = corpus_pipeline.run(spark, folder).collect()
    assert sorted(((r["doc_id"], r["ids"]) for r in got), key=str) == want
    assert all(r["n_tokens"] == len(r["ids"]) and r["round_trip"] for r in got)
    assert 0 < len(kept) < len(docs) and sum(a != b for a, b in zip(kept, clean)) >= 9
    assert not any(t and "Zorblatt" in t for _, t in clean)


def test_stages_keep_the_columns_and_filter(spark):
    docs = table(spark, SF, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard", "decontamination", "pii", "sentencepiece"]
    ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        kept = {r["doc_id"] for r in out.select("doc_id").collect()}
        assert kept <= ids and (name != "pii" or kept == ids)


def test_stages_take_empty_documents(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
