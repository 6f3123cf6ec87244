import hashlib
import re

from featurelake.llm import pii
from tests.llm.conftest import make_docs, pairs_of, prose
import random

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def valid(kind, v):
    d = re.sub("[^0-9]", "", v)
    return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in v.split(".")),
            "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]


def spans(t):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in BASE.items() for m in re.finditer(p, t or "") if valid(k, m[0])]


HARD = [
    "a@b.com_x@y.org", "@@a@b", "x@y.z.w-1.q.", "..a..@b.c d@e.f@g.h", "%+-@a.b", "é日@b.cc 😀 me@日.de you@b.de",
    "1.2.3.4.5.6.7.8", "300.1.1.1 1.2.3.004", "0000001.2.3.4", "1.2.3", "12345678901234567890.1.1.1", "01.02.3.255",
    "4111 1111 1111 1111", "4111-1111-1111-1112", "4111  1111 1111 1111", "4111111111111111 4111111111111111", "4" * 6000, "1 " * 5000,
    "+1 (386) 555-3733", "+1 2", "+12345678901234567890", "++1 386 555 3733.", "+1 ) ( 386-555 3733) x", "a" * 50000 + "@", "+1" + " " * 3000 + "2",
]


def test_base_spans_match_python(spark):
    rng = random.Random(3)
    made = ["".join(rng.choice("a@.-+%_ 0123456789()é") for _ in range(rng.randint(0, 60))) for _ in range(400)]
    pairs = list(enumerate([*HARD, *made, None, ""]))
    got = {r["doc_id"]: r for r in pii.digest(pii.personal_data(make_docs(spark, pairs))).collect()}
    for i, t in pairs:
        s = spans(t)
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(s).encode()).hexdigest(), t[:80]
        assert got[i]["spans"].startswith(",".join(s))
        assert [got[i][f"n_{k}"] for k in BASE] == [sum(x.startswith(k) for x in s) for k in BASE]


def test_positions_in_long_texts_full_of_matches(spark):
    texts = [" ".join(f"é{i % 97} 1.2.3.{i % 256}" for i in range(n)) for n in (255, 256, 257, 512, 513, 60_000)]
    got = {r["doc_id"]: r for r in pii.digest(pii.personal_data(make_docs(spark, list(enumerate(texts))))).collect()}
    for i, t in enumerate(texts):
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(spans(t)).encode()).hexdigest()


def test_terms_that_give_an_entity_away(spark):
    rng = random.Random(4)
    pairs = [(i, f"{prose(rng, 20)} Zorblatt writes from joe.{i % 2}@mail.example and the rest {prose(rng, 20)}") for i in range(12)]
    pairs += [(100 + i, f"{prose(rng, 20)} and the rest writes from {prose(rng, 9)}") for i in range(40)]
    docs = make_docs(spark, pairs)
    text = dict(pairs)
    found = {r["doc_id"]: r["terms"] for r in pii.personal_data(docs, threshold=0.5).collect()}
    assert all(any(s["value"] == "zorblatt" for s in found[i]) for i in range(12))
    assert not any(found[100 + i] for i in range(40))
    assert all(text[i][s["start"]:s["stop"]].lower() == s["value"] for i in range(12) for s in found[i])
    assert not any(s["value"] == "writes" for i in range(12) for s in found[i])
    clean = {r["doc_id"]: r["text"] for r in pii.sanitised(docs, threshold=0.5).collect()}
    assert all("Zorblatt" not in clean[i] and "[EMAIL]" in clean[i] and "joe." not in clean[i] for i in range(12))
    assert all(clean[100 + i] == text[100 + i] for i in range(40))


def test_terms_far_from_entities_that_few_documents_hold(spark):
    """Each address is in one document or two, the words stand far from it."""
    rng = random.Random(9)
    pairs = [(i, f"Zorblatt {prose(rng, 40)} mail u{i}@corp.example {prose(rng, 5)}") for i in range(8)]
    pairs += [(50 + i, f"{prose(rng, 30)} mail two@other.example {prose(rng, 30)} Quibbex7") for i in range(2)]
    pairs += [(60 + i, f"Lonely mail once@third.example {pairs[0][1][8:40]}") for i in range(1)] * 6   # copies are no evidence
    pairs += [(100 + i, f"{prose(rng, 40)} mail") for i in range(200)]
    docs, text = make_docs(spark, pairs), dict(pairs)
    found = {r["doc_id"]: r["terms"] for r in pii.personal_data(docs).collect()}
    values = {i: {s["value"] for s in t} for i, t in found.items()}
    assert all("zorblatt" in values[i] for i in range(8)) and all("quibbex7" in values[50 + i] for i in range(2))
    assert "lonely" not in values[60] and not any("mail" in v for v in values.values())
    assert not any(values[100 + i] for i in range(200))
    assert all(text[i][s["start"]:s["stop"]].lower() == s["value"] for i in found for s in found[i])
    clean = {r["doc_id"]: r["text"] for r in pii.sanitised(docs).collect()}
    assert not any("Zorblatt" in clean[i] for i in range(8)) and "Quibbex7" not in clean[50] + clean[51]


def test_rows_columns_and_empty(corpus, no_docs):
    out = pii.sanitised(corpus)
    assert out.columns == corpus.columns and sorted(map(str, pairs_of(out))) == sorted(map(str, pairs_of(corpus)))
    assert pii.sanitised(no_docs).count() == 0 and pii.digest(pii.personal_data(no_docs)).count() == 0
