import hashlib
import math
import random
import re

from featurelake.llm import secrets
from tests.llm.conftest import make_docs

ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"""
                    r"""[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base(t):
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(out)]


def test_base_spans_match_python(spark, corpus):
    rng = random.Random(0)
    bits = ["password", "PassWd", "api_key", "APIKEY", "token", "secret", "=", ": ", '"', "'", " ", "AKIA", "ABCD1234EFGH5678", "0a1b2c3d4e5f",
            "deadbeefcafe", "é", "x", "-", "_", "\n", "Zz9+/"]
    pairs = list(enumerate("".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(500)))
    pairs += [(1000, None), (1001, ""), (1002, "f" * 40000), (1003, "ſecret=abcdefg")]
    got = {r["doc_id"]: r for r in secrets.scan(make_docs(spark, pairs)).collect()}
    for i, t in pairs:
        want = base(t or "")
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), t
        assert [s for s in got[i]["spans"].split(",") if s and not s.startswith("entropy")] == want
        assert got[i]["n_assign"] + got[i]["n_access"] + got[i]["n_hex"] == len(want)
    assert secrets.scan(corpus).count() == corpus.count()


def test_windows_match_direct_entropy():
    rng = random.Random(1)
    for kind, (members, width, least) in secrets.CLASSES.items():
        for _ in range(60):
            t = "".join(rng.choice("0123456789abcdefABCXYZ+!") for _ in range(rng.randint(0, 90)))
            marked = set()
            for s in range(len(t) - width + 1):
                w = t[s:s + width]
                if all(c in members for c in w):
                    h = -sum(w.count(c) / width * math.log2(w.count(c) / width) for c in set(w))
                    if h >= least - 1e-9 / width:
                        marked |= set(range(s, s + width))
            assert {p for a, b in secrets.windows(t, kind) for p in range(a, b)} == marked


def test_entropy_and_allow_list():
    allow = [re.compile(p) for p in secrets.ALLOW]
    key = "q9Xv2LmZ8RtY4KpWc7Nd"
    assert secrets.scan_text(f"see {key} there", allow)[1] == [(4, 24, "entropy")]
    for t in ("123e4567-e89b-12d3-a456-426614174000", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789abc", "thisIsAnEXAMPLEkey0q9Xv2LmZ8RtY",
              "internationalisationofcommunication", "some-long-path/of/ordinary-words"):
        assert secrets.scan_text(t, allow)[1] == [], t


def test_tokens_of_one_case_and_allowed_strings_far_away():
    allow = [re.compile(p) for p in secrets.ALLOW]
    rng = random.Random(2)
    for letters in ("abcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"):
        keys = ["".join(rng.choice(letters) for _ in range(40)) for _ in range(200)]
        assert sum(bool(secrets.scan_text(f"see {k} there", allow)[1]) for k in keys) >= 198
    key = "q9Xv2LmZ8RtY4KpWc7Nd"
    text = f"sample/{'directory/' * 5}{key}"
    assert any(a <= text.index(key) and b == len(text) for a, b, _ in secrets.scan_text(text, allow)[1])
    assert secrets.scan_text(f"sample/{key[:16]}", allow)[1] == []
    assert secrets.scan_text("internationalisationofcommunication2", allow)[1] == []


def test_empty_table(no_docs):
    assert secrets.scan(no_docs).count() == 0
