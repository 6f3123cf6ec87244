"""Secret scan: fixed patterns, and high-entropy windows of candidate strings.

Candidates are the maximal runs of the characters that keys are written in.
Over each candidate a window slides, per character class, with its Shannon
entropy kept up to date from the counts: one character enters, one leaves,
and only their two terms of the sum change.  Windows above the threshold of
their class merge into a span of kind ``entropy``.  What the allow-list knows is
left out with its near surroundings.  Spans of the fixed patterns always stay.
"""

from __future__ import annotations

import hashlib
import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurelake.llm.common import map_rows

# fixed values: the three base patterns
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex")
LEAST = {"assign": 6, "access": 20, "hex": 24}

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: Characters, window and least entropy (bits a character) per class.  A
#: window of random hex digits has about 3.4 bits, of random base-64 digits
#: 4.2, of base-32 or base-36 digits 3.8; words of a language stay under 3.3.
CLASSES = {
    "hex": (frozenset("0123456789abcdef"), 20, 3.0),
    "HEX": (frozenset("0123456789ABCDEF"), 20, 3.0),
    "base64": (frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"), 20, 3.8),
    "base36": (frozenset("abcdefghijklmnopqrstuvwxyz0123456789"), 20, 3.5),
    "BASE36": (frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), 20, 3.5),
}
NEAR = 16               # characters beside an allowed string that are left out with it
#: Strings that look random and are known not to be secret.
ALLOW = (
    r"(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$",       # UUID
    r"(?i)abcdefghijklmnop|0123456789abcdef",                  # alphabets
    r"(?i)example|sample|placeholder|dummy|x{6,}",             # placeholders
    r"^[A-Za-z]+([-_/][A-Za-z]+)+$",                           # words joined by marks
    r"^[0-9+/_=-]+$",                                          # numbers and rules
)


def _terms(n: int) -> list[float]:
    return [c * math.log2(c) if c else 0.0 for c in range(n + 1)]


_PART = {name: _terms(w) for name, (_, w, _) in CLASSES.items()}


def windows(text: str, kind: str) -> list[tuple[int, int]]:
    """Merged [start, stop) of the windows over the threshold of a class."""
    members, width, least = CLASSES[kind]
    part = _PART[kind]
    # entropy = log2(width) - sum(c log2 c) / width
    most = (math.log2(width) - least) * width + 1e-9
    out: list[tuple[int, int]] = []
    counts: dict[str, int] = {}
    run, total = 0, 0.0
    for at, ch in enumerate(text):
        if ch not in members:
            counts, run, total = {}, 0, 0.0
            continue
        if run == width:
            gone = text[at - width]
            c = counts[gone]
            total += part[c - 1] - part[c]
            counts[gone] = c - 1
        else:
            run += 1
        c = counts.get(ch, 0)
        total += part[c + 1] - part[c]
        counts[ch] = c + 1
        if run == width and total <= most:
            start = at - width + 1
            if out and start <= out[-1][1]:
                out[-1] = out[-1][0], at + 1
            else:
                out.append((start, at + 1))
    return out


def entropy_spans(text: str, start: int, stop: int, allow: list[re.Pattern]) -> list[tuple[int, int]]:
    """Spans inside one candidate, outside of what the allow-list knows there."""
    string = text[start:stop]
    known = sorted((m.start() - NEAR, m.end() + NEAR) for p in allow for m in p.finditer(string))
    out, at = [], 0
    for a, b in [*known, (len(string), len(string))]:
        out += _piece_spans(string[at:max(at, a)], start + at)
        at = max(at, b)
    return out


def _piece_spans(string: str, start: int) -> list[tuple[int, int]]:
    """Base-64 windows need a digit and letters of both cases, windows of one
    case a digit in twenty characters and two at least, so that long words do not."""
    found = [*windows(string, "hex"), *windows(string, "HEX")]
    found += [(a, b) for a, b in windows(string, "base64")
              if any(c.isdigit() for c in string[a:b]) and any(c.islower() for c in string[a:b]) and any(c.isupper() for c in string[a:b])]
    for kind in ("base36", "BASE36"):
        found += [(a, b) for a, b in windows(string, kind)
                  if max(2, (b - a) / 20) <= sum(c.isdigit() for c in string[a:b]) < b - a]
    merged: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if merged and a <= merged[-1][1]:
            merged[-1] = merged[-1][0], max(b, merged[-1][1])
        else:
            merged.append((a, b))
    return [(start + a, start + b) for a, b in merged]


def base_spans(text: str, candidates: list[re.Match]) -> list[tuple[int, int, str]]:
    """(start, stop, kind), by start, then kind as listed."""
    out = []
    lower = text.lower()
    if any(h in lower for h in _HINTS):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    for c in candidates:  # a run of 24 hex digits lies inside a candidate
        out += [(c.start() + m.start(), c.start() + m.end(), "hex") for m in HEX.finditer(c[0]) if len(m[0]) >= LEAST["hex"]]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def scan_text(text: str | None, allow: list[re.Pattern]) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Base and added spans of one text."""
    if not text:
        return [], []
    candidates = list(CANDIDATE.finditer(text))
    return base_spans(text, candidates), [(a, b, "entropy") for c in candidates for a, b in entropy_spans(text, c.start(), c.end(), allow)]


def _listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def scan(docs: DataFrame, allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """(doc_id, th, n_assign, n_access, n_hex, n_entropy, base_sha256, spans)
    for every row of ``docs``; positions are code points, stops exclusive.
    ``spans`` holds all spans by start, then kind as listed, the added kind
    last.  Null and empty texts have none; repeated rows keep a row each.
    A very long text is scanned whole, in time linear in it; an empty table
    gives no rows; further columns of ``docs`` are not carried.
    """
    def run(rows):
        known = [re.compile(p) for p in allow]
        for doc_id, th, text in rows:
            base, more = scan_text(text, known)
            kinds = [s[2] for s in base]
            every = sorted(base + more, key=lambda s: (s[0], (*KINDS, "entropy").index(s[2])))
            yield (doc_id, th, *(kinds.count(k) for k in KINDS), len(more),
                   hashlib.sha256(_listed(base).encode()).hexdigest(), _listed(every))

    texts = docs.select("doc_id", F.xxhash64("text").alias("th"), "text")
    return map_rows(texts, run, "doc_id long, th long, n_assign long, n_access long, n_hex long, n_entropy long, "
                                "base_sha256 string, spans string")
