import base64
import random

import numpy as np
import public_tokenizers
import tiktoken

from featurelake.llm import byte_bpe
from tests.llm.conftest import make_docs, pairs_of

FILE, PATTERN = byte_bpe.vocabulary()
with open(FILE, "rb") as f:
    RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
LIB = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def test_ids_equal_the_library_and_decode_to_the_text(corpus):
    got = byte_bpe.decode(byte_bpe.encode(corpus)).collect()
    want = [(d, LIB.encode_ordinary(t or ""), (t or "").encode()) for d, t in pairs_of(corpus)]
    assert sorted(((r["doc_id"], r["ids"], bytes(r["decoded"])) for r in got), key=str) == sorted(want, key=str)


def test_hard_texts(spark):
    rng = random.Random(3)
    parts = ["the", "represent", "'ll", "'S", " ", "  ", "\n", "\t ", "é", "日本", "😀", " ", "　", "12", "³", "==", "-", "://", "\x00", "ß",
             "\x1c", "á", "<|endoftext|>"]
    pairs = list(enumerate("".join(rng.choice(parts) for _ in range(rng.randint(1, 60))) for _ in range(200)))
    rows = byte_bpe.decode(byte_bpe.encode(make_docs(spark, pairs))).collect()
    got = {r["doc_id"]: (r["ids"], bytes(r["decoded"]).decode()) for r in rows}
    assert all(got[i] == (LIB.encode_ordinary(t), t) for i, t in pairs)


def test_one_very_long_piece():
    rng = random.Random(4)
    for piece in ("x" * 30_000, "".join(rng.choice("abcdeé") for _ in range(20_000)), "日本" * 5000):
        assert byte_bpe.merged(piece.encode(), RANKS) == LIB.encode_ordinary(piece)


def test_least_key_after_point_updates():
    rng = random.Random(5)
    for n in (1, 2, 3, 7, 64, 65):
        keys = [rng.randrange(50) * n + i for i in range(n)]
        tree = byte_bpe.MinTree(list(keys))
        for _ in range(200):
            assert tree.least() == min(keys)
            at = rng.randrange(n)
            keys[at] = rng.choice([byte_bpe.NONE, rng.randrange(50) * n + at])
            tree.put(at, keys[at])


def test_columns_merge_like_the_tree():
    rng = random.Random(6)
    columns = byte_bpe.Columns(RANKS)
    for size in (2, 4, 8, 16, 64):
        pieces = ["".join(rng.choice(["the", "ing", "a", "s", "é", "日", "x", " ", "0"]) for _ in range(30)).encode()[:rng.randint(1, size)] for _ in range(300)]
        own = [p for p in pieces if p not in RANKS]
        assert columns.merge(own, size) == [np.array(byte_bpe.merged(p, RANKS), np.int32).tobytes() for p in own]


def test_memory_of_pieces_is_bounded(monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 40)
    monkeypatch.setattr(byte_bpe, "LONG", 64)
    own = byte_bpe.Codec(FILE, PATTERN)
    rng = random.Random(8)
    for _ in range(20):
        texts = [" ".join(rng.choice(["", "word", "zz" * 60, "é"]) + str(rng.randrange(99)) for _ in range(rng.randint(0, 9))) for _ in range(5)] + [""]
        ids, ends = own.encode(texts)
        assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [LIB.encode_ordinary(t) for t in texts]
        assert len(own.known) <= 40 and all(len(p) <= byte_bpe.LONGEST for p in own.known)


def test_null_ids_decode_to_null(spark):
    rows = spark.createDataFrame([(1, 2, None), (2, 2, []), (None, 3, LIB.encode_ordinary("né e")), (4, 4, None)], "doc_id long, th long, ids array<int>")
    got = {r["doc_id"]: r["decoded"] for r in byte_bpe.decode(rows).collect()}
    assert got[1] is None and got[4] is None and bytes(got[2]) == b"" and bytes(got[None]) == "né e".encode()


def test_empty_table(no_docs):
    assert byte_bpe.decode(byte_bpe.encode(no_docs)).count() == 0
