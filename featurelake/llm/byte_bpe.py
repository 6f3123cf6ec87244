"""Byte-level BPE encoding and decoding with a segment tree per piece.

A pattern splits a text into pieces, which are encoded one by one.  A piece
that is a token of its own is that token.  Any other starts as its bytes; a
segment tree over the byte positions holds, for each live position, the rank
of the pair that starts there, and its root names the leftmost pair of least
rank.  A merge removes one position from the list of live ones and changes
three leaves, each in logarithmic time, so a piece of n bytes takes
n log n steps however long it is.

Pieces recur: their ids are remembered, in bounded memory.  Short pieces that
a slice of rows brings for the first time are merged side by side, one merge
of each at a time, with their trees as columns of one array.
"""

from __future__ import annotations

import base64
import sys
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurelake.llm.common import IN_ROWS

RANKS = "byte_bpe_multi_50k.tiktoken"
#: No pair starts here.  Keys are rank * positions + position, far below.
NONE = 1 << 62
#: Pieces remembered by a task, bytes of the longest that are, and pieces merged side by side.
REMEMBERED, LONGEST, SIDE = 400_000, 64, 4096
#: Characters of a text that is worked on in parts.
LONG = 1 << 20


class MinTree:
    """Segment tree over positions: the least key, under point updates."""

    def __init__(self, keys: list[int]):
        self.size = 1 << max(0, len(keys) - 1).bit_length()
        self.nodes = nodes = [NONE] * self.size + keys + [NONE] * (self.size - len(keys))
        for i in range(self.size - 1, 0, -1):
            a, b = nodes[2 * i], nodes[2 * i + 1]
            nodes[i] = a if a < b else b

    def least(self) -> int:
        return self.nodes[1]

    def put(self, position: int, key: int) -> None:
        nodes, i = self.nodes, position + self.size
        nodes[i] = key
        while i > 1:
            i >>= 1
            a, b = nodes[2 * i], nodes[2 * i + 1]
            low = a if a < b else b
            if nodes[i] == low:      # nothing changes further up
                return
            nodes[i] = low


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: always the pair of least rank, the leftmost of equals."""
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    after = list(range(1, n + 1))          # start of the next live part; n at the end
    before = list(range(-1, n))            # start of the former live part

    def key(i: int) -> int:
        j = after[i]
        if j >= n:
            return NONE
        rank = ranks.get(piece[i:after[j]])
        return NONE if rank is None else rank * n + i

    tree = MinTree([key(i) for i in range(n)])
    while (low := tree.least()) != NONE:
        i = low % n
        gone = after[i]
        after[i] = after[gone]
        before[after[i]] = i
        tree.put(gone, NONE)
        tree.put(i, key(i))
        if i:
            tree.put(before[i], key(before[i]))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i:after[i]]])
        i = after[i]
    return ids


class Columns:
    """The same merges for many short pieces at once: column c of every array
    belongs to piece c, and a step merges the leftmost pair of least rank in
    each column that still has a pair."""

    def __init__(self, ranks: dict[bytes, int]):
        self.count = 1 + max(ranks.values())
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left * self.count + right] = rank
        self.pairs = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[p] for p in self.pairs.tolist()], np.int64)
        two = np.arange(1 << 16)
        self.byte_pairs = self.rank(self.byte[two >> 8], self.byte[two & 255])

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that two tokens make together, NONE if none."""
        pair = left * self.count + right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pair, self.ranks[at], NONE)

    def merge(self, pieces: list[bytes], size: int) -> list[bytes]:
        """Ids (32-bit, packed) of pieces of at most ``size`` bytes, a power of two."""
        n = np.fromiter(map(len, pieces), np.int64, len(pieces))
        raw = np.frombuffer(b"".join([p.ljust(size, b"\0") for p in pieces]), np.uint8).reshape(-1, size).T.astype(np.int64)
        token = self.byte[raw]
        live = np.arange(size)[:, None] < n
        after = np.repeat(np.arange(1, size + 1)[:, None], len(pieces), axis=1)
        before = np.repeat(np.arange(-1, size)[:, None], len(pieces), axis=1)
        nodes = np.full((2 * size, len(pieces)), NONE, np.int64)
        first = self.byte_pairs[raw[:-1] << 8 | raw[1:]]
        at = np.arange(size - 1)[:, None]
        nodes[size:2 * size - 1] = np.where((at + 1 < n) & (first != NONE), first * size + at, NONE)
        for i in range(size - 1, 0, -1):
            np.minimum(nodes[2 * i], nodes[2 * i + 1], out=nodes[i])

        def put(position, column, key):
            i = position + size
            nodes[i, column] = key
            for _ in range(size.bit_length() - 1):
                i = i >> 1
                nodes[i, column] = np.minimum(nodes[2 * i, column], nodes[2 * i + 1, column])

        def key(position, left, right):
            rank = self.rank(left, right)
            return np.where(rank == NONE, NONE, rank * size + position)

        column = np.flatnonzero(nodes[1] != NONE)
        while len(column):
            rank, i = np.divmod(nodes[1, column], size)
            gone = after[i, column]
            token[i, column], live[gone, column] = rank, False
            then = after[gone, column]
            after[i, column], before[then, column] = then, i
            put(gone, column, NONE)
            more = then < n[column]
            put(i, column, np.where(more, key(i, rank, token[np.minimum(then, size - 1), column]), NONE))
            some = np.flatnonzero(i > 0)
            left = before[i[some], column[some]]
            put(left, column[some], key(left, token[left, column[some]], rank[some]))
            column = column[nodes[1, column] != NONE]
        ids = token.T[live.T].astype(np.int32).tobytes()
        ends = (4 * np.cumsum(live.sum(axis=0))).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]


class Codec:
    """A vocabulary of ranks with the pattern that splits texts."""

    def __init__(self, ranks_file: str, pattern: str):
        import regex

        with open(ranks_file, "rb") as f:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        if any(bytes([b]) not in self.ranks for b in range(256)):
            raise ValueError(f"{ranks_file} lacks single bytes")
        self.pattern = regex.compile(pattern)
        self.columns = Columns(self.ranks)
        self.known: dict[str, bytes] = {}      # packed 32-bit ids
        tokens: list[bytes] = [b""] * self.columns.count
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.size) - self.size

    def pieces(self, texts: list[str]):
        """(row, pieces): lists of pieces, a bounded number at a time."""
        for row, text in enumerate(texts):
            if len(text) < LONG:
                yield row, self.pattern.findall(text)
            else:
                found = self.pattern.finditer(text)
                while part := [m.group() for m in islice(found, LONG // 8)]:
                    yield row, part

    def learn(self, pieces: set[str]) -> dict[str, bytes]:
        """Ids of pieces that are not known yet."""
        out, short = {}, {}
        for piece in pieces:
            raw = piece.encode()
            rank = self.ranks.get(raw)
            if rank is not None:
                out[piece] = rank.to_bytes(4, sys.byteorder)
            elif len(raw) > LONGEST:
                out[piece] = np.array(merged(raw, self.ranks), np.int32).tobytes()
            else:
                names, raws = short.setdefault((len(raw) - 1).bit_length(), ([], []))
                names.append(piece)
                raws.append(raw)
        for bits, (names, raws) in short.items():
            for at in range(0, len(names), SIDE):
                out.update(zip(names[at:at + SIDE], self.columns.merge(raws[at:at + SIDE], 1 << bits)))
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and where each text begins and ends."""
        out, counts = [], np.zeros(len(texts), np.int64)
        held, size = [], 0

        def flush():
            every = set(chain.from_iterable([pieces for _, pieces in held]))
            new = every - self.known.keys()
            if len(self.known) + len(new) > REMEMBERED:
                self.known.clear()
                new = every
            found = self.learn(new)
            long = [p for p in found if len(p) > LONGEST]
            self.known.update(found)
            for row, pieces in held:
                out.append(b"".join(map(self.known.__getitem__, pieces)))
                counts[row] += len(out[-1]) // 4
            for p in long:
                del self.known[p]
            if len(self.known) > REMEMBERED:
                self.known.clear()

        for row, pieces in self.pieces(texts):
            held.append((row, pieces))
            size += len(pieces)
            if size > LONG // 8:
                flush()
                held, size = [], 0
        flush()
        return np.frombuffer(b"".join(out), np.int32), np.concatenate([[0], np.cumsum(counts)])

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids one after another, and where each id's end."""
        size = self.size[ids]
        ends = np.cumsum(size)
        at = np.repeat(self.start[ids] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
        return self.bytes[at], ends


@lru_cache(maxsize=2)
def codec(ranks_file: str, pattern: str) -> Codec:
    return Codec(ranks_file, pattern)


def vocabulary() -> tuple[str, str]:
    """Place of the public rank file and its pattern."""
    import public_tokenizers

    return public_tokenizers.path(RANKS), public_tokenizers.PATTERN


def encode(docs: DataFrame, ranks_file: str | None = None, pattern: str | None = None) -> DataFrame:
    """(doc_id, th, ids) for every row of ``docs`` (doc_id, text, any more
    columns, which are not carried); ``th`` is the hash of the text.

    Null and empty texts have no ids.  Very long texts are worked on whole, a
    piece at a time, by one task; a piece of any length takes n log n steps.
    Rows that repeat keep a row each, null ids stay null, pairs of equal rank
    are merged from the left, an empty table gives an empty one.
    """
    file, split = (ranks_file, pattern) if ranks_file and pattern else vocabulary()
    rows = docs.select("doc_id", F.xxhash64("text").alias("th"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    schema = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches):
        own = codec(file, split)
        for batch in batches:
            for at in range(0, batch.num_rows, IN_ROWS):
                part = batch.slice(at, IN_ROWS)
                ids, ends = own.encode(part.column(2).to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), part.column(1), lists.cast(schema.field(2).type)], schema=schema)

    return rows.mapInArrow(run, "doc_id long, th long, ids array<int>")


def decode(rows: DataFrame, ranks_file: str | None = None, pattern: str | None = None) -> DataFrame:
    """(doc_id, th, ids, decoded) from rows (doc_id, th, ids): the bytes that
    the ids stand for, null for null ids.  An id that the vocabulary lacks is
    an error."""
    file, split = (ranks_file, pattern) if ranks_file and pattern else vocabulary()
    schema = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.binary())])

    def run(batches):
        own = codec(file, split)
        for batch in batches:
            for at in range(0, batch.num_rows, IN_ROWS):
                part = batch.slice(at, IN_ROWS)
                lists = part.column(2)
                raw, ends = own.decode(lists.flatten().to_numpy(zero_copy_only=False))
                last = np.cumsum(np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64))
                stops = np.concatenate([[0], np.concatenate([[0], ends])[last]])
                texts = pa.BinaryArray.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(stops.astype(np.int32)), pa.py_buffer(raw)])
                if lists.null_count:
                    texts = pc.if_else(lists.is_valid(), texts, None)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), lists.cast(schema.field(2).type), texts], schema=schema)

    return rows.select("doc_id", "th", "ids").mapInArrow(run, "doc_id long, th long, ids array<int>, decoded binary")
