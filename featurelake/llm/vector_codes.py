"""Vector codes: product quantisation in integers, entries found by a GNAT.

Components become integers, vectors are cut into parts, and each part has a
codebook that a few rounds of assigning and averaging improve.  The nearest
entry of a part comes from a geometric near-neighbour access tree over its
codebook: a node's split points keep, for each child, the least and greatest
distance between split point and the child's entries.  Once a query's distance
to a split point is known, each child whose range lies beyond the best
distance so far is out with its whole subtree.

Nothing depends on rounding.  Squared distances are integers; their roots are
used only as whole numbers below and above; a subtree goes only if all of it
is strictly further away, so ties always come to the comparison of squared
distances, where the lower index wins.

A round is one pass in which tasks add up parts per entry; only these sums
meet, and only the codebooks (a fixed number of entries) reach the driver.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featurelake.llm.common import checked_broadcast, stored, unused

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
DEGREE = 4                    # split points of a node
ROWS = 4096                   # vectors worked on at a time
LIMB = 1 << 60                # sums travel in limbs of this base
LARGEST = (1 << 63) - 1


def squared(x: np.ndarray, entry: np.ndarray) -> np.ndarray:
    d = x - entry
    return (d * d).sum(axis=1) if x.shape[1] else np.zeros(len(x), np.int64)


def roots(d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers below and above the square roots of integers."""
    if d.dtype == object:
        low = np.array([math.isqrt(int(v)) for v in d], object)
    else:
        low = np.sqrt(d.astype(np.float64)).astype(np.int64)
        low -= low * low > d
        low += (low + 1) * (low + 1) <= d
    return low, low + (low * low < d)


class Gnat:
    """Near-neighbour tree over the rows of ``entries`` (integers)."""

    def __init__(self, entries: np.ndarray, members: np.ndarray | None = None, degree: int = DEGREE):
        self.entries = entries
        members = np.arange(len(entries)) if members is None else members
        # split points: the first, then always the one furthest from those before
        splits = [0]
        reach = squared(entries[members], entries[members[0]])
        while len(splits) < min(degree, len(members)):
            open_ = [i for i in range(len(members)) if i not in splits]
            splits.append(max(open_, key=lambda i: (reach[i], -i)))
            reach = np.minimum(reach, squared(entries[members], entries[members[splits[-1]]]))
        self.splits = members[splits]
        to = np.stack([squared(entries[members], entries[s]) for s in self.splits])
        owner = to.argmin(axis=0) if to.dtype != object else np.array([min(range(len(to)), key=lambda i: to[i, j]) for j in range(len(members))])
        rest = [np.array([j for j in range(len(members)) if owner[j] == i and j not in splits], np.int64) for i in range(len(splits))]
        self.children = [Gnat(entries, members[r], degree) if len(r) else None for r in rest]
        # low[i][j], high[i][j]: distances from split i to split j and all below it
        self.low, self.high = [], []
        for i in range(len(splits)):
            ranges = [to[i, np.append(r, s)] if i != j else to[i, r] if len(r) else to[i, [s]] for j, (r, s) in enumerate(zip(rest, splits))]
            self.low.append([int(roots(np.array([min(v)], to.dtype))[0][0]) for v in ranges])
            self.high.append([int(roots(np.array([max(v)], to.dtype))[1][0]) for v in ranges])

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(index, squared distance) of the nearest entry of each row of
        ``x``, the lowest index of equals; and the distances worked out."""
        best = np.zeros(len(x), np.int64)
        far = squared(x, self.entries[0])
        best_d, done = far.copy(), len(x)
        done += self._visit(x, np.arange(len(x)), best, best_d)
        return best, best_d, done

    def _visit(self, x, rows, best, best_d) -> int:
        alive = np.ones((len(rows), len(self.splits)), bool)
        done = 0
        for i, s in enumerate(self.splits):
            at = np.flatnonzero(alive[:, i])
            if not len(at):
                continue
            here = rows[at]
            d = squared(x[here], self.entries[s])
            done += len(at)
            better = (d < best_d[here]) | ((d == best_d[here]) & (s < best[here]))
            best[here[better]], best_d[here[better]] = s, d[better]
            below, above = roots(d)
            radius = roots(best_d[here])[1]
            for j in range(len(self.splits)):
                out = (below - self.high[i][j] > radius) | (self.low[i][j] - above > radius)
                # split points up to i are compared already; their entries below are not
                alive[at[out.astype(bool)], j] = False
        for j, child in enumerate(self.children):
            if child is not None and alive[:, j].any():
                done += child._visit(x, rows[alive[:, j]], best, best_d)
        return done


def whole_numbers(x: np.ndarray) -> np.ndarray:
    """floor(4096 x), exactly: 64-bit where squared distances fit, else
    numbers of any size."""
    top = float(np.abs(x).max()) if x.size else 0.0
    if top * SCALE < 1 << 26 and x.shape[1] <= 1 << 8:
        return np.floor(x.astype(np.float64) * SCALE).astype(np.int64)
    exact = [SCALE * int(v) if abs(v) >= 1 << 50 else math.floor(v * SCALE) for v in x.astype(np.float64).ravel().tolist()]
    return np.array(exact, object).reshape(x.shape)


def bounds(length: int, parts: int) -> list[int]:
    """Where the parts begin and end: equal ones if ``parts`` divides the
    length, else as even as can be."""
    return [i * length // parts for i in range(parts + 1)]


def _blocks(batch: pa.RecordBatch, column: str):
    """(rows, integers) per vector length, a slice at a time."""
    for at in range(0, batch.num_rows, ROWS):
        part = batch.slice(at, ROWS)
        lists = part.column(part.schema.get_field_index(column))
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64) if len(sizes) else sizes
        for length in np.unique(sizes):
            here = np.flatnonzero(sizes == length)
            x = flat[(starts[here][:, None] + np.arange(length)[None, :])] if length else np.zeros((len(here), 0))
            yield part, here, int(length), whole_numbers(x)


Books = dict[int, list[np.ndarray]]      # per vector length: a codebook per part


def _typed(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in 64 bits or both as numbers of any size."""
    return (x, book) if x.dtype == book.dtype else (x.astype(object), book.astype(object))


def _book(rows: list[list[int]], width: int) -> np.ndarray:
    exact = np.array(rows, object).reshape(len(rows), width)
    return exact.astype(np.int64) if not exact.size or max(abs(int(v)) for v in exact.ravel()) < 1 << 26 else exact


def usable(v):
    """Not null, and all components finite."""
    return v.isNotNull() & F.coalesce(F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))), F.lit(False))


def first_books(rows: DataFrame, parts: int, entries: int) -> Books:
    """Codebooks of the vectors with the smallest ids, per vector length."""
    w = W.partitionBy(F.size("embedding")).orderBy(F.col("vec_id").asc_nulls_last(), F.col("embedding").asc())
    seeds = rows.select("embedding", F.row_number().over(w).alias("n")).filter(F.col("n") <= entries)
    by_length: dict[int, list] = {}
    for r in seeds.orderBy(F.size("embedding"), "n").collect():
        by_length.setdefault(len(r["embedding"]), []).append(r["embedding"])
    books: Books = {}
    for length, vectors in by_length.items():
        x = whole_numbers(np.array(vectors, np.float64).reshape(len(vectors), length))
        cut = bounds(length, parts)
        books[length] = [_book(x[:, a:b].tolist(), b - a) for a, b in zip(cut, cut[1:])]
    return books


def _sums(rows: DataFrame, books: Books) -> DataFrame:
    """(length, part, entry, position, limb, total): sums of the parts that
    each entry is nearest to; position -1 counts them."""
    schema = pa.schema([(c, pa.int32()) for c in ("length", "part", "entry", "position", "limb")] + [("total", pa.int64())])

    def run(batches):
        trees = {n: [Gnat(b) for b in own] for n, own in books.items()}
        totals: dict[tuple[int, int, int], list] = {}
        for batch in batches:
            for _, _, length, x in _blocks(batch, "embedding"):
                cut = bounds(length, len(books[length]))
                for p, (a, b) in enumerate(zip(cut, cut[1:])):
                    own, entries = _typed(x[:, a:b], trees[length][p].entries)
                    tree = trees[length][p] if entries.dtype == trees[length][p].entries.dtype else Gnat(entries)
                    code = tree.nearest(own)[0]
                    order = np.argsort(code, kind="stable")
                    found, starts = np.unique(code[order], return_index=True)
                    sums = np.add.reduceat(own[order], starts, axis=0) if b > a else np.zeros((len(found), 0), np.int64)
                    sizes = np.diff(np.append(starts, len(code)))
                    for e, n, s in zip(found.tolist(), sizes.tolist(), sums.tolist()):
                        held = totals.setdefault((length, p, e), [0, [0] * (b - a)])
                        held[0] += n
                        held[1] = [u + int(v) for u, v in zip(held[1], s)]
        out = []
        for (length, p, e), (n, sums) in totals.items():
            out.append((length, p, e, -1, 0, n))
            for i, s in enumerate(sums):
                sign, left, limb = (-1, -s, 0) if s < 0 else (1, s, 0)
                while left:
                    left, low = divmod(left, LIMB)
                    out.append((length, p, e, i, limb, sign * low))
                    limb += 1
        for at in range(0, len(out), 65_536):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out[at:at + 65_536]), schema)], schema=schema)

    parts = rows.select("embedding").mapInArrow(run, "length int, part int, entry int, position int, limb int, total long")
    return parts.groupBy("length", "part", "entry", "position", "limb").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))


def fit(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Books:
    """Codebooks after ``rounds`` of assigning every part of every vector of
    ``rows`` (embedding; all usable) and averaging; unused entries stay."""
    books = first_books(rows, parts, entries)
    for _ in range(rounds if books else 0):
        found: dict[tuple[int, int, int], dict[int, int]] = {}
        for r in _sums(rows, books).collect():      # entries x (length + 1): the codebooks' size
            at = found.setdefault((r["length"], r["part"], r["entry"]), {})
            at[r["position"]] = at.get(r["position"], 0) + int(r["total"]) * LIMB ** r["limb"]
        for length, own in books.items():
            for p, book in enumerate(own):
                new = book.tolist()
                for e in range(len(new)):
                    if (sums := found.get((length, p, e))) is not None:
                        new[e] = [sums.get(i, 0) // sums[-1] for i in range(book.shape[1])]
                own[p] = _book(new, book.shape[1])
    return books


def digest(own: list[np.ndarray]) -> str:
    """SHA-256 of all components by part, entry, position, comma-joined."""
    return hashlib.sha256(",".join(str(int(v)) for book in own for v in book.ravel()).encode()).hexdigest()


def encode(rows: DataFrame, books: Books) -> DataFrame:
    """``rows`` (embedding, more columns) with ``codes`` (an entry index per
    part), ``error`` (squared distances summed) and ``codebooks_sha256``.
    An error beyond 64 bits is given as the largest long."""
    names = {n: digest(own) for n, own in books.items()}
    kept = [c for c in rows.columns if c != "embedding"]
    schema = rows.select(*kept).schema.add("codes", T.ArrayType(T.IntegerType())).add("error", T.LongType()).add(
        "codebooks_sha256", T.StringType())
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches):
        trees = {n: [Gnat(b) for b in own] for n, own in books.items()}
        for batch in batches:
            for part, here, length, x in _blocks(batch, "embedding"):
                cut = bounds(length, len(books[length]))
                codes, errors = [], np.zeros(len(here), object)
                for p, (a, b) in enumerate(zip(cut, cut[1:])):
                    own, entries = _typed(x[:, a:b], trees[length][p].entries)
                    tree = trees[length][p] if entries.dtype == trees[length][p].entries.dtype else Gnat(entries)
                    code, d, _ = tree.nearest(own)
                    codes.append(code)
                    errors = errors + d
                rows_ = part.take(pa.array(here))
                columns = [rows_.column(rows_.schema.get_field_index(c)) for c in kept]
                columns += [pa.array(list(np.stack(codes, axis=1).astype(np.int32))), pa.array([min(int(e), LARGEST) for e in errors], pa.int64()),
                            pa.array([names[length]] * len(here))]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return rows.mapInArrow(run, schema)


def decode(rows: DataFrame, books: Books) -> DataFrame:
    """``rows`` with ``approximation``: the entries of ``codes`` put together,
    in the scale of the vectors.  Rows name their codebooks by digest."""
    names = {digest(own): [(book / SCALE).tolist() for book in own] for own in books.values()}

    @F.pandas_udf("array<double>")
    def join(codes, name):
        import pandas as pd

        return pd.Series([[v for book, e in zip(names[n], c) for v in book[e]] for c, n in zip(codes, name)])

    return rows.withColumn("approximation", join("codes", "codebooks_sha256"))


def compressed(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, label, codes, error, label_error, codebooks_sha256) for the
    rows of ``vectors`` (vec_id, embedding, label, any more columns, which are
    not carried) whose vector is usable.

    Null vectors and those with null or non-finite components go.  Vectors of
    different length have codebooks of their own; lengths that the parts do
    not divide are cut as evenly as can be, parts without components cost
    nothing.  Fewer rows than entries give as many entries.  Rows that repeat
    keep a row each; first entries of one id are taken in the order of their
    vectors, null ids last; ties go to the lower index.  Null labels are one
    label.  An empty table gives an empty one.
    """
    rows = stored(vectors.select("vec_id", "embedding", "label").filter(usable(F.col("embedding"))), "vectors")
    coded = stored(encode(rows, fit(rows, parts, entries, rounds)), "vector-codes")
    of, total = unused(coded, "of"), F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LARGEST)).cast("long")
    labels = checked_broadcast(coded.groupBy(F.col("label").alias(of)).agg(total.alias("label_error")))
    return coded.join(labels, F.col("label").eqNullSafe(F.col(of))).select(
        "vec_id", "label", "codes", "error", "label_error", "codebooks_sha256")


def code_text(codes):
    """Two hex digits an entry index, in part order."""
    return F.array_join(F.transform(codes, lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
