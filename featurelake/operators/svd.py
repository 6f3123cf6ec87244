"""Truncated SVD of the sparse user x item matrix A, to a proven residual.

For a catalog of few items A'A itself is small: it is added up in one pass and
solved at once.  Beyond, its leading eigenvectors come from Chebyshev-filtered
subspace iteration: a block of item vectors is multiplied by a polynomial in A'A that
damps everything below the wanted eigenvalues, and the next block are the best
vectors in the span of what the polynomial's steps have given (a Krylov space,
restarted).  The end is decided by the residuals ||A'Av - s^2 v|| of
the wanted vectors and by nothing else, whichever way they came; a fit that has not reached them after
its budget raises (or says so, if asked to).

Thin matrices live as tables of dense blocks (block, matrix), A as two tables
of tiles, one by items and one by users.  A product is a join of tiles and
blocks, a partial sum per tile, and a shuffle of these sums to the blocks of
the other side, which tasks add up as they stream in.  Only matrices of
(components + oversample) (degree + 2) squared reach the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurelake.operators.indexing import kept
from featurelake.operators.matrix import BLOCK, looked_up, numbered, positions, tiles
from featurelake.schemas import SVD_COMPONENTS

# Extra directions; degree of a filter at most; residual to reach; products at most.
OVERSAMPLE, DEGREE, TOLERANCE, PRODUCTS = 20, 10, 1e-7, 2000
# Items up to which A'A (8 bytes an entry squared) is added up and solved at once.
GRAM_ITEMS = 2048
# A thin matrix up to this size is broadcast to the tiles, larger ones are joined by shuffling.
BROADCAST_BYTES = 32 * 1024 * 1024
# Cells of a range of result rows at about least, and rows of one at most.
RANGE_CELLS, RANGE_ROWS = 131_072, 131_072
# A filter may tell its largest from its least wanted direction by this factor at most.
SPREAD = 1e10
# ... and by this one over the relative residual, as far as the vectors are unsettled.
UNSETTLED = 1e4
# Parts of a step that the last one does not hold, relative to their squared length, that count.
APART = 1e-10


class NotConverged(RuntimeError):
    """The residuals did not reach the tolerance within the budget."""


@dataclass
class SVDModel:
    item_factors: DataFrame        # product_id, item_idx, v ARRAY<DOUBLE> (row of V)
    user_scores: DataFrame         # user_id, u ARRAY<DOUBLE> (row of U·Σ)
    singular_values: list[float]
    n_users: int
    n_items: int
    residuals: list[float] | None = None   # ||A'Av - s^2 v|| / s^2 per component
    converged: bool = True
    products: int = 0                      # multiplications by A'A

    @property
    def k(self) -> int:
        return len(self.singular_values)


def _matrix(blob: bytes, width: int) -> np.ndarray:
    return np.frombuffer(blob, np.float64).reshape(-1, width)


def _small(n: int, width: int) -> bool:
    return n * width * 8 <= BROADCAST_BYTES


def _range(n_cells: int, n: int, m: int) -> int:
    """Result rows (of m) that a task adds up together.  A range takes all n
    rows of the other side into Python, so there are no more ranges than that
    is cheaper than a row per cell."""
    ranges = max(1, min(n_cells // RANGE_CELLS, n_cells // n))
    return min(BLOCK * math.ceil(m / ranges / BLOCK), RANGE_ROWS)


class _Products:
    """Products of A and A' with thin matrices of ``width`` columns at most, in blocks.

    Where the matrix fits a broadcast, the tiles of one range of result rows
    lie side by side, and a task adds them up before anything is shuffled:
    what moves is about the size of the result, not of a row per cell.
    """

    def __init__(self, cells: DataFrame, n_users: int, n_items: int, width: int):
        n = cells.count()
        self.by_item, self.user_rows = self._tiles(cells, "i", "u", n, n_items, n_users, width)
        self.by_user, self.item_rows = self._tiles(cells, "u", "i", n, n_users, n_items, width)
        self.n_users, self.n_items = n_users, n_items

    @staticmethod
    def _tiles(cells: DataFrame, by: str, other: str, n_cells: int, n: int, m: int, width: int) -> tuple[DataFrame, int | None]:
        """The tiles and the number of result rows in a range, if they are ranged."""
        if not _small(n, width):
            return kept(tiles(cells, by, other), "svd-tiles"), None
        rows = _range(n_cells, n, m)
        found = tiles(cells, by, other, group=rows)
        # files of their own, as a reader splits a small table by files
        return kept(found.repartitionByRange(math.ceil(m / rows), "group", "block").sortWithinPartitions("group", "block"), "svd-tiles"), rows

    def times(self, x: DataFrame, width: int) -> DataFrame:
        """A X: (block, x) of items to (block, x) of users."""
        return self._half(self.by_item, x, width, self.n_items, self.n_users, self.user_rows)

    def times_transposed(self, y: DataFrame, width: int) -> DataFrame:
        return self._half(self.by_user, y, width, self.n_users, self.n_items, self.item_rows)

    def _half(self, tiles_: DataFrame, x: DataFrame, width: int, n: int, m: int, rows: int | None) -> DataFrame:
        # a block of vectors may seem small to Spark, which does not see what Python makes
        joined = tiles_.join(F.broadcast(x) if _small(n, width) else x.hint("merge"), "block").select(
            *["group"] * (rows is not None), "at", "other", "r", "x")

        def terms(at, other, r, blob):
            """(rows of the result, what a tile adds to each)"""
            other = np.asarray(other)
            first = np.flatnonzero(np.append(True, other[1:] != other[:-1]))
            return other[first], np.add.reduceat(np.asarray(r)[:, None] * _matrix(blob, width)[np.asarray(at)], first, axis=0)

        def blocks(ids, sums):
            cut = np.flatnonzero(np.append(True, ids[1:] // BLOCK != ids[:-1] // BLOCK)).tolist() + [len(ids)]
            return pd.DataFrame({"block": [int(ids[a]) // BLOCK for a in cut[:-1]],
                                 "at": [(ids[a:b] % BLOCK).astype(np.int32) for a, b in zip(cut, cut[1:])],
                                 "x": [sums[a:b].tobytes() for a, b in zip(cut, cut[1:])]})

        def partial(batches):
            for batch in batches:
                for tile in zip(*(batch[c] for c in ("at", "other", "r", "x"))):
                    yield blocks(*terms(*tile))

        def gathered(batches):
            group, low, total, touched = None, 0, None, None
            for batch in batches:
                for g, *tile in zip(*(batch[c] for c in ("group", "at", "other", "r", "x"))):
                    if g != group:
                        if group is not None:
                            yield blocks(low + np.flatnonzero(touched), total[touched])
                        group, low = g, g * rows
                        total, touched = np.zeros((min(rows, m - low), width)), np.zeros(min(rows, m - low), bool)
                    ids, sums = terms(*tile)
                    total[ids - low] += sums
                    touched[ids - low] = True
            if group is not None:
                yield blocks(low + np.flatnonzero(touched), total[touched])

        def add(batches):
            block, total = None, None
            for batch in batches:
                done = []
                for b, at, blob in zip(batch["block"], batch["at"], batch["x"]):
                    if b != block:
                        if block is not None:
                            done.append((block, total.tobytes()))
                        block, total = b, np.zeros((min(BLOCK, m - b * BLOCK), width))
                    total[np.asarray(at)] += _matrix(blob, width)
                if done:
                    yield pd.DataFrame(done, columns=["block", "x"])
            if block is not None:
                yield pd.DataFrame([(block, total.tobytes())], columns=["block", "x"])

        sums = joined.mapInPandas(partial if rows is None else gathered, "block long, at array<int>, x binary")
        # streamed in the order of blocks: a task holds one block, whatever arrives for it
        return sums.repartition("block").sortWithinPartitions("block").mapInPandas(add, "block long, x binary")


def _gram_of_items(cells: DataFrame, n_items: int) -> np.ndarray:
    """A'A of few items: users are gathered by block, a dense block at a time
    in a task, and the tasks' sums meet by bands of rows."""
    def products(batches):
        total, block, dense = np.zeros((n_items, n_items)), None, None
        for batch in batches:
            for b, at, other, r in zip(batch["block"], batch["at"], batch["other"], batch["r"]):
                if b != block:
                    if block is not None:
                        total += dense.T @ dense
                    block, dense = b, np.zeros((BLOCK, n_items))
                dense[np.asarray(at), np.asarray(other)] = np.asarray(r)
        if block is not None:
            total += dense.T @ dense
            yield _bands(total)

    blocks = tiles(cells, "u", "i").repartition("block").sortWithinPartitions("block").mapInPandas(products, "block long, x binary")
    return _from_bands(blocks, n_items)      # at most 8 GRAM_ITEMS^2 bytes


BAND = 128


def _bands(total: np.ndarray) -> pd.DataFrame:
    """A task's sum of a square matrix, as bands of rows."""
    return pd.DataFrame({"block": range(0, len(total), BAND), "x": [total[a:a + BAND].tobytes() for a in range(0, len(total), BAND)]})


def _from_bands(parts: DataFrame, n: int) -> np.ndarray:
    """The symmetric matrix of n rows that the tasks' bands add up to."""
    def add(batches):
        block, total = None, None
        for batch in batches:
            for b, x in zip(batch["block"], batch["x"]):
                if b != block:
                    if block is not None:
                        yield pd.DataFrame([(block, total.tobytes())], columns=["block", "x"])
                    block, total = b, np.zeros(len(x) // 8)
                total += np.frombuffer(x, np.float64)
        if block is not None:
            yield pd.DataFrame([(block, total.tobytes())], columns=["block", "x"])

    out = np.zeros((n, n))
    for r in parts.repartition("block").sortWithinPartitions("block").mapInPandas(add, "block long, x binary").collect():
        out[r["block"]:r["block"] + BAND] = _matrix(r["x"], n)
    return (out + out.T) / 2


def _start(n_items: int, width: int, spark, known: np.ndarray | None = None) -> DataFrame:
    """The first block of vectors: known ones, or normal draws seeded by the
    block, so that a refit gives the same factors."""
    def fill(batches):
        for batch in batches:
            rows = []
            for block in batch["id"]:
                size = min(BLOCK, n_items - block * BLOCK)
                x = known[block * BLOCK:block * BLOCK + size] if known is not None else \
                    np.random.default_rng([20, int(block)]).standard_normal((size, width))
                rows.append((block, x.tobytes()))
            yield pd.DataFrame(rows, columns=["block", "x"])

    return spark.range(math.ceil(n_items / BLOCK)).mapInPandas(fill, "block long, x binary")


def _summed(parts: DataFrame, width: int, name: str = "i") -> np.ndarray:
    """Rows (i, g) of task-wise sums, added up in Spark."""
    sums = parts.groupBy(name).agg(*[F.sum(F.col("g")[c]).alias(f"s{c}") for c in range(width)]).orderBy(name).collect()
    return np.array([list(r)[1:] for r in sums], float)


def _grams(pair: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """X'X and X'W of the rows (x, w)."""
    def run(batches):
        total = np.zeros((2 * width, width))
        for batch in batches:
            for x, w in zip(batch["x"], batch["w"]):
                x = _matrix(x, width)
                total += np.vstack([x.T @ x, x.T @ _matrix(w, width)])
        yield pd.DataFrame({"i": np.arange(2 * width), "g": list(total)})

    both = _summed(pair.select("x", "w").mapInPandas(run, "i int, g array<double>"), width)
    return both[:width], (both[width:] + both[width:].T) / 2


def _rotation(gram: np.ndarray, image: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values, Q): the best eigenpairs the block holds, largest first; Q has
    orthonormal columns in the inner product of ``gram``."""
    scale = np.sqrt(np.diag(gram))
    scale = np.where(scale > 0, 1 / np.where(scale > 0, scale, 1), 0)
    w, q = np.linalg.eigh(gram * scale[:, None] * scale[None, :])
    good = w > max(w.max(), 0.0) * 1e-13
    basis = scale[:, None] * q[:, good] / np.sqrt(w[good])
    values, turn = np.linalg.eigh(basis.T @ image @ basis)
    return values[::-1], basis @ turn[:, ::-1]


def _turned(pair: DataFrame, width: int, q: np.ndarray, values: np.ndarray, cut: float) -> DataFrame:
    """(block, x, t, residual): the rotated vectors, the filter's first step
    2/cut A'A x - x, and the squared residuals of the block."""
    def run(batches):
        for batch in batches:
            rows = []
            for block, x, w in zip(batch["block"], batch["x"], batch["w"]):
                x, w = _matrix(x, width) @ q, _matrix(w, width) @ q
                rows.append((block, x.tobytes(), (2 / cut * w - x).tobytes(), ((w - x * values) ** 2).sum(axis=0)))
            if rows:
                yield pd.DataFrame(rows, columns=["block", "former", "x", "residual"])

    return pair.mapInPandas(run, "block long, former binary, x binary, residual array<double>")


def _joined_image(products: _Products, x: DataFrame, width: int) -> DataFrame:
    """Rows of ``x`` (block, ..., x) with w = A'A x; blocks without cells get zeros."""
    image = products.times_transposed(products.times(x.select("block", "x"), width), width).withColumnRenamed("x", "w")
    if not _small(products.n_items, width):
        image = image.hint("merge")
    return x.join(image, "block", "left").withColumn("w", F.coalesce("w", F.expr("cast(repeat('\\0', octet_length(x)) as binary)")))


def _step(products: _Products, state: DataFrame, width: int, cut: float) -> DataFrame:
    """One more degree of the filter: (former, x) to (x, 4/cut A'A x - 2 x - former)."""
    def run(batches):
        for batch in batches:
            rows = [(b, x, (4 / cut * _matrix(w, width) - 2 * _matrix(x, width) - _matrix(f, width)).tobytes())
                    for b, f, x, w in zip(batch["block"], batch["former"], batch["x"], batch["w"])]
            if rows:
                yield pd.DataFrame(rows, columns=["block", "former", "x"])

    both = _joined_image(products, state.select("block", "former", "x"), width)
    return both.mapInPandas(run, "block long, former binary, x binary")


def _steps(states: list[DataFrame]) -> DataFrame:
    """(block, x): all steps of the filter, T_0 X to T_(d+1) X, side by side."""
    parts = [states[0].select("block", F.lit(0).alias("j"), F.col("former").alias("x"))]
    parts += [s.select("block", F.lit(j + 1).alias("j"), "x") for j, s in enumerate(states)]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    n = len(parts)

    def gather(batches):
        held = []
        for batch in batches:
            for block, x in zip(batch["block"], batch["x"]):
                held.append(x)
                if len(held) == n:       # in the order of blocks, of which each has all steps
                    yield pd.DataFrame([(block, held)], columns=["block", "x"])
                    held = []

    return rows.repartition("block").sortWithinPartitions("block", "j").mapInPandas(gather, "block long, x array<binary>")


def _gram_of_steps(steps: DataFrame, width: int, n: int) -> np.ndarray:
    """K'K of the n columns of all steps."""
    def run(batches):
        total = np.zeros((n, n))
        for batch in batches:
            for x in batch["x"]:
                k = np.hstack([_matrix(part, width) for part in x])
                total += k.T @ k
        yield _bands(total)

    return _from_bands(steps.select("x").mapInPandas(run, "block long, x binary"), n)


def _best(gram: np.ndarray, width: int, cut: float, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, C, D): the best ``most`` eigenpairs in the span of the steps
    T_0 X to T_d X, as K C, and their images A'A K C = K D.

    The recurrence of the steps gives their images.  The last step counts
    whole; of the others counts what it does not hold, as far as it is more
    than rounding."""
    total = len(gram)
    n = total - width
    images = np.zeros((total, n))
    for j in range(n // width):
        for to, share in ((0, 0.5), (1, 0.5)) if j == 0 else ((j - 1, 0.25), (j, 0.5), (j + 1, 0.25)):
            images[to * width:(to + 1) * width, j * width:(j + 1) * width] = share * cut * np.eye(width)
    image = gram[:n] @ images
    gram, image = gram[:n, :n], (image + image.T) / 2
    last = slice(n - width, n)
    _, q = _rotation(gram[last, last], image[last, last])
    basis = np.zeros((n, q.shape[1]))
    basis[last] = q
    if n > width:
        length = np.sqrt(np.diag(gram)[:n - width])
        rest = np.zeros((n, n - width))
        rest[np.arange(n - width), np.arange(n - width)] = np.where(length > 0, 1 / np.where(length > 0, length, 1), 0)
        for _ in range(2):
            rest -= basis @ (basis.T @ (gram @ rest))
        apart = rest.T @ gram @ rest
        w, q = np.linalg.eigh((apart + apart.T) / 2)
        good = w > APART
        basis = np.hstack([basis, rest @ (q[:, good] / np.sqrt(w[good]))])
    inner = basis.T @ image @ basis
    values, turn = np.linalg.eigh((inner + inner.T) / 2)
    chosen = basis @ turn[:, ::-1][:, :most]
    return values[::-1][:most], np.vstack([chosen, np.zeros((width, chosen.shape[1]))]), images @ chosen


def _mixed(steps: DataFrame, width: int, c: np.ndarray, d: np.ndarray, values: np.ndarray, cut: float) -> DataFrame:
    """What ``_turned`` gives, of X = K C and A'A X = K D."""
    def run(batches):
        for batch in batches:
            rows = []
            for block, x in zip(batch["block"], batch["x"]):
                k = np.hstack([_matrix(part, width) for part in x])
                x, w = k @ c, k @ d
                rows.append((block, x.tobytes(), (2 / cut * w - x).tobytes(), ((w - x * values) ** 2).sum(axis=0)))
            if rows:
                yield pd.DataFrame(rows, columns=["block", "former", "x", "residual"])

    return steps.mapInPandas(run, "block long, former binary, x binary, residual array<double>")


def _refilled(state: DataFrame, width: int, wanted: int, seed: int) -> DataFrame:
    """The rotated vectors of ``state`` with normal draws as further columns."""
    def run(batches):
        for batch in batches:
            rows = []
            for block, x in zip(batch["block"], batch["former"]):
                x = _matrix(x, width)
                fresh = np.random.default_rng([20, int(block), seed]).standard_normal((len(x), wanted - width))
                rows.append((block, np.hstack([x, fresh]).tobytes()))
            if rows:
                yield pd.DataFrame(rows, columns=["block", "x"])

    return state.select("block", "former").mapInPandas(run, "block long, x binary")


def _degree(values: np.ndarray, residual: np.ndarray, cut: float, most: int) -> int:
    """As high as ``most``, but so that the largest direction does not drown
    the others.  An unsettled vector still holds parts of the largest
    direction, by about its relative residual, and the largest value may lie
    that far above its estimate; both leave a lower degree."""
    relative = residual / np.maximum(values[:len(residual)], 1e-300)
    spread = min(SPREAD, max(10.0, UNSETTLED / max(float(relative.max()), 1e-300)))
    z = 2 * float(values[0]) * (1 + float(relative[0])) / cut - 1
    growth = z + math.sqrt(max(z * z - 1, 0.0))
    return max(1, min(most, int(math.log(2 * spread) / math.log(growth)))) if growth > 1.001 else most


def _enough(values: np.ndarray, residual: np.ndarray, cut: float, tolerance: float) -> int:
    """The degree that takes the residuals to the tolerance, with a factor of
    three to spare, by how much a filter raises the least wanted direction."""
    z = 2 * float(values[len(residual) - 1]) / cut - 1
    growth = z + math.sqrt(max(z * z - 1, 0.0))
    open_ = float((residual / np.maximum(values[:len(residual)], 1e-300)).max())
    if growth <= 1.001 or tolerance <= 0:
        return DEGREE
    return max(1, math.ceil(math.log(max(6 * open_ / tolerance, 1.0)) / math.log(growth)))


def _unpacked(blocks: DataFrame, width: int, name: str, vector: str, q: np.ndarray) -> DataFrame:
    """(name, vector): blocks times ``q`` as a row per position."""
    def run(batches):
        for batch in batches:
            for block, x in zip(batch["block"], batch["x"]):
                rows = _matrix(x, width) @ q
                yield pd.DataFrame({name: int(block) * BLOCK + np.arange(len(rows)), vector: list(rows)})

    return blocks.select("block", "x").mapInPandas(run, f"{name} long, {vector} array<double>")


def fit_svd(cells: DataFrame, k: int = SVD_COMPONENTS, oversample: int = OVERSAMPLE, tolerance: float = TOLERANCE,
            products: int = PRODUCTS, partial: bool = False, gram_items: int = GRAM_ITEMS) -> SVDModel:
    """R4 + R5: uncentered truncated SVD of the user x item matrix of
    ``cells`` (user_id, product_id, rating; a row per pair).

    Every component's residual ||A'Av - s^2 v|| is at most ``tolerance`` s^2
    (plus rounding of the largest), which bounds the relative error of s^2 by
    the same number.  If ``products`` multiplications by A'A do not reach it,
    NotConverged is raised; with ``partial`` the model is returned with
    ``converged`` false.  Components of value zero are left out.
    """
    spark = cells.sparkSession
    items = kept(positions(cells, "product_id", "item_idx"), "svd-items")
    users = kept(positions(cells, "user_id", "user_idx"), "svd-users")
    n_items, n_users = items.count(), users.count()
    none = F.array().cast("array<double>")
    empty = SVDModel(items.select("product_id", "item_idx", none.alias("v")), users.select("user_id", none.alias("u")), [], n_users, n_items, [])
    width = min(k + oversample, n_items)
    k = max(0, min(k, n_items, n_users))
    numbers = kept(numbered(cells, users, items, n_users, n_items), "svd-cells")
    if not k or numbers.isEmpty():
        return empty
    a = _Products(numbers, n_users, n_items, width)
    known = None
    if n_items <= gram_items:
        known = np.ascontiguousarray(np.linalg.eigh(_gram_of_items(numbers, n_items))[1][:, ::-1][:, :width])
    block, used = width, 1

    def turned(x: DataFrame) -> tuple[DataFrame, np.ndarray, float, int]:
        """The state, its values, its cut and its width, of any block of vectors."""
        pair = kept(_joined_image(a, x, block), "svd-pair")
        values, q = _rotation(*_grams(pair, block))
        cut = max(float(values[-1]), 1e-6 * float(values[0]))
        return kept(_turned(pair, block, q, values, cut), "svd-state"), values, cut, q.shape[1]

    state, values, cut, width = turned(_start(n_items, width, spark, known))
    while True:
        squares = state.agg(*[F.sum(F.col("residual")[c]).alias(f"r{c}") for c in range(width)]).first()
        residual = np.sqrt(np.array([float(s) for s in squares]))[:k]
        top = values[:k]
        reached = residual <= tolerance * np.maximum(top, 0) + 1e-13 * top[0]
        lost = width < k
        if (reached.all() and not lost) or used >= products:
            break
        if lost:   # fewer directions than are wanted stayed apart: fresh ones join them
            state, values, cut, width = turned(_refilled(state, width, block, used))
            used += 1
            continue
        states = [state]
        for _ in range(min(_degree(values, residual, cut, DEGREE), _enough(values, residual, cut, tolerance), products - used)):
            states.append(kept(_step(a, states[-1], width, cut), "svd-state"))
            used += 1
        steps, n = kept(_steps(states), "svd-steps"), width * (len(states) + 1)
        values, c, d = _best(_gram_of_steps(steps, width, n), width, cut, block)
        former, cut, width = width, max(float(values[-1]), 1e-6 * float(values[0])), len(values)
        state = kept(_mixed(steps, former, c, d, values, cut), "svd-state")
    held = [i for i in range(len(top)) if top[i] > max(float(top[0]), 0.0) * 1e-14]
    relative = [float(residual[i] / top[i]) for i in held]
    converged = bool(reached.all()) and not lost
    if not converged and not partial:
        raise NotConverged(f"residuals {max(relative):.1e} after {used} products; {tolerance:.1e} was asked for")

    vectors = state.select("block", F.col("former").alias("x"))
    choose = np.eye(width)[:, held]
    named = looked_up(items, n_items)
    found = kept(_unpacked(vectors, width, "item_idx", "v", choose).join(named, "item_idx"), "svd-vectors")
    # deterministic signs: the largest entry of each item component is positive
    if held:
        largest = found.agg(*[F.max_by(F.col("v")[c], F.struct(F.abs(F.col("v")[c]), "item_idx")).alias(f"s{c}") for c in range(len(held))]).first()
        choose = choose * np.array([-1.0 if (t or 0.0) < 0 else 1.0 for t in largest])
    factors = kept(_unpacked(vectors, width, "item_idx", "v", choose).join(named, "item_idx").select("product_id", "item_idx", "v"), "svd-factors")
    scores = _unpacked(a.times(vectors, width), width, "user_idx", "u", choose)
    zero = F.array(*[F.lit(0.0)] * len(held)).cast("array<double>")
    scores = kept(users.join(looked_up(scores, n_users), "user_idx", "left").select("user_id", F.coalesce("u", zero).alias("u")), "svd-scores")
    return SVDModel(factors, scores, [float(math.sqrt(top[i])) for i in held], n_users, n_items, relative, converged, used)
