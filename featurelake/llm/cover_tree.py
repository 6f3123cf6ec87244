"""Exact near-duplicate vectors by cover trees and dual traversal.

Unit vectors at cosine c are sqrt(2 - 2c) apart, so the threshold pairs are
the pairs within a radius.  The top of the tree is shared: pivots, a net of a
bounded sample, split the vectors into cells whose covering radius is
measured over all rows.  Cells are dealt into blocks of bounded size, and
each block gets a cover tree of its own: a node's points are covered by
children whose radius is half as large, the node's own centre among them.

Two trees are traversed together, level by level.  A pair of nodes is dropped
when the centres are further apart than both covering radii plus the
threshold allow; it is taken whole when they are so near that every pair of
points must link; else their children are paired.  Pairs of single points are
decided by the cosine in double precision.  Block pairs are dropped by the
same bound on their cells before any block is sent.

A task gives a count per vector and only those links that join two of its
vectors for the first time, so dense groups cost rows linear in their size.
"""

from __future__ import annotations

import pickle

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurelake.llm.common import stored
from featurelake.llm.components import components

THRESHOLD = 0.9
BLOCK = 4096            # vectors in a block
SAMPLE = 2048           # vectors the pivots are chosen from
PIVOTS = 64             # cells per dimension, at most
SLACK = 1e-9            # bounds decide only beyond rounding errors


class Tree:
    """A cover tree over unit vectors; the points of a node are contiguous.

    ``order`` lists the rows of ``x``; node i has centre ``centre[i]`` (a row),
    radius ``radius[i]``, points ``order[lo[i]:hi[i]]`` and the children
    ``first[i]`` to ``last[i]`` (none for a single point or a radius of 0).
    """

    def __init__(self, x: np.ndarray):
        self.x = x
        self.order = np.arange(len(x))
        far = np.linalg.norm(x - x[0], axis=1).max() if len(x) else 0.0
        self.centre, self.radius, self.lo, self.hi = [0], [far], [0], [len(x)]
        self.first, self.last = [0], [0]
        at = 0
        while at < len(self.centre):
            self._split(at)
            at += 1
        for name in ("centre", "lo", "hi", "first", "last"):
            setattr(self, name, np.array(getattr(self, name), np.int64))
        self.radius = np.array(self.radius)

    def _split(self, node: int) -> None:
        lo, hi, reach = self.lo[node], self.hi[node], self.radius[node]
        if hi - lo <= 1 or reach <= SLACK:
            return
        rows = self.order[lo:hi].copy()
        pts = self.x[rows]
        half = reach / 2
        # greedy net: the node's centre first, then whatever is not covered yet
        start = int(np.flatnonzero(rows == self.centre[node])[0])
        near = np.linalg.norm(pts - pts[start], axis=1)
        owner = np.zeros(len(rows), np.int64)
        centres = [start]
        open_ = near > half
        while open_.any():
            i = int(np.argmax(open_))
            # the covered points keep their centre; only the open ones are looked at
            idx = np.flatnonzero(open_)
            d = np.sqrt(np.maximum(0.0, 2 - 2 * (pts[idx] @ pts[i])))
            d[idx == i] = 0.0
            hit = d <= half
            got = idx[hit]
            owner[got], near[got] = len(centres), d[hit]
            centres.append(i)
            open_[got] = False
        by = np.argsort(owner, kind="stable")
        self.order[lo:hi] = rows[by]
        sizes = np.bincount(owner, minlength=len(centres))
        reaches = np.zeros(len(centres))
        np.maximum.at(reaches, owner, near)
        self.first[node] = len(self.centre)
        stops = np.cumsum(sizes) + lo
        self.centre.extend(rows[centres].tolist())
        self.radius.extend((reaches + np.where(sizes > 1, 1e-12, 0)).tolist())
        self.lo.extend((stops - sizes).tolist())
        self.hi.extend(stops.tolist())
        self.first.extend([0] * len(centres))
        self.last.extend([0] * len(centres))
        self.last[node] = len(self.centre)


class Joined:
    """Counts and first links of the points of two trees."""

    def __init__(self, s: Tree, t: Tree, same: bool, cosine: float):
        self.s, self.t, self.same, self.cosine = s, t, same, cosine
        self.eps = float(np.sqrt(2 - 2 * cosine))
        self.count_s = np.zeros(len(s.x), np.int64)
        self.count_t = self.count_s if same else np.zeros(len(t.x), np.int64)
        n = len(s.x) + (0 if same else len(t.x))
        self.parent = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def _find(self, i: int) -> int:
        p = self.parent
        while p[i] != i:
            p[i] = p[p[i]]
            i = p[i]
        return i

    def _union(self, i: int, j: int) -> None:
        a, b = self._find(i), self._find(j + (0 if self.same else len(self.s.x)))
        if a != b:
            self.parent[max(a, b)] = min(a, b)
            self.links.append((i, j))

    def _whole(self, a: int, b: int) -> None:
        s, t = self.s, self.t
        rows, cols = s.order[s.lo[a]:s.hi[a]], t.order[t.lo[b]:t.hi[b]]
        if self.same and a == b:
            self.count_s[rows] += len(rows) - 1
        else:
            self.count_s[rows] += len(cols)
            self.count_t[cols] += len(rows)
        for i in rows:
            self._union(int(i), int(cols[0]))
        for j in cols[1:]:
            self._union(int(rows[0]), int(j))

    def _points(self, i: np.ndarray, j: np.ndarray) -> None:
        """Pairs of single points, decided exactly."""
        hit = np.einsum("ij,ij->i", self.s.x[i], self.t.x[j]) >= self.cosine
        i, j = i[hit], j[hit]
        np.add.at(self.count_s, i, 1)
        np.add.at(self.count_t, j, 1)
        for a, b in zip(i.tolist(), j.tolist()):
            self._union(a, b)

    def run(self) -> None:
        if not len(self.s.x) or not len(self.t.x):
            return
        front = [(np.array([0]), np.array([0]))]
        while front:
            nodes_a, nodes_b = front.pop()
            for a, b in zip(nodes_a.tolist(), nodes_b.tolist()):
                front.extend(self._expand(a, b))

    def _children(self, tree: Tree, node: int) -> np.ndarray:
        return np.arange(tree.first[node], tree.last[node]) if tree.last[node] else np.array([node])

    def _expand(self, a: int, b: int):
        """The pairs below (a, b) that are neither dropped nor settled."""
        s, t = self.s, self.t
        own = self.same and a == b
        # the larger ball is opened, both if they are alike
        ca = self._children(s, a) if own or s.radius[a] >= t.radius[b] / 2 else np.array([a])
        cb = self._children(t, b) if own or t.radius[b] >= s.radius[a] / 2 else np.array([b])
        if len(ca) == 1 and len(cb) == 1 and ca[0] == a and cb[0] == b:
            if not own and s.hi[a] - s.lo[a] == 1 and t.hi[b] - t.lo[b] == 1:
                self._points(s.centre[[a]], t.centre[[b]])
            else:
                self._alike(a, b, own)
            return
        for at in range(0, len(ca), 512):  # a slice of the matrix at a time
            rows = ca[at:at + 512]
            dist = np.sqrt(np.maximum(0.0, 2 - 2 * (s.x[s.centre[rows]] @ t.x[t.centre[cb]].T)))
            room = s.radius[rows][:, None] + t.radius[cb][None, :]
            keep = dist <= room + self.eps + 1e-7
            if own:
                keep &= rows[:, None] <= cb[None, :]
            i, j = np.nonzero(keep)
            na, nb, d, r = rows[i], cb[j], dist[i, j], room[i, j]
            full = d + r <= self.eps - 1e-7
            if own:
                full &= na != nb
            for x, y in zip(na[full].tolist(), nb[full].tolist()):
                self._whole(x, y)
            na, nb = na[~full], nb[~full]
            single = (s.hi[na] - s.lo[na] == 1) & (t.hi[nb] - t.lo[nb] == 1)
            if own:
                mine = na == nb
                inside = mine & ~single
                for x in na[inside].tolist():
                    if 2 * s.radius[x] <= self.eps - 1e-7:
                        self._whole(x, x)
                    else:
                        yield np.array([x]), np.array([x])
                single, na, nb = single[~mine], na[~mine], nb[~mine]
            self._points(s.centre[na[single]], t.centre[nb[single]])
            if (~single).any():
                yield na[~single], nb[~single]

    def _alike(self, a: int, b: int, own: bool) -> None:
        """Nodes without children: their points are equal but for rounding."""
        s, t = self.s, self.t
        rows, cols = s.order[s.lo[a]:s.hi[a]], t.order[t.lo[b]:t.hi[b]]
        if own:
            self._whole(a, a)
        elif float(s.x[s.centre[a]] @ t.x[t.centre[b]]) >= self.cosine and len(rows) and len(cols):
            self._whole(a, b)


def usable(v):
    """A vector that can link: not null, all components finite, not zero."""
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda c: c != 0), F.lit(False))


def _unit(rows) -> np.ndarray:
    x = np.array(rows if len(rows) == 0 else np.stack(rows), np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)   # against under- and overflow
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _net(x: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` points of ``x``, each the furthest from those before."""
    chosen = [0]
    d = np.linalg.norm(x - x[0], axis=1)
    while len(chosen) < min(most, len(x)) and d.max() > 1e-6:
        chosen.append(int(d.argmax()))
        d = np.minimum(d, np.linalg.norm(x - x[chosen[-1]], axis=1))
    return x[chosen]


def near_duplicates(vectors: DataFrame, cosine: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``
    (vec_id, embedding, any more columns).

    Null and zero vectors and those with null or non-finite components link
    with nothing and are their own component; vectors of different length do
    not link.  Equal rows are vectors of their own; null ids do not count in
    the smallest id (a component of none has null, and is not kept).
    """
    rows = stored(vectors.select("vec_id", "embedding").withColumn("rid", F.monotonically_increasing_id()), "vectors")
    good = rows.filter(usable(F.col("embedding"))).select("rid", "embedding", F.size("embedding").alias("dim"))

    sample: dict[int, list] = {}
    for r in good.orderBy(F.xxhash64("rid")).limit(SAMPLE).collect():
        sample.setdefault(r["dim"], []).append(r["embedding"])
    pivots = {dim: _net(_unit(v), PIVOTS) for dim, v in sample.items()}
    shared = vectors.sparkSession.sparkContext.broadcast(pivots)  # PIVOTS vectors a length

    def cells(batches):
        for pdf in batches:
            pdf = pdf.reset_index(drop=True)
            pdf["cell"], pdf["far"] = 0, 2.0   # a length the sample lacks: one cell
            for dim, part in pdf.groupby("dim"):
                if dim in shared.value:
                    d = np.sqrt(np.maximum(0.0, 2 - 2 * (_unit(part["embedding"].tolist()) @ shared.value[dim].T)))
                    pdf.loc[part.index, "cell"], pdf.loc[part.index, "far"] = d.argmin(axis=1), d.min(axis=1)
            yield pdf[["rid", "dim", "cell", "far", "embedding"]]

    kind = good.schema["embedding"].dataType.simpleString()
    placed = stored(good.mapInPandas(cells, f"rid long, dim int, cell int, far double, embedding {kind}"), "vector-cells")
    size = placed.groupBy("dim", "cell").agg(F.max("far").alias("far"), F.ceil(F.count("*") / block).cast("int").alias("subs"))
    # cells: PIVOTS for each length of the sample
    cell_rows = [tuple(r) for r in size.select("dim", "cell", "far", "subs").collect()]
    eps = float(np.sqrt(2 - 2 * cosine))
    allowed = []
    for dim, c, far, subs in cell_rows:
        for dim2, c2, far2, subs2 in cell_rows:
            apart = float(np.linalg.norm(pivots[dim][c] - pivots[dim][c2])) if dim == dim2 and dim in pivots else 0.0
            if dim == dim2 and (c == c2 or apart <= far + far2 + eps + 1e-7):
                allowed.append((dim, c, subs, c2, subs2))
    if not allowed:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.col("vec_id").isNotNull().alias("kept"))
    plan = F.broadcast(vectors.sparkSession.createDataFrame(allowed, "dim int, cell int, subs int, cell2 int, subs2 int"))
    counts = F.broadcast(vectors.sparkSession.createDataFrame([(d, c, s) for d, c, _, s in cell_rows], "dim int, cell int, subs int"))

    def grow(key, pdf):
        import pandas as pd

        tree = Tree(_unit(pdf["embedding"].tolist()))
        return pd.DataFrame({"dim": [key[0]], "cell": [key[1]], "sub": [key[2]], "tree": [
            pickle.dumps((pdf["rid"].to_numpy(), np.stack(pdf["embedding"].tolist()), tree.order, tree.centre, tree.radius,
                          tree.lo, tree.hi, tree.first, tree.last))]})

    blocks = placed.join(counts, ["dim", "cell"]).withColumn("sub", F.pmod(F.xxhash64("rid"), F.col("subs")).cast("int"))
    trees = stored(blocks.groupBy("dim", "cell", "sub").applyInPandas(grow, "dim int, cell int, sub int, tree binary"), "vector-trees")
    here, there = F.struct("cell", "sub"), F.struct(F.col("cell2").alias("cell"), F.col("sub2").alias("sub"))
    sent = trees.join(plan, ["dim", "cell"]).select(
        "dim", "cell", "sub", "cell2", F.explode(F.sequence(F.lit(0), F.col("subs2") - 1)).alias("sub2"), "tree").select(
        "dim", F.least(here, there).alias("p"), F.greatest(here, there).alias("q"), here.alias("own"), "tree")

    def thaw(blob):
        rid, emb, *parts = pickle.loads(blob)
        tree = Tree.__new__(Tree)
        tree.x = _unit(list(emb))
        tree.order, tree.centre, tree.radius, tree.lo, tree.hi, tree.first, tree.last = parts
        return rid, tree

    def meet(pdf):
        import pandas as pd

        blobs = pdf["tree"].tolist()
        if len(blobs) == 1 and pdf["p"].iloc[0] != pdf["q"].iloc[0]:
            return pd.DataFrame({"a": [], "b": [], "n": []}, dtype="int64")   # the other block is empty
        rid_s, s = thaw(blobs[0])
        rid_t, t = thaw(blobs[1]) if len(blobs) == 2 else (rid_s, s)
        join = Joined(s, t, len(blobs) == 1, cosine)
        join.run()
        out = [(int(rid_s[i]), int(rid_t[j]), 0) for i, j in join.links]
        out += [(int(rid_s[i]), -1, int(join.count_s[i])) for i in np.flatnonzero(join.count_s)]
        if len(blobs) == 2:
            out += [(int(rid_t[i]), -1, int(join.count_t[i])) for i in np.flatnonzero(join.count_t)]
        return pd.DataFrame(out, columns=["a", "b", "n"], dtype="int64")

    found = stored(sent.groupBy("dim", "p", "q").applyInPandas(meet, "a long, b long, n long"), "vector-links")
    degree = found.filter("b = -1").groupBy(F.col("a").alias("rid")).agg(F.sum("n").alias("n_links"))
    roots = components(found.filter("b <> -1"))
    named = rows.select("rid", "vec_id").join(roots, rows["rid"] == roots["node"], "left").withColumn("root", F.coalesce("root", "rid"))
    least = named.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    return named.join(least, "root").join(degree, "rid", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id",
        F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
