import numpy as np
import pytest

from featurelake.llm import cover_tree

SCHEMA = "vec_id long, embedding array<double>, label int, n_links long, cell int"


def brute(rows, cosine=0.9):
    ok = [i for i, (_, v) in enumerate(rows) if v and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x in ok:
        for y in ok:
            a, b = np.array(rows[x][1]), np.array(rows[y][1])
            if x != y and len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= cosine:
                links[x] += 1
                root[find(x)] = find(y)
    least = {}
    for i, (v, _) in enumerate(rows):
        if v is not None:
            least[find(i)] = min(v, least.get(find(i), v))
    return sorted(((v, links[i], least.get(find(i)), v is not None and v == least.get(find(i))) for i, (v, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("block", [4096, 16])
def test_matches_brute_force(spark, block):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(14, 12))
    rows = []
    for i in range(160):
        v = centres[rng.integers(14)] + rng.normal(size=12) * rng.choice([0, 1e-7, 0.05, 0.3, 0.8])
        rows.append((1000 - i, (v * rng.choice([1e-3, 1, 50])).tolist()))
    rows += [(5, None), (6, []), (7, [0.0] * 12), (8, [float("nan")] * 12), (9, [float("inf")] + [1.0] * 11), (10, [None] + [1.0] * 11),
             (11, [1.0, 2.0]), (12, [2.0, 4.0]), (None, rows[0][1]), (None, None), (13, rows[3][1]), (13, rows[3][1])]
    df = spark.createDataFrame([(i, v, 0, 1, 2) for i, v in rows], SCHEMA)
    got = cover_tree.near_duplicates(df, block=block).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_traversal_of_two_trees():
    rng = np.random.default_rng(3)
    for _ in range(25):
        base = rng.normal(size=(rng.integers(1, 20), 6))
        x = base[rng.integers(0, len(base), rng.integers(2, 150))]
        x = x + rng.normal(size=x.shape) * rng.choice([0, 1e-3, .1, .4], size=(len(x), 1))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        k = int(rng.integers(1, len(x)))
        for same, s, t in ((True, x, x), (False, x[:k], x[k:])):
            a = cover_tree.Tree(s)
            join = cover_tree.Joined(a, a if same else cover_tree.Tree(t), same, 0.9)
            join.run()
            want = s @ t.T >= 0.9
            if same:
                np.fill_diagonal(want, False)
            assert (join.count_s == want.sum(1)).all()
            assert same or (join.count_t == want.sum(0)).all()


def test_nodes_cover_their_points_with_halving_radii():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 3))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    t = cover_tree.Tree(x)
    for i in range(len(t.centre)):
        pts = x[t.order[t.lo[i]:t.hi[i]]]
        assert np.linalg.norm(pts - x[t.centre[i]], axis=1).max() <= t.radius[i] + 1e-9
        for c in range(t.first[i], t.last[i]):
            assert t.radius[c] <= t.radius[i] / 2 + 1e-9
        if t.last[i]:
            assert t.centre[i] in t.centre[t.first[i]:t.last[i]]


def test_empty_table(spark):
    assert cover_tree.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
