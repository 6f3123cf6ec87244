import numpy as np
import pytest
from pyspark.sql import functions as F

from featurelake.operators import evaluate, recommend


def _cells(spark, seed=7, users=30, items=9, density=0.5):
    rng = np.random.default_rng(seed)
    rows = []
    for u in range(users):
        for i in range(items):
            if rng.random() < density:
                rows.append((f"U{u:03d}", f"P{i:02d}", float(rng.integers(1, 6))))
    return spark.createDataFrame(rows, "user_id string, product_id string, rating double"), rows


def _dense(rows):
    us = sorted({r[0] for r in rows}); its = sorted({r[1] for r in rows})
    A = np.zeros((len(us), len(its)))
    for u, i, r in rows:
        A[us.index(u), its.index(i)] = r
    return A, us, its


def test_svd_matches_numpy(spark):
    cells, rows = _cells(spark)
    A, us, its = _dense(rows)
    model = recommend.fit_svd(cells, k=4)
    s_np = np.linalg.svd(A, compute_uv=False)[:4]
    assert np.allclose(model.singular_values, s_np, rtol=1e-8)
    # reconstruction A V V^T on observed cells equals numpy's rank-4 reconstruction
    U, s, Vt = np.linalg.svd(A, full_matrices=False)
    R = (U[:, :4] * s[:4]) @ Vt[:4]
    got = {(r.user_id, r.product_id): r.prediction for r in recommend.scored_cells(cells, model).collect()}
    for (u, i), p in got.items():
        assert abs(p - R[us.index(u), its.index(i)]) < 1e-8


def test_full_rank_rmse_zero_and_variance(spark):
    cells, rows = _cells(spark, seed=3, users=20, items=6, density=0.8)
    A, _, _ = _dense(rows)
    model = recommend.fit_svd(cells, k=6)
    err = evaluate.error_metrics(recommend.scored_cells(cells, model)).first()
    assert err.rmse < 1e-8
    ev = [r.explained_variance_ratio for r in recommend.explained_variance(cells, model).orderBy("component").collect()]
    U, s, Vt = np.linalg.svd(A, full_matrices=False)
    X = U * s
    ref = X.var(axis=0) / A.var(axis=0).sum()
    assert np.allclose(ev, ref[:len(ev)], atol=1e-9)
    assert abs(sum(ev) - 1.0) < 1e-8


def _brute_topk(A, R, its, k):
    out = {}
    for u in range(R.shape[0]):
        order = sorted(range(R.shape[1]), key=lambda j: (-round(R[u, j], 9), its[j]))[:k]
        out[u] = [its[j] for j in order]
    return out


@pytest.mark.parametrize("block_items", [4096, 5])
def test_topk_and_precision_recall_match_brute_force(spark, block_items):
    cells, rows = _cells(spark, seed=11, users=25, items=12, density=0.6)
    A, us, its = _dense(rows)
    model = recommend.fit_svd(cells, k=3)
    U, s, Vt = np.linalg.svd(A, full_matrices=False)
    R = (U[:, :3] * s[:3]) @ Vt[:3]
    top = recommend.recommend(model, k=5, block_items=block_items)
    got = {}
    for r in top.orderBy("user_id", "rank").collect():
        got.setdefault(r.user_id, []).append(r.product_id)
    ref = _brute_topk(A, R, its, 5)
    assert {us[u]: v for u, v in ref.items()} == got
    # precision / recall exactly as the reference loop computes them
    precisions, recalls = [], []
    for u in range(A.shape[0]):
        rel = set(np.where(A[u] >= 3.5)[0]); rec = {its.index(p) for p in ref[u]}
        hits = len(rel & rec)
        precisions.append(hits / 5)
        if rel:
            recalls.append(hits / len(rel))
    pr = recommend.precision_recall_at_k(cells, top, 5, 3.5).first()
    assert abs(pr.precision_at_5 - np.mean(precisions)) < 1e-12
    assert abs(pr.recall_at_5 - np.mean(recalls)) < 1e-12


def test_exclude_seen(spark):
    cells, rows = _cells(spark, seed=5, users=10, items=8, density=0.4)
    model = recommend.fit_svd(cells, k=2)
    top = recommend.recommend(model, k=3, exclude_seen=True, cells=cells)
    assert top.join(cells, ["user_id", "product_id"], "left_semi").count() == 0


def test_histograms_and_summaries(spark):
    pairs = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (3.0, 2.5), (5.0, 4.0), (4.0, 4.4)],
                                  "actual double, prediction double")
    a = np.array([1, 2, 3, 5, 4.0]); p = np.array([1.5, 2, 2.5, 4, 4.4])
    res = a - p
    h = [r["count"] for r in evaluate.residual_histogram(pairs, 25).orderBy("bin").collect()]
    assert h == np.histogram(res, bins=25)[0].tolist()
    sh = evaluate.shared_histogram(pairs, 15)
    edges = np.histogram_bin_edges(np.concatenate([a, p]), bins=15)
    for series, arr in (("actual", a), ("predicted", p)):
        got = [r["count"] for r in sh.filter(F.col("series") == series).orderBy("bin").collect()]
        assert got == np.histogram(arr, bins=edges)[0].tolist()
    m = {r.rating: r.mae for r in evaluate.mae_by_rating(pairs).collect()}
    assert m == {1: 0.5, 2: 0.0, 3: 0.5, 4: pytest.approx(0.4), 5: 1.0}
    k = evaluate.kde(pairs, columns=("actual",)).orderBy("point").collect()
    bw = a.std(ddof=1) * len(a) ** (-0.2)
    xs = np.linspace(a.min() - 3 * bw, a.max() + 3 * bw, 200)
    dens = np.exp(-0.5 * ((xs[:, None] - a[None, :]) / bw) ** 2).sum(1) / (len(a) * bw * np.sqrt(2 * np.pi))
    assert np.allclose([r.density for r in k], dens)
    hb = evaluate.hexbin_density(pairs, 15)
    assert hb.agg(F.sum("count")).first()[0] == 5


def test_matrix_sample_and_split(spark):
    cells, rows = _cells(spark, users=20, items=20, density=0.3)
    ms = evaluate.matrix_sample(cells, 15)
    assert ms.count() == 15 * 15
    train, test = recommend.split(cells, 0.2, 42)
    assert train.count() + test.count() == cells.count()
    assert sorted(test.collect()) == sorted(recommend.split(cells, 0.2, 42)[1].collect())


def test_topk_large_block_exact_ties(spark):
    # > 4096 items in one block: the threshold path, with deliberate ties
    n_items, k = 5000, 5
    rng = np.random.default_rng(1)
    vals = np.round(rng.random(n_items), 2)            # many exact ties
    items = spark.createDataFrame([(f"P{i:05d}", i, [float(vals[i])]) for i in range(n_items)],
                                  "product_id string, item_idx long, v array<double>")
    users = spark.createDataFrame([("U1", [1.0]), ("U2", [-1.0])], "user_id string, u array<double>")
    model = recommend.SVDModel(items, users, [1.0], 2, n_items)
    got = {}
    for r in recommend.recommend(model, k).orderBy("user_id", "rank").collect():
        got.setdefault(r.user_id, []).append(r.product_id)
    ids = [f"P{i:05d}" for i in range(n_items)]
    for uid, sign in (("U1", 1.0), ("U2", -1.0)):
        ref = sorted(range(n_items), key=lambda i: (-sign * vals[i], ids[i]))[:k]
        assert got[uid] == [ids[i] for i in ref]


def test_top_k_memory_does_not_grow_with_the_block():
    import tracemalloc

    from featurelake.operators import topk

    rng = np.random.default_rng(0)
    ids, v, u = np.array([f"P{i:05d}" for i in range(100_000)], dtype=object), rng.normal(size=(100_000, 12)), rng.normal(size=(512, 12))
    tracemalloc.start()
    rows, items, scores = topk._best(u, [None] * 512, np.full(512, -np.inf), ids, v, 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(rows) == 5 * 512 and peak < 100e6          # all scores at once would be 400 MB
    assert items[rows == 7].tolist() == ids[np.argsort(-(v @ u[7]))[:5]].tolist()


def _model(spark, u, v):
    items = spark.createDataFrame([(f"P{i:04d}", i, [float(x) for x in row]) for i, row in enumerate(v)], "product_id string, item_idx long, v array<double>")
    users = spark.createDataFrame([(f"U{i:04d}", [float(x) for x in row]) for i, row in enumerate(u)], "user_id string, u array<double>")
    return recommend.SVDModel(items, users, [1.0] * len(v[0]), len(u), len(v))


@pytest.mark.parametrize("kind", ["ties", "negative", "falling"])
def test_blocks_that_cannot_pass_the_bar_are_left_out(spark, kind):
    rng = np.random.default_rng(4)
    u, v = rng.integers(-2, 3, (70, 3)).astype(float), rng.integers(-2, 3, (300, 3)).astype(float)
    if kind == "negative":                       # no score above 0: nothing can be pruned
        u, v = -np.abs(u), np.abs(v)
    if kind == "falling":
        u, v = rng.normal(size=(70, 3)), rng.normal(size=(300, 3)) * np.exp(-np.arange(300) / 20)[:, None]
    top, work = recommend.search(_model(spark, u, v), 4, block_items=16)
    got = {}
    for r in top.orderBy("user_id", "rank").collect():
        got.setdefault(int(r.user_id[1:]), []).append((int(r.product_id[1:]), r.score))
    for i in range(len(u)):
        s = [float(sum(a * b for a, b in zip(u[i], w))) for w in v]
        order = sorted(range(len(v)), key=lambda j: (-s[j], j))[:4]
        assert [j for j, _ in got[i]] == order
        assert np.allclose([x for _, x in got[i]], [s[j] for j in order], rtol=0, atol=1e-12)
    share = recommend.pruned_share(work).first()
    assert share.pairs > share.scored if kind == "falling" else share.pairs >= share.scored


def test_scores_equal_predictions_bit_by_bit(spark):
    rng = np.random.default_rng(6)
    model = _model(spark, rng.normal(size=(40, 7)), rng.normal(size=(50, 7)))
    top = recommend.recommend(model, 3, block_items=8)
    both = recommend.predict(top, model)
    assert both.filter("score <> prediction").count() == 0 and both.count() == 120


def test_scores_that_are_not_finite_are_left_out(spark):
    for n in (10, 5000):
        items = spark.createDataFrame([(f"P{i:05d}", i, [float("nan") if i == 0 else float(i)]) for i in range(n)],
                                      "product_id string, item_idx long, v array<double>")
        users = spark.createDataFrame([("U1", [1.0])], "user_id string, u array<double>")
        got = recommend.recommend(recommend.SVDModel(items, users, [1.0], 1, n), 5).orderBy("rank").collect()
        assert [r.product_id for r in got] == [f"P{i:05d}" for i in range(n - 1, n - 6, -1)]


def test_wide_matrix_fits_by_passes(spark):
    rng = np.random.default_rng(2)
    A = (rng.normal(size=(60, 5)) * [9, 7, 5, 3, 2]) @ rng.normal(size=(5, 90)) + 0.01 * rng.normal(size=(60, 90))
    cells = spark.createDataFrame([(f"U{u}", f"P{i}", float(A[u, i])) for u in range(60) for i in range(90)],
                                  "user_id string, product_id string, rating double")
    model = recommend.fit_svd(cells, 4)
    assert np.allclose(model.singular_values, np.linalg.svd(A, compute_uv=False)[:4], rtol=1e-8)
    v = np.array([r.v for r in model.item_factors.orderBy("item_idx").collect()])
    assert np.allclose(v.T @ v, np.eye(4), atol=1e-10)


def test_slowly_falling_spectrum_converges(spark):
    # neighbouring singular values lie within a percent: no few passes of plain iteration would do
    rng = np.random.default_rng(9)
    rows = [(f"U{u:03d}", f"P{i:03d}", float(rng.integers(1, 6))) for u in range(110) for i in range(130) if rng.random() < 0.2]
    cells = spark.createDataFrame(rows, "user_id string, product_id string, rating double")
    A, us, its = _dense(rows)
    model = recommend.fit_svd(cells, 12, gram_items=0)
    s = np.linalg.svd(A, compute_uv=False)
    assert model.converged and max(model.residuals) <= 1e-7 and model.products > 8
    assert np.allclose(model.singular_values, s[:12], rtol=1e-10)
    v = np.array([r.v for r in model.item_factors.orderBy("item_idx").collect()])
    assert np.abs(v.T @ v - np.eye(12)).max() < 1e-10
    assert (np.linalg.norm(A.T @ (A @ v) - v * s[:12] ** 2, axis=0) / s[:12] ** 2).max() < 1e-6
    u = {r.user_id: r.u for r in model.user_scores.collect()}
    assert np.allclose(np.array([u[x] for x in us]), A @ v, atol=1e-9)


def test_far_largest_direction_leaves_the_others(spark):
    # a random block sees little of the largest direction at first: filters of full degree kept nothing else
    rng = np.random.default_rng(5)
    users, items = 600, 900
    rows = [(f"U{u:03d}", f"P{i:03d}", float(rng.integers(1, 6))) for u in range(users) for i in range(items) if i < 12 or rng.random() < 0.01]
    model = recommend.fit_svd(spark.createDataFrame(rows, "user_id string, product_id string, rating double"), 18, gram_items=0, products=8, partial=True)
    A, _, _ = _dense(rows)
    assert model.k == 18          # 13 were left of the block before
    assert model.singular_values[0] == pytest.approx(np.linalg.norm(A, 2), rel=1e-6)


def test_degree_is_low_while_the_largest_value_is_unsettled():
    from featurelake.operators import svd

    values = np.array([58.1, 57.9, 51.7]) ** 2
    assert svd._degree(values, 4.7 * values, float(values[-1]), 10) <= 2
    assert svd._degree(values, 1e-6 * values, float(values[-1]), 10) == 10


def test_lost_directions_are_replaced(spark, monkeypatch):
    from featurelake.operators import svd

    rng = np.random.default_rng(8)
    A = rng.normal(size=(30, 40))
    cells = spark.createDataFrame([(f"U{u:02d}", f"P{i:02d}", float(A[u, i])) for u in range(30) for i in range(40)],
                                  "user_id string, product_id string, rating double")
    rotation, calls = svd._rotation, []

    def losing(gram, image):
        values, q = rotation(gram, image)
        calls.append(1)
        return (values[:2], q[:, :2]) if len(calls) == 1 else (values, q)

    monkeypatch.setattr(svd, "_rotation", losing)
    model = svd.fit_svd(cells, 4, gram_items=0)
    assert model.k == 4 and np.allclose(model.singular_values, np.linalg.svd(A, compute_uv=False)[:4], rtol=1e-8)


def test_sums_of_a_range_of_rows_leave_a_task_once(spark, monkeypatch):
    from featurelake.operators import svd

    rng = np.random.default_rng(7)
    A = np.where(rng.random((5000, 4500)) < 0.004, rng.integers(1, 6, (5000, 4500)), 0).astype(float)
    u, i = np.nonzero(A)
    cells = spark.createDataFrame([(int(a), int(b), float(A[a, b])) for a, b in zip(u, i)], "u long, i long, r double")
    monkeypatch.setattr(svd, "RANGE_CELLS", 20_000)
    products = svd._Products(cells, 5000, 4500, 3)
    assert products.user_rows == 2048 and products.by_item.select("group").distinct().count() == 3
    x = svd._start(4500, 3, spark)

    def whole(blocks):
        return np.vstack([svd._matrix(r["x"], 3) for r in blocks.orderBy("block").collect()])

    y = products.times(x, 3)
    assert np.allclose(whole(y), A @ whole(x), atol=1e-10)
    assert np.allclose(whole(products.times_transposed(y, 3)), A.T @ (A @ whole(x)), atol=1e-8)


def test_a_fit_that_stops_early_says_so(spark):
    rng = np.random.default_rng(9)
    cells = spark.createDataFrame([(f"U{u:03d}", f"P{i:03d}", float(rng.integers(1, 6))) for u in range(60) for i in range(70) if rng.random() < 0.3],
                                  "user_id string, product_id string, rating double")
    with pytest.raises(recommend.NotConverged):
        recommend.fit_svd(cells, 4, products=2, gram_items=0)
    model = recommend.fit_svd(cells, 4, products=2, partial=True, gram_items=0)
    assert not model.converged and max(model.residuals) > 1e-7 and model.k == 4


def test_dominant_direction_low_rank_and_zero_ratings(spark):
    rng = np.random.default_rng(3)
    A = 1e4 + (rng.normal(size=(40, 2)) @ rng.normal(size=(2, 60)))          # rank 3, one value far above the rest
    rows = [(f"U{u:02d}", f"P{i:02d}", float(A[u, i])) for u in range(40) for i in range(60)] + [("U99", "P00", 0.0), ("U00", "P99", 0.0)]
    model = recommend.fit_svd(spark.createDataFrame(rows, "user_id string, product_id string, rating double"), 6)
    s = np.linalg.svd(A, compute_uv=False)
    assert model.k >= 3 and np.allclose(model.singular_values[:3], s[:3], rtol=1e-8)
    assert all(x < 1e-6 * s[0] for x in model.singular_values[3:])
    assert model.n_users == 41 and model.n_items == 61
    users = {r.user_id: r.u for r in model.user_scores.collect()}
    assert len(users) == 41 and np.allclose(users["U99"], 0)


def test_hot_user_and_item_are_dealt_into_tiles(spark):
    from featurelake.operators import matrix

    cells = spark.range(3000).selectExpr("id % 3 as u", "id as i", "cast(1 as double) as r").union(
        spark.range(1, 900).selectExpr("id as u", "7 as i", "2D as r"))
    for by, other in (("u", "i"), ("i", "u")):
        tiles = matrix.tiles(cells.dropDuplicates(["u", "i"]), by, other, block=16, tile_cells=100).collect()
        assert max(len(t.r) for t in tiles) < 200
        assert sum(len(t.r) for t in tiles) == cells.dropDuplicates(["u", "i"]).count()
        assert all(list(t.other) == sorted(t.other) for t in tiles)


def test_sparse_vectors_and_their_transpose(spark):
    from featurelake.operators import matrix

    cells, rows = _cells(spark, users=12, items=9)
    A, us, its = _dense(rows)
    items, users = recommend.item_index(cells), matrix.positions(cells, "user_id", "user_idx")
    by_user = recommend.sparse_rows(cells, items, segment=4)
    assert all(list(r.indices) == sorted(r.indices) and {i // 4 for i in r.indices} == {r.segment} for r in by_user.collect())
    back = np.zeros_like(A)
    for r in matrix.cells_of(by_user, "user_id").collect():
        back[us.index(r.user_id), r.position] = r.rating
    assert (back == A).all()
    back = np.zeros_like(A)
    for r in matrix.cells_of(recommend.sparse_columns(cells, users), "product_id").collect():
        back[r.position, its.index(r.product_id)] = r.rating
    assert (back == A).all()


def test_load_then_save_keeps_the_model(spark, scratch):
    cells, _ = _cells(spark, users=8, items=5)
    model = recommend.fit_svd(cells, 2)
    recommend.save_model(model, scratch)
    loaded = recommend.load_model(spark, scratch)
    recommend.save_model(loaded, scratch)
    again = recommend.load_model(spark, scratch)
    assert again.singular_values == model.singular_values
    assert sorted(again.user_scores.collect()) == sorted(model.user_scores.collect())


def test_no_cells(spark):
    cells = spark.createDataFrame([], "user_id string, product_id string, rating double")
    assert recommend.fit_svd(cells, 3).k == 0


def test_packed_tables_are_not_broadcast(spark):
    cells, _ = _cells(spark, seed=6)
    plan = recommend.recommend(recommend.fit_svd(cells, 2), 3)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_cells_of_one_block_are_not_shuffled_to_meet_its_size(spark):
    from featurelake.operators.matrix import tiles
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        numbers = spark.range(5000).selectExpr("id AS u", "id % 25 AS i", "1.0D AS r")
        plan = tiles(numbers, "i", "u")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_best_vectors_come_from_all_steps_of_a_filter():
    from featurelake.operators import svd

    rng = np.random.default_rng(11)
    A = rng.normal(size=(300, 200))
    gram, width, k = A.T @ A, 8, 3
    x, _ = np.linalg.qr(rng.normal(size=(200, width)))
    values, q = svd._rotation(x.T @ x, x.T @ gram @ x)
    x, cut = x @ q, float(values[-1])
    steps = [x, 2 / cut * gram @ x - x]
    for _ in range(6):
        steps.append(4 / cut * gram @ steps[-1] - 2 * steps[-1] - steps[-2])
    basis = np.hstack(steps)
    values, c, d = svd._best(basis.T @ basis, width, cut, width)
    v, last = basis @ c, steps[-2]
    assert np.allclose(v.T @ v, np.eye(width), atol=1e-8) and np.allclose(gram @ v, basis @ d, atol=1e-6 * values[0])
    former = svd._rotation(last.T @ last, last.T @ gram @ last)[0]        # the last step alone, as before
    true = np.linalg.eigvalsh(gram)[::-1]
    assert all(true[:k] - values[:k] < (true[:k] - former[:k]) / 3 + 1e-9 * true[0])


def test_a_filter_ends_where_the_residuals_need_no_more():
    from featurelake.operators import svd

    values = np.array([4.0, 3.0, 2.0])
    assert svd._enough(values, 1e-6 * values[:2], 2.0, 1e-7) < 5 < svd._enough(values, 1e-2 * values[:2], 2.0, 1e-7)
    assert svd._enough(values, 1e-6 * values, 2.0, 1e-7) == svd.DEGREE        # no gap to tell by


def test_large_blocks_and_indexes_do_not_go_through_the_driver(spark, monkeypatch):
    # some ten kilobytes in files, or none in Spark's eyes: it would broadcast them, whatever they grow to
    from featurelake.operators import matrix, svd

    rng = np.random.default_rng(4)
    rows = [(f"u{u}", f"p{p:04d}", float(rng.integers(1, 6))) for u in range(40) for p in rng.choice(300, 20, replace=False).tolist()]
    cells = spark.createDataFrame(rows, "user_id string, product_id string, rating double")
    want = recommend.fit_svd(cells, 3, oversample=5, gram_items=10)
    items, users = matrix.positions(cells, "product_id", "item_idx"), matrix.positions(cells, "user_id", "user_idx")

    def joins(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return [plan.count(f"{kind}Join") for kind in ("BroadcastHash", "SortMerge")]

    few = joins(matrix.numbered(cells, users, items, 40, 300))
    assert few[1] == 0
    monkeypatch.setattr(matrix, "INDEX_ROWS", 30)
    monkeypatch.setattr(svd, "BROADCAST_BYTES", 0)
    many = matrix.numbered(cells, users, items, 40, 300)
    # what is left to broadcast are the offsets of positions, a row per partition
    assert joins(many) == [few[0] - 2, 2] and many.count() == len(rows)
    products = svd._Products(many, 40, 300, 8)
    start = svd._start(300, 8, spark)
    assert joins(products.times(start, 8)) == [0, 1]
    assert joins(svd._joined_image(products, start, 8)) == [0, 3]
    got = recommend.fit_svd(cells, 3, oversample=5, gram_items=10)
    assert got.singular_values == pytest.approx(want.singular_values, rel=1e-9) and got.converged
