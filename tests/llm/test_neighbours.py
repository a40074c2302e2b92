import numpy as np

from qanat.llm import neighbours as N


def brute(rows, k):
    rows = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if v is not None and any(v)]
    names, matrix = [i for i, _ in rows], np.array([v for _, v in rows])
    size = np.linalg.norm(matrix, axis=1)
    out = set()
    for i, line in zip(names, np.round(matrix @ matrix.T / np.outer(size, size), 9).tolist()):
        near = sorted((-s, j) for s, j in zip(line, names) if j != i)[:k]
        out |= {tuple(sorted((i, j))) for _, j in near}
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [float(x) for x in v], "x") for i, v in rows], "id string, vector array<float>, k1 string")


def test_small_tables_are_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(f"v{i:03}", rng.standard_normal(8)) for i in range(120)]
    rows += [(f"c{i}", rows[0][1]) for i in range(9)]  # more copies than neighbours
    rows += [("s", rows[1][1] * 3), ("null", None), ("zero", np.zeros(8))]
    got = {tuple(r) for r in N.nearest(frame(spark, rows)).collect()}
    assert got == brute(rows, 5)


def test_few_rows(spark):
    rows = [("a", [1, 0]), ("b", [0, 1]), ("c", [1, 1]), ("c", [1, 1]), ("d", [1, 2, 3]), ("e", [3, 2, 1]), ("f", [5])]
    assert {tuple(r) for r in N.nearest(frame(spark, rows)).collect()} == {("a", "b"), ("a", "c"), ("b", "c"), ("d", "e")}
    assert N.nearest(frame(spark, rows[:1])).count() == 0
    assert N.nearest(frame(spark, [])).count() == 0


def test_recall_with_many_leaves(spark, monkeypatch):
    for name, value in (("LEAF_ROWS", 60), ("CELL_ROWS", 300), ("SLICE_QUERIES", 100)):
        monkeypatch.setattr(N, name, value)
    monkeypatch.setattr(N, "fit_tree", lambda s, n: real(s, n, 60, 300))
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((12, 16)) * 2
    rows = [(f"v{i:05}", centres[min(11, int(rng.exponential(2)))] + rng.standard_normal(16)) for i in range(2000)]
    found = {tuple(r) for r in N.nearest(frame(spark, rows)).collect()}
    wanted = brute(rows, 5)
    assert len(found & wanted) / len(wanted) > 0.95
    assert len(found) <= 5 * len(rows)


real = N.fit_tree


def test_tree_indexes_every_vector_and_visits_widen():
    rng = np.random.default_rng(3)
    points = N.unit(rng.standard_normal((800, 8)).astype(np.float32))
    tree = N.fit_tree(points, 800, 50, 200)
    leaves = len(tree.cell_of_leaf)
    assert leaves > 8 and set(N.home_leaf(tree, points)) <= set(range(leaves))
    order = N.visited_leaves(tree, points[:50], leaves)
    assert all(sorted(row) == list(range(leaves)) for row in order.tolist())
    assert (N.visited_leaves(tree, points[:50], 3) == order[:, :3]).all()


def test_measured_recall(spark):
    rng = np.random.default_rng(4)
    rows = frame(spark, [(f"v{i:03}", rng.standard_normal(8)) for i in range(300)])
    row = N.measured_recall(rows, N.nearest(rows), one_in=10).first()
    assert row["recall"] == 1.0 and row["wanted"] == 5 * row["queries"] > 0


def test_scaled_copies_are_folded(spark):
    import time

    rng = np.random.default_rng(5)
    one = rng.standard_normal(16)
    rows = [(f"s{i:05}", one * (1 + i / 7)) for i in range(20_000)] + [(f"v{i:03}", rng.standard_normal(16)) for i in range(200)]
    began = time.perf_counter()
    found = {tuple(r) for r in N.nearest(frame(spark, rows)).collect()}
    assert time.perf_counter() - began < 60
    of = {i: {b if a == i else a for a, b in found if i in (a, b)} for i in ("s19999", "s10000")}
    assert all(own == {f"s{i:05}" for i in range(5)} for own in of.values())


def test_ties_are_cut_by_order():
    rng = np.random.default_rng(6)
    members = np.repeat(rng.standard_normal((3, 8)), 400, axis=0).astype(np.float32) * np.repeat(rng.uniform(1, 9, 1200)[:, None], 8, 1).astype(np.float32)
    who, what = N._best(members[::100], [(np.arange(12), np.arange(1200))], members, 6)
    assert len(who) == 72
    similar = np.round(N.unit(members[::100]).astype(float) @ N.unit(members).astype(float).T, 6)
    for q in range(12):
        wanted = np.lexsort((np.arange(1200), -np.round(N.exact_similarity(np.repeat(members[q * 100][None], 1200, 0), members), 9)))[:6]
        assert set(what[who == q]) == set(wanted) and similar[q][what[who == q]].min() > 0.999999


def test_stored_index_is_asked_with_a_vector(spark, tmp_path, monkeypatch):
    for name, value in (("LEAF_ROWS", 60), ("CELL_ROWS", 300)):
        monkeypatch.setattr(N, name, value)
    monkeypatch.setattr(N, "fit_tree", lambda s, n: real(s, n, 60, 300))
    rng = np.random.default_rng(8)
    rows = [(f"v{i:04}", rng.standard_normal(8)) for i in range(1500)] + [("x", [1, 2]), ("null", None), ("zero", np.zeros(8))]
    N.build_index(frame(spark, rows), str(tmp_path / "index"), target=0.99)
    met = 0
    for _ in range(10):
        asked = rng.standard_normal(8)
        got = [r["id"] for r in N.search_index(spark, str(tmp_path / "index"), asked.tolist()).collect()]
        near = sorted((-round(float(np.float32(v).astype(float) @ asked) / (np.linalg.norm(np.float32(v).astype(float)) * np.linalg.norm(asked)), 9), i) for i, v in rows[:1500])[:5]
        met += len(set(got) & {i for _, i in near})
    assert met >= 45
    assert [r["id"] for r in N.search_index(spark, str(tmp_path / "index"), [2.0, 4.0]).collect()] == ["x"]
    assert N.search_index(spark, str(tmp_path / "index"), [0.0] * 8).count() == 0
