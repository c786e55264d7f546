import numpy as np
from pyspark.sql import functions as F

from llm.brute import components
from prefloom.llm import near_vectors as V, neighbours as N
from prefloom.llm.cells import Cells


def odd_vectors(spark):
    rnd = np.random.default_rng(4)
    x = rnd.standard_normal((300, 64)).astype(np.float32)
    x[100:140] = x[100] + 0.3 * rnd.standard_normal((40, 64)).astype(np.float32)
    x[140:150] = x[141]
    rows = [(i, [float(v) for v in r], i % 3) for i, r in enumerate(x)]
    rows += [(300, None, 0), (400, [0.0] * 64, 0), (500, [float("nan")] + [1.0] * 63, 0), (501, [None] + [1.0] * 63, 0), (502, [1.0, 2.0], 0), (503, [], 0),
             (7, rows[7][1], 0), (600, [float("inf")] * 64, 0)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), rows


def usable(rows):
    return [(i, np.array(r, float)) for i, r, _ in rows if r and len(r) == 64 and all(v is not None and np.isfinite(v) for v in r) and any(r)]


def test_near_vectors(spark, monkeypatch):
    monkeypatch.setattr(V, "HOME", 64)
    monkeypatch.setattr(V, "OTHER", 100)
    df, rows = odd_vectors(spark)
    good = usable(rows)
    unit = np.stack([v / np.linalg.norm(v) for _, v in good])
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    ids = [i for i, _ in good]
    root = components(set(ids), [(ids[a], ids[b]) for a, b in np.argwhere(linked)])
    want = sorted([(i, int(linked[k].sum()), root[i], root[i] == i) for k, i in enumerate(ids)] + [
        (i, 0, i, True) for i in (300, 400, 500, 501, 502, 503, 600)])
    assert sorted(map(tuple, V.near_vectors(df).collect())) == want and linked.sum() > 200
    assert V.near_vectors(df.limit(0)).collect() == []


def test_neighbours(spark, monkeypatch):
    monkeypatch.setattr(N, "PIECE", 50)
    df, rows = odd_vectors(spark)
    good = usable(rows)
    got = {}
    for r in N.nearest_neighbours(df, F.col("vec_id") % 10 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    hits = total = 0
    for i, v in good:
        if i % 10 == 0:
            near = sorted((float(np.sqrt(((w - v) ** 2).sum())), j) for j, w in good if j != i)[:10]
            assert len(got[i]) == 10 and [s for _, s in got[i]] == sorted(s for _, s in got[i])
            hits += len({j for _, j in near} & {j for j, _ in got[i]})
            total += 10
    assert hits >= 0.95 * total and set(got) == {i for i, _ in good if i % 10 == 0}
    few = N.nearest_neighbours(df.where("vec_id < 4"), F.lit(True)).groupBy("query_id").count().collect()
    assert [r["count"] for r in few] == [3] * 4
    assert N.nearest_neighbours(df.limit(0), F.lit(True)).collect() == []


def mixed_sizes(spark):
    """Two sizes, repeated keys, a null key, and columns with the names that the operators use themselves."""
    rnd = np.random.default_rng(8)
    rows = [(i, rnd.standard_normal(4).tolist()) for i in range(6)] + [(10 + i, [1.0, 2.0 + i / 100]) for i in range(3)]
    rows += [(20, [-2.0, 1.0]), (20, [-2.0, 1.0]), (None, [1.0, 2.0]), (30, None), (31, [1.0])]
    return spark.createDataFrame([(i, v, 1, 2, "x", b"y", 0) for i, v in rows], "vec_id long, embedding array<double>, node long, weight long, id string, v binary, d int"), rows


def test_sizes_are_joined_apart(spark):
    df, rows = mixed_sizes(spark)
    got = sorted(map(tuple, V.near_vectors(df).collect()), key=str)
    links = [(a, b) for a in range(len(rows)) for b in range(len(rows)) if a != b and rows[a][1] and rows[b][1] and len(rows[a][1]) == len(rows[b][1])
             and np.dot(rows[a][1], rows[b][1]) >= 0.9 * np.linalg.norm(rows[a][1]) * np.linalg.norm(rows[b][1])]
    part = components(range(len(rows)), links)
    least = {p: min((rows[k][0] for k in part if part[k] == p and rows[k][0] is not None), default=None) for p in part.values()}
    want = [(i, sum(a == k for a, _ in links), least[part[k]], i == least[part[k]]) for k, (i, _) in enumerate(rows)]
    assert got == sorted(want, key=str) and sum(a == 6 for a, _ in links) == 3


def test_neighbours_of_each_size(spark):
    df, rows = mixed_sizes(spark)
    got = {}
    for r in N.nearest_neighbours(df, F.lit(True), k=3).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    for i, v in set((i, tuple(v)) for i, v in rows if i is not None and v):
        if len(v) > 1:
            near = sorted({(float(np.linalg.norm(np.subtract(v, w))), j) for j, w in rows if j not in (None, i) and w and len(w) == len(v)})
            assert got.pop(i) == [j for _, j in near[:3]]
    assert got == {}


def test_many_equal_vectors(spark, monkeypatch):
    monkeypatch.setattr(N, "PIECE", 16)
    rnd = np.random.default_rng(9)
    copies = {i: rnd.standard_normal(64).tolist() for i in range(4)}
    rows = [(i * 100 + k, v) for i, v in copies.items() for k in range(30)]
    rows += [(1000 + k, rnd.standard_normal(64).tolist()) for k in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
    got = {}
    # in batches of three rows the projection of a row depends on its place
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        found = N.nearest_neighbours(df, F.col("vec_id") < 400).orderBy("query_id", "rank").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for r in found:
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    for i in copies:
        own = [i * 100 + k for k in range(30)]
        for q in own:
            assert got[q] == [(j, 0.0) for j in own if j != q][:10]


def test_rounding_of_projections_is_allowed_for():
    rnd = np.random.default_rng(3)
    vector, weights = rnd.standard_normal(64), rnd.standard_normal((64, 8))
    vectors = np.stack([vector] * 30)
    points = vectors @ weights
    points[::2] = np.nextafter(points[::2], np.inf)
    slack = float(4 * 64 * np.finfo(np.float64).eps * np.linalg.norm(weights))
    names, far = N._Tree(points).nearest(points[1], vector, vectors, np.arange(30), 1, 10, 0.0, 20.1, slack)
    assert names.tolist() == [0, *range(2, 11)] and not far.any()


def test_cells_reach_every_near_point():
    rnd = np.random.default_rng(2)
    points = rnd.standard_normal((200, 3))
    cells = Cells(points[:100], 4)
    home = cells.home(points)
    row, cell = cells.reach(points, np.full(200, 0.5))
    reached = set(zip(row.tolist(), cell.tolist()))
    for a in range(200):
        assert (a, home[a]) in reached
        for b in np.flatnonzero(((points - points[a]) ** 2).sum(1) <= 0.25):
            assert (a, home[b]) in reached


def test_chi_square_quantile():
    sample = (np.random.default_rng(1).standard_normal((200_000, 8)) ** 2).sum(1)
    assert abs(np.quantile(sample, 0.99) - N.chi_square_quantile(0.99, 8)) < 0.2
