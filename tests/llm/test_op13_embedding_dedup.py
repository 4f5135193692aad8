import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from telemetry_lake.llm import embedding_dedup as op

SCHEMA = "vec_id bigint, embedding array<float>"


def turned(dice, vector, cosine):
    """A unit vector at this cosine from a unit vector."""
    other = dice.standard_normal(len(vector))
    other -= vector * (other @ vector)
    return cosine * vector + math.sqrt(1 - cosine**2) * other / np.linalg.norm(other)


def unit(dice, dim):
    v = dice.standard_normal(dim)
    return v / np.linalg.norm(v)


def brute(rows, similarity=0.9):
    """{row number: (n_links, component)} by all pairs."""
    good = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    near = {i: set() for i in range(len(rows))}
    units = {i: np.array(rows[i][1], dtype=np.float32).astype(float) for i in good}
    units = {i: v / np.linalg.norm(v / np.abs(v).max()) / np.abs(v).max() for i, v in units.items()}
    for i in good:
        for j in good:
            if i < j and len(units[i]) == len(units[j]) and units[i] @ units[j] >= similarity:
                near[i].add(j)
                near[j].add(i)
    out = {}
    for i in near:
        seen, todo = {i}, [i]
        while todo:
            new = near[todo.pop()] - seen
            seen |= new
            todo += new
        ids = [rows[k][0] for k in seen if rows[k][0] is not None]
        out[i] = (len(near[i]), min(ids, default=None))
    return out


def listed(rows):
    return [(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in rows]


@pytest.fixture(scope="module")
def clusters():
    dice = np.random.default_rng(8)
    rows = [unit(dice, 64) for _ in range(300)]
    for size, cosine in ((2, 0.93), (30, 0.99), (25, 0.975), (40, 0.96), (12, 0.95)):
        for _ in range(3):
            centre = unit(dice, 64)
            rows += [turned(dice, centre, cosine) for _ in range(size)]
    rows += [r * 3 for r in rows[:5]] + rows[5:9] + rows[5:9]
    return [(i * 2, v) for i, v in enumerate(rows)]


def test_clusters_equal_brute_force(spark, clusters):
    rows = listed(clusters)
    got = op.near_vectors(spark.createDataFrame(rows, SCHEMA).withColumns({"node": F.lit(1), "label": F.lit(None)})).collect()
    expected = brute(rows)
    assert len(got) == len(rows)
    found = sum(r.n_links for r in got)
    wanted = sum(n for n, _ in expected.values())
    # Nothing below the bound, so no row has too many; and nearly all pairs.
    assert all(r.n_links <= expected[r.vec_id // 2][0] for r in got)
    assert found >= 0.98 * wanted
    same = sum(r.component_id == expected[r.vec_id // 2][1] for r in got)
    assert same >= 0.98 * len(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_recall_at_the_bound(spark):
    dice = np.random.default_rng(5)
    rows = []
    for i in range(1500):
        v = unit(dice, 64)
        rows += [(2 * i, v), (2 * i + 1, turned(dice, v, 0.9005))]
    got = {r.vec_id: r for r in op.near_vectors(spark.createDataFrame(listed(rows), SCHEMA)).collect()}
    hits = sum(got[2 * i + 1].component_id == 2 * i and got[2 * i].n_links == 1 for i in range(1500))
    print("recall at 0.9005:", hits / 1500)
    assert hits >= 0.95 * 1500


def test_balls_have_only_links_and_cover_hot_groups(spark):
    dice = np.random.default_rng(2)
    centre = unit(dice, 64)
    hot = [turned(dice, centre, 0.985) for _ in range(600)]
    rows = listed(enumerate(hot + [unit(dice, 64) for _ in range(300)]))
    source = spark.createDataFrame(rows, SCHEMA).select("vec_id", F.col("embedding").alias("vector"))
    found = op.links(source, "vector")
    sizes = [r["count"] for r in found.nodes.groupBy("ball").count().collect() if r["count"] > 1]
    assert sum(sizes) > 500 and max(sizes) > 50
    members = found.nodes.join(found.vectors, "node").collect()
    for ball in {r.ball for r in members}:
        v = np.array([r.vector for r in members if r.ball == ball])
        v = v / np.linalg.norm(v, axis=1, keepdims=True)
        assert (v @ v.T >= 0.9).all()
    got = op.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    expected = brute(rows)
    assert sum(r.n_links for r in got) >= 0.99 * sum(n for n, _ in expected.values())
    assert all(r.n_links <= expected[r.vec_id][0] and r.component_id == expected[r.vec_id][1] for r in got)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [0.99, 0.01]), (3, [0.0, 1.0]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [1.0, None]), (8, [nan, 1.0]),
        (9, [inf, 1.0]), (10, [1.0, 0.0]), (None, [1.0, 0.0]), (None, None), (11, [1.0, 0.0, 0.0]), (12, [1e-38, 1e-40]), (13, [3e38, 1e30]), (14, [1.0]), (15, [-2.0]),
        (3, [0.0, 2.0]), (16, [5.0]), (None, [-1.0, 0.1]),
    ]
    got = op.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    expected = brute(rows)
    key = lambda t: tuple(map(str, t))
    left = sorted(((rows[i][0], n, c if n or rows[i][0] is None else rows[i][0], rows[i][0] == (c if n or rows[i][0] is None else rows[i][0])) for i, (n, c) in expected.items()), key=key)
    assert sorted(map(tuple, got), key=key) == left


def test_empty_table(spark):
    assert op.near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []


def test_decoding_finds_all_filters():
    dice = np.random.default_rng(1)
    for rows, dim in ((100, 64), (20_000, 20), (5, 3)):
        filters = op.filters_for(rows, dim, 0.9)
        units = np.stack([unit(dice, dim) for _ in range(20)])
        expected = [[] for _ in units]
        for k, code in enumerate(filters.codes):
            width = code.blocks[0].shape[0]
            turned = np.zeros((20, width * len(code.blocks)))
            turned[:, :dim] = units
            turned = turned @ code.rotation
            for row, v in enumerate(turned):
                total = np.zeros(1)
                for i, b in enumerate(code.blocks):
                    total = (total[:, None] + (v[i * width : (i + 1) * width] @ b)[None, :]).ravel()
                expected[row] += [(k * code.filters + i, total[i]) for i in np.flatnonzero(total >= filters.alpha)]
        found, home = filters.decode(units)
        assert [sorted(x) for x in found] == [sorted(i for i, _ in x) for x in expected]
        assert [int(h) for h in home] == [max(x, key=lambda p: p[1])[0] if x else -1 for x in expected]


def test_shares_of_directions():
    dice = np.random.default_rng(3)
    x = dice.standard_normal((400_000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    a = unit(dice, 16)
    b = turned(dice, a, 0.9)
    one, two = x @ a >= 0.5, x @ b >= 0.5
    assert op._tail(np.array(0.5), 16) == pytest.approx(one.mean(), rel=0.05)
    assert op.meeting_share(0.5, 0.9, 16) == pytest.approx((one & two).mean(), rel=0.08)
