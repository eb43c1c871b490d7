import numpy as np
import pytest

from sheaf.llm import embedding_join as E
from sheaf.llm.common import Scratch
from sheaf.llm.components import connected_components


def brute(ids, vectors, t=0.9):
    good = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors]
    n, root = len(ids), list(range(len(ids)))
    links = [0] * n

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(n):
        for j in range(i):
            if good[i] and good[j] and len(vectors[i]) == len(vectors[j]):
                a, b = np.array(vectors[i], float), np.array(vectors[j], float)
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= t:
                    links[i] += 1
                    links[j] += 1
                    root[find(i)] = find(j)
    least = {}
    for i in range(n):
        if ids[i] is not None:
            least[find(i)] = min(least.get(find(i), ids[i]), ids[i])
    return sorted([(ids[i], links[i], least.get(find(i)) if good[i] else ids[i]) for i in range(n)], key=repr)


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr(
        "*", "1 AS label", "2 AS rep", "3 AS node", "'k' AS key", "4 AS vec")
    out = E.embedding_near_dups(df, **kw).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in out)
    return sorted([(r.vec_id, r.n_links, r.component_id) for r in out], key=repr)


def clouds(seed, n=250, dim=16):
    rng = np.random.default_rng(seed)
    out = []
    while len(out) < n:
        c = rng.normal(size=dim)
        spread = rng.choice([0, 0.1, 0.3, 0.45, 0.6])
        for _ in range(rng.choice([1, 2, 5, 20])):
            out.append((c + spread * rng.normal(size=dim)) * rng.choice([1, 5, 0.01]))
    return [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(out)]


@pytest.mark.parametrize("kw", [{}, {"blocks": 2, "axes": 2, "chunk": 20}, {"blocks": 16, "axes": 1, "chunk": 7}, {"axes": 3}])
def test_matches_all_pairs(spark, kw):
    rows = clouds(1)
    assert run(spark, rows, **kw) == brute(*zip(*rows))


def test_odd_vectors(spark):
    v = [1.0, 2.0, 3.0, 4.0]
    rows = [(1, v), (2, v), (2, v), (3, None), (4, []), (5, [0.0] * 4), (6, [1.0, None, 3.0, 4.0]), (7, [float("nan")] * 4),
            (8, [float("inf"), 1.0, 1.0, 1.0]), (9, [2.0, 4.0, 6.0, 8.0]), (10, [1.0, 2.0, 3.0]), (11, [1.0, 2.0, 3.1]),
            (None, [-1.0, 0.0, 0.0, 0.5]), (12, [1e-40, 2e-40, 3e-40, 4e-40]), (13, [-x for x in v])]
    rows = [(i, None if x is None else [None if y is None else float(np.float32(y)) for y in x]) for i, x in rows]
    with np.errstate(under="ignore"):
        assert run(spark, rows) == brute(*zip(*rows))


def test_double_components_far_from_one(spark):
    rows = [(1, [1e300, 1e300]), (2, [1e-300, 1.1e-300]), (3, [1.0, -1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in E.embedding_near_dups(df).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (0, 3)}


def test_empty_table(spark):
    assert run(spark, []) == [] and run(spark, [(1, None)]) == [(1, 0, 1)]


def test_a_hot_cloud_in_small_chunks(spark):
    rng = np.random.default_rng(4)
    c = rng.normal(size=8)
    rows = [(i, (c + 0.2 * rng.normal(size=8) if i % 3 == 0 else rng.normal(size=8)).astype(np.float32).tolist()) for i in range(400)]
    assert run(spark, rows, chunk=16) == brute(*zip(*rows))


def test_components_of_chains_stars_and_rings(spark):
    rng = np.random.default_rng(2)
    links = [(i, i + 1) for i in range(0, 300)] + [(1000, i) for i in range(1001, 1400)] + [(5000 + i, 5000 + (i + 1) % 50) for i in range(50)]
    links += [(7, 7), (None, 3)]
    rng.shuffle(links[:700])
    df = spark.createDataFrame(links, "a long, b long").repartition(13)
    tmp = Scratch(spark)
    want = {i: 0 for i in range(1, 301)} | {i: 1000 for i in range(1001, 1400)} | {5000 + i: 5000 for i in range(1, 50)}
    for per_task in (1 << 20, 100):  # one task, and several with rounds after them
        got = {r.node: r.root for r in connected_components(df, "a", "b", tmp, per_task).collect()}
        assert got == want
    assert connected_components(df.limit(0), "a", "b", tmp).collect() == []
