import math

import numpy as np
import pytest

from llm.embedding_dedup import Plan, _Bucket, embedding_components, rotations

VECTORS = "vec_id long, embedding array<float>, label int, row long, dim int, code string, band int, copies long, links long"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, None, None, None, None, None, None) for i, v in rows], VECTORS).repartition(4)


def wanted(rows, threshold=0.9):
    rows = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in rows]
    out = {i: [0, i] for i, _ in rows}
    unit = np.array([v / np.linalg.norm(v) for _, v in rows])
    near = unit @ unit.T >= threshold
    ids = [i for i, _ in rows]
    root = np.arange(len(rows))
    for _ in range(len(rows)):
        new = np.array([root[n].min() for n in near])
        if (new == root).all():
            break
        root = new
    least = {}
    for k, i in enumerate(ids):
        least[root[k]] = min(least.get(root[k], i), i)
    return {i: (int(near[k].sum()) - 1, least[root[k]]) for k, i in enumerate(ids)} if out else {}


def found(frame):
    rows = frame.collect()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in rows)
    return {r["vec_id"]: (r["n_links"], r["component_id"]) for r in rows}


def test_bands_reach_the_recall():
    for rows in (10, 10**4, 10**7, 10**10):
        plan = Plan(rows, 0.9, 0.97)
        same = 1 - math.acos(0.9) / math.pi
        assert 1 - (1 - same**plan.bits) ** plan.bands >= 0.97 and plan.turns(64) * 64 >= plan.bits * plan.bands


def test_estimates_are_unbiased_and_inside_their_bounds():
    draw, plan = np.random.default_rng(2), Plan(10**5, 0.9, 0.97)
    bucket, dim = _Bucket(plan, 5), 64
    x = draw.standard_normal((400, dim))
    x[200:] = x[:200] + 0.5 * draw.standard_normal((200, dim))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    signs = unit @ rotations(dim, plan.turns(dim), 5) >= 0
    codes = [c.tobytes() for c in np.packbits(signs, axis=1)]
    _, turned, corrected, error, keys = bucket.prepare(dim, [v.tobytes() for v in x], codes)
    off = turned @ corrected.T - unit @ unit.T
    np.fill_diagonal(off, 0)
    assert abs(off.mean()) < 2e-3 and (np.abs(off) <= error).mean() > 0.999
    assert (keys == plan.keys(signs)).all()


def test_small_tables(spark, folder):
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    want, have = wanted(rows), found(embedding_components(vectors))
    assert sum(have[i][0] for i in have) >= 0.9 * sum(n for n, _ in want.values()) and all(have[i][0] <= want[i][0] for i in want)


def test_large_groups_copies_and_pairs_at_the_bound(spark):
    draw, rows = np.random.default_rng(3), []
    centre = draw.standard_normal(32)
    for _ in range(1300):  # more than two blocks of one bucket
        rows.append(centre + 0.05 * draw.standard_normal(32))
    rows += [rows[0]] * 400
    for _ in range(600):
        a, b = draw.standard_normal((2, 32))
        rows += [a, a + draw.uniform(0.3, 0.6) * b * np.linalg.norm(a) / np.linalg.norm(b)]
    order = draw.permutation(len(rows))
    rows = [(int(i) * 2 + 1, rows[k]) for i, k in zip(order, range(len(rows)))]
    want, have = wanted(rows), found(embedding_components(table(spark, rows)))
    assert all(have[i][0] <= want[i][0] for i in want)
    assert sum(n for n, _ in have.values()) >= 0.98 * sum(n for n, _ in want.values())
    assert sum(have[i] == want[i] for i in want) >= 0.95 * len(want)


@pytest.mark.parametrize("scale", [1.0, 1e-20, 1e18])
def test_edges(spark, scale):
    v = [scale, 2 * scale, 0.0]
    rows = [(1, v), (1, v), (2, v), (3, None), (4, []), (5, [0.0, 0.0, 0.0]), (6, [1.0, None, 2.0]), (7, [1.0, float("nan"), 2.0]), (8, [1.0, float("inf"), 2.0]), (None, v), (9, [1.0, 2.0]), (10, [-scale, -2 * scale, 0.0]), (11, [3 * scale, 6 * scale, 0.0])]
    have = found(embedding_components(table(spark, rows)))
    assert have == {1: (2, 1), 2: (2, 1), 11: (2, 1), **{k: (0, k) for k in (3, 4, 5, 6, 7, 8, 9, 10)}}
    assert embedding_components(table(spark, rows).where("false")).count() == 0


def test_a_vector_counts_where_an_id_also_has_none(spark):
    rows = [(2, None), (2, [1.0, 2.0, 2.0]), (1, [2.0, 4.0, 4.0]), (3, None), (3, [0.0, 0.0, 0.0])]
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_components(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert found == {1: (1, 1), 2: (1, 1), 3: (0, 3)}
