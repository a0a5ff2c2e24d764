import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import llm.hard_negatives as hard
from llm.hard_negatives import Lists, mine_hard_negatives

ROWS = "vec_id long, embedding array<float>, label int, row long, anchor boolean, id long, x string, dim int, levels int, group string, kind string, score double, window int"


def table(spark, rows):
    return spark.createDataFrame([(*r, *[None] * 10) for r in rows], ROWS).repartition(3)


def best(points, rows, k, low=None, high=None):
    own = [(-s, i) for i, s in points if i in rows and (low is None or s >= low) and (high is None or s <= high)]
    return [(i, -s) for s, i in sorted(own)[:k]]


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 60), st.integers(1, 6), st.sampled_from([1, 3, 200, 10**6, 2**30]), st.integers(1, 4))
def test_search_is_what_scoring_every_row_gives(seed, n, dim, reach, k):
    draw = np.random.default_rng(seed)
    x, labels = draw.integers(-reach, reach + 1, (n, dim)), draw.integers(0, 3, n)
    ids = draw.permutation(n * 2)[:n]
    lists = Lists(ids, labels, x)
    q = draw.integers(-reach, reach + 1, dim)
    points = [(int(i), sum(int(a) * int(b) for a, b in zip(v, q))) for i, v in zip(ids, x)]
    (own, scores), = lists.search(int(ids[0]), 1, True, q, [(None, None)], k)[0]
    assert list(zip(own.tolist(), scores.tolist())) == best(points, {int(i) for i, c in zip(ids, labels) if c == 1 and i != ids[0]}, k)
    ends = sorted(s for _, s in points)
    windows = [(ends[n // 3], ends[-1 - n // 4]), (ends[0], ends[n // 2]), (5, 4), (ends[-1] + 1, ends[-1] + 9)]
    others = {int(i) for i, c in zip(ids, labels) if c != 1}
    for window, (own, scores) in zip(windows, lists.search(int(ids[0]), 1, False, q, windows, k)[0]):
        assert list(zip(own.tolist(), scores.tolist())) == best(points, others, k, *window)


def test_lists_are_left_early_where_few_rows_are_near():
    draw = np.random.default_rng(1)
    x = draw.integers(-20, 21, (20_000, 16))
    x[:40] += 300
    lists = Lists(np.arange(len(x)), np.zeros(len(x), dtype=int), x)
    ((own, _),), met = lists.search(0, 0, True, x[0], [(None, None)], 5)
    assert len(own) == 5 and (own < 40).all() and met < len(x) // 10
    ((own, scores),), met = lists.search(0, 1, False, x[0], [(10**6, 10**7)], 3)
    assert (own < 40).all() and met < len(x) // 10


def wanted(rows, anchor=lambda i: i % 50 == 0, positives=5, negatives=3):
    rows = {(i, c, tuple(math.floor(256 * float(np.float32(y))) for y in v)) for i, v, c in rows if i is not None and c is not None and v and all(y is not None and math.isfinite(y) for y in v)}
    out = []
    for a in [r for r in rows if anchor(r[0])]:
        points = [(r, sum(x * y for x, y in zip(a[2], r[2]))) for r in rows if len(r[2]) == len(a[2])]
        near = sorted((-s, r[0]) for r, s in points if r[1] == a[1] and r[0] != a[0])[:positives]
        for p, i in near:
            far = sorted((-s, r[0]) for r, s in points if r[1] != a[1] and -50 * p <= 100 * s <= -95 * p)[:negatives]
            out += [(a[0], i, k + 1, j, -p, -s) for k, (s, j) in enumerate(far)]
    return sorted(out)


def found(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_small_tables(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet")
    have = mine_hard_negatives(rows, F.col("vec_id") % 10 == 3)
    assert have.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = wanted([tuple(r) for r in rows.select("vec_id", "embedding", "label").collect()], lambda i: i % 10 == 3)
    assert want and found(have) == sorted(want, key=repr)


@pytest.mark.parametrize("cells, least", [(1 << 22, 1 << 11), (200, 8)])
def test_a_label_and_a_vector_with_a_third_of_all_rows(spark, monkeypatch, cells, least):
    monkeypatch.setattr(hard, "CELLS", cells)
    monkeypatch.setattr(hard, "LEAST_ROWS", least)
    draw = random.Random(4)
    vectors = [[draw.gauss(0, 0.4) for _ in range(8)] for _ in range(300)]
    rows = [(i, vectors[i % 300] if i % 3 else vectors[0], 1 if i % 3 == 1 else draw.randrange(5)) for i in range(400)]
    have = found(mine_hard_negatives(table(spark, rows), F.col("vec_id") % 20 == 0))
    assert have and have == sorted(wanted(rows, lambda i: i % 20 == 0), key=repr)


def test_edges(spark):
    v, w = [0.5, 0.25, 0.1], [0.4, 0.2, 0.0]
    odd = [(None, v, 1), (50, None, 1), (100, [], 1), (150, [0.5, None, 0.1], 1), (200, [0.5, float("nan"), 0.1], 1), (250, [float("inf")] * 3, 1), (300, v, None), (350, [3e38] * 3, 1)]
    rows = [(0, v, 1), (0, v, 1), (0, w, 1), (1, v, 1), (2, v, 1), (3, w, 2), (4, w, 2), (4, w, 2), (5, w, 3), (6, w, 2), (7, [0.5, 0.25], 2), (8, [-0.5, 0.0, 0.0], 1), (400, [0.0, 0.0, 0.0], 2), (450, [0.5, 0.5], 1)]
    have = found(mine_hard_negatives(table(spark, rows + odd), F.col("vec_id") % 50 == 0))
    assert have == sorted(wanted(rows), key=repr) and {r[0] for r in have} == {0, 400}
    assert found(mine_hard_negatives(table(spark, odd), F.col("vec_id") % 50 == 0)) == []
    assert found(mine_hard_negatives(table(spark, rows), F.lit(None).cast("boolean"))) == []
    assert found(mine_hard_negatives(table(spark, []), F.col("vec_id") % 50 == 0)) == []
