"""Top-k against all scores."""

import math
import random

import pytest
from pyspark.sql import functions as F

from haulmark.llm import topk

SCHEMA = "vec_id bigint, embedding array<float>, rank int"


def brute(rows, k, every):
    good = [(i, v) for i, v, *_ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    scaled = [(i, [math.floor(64 * x) for x in v]) for i, v in good]
    out = []
    for q in sorted({i for i, _ in scaled if i % every == 0}):
        mine = min(v for i, v in scaled if i == q)
        found = []
        for i, v in scaled:
            if i != q:
                score = sum(a * b for a, b in zip(mine, v, strict=False))
                found.append((-max(min(score, 2**63 - 1), -(2**63)), i))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(found)[:k])]
    return out


def run(spark, rows, k=5, every=10, **sizes):
    vectors = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    got = topk.top_k(vectors, k=k, is_query=F.col("vec_id") % every == 0, **sizes).collect()
    return sorted(map(tuple, got)), brute(rows, k, every)


@pytest.mark.parametrize("shift", [0.0, -2.0, 1.0])
def test_equals_all_scores(spark, shift):
    rng = random.Random(3)
    rows = [(i, [float(rng.choice([-1, 0.5, 0.25, 1, 2]) + shift) for _ in range(7)]) for i in range(260)]
    got, want = run(spark, rows, shard_rows=40, query_rows=9)
    assert got == want


def test_ties_of_a_hot_vector(spark):
    rows = [(i, [1.0, 1.0, 0.0]) for i in range(900)] + [(i, [0.5, 0.0, 1.0]) for i in range(900, 1000)]
    got, want = run(spark, rows, every=100, shard_rows=64)
    assert got == want


def test_nulls_and_odd_vectors(spark):
    rows = [
        (0, [1.0, 2.0]), (10, None), (20, [1.0, None]), (30, [float("nan"), 1.0]), (40, [float("inf"), 1.0]), (1, [1.0]),
        (2, []), (3, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (5, [-0.001, 0.0]), (50, [0.0, 0.0]), (5, [3.0, 3.0]), (0, [0.5, 2.0]),
    ]
    got, want = run(spark, rows)
    assert got == want


def test_wide_values_stay_exact(spark):
    rng = random.Random(9)
    rows = [(i, [float(rng.randint(-9, 9)) * 10.0 ** rng.randint(0, 6) for _ in range(6)]) for i in range(60)]
    got, want = run(spark, rows, shard_rows=16)
    assert got == want


def test_few_and_no_rows(spark):
    assert run(spark, [(0, [1.0]), (1, [2.0])]) == ([(0, 1, 1, 64 * 128)], [(0, 1, 1, 64 * 128)])
    assert run(spark, [(0, [1.0])]) == ([], [])
    assert run(spark, []) == ([], [])
    assert run(spark, [(1, [1.0]), (2, [1.0])]) == ([], [])
