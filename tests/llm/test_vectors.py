"""Centroids, vector codes and near vectors against plain loops."""

import math
import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from haulmark.llm import centroids, codes, vector_links

SCHEMA = "vec_id bigint, embedding array<float>, label int, cluster int, dots string, row string"
LONG_MAX = 2**63 - 1


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, -1, "x", "y") for i, v, label in rows], SCHEMA)


def fine(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def squared(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))


def nearest(v, words):
    return min((squared(v, w), i) for i, w in enumerate(words))


def moved(words, groups):
    return [[sum(c) // len(groups[i]) for c in zip(*groups[i], strict=True)] if groups.get(i) else w for i, w in enumerate(words)]


def plain_clusters(rows, k, rounds, width, limit):
    kept = [(i, [max(-limit, min(limit, math.floor(256 * x))) for x in v]) for i, v, _ in rows if fine(v) and len(v) == width]
    words = [v for _, v in sorted(kept, key=lambda r: (sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]]
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v, words)[1], []).append(v)
        words = moved(words, groups)
    found = [(i, *nearest(v, words)) for i, v in kept]
    within = Counter()
    for _, d, j in found:
        within[j] += d
    total = min(sum(within.values()), LONG_MAX)
    return [(i, j, d, min(within[j], LONG_MAX), total, sha256(",".join(map(str, words[j])).encode()).hexdigest()) for i, d, j in found]


def plain_codes(rows, parts, entries, rounds):
    kept = [(i, label, [math.floor(256 * x) for x in v]) for i, v, label in rows if fine(v)]
    size = max(1, -(-max(len(v) for *_, v in kept) // parts))
    cut = [[(v + [0] * (size * parts - len(v)))[p * size : (p + 1) * size] for p in range(parts)] for *_, v in kept]
    order = sorted(range(len(kept)), key=lambda r: (kept[r][0] is None, kept[r][0] or 0, kept[r][2]))[:entries]
    words = [[cut[r][p] for r in order] for p in range(parts)]
    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for c in cut:
                groups.setdefault(nearest(c[p], words[p])[1], []).append(c[p])
            words[p] = moved(words[p], groups)
    best = [[nearest(c[p], words[p]) for p in range(parts)] for c in cut]
    error = [sum(d for d, _ in b) for b in best]
    of_label = Counter()
    for (_, label, _), e in zip(kept, error, strict=True):
        of_label[label] += e
    digest = sha256(",".join(str(x) for w in words for entry in w for x in entry).encode()).hexdigest()
    return [
        (i, "".join(f"{e:02x}" for _, e in b), err, of_label[label], digest) for (i, label, _), b, err in zip(kept, best, error, strict=True)
    ]


def plain_links(rows, threshold=0.93):
    """Links by all pairs of a label, components by walking."""
    width = max((len(v) for _, v, _ in rows if v), default=0)
    good = [fine(v) and any(v) and label is not None for _, v, label in rows]
    unit = [np.array(list(v) + [0.0] * (width - len(v))) if g else None for (_, v, _), g in zip(rows, good, strict=True)]
    unit = [u / np.sqrt(u @ u) if u is not None else None for u in unit]
    near = [
        [j for j in range(len(rows)) if j != i and good[i] and good[j] and rows[i][2] == rows[j][2] and unit[i] @ unit[j] >= threshold]
        for i in range(len(rows))
    ]
    out = []
    for i, (vec_id, *_) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        low = min(ids) if ids else None
        out.append((vec_id, len(near[i]), low, vec_id == low))
    return out


def order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple(map(str, r)))


def random_rows(seed, n, width, step=64):
    rng = random.Random(seed)
    return [(i, [rng.randint(-step, step) / step for _ in range(width)], rng.choice([0, 0, 1, None])) for i in range(n)]


ODD = [
    (None, [0.5, 0.25, 0.0, 1.0], 1), (900, None, 1), (901, [1.0, None, 0.0, 0.0], 1), (902, [float("nan"), 1.0, 0.0, 0.0], 1),
    (903, [float("inf"), 1.0, 0.0, 0.0], None), (904, [1.0], 1), (905, [], 0), (906, [0.0, 0.0, 0.0, 0.0], 0), (3, [0.5, 0.5, 0.5, 0.5], 0),
    (3, [0.25, 0.5, 0.5, 0.5], 0), (3, [0.25, 0.5, 0.5, 0.5], 0), (907, [-1.0, 1.0, -0.001, 0.001], None),
]


@pytest.mark.parametrize("k,rounds", [(1, 0), (7, 5), (500, 2)])
def test_clusters_equal_plain_loops(spark, k, rounds):
    rows = random_rows(5, 150, 4) + ODD
    got = centroids.cluster(frame(spark, rows), k=k, rounds=rounds, width=4).collect()
    assert order(got) == order(plain_clusters(rows, k, rounds, 4, 2**40))


def test_clusters_of_ties_and_wide_components(spark):
    limit = math.isqrt(LONG_MAX // 2) // 2
    rows = [(i, [float(i % 3), 0.0], 0) for i in range(40)] + [(50, [1e30, -1e30], 0), (51, [-3e9, 5.0], 1)]
    got = centroids.cluster(frame(spark, rows), k=5, rounds=3, width=2).collect()
    assert order(got) == order(plain_clusters(rows, 5, 3, 2, limit))


def test_an_update_equals_all_products():
    rng = np.random.default_rng(2)
    vectors, old = rng.integers(-99, 99, (50, 6)), rng.integers(-99, 99, (4, 6))
    new = old.copy()
    new[1, 2] += 5
    new[3] -= 1
    assert (centroids.update(vectors @ old.T, vectors, new - old) == vectors @ new.T).all()


@pytest.mark.parametrize("parts,entries,rounds", [(2, 9, 2), (4, 1, 1), (3, 200, 2)])
def test_codes_equal_plain_loops(spark, parts, entries, rounds):
    rows = random_rows(6, 150, 4, step=8) + ODD
    got = codes.compress(frame(spark, rows), parts=parts, entries=entries, rounds=rounds).collect()
    assert order(got) == order(plain_codes(rows, parts, entries, rounds))


def test_the_search_is_exact_and_skips_entries():
    rng = np.random.default_rng(4)
    book = codes.books(rng.integers(-50, 50, (3, 64, 4)))
    parts = rng.integers(-60, 60, (2000, 3, 4))
    best, distance, computed = codes.search(parts, codes.starts(parts, book), book)
    every = ((parts[:, :, None, :] - book.values.reshape(3, 64, 4)[None]) ** 2).sum(axis=3)
    assert (best.reshape(-1, 3) - np.arange(3) * 64 == every.argmin(axis=2)).all()
    assert (distance.reshape(-1, 3) == every.min(axis=2)).all()
    assert computed < 0.6 * every.size


def test_codes_of_too_many_entries(spark):
    with pytest.raises(ValueError):
        codes.compress(frame(spark, []), entries=257)


def noisy(rng, base, size):
    v = np.asarray(base) + rng.normal(scale=size, size=len(base))
    return [float(np.float32(x)) for x in v]


def linked_rows(seed, n, width, groups):
    """Random vectors and groups of near ones, some chained; 16-bit noise keeps cosines off the threshold by chance alone."""
    rng = np.random.default_rng(seed)
    rows = [(i, noisy(rng, np.zeros(width), 1.0), int(i % 3)) for i in range(n)]
    for size in groups:
        base = rng.normal(size=width)
        rows += [(len(rows) + i, noisy(rng, base, 0.13), int(rng.integers(0, 2))) for i in range(size)]
    return rows


@pytest.mark.parametrize("per_block", [8192, 37])
def test_links_equal_all_pairs(spark, per_block):
    rows = linked_rows(1, 240, 12, [60, 25, 3, 2, 2]) + ODD
    rows += [(2000 + i, rows[5][1], rows[5][2]) for i in range(30)] + [(rows[7][0], [2 * x for x in rows[7][1]], rows[7][2])]
    got = vector_links.near_vectors(frame(spark, rows), recall=1.0, rows_per_block=per_block, cell_rows=2).collect()
    assert order(got) == order(plain_links(rows))


def test_recall_at_the_threshold(spark):
    """Partners just above the threshold, the hardest links there are, in random directions."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(1200):
        x = rng.normal(size=64)
        y = rng.normal(size=64)
        x, y = x / np.sqrt(x @ x), y - (y @ x) * x / (x @ x)
        rows += [(2 * i, x.tolist(), 0), (2 * i + 1, (0.931 * x + math.sqrt(1 - 0.931**2) * y / np.sqrt(y @ y)).tolist(), 0)]
    got = {r["vec_id"]: r["n_links"] for r in vector_links.near_vectors(frame(spark, rows)).collect()}
    assert sum(got.values()) >= 0.97 * 2400


def test_links_of_odd_vectors_only(spark):
    rows = [(1, None, 0), (2, [0.0], 0), (3, [1.0], None), (None, [1.0], 2), (None, [2.0], 2)]
    got = vector_links.near_vectors(frame(spark, rows)).collect()
    assert order(got) == order(plain_links(rows))


def test_wide_and_tiny_vectors_link(spark):
    rows = [(1, [3e38, 3e38], 0), (2, [1e-40, 1e-40], 0), (3, [1.0, -1.0], 0)]
    assert order(vector_links.near_vectors(frame(spark, rows)).collect()) == order([(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)])


def test_traversal_goes_by_cost():
    rng = np.random.default_rng(8)
    a, b = rng.random((30, 5)), rng.random((30, 7))
    a, b = a - a.min(axis=1)[:, None], b - b.min(axis=1)[:, None]
    rows, cells = vector_links.visits(a, b, 0.5)
    cost = a[:, :, None] + b[:, None, :]
    assert (np.bincount(rows, minlength=30) == (cost <= 0.5).sum(axis=(1, 2))).all()
    paid = cost.reshape(30, -1)[rows, cells]
    assert all((np.diff(paid[rows == r]) >= -1e-12).all() for r in range(30))


def test_empty_tables(spark):
    empty = frame(spark, [])
    for made in (centroids.cluster(empty), codes.compress(empty), vector_links.near_vectors(empty)):
        assert made.count() == 0
    assert centroids.cluster(frame(spark, [(1, None, 0)])).select(F.col("vec_id")).count() == 0
