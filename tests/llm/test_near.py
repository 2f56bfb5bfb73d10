"""Near copies against all pairs, and the signature against the probability Jaccard similarity."""

import random

import numpy as np
import pytest

from haulmark.llm import near

SCHEMA = "doc_id bigint, text string, class_id int"


def sets(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    shingles = [sets(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = shingles[i], shingles[j]
            if a and b and len(a & b) >= 0.8 * len(a | b):
                root[find(i)] = find(j)
    classes = {}
    for i, (doc_id, _) in enumerate(rows):
        classes.setdefault(find(i), []).append(doc_id)
    return sorted((d, min(ids), len(ids)) for ids in classes.values() for d in ids)


def corpus():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for base in range(12):
        text = [rng.choice(words) for _ in range(rng.choice([3, 40, 200, 400]))]
        for copy in range(6):
            edited = list(text)
            for _ in range(copy * len(text) // 150):
                edited[rng.randrange(len(edited))] = rng.choice(words)
            rows.append((base * 10 + copy, " ".join(edited)))
    # A chain: neighbours are links, the ends are not.
    chain = [rng.choice(words) for _ in range(300)]
    for step in range(8):
        rows.append((1000 + step, " ".join(chain[step * 12 :] + [f"c{step}_{k}" for k in range(step * 12)])))
    shared = " ".join(rng.choice(words) for _ in range(60))
    rows += [(2000 + i, shared + " " + " ".join(rng.choice(words) for _ in range(90))) for i in range(40)]
    return rows + [(3000, None), (3001, ""), (3002, " \n "), (3003, "one"), (3004, "ONE"), (3005, "a b c d"), (3006, "a  b\tc d")]


def test_equals_all_pairs(spark):
    rows = corpus()
    got = near.near_copies(spark.createDataFrame([(i, t, 0) for i, t in rows], SCHEMA)).collect()
    assert sorted((r.doc_id, r.class_id, r.class_size) for r in got) == brute(rows)
    kept = [r.doc_id for r in got if r.kept]
    assert sorted(kept) == sorted({r.class_id for r in got})


def test_repeated_passages_inside_documents(spark):
    rng = random.Random(9)
    rows = []
    for i in range(40):
        text = [f"w{rng.randrange(10**6)}" for _ in range(440)]
        # Of the second the end is other text and a passage stands there many times; the third only repeats it.
        rows += [(10 * i, " ".join(text)), (10 * i + 1, " ".join(text[:100] * 100 + text[100:405] + [f"e{i}_{k}" for k in range(35)]))]
        rows.append((10 * i + 2, " ".join(text[:300] * 100 + text[300:])))
    got = near.near_copies(spark.createDataFrame([(i, t, 0) for i, t in rows], SCHEMA)).collect()
    want = brute(rows)
    assert {size for *_, size in want} == {3}
    assert sorted((r.doc_id, r.class_id, r.class_size) for r in got) == want


def test_hot_group_of_near_copies(spark):
    rng = random.Random(1)
    base = [rng.choice("abcdefghijklmnopqrstuvwxyz") * 3 + str(i) for i in range(120)]
    rows = []
    for i in range(700):
        text = list(base)
        for _ in range(2):
            text[rng.randrange(len(text))] = f"n{i}"
        rows.append((i, " ".join(text), 0))
    got = near.near_copies(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 700
    assert sorted((r.doc_id, r.class_id, r.class_size) for r in got) == brute([r[:2] for r in rows])


def test_repeats_and_nulls(spark):
    rows = [(1, "x y z", 0), (1, "x y z", 0), (None, "x y z", 0), (7, None, 0), (7, None, 0)]
    got = near.near_copies(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(str((r.doc_id, r.class_id, r.class_size)) for r in got) == sorted(
        ["(1, 1, 3)", "(1, 1, 3)", "(None, 1, 3)", "(7, 7, 1)", "(7, 7, 1)"]
    )
    assert sum(r.kept for r in got) == 3


def test_empty_table(spark):
    assert near.near_copies(spark.createDataFrame([], SCHEMA)).count() == 0


def test_registers_estimate_probability_jaccard():
    rng = np.random.default_rng(2)
    code = rng.integers(1, 1 << 62, 300).astype(np.uint64)
    wa, wb = np.ones(300), np.ones(300)
    wb[:30] = 5.0
    both = np.concatenate([code, code])
    owner = np.repeat([0, 1], 300)
    sig = near.signatures(owner, both, np.concatenate([wa, wb]), 2, 8192)
    expected = sum(1 / np.maximum(wa / wa[i], wb / wb[i]).sum() for i in range(300))
    assert (sig[0] == sig[1]).mean() == pytest.approx(expected, abs=0.02)


@pytest.mark.parametrize("edges", [[(1, 2), (2, 3), (3, 4), (4, 5)], [(9, 1), (9, 2), (9, 3), (9, 4)], [(1, 1)], []])
def test_components(spark, edges):
    from haulmark.llm.blocks import job

    got = near.components(spark.createDataFrame(edges, "a bigint, b bigint"), job(spark, "test")).collect()
    assert {r.root for r in got} == ({1} if any(a != b for a, b in edges) else set())


@pytest.mark.parametrize("common,each", [(4, (0, 1)), (8, (1, 1)), (12, (1, 2)), (16, (2, 2))])
def test_register_bits_of_links_at_the_threshold(common, each):
    """Pairs at exactly 0.8 of few shingles stay below the bound on differing bits."""
    n = 5000
    rng = np.random.default_rng(common)
    code = rng.integers(0, 2**63, (n, common + sum(each))).astype(np.uint64)
    sides = np.arange(common + each[0]), np.r_[np.arange(common), np.arange(common + each[0], common + sum(each))]
    bits = []
    for side in sides:
        own = code[:, side]
        owner = np.repeat(np.arange(n), own.shape[1])
        bits.append(near.register_bits(near.signatures(owner, own.ravel(), np.ones(own.size), n, near.BANDS * near.ROWS)))
    assert ((bits[0] ^ bits[1]).sum(axis=1) <= near.DIFFERING).all()
