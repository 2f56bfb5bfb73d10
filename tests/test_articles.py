import datetime as dt
import random
import tempfile
from difflib import SequenceMatcher

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from haulmark.operators import articles as art
from haulmark.operators import claims, similarity

BASE = dt.date(2024, 1, 1)
SCHEMA = "raw_ref bigint, day date, title string, judged boolean, duplicate_of bigint"


def sequential(items, threshold=0.72, window=3):
    """One item after the other, as a person with a list would do it."""
    usable = [i for i in items if i[1] is not None and (i[2] or "").strip()]
    usable.sort(key=lambda i: (i[1], i[0]))
    pool = [i for i in usable if i[3] and i[4] is None]
    out = {i[0]: i[4] for i in items}
    for item in usable:
        if item[3]:
            continue
        near = [c for c in pool if abs((c[1] - item[1]).days) <= window]
        hit = next((c for c in near if SequenceMatcher(None, item[2].strip(), c[2].strip()).ratio() >= threshold), None)
        out[item[0]] = hit[0] if hit else None
        if hit is None:
            pool.append(item)
    return out


def noisy_titles(rng, n, days, settled=0.2):
    stems = ["market opens higher today", "new rule for imports", "harvest season begins early", "price of goods falls"]
    items = []
    for i in range(n):
        title = list(rng.choice(stems))
        for _ in range(rng.randint(0, 9)):
            title[rng.randrange(len(title))] = rng.choice("abcdefgh xyz")
        day = BASE + dt.timedelta(days=rng.randrange(days)) if rng.random() > 0.03 else None
        judged = rng.random() < settled
        items.append((i + 1, day, "".join(title) if rng.random() > 0.03 else " ", judged, None))
    for copy in range(n // 3):
        items.append((1000 + copy, BASE + dt.timedelta(days=rng.randrange(days)), stems[0], False, None))
    rng.shuffle(items)
    return items


@pytest.mark.parametrize("seed, options", [(1, {}), (2, {"window": 1}), (3, {"window": 5}), (4, {"tile_rows": 7})])
def test_assignment_equals_sequential_rule(spark, seed, options):
    items = noisy_titles(random.Random(seed), 90, 12)
    got = art.assign_canonical(spark.createDataFrame(items, SCHEMA), **options)
    assert {r.raw_ref: r.duplicate_of for r in got.collect()} == sequential(items, window=options.get("window", 3))


def test_long_chain_is_walked_in_one_pass(spark):
    """Copies on every day for months: each fourth day opens a new canonical item."""
    items = [(i + 1, BASE + dt.timedelta(days=i), "same old story", False, None) for i in range(120)]
    got = {r.raw_ref: r.duplicate_of for r in art.assign_canonical(spark.createDataFrame(items, SCHEMA)).collect()}
    assert got == {i + 1: None if i % 4 == 0 else i - i % 4 + 1 for i in range(120)}


def test_same_batch_and_override(spark):
    items = [(1, BASE, "factory opens in the north", False, None), (2, BASE + dt.timedelta(1), "factory opens in the north!", False, None)]
    got = {r.raw_ref: (r.duplicate_of, r.judged_now) for r in art.assign_canonical(spark.createDataFrame(items, SCHEMA)).collect()}
    assert got == {1: (None, True), 2: (1, True)}


def test_force_judges_everything_again(spark):
    items = [(1, BASE, "alpha beta gamma", True, None), (2, BASE, "alpha beta gamma", True, None), (3, BASE, "other words here", True, 1)]
    got = {r.raw_ref: r.duplicate_of for r in art.assign_canonical(spark.createDataFrame(items, SCHEMA), force=True).collect()}
    assert got == {1: None, 2: 1, 3: None}


def nodes(spark, items, settled):
    rows = [(i, t, (d - dt.date(1970, 1, 1)).days, settled) for i, d, t in items]
    return spark.createDataFrame(rows, "node bigint, title string, day_no int, settled boolean")


def test_pairs_equal_brute_force(spark):
    rng = random.Random(11)
    items = [(i[0], i[1], i[2]) for i in noisy_titles(rng, 60, 9) if i[1] and i[2].strip()]
    items += [(5000 + k, BASE + dt.timedelta(k), "x" * 210 + "y" * k) for k in range(4)]
    df = nodes(spark, items, False)
    got = {(r.node, r.cand) for r in similarity.similar_pairs(df, df, tile_rows=5).select("node", "cand").collect()}
    want = {
        (a[0], b[0])
        for a in items
        for b in items
        if (b[1], b[0]) < (a[1], a[0]) and (a[1] - b[1]).days <= 3 and SequenceMatcher(None, a[2], b[2]).ratio() >= 0.72
    }
    assert got == want and want


def test_rows_of_equal_title_and_day_equal_brute_force(spark):
    items = [(i, BASE + dt.timedelta(i % 5), ("harvest begins", "harvest begin", "other words")[i % 3]) for i in range(60)]
    old = [(i, d, t) for i, d, t in items if i % 4 == 0]
    new = nodes(spark, items, False)
    for cand, rows, settled in ((new, items, False), (nodes(spark, old, True), old, True)):
        got = [(r.node, r.cand, round(r.ratio, 6)) for r in similarity.similar_rows(new, cand, tile_rows=5).collect()]
        want = [
            (a[0], b[0], round(SequenceMatcher(None, a[2], b[2]).ratio(), 6))
            for a in items
            for b in rows
            if abs((a[1] - b[1]).days) <= 3 and (settled or (b[1], b[0]) < (a[1], a[0]))
            and SequenceMatcher(None, a[2], b[2]).ratio() >= 0.72
        ]
        assert sorted(got) == sorted(want) and want


def test_equal_titles_meet_earlier_days_only(spark):
    items = [(k, BASE + dt.timedelta(d), t) for k, (d, t) in enumerate([(0, "a"), (1, "a"), (4, "a"), (5, "a"), (9, "a"), (1, "b"), (2, "b")])]
    got = {tuple(r) for r in similarity.equal_titles(nodes(spark, items, False)).collect()}
    assert got == {(1, 0), (2, 1), (3, 2), (6, 5)}


def test_unsettled_candidates_reach_no_earlier_day(spark):
    df = nodes(spark, [(k, BASE + dt.timedelta(k), "same title") for k in range(12)], False)
    left, right = similarity.tiles(df, df, threshold=0.72, window=3)
    near = left.join(right, (left.a_bucket == right.b_bucket) & (left.a_a == right.b_a) & (left.a_b == right.b_b))
    gaps = {r.g for r in near.select((F.col("a_day_no") - F.col("b_day_no")).alias("g")).collect()}
    assert gaps == {0, 1, 2, 3}


def test_review_candidates_equal_brute_force(spark):
    rng = random.Random(5)
    items = [(i[0], i[1], i[2]) for i in noisy_titles(rng, 50, 6) if i[1] and i[2].strip()]
    new, old = items[:20] + [(9000, BASE, "QQQQQQ")], items[20:]
    got = similarity.review_candidates(nodes(spark, new, False), nodes(spark, old, True), limit=4, tile_rows=5)
    want = set()
    for a in new:
        near = sorted((c for c in old if abs((c[1] - a[1]).days) <= 3), key=lambda c: (c[1], c[0]))
        loose = [c for c in near if SequenceMatcher(None, a[2], c[2]).ratio() >= 0.3]
        want |= {(a[0], c[0], bool(loose), k + 1) for k, c in enumerate((loose or near)[:4])}
    assert {tuple(r) for r in got.collect()} == want


def test_matched_characters_equal_the_library():
    rng = random.Random(3)
    for _ in range(2000):
        a, b = ("".join(rng.choices(rng.choice(["ab", "abcde ", "abcdefghij éß"]), k=rng.randint(0, 260))) for _ in range(2))
        want, size, held = SequenceMatcher(None, a, b).ratio(), len(a) + len(b), similarity.Held(b)
        assert held.matched(a, 0) == round(want * size / 2) or not size
        for threshold in (0.3, 0.72):
            least = similarity.least_matched(size, threshold)
            assert (held.matched(a, least, enough=least) >= least) == (want >= threshold)


def test_review_candidates_spread_small_tiles_and_compare_copies_once(spark, monkeypatch):
    run = similarity._first_loose

    def counted(loose):
        inner = run(loose)

        def noted(items, cands):
            with open(path, "a") as log:
                log.write(f"{TaskContext.get().partitionId()} {items.num_rows}\n")
            return inner(items, cands)

        return noted

    with tempfile.TemporaryDirectory() as folder:
        path = f"{folder}/log"
        monkeypatch.setattr(similarity, "_first_loose", counted)
        new = [(k, BASE + dt.timedelta(k % 12), f"alpha beta {k % 12}") for k in range(600)]
        old = [(1000 + k, BASE + dt.timedelta(k), f"alpha beta {k}") for k in range(12)]
        got = similarity.review_candidates(nodes(spark, new, False), nodes(spark, old, True), limit=2).collect()
        tiles = [line.split() for line in open(path)]
    assert len(got) == 1200 and sum(int(n) for _, n in tiles) == 12
    # The few bytes of the tiles are not gathered into one task.
    assert len({task for task, _ in tiles}) > 1


def test_display_rule(spark):
    rows = [
        (1, True, None, False, False),
        (2, True, 1, False, False),
        (3, True, 1, True, False),
        (4, True, None, False, True),
        (5, False, None, False, False),
        (6, True, None, None, None),
    ]
    df = spark.createDataFrame(rows, "raw_ref int, relevant boolean, duplicate_of int, manual_override boolean, hidden boolean")
    assert [r.raw_ref for r in df.filter(art.display_rule()).collect()] == [1, 3, 6]


def cluster(spark):
    rows = [
        (1, True, None, False, True, "2024-01-01", "lead"),
        (2, True, 1, False, False, "2024-01-03", "mate b"),
        (3, True, 1, False, False, "2024-01-02", "mate a"),
        (4, True, 1, True, False, "2024-01-01", "kept"),
        (5, True, 1, False, True, "2024-01-01", "hidden mate"),
        (6, True, 99, False, False, "2024-01-01", "dangling"),
    ]
    return spark.createDataFrame(
        rows,
        "raw_ref int, relevant boolean, duplicate_of int, manual_override boolean, hidden boolean, published_date string, title string",
    )


def test_succession_promotes_the_earliest_and_is_idempotent(spark):
    out = art.succession(cluster(spark))
    assert [tuple(r) for r in out.events.collect()] == [(1, "lead", 3, "mate a")]
    assert {r.raw_ref: r.duplicate_of for r in out.rows.collect()} == {1: 3, 2: 3, 3: None, 4: 1, 5: 3, 6: 99}
    again = art.succession(out.rows)
    assert again.events.count() == 0
    assert {r.raw_ref: r.duplicate_of for r in again.rows.collect()} == {1: 3, 2: 3, 3: None, 4: 1, 5: 3, 6: 99}


LEGACY = [
    "row_no", "article_id", "title", "url", "content_hash", "published_date", "source", "category", "english_title",
    "english_summary", "ai_processed_at", "include_on_site", "crawled_at", "duplicate_of_article_id", "dedup_judged_at", "manual_override",
]


def legacy(spark, rows):
    base = dict.fromkeys(LEGACY, "")
    full = [{**base, "row_no": i, "crawled_at": "2023", **r} for i, r in enumerate(rows)]
    schema = ", ".join(f"{c} {'int' if c == 'row_no' else 'string'}" for c in LEGACY)
    return spark.createDataFrame([tuple(r[c] for c in LEGACY) for r in full], schema)


def test_many_copies_collapse_to_the_visible_one(spark):
    a, b, c = "a" * 16, "b" * 16, "c" * 16
    rows = [{"article_id": a, "title": "https://www.x.y/1", "url": "head", "content_hash": "desc", "ai_processed_at": f"t{i:02d}", "category": "no"} for i in range(26)]
    rows[13] |= {"include_on_site": "true", "category": "yes", "manual_override": "TRUE"}
    rows += [
        {"article_id": b, "ai_processed_at": "t1", "duplicate_of_article_id": a},
        {"article_id": c, "ai_processed_at": "t1", "duplicate_of_article_id": "d" * 16, "dedup_judged_at": "j"},
        {"article_id": "e" * 16},
    ]
    out = art.consolidate(legacy(spark, rows), now=F.lit("now"))
    raw = {r.content_hash: r for r in out.raw.collect()}
    assert len(raw) == 4 and (raw[a].url, raw[a].title_ko, raw[a].description, raw[a].source_domain) == ("https://www.x.y/1", "head", "desc", "x.y")
    got = {r.raw_ref: r for r in out.canonical.collect()}
    assert set(got) == {a, b, c}
    assert (got[a].relevant, got[a].category, got[a].classified_at, got[a].manual_override) == (True, "yes", "t13", True)
    assert (got[b].relevant, got[b].duplicate_of, got[b].dedup_judged_at) == (True, a, "2023")
    assert (got[c].duplicate_of, got[c].dedup_judged_at) == (None, "j")
    assert tuple(out.counts.first()) == (3, 1, 1, 1)


def test_bad_id_stops_everything(spark):
    with pytest.raises(ValueError, match="malformed"):
        art.consolidate(legacy(spark, [{"article_id": "XYZ"}, {"article_id": "a" * 16}]), now=F.lit("n"))


def test_claims(spark):
    figures = spark.createDataFrame([("kg", 153674.0), ("%", 12.5), ("articles", 0.0)], "unit string, value double")
    texts = spark.createDataFrame(
        [
            (1, "Imports reached 153,700 kg, up 12.4%."),
            (2, "Imports reached 200,000 Kilograms, up 30 %; 0 articles, 5 Articles, 7 days."),
            (3, "Nothing quoted in the last 90 days."),
            (4, None),
        ],
        "id int, text string",
    )
    got = {r.id: (r.status, r.detail) for r in claims.check_texts(texts, figures, key=["id"], text="text").collect()}
    assert got[1] == ("ok", "") and got[3] == ("ok", "") and got[4] == ("ok", "")
    assert got[2] == ("review_needed", "not found among this build's figures: 200,000Kilograms, 30%, 5Articles")


def test_claims_without_any_figure(spark):
    none = spark.createDataFrame([], "unit string, value double")
    got = claims.check_texts(spark.createDataFrame([(1, "5 kg")], "id int, text string"), none, key=["id"], text="text").first()
    assert got.status == "review_needed"
