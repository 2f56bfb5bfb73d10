"""Raked weights against their targets, and the sample against its probabilities."""

import hashlib
from dataclasses import replace

import duckdb
import pytest

from corpus_pipeline import STAGE_MIXTURE
from haulmark.llm import mixing
from haulmark.llm.queries import MIXTURE

SCHEMA = "doc_id bigint, text string, lang string, source string, probability int"


def test_margins_meet_targets():
    cells = [(s, g, t, 10 + 7 * i * j + 3 * k) for i, s in enumerate("abc") for j, g in enumerate("xyz") for k, t in enumerate("pq")]
    shares = {"source": {"a": 0.5, "b": 0.3, "c": 0.2}, "lang": {"x": 0.2, "y": 0.3, "z": 0.5}, "topic": {"p": 0.6, "q": 0.4}}
    mixture = mixing.Mixture(list("abc"), list("xyz"), [], {}, shares, sweeps=60)
    chance = mixing.rake(cells, mixture)
    assert max(chance.values()) == pytest.approx(1.0)
    mass = {c[:3]: c[3] * chance[c[:3]] for c in cells}
    total = sum(mass.values())
    for i, margin in enumerate(mixing.MARGINS):
        for name, share in shares[margin].items():
            assert sum(v for k, v in mass.items() if k[i] == name) / total == pytest.approx(share, abs=1e-9)


def test_cells_without_mass_and_no_cells():
    assert mixing.rake([], MIXTURE) == {}
    assert mixing.rake([("a", "x", "p", 0)], MIXTURE) == {("a", "x", "p"): 1.0}
    chance = mixing.rake([("a", "x", "p", 0), ("b", "x", "p", 5)], MIXTURE)
    assert chance == {("a", "x", "p"): 1.0, ("b", "x", "p"): 1.0}


def test_a_rare_source_does_not_set_the_scale():
    cells = [("src0", "en", "other", 1_700_000_000), ("src1", "en", "other", 170_000_000), ("other", "en", "other", 300)]
    chance = mixing.rake(cells, STAGE_MIXTURE)
    stay = {c[0]: c[3] * chance[c[:3]] for c in cells}
    assert stay["other"] == 300
    assert sum(stay.values()) == pytest.approx(0.5 * sum(c[3] for c in cells))
    assert stay["src0"] / stay["src1"] == pytest.approx(10**0.7)
    # Where the largest factor leaves enough, it sets the scale as before.
    assert mixing.rake(cells[:2], STAGE_MIXTURE) == pytest.approx(mixing.rake(cells[:2], MIXTURE))


def furthest(cells, mixture):
    """The largest difference of a name's share from its target, as a share of the target."""
    chance = mixing.rake(cells, mixture)
    out = 0.0
    for i, margin in enumerate(mixing.MARGINS):
        seen, left = {}, {}
        for c in cells:
            seen[c[i]] = seen.get(c[i], 0) + c[3]
            left[c[i]] = left.get(c[i], 0) + c[3] * chance[c[:3]]
        wanted = {n: m ** mixture.powers[margin] for n, m in seen.items()}
        for n in seen:
            target = wanted[n] / sum(wanted.values())
            out = max(out, abs(left[n] / sum(left.values()) - target) / target)
    return out


def test_sweeps_go_on_until_the_margins_agree():
    # Sources that have nearly one language each: raking is slow.
    cells = [("src0", "en", "other", 1_000_000), ("src0", "de", "other", 300), ("src1", "en", "other", 300), ("src1", "de", "other", 9_000)]
    assert furthest(cells, MIXTURE) > 1e-4
    assert furthest(cells, replace(STAGE_MIXTURE, least=0.0)) < 2e-6


def rows():
    out = [(i, f"w{i} " * (i % 9), ["en", "de", None, "xx"][i % 4], ["src0", "src0", "src0", "src1", "zzz", None][i % 6], 1) for i in range(400)]
    return out + [(None, None, None, None, 1), (1, "w1 ", "de", "src0", 1), (500, "Released under the MIT License. " * 3, "en", "src0", 1)]


@pytest.mark.parametrize("least", [0.0, 0.5, 0.9, 1.0])
def test_frames_and_sql(spark, least):
    mixture = replace(MIXTURE, least=least)
    docs = spark.createDataFrame(rows(), SCHEMA)
    got = mixing.mix(docs, mixture).drop("text_key")
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    want = con.sql(mixing.rake_sql(mixture).replace("from documents", "from (select doc_id::bigint as doc_id, text, lang, source from documents)"))
    names = want.columns
    assert sorted(map(str, map(tuple, got.select(*names).collect()))) == sorted(map(str, want.fetchall()))
    for r in got.collect():
        key = f"{'' if r.doc_id is None else r.doc_id}:{MIXTURE.salt}"
        assert r.kept == (int(hashlib.md5(key.encode()).hexdigest()[:8], 16) / 2**32 < r.probability)
    left = mixing.mixed(docs, mixture)
    assert left.columns == docs.columns
    assert left.count() == got.filter("kept").count()


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert mixing.mix(docs, MIXTURE).count() == 0
    assert mixing.mixed(docs, MIXTURE).count() == 0
