"""The pipeline's rows against the stages worked by hand on the smallest tables."""

import os
import re

import pytest

import corpus_pipeline
from haulmark.llm import language, mixing
from haulmark.llm.queries import MIXTURE

from .test_near import brute

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no generated tables")


def test_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    model = language.fit(docs, corpus_pipeline.F.lit(True))
    rejected = model.predict([r[1] or "" for r in rows])[2]
    rows = [r for r, bad in zip(rows, rejected, strict=True) if not bad]
    groups = {}
    for r in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r[1]), []).append((-len(r[1]), r[0]))
    stay = {min(g)[1] for g in groups.values()}
    rows = [r for r in rows if r[0] in stay]
    stay = {c for _, c, _ in brute([r[:2] for r in rows])}
    rows = [r for r in rows if r[0] in stay]
    left = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    want = sorted(r.doc_id for r in mixing.mix(left, MIXTURE).filter("kept").collect())
    got = corpus_pipeline.run(spark, SF)
    assert sorted(r.doc_id for r in got.collect()) == want
    assert got.filter("not round_trip").count() == 0
    assert got.columns[: len(docs.columns)] == docs.columns


def test_odd_rows(spark, tmp_path):
    rows = [
        (1, None, "en", "s", 0), (2, "", None, None, None), (3, "the and of with that is", "en", "src0", 1), (3, "the and of with that is", "en", "src0", 1),
        (None, "the and of with", None, "src1", 2), (5, "the and of with this " * 3000, "en", "src0", 1), (6, "the and of\twith that  is", "en", "src0", 1),
    ]
    folder = tmp_path / "odd"
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, kept int").write.parquet(f"{folder}/documents.parquet")
    got = corpus_pipeline.run(spark, str(folder)).collect()
    assert len({r.doc_id for r in got}) == len(got) and {r.doc_id for r in got} <= {None, 5, 6}


def test_empty_table(spark, tmp_path):
    folder = tmp_path / "none"
    spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{folder}/documents.parquet")
    assert corpus_pipeline.run(spark, str(folder)).count() == 0


@pytest.mark.parametrize("stage", range(5))
def test_clashing_names_pass_through(spark, stage):
    """Columns with the names that the stages use themselves."""
    names = ["_id", "_key", "_lang", "_bad", "_cell", "_chance", "_decoded", "_Keep", "kept", "class_id"]
    rows = [(i, t, "en", "src1", *[f"{n}{i}" for n in names]) for i, t in enumerate([
        "the and of with that is in a text", "the and of  with that is in a text", "another text of the kind that is with the others",
        "another text of the kind that is with the others", "the end",
    ])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, " + ", ".join(f"`{n}` string" for n in names))
    got = corpus_pipeline.STAGES[stage][1](spark, docs, SF)
    assert got.columns[: len(docs.columns)] == docs.columns
    out = got.collect()
    assert out and all(r[n] == f"{n}{r.doc_id}" for r in out for n in names)
