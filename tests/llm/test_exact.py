"""Exact copies against a dictionary of normalised texts."""

import hashlib
import re

import pytest

from haulmark.llm import exact

SCHEMA = "doc_id bigint, text string, keep_id string, kept int"


def brute(rows):
    groups = {}
    for i, text, *_ in rows:
        text = text or ""
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text), []).append((-len(text), i))
    out = []
    for i, text, *_ in rows:
        flat = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        keep = min(groups[flat])[1]
        out.append((i, keep, len(groups[flat]), i == keep, hashlib.sha256(flat.encode()).hexdigest()))
    return sorted(out)


LONG = "The one sentence that repeats. " * 700
ROWS = [
    (1, "a b c"), (2, "abc"), (3, "a\tb\n c "), (4, "a b c"), (5, None), (6, ""), (7, " \n"),
    (8, LONG), (9, LONG.replace(" ", "\n")), (10, LONG + "x"), (11, "x" * 5000), (12, "x" * 4999 + "y"),
    (13, "日本語。" * 300), (14, "日本 語。" * 300), (15, "abd"),
]


@pytest.mark.parametrize("bits", [64, 4])
def test_equals_brute_force(spark, bits):
    docs = spark.createDataFrame([(i, t, "z", 0) for i, t in ROWS], SCHEMA)
    got = exact.copies(docs, bits=bits).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted(map(tuple, got)) == brute(ROWS)


def test_repeated_rows_and_null_ids(spark):
    docs = spark.createDataFrame([(1, "a", "", 0), (1, "a", "", 0), (None, "a", "", 0), (None, "b", "", 0)], SCHEMA)
    got = exact.copies(docs).collect()
    assert len(got) == 4
    assert sum(r.kept for r in got) == 2
    assert {r.keep_id for r in got if r.group_size == 3} == {1}


def test_empty_table(spark):
    assert exact.copies(spark.createDataFrame([], SCHEMA)).count() == 0


def test_hot_group_keeps_every_row(spark):
    rows = [(i, "same text", "", 0) for i in range(3000)] + [(5000, "other", "", 0)]
    got = exact.copies(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 3001
    assert {r.group_size for r in got} == {3000, 1}
    assert sum(r.kept for r in got) == 2


def test_chunks_are_stored_only_where_a_fingerprint_is_shared(spark, monkeypatch):
    written = {}
    keep = exact.job.__globals__["Stages"].keep
    monkeypatch.setattr("haulmark.session.Stages.keep", lambda self, name, df: written.setdefault(name, df.columns) and keep(self, name, df))
    docs = spark.createDataFrame([(i, t, "z", 0) for i, t in ROWS], SCHEMA)
    exact.copies(docs)
    assert "chunks" not in written["recipes"]
    written.clear()
    exact.copies(docs, bits=4)
    assert "chunks" in written["recipes"]
