import random

import pytest
from pyspark.sql import functions as F

from haulmark.operators import buckets
from haulmark.operators.buckets import BucketTable

SCHEMA = "ref bigint, title string, stamp string"


def frame(spark, rows):
    return spark.createDataFrame(rows, "ref bigint, title string, n int")


def table(spark, path, n=16):
    return BucketTable(spark, str(path), spark.createDataFrame([], SCHEMA).schema, ["ref"], buckets=n)


def contents(t):
    return {r.ref: (r.title, r.stamp) for r in t.read().collect()}


def load(spark, t, refs):
    return t.upsert(frame(spark, [(r, f"t{r}", 1) for r in refs]), update=["title"], order=[F.col("n")], on_insert={"stamp": F.lit("first")})


def test_upserts_equal_a_dictionary(spark, tmp_path):
    rng, t, want = random.Random(3), table(spark, tmp_path / "t"), {}
    for turn in range(4):
        rows = [(rng.randrange(60), f"v{turn}-{i}", i) for i in range(rng.choice([1, 30]))]
        last = {ref: title for ref, title, _ in rows}
        done = t.upsert(frame(spark, rows), update=["title"], order=[F.col("n")], on_insert={"stamp": F.lit(str(turn))})
        assert (done.inserted, done.updated) == (len(last.keys() - want.keys()), len(last.keys() & want.keys()))
        want |= {ref: (title, want.get(ref, ("", str(turn)))[1]) for ref, title in last.items()}
        assert contents(t) == want
    t.vacuum()
    assert contents(t) == want and contents(table(spark, tmp_path / "t", n=99)) == want


def test_only_touched_buckets_are_read_and_written(spark, tmp_path):
    t = table(spark, tmp_path / "t", n=32)
    load(spark, t, range(2000))
    before = {b: t.folders([b]) for b in range(32)}
    done = t.upsert(frame(spark, [(7, "new", 1)]), update=["title"], order=[F.col("n")])
    assert (done.inserted, done.updated, len(done.buckets)) == (0, 1, 1)
    changed = [b for b in range(32) if t.folders([b]) != before[b]]
    assert changed == done.buckets
    files = t.read(done.buckets).inputFiles()
    assert all(f"bucket={done.buckets[0]}/" in f for f in files) and t.read().count() == 2000


def test_a_failed_run_leaves_the_table(spark, tmp_path, monkeypatch):
    t = table(spark, tmp_path / "t")
    load(spark, t, range(10))
    want = contents(t)

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(buckets.Manifest, "commit", broken)
        with pytest.raises(RuntimeError, match="lost"):
            load(spark, t, range(5, 20))
    assert contents(t) == want
    load(spark, t, range(5, 20))
    assert set(contents(t)) == set(range(20))


def test_a_second_writer_is_refused(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    load(spark, t, [1])
    with pytest.raises(RuntimeError, match="another writer"):
        t.manifest.commit(1, {})


def test_nothing_to_write(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    assert load(spark, t, []) == (0, 0, 0, []) and t.insert_or_ignore(t.read(), order=[F.col("ref")]).skipped == 0
    assert t.read().count() == 0
