from pyspark.sql import functions as F

from haulmark.operators.buckets import BucketTable
from haulmark.sources import customs
from haulmark.streaming import incremental as inc

SCHEMA = "id bigint, key string, value bigint"


def drop(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_append_by_key_over_several_runs(spark, tmp_path):
    src, target, progress = (str(tmp_path / n) for n in ("src", "target", "progress"))
    drop(spark, src, [(1, "a", 1), (2, "b", 2)])
    stream = lambda: inc.file_stream(spark, src, spark.read.parquet(src).schema, files_per_batch=1)
    inc.append_files(stream(), target, keys=["id"], checkpoint=progress, partition_by=["key"], prune="id")
    drop(spark, src, [(2, "b", 9), (3, "a", 3)])
    inc.append_files(stream(), target, keys=["id"], checkpoint=progress, partition_by=["key"], prune="id")
    inc.append_files(stream(), target, keys=["id"], checkpoint=progress, partition_by=["key"], prune="id")
    assert sorted((r.id, r.value) for r in spark.read.parquet(target).collect()) == [(1, 1), (2, 2), (3, 3)]


def test_first_wins_across_batches(spark, tmp_path):
    src, path, progress = (str(tmp_path / n) for n in ("src", "target", "progress"))
    drop(spark, src, [(2, "a", 2), (1, "a", 1)])
    schema = spark.read.parquet(src).schema
    table = BucketTable(spark, path, schema, ["key"], buckets=8)
    run = lambda at=progress: inc.first_wins(inc.file_stream(spark, src, schema, files_per_batch=1), table, order=[F.col("id")], checkpoint=at)
    assert [(w.offered, w.inserted, w.skipped) for w in run()] == [(2, 1, 1)]
    drop(spark, src, [(0, "a", 0), (5, "b", 5)])
    drop(spark, src, [(7, "c", 5), (6, "b", 5)])
    assert sum(w.inserted for w in run()) == 2
    got = sorted((r.key, r.id) for r in table.read().collect())
    assert got[0] == ("a", 1) and {k for k, _ in got} == {"a", "b", "c"} and len(got) == 3
    assert sum(w.inserted for w in run(f"{progress}-replay")) == 0
    assert sorted((r.key, r.id) for r in table.read().collect()) == got


def test_a_batch_reads_the_buckets_of_its_keys(spark, tmp_path):
    """What a batch of few keys touches does not depend on how much the table holds."""
    table = BucketTable(spark, str(tmp_path / "t"), spark.createDataFrame([], SCHEMA).schema, ["key"], buckets=64)
    rows = lambda keys: spark.createDataFrame([(i, f"k{i}", i) for i in keys], SCHEMA)
    for start in range(0, 4000, 1000):
        table.insert_or_ignore(rows(range(start, start + 1000)), order=[F.col("id")])
        done = table.insert_or_ignore(rows([start, 10**6 + start]), order=[F.col("id")])
        assert (done.inserted, done.skipped) == (1, 1) and len(done.buckets) <= 2
    assert table.read().count() == 4004
    assert max(len(table.folders([b])) for b in range(64)) <= 9


def totals_of(spark, src):
    return {r.key: (r.value, r.n) for r in spark.read.parquet(src).groupBy("key").agg(F.sum("value").alias("value"), F.count("*").alias("n")).collect()}


def test_running_totals_equal_batch(spark, tmp_path):
    src, target, progress = (str(tmp_path / n) for n in ("src", "target", "progress"))
    rows = [(i, "abc"[i % 3], i * i) for i in range(90)]
    for k in range(9):
        drop(spark, src, rows[k * 10 : k * 10 + 10])
    stream = inc.file_stream(spark, src, spark.read.parquet(src).schema, files_per_batch=1)
    inc.running_totals(stream, target, keys=["key"], value=F.col("value"), checkpoint=progress)
    assert {r.key: (r.value, r.n) for r in inc.current_totals(spark, target, keys=["key"]).collect()} == totals_of(spark, src)
    # Nine batches: two merged fours and one single version.
    assert len(inc.live_versions(spark, target)) == 3
    drop(spark, src, rows[:5])
    stream = inc.file_stream(spark, src, spark.read.parquet(src).schema, files_per_batch=1)
    inc.running_totals(stream, target, keys=["key"], value=F.col("value"), checkpoint=progress)
    assert {r.key: (r.value, r.n) for r in inc.current_totals(spark, target, keys=["key"]).collect()} == totals_of(spark, src)


def lines_of(folder, name, text):
    (folder / name).write_text(text, encoding="utf-8")


def test_drops_go_to_their_layouts(spark, tmp_path):
    folder, target, progress = tmp_path / "drop", str(tmp_path / "target"), str(tmp_path / "progress")
    folder.mkdir()

    def parse(rows, heads):
        parsed = customs.price_rows(rows, heads=heads)
        return parsed.rows, parsed.rejects.select("file", F.array_join("reasons", "; ").alias("reason"))

    layouts = {"prices": inc.Layout(r"^p_.*\.csv$", parse, ["year", "rank", "product_name"])}
    run = lambda at=progress: inc.ingest_drops(spark, str(folder), target, layouts, checkpoint=at)
    lines_of(folder, "p_1.csv", "year,rank,product_name,price\n2020,1,a,5\n2020,0,b,5\n")
    run()
    lines_of(folder, "p_2.csv", "year,rank,product_name,price\n2020,1,a,9\n2021,1,c,5\n")
    lines_of(folder, "other.txt", "hello\n")
    run()
    stored = lambda: sorted((r.year, r.product_name, r.price_krw) for r in spark.read.parquet(f"{target}/prices").collect())
    assert stored() == [("2020", "a", "5"), ("2021", "c", "5")]
    rejects = lambda: {tuple(r) for r in spark.read.parquet(f"{target}/rejects").select("file", "layout", "reason").collect()}
    want = {("p_1.csv", "prices", "rank invalid"), ("other.txt", "", "no layout has this name")}
    assert rejects() == want
    run(f"{progress}-replay")
    assert len(stored()) == 2 and rejects() == want


def test_bounded_first_within(spark, tmp_path):
    src = str(tmp_path / "src")
    spark.sql("select timestamp'2024-01-01 00:00:00' as ts, 'a' as key union all select timestamp'2024-01-01 00:10:00', 'a'").coalesce(1).write.parquet(src)
    stream = inc.file_stream(spark, src, spark.read.parquet(src).schema)
    out, progress = str(tmp_path / "out"), str(tmp_path / "p")
    q = (
        inc.first_within(stream, keys=["key"], event_time="ts", delay="1 hour")
        .writeStream.format("parquet").option("path", out).option("checkpointLocation", progress).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    assert spark.read.parquet(out).count() == 1
