import pytest
from pyspark.sql import functions as F

from haulmark.operators import catalog, curation, resolve, units, writes
from haulmark.functions import dates, names, text, urls

OBS = "date string, series string, hs_code string, unit string, country string, value int"


def test_append_is_idempotent_and_keeps_batch_repeats(spark):
    stored = spark.createDataFrame([("2024-01", "s", "507.9", "KG", "A", 1)], OBS)
    new = spark.createDataFrame(
        [("2024-01", "s", "0507.90", "KG", "A", 9), ("2024-02", "s", "0507.90", "KG", None, 2), ("2024-02", "s", "0507.90", "KG", "", 3)], OBS
    )
    fresh = writes.append_new(new, stored, keys=writes.OBSERVATION_KEY)
    assert sorted(r.value for r in fresh.collect()) == [2, 3]
    again = writes.append_new(new, stored.union(fresh), keys=writes.OBSERVATION_KEY)
    assert again.count() == 0
    counts = writes.append_counts(new, fresh).first()
    assert (counts.offered, counts.appended, counts.skipped) == (3, 2, 1)


def test_insert_or_ignore_first_arrival(spark):
    stored = spark.createDataFrame([("a", 0, "old")], "k string, seq int, v string")
    batch = spark.createDataFrame([("a", 1, "x"), ("b", 3, "late"), ("b", 2, "first"), ("c", 4, "c")], "k string, seq int, v string")
    got = writes.insert_or_ignore(batch, stored, keys=["k"], order=[F.col("seq")])
    assert sorted((r.k, r.v) for r in got.collect()) == [("b", "first"), ("c", "c")]


def test_upsert_keeps_curation_stamp(spark):
    target = spark.createDataFrame([(1, "t1", "2020"), (2, "t2", "2020")], "ref int, title string, curated_at string")
    updates = spark.createDataFrame([(2, "older", 1), (2, "new", 2), (3, "t3", 3)], "ref int, title string, n int")
    out = writes.upsert(
        target, updates, keys=["ref"], update=["title"], on_insert={"curated_at": F.lit("2024")}, order=[F.col("n")]
    )
    assert sorted(tuple(r) for r in out.rows.collect()) == [(1, "t1", "2020"), (2, "new", "2020"), (3, "t3", "2024")]
    assert {r.action: r.n for r in out.counts.collect()} == {"kept": 1, "updated": 1, "inserted": 1}


def test_second_promotion_is_an_error(spark):
    target = spark.createDataFrame([(7, 70)], "ref int, doc_id int")
    batch = spark.createDataFrame([(7,), (8,)], "ref int")
    with pytest.raises(ValueError, match="7 is already promoted, see row 70"):
        writes.promote_strict(batch, target, key="ref", target_id="doc_id")
    assert writes.promote_strict(batch.filter("ref = 8"), target, key="ref", target_id="doc_id").count() == 1


def test_seed_only_an_empty_target(spark):
    seed = spark.createDataFrame([(1,)], "x int")
    assert writes.seed_if_empty(seed, lambda: seed) is None
    assert writes.seed_if_empty(seed.limit(0), lambda: seed).count() == 1


def test_judgement_is_null_unless_relevant(spark):
    df = spark.createDataFrame([(1, True, "c"), (2, False, "c"), (3, None, "c")], "raw_ref int, relevant boolean, category string")
    got = writes.judged_rows(df, ref="raw_ref", relevant="relevant", fields=["category"], now=F.lit("t")).collect()
    assert [(r.relevant, r.category, r.classified_at) for r in got] == [(True, "c", "t"), (False, None, None), (False, None, None)]


@pytest.mark.parametrize("name", ["Acme Foods Co., Ltd.", "ACME FOODS", " acme foods inc. "])
def test_entity_key_variants(spark, name):
    assert spark.range(1).select(names.entity_key(F.lit(name))).first()[0] == "ACMEFOODS"


def test_entity_key_korean_and_tokens(spark):
    key = lambda s, **k: spark.range(1).select(names.entity_key(F.lit(s), **k)).first()[0]
    assert key("주식회사 가나다") == key("가나다(주)") == key("㈜가나다") == "가나다"
    assert key("Café") == "CAFÉ"
    assert key("Costco") == "STCO".replace("CO", "") == "ST"
    assert key("Costco Co.", token_only=True) == "COSTCO"
    assert key("") == ""


def test_majority_vote(spark):
    df = spark.createDataFrame(
        [(1, "Foo(주)", "B"), (2, "foo", "A"), (3, "FOO", "A"), (4, "bar", " "), (5, "baz", "Y"), (6, "baz", "X")],
        "n int, ko string, en string",
    )
    got = {r.match_key: (r.source_name, r.canonical) for r in resolve.seed_mapping(df, pairs=[("ko", "en")], order=[F.col("n")]).collect()}
    assert got == {"FOO": ("Foo(주)", "A"), "BAZ": ("baz", "Y")}


def test_resolve_branches(spark):
    mapping = spark.createDataFrame([("FOO", "Foo Inc"), ("EMPTY", " ")], "match_key string, canonical string")
    df = spark.createDataFrame(
        [(1, "foo", ""), (2, "nope", None), (3, "", ""), (4, "foo", "kept"), (5, "empty", "")], "id int, ko string, en string"
    )
    out = resolve.resolve_terms(df, [resolve.Gate("ko", "en", mapping, "map")], row_ref="id", table_name="t")
    assert {r.id: r.en for r in out.rows.collect()} == {1: "Foo Inc", 2: None, 3: None, 4: "kept", 5: None}
    assert {r.row_ref: r.reason for r in out.exceptions.collect()} == {"2": "no map match", "5": "blank_mapping in map"}
    off = resolve.resolve_terms(df, [resolve.Gate("ko", "en", None, "map")], row_ref="id", table_name="t")
    assert off.exceptions.count() == 0 and off.rows.count() == 5


def test_mapping_later_row_wins(spark):
    df = spark.createDataFrame([(1, "", "foo", "old"), (2, "FOO", "x", "new"), (3, None, "", "none")], "n int, k string, s string, c string")
    got = resolve.build_mapping(df, source="s", canonical="c", order=[F.col("n")], match_key="k").collect()
    assert [(r.match_key, r.canonical) for r in got] == [("FOO", "new")]


def test_curation_round_trip(spark):
    canonical = spark.createDataFrame([(1, False, False), (2, False, False)], "raw_ref bigint, hidden boolean, manual_override boolean")
    sheet = spark.createDataFrame(
        [("1.0", "TRUE", "", 1), ("1", "no", "1", 2), ("9", "", "", 3), ("", "", "", 4), ("x", "", "", 5)],
        "raw_ref string, hidden string, manual_override string, n int",
    )
    out = curation.pull_flags(canonical, sheet, key="raw_ref", flags=["hidden", "manual_override"], order=[F.col("n")])
    assert sorted(tuple(r) for r in out.rows.collect()) == [(1, False, True), (2, False, False)]
    assert {r.outcome: r.n for r in out.counts.collect()} == {"applied": 2, "skipped_no_match": 1, "skipped_blank_key": 2}
    pushed = curation.push_rows(canonical.select("raw_ref"), sheet, key="raw_ref", blanks=["hidden"])
    assert [tuple(r) for r in pushed.collect()] == [(2, "")]


def test_approval_stamp_and_latest(spark):
    drafts = spark.createDataFrame(
        [(1, "2024-01-07", "d1", "ok"), (2, "2024-01-14", "d2", "ok")], "draft_id bigint, week string, draft_text string, fact_check_status string"
    )
    briefs = spark.createDataFrame([], "draft_id bigint, approved boolean, approved_at string, published_text string, notes string")
    sheet = spark.createDataFrame(
        [("2024-01-07", "TRUE", "", "", ""), ("2024-01-14", "", "", "", "wait"), ("2024-02-01", "TRUE", "", "", "")],
        "week string, approved string, approved_at string, published_text string, notes string",
    )
    synced = curation.sync_approvals(briefs, drafts, sheet, order=[F.col("week")])
    assert sorted((r.draft_id, r.approved, r.approved_at) for r in synced.rows.collect()) == [(1, True, "2024-01-07"), (2, False, None)]
    top = curation.latest_approved(synced.rows, drafts, as_of=F.lit("2024-02-01").cast("date")).first()
    assert (top.week, top.text, top.age_days, top.is_stale) == ("2024-01-07", "d1", 25, True)
    assert curation.latest_approved(briefs, drafts, as_of=F.lit("2024-02-01").cast("date")).count() == 0


def test_schema_drift_and_conform(spark):
    df = spark.createDataFrame([("2024-1", 5, "z")], "date string, value int, extra string")
    issues = {(r.column, r.issue) for r in catalog.schema_drift(spark, df, catalog.OBSERVATIONS).collect()}
    assert {("series", "missing"), ("extra", "unexpected"), ("value", "type")} <= issues
    row = catalog.conform(df, catalog.OBSERVATIONS).first()
    assert row.value == "5" and row.series is None and "extra" not in row.asDict()


def test_unpadded_month_does_not_win_latest(spark):
    df = spark.createDataFrame([("2026-3",), ("2026-12",), (" 2026-9 ",)], "date string")
    assert df.agg(catalog.last_updated(df).alias("x")).first().x == "2026-12"


def test_missing_table_is_empty(spark, tmp_path):
    src = [catalog.Source("a", "t", "s"), catalog.Source("b", "t", "s", "x")]
    tables = catalog.load_tables(spark, {"t": str(tmp_path / "none")}, src, {"t": catalog.OBSERVATIONS})
    assert list(tables) == ["t"] and tables["t"].count() == 0
    with pytest.raises(ValueError):
        catalog.load_tables(spark, {}, [src[0], src[0]], {})


@pytest.mark.parametrize(
    "raw, want",
    [("https://a.b/x", "https://a.b/x"), (" http://a ", "http://a"), ("javascript:alert(1)", None), ("ftp://a/b", None), ("", None), ("plain", None), ("https://", None)],
)
def test_safe_url(spark, raw, want):
    assert spark.range(1).select(urls.safe_url(F.lit(raw))).first()[0] == want


def test_mail_date_keeps_own_zone(spark):
    got = spark.range(1).select(
        dates.mail_date(F.lit("Mon, 01 Jan 2024 00:30:00 +0900")).cast("string"), dates.mail_date(F.lit("yesterday"))
    ).first()
    assert tuple(got) == ("2024-01-01", None)


def test_broken_answer_is_safe(spark):
    got = spark.range(1).select(text.parse_judgement(F.lit("not json"), ["a"], "d").alias("j")).select("j.*").first()
    assert (got.category, got.relevant, got.error) == ("d", False, True)


def test_repeated_keys_never_multiply_rows(spark):
    target = spark.createDataFrame([(1, " "), (2, "kept")], "k int, v string")
    values = spark.createDataFrame([(1, "second", 2), (1, "first", 1), (2, "other", 1)], "k int, v string, seq int")
    got = resolve.fill_blank(target, values, keys=["k"], columns=["v"], order=[F.col("seq")])
    assert sorted(map(tuple, got.collect())) == [(1, "first"), (2, "kept")]

    stuck = spark.createDataFrame([(1, True, None, None)], "ref int, relevant boolean, category string, classified_at string")
    answers = spark.createDataFrame([(1, "later", 2), (1, "first", 1)], "ref int, category string, seq int")
    got = writes.repair_stuck(stuck, answers, ref="ref", fields=["category"], now=F.lit("now"), order=[F.col("seq")])
    assert [tuple(r) for r in got.collect()] == [(1, True, "first", "now")]

    drafts = spark.createDataFrame([], "week string")
    rows = spark.createDataFrame([("w1", "zulu first", "", 1), ("w1", "alpha second", "", 2)], "week string, text string, status string, seq int")
    got = curation.rehydrate(drafts, rows, week="week", text="text", status="status", now=F.lit("n"), order=[F.col("seq")])
    assert [(r.week, r.text, r.status) for r in got.collect()] == [("w1", "zulu first", "ok")]


def test_push_reads_keys_as_the_pull_does(spark):
    have = spark.createDataFrame([("12.0",), ("text",), ("",)], "ref string")
    items = spark.createDataFrame([(12,), (13,)], "ref bigint")
    assert [r.ref for r in curation.push_rows(items, have, key="ref", numeric=True).collect()] == [13]


def test_a_corrupt_table_is_an_error(spark, tmp_path):
    bad = tmp_path / "bad.parquet"
    bad.write_bytes(b"PAR1 not a table PAR1")
    src = [catalog.Source("a", "t", "s")]
    with pytest.raises(Exception, match="(?i)footer|parquet"):
        catalog.load_tables(spark, {"t": str(bad)}, src, {"t": catalog.OBSERVATIONS})["t"].count()


def test_latest_point_of_each_key(spark):
    rows = [(k, "X", m, "frozen", u, v) for k, m in (("a", "2024-01"), ("a", "2024-02"), ("b", "2023-05")) for u, v in (("KG", 10.0), ("USD", 5.0))]
    obs = spark.createDataFrame(rows, "series string, country string, month string, form string, unit string, value double")
    got = units.origin_price(obs, origin=("country", "X"), value_unit="USD", keys=["series"])
    assert sorted((r.series, r.month, r.is_latest) for r in got.collect()) == [("a", "2024-01", False), ("a", "2024-02", True), ("b", "2023-05", True)]


def test_record_store_resolves_a_new_row_once(spark, rows, tmp_path):
    from haulmark.operators import records, resolve

    rec = spark.createDataFrame(
        [(1, "2024-01-01", "a", ""), (2, "2024-01-02", "b", ""), (3, "2024-01-03", "c", "given")], "id int, date string, local string, en string"
    )
    mapping = spark.createDataFrame([("A", "Alpha")], "match_key string, canonical string")
    store = records.RecordStore(spark, str(tmp_path / "store"), rec.schema, keys=["date", "local"], raw=["local", "en"], row_ref="id", name="t")
    gates = [resolve.Gate("local", "en", mapping, "m")]
    late = F.col("date") >= "2024-01-02"
    assert store.ingest(rec.filter("id < 3"), gates, now=F.lit("now")) == (2, 2, 0)
    assert store.ingest(rec.filter(late), gates, now=F.lit("now"), scope=late) == (2, 1, 1)
    assert rows(store.read("records")) == [(1, "2024-01-01", "a", "Alpha"), (2, "2024-01-02", "b", None), (3, "2024-01-03", "c", "given")]
    assert rows(store.read("raw")) == [("a", "", "now"), ("b", "", "now"), ("c", "given", "now")]
    assert rows(store.read("exceptions")) == [("t", "2", "en", "b", "B", "no m match", "now")]
    # The rows of a run are stored with what is resolved and what is open, so no output joins the mapping again.
    assert "_flags" in spark.read.parquet(str(tmp_path / "store" / "run=000000000001" / "new")).columns
