import pytest
from pyspark.sql import functions as F

from haulmark.operators import catalog
from haulmark.sources import customs, files, grids, lines, news, sinks, wide


def write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


WIDE = "\n".join(
    [
        "Exports,,,,,,,,",
        '"","China, People\'s Republic of",,,,"Korea, Republic of",,,',
        '" ",Horn; frozen,,Horn; dried,,Unheard of,,"Horn, other than frozen or dried",',
        '" ",Quantity,Free on board,Quantity,Free on board,Quantity,Free on board,Free on board,Quantity',
        '2021M01,"1,000",50,3,4,5,6,7,8',
        ",,,,,,,,",
        "2021M02,2",
        "2021M03,0,0,0,0,0,0,0,0",
        "2021M04,1,1,1,1,1,1,1,1",
        "Source: statistics office,,,,,,,,",
        "2021M05,9,9,9,9,9,9,9,9",
    ]
)


def test_wide_file(spark, tmp_path):
    write(tmp_path / "a.csv", WIDE)
    got = wide.wide_to_long(lines.read_lines(spark, str(tmp_path)), series="s", value_unit="NZD").collect()
    assert {(r.country, r.product_type) for r in got} == {("China", "frozen"), ("China", "dried")}
    assert {r.date for r in got} == {"2021-01", "2021-02", "2021-03", "2021-04"}
    value = {(r.date, r.product_type, r.unit): r.value for r in got}
    assert value[("2021-01", "frozen", "KG")] == 1000.0 and value[("2021-01", "frozen", "NZD")] == 50.0
    assert value[("2021-02", "frozen", "KG")] == 2.0 and value[("2021-02", "dried", "NZD")] == 0.0
    assert value[("2021-03", "dried", "KG")] == 0.0 and len(got) == 16
    flags = {r.date: r.notes for r in got}
    assert flags["2021-01"] == "source: a.csv | provisional: False" and flags["2021-02"].endswith("True")


def test_few_months_are_all_provisional(spark, tmp_path):
    write(tmp_path / "b.csv", "\n".join(WIDE.split("\n")[:5]))
    got = wide.wide_to_long(lines.read_lines(spark, str(tmp_path)), series="s", value_unit="NZD").collect()
    assert got and all(r.notes.endswith("True") for r in got)


def test_customs_file(spark, tmp_path):
    head = "﻿기간,국가,HS코드,품목명,수출 중량,수출 금액,수입 중량,수입 금액,무역수지"
    body = [
        '2024-01,"갑국",0507901110,a,0,0,"1,234.9",10,0',
        "2024-01,총계,0507901110,a,0,0,9,9,0",
        "2024-01,,0507901110,a,0,0,9,9,0",
        "2024-01,을국,0507901190,b,0,0,0,0,0",
        "2024-01,을국,0507901190,b,0,0,x,1,0",
        "2024-02,을국,0507901190,b,0,0,5,,0",
        "2024-02,병국,1234,b,0,0,5,1,0",
    ]
    write(tmp_path / "ok.csv", "\r\n".join([head, *body]))
    write(tmp_path / "bad.csv", "기간,국가\n2024-01,갑국")
    out = customs.customs_csv(lines.read_lines(spark, str(tmp_path)), series="k")
    got = sorted((r.date, r.country, r.hs_code, r.product_type, r.unit, r.value) for r in out.rows.collect())
    assert got == sorted(
        [
            ("2024-01", "갑국", "0507.90", "frozen", "KG", 1234.0),
            ("2024-01", "갑국", "0507.90", "frozen", "USD_thousands", 10.0),
            ("2024-02", "을국", "0507.90", "dried", "KG", 5.0),
            ("2024-02", "을국", "0507.90", "dried", "USD_thousands", 0.0),
            ("2024-02", "병국", "1234", "other", "KG", 5.0),
            ("2024-02", "병국", "1234", "other", "USD_thousands", 1.0),
        ]
    )
    reject = out.rejects.first()
    assert reject.file == "bad.csv" and "수입 중량" in reject.missing


def test_json_shapes(spark):
    item = '{"cntyNm": " A ", "imp_cur_mon_wgt": 5.9, "imp_cur_mon_usd": "1"}'
    idle = '{"cntyNm": "B", "imp_cur_mon_wgt": 0, "imp_cur_mon_usd": 0}'
    odd = '{"cntyNm": "C", "imp_cur_mon_wgt": "x", "imp_cur_mon_usd": 0}'
    bodies = [
        f'{{"items": [{item}, {idle}, {odd}]}}',
        f'{{"response": {{"body": {{"items": {{"item": {item}}}}}}}}}',
        f'{{"response": {{"body": {{"items": {{"item": [{item}]}}}}}}}}',
        '{"items": ""}',
        "{}",
        "broken",
    ]
    df = spark.createDataFrame([(b, "2024-01", "0507901190") for b in bodies], "body string, p string, c string")
    got = customs.customs_json(df, body="body", period="p", code="c", series="k", labels={"x": "y"})
    assert sorted((r.country, r.unit, r.value) for r in got.collect()) == [("A", "KG", 5.0)] * 3 + [("A", "USD_thousands", 1.0)] * 3


def test_xml_result_code(spark):
    def page(code, items):
        return f"<response><header><resultCode>{code}</resultCode></header><body><items>{items}</items></body></response>"

    item = "<item><year>2024.01</year><statCdCntnKor1></statCdCntnKor1><impWgt>20</impWgt><impDlr>2879659</impDlr></item>"
    total = "<item><year>총계</year><impWgt>1</impWgt><impDlr>1</impDlr></item>"
    plain = "<item><year>2024</year><impWgt>1</impWgt><impDlr>1</impDlr></item>"
    df = spark.createDataFrame(
        [(page("00", total + item + plain), "NZ", "0507901110"), (page("30", item), "NZ", "0507901110"), ("<oops", "NZ", "0507901110")],
        "body string, cc string, code string",
    )
    got = customs.customs_xml(df, body="body", country_code="cc", code="code", series="k", labels={"x": "y"}, countries={"NZ": "Land"})
    assert sorted((r.date, r.country, r.unit, r.value) for r in got.collect()) == [
        ("2024-01", "Land", "KG", 20.0),
        ("2024-01", "Land", "USD_thousands", 2879.659),
    ]


@pytest.mark.parametrize("encoding", ["utf-8-sig", "utf-8", "cp949"])
def test_ranking_encodings_and_rejects(spark, tmp_path, encoding):
    text = "연 도,순위,제품명,가격(원),비고\n2023,1,가나,\"1,500\",ok\n1999,1,x,1,\n2023,0,x,1,\n2023,2, ,1,\n2023,3,x,abc,\n2023,4,y,2.5,"
    write(tmp_path / "p.csv", text, encoding)
    raw = spark.read.format("binaryFile").load(str(tmp_path)).select(F.col("path").alias("file"), "content")
    out = customs.price_rows(lines.decode_lines(raw))
    assert sorted((r.year, r.rank, r.product_name, r.price_krw) for r in out.rows.collect()) == [
        ("2023", "1", "가나", "1500"),
        ("2023", "4", "y", "2.5"),
    ]
    assert sorted(r.reasons[0] for r in out.rejects.collect()) == ["price_krw invalid", "product_name is empty", "rank invalid", "year invalid"]


HTML = """

<html><table><tr><td>layout <table><tr><td>a</td></tr></table></td></tr></table>
<table><tr><td colspan=4>title</td></tr>
<tr><th>국 가</th><th>품 명</th><th>건 수</th><th>중량(kg/ea)</th></tr>
<tr><td rowspan=2>갑국</td><td>녹용</td><td>1,0</td><td>-</td></tr>
<tr><td></td><td>생녹용</td><td>-5</td><td>2.5</td></tr>
<tr><td></td><td>품명계</td><td>9</td><td>9</td></tr>
<tr><td>을국</td><td>녹용</td><td>0</td><td>-</td></tr>
<tr><td>총 계</td><td>x</td><td>9</td><td>9</td></tr></table></html>"""


def test_monthly_html_table(spark):
    df = spark.createDataFrame([("Q_2026-01_IMPORT.xls", HTML)], "file string, html string")
    grid = grids.rows_from_html(df)
    assert grid.filter("table_no = 0").count() == 1
    got = grids.monthly_grid(grid, series=files.series_of(F.col("file"), "q", "q_export"), period=files.period_of(F.col("file")))
    assert sorted((r.date, r.country, r.unit, r.value) for r in got.collect()) == [
        ("2026-01", "갑국", "KG", 0.0),
        ("2026-01", "갑국", "KG", 2.5),
        ("2026-01", "갑국", "shipments", -5.0),
        ("2026-01", "갑국", "shipments", 10.0),
    ]


def as_grid(spark, file, table):
    return spark.createDataFrame([(file, 0, r, line) for r, line in enumerate(table)], "file string, table_no int, row_no bigint, cells array<string>")


def test_rows_from_single_cells(spark):
    cells = [("f", 0, 1, 2, "c"), ("f", 0, 1, 0, "a"), ("f", 1, 0, 0, "x")]
    got = grids.grid_rows(spark.createDataFrame(cells, "file string, table_no int, row_no int, col_no int, cell string"))
    assert sorted(map(tuple, got.collect())) == [("f", 0, 1, ["a", "", "c"]), ("f", 1, 0, ["x"])]


def test_records_pass_no_exchange(spark):
    """From the reader to the record: headings are broadcast, lines stay where they are."""
    sheet = as_grid(spark, "o.xlsx", [["처리일자", "수입업체", "제품명(한글)"], ["20240105", "갑상사", "건강차"]])
    plan = grids.portal_records(sheet)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_headings_are_looked_up_and_dates_parsed_once_a_line(spark):
    sheet = as_grid(spark, "o.xlsx", [["처리일자", "수입업체", "제품명(한글)"], ["20240105", "갑상사", "건강차"]])
    plan = grids.portal_records(sheet)._jdf.queryExecution().optimizedPlan().toString()
    # Two formats for each of the two dates.
    assert plan.count("gettimestamp") <= 4


def test_layouts_scan_the_facts_once(spark):
    from haulmark.plans import layouts

    lines = layouts.customs_lines(spark, "/root/testdata/sf0.001")
    assert not any("lineitem" in path for path in lines.inputFiles())


def test_the_last_of_equal_headings_counts(spark):
    sheet = as_grid(spark, "a", [["k", "k", "v"], ["1", "2", "3"], ["4"]])
    got = sorted(r.cells["k"] for r in grids.header_records(sheet, required=["k", "v"])[0].collect())
    assert got == ["", "2"]


def test_lines_have_byte_positions_in_every_split(spark, tmp_path):
    texts = {"a.csv": "\ufeffhead\r\n가나,1\n\nlast", "b.csv": "", "c.csv": "x" * 50 + "\n" + "y\n" * 20}
    for name, text in texts.items():
        write(tmp_path / name, text)
    want = []
    for name, text in texts.items():
        at = 0
        for line in text.encode().split(b"\n")[: None if not text.endswith("\n") and text else -1]:
            want.append((name, at, line.decode().removeprefix("\ufeff").removesuffix("\r")))
            at += len(line) + 1
    for block in (1, 7, 1000):
        assert sorted(map(tuple, lines.read_lines(spark, str(tmp_path), block_bytes=block).collect())) == sorted(want)
    heads = sorted(map(tuple, lines.read_heads(spark, str(tmp_path), 2).collect()))
    assert heads == sorted(w for name in texts for w in [w for w in want if w[0] == name][:2])


def test_positions_run_on_through_parts(spark, tmp_path):
    rows = [("r s.csv", i, f"line {i:03d}") for i in range(100)]
    df = spark.createDataFrame(rows, "file string, pos int, text string").repartitionByRange(4, "pos").sortWithinPartitions("pos")
    df.select("file", "text").write.partitionBy("file").text(str(tmp_path / "out"))
    got = sorted(map(tuple, lines.read_lines(spark, str(tmp_path / "out"), block_bytes=100).collect()))
    assert got == [("r s.csv", 9 * i, f"line {i:03d}") for i in range(100)]
    assert [r.pos for r in lines.read_heads(spark, str(tmp_path / "out"), 30).orderBy("pos").collect()] == [9 * i for i in range(30)]


def test_annual_sheet(spark):
    table = [
        ["title"],
        ["품목명", "품 명", "국가명", "2024.01", "", "2024.02", ""],
        ["", "", "", "건수", "수량", "건수", "수량"],
        ["축산물", "녹용", "갑국", "3", "1,000", "0", "-"],
        ["", "", "을국", "1", "2", "3", "4"],
        ["", "", "국가계", "9", "9", "9", "9"],
        [""],
        ["", "생녹용", "갑국", "5", "6", "", ""],
        ["", "녹각", "갑국", "7", "7", "7", "7"],
    ]
    got = grids.annual_grid(as_grid(spark, "s.xlsx", table), series=F.lit("q")).collect()
    assert sorted((r.date, r.country, r.product_type, r.unit, r.value) for r in got if r.unit == "KG") == [
        ("2024-01", "갑국", "dried", "KG", 1000.0),
        ("2024-01", "갑국", "frozen", "KG", 6.0),
        ("2024-01", "을국", "dried", "KG", 2.0),
        ("2024-02", "을국", "dried", "KG", 4.0),
    ]
    assert len(got) == 8


def test_portal_old_and_new_names(spark):
    old = as_grid(spark, "o.xlsx", [["조회"], ["처리일자", "수입업체", "제품명(한글)", "품목류", "유통기한", "신고번호"], ["20240105", " 갑상사 ", "건강차", "음료", "-", "77"]])
    new = as_grid(spark, "n.xlsx", [["처리일자", "수입업체", "제품명(한글)", "품목(유형)", "소비기한"], ["2026-07-01", "을상사", "분말", "가공", "20270101"]])
    bad = as_grid(spark, "b.xlsx", [["처리일자", "수입업체"], ["20240101", "x"]])
    got = {r.importer_ko: r for r in grids.portal_records(old.union(new).union(bad)).collect()}
    assert set(got) == {"갑상사", "을상사"}
    a, b = got["갑상사"], got["을상사"]
    assert (a.date, a.year, a.month, a.day, a.product_type_ko, a.expiry_date, a.notes, a.importer) == ("2024-01-05", "2024", "01", "05", "음료", "", "신고번호=77", "갑상사")
    assert (b.product_type_ko, b.expiry_date, b.notes) == ("가공", "2027-01-01", "")
    _, unusable = grids.header_records(bad, required=grids.PORTAL_REQUIRED)
    assert [r.file for r in unusable.collect()] == ["b.xlsx"]


def test_sheet_format(spark, tmp_path):
    rows = [("a.XLS", b"\n\n <html>"), ("a.xls", b"\xd0\xcf<"), ("a.xlsx", b"PK"), ("a.csv", b"<"), ("b.xls", b" " * 70 + b"<")]
    df = spark.createDataFrame(rows, "name string, content binary")
    assert [r[0] for r in df.select(files.sheet_format(F.col("name"), F.col("content"))).collect()] == ["html", None, "workbook", None, None]


def test_file_names(spark):
    rows = [("Q_2026-01_X.xls", "", "수입식품조회20260101.xlsx"), ("Q_2024_EXPORT.xlsx", "application/pdf", "수입식품조회20260101.xlsx"), ("plain", None, "list.xlsx")]
    df = spark.createDataFrame(rows, "n string, m string, v string")
    got = df.select(
        files.period_of(F.col("n")), files.series_of(F.col("n"), "s", "s_export"), files.file_type(F.col("m"), F.col("n")),
        files.record_layout(files.composed(F.col("v"))),
    ).collect()
    assert [tuple(r) for r in got] == [
        ("2026-01", "s", "xls", "portal"), ("2024", "s_export", "pdf", "portal"), ("", "s", "unknown", "historical"),
    ]


def test_keywords_fall_back_to_default(spark):
    empty = spark.createDataFrame([(" ",)], "term string")
    assert [r.term for r in news.keywords(empty, ["a", "b"], limit=1).collect()] == ["a"]


def test_annual_statistics(spark):
    got = customs.annual_statistics(spark, {2023: 5, 2024: 6}, {(2024, "A"): 2}, series="y", code="1", label="l", note="n")
    assert sorted((r.date, r.series, r.country, r.value) for r in got.collect()) == [
        ("2023-01", "y", "all origins", 5.0), ("2024-01", "y", "all origins", 6.0), ("2024-01", "y_country", "A", 2.0),
    ]


def read_all(path):
    return [p.read_text(encoding="utf-8") for p in sorted(path.glob("part-*"))]


def test_csv_has_a_header_even_when_empty(spark, tmp_path):
    df = spark.createDataFrame([('say "hi", x', None)], "a string, b string")
    sinks.export_csv(df, str(tmp_path / "x"), excel=True, files=1)
    assert read_all(tmp_path / "x") == ['﻿a,b\n"say ""hi"", x",\n']
    sinks.export_csv(df.filter("a = 'none'"), str(tmp_path / "y"), files=1)
    assert read_all(tmp_path / "y") == ["a,b\n"]


def test_export_all_counts_and_refuses_nothing(spark, tmp_path):
    df = spark.range(5)
    counts = sinks.export_all({"a": df, "b": df.limit(0)}, str(tmp_path / "e"))
    assert {r.table: r.n_rows for r in counts.collect()} == {"a": 5, "b": 0}
    with pytest.raises(ValueError):
        sinks.export_all({"b": df.limit(0)}, str(tmp_path / "f"))


def test_partitioned_append_prunes(spark, tmp_path):
    path = str(tmp_path / "obs")
    df = spark.createDataFrame([("F", 1), ("O", 2)], "series string, v int")
    sinks.append_partitioned(df, path, by=["series"])
    sinks.append_partitioned(df, path, by=["series"])
    plan = spark.read.parquet(path).filter("series = 'F'")
    assert plan.count() == 2 and "PartitionFilters: [isnotnull(series" in plan._jdf.queryExecution().toString()


def test_sections(spark):
    df = spark.createDataFrame([("a", "2024-1"), ("b", "2024-12")], "series string, date string")
    src = [catalog.Source("x", "t", "s", "a"), catalog.Source("y", "t", "s", "b", enabled=False)]
    rows = catalog.section_rows({"t": df}, src, "s")
    assert [r.series for r in rows.collect()] == ["a"]
    assert catalog.section_rows({"t": df}, src, "none") is None
    status = catalog.section_status({"s": rows}).first()
    assert (status.n_rows, status.last_updated, status.has_data) == (1, "2024-01", True)
    assert [r.series for r in catalog.unassigned_series(df, src, "t").collect()] == ["b"]


def test_fixed_values_drive_the_operators(spark):
    from haulmark.functions import names, text, vocabulary as v

    df = spark.createDataFrame([("최신 뉴스 보여줘",), ("How much was EXPORTED?",), ("hello",)], "q string")
    assert [r[0] for r in df.select(names.first_rule(F.col("q"), v.QUESTION_ROUTES)).collect()] == ["news_summary", "trade_flow", None]
    answer = F.lit('{"category": "무역시장", "include_on_site": true}')
    got = spark.range(1).select(text.parse_judgement(answer, list(v.CATEGORY_LABELS), v.DEFAULT_CATEGORY).alias("j")).select("j.*").first()
    assert (got.category, got.relevant, got.english_title) == ("무역시장", True, "")
    rows = customs.annual_statistics(spark, v.YEARLY_TOTALS, v.YEARLY_BY_COUNTRY, series="annual", code="0507.90", label="l", note="n")
    assert rows.count() == 24 and rows.agg(F.sum("value")).first()[0] == sum(v.YEARLY_TOTALS.values()) + 28026
