import struct
import zipfile

import pytest

from strataflow.sources import columns, files, inventory, logs, subsurface, witsml, xlsx


def write_xlsx(path, sheets):
    """A minimal workbook with inline strings; None is a cell that isn't there."""
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(path, "w") as book:
        rel = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
        book.writestr("xl/workbook.xml", f"<workbook {ns} {rel}><sheets>" + "".join(f'<sheet name="S{k}" sheetId="{k + 1}" r:id="rId{k + 1}"/>' for k in range(len(sheets))) + "</sheets></workbook>")
        book.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="rId{k + 1}" Target="worksheets/sheet{k + 1}.xml"/>' for k in range(len(sheets))) + "</Relationships>")
        book.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>shared</t></si><si><r><t>ru</t></r><r><t>ns</t></r></si></sst>")
        for k, rows in enumerate(sheets):
            body = ""
            for n, row in enumerate(rows, 1):
                cells = ""
                for c, value in enumerate(row):
                    if value is None:
                        continue
                    ref = f"{chr(65 + c) if c < 26 else 'A' + chr(65 + c - 26)}{n}"
                    if isinstance(value, tuple):
                        cells += f'<c r="{ref}" t="s"><v>{value[0]}</v></c>'
                    elif isinstance(value, str):
                        cells += f'<c r="{ref}" t="inlineStr"><is><t>{value}</t></is></c>'
                    else:
                        cells += f'<c r="{ref}"><v>{value}</v></c>'
                body += f'<row r="{n}">{cells}</row>'
            book.writestr(f"xl/worksheets/sheet{k + 1}.xml", f"<worksheet {ns}><sheetData>{body}</sheetData></worksheet>")


def test_xlsx_cells(tmp_path):
    write_xlsx(tmp_path / "a.xlsx", [[["First Name", "b"], ["", None], [(0,), (1,)], [None, 3]]])
    raw = (tmp_path / "a.xlsx").read_bytes()
    assert xlsx.sheet_names(raw) == ["S0"]
    assert list(xlsx.sheet_rows(raw, 0)) == [{"first_name": "shared", "b": "runs"}, {"first_name": None, "b": "3"}]


def test_production_workbook(spark, tmp_path):
    daily = [list(map(str.upper, columns.PROD_DAILY))] + [[serial, "NO 15/9-F-4 AH", *["x"] * 22] for serial in (41000, 41001, 41500)]
    monthly = [["Wellbore name", "NPDCode", "Year", "Month", "On Stream", "Oil", "Gas", "Water", "GI", "WI"], [None, None, None, None, "hrs", "Sm3", "Sm3", "Sm3", "Sm3", "Sm3"], ["15/9-F-4", 1, 2012, 4, 700, 5, 6, 7, "NULL", "NULL"], ["15/9-F-4", 1, 2013, 4, 700, 5, 6, 7, "NULL", "NULL"]]
    write_xlsx(tmp_path / "p.xlsx", [daily, monthly])
    out = xlsx.read_prod_daily(spark, str(tmp_path), "2012-04-01", "2012-04-30").collect()
    assert sorted(r._replay_date for r in out) == ["2012-04-01", "2012-04-02"] and out[0]._source_identifier == "NO 15/9-F-4 AH"
    months = xlsx.read_prod_monthly(spark, str(tmp_path), "2012-04-01", "2012-04-30").collect()
    assert [(r.year, r.gi, r._replay_date) for r in months] == [("2012", "NULL", "2012-04-01")]


DDR = """<?xml version="1.0"?><w:drillReports xmlns:w="http://www.witsml.org/schemas/1series" version="1.4">
<w:drillReport><w:nameWell>15/9-F-14</w:nameWell><w:nameWellbore>15/9-F-14 A</w:nameWellbore><w:dTimStart>2016-08-03T00:00:00+02:00</w:dTimStart><w:dTimEnd>2016-08-04T00:00:00+02:00</w:dTimEnd>
<w:wellboreAlias><w:name>6000</w:name><w:namingSystem>NPD number</w:namingSystem></w:wellboreAlias>
<w:activity><w:dTimStart>2016-08-03T00:00:00+02:00</w:dTimStart><w:md uom="m">12.5</w:md><w:comments>one</w:comments></w:activity><w:activity><w:comments>two</w:comments></w:activity></w:drillReport></w:drillReports>"""


def test_daily_reports(spark, tmp_path):
    (tmp_path / "a_2016_08_04.xml").write_text(DDR)
    (tmp_path / "b_2016_08_05.xml").write_text("<drillReports><drillReport><nameWell>W</nameWell></drillReport></drillReports>")
    out = witsml.read_ddr_activity(spark, str(tmp_path)).orderBy("report_date", "activity_seq").collect()
    assert [(r.report_date, r.activity_seq, r.comments, r.activity_md, r.npd_number) for r in out] == [("2016-08-04", "1", "one", "12.5", "6000"), ("2016-08-04", "2", "two", None, "6000"), ("2016-08-05", None, None, None, None)]
    assert out[0].activity_md_uom == "m" and out[0]._source_identifier == "15/9-F-14 A"


def test_html_reports(spark, tmp_path):
    (tmp_path / "r_2016_08_04.html").write_text("<table><tr><td>Wellbore:</td><td>15/9-F-1</td></tr><tr><td>00:00</td><td>drill</td><td>fine</td></tr></table>")
    out = witsml.read_ddr_html(spark, str(tmp_path)).collect()
    assert [(r.name_wellbore, r.comments, r.report_date, r.source_format) for r in out] == [("15/9-F-1", "00:00 | drill | fine", "2016-08-04", "html")]


TRAJECTORY = """<trajectorys xmlns="http://www.witsml.org/schemas/131" version="1.3.1"><trajectory uid="t1" uidWell="w" uidWellbore="b"><nameWell>15/9-X-3</nameWell><nameWellbore>15/9-X-3 A</nameWellbore><dTimTrajStart>2010-01-02T00:00:00Z</dTimTrajStart>
<trajectoryStation uid="s1"><md uom="m">0</md><incl uom="rad">0</incl><azi uom="rad">0</azi></trajectoryStation><trajectoryStation uid="s2"><dTimStn>2010-01-03T00:00:00Z</dTimStn><md uom="m">30</md><incl uom="dega">1.5</incl></trajectoryStation></trajectory></trajectorys>"""


def test_trajectories(spark, tmp_path):
    (tmp_path / "t.xml").write_text(TRAJECTORY)
    out = witsml.read_trajectory_station(spark, str(tmp_path)).orderBy("station_seq").collect()
    assert [(r.station_seq, r.md, r.incl_uom, r._replay_date, r.azi) for r in out] == [("1", "0", "rad", "2010-01-02", "0"), ("2", "30", "dega", "2010-01-03", None)]
    assert out[0].trajectory_uid == "t1" and len(out[0]) == len(columns.TRAJECTORY_STATION) + 3


LOG = """<logs xmlns="http://www.witsml.org/schemas/131" version="1.3.1.1"><log uid="l1"><nameWellbore>15/9-F-1</nameWellbore><name>L</name><indexType>date time</indexType>
<logCurveInfo uid="c1"><mnemonic>TIME</mnemonic></logCurveInfo><logCurveInfo uid="c2"><mnemonic>bit_depth_m</mnemonic><unit>m</unit></logCurveInfo>
<logData><mnemonicList>TIME,bit_depth_m,hole_depth_m</mnemonicList><unitList>s,m</unitList><data>2020-01-01T00:00:00Z,10,11,99</data><data>2020-01-01T00:00:05Z,10.5,11</data></logData></log></logs>"""


def test_logs_become_long_rows_and_samples(spark, tmp_path):
    (tmp_path / "l.xml").write_text(LOG)
    heads = witsml.read_witsml_log_header(spark, str(tmp_path)).orderBy("curve_seq").collect()
    assert [(r.mnemonic, r.unit, r.namespace, r.schema_version) for r in heads] == [("TIME", None, "http://www.witsml.org/schemas/131", "1.3.1.1"), ("bit_depth_m", "m", "http://www.witsml.org/schemas/131", "1.3.1.1")]
    data = witsml.read_witsml_log_data(spark, str(tmp_path))
    assert sorted((r.index_value[-3:-1], r.mnemonic, r.unit, r.value) for r in data.collect()) == [("00", "bit_depth_m", "m", "10"), ("00", "hole_depth_m", None, "11"), ("05", "bit_depth_m", "m", "10.5"), ("05", "hole_depth_m", None, "11")]
    rows = witsml.telemetry_samples(data).orderBy("ts").collect()
    assert [(r.ts, r.bit_depth_m) for r in rows] == [("1577836800000", "10"), ("1577836805000", "10.5")]


def test_messages_and_roots(spark, tmp_path):
    (tmp_path / "m.xml").write_text('<messages xmlns="http://www.witsml.org/schemas/131"><message uid="m"><nameWell>W</nameWell><dTim>2010-05-05T10:00:00+02:00</dTim><md uom="m">5</md><messageText>hi</messageText></message></messages>')
    row = witsml.read_witsml_message(spark, str(tmp_path)).first()
    assert (row.message_text, row.md, row.md_uom, row._replay_date, row.uid_message) == ("hi", "5", "m", "2010-05-05", "m")
    assert [(r.root, r.documents) for r in witsml.survey_document_types(spark, str(tmp_path)).collect()] == [("messages", 1)]


LAS2 = """~Version
VERS. 2.0 : v
WRAP. NO : w
~Well
STRT.M 1 : START
NULL.   -999.25   : NULL
DATE. 00:00:00 09-Jun-08 : START INDEX
UWI . U1 : id
~Curve
DEPT.M : depth
GR.API 45 310 : gamma
~A
1.0 -999.25
2.0 55
"""
LAS3 = """~Version
VERS. 3.0 :
DLM. COMMA :
~Well
WELL. 15/9-F-1 :
~Phase_Definition_RMDATA
DEPT.M : d
RHOB.K/M3 : r
~Phase_data_RMDATA | Phase_Definition_RMDATA
1,2.5
"""


def test_las(spark, tmp_path):
    (tmp_path / "a.las").write_text(LAS2)
    (tmp_path / "b.LAS").write_text(LAS3)
    heads = logs.read_las_curve_header(spark, str(tmp_path)).orderBy("las_version", "curve_index").collect()
    assert [(r.mnemonic, r.unit, r.null_value_declared, r.date_declared) for r in heads[:2]] == [("DEPT", "M", "-999.25", "00:00:00 09-Jun-08"), ("GR", "API", "-999.25", "00:00:00 09-Jun-08")]
    assert heads[0].well_name == "U1" and heads[2].well_name == "15/9-F-1"
    out = logs.read_las_sample(spark, str(tmp_path)).collect()
    assert sorted((r.mnemonic, r.index_value, r.value) for r in out) == [("GR", "1.0", "-999.25"), ("GR", "2.0", "55"), ("RHOB", "1", "2.5")]
    assert {r.mnemonic for r in logs.read_las_sample(spark, str(tmp_path), max_files=1).collect()} == {"RHOB"}


def test_checkshots(spark, tmp_path):
    (tmp_path / "checkshot_15_9_F_1.txt").write_text("Wellname : 15/9-F-1\nContractor : X\nMD TVD TWT\n10 9 5.5\n20 18 11\n")
    (tmp_path / "checkshot_15_9_19A.txt").write_text("Curve Name  TVDBTDD TVD TVDSS Time\nC1 1 2 3 4\n")
    out = {r.well_from_file_name: r for r in subsurface.read_checkshot(spark, str(tmp_path)).orderBy("row_seq").collect()}
    assert (out["15_9_F_1"].md_m, out["15_9_F_1"].layout, out["15_9_F_1"]._source_identifier) == ("20", "header_block", "15/9-F-1")
    assert (out["15_9_19A"].md_m, out["15_9_19A"].tvd_m, out["15_9_19A"].curve_name) == (None, "2", "C1")


@pytest.mark.parametrize("encoding", ["cp037", "ascii"])
def test_segy(spark, tmp_path, encoding):
    text = "C 1 CLIENT X".ljust(80) + "C 2 WELL: 15/9-19".ljust(80)
    raw = text.ljust(3200).encode(encoding) + bytearray(640)
    raw = bytearray(raw)
    struct.pack_into(">h", raw, 3216, 2000)
    struct.pack_into(">i", raw, 3600 + 72, -7)
    (tmp_path / "s.sgy").write_bytes(bytes(raw) + b"\0" * 5000)
    row = subsurface.read_segy_header(spark, str(tmp_path)).first()
    assert (row.sample_interval_us, row.trace1_source_x, row._source_identifier, row.access_mode) == ("2000", "-7", "15/9-19", "prefix")
    assert row.textual_header.startswith("C 1 CLIENT X\nC 2")


def test_balances_keep_blank_columns(spark, tmp_path):
    page = """ECLIPSE VERSION 2011 RUN AT 10:00
 REPORT   3   31 DEC 2007
 BALANCE AT  30.00 DAYS
 PAV = 300.5 BARSA
                          :   LIQUID     VAPOUR      TOTAL  :    TOTAL  :    FREE     DISSOLVED     TOTAL  :
 :CURRENTLY IN PLACE      : 21967455.             21967455. : 1234567.  :    0.        999.         999. :
"""
    (tmp_path / "M.PRT").write_text(page + page.replace("30.00", "60.00"))
    out = subsurface.read_eclipse_balance(spark, str(tmp_path)).orderBy("days_from_start").collect()
    assert [r.days_from_start for r in out] == ["30.00", "60.00"]
    assert (out[0].row_label, out[0].oil_liquid, out[0].oil_vapour, out[0].oil_total, out[0].water_total, out[0].gas_total) == ("CURRENTLY IN PLACE", "21967455.", None, "21967455.", "1234567.", "999.")
    assert out[0].report_date == "2007-12-31" and out[0].pav_bara == "300.5"


def test_geometry(spark, tmp_path):
    (tmp_path / "FAULT_1").write_text("-- north fault\nADDZCORN\n   10.0    0 62  46 0  /\n   -2.5    1 2 /\n")
    out = subsurface.read_fault_records(spark, str(tmp_path)).orderBy("record_seq").collect()
    assert [(r.keyword, r.z_shift, r.index_values, r.comment) for r in out] == [("ADDZCORN", "10.0", "0 62 46 0", "north fault"), ("ADDZCORN", "-2.5", "1 2", "north fault")]
    (tmp_path / "fixed.txt").write_text("# c\nAB  12\n\nCDE 3\n")
    rows = subsurface.parse_fixed_width(spark, str(tmp_path / "fixed.txt"), [("a", 0, 4), ("b", 4, 6)]).collect()
    assert sorted(map(tuple, rows)) == [("AB", "12"), ("CDE", "3")]


def test_decoding():
    assert files.decode_text("﻿å".encode()) == ("å", "utf-8-sig")
    assert files.decode_text("MÆRSK".encode("cp1252")) == ("MÆRSK", "cp1252")


def test_inventory(spark, tmp_path):
    for name, entries in {"a.zip": {"x/log1.las": "1", "x/copy of log1.las": "1", "y/other.bin": "\0"}, "b.zip": {"z/log1.las": "1"}}.items():
        with zipfile.ZipFile(tmp_path / name, "w") as out:
            for entry, text in entries.items():
                out.writestr(entry, text)
    found = inventory.inventory_scan(spark, str(tmp_path))
    kinds = {r.entry: (r.kind, r.confidence) for r in inventory.classify_entries(found).collect()}
    assert kinds["x/log1.las"] == ("LAS", "high") and kinds["y/other.bin"] == (None, "none")
    assert [(r.canonical, r.copies) for r in inventory.group_duplicates(found).collect()] == [("x/log1.las", 3)]
    row = inventory.cross_archive_agreement(found).first()
    assert (row.shared, row.equal, row.corroborated) == (1, 1, False)
    assert inventory.spread_sample(found, ["entry"], 2).count() == 2
    assert inventory.profile_text(b"a;b\r\n2020-01-01;-999.25\r\n")["delimiter"] == ";"


def test_the_driver_hears_nothing_of_each_written_or_listed_file(spark, tmp_path):
    import pickle

    sizes = []
    for n in (10, 1000):
        writer = files._FileWriter(f"file://{tmp_path}/{n}", "_job")
        sizes.append(len(pickle.dumps(writer.write({"name": f"a/{k}.txt", "content": b"x"} for k in range(n)))))
    assert sizes[0] + 10 > sizes[1]
    (tmp_path / "in" / "sub dir").mkdir(parents=True)
    for k in range(40):
        (tmp_path / "in" / ("sub dir" if k % 2 else ".") / f"r{k}_2016_08_04.xml").write_text(DDR)
        (tmp_path / "in" / ("sub dir" if k % 4 == 1 else ".") / f"r{k}_2016_08_04.html").write_text("<table><tr><td>1</td><td>2</td><td>3</td></tr></table>")
    out = witsml.read_reports(spark, str(tmp_path / "in"))
    assert out.inputFiles() == [] and out.groupBy("source_format").count().orderBy("source_format").collect() == [("html", 10), ("xml", 80)]


ODD_XML = {
    "ok": '<a><r uid="1"><n> x </n><m uom="m">5</m><c>1</c><c>2</c></r><r uid="2>"><n>&lt;y</n></r></a>', "cut": '<a><r uid="3"><n>x</n></r><r uid="4"><n>y</n>', "bad": "garbage",
    "tail": '<a><r uid="5"><n>x</n></r></b>', "empty": "", "none": "<a/>", "_hidden": '<a><r uid="9"/></a>', "long": "<a>" + "".join(f'<r uid="{k}"><n>{"é" * 999}</n></r>' for k in range(100)) + "</a>",
    "spaced": '<?xml version="1.0"?><!-- <r> --><p:a xmlns:p="u"><p:r uid="6"><p:n>z<![CDATA[<q>]]></p:n><p:m uom="m"/></p:r><b><p:r/></b></p:a>',
}


def test_odd_documents_are_read_as_by_the_xml_source(spark, tmp_path):
    for name, text in ODD_XML.items():
        (tmp_path / f"{name}.xml").write_text(text, encoding="utf-8")
    schema = "_uid string, n string, m struct<_VALUE: string, _uom: string>, c array<string>"
    own = witsml._xml(spark, str(tmp_path), "r", schema, "*.xml")
    theirs = spark.read.format("xml").option("rowTag", "r").option("ignoreNamespace", "true").schema(schema).load(f"{tmp_path}/*.xml").selectExpr("*", "_metadata.file_name as file")
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(own.selectExpr("_uid", "n", "m", "c", "element_at(split(_source_file, '/'), -1) as file")) == rows(theirs.where("not file like '\\_%'"))


def test_many_small_files_from_one_task_are_written_and_read_by_all(spark, tmp_path):
    folder = f"file://{tmp_path}/out"
    files.write_files(spark.range(0, 300, 1, 1).selectExpr("concat(id % 3, '/', id, '.txt') as name", "cast(cast(id as string) as binary) as content"), folder)
    read = files.binary_files(spark, folder, "*.txt")
    assert read.inputFiles() == [] and read.count() == 300 and read.rdd.getNumPartitions() == 4
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["0", "1", "2"]
    writer = files._FileWriter(folder, "_job")
    own = writer.write([{"name": "3/new.txt", "content": b"new"}]).own
    for _ in range(2):  # a task that is run again finds its files named
        files._name(folder, own)
    assert (tmp_path / "out" / "3" / "new.txt").read_bytes() == b"new"
    writer.abort([])
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["0", "1", "2", "3"]


def test_spread_samples_are_ranked_over_ranges_of_any_number_and_size(spark, tmp_path):
    from strataflow.plans import source_queries

    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1k")
    try:
        make = spark.range(60_000).selectExpr("id as event_id", "timestamp_seconds(id * 7919 % 10007) as ts", "sha2(cast(id as string), 512) as wide")
        make.write.parquet(f"{tmp_path}/events.parquet")
        for n in (7, 50):
            got = inventory.spread_sample(spark.read.parquet(f"{tmp_path}/events.parquet"), ["ts", "event_id"], n).collect()
            ranked = sorted(range(60_000), key=lambda k: (k * 7919 % 10007, k))
            assert sorted(r.event_id for r in got) == sorted(x for k, x in enumerate(ranked) if k * n // 60_000 != (k - 1) * n // 60_000)
        assert sorted(r[0] for r in source_queries.spread_sample(spark, str(tmp_path)).collect()) == sorted(r.event_id for r in got)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
