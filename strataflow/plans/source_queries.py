"""Queries of readers, sinks and streams: files written from the driver's tables, read back, and held against SQL on the tables.

Files are made by tasks, one per group of rows, and written whole into the shared folder. Text files
come from SQL expressions; workbooks, seismic files and archives, which are binary, from Arrow groups.
"""

from __future__ import annotations

import io
import zipfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.plans import bronze, scratch
from strataflow.plans.queries import DAILY, REPORTED, STATIONS, daily_bronze, events, monthly_bronze, query, stations, table
from strataflow.sources import columns, files, inventory, logs, subsurface, witsml, xlsx


def _text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _join(*parts: Column | str) -> Column:
    """Concatenation in which strings stand for themselves and nulls are blank."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(_text(p), F.lit("")) for p in parts])


def _bodies(lines: DataFrame, by: list[str], order: list[str], line: Column, end: str = "\n") -> DataFrame:
    """(by, body): the lines of each group in order, as one text."""
    listed = F.array_sort(F.collect_list(F.struct(*order, line.alias("_line"))))
    return lines.groupBy(*by).agg(F.array_join(F.transform(listed, lambda x: x["_line"]), end).alias("body"))


def _put(spark: SparkSession, name: str, made: DataFrame, path: Column, text: Column) -> str:
    folder = scratch.fresh_path(spark, name)
    files.write_files(made.select(path.alias("name"), text.cast("binary").alias("content")), folder)
    return folder


_NAME = "element_at(split(_source_file, '/'), -1)"


# ---------------------------------------------------------------- workbooks

_NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def _sheet(rows: list[list]) -> str:
    """Cells of a worksheet: texts inline, pairs as shared strings by number, nulls left out."""
    out = []
    for n, row in enumerate(rows, 1):
        cells = []
        for k, value in enumerate(row):
            at = f'r="{chr(65 + k) if k < 26 else "A" + chr(39 + k)}{n}"'
            if isinstance(value, int):
                cells.append(f'<c {at} t="s"><v>{value}</v></c>')
            elif value is not None:
                cells.append(f'<c {at} t="inlineStr"><is><t>{value}</t></is></c>')
        out.append(f'<row r="{n}">{"".join(cells)}</row>')
    return f"<worksheet {_NS}><sheetData>{''.join(out)}</sheetData></worksheet>"


def _workbook(sheets: list[list[list]], shared: list[str]) -> bytes:
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as book:
        tags = "".join(f'<sheet name="S{k}" sheetId="{k}" r:id="rId{k}"/>' for k in range(1, len(sheets) + 1))
        book.writestr("xl/workbook.xml", f'<workbook {_NS} xmlns:r="{_REL}"><sheets>{tags}</sheets></workbook>')
        rels = "".join(f'<Relationship Id="rId{k}" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(sheets) + 1))
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{rels}</Relationships>')
        book.writestr("xl/sharedStrings.xml", f"<sst {_NS}>{''.join(f'<si><r><t>{x[:2]}</t></r><r><t>{x[2:]}</t></r></si>' for x in shared)}</sst>")
        for k, rows in enumerate(sheets, 1):
            book.writestr(f"xl/worksheets/sheet{k}.xml", _sheet(rows))
    return raw.getvalue()


def workbooks(spark: SparkSession, sf_dir: str) -> str:
    """A workbook per wellbore: its days on the first sheet, its months below a row of units on the second, blank rows between."""
    daily = daily_bronze(spark, sf_dir).where("_batch_id = 'batch-1'")
    missing = F.lit(None).cast("string")
    daily = daily.select(F.col("_source_identifier").alias("_well"), *[F.col(c) if c in daily.columns else missing.alias(c) for c in columns.PROD_DAILY])
    monthly = monthly_bronze(spark, sf_dir).select(F.col("_source_identifier").alias("_well"), *columns.PROD_MONTHLY)

    def make(days: pa.Table, months: pa.Table) -> pa.Table:
        kinds = ["injection", "production"]
        first = [[c.replace("_", " ").title() for c in columns.PROD_DAILY], *[[kinds.index(v) if v in kinds else v for v in row] for row in zip(*(days[c].to_pylist() for c in columns.PROD_DAILY))]]
        first.insert(2, [None, ""])
        second = [list(columns.PROD_MONTHLY), [None, None, None, None, "hrs", "Sm3"], *map(list, zip(*(months[c].to_pylist() for c in columns.PROD_MONTHLY))), [None]]
        name = (days if len(days) else months)["_well"][0].as_py()
        return pa.table({"name": [f"{name}.xlsx"], "content": pa.array([_workbook([first, second], kinds)], pa.binary())})

    made = daily.groupBy("_well").cogroup(monthly.groupBy("_well")).applyInArrow(make, "name string, content binary")
    folder = scratch.fresh_path(spark, "workbooks")
    files.write_files(made, folder)
    return folder


@query(f"""WITH {DAILY} SELECT CAST(date_diff('day', DATE '1899-12-30', prod_date) AS VARCHAR) AS dateprd, wellbore_uid AS identifier, CAST(CAST(oil_raw AS BIGINT) AS VARCHAR) AS bore_oil_vol, CASE WHEN well_type = 'WI' THEN 'injection' ELSE 'production' END AS flow_kind,
           CAST(NULL AS VARCHAR) AS avg_whp_p, CAST(prod_date AS VARCHAR) AS replay_date, wellbore_uid || '.xlsx' AS file FROM daily WHERE prod_date BETWEEN DATE '1994-01-01' AND DATE '1996-12-31'""")
def read_prod_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = xlsx.read_prod_daily(spark, workbooks(spark, sf_dir), "1994-01-01", "1996-12-31")
    return rows.select("dateprd", F.col("_source_identifier").alias("identifier"), "bore_oil_vol", "flow_kind", "avg_whp_p", F.col("_replay_date").alias("replay_date"), F.expr(_NAME).alias("file"))


@query(f"""WITH {DAILY}, {REPORTED} SELECT wellbore_uid AS wellbore_name, CAST(month_key // 100 AS VARCHAR) AS year, CAST(month_key % 100 AS VARCHAR) AS month, CAST(CAST(oil_sm3 AS BIGINT) AS VARCHAR) AS oil, 'NULL' AS gi,
           CAST(make_date(CAST(month_key // 100 AS BIGINT), CAST(month_key % 100 AS BIGINT), 1) AS VARCHAR) AS replay_date FROM reported WHERE month_key BETWEEN 199401 AND 199612""")
def read_prod_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = xlsx.read_prod_monthly(spark, workbooks(spark, sf_dir), "1994-01-01", "1996-12-31")
    return rows.select("wellbore_name", "year", "month", "oil", "gi", F.col("_replay_date").alias("replay_date"))


# ---------------------------------------------------------------- text files

@query("""SELECT CAST(s_suppkey AS VARCHAR) AS suppkey, 'MÆRSK ' || s_name AS text, CASE s_suppkey % 3 WHEN 2 THEN 'cp1252' ELSE 'utf-8-sig' END AS encoding FROM supplier""")
def decode_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file per supplier in UTF-8 with its mark, without, or in Windows-1252; without the mark UTF-8 reads alike."""
    named = table(spark, sf_dir, "supplier").withColumn("text", _join("MÆRSK ", F.col("s_name")))
    kind = F.col("s_suppkey") % 3
    content = F.when(kind == 0, F.concat(F.lit(b"\xef\xbb\xbf"), F.encode("text", "UTF-8"))).when(kind == 1, F.encode("text", "UTF-8")).otherwise(F.concat(F.lit(b"M\xc6RSK "), F.encode("s_name", "UTF-8")))
    folder = _put(spark, "texts", named, _join(F.col("s_suppkey"), ".txt"), content)

    def parse(path: str, raw: bytes):
        text, encoding = files.decode_text(raw)
        yield {"suppkey": files.stem(path), "text": text, "encoding": encoding}

    return files.parse_files(files.binary_files(spark, folder, "*.txt"), parse, ("suppkey", "text", "encoding")).select("suppkey", "text", "encoding")


@query("""SELECT CAST(l_suppkey AS VARCHAR) || '.txt' AS file, count(*) AS rows, CAST(sum(l_orderkey) AS BIGINT) AS orderkeys, 1 AS files FROM lineitem GROUP BY l_suppkey""")
def batcher(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file of lines per supplier; batches that leave the parser are bounded and never mix files."""
    bodies = _bodies(table(spark, sf_dir, "lineitem"), ["l_suppkey"], ["l_orderkey", "l_linenumber"], _text("l_orderkey"))
    folder = _put(spark, "lines", bodies, _join(F.col("l_suppkey"), ".txt"), F.col("body"))

    def parse(path: str, raw: bytes):
        for line in raw.decode().splitlines():
            yield {"orderkey": line}

    rows = files.parse_files(files.binary_files(spark, folder), parse, ("orderkey",))
    return rows.groupBy(F.expr(_NAME).alias("file")).agg(F.count("*").alias("rows"), F.sum(F.col("orderkey").cast("long")).alias("orderkeys"), F.count_distinct("_source_file").cast("int").alias("files"))


@query("""SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS key, trim(substr(p_brand, 1, 10)) AS brand, CAST(p_size AS VARCHAR) AS size FROM part""")
def parse_fixed_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part")
    line = F.concat(F.rpad(_text("p_partkey"), 12, " "), F.rpad(F.substring("p_brand", 1, 10), 10, " "), F.lpad(_text("p_size"), 6, " "))
    folder = scratch.fresh_path(spark, "fixed")
    rows.select(F.explode(F.array(F.lit("-- part"), line, F.lit("  # note"), F.lit(""))).alias("value")).write.text(folder)
    return subsurface.parse_fixed_width(spark, folder, [("key", 0, 12), ("brand", 12, 22), ("size", 22, 28)]).select(F.col("key").cast("long").alias("p_partkey"), "key", "brand", "size")


@query("""
    WITH r AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS seq FROM orders)
    SELECT 'FAULT_' || CAST(o_custkey AS VARCHAR) AS fault_file, 'ADDZCORN' AS keyword, CAST(seq AS VARCHAR) AS record_seq, CASE WHEN o_orderkey % 2 = 0 THEN '10.0' ELSE '-2.5' END AS z_shift, CAST(o_orderkey AS VARCHAR) || ' 1' AS index_values, 'fault of ' || CAST(o_custkey AS VARCHAR) AS comment FROM r""")
def read_fault_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    shift = F.when(F.col("o_orderkey") % 2 == 0, "10.0").otherwise("-2.5")
    bodies = _bodies(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderkey"], _join("   ", shift, "    ", F.col("o_orderkey"), "  1  /"))
    text = _join("-- fault of ", F.col("o_custkey"), "\nADDZCORN\n", F.col("body"), "\n/\nnot 1 a record /\n")
    folder = _put(spark, "faults", bodies, _join("FAULT_", F.col("o_custkey")), text)
    return subsurface.read_fault_records(spark, folder).select("fault_file", "keyword", "record_seq", "z_shift", "index_values", "comment")


@query("""
    SELECT CAST(o_custkey AS VARCHAR) AS name, CASE WHEN o_custkey % 2 = 0 THEN 'header_block' ELSE 'columns' END AS layout, CASE WHEN o_custkey % 2 = 0 THEN '15/9-F-' || CAST(o_custkey AS VARCHAR) END AS well_from_header,
           CASE WHEN o_custkey % 2 = 1 THEN 'C' || CAST(o_orderkey AS VARCHAR) END AS curve_name, CASE WHEN o_custkey % 2 = 0 THEN CAST(o_orderkey AS VARCHAR) END AS md_m, CAST(o_orderkey % 1000 AS VARCHAR) AS tvd_m, CAST(o_orderkey % 777 AS VARCHAR) AS two_way_time_ms,
           CASE WHEN o_custkey % 2 = 0 THEN 'X Y' END AS contractor FROM orders""")
def read_checkshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file per customer, in the layout with a header or in the one with columns."""
    key = F.col("o_orderkey")
    even = F.col("o_custkey") % 2 == 0
    line = F.when(even, _join(key, "  ", key % 1000, "  ", key % 777)).otherwise(_join("C", key, " 1.5 ", key % 1000, " 2.5 ", key % 777))
    bodies = _bodies(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderkey"], line)
    head = F.when(even, _join("Wellname : 15/9-F-", F.col("o_custkey"), "\nContractor:  X Y\nMD TVD TWT\n")).otherwise("Curve Name TVDBTDD TVD TVDSS Time\n")
    folder = _put(spark, "checkshots", bodies, _join("checkshot_", F.col("o_custkey"), ".txt"), F.concat(head, "body"))
    return subsurface.read_checkshot(spark, folder).select(F.col("well_from_file_name").alias("name"), "layout", "well_from_header", "curve_name", "md_m", "tvd_m", "two_way_time_ms", "contractor")


@query("""
    SELECT 'M' || CAST(o_custkey AS VARCHAR) AS model_name, CAST(o_orderkey AS VARCHAR) || '.00' AS days_from_start, strftime(o_orderdate, '%Y-%m-%d') AS report_date, r.label AS row_label, CAST(o_orderkey AS VARCHAR) || '.' AS oil_liquid, CAST(NULL AS VARCHAR) AS oil_vapour,
           CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey AS VARCHAR) || '.' END AS water_total, CAST(o_orderkey % 97 AS VARCHAR) || '.' AS gas_total, CAST(o_custkey AS VARCHAR) || '.5' AS pav_bara, '2011.1' AS simulator_version
    FROM orders, (VALUES ('CURRENTLY IN PLACE'), ('OUTFLOW THROUGH WELLS')) AS r(label)""")
def read_eclipse_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A print file per customer, a page per order, two lines a page; cells are blank where values are missing."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    cell = lambda c: F.lpad(F.coalesce(_text(c), F.lit("")), 12, " ")
    values = [F.lit(":"), cell(_join(key, ".")), cell(F.lit(None)), cell(_join(key, ".")), F.lit(":"), cell(F.when(key % 2 == 0, _join(customer, "."))), F.lit(":"), cell(F.lit("0.")), cell(F.lit("1.")), cell(_join(key % 97, ".")), F.lit(":")]
    heading = " " * 27 + ":" + "".join(x.rjust(12) for x in ("LIQUID", "VAPOUR", "TOTAL")) + ":" + "TOTAL".rjust(12) + ":" + "".join(x.rjust(12) for x in ("FREE", "DISSOLVED", "TOTAL")) + ":\n"
    row = lambda label: F.concat(F.lit(f" :{label}".ljust(27)), *values, F.lit("\n"))
    page = F.concat(
        _join("   REPORT  1   "), F.upper(F.date_format("o_orderdate", "dd MMM yyyy")), _join("  *\n  BALANCE  AT  ", key, ".00  DAYS  *\n  PAV =  ", customer, ".5  BARSA\n"), F.lit(heading), row("CURRENTLY IN PLACE"), row("OUTFLOW THROUGH WELLS")
    )
    bodies = _bodies(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderkey"], page, "")
    folder = _put(spark, "balances", bodies, _join("M", customer, ".PRT"), F.concat(F.lit("ECLIPSE  VERSION 2011.1\n"), "body"))
    names = ("model_name", "days_from_start", "report_date", "row_label", "oil_liquid", "oil_vapour", "water_total", "gas_total", "pav_bara", "simulator_version")
    return subsurface.read_eclipse_balance(spark, folder).select(*names)


# ---------------------------------------------------------------- seismic files

@query("""SELECT CAST(s_suppkey AS VARCHAR) || '.sgy' AS survey_file, '15/9-' || CAST(s_suppkey AS VARCHAR) AS well, CAST(s_suppkey % 30000 AS VARCHAR) AS sample_interval_us, CAST(-1 - s_suppkey AS VARCHAR) AS trace1_source_x, CAST(s_nationkey AS VARCHAR) AS traces_per_ensemble,
           'C 1 CLIENT ' || s_name AS first_card, 'prefix' AS access_mode FROM supplier""")
def read_segy_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file per supplier, its text header in EBCDIC or ASCII; only the headers' bytes are read."""
    import struct

    def make(batches):
        for batch in batches:
            names, contents = [], []
            for key, name, nation in zip(*(batch.column(c).to_pylist() for c in ("s_suppkey", "s_name", "s_nationkey"))):
                cards = (f"C 1 CLIENT {name}".ljust(80) + f"C 2 WELL: 15/9-{key}".ljust(80)).ljust(3200)
                raw = bytearray(cards.encode("cp037" if key % 2 else "ascii") + bytes(640 + 2000))
                struct.pack_into(">h", raw, 3212, nation)
                struct.pack_into(">h", raw, 3216, key % 30000)
                struct.pack_into(">i", raw, 3600 + 72, -1 - key)
                names.append(f"{key}.sgy")
                contents.append(bytes(raw))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(contents, pa.binary())], ["name", "content"])

    folder = scratch.fresh_path(spark, "seismic")
    files.write_files(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey").mapInArrow(make, "name string, content binary"), folder)
    rows = subsurface.read_segy_header(spark, folder.removeprefix("file://"))
    return rows.select("survey_file", F.col("_source_identifier").alias("well"), "sample_interval_us", "trace1_source_x", "traces_per_ensemble", F.substring_index("textual_header", "\n", 1).alias("first_card"), "access_mode")


# ---------------------------------------------------------------- logs in LAS

def las_folder(spark: SparkSession, sf_dir: str) -> str:
    """A log file per user: a line per event, a curve per kind of event, the sentinel where an event is of another kind.

    Versions 2 and 3 of the format take turns; in version 3 commas stand between values.
    """
    kinds = ["click", "purchase", "scroll", "search", "view"]
    third = F.col("user_id") % 2 == 1
    cells = F.concat_ws(",", _text("event_id"), *[F.when(F.col("event_type") == k, F.round("value", 4).cast("string")).otherwise("-999.25") for k in kinds])
    lines = events(spark, sf_dir).withColumn("_cells", F.when(third, cells).otherwise(F.replace(cells, F.lit(","), F.lit("  "))))
    bodies = _bodies(lines, ["user_id"], ["event_id"], F.col("_cells"))
    curves = "DEPT.M : index\n" + "".join(f"{k.upper()}.V/V 45 : {k}: all of it\n" for k in kinds)
    user = F.col("user_id")
    head = F.when(third, "~Version\nVERS. 3.0 : v\nDLM. COMMA : d\n").otherwise("~Version\nVERS. 2.0 : v\nWRAP. NO : w\n")
    middle = _join("~Well\nSTRT.M 0 : START\nNULL.  -999.25 : NULL\nDATE. 00:00:00 09-Jun-08 : start: of it\nWELL. 15/9-F-", user, " : WELL\n# note\n")
    parts = F.when(third, f"~Log_Definition\n{curves}~Log_Data | Log_Definition\n").otherwise(f"~Curve\n{curves}~A\n")
    return _put(spark, "las", bodies, _join(user, F.when(third, ".LAS").otherwise(".las")), F.concat(head, middle, parts, "body", F.lit("\n")))


_KINDS = "(VALUES ('click', 1), ('purchase', 2), ('scroll', 3), ('search', 4), ('view', 5)) AS k(kind, place)"


@query(f"""
    WITH u AS (SELECT DISTINCT user_id FROM events)
    SELECT '15/9-F-' || CAST(user_id AS VARCHAR) AS well_name, CASE WHEN user_id % 2 = 1 THEN '3.0' ELSE '2.0' END AS las_version, CAST(place AS VARCHAR) AS curve_index, upper(kind) AS mnemonic, 'V/V' AS unit, '45 : ' || kind AS api_code, 'all of it' AS description, '-999.25' AS null_value_declared, 'DEPT' AS index_mnemonic
    FROM u, {_KINDS}
    UNION ALL SELECT '15/9-F-' || CAST(user_id AS VARCHAR), CASE WHEN user_id % 2 = 1 THEN '3.0' ELSE '2.0' END, '0', 'DEPT', 'M', NULL, 'index', '-999.25', 'DEPT' FROM u""")
def read_las_curve_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers as scanned: the description follows the last colon, the unit sticks to the point."""
    rows = logs.read_las_curve_header(spark, las_folder(spark, sf_dir))
    return rows.select("well_name", "las_version", "curve_index", "mnemonic", "unit", "api_code", "description", "null_value_declared", "index_mnemonic")


@query("""SELECT DISTINCT '15/9-F-' || CAST(user_id AS VARCHAR) AS identity, '-999.25' AS sentinel, '00:00:00 09-Jun-08 : start' AS date, CASE WHEN user_id % 2 = 1 THEN ',' END AS delimiter, 6 AS curves FROM events""")
def scan_las_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    def parse(path: str, raw: bytes):
        header = logs.scan_las_header(files.decode_text(raw)[0].splitlines())
        yield {"identity": header.identity, "sentinel": header.sentinel, "date": header.well.get("DATE"), "delimiter": header.delimiter, "curves": str(len(header.curves))}

    rows = files.parse_files(files.binary_files(spark, las_folder(spark, sf_dir)), parse, ("identity", "sentinel", "date", "delimiter", "curves"))
    return rows.select("identity", "sentinel", "date", "delimiter", F.col("curves").cast("int").alias("curves"))


@query(f"""
    SELECT '15/9-F-' || CAST(user_id AS VARCHAR) AS well_name, upper(kind) AS mnemonic, CAST(event_id AS VARCHAR) AS index_value, CASE WHEN event_type = kind THEN round(value, 4) ELSE -999.25 END AS value, '-999.25' AS null_value_declared FROM events, {_KINDS}""")
def read_las_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = logs.read_las_sample(spark, las_folder(spark, sf_dir))
    return rows.select("well_name", "mnemonic", "index_value", F.col("value").cast("double").alias("value"), "null_value_declared")


@query("""
    WITH f AS (SELECT user_id, CAST(user_id AS VARCHAR) AS n FROM events GROUP BY 1), r AS (SELECT n, row_number() OVER (ORDER BY length(n), n) AS k FROM f)
    SELECT n || '.las' AS file, CAST(repeat('1 2\n', CAST(length(n) AS INTEGER)) AS VARCHAR) <> '' AS read FROM r WHERE k <= 5""")
def smallest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of the five smallest of many log files, by size and then by name."""
    users = events(spark, sf_dir).select("user_id").distinct()
    text = F.concat(F.lit("~V\nVERS. 2.0 :\n~W\nWELL. w :\n~C\nD.M :\nG.API :\n~A\n"), F.expr("repeat('1 2\n', cast(length(cast(user_id as string)) as int))"))
    folder = _put(spark, "many", users, _join(F.col("user_id"), ".las"), text)
    rows = logs.read_las_sample(spark, folder, max_files=5)
    return rows.groupBy(F.expr(_NAME).alias("file")).agg((F.count("*") > 0).alias("read"))


# ---------------------------------------------------------------- documents in XML and HTML

_SPACE = "http://www.witsml.org/schemas/131"


@query("""
    WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS seq FROM orders)
    SELECT '15/9-F-' || CAST(o_custkey AS VARCHAR) AS identifier, CASE WHEN o_custkey % 2 = 0 THEN '2016-08-04' ELSE '2015-01-31' END AS report_date, CAST(seq AS VARCHAR) AS activity_seq, CAST(o_orderkey AS VARCHAR) AS activity_md, 'm' AS activity_md_uom, o_orderpriority AS comments, CAST(o_custkey AS VARCHAR) AS npd_number, 'xml' AS source_format FROM r
    UNION ALL SELECT '15/9-E-' || CAST(c_custkey AS VARCHAR), '2014-02-28', NULL, NULL, NULL, NULL, NULL, 'xml' FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
    UNION ALL SELECT '15/9-H-' || CAST(n_nationkey AS VARCHAR), '2013-03-0' || CAST(1 + n_nationkey % 9 AS VARCHAR), '3', NULL, NULL, '00:00 | ' || n_name || ' | fine', NULL, 'html' FROM nation""")
def read_ddr_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports in XML with and without activities, in HTML where there is no XML, and in HTML beside an XML, which don't count."""
    orders = table(spark, sf_dir, "orders")
    activity = _join('<w:activity><w:dTimStart>2016-08-03T00:00:00+02:00</w:dTimStart><w:md uom="m">', F.col("o_orderkey"), "</w:md><w:comments>", F.col("o_orderpriority"), "</w:comments></w:activity>")
    customer = F.col("o_custkey")
    end = F.when(customer % 2 == 0, "<w:dTimEnd>2016-08-04T23:30:00+02:00</w:dTimEnd>").otherwise("")
    root = '<?xml version="1.0"?>\n<w:drillReports xmlns:w="http://www.witsml.org/schemas/1series" version="1.4">'
    report = lambda name, body: F.concat(F.lit(root + "<w:drillReport><w:nameWell>15/9</w:nameWell><w:nameWellbore>"), name, F.lit("</w:nameWellbore>"), body, F.lit("</w:drillReport></w:drillReports>"))
    alias = _join("<w:wellboreAlias><w:name>", customer, "</w:name><w:namingSystem>NPD number</w:namingSystem></w:wellboreAlias>")
    full = _bodies(orders, ["o_custkey"], ["o_orderkey"], activity, "")
    full = full.select(_join("r", customer, "_2015_01_31.xml").alias("name"), report(_join("15/9-F-", customer), F.concat(alias, end, F.col("body"))).alias("text"))
    empty = table(spark, sf_dir, "customer").join(orders, F.col("c_custkey") == customer, "left_anti")
    empty = empty.select(_join("e", F.col("c_custkey"), "_2014_02_28.xml").alias("name"), report(_join("15/9-E-", F.col("c_custkey")), F.lit("")).alias("text"))
    nation = table(spark, sf_dir, "nation")
    page = lambda well: F.concat(F.lit("<table><tr><td>Wellbore:</td><td>"), well, F.lit("</td></tr><tr><th>a</th></tr><tr><td>00:00</td><td>"), F.col("n_name"), F.lit("</td><td>fine</td></tr></table>"))
    pages = nation.select(_join("h", F.col("n_nationkey"), "_2013_03_0", 1 + F.col("n_nationkey") % 9, ".html").alias("name"), page(_join("15/9-H-", F.col("n_nationkey"))).alias("text"))
    beside = full.limit(20).crossJoin(nation.limit(1)).select(F.replace("name", F.lit(".xml"), F.lit(".html")).alias("name"), page(F.lit("twice")).alias("text"))
    folder = _put(spark, "reports", full.unionByName(empty).unionByName(pages).unionByName(beside), F.col("name"), F.col("text"))
    rows = witsml.read_reports(spark, folder)
    return rows.select(F.col("_source_identifier").alias("identifier"), "report_date", "activity_seq", "activity_md", "activity_md_uom", "comments", "npd_number", "source_format")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderdate AS DATE) END AS day FROM orders""")
def report_date_from_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy_MM_dd")
    name = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("a/15_9_F_1_"), day, F.lit(".xml"))).when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit("a_2016_13_41/"), day, F.lit(".xml"))).otherwise(F.concat(F.lit("b_2016_13_41"), F.lit(".html")))
    return table(spark, sf_dir, "orders").select("o_orderkey", witsml.report_date_from_name(name).alias("day"))


def _rounded(name: str) -> str:
    return f"CAST(CAST(round({name} * 100) AS BIGINT) AS VARCHAR)"


@query(f"""WITH {STATIONS} SELECT 't' || CAST(l_orderkey AS VARCHAR) AS trajectory_uid, CAST(seq AS VARCHAR) AS station_seq, {_rounded('md')} AS md, 'm' AS md_uom, {_rounded('inclination_deg')} AS incl, CASE WHEN seq % 2 = 0 THEN 'dega' ELSE 'rad' END AS incl_uom,
           CASE WHEN seq % 2 = 0 THEN '2011-02-03' ELSE '2010-01-02' END AS replay_date FROM ordered""")
def read_trajectory_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file per customer's hundred orders, a survey per order; every other station has its own day and unit."""
    number = lambda c: F.round(F.col(c) * 100).cast("long")
    even = F.col("seq") % 2 == 0
    station = _join('<trajectoryStation uid="s', F.col("seq"), '">', F.when(even, "<dTimStn>2011-02-03T10:00:00Z</dTimStn>"), '<md uom="m">', number("md"), '</md><incl uom="', F.when(even, "dega").otherwise("rad"), '">', number("inclination_deg"), "</incl></trajectoryStation>")
    surveys = _bodies(stations(spark, sf_dir), ["l_orderkey"], ["seq"], station, "")
    one = _join('<trajectory uid="t', F.col("l_orderkey"), '"><nameWellbore>15/9-F-1</nameWellbore><dTimTrajStart>2010-01-02T00:00:00Z</dTimTrajStart>', F.col("body"), "</trajectory>")
    bodies = _bodies(surveys.withColumn("_file", F.floor(F.col("l_orderkey") / 100)), ["_file"], ["l_orderkey"], one)
    folder = _put(spark, "trajectories", bodies, _join(F.col("_file"), ".xml"), _join(f'<trajectorys xmlns="{_SPACE}" version="1.3.1">\n', F.col("body"), "\n</trajectorys>"))
    return witsml.read_trajectory_station(spark, folder).select("trajectory_uid", "station_seq", "md", "md_uom", "incl", "incl_uom", F.col("_replay_date").alias("replay_date"))


@query(f"""SELECT CAST(event_id AS VARCHAR) AS uid_message, '15/9-F-' || CAST(user_id AS VARCHAR) AS name_wellbore, event_type AS message_text, CAST(event_id AS VARCHAR) AS md, 'm' AS md_uom, strftime(ts, '%Y-%m-%d') AS replay_date, '{_SPACE}' AS namespace, '1.3.1' AS schema_version FROM events""")
def read_witsml_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'+02:00'")
    message = _join('<message uid="', F.col("event_id"), '"><nameWellbore>15/9-F-', F.col("user_id"), "</nameWellbore><dTim>", at, '</dTim><md uom="m">', F.col("event_id"), "</md><messageText>", F.col("event_type"), "</messageText></message>")
    bodies = _bodies(events(spark, sf_dir), ["user_id"], ["event_id"], message)
    folder = _put(spark, "messages", bodies, _join(F.col("user_id"), ".xml"), _join(f'<?xml version="1.0"?>\n<messages xmlns="{_SPACE}" version="1.3.1">\n', F.col("body"), "\n</messages>"))
    return witsml.read_witsml_message(spark, folder).select("uid_message", "name_wellbore", "message_text", "md", "md_uom", F.col("_replay_date").alias("replay_date"), "namespace", "schema_version")


def log_folder(spark: SparkSession, sf_dir: str) -> str:
    """A document per user: a log of telemetry, a line per event; a unit and a value are missing, one value is beyond the list."""
    at = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    line = _join("<data>", at, ",", F.col("event_id"), ",", F.col("event_id") + 1, ",", F.when(F.col("event_id") % 3 != 0, F.col("event_id") % 70), ",beyond</data>")
    bodies = _bodies(events(spark, sf_dir), ["user_id"], ["event_id"], line)
    names = ("TIME", "bit_depth_m", "hole_depth_m", "rpm")
    curves = "".join(f'<logCurveInfo uid="c{k}"><mnemonic>{n}</mnemonic>{"<unit>m</unit>" if k in (1, 2) else ""}</logCurveInfo>' for k, n in enumerate(names))
    head = f'<logs xmlns="{_SPACE}" version="1.3.1.1">\n<log uid="l"><nameWellbore>15/9-F-'
    text = _join(head, F.col("user_id"), f"</nameWellbore><name>L</name><indexType>date time</indexType>{curves}<logData><mnemonicList>{','.join(names)}</mnemonicList><unitList>s,m,m</unitList>\n", F.col("body"), "\n</logData></log></logs>")
    return _put(spark, "logs", bodies, _join(F.col("user_id"), ".xml"), text)


@query(f"""SELECT DISTINCT '15/9-F-' || CAST(user_id AS VARCHAR) AS name_wellbore, CAST(seq AS VARCHAR) AS curve_seq, mnemonic, unit, '{_SPACE}' AS namespace, '1.3.1.1' AS schema_version
           FROM events, (VALUES (1, 'TIME', NULL), (2, 'bit_depth_m', 'm'), (3, 'hole_depth_m', 'm'), (4, 'rpm', NULL)) AS c(seq, mnemonic, unit)""")
def read_witsml_log_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return witsml.read_witsml_log_header(spark, log_folder(spark, sf_dir)).select("name_wellbore", "curve_seq", "mnemonic", "unit", "namespace", "schema_version")


_LOGGED = "(SELECT user_id, event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS moment, strftime(ts, '%Y-%m-%d') AS day FROM events)"


@query(f"""
    SELECT '15/9-F-' || CAST(user_id AS VARCHAR) AS name_wellbore, moment AS index_value, mnemonic, unit, CASE mnemonic WHEN 'bit_depth_m' THEN CAST(event_id AS VARCHAR) WHEN 'hole_depth_m' THEN CAST(event_id + 1 AS VARCHAR) WHEN 'rpm' THEN CASE WHEN event_id % 3 <> 0 THEN CAST(event_id % 70 AS VARCHAR) ELSE '' END END AS value, day AS replay_date
    FROM {_LOGGED}, (VALUES ('bit_depth_m', 'm'), ('hole_depth_m', 'm'), ('rpm', NULL)) AS c(mnemonic, unit)""")
def read_witsml_log_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return witsml.read_witsml_log_data(spark, log_folder(spark, sf_dir)).select("name_wellbore", "index_value", "mnemonic", "unit", "value", F.col("_replay_date").alias("replay_date"))


@query("""SELECT '15/9-F-' || CAST(user_id AS VARCHAR) AS wellbore_uid, CAST(epoch_us(ts) // 1000 AS VARCHAR) AS ts, CAST(event_id AS VARCHAR) AS bit_depth_m, CAST(event_id + 1 AS VARCHAR) AS hole_depth_m, CASE WHEN event_id % 3 <> 0 THEN CAST(event_id % 70 AS VARCHAR) ELSE '' END AS rpm, CAST(NULL AS VARCHAR) AS wob_klbf FROM events""")
def iter_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = witsml.telemetry_samples(witsml.read_witsml_log_data(spark, log_folder(spark, sf_dir)))
    return rows.select("wellbore_uid", "ts", "bit_depth_m", "hole_depth_m", "rpm", "wob_klbf")


def mixed_folder(spark: SparkSession, sf_dir: str) -> str:
    """Documents of three kinds, some with a prefix, a comment before the root or a namespace of another schema."""
    key = F.col("o_custkey")
    text = F.when(key % 3 == 0, f'<?xml version="1.0"?><!-- <x> --><w:logs xmlns:w="{_SPACE}" version="1.3"><a/></w:logs>').when(key % 3 == 1, '<messages xmlns="http://other/1"\n version="2"></messages>').otherwise("<trajectorys><b/></trajectorys>")
    return _put(spark, "mixed", table(spark, sf_dir, "orders").select(key).distinct(), _join(key, ".xml"), text)


_MIXED = f"""(SELECT DISTINCT CAST(o_custkey AS VARCHAR) || '.xml' AS file, CASE o_custkey % 3 WHEN 0 THEN 'logs' WHEN 1 THEN 'messages' ELSE 'trajectorys' END AS root, CASE o_custkey % 3 WHEN 0 THEN '{_SPACE}' WHEN 1 THEN 'http://other/1' END AS namespace, CASE o_custkey % 3 WHEN 0 THEN '1.3' WHEN 1 THEN '2' END AS version FROM orders)"""


@query(f"SELECT * FROM {_MIXED}")
def document_namespace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return witsml.document_roots(spark, mixed_folder(spark, sf_dir)).select(F.expr(_NAME).alias("file"), "root", "namespace", "version")


@query(f"SELECT root, count(*) AS documents FROM {_MIXED} GROUP BY root")
def survey_document_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return witsml.survey_document_types(spark, mixed_folder(spark, sf_dir))


# ---------------------------------------------------------------- archives

def archives(spark: SparkSession, sf_dir: str) -> str:
    """An archive per nation of its suppliers' files; every third file is in two archives, every fourth of other content there."""

    def make(rows: pa.Table) -> pa.Table:
        raw = io.BytesIO()
        with zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as out:
            out.writestr("folder/", "")
            for entry, text in sorted(zip(rows["entry"].to_pylist(), rows["text"].to_pylist())):
                out.writestr(entry, text.encode("cp1252"))
        return pa.table({"name": [f"n{rows['n'][0].as_py()}.zip"], "content": pa.array([raw.getvalue()], pa.binary())})

    folder = scratch.fresh_path(spark, "archives")
    files.write_files(_entries(spark, sf_dir).groupBy("n").applyInArrow(make, "name string, content binary"), folder)
    return folder


def _entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    entry = F.when(key % 5 == 0, _join("logs/", key, ".las")).when(key % 5 == 1, _join("Production data/", key, ".xlsx")).when(key % 5 == 2, _join("Daily drill reports/", key, "_2016_01_02.xml")).otherwise(_join("x/", key, ".bin"))
    rows = table(spark, sf_dir, "supplier").select((F.col("s_nationkey") % 4).alias("n"), key, entry.alias("entry"), _join("MÆRSK ", key % 7).alias("text"))
    again = rows.where(key % 3 == 0).select((F.col("n") + 4).alias("n"), "s_suppkey", "entry", F.when(key % 4 == 0, "other").otherwise(F.col("text")).alias("text"))
    return rows.unionByName(again).drop("s_suppkey")


_ARCHIVED = """
    own AS (SELECT s_nationkey % 4 AS n, s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN 'logs/' || s_suppkey || '.las' WHEN 1 THEN 'Production data/' || s_suppkey || '.xlsx' WHEN 2 THEN 'Daily drill reports/' || s_suppkey || '_2016_01_02.xml' ELSE 'x/' || s_suppkey || '.bin' END AS entry, 'MÆRSK ' || s_suppkey % 7 AS text FROM supplier),
    entries AS (SELECT n, entry, text FROM own UNION ALL SELECT n + 4, entry, CASE WHEN s_suppkey % 4 = 0 THEN 'other' ELSE text END FROM own WHERE s_suppkey % 3 = 0)"""


@query(f"""WITH {_ARCHIVED} SELECT 'n' || n || '.zip' AS archive, entry, CAST(length(text) AS BIGINT) AS size, CASE WHEN text = 'other' THEN 'utf-8-sig' ELSE 'cp1252' END AS encoding FROM entries""")
def inventory_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inventory.inventory_scan(spark, archives(spark, sf_dir))
    return rows.select(F.element_at(F.split("archive", "/"), -1).alias("archive"), "entry", "size", "encoding")


@query(f"""WITH {_ARCHIVED} SELECT DISTINCT entry, CASE WHEN entry LIKE '%.las' THEN 'LAS' WHEN entry LIKE '%.xlsx' THEN 'PROD' WHEN entry LIKE '%.xml' THEN 'DDR' END AS kind, CASE WHEN entry LIKE '%.las' THEN 90 WHEN entry LIKE '%.xlsx' THEN 80 WHEN entry LIKE '%.xml' THEN 100 ELSE 0 END AS score,
           CASE WHEN entry LIKE '%.bin' THEN 'none' ELSE 'high' END AS confidence FROM entries""")
def classify_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.classify_entries(inventory.inventory_scan(spark, archives(spark, sf_dir))).select("entry", "kind", "score", "confidence").distinct()


@query(f"""WITH {_ARCHIVED}, r AS (SELECT *, count(*) OVER (PARTITION BY text) AS copies, row_number() OVER (PARTITION BY text ORDER BY length(entry), entry) AS k FROM entries) SELECT entry AS canonical, copies FROM r WHERE k = 1 AND copies > 1""")
def group_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.group_duplicates(inventory.inventory_scan(spark, archives(spark, sf_dir))).select("canonical", "copies")


@query(f"""
    WITH {_ARCHIVED}, e AS (SELECT DISTINCT 'n' || n || '.zip' AS archive, string_split(entry, '/')[-1] AS name, text FROM entries)
    SELECT a.archive AS left_archive, b.archive AS right_archive, count(DISTINCT a.name) AS shared, count(DISTINCT CASE WHEN a.text = b.text THEN a.name END) AS equal,
           count(DISTINCT a.name) >= 3 AND 2 * count(DISTINCT CASE WHEN a.text = b.text THEN a.name END) >= count(DISTINCT a.name) AS corroborated
    FROM e a JOIN e b ON a.name = b.name AND a.archive < b.archive GROUP BY 1, 2""")
def cross_archive_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inventory.inventory_scan(spark, archives(spark, sf_dir))
    return inventory.cross_archive_agreement(rows.withColumn("archive", F.element_at(F.split("archive", "/"), -1)))


@query("""
    SELECT CAST(s_suppkey AS VARCHAR) AS name, 'utf-8-sig' AS encoding, CASE WHEN s_suppkey % 2 = 0 THEN 'crlf' ELSE 'lf' END AS line_ends, CASE s_suppkey % 3 WHEN 0 THEN ';' WHEN 1 THEN ',' END AS delimiter, 'iso' AS dates, CASE WHEN s_suppkey % 2 = 0 THEN '-999.25' END AS sentinels, 'Sm3' AS units, '301' AS lines FROM supplier""")
def profile_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of 301 lines whose delimiter, for every third, fails on the last."""
    key = F.col("s_suppkey")
    mark = F.when(key % 3 == 1, ",").otherwise(";")
    end = F.when(key % 2 == 0, "\r\n").otherwise("\n")
    row = F.concat(F.lit("2016-01-02"), mark, F.when(key % 2 == 0, "-999.25").otherwise("7"), mark, F.lit("Sm3"), end)
    last = F.when(key % 3 == 2, F.concat(F.lit("nothing between"), end)).otherwise(row)
    folder = _put(spark, "profiled", table(spark, sf_dir, "supplier").select(key, F.concat(F.repeat(row, F.lit(300)), last).alias("text")), _join(key, ".txt"), F.col("text"))
    names = ("encoding", "line_ends", "delimiter", "dates", "sentinels", "units", "lines")

    def parse(path: str, raw: bytes):
        yield {"name": files.stem(path)} | {k: None if v is None else str(v) for k, v in inventory.profile_text(raw).items()}

    return files.parse_files(files.binary_files(spark, folder), parse, ("name", *names)).select("name", *names)


@query("""
    WITH r AS (SELECT event_id, row_number() OVER (ORDER BY ts) - 1 AS k, count(*) OVER () AS n FROM events)
    SELECT event_id FROM r WHERE floor(k * 50 / n) <> floor((k - 1) * 50 / n)""")
def spread_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifty events at even distances in time; of events at one time, which the SQL leaves open, those of lesser id come first."""
    return inventory.spread_sample(events(spark, sf_dir), ["ts", "event_id"], 50).select("event_id")


# ---------------------------------------------------------------- landing tables and sinks

def _dated(spark: SparkSession, sf_dir: str, batch: str = "batch-1") -> DataFrame:
    rows = events(spark, sf_dir).select("event_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("_replay_date"))
    return bronze.add_technical_columns(rows, ["event_id", "event_type"], "EVENTS", batch, "2024-01-01T00:00:00+00:00")


def _range(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    row = events(spark, sf_dir).agg(F.min(F.to_date("ts")).cast("string"), F.max(F.to_date("ts")).cast("string")).first()
    return row[0], row[1]


@query("""SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, strftime(ts, '%Y-%m-%d') AS replay_date, 'batch-2' AS batch FROM events WHERE CAST(ts AS DATE) <> (SELECT min(CAST(ts AS DATE)) + 1 FROM events)""")
def load_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days loaded twice, the second load without one day: its rows go, the others are there once."""
    folder, (first, last) = scratch.fresh_path(spark, "landing"), _range(spark, sf_dir)
    bronze.load_range(_dated(spark, sf_dir), folder, first, last)
    again = _dated(spark, sf_dir, "batch-2").where(F.col("_replay_date") != F.date_add(F.lit(first).cast("date"), 1).cast("string"))
    bronze.load_range(again, folder, first, last)
    return bronze.bronze_scan(spark, folder, ["event_id", "event_type"]).select("event_id", "event_type", F.col("_replay_date").alias("replay_date"), F.col("_batch_id").alias("batch"))


@query("""
    WITH d AS (SELECT *, CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events) AS last FROM events)
    SELECT CAST(event_id AS VARCHAR) AS event_id, CASE WHEN last THEN 'batch-2' ELSE 'batch-1' END AS batch, (SELECT count(*) FILTER (last) FROM d) AS loaded FROM d""")
def load_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days, then the last one anew, and a day of no rows: nothing else moves."""
    folder, (first, last) = scratch.fresh_path(spark, "landing"), _range(spark, sf_dir)
    bronze.load_range(_dated(spark, sf_dir), folder, first, last)
    loaded = bronze.load_day(_dated(spark, sf_dir, "batch-2"), folder, last) + bronze.load_day(_dated(spark, sf_dir, "batch-3"), folder, "1970-01-01")
    return bronze.bronze_scan(spark, folder, ["event_id", "event_type"]).select("event_id", F.col("_batch_id").alias("batch"), F.lit(loaded).cast("long").alias("loaded"))


@query("""SELECT name, 'string' AS kind FROM (VALUES ('event_id'), ('event_type'), ('_ingested_at'), ('_replay_date'), ('_source_system'), ('_source_file'), ('_source_identifier'), ('_batch_id'), ('_row_hash'), ('_wellbore_uid')) AS t(name)""")
def ensure_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of a landing table that was written and is read by its declared schema: text, all of them."""
    folder, (first, last) = scratch.fresh_path(spark, "landing"), _range(spark, sf_dir)
    bronze.load_range(_dated(spark, sf_dir), folder, first, last)
    return spark.createDataFrame(bronze.bronze_scan(spark, folder, ["event_id", "event_type"]).dtypes, "name string, kind string")


@query("""SELECT event_type, count(*) AS rows, CAST(sum(event_id) AS BIGINT) AS ids FROM events WHERE CAST(ts AS DATE) >= (SELECT min(CAST(ts AS DATE)) + 3 FROM events) GROUP BY 1""")
def bronze_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing table from its fourth day on: folders of other days aren't read."""
    folder, (first, last) = scratch.fresh_path(spark, "landing"), _range(spark, sf_dir)
    bronze.load_range(_dated(spark, sf_dir), folder, first, last)
    days = bronze.bronze_scan(spark, folder, ["event_id", "event_type"]).where(F.col("_replay_date") >= F.date_add(F.lit(first).cast("date"), 3).cast("string"))
    return days.groupBy("event_type").agg(F.count("*").alias("rows"), F.sum(F.col("event_id").cast("long")).alias("ids"))


@query("""SELECT event_id, event_type, true AS fewer FROM events""")
def compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table in forty files written anew in few, with every row."""
    folder = scratch.fresh_path(spark, "small-files")
    events(spark, sf_dir).select("event_id", "event_type").repartition(40).write.parquet(f"{folder}/a")
    before, after = bronze.compact(spark, f"{folder}/a", f"{folder}/b")
    return spark.read.parquet(f"{folder}/b").withColumn("fewer", F.lit(after < before))


@query(f"""WITH {DAILY} SELECT 'silver_production_daily' AS model, count(*) AS rows FROM silver UNION ALL SELECT 'silver_production_quarantine', count(*) FILTER (on_stream_hrs = 0 AND (oil_sm3 > 0 OR gas_sm3 > 0 OR water_sm3 > 0)) + count(*) FILTER (on_stream_hrs > 0 AND oil_sm3 = 0 AND gas_sm3 = 0 AND water_sm3 = 0 AND injected_sm3 = 0) + count(*) FILTER (on_stream_hrs > 24) FROM silver
           UNION ALL SELECT 'dim_facility', count(DISTINCT facility) FROM silver""")
def create_table_as(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models written as tables by the registry, each after those it needs, and counted."""
    from functools import reduce

    from strataflow.plans.registry import default_registry

    folder, wanted = scratch.fresh_path(spark, "models"), ["silver_production_quarantine", "dim_facility"]
    default_registry().write({"prod_daily": daily_bronze(spark, sf_dir)}, folder, wanted)
    counts = [spark.read.parquet(f"{folder}/{name}").agg(F.lit(name).alias("model"), F.count("*").alias("rows")) for name in default_registry().order(wanted)]
    return reduce(DataFrame.unionByName, counts)


@query("""
    WITH m AS (SELECT DISTINCT o_custkey FROM orders)
    SELECT 'checkshot_' || o_custkey || '.txt' AS file, 'VSP' AS system, '2008-06-01' AS replay_date, CASE WHEN o_custkey % 2 = 0 THEN 'uid of ' || o_custkey END AS wellbore_uid, 1 AS rows FROM m""")
def source_reader(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source of the catalogue read for the static day, with names looked up; for any other day it has no rows."""
    from strataflow.sources.catalogue import SOURCES

    customers = table(spark, sf_dir, "orders").select("o_custkey").distinct()
    folder = _put(spark, "one-shot", customers, _join("checkshot_", F.col("o_custkey"), ".txt"), F.lit("Wellname : w\n1 2 3\n"))
    named = customers.where("o_custkey % 2 = 0").select(F.lit("VSP").alias("source_system"), F.lit("w").alias("source_identifier"), _join("uid of ", F.col("o_custkey")).alias("wellbore_uid"))
    source = SOURCES["vsp_checkshot"]
    rows = source.read(spark, folder, "2008-06-01", batch_id="b").unionByName(source.read_range(spark, folder, "2009-01-01", "2010-01-01", "b"))
    named = named.select("wellbore_uid", F.regexp_extract("wellbore_uid", "([0-9]+)$", 1).alias("_k"))
    rows = rows.withColumn("_k", F.regexp_extract("_source_file", "checkshot_([0-9]+)", 1)).drop("_wellbore_uid").join(named, "_k", "left")
    return rows.groupBy(F.expr(_NAME).alias("file"), F.col("_source_system").alias("system"), F.col("_replay_date").alias("replay_date"), "wellbore_uid").agg(F.count("*").cast("int").alias("rows"))


# ---------------------------------------------------------------- streams

def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry records of all events: half the rigs in one file per hundred events, in order of time; every fifth is broken."""
    broken = F.col("event_id") % 5 == 0
    return events(spark, sf_dir).select(
        F.col("user_id").cast("string").alias("wellbore_uid"), F.unix_millis(F.col("ts").cast("timestamp")).cast("string").alias("ts"), F.when(broken, "x").otherwise("1").alias("bit_depth_m"), F.lit("1").alias("hole_depth_m"), F.col("event_id").cast("string").alias("producer_seq")
    )


def _routed(spark: SparkSession, parts: list[DataFrame], per_batch: int = 10_000) -> tuple[str, int]:
    """The stream's output folder after all ``parts`` came one after another, the query stopped between them; and its batches."""
    from strataflow.streaming import telemetry as stream

    folder, batches = scratch.fresh_path(spark, "stream"), 0
    for k, part in enumerate(parts):
        part.write.mode("append").json(f"{folder}/in")
        run = stream.start_routing(stream.file_source(spark, f"{folder}/in", per_batch), f"{folder}/out", f"{folder}/checkpoint")
        run.awaitTermination()
        batches += sum(p["numInputRows"] > 0 for p in run.recentProgress)
    return f"{folder}/out", batches


_LATE = "(SELECT max(epoch_us(ts) // 1000) - 600000 FROM events WHERE event_id % 5 <> 0 AND event_id % 2 = 0)"


@query(f"""SELECT event_id, 'not_numeric' AS reason, 'bit_depth_m' AS field, 'x' AS raw_value FROM events WHERE event_id % 5 = 0""")
def stream_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strataflow.streaming import telemetry as stream

    out, _ = _routed(spark, [_records(spark, sf_dir)])
    return stream.read_routed(spark, out, "dead_letter").select(F.col("producer_seq").cast("long").alias("event_id"), "reason", "field", "raw_value")


@query(f"""
    SELECT event_id, CASE WHEN event_id % 2 = 1 AND epoch_us(ts) // 1000 < {_LATE} THEN 'late' ELSE 'telemetry' END AS sink FROM events WHERE event_id % 5 <> 0""")
def stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd events come after even ones: those before the watermark go to the late table, nothing is lost, nothing twice."""
    from strataflow.streaming import telemetry as stream

    rows = _records(spark, sf_dir)
    odd = F.col("producer_seq").cast("long") % 2 == 1
    out, _ = _routed(spark, [rows.where(~odd), rows.where(odd)])
    kinds = [stream.read_routed(spark, out, k).select(F.col("producer_seq").cast("long").alias("event_id"), F.lit(k).alias("sink")) for k in ("telemetry", "late")]
    return kinds[0].unionByName(kinds[1])


@query("""SELECT event_id, CAST(user_id AS VARCHAR) AS wellbore_uid FROM events WHERE event_id % 5 <> 0""")
def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream in two runs on one checkpoint, the second with the first's records once more: none is lost or doubled.

    All times are within the watermark, as late records aren't held against earlier ones. So that no two
    events have the same wellbore and time, a wellbore is split by stretches of a half million events.
    """
    from strataflow.streaming import telemetry as stream

    event, stretch = F.col("producer_seq").cast("long"), 500_000
    well = F.concat("wellbore_uid", F.lit("/"), F.floor(event / stretch).cast("string"))
    same = _records(spark, sf_dir).withColumns({"ts": (1577836800000 + F.pmod(event, F.lit(stretch))).cast("string"), "wellbore_uid": well})
    half = F.col("producer_seq").cast("long") % 2 == 0
    out, _ = _routed(spark, [same.where(half), same])
    kinds = [stream.read_routed(spark, out, k) for k in ("telemetry", "late")]
    return kinds[0].unionByName(kinds[1]).select(F.col("producer_seq").cast("long").alias("event_id"), F.substring_index("wellbore_uid", "/", 1).alias("wellbore_uid"))


@query("""SELECT 4 AS batches, count(*) FILTER (event_id % 5 <> 0) AS rows FROM events""")
def stream_pacing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight files at two a batch."""
    from strataflow.streaming import telemetry as stream

    ordered = _records(spark, sf_dir).withColumn("ts", F.lit("1577836800000")).withColumn("wellbore_uid", F.col("producer_seq"))
    out, batches = _routed(spark, [ordered.repartition(8)], 2)
    return stream.read_routed(spark, out, "telemetry").agg(F.lit(batches).alias("batches"), F.count("*").alias("rows"))


@query("""SELECT event_id, CAST(user_id AS VARCHAR) AS wellbore_uid, CAST(ts AS DATE) AS day FROM events WHERE event_id % 5 <> 0""")
def stream_watermark_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records twice in one batch through the watermark, the stateful deduplication and the append sink, each written once."""
    from strataflow.operators.contract import split_valid, validate_records
    from strataflow.streaming import telemetry as stream

    folder, rows = scratch.fresh_path(spark, "stream"), _records(spark, sf_dir)
    rows.unionByName(rows).write.json(f"{folder}/in")
    good = split_valid(validate_records(stream.file_source(spark, f"{folder}/in", 10_000)))[0]
    for _ in range(2):  # the second run finds nothing new in its checkpoint
        stream.append_stream(stream.dedup_stream(good), f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/out").select(F.col("producer_seq").cast("long").alias("event_id"), "wellbore_uid", F.to_date("ts_date").alias("day"))


