"""Drilling documents in XML, by Spark's own XML parser with declared schemas.

Tasks list and open the documents and cut out the rows' elements, so that the driver holds nothing for
each document; where they can't, Spark's XML source reads them.

Everything is read as text; repeated elements become rows. Namespaces are ignored when matching, so
prefixed documents work alike; the namespace and version columns come from the root's attributes.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterator
from html.parser import HTMLParser
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.sources.columns import DDR_ACTIVITY, TRAJECTORY_STATION, WITSML_LOG_DATA, WITSML_LOG_HEADER, WITSML_MESSAGE
from strataflow.sources.files import BATCH_BYTES, Row, binary_files, decode_text, file_name, file_paths, open_store, parse_files, stem

MEASURE = "struct<_VALUE: string, _uom: string>"


def _elements(chunks: Iterator[bytes], tag: str) -> Iterator[str]:
    """Source of each outermost element of that name, prefixed or not.

    A document that isn't well-formed ends with one that isn't either, which the parser makes a row of nulls.
    """
    parser = expat.ParserCreate()
    held, ahead = bytearray(), 0  # ahead: bytes of the document before those held
    begin, seen, depth, encoding, found = -1, 0, 0, "utf-8", []

    def declared(version, name, standalone):
        nonlocal encoding
        encoding = name or encoding

    def start(name, attributes):
        nonlocal begin, seen, depth
        seen = parser.CurrentByteIndex
        if begin < 0 and name.rpartition(":")[2] == tag:
            begin = seen
        depth += begin >= 0

    def end(name):
        nonlocal begin, seen, depth
        seen = parser.CurrentByteIndex
        if begin >= 0:
            depth -= 1
            if not depth:
                close = _TAG.match(held, begin - ahead)
                close = close if close[0].endswith(b"/>") else _TAG.match(held, seen - ahead)
                found.append(held[begin - ahead : close.end()].decode(encoding, "replace"))
                begin = -1

    parser.XmlDeclHandler, parser.StartElementHandler, parser.EndElementHandler = declared, start, end
    try:
        for chunk in chunks:
            held += chunk
            parser.Parse(chunk, False)
            yield from found
            found.clear()
            keep = (begin if begin >= 0 else seen) - ahead
            del held[:keep]
            ahead += keep
        parser.Parse(b"", True)
    except expat.ExpatError:
        yield from found
        if ahead or held:
            yield held[begin - ahead :].decode(encoding, "replace") if begin >= 0 else "<"


_TAG = re.compile(rb"""<(?:[^"'>]|"[^"]*"|'[^']*')*>""")


def _xml(spark: SparkSession, path: str, tag: str, schema: str, glob: str) -> DataFrame:
    found = file_paths(spark, path, glob)
    if found is None:
        reader = spark.read.format("xml").option("rowTag", tag).option("ignoreNamespace", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
        return reader.schema(schema).load(path).withColumn("_source_file", F.col("_metadata.file_path"))

    def cut(batches):
        names = ["_source_file", "_element"]
        for batch in batches:
            held, size = [], 0
            for where in batch.column("path").to_pylist():
                for element in _elements(_beginning(where, 1 << 16), tag):
                    held.append((where, element))
                    size += len(element)
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*held)], names)
                        held, size = [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*held)], names)

    rows = found.mapInArrow(cut, "_source_file string, _element string")
    return rows.select(F.from_xml("_element", schema, {"rowTag": tag, "ignoreNamespace": "true"}).alias("_row"), "_source_file").select("_row.*", "_source_file")


def _text(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.nullif(F.trim(c), F.lit(""))


def _select(df: DataFrame, columns: tuple[str, ...], found: dict[str, Column], identifier: Column, day: Column) -> DataFrame:
    none = F.lit(None).cast("string")
    return df.select(*[found.get(c, none).cast("string").alias(c) for c in columns], day.cast("string").alias("_replay_date"), F.col("_source_file"), identifier.alias("_source_identifier"))


def local_day(c: Column | str) -> Column:
    """Day of an ISO time in the zone it was written in."""
    return F.substring(F.col(c) if isinstance(c, str) else c, 1, 10).try_cast("date")


def report_date_from_name(c: Column) -> Column:
    """Day at the end of a report's file name, like ``_2016_08_04``."""
    name = F.regexp_replace(F.element_at(F.split(c, "/"), -1), r"\.[^.]*$", "")
    day = F.regexp_extract(name, r"_(\d{4}_\d{2}_\d{2})$", 1)
    return F.replace(F.nullif(day, F.lit("")), F.lit("_"), F.lit("-")).try_cast("date")


def read_ddr_activity(spark: SparkSession, path: str, glob: str = "*.xml") -> DataFrame:
    """A row per activity of each report; a report without any gives one row with no activity.

    The report's day is the local day of its end, or else the one in the file name.
    """
    alias = "array<struct<name: string, namingSystem: string>>"
    activity = f"array<struct<dTimStart: string, dTimEnd: string, md: {MEASURE}, phase: string, proprietaryCode: string, state: string, stateDetailActivity: string, comments: string>>"
    schema = (
        f"nameWell string, nameWellbore string, wellAlias {alias}, wellboreAlias {alias}, wellboreInfo struct<rigAlias: {alias}>, versionKind string, createDate string, "
        f"documentInfo struct<documentName: string, owner: string>, dTimStart string, dTimEnd string, activity {activity}"
    )
    docs = _xml(spark, path, "drillReport", schema, glob)
    rows = docs.select("*", F.posexplode_outer("activity").alias("seq", "one"))
    npd = lambda c: F.expr(f"get(filter({c}, x -> lower(x.namingSystem) like 'npd code%'), 0).name")
    number = F.expr("get(filter(wellboreAlias, x -> lower(x.namingSystem) like 'npd number%'), 0).name")
    day = F.coalesce(local_day("dTimEnd"), report_date_from_name(F.col("_source_file")))
    found = {
        "report_date": day, "name_well": _text("nameWell"), "name_wellbore": _text("nameWellbore"), "npd_code_well": _text(npd("wellAlias")), "npd_code_wellbore": _text(npd("wellboreAlias")),
        "npd_number": _text(number), "rig_alias": _text(F.expr("get(wellboreInfo.rigAlias, 0).name")), "document_name": _text("documentInfo.documentName"), "document_owner": _text("documentInfo.owner"),
        "version_kind": _text("versionKind"), "create_date": _text("createDate"), "dtim_start": _text("dTimStart"), "dtim_end": _text("dTimEnd"), "activity_seq": F.col("seq") + 1,
        "activity_dtim_start": _text("one.dTimStart"), "activity_dtim_end": _text("one.dTimEnd"), "activity_md": _text("one.md._VALUE"), "activity_md_uom": F.col("one.md._uom"), "phase": _text("one.phase"),
        "proprietary_code": _text("one.proprietaryCode"), "state": _text("one.state"), "state_detail_activity": _text("one.stateDetailActivity"), "comments": _text("one.comments"), "source_format": F.lit("xml"),
    }
    return _select(rows, DDR_ACTIVITY, found, F.coalesce(_text("nameWellbore"), _text("nameWell")), day)


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """Activities of all reports: from XML, and from HTML where no XML of the same place and name exists."""
    documents, pages = read_ddr_activity(spark, path), read_ddr_html(spark, path)
    bare = lambda c: F.regexp_replace(F.regexp_replace(c, "^file:/+", "/"), r"\.[^./]*$", "")  # noqa: E731  the two sources spell local paths differently
    listed = file_paths(spark, path, "*.xml")
    named = (listed if listed is not None else binary_files(spark, path, "*.xml")).select(bare("path").alias("_name"))
    return documents.unionByName(pages.join(named, bare("_source_file") == F.col("_name"), "left_anti"))


def _day_in_name(path: str) -> str | None:
    """The day at the end of a report's file name, as ``report_date_from_name`` reads it."""
    parts = stem(path).split("_")[-3:]
    try:
        return dt.datetime.strptime("-".join(parts), "%Y-%m-%d").date().isoformat() if [len(x) for x in parts] == [4, 2, 2] else None
    except ValueError:
        return None


class _Cells(HTMLParser):
    def __init__(self):
        super().__init__()
        self.rows: list[list[tuple[str, str]]] = []

    def handle_starttag(self, tag, attrs):
        if tag == "tr":
            self.rows.append([])
        elif tag in ("td", "th") and self.rows:
            self.rows[-1].append((tag, ""))

    def handle_data(self, data):
        if self.rows and self.rows[-1]:
            tag, text = self.rows[-1][-1]
            self.rows[-1][-1] = tag, f"{text} {data.strip()}".strip()


def read_ddr_html(spark: SparkSession, path: str, glob: str = "*.html") -> DataFrame:
    """Reports in HTML: names from label and value cells, a row per line of three cells or more.

    The day is the one in the file's name; null if there is none that is a date.
    """

    def parse(where: str, raw: bytes):
        cells = _Cells()
        cells.feed(decode_text(raw)[0])
        labels: dict[str, str] = {}
        for row in cells.rows:
            if len(row) >= 2 and row[0][1]:
                labels.setdefault(row[0][1].rstrip(":").strip().lower(), row[1][1])
        day = _day_in_name(where)
        head: Row = {"report_date": day, "name_well": labels.get("well"), "name_wellbore": labels.get("wellbore"), "source_format": "html", "_replay_date": day}
        head["_source_identifier"] = head["name_wellbore"] or head["name_well"]
        for k, row in enumerate(cells.rows, 1):
            values = [text for tag, text in row if tag == "td"]
            if len(values) >= 3:
                yield head | {"activity_seq": str(k), "comments": " | ".join(values)}

    return parse_files(binary_files(spark, path, glob), parse, DDR_ACTIVITY)


def read_trajectory_station(spark: SparkSession, path: str, glob: str = "*.xml") -> DataFrame:
    """A row per station, with the unit each angle and depth was written in; undated stations take the survey's day."""
    station = (
        f"array<struct<_uid: string, dTimStn: string, typeTrajStation: string, statusTrajStation: string, md: {MEASURE}, tvd: {MEASURE}, incl: {MEASURE}, azi: {MEASURE}, "
        f"dispNs: {MEASURE}, dispEw: {MEASURE}, vertSect: {MEASURE}, dls: {MEASURE}>>"
    )
    schema = (
        f"_uid string, _uidWell string, _uidWellbore string, nameWell string, nameWellbore string, name string, serviceCompany string, dTimTrajStart string, dTimTrajEnd string, mdMn {MEASURE}, mdMx {MEASURE}, "
        f"aziRef string, aziVertSect {MEASURE}, magDeclUsed {MEASURE}, gridCorUsed {MEASURE}, trajectoryStation {station}"
    )
    rows = _xml(spark, path, "trajectory", schema, glob).select("*", F.posexplode("trajectoryStation").alias("seq", "st"))
    value = lambda c: _text(f"{c}._VALUE")
    found = {
        "name_well": _text("nameWell"), "name_wellbore": _text("nameWellbore"), "trajectory_name": _text("name"), "trajectory_uid": F.col("_uid"), "uid_well": F.col("_uidWell"), "uid_wellbore": F.col("_uidWellbore"),
        "service_company": _text("serviceCompany"), "dtim_traj_start": _text("dTimTrajStart"), "dtim_traj_end": _text("dTimTrajEnd"), "md_min": value("mdMn"), "md_max": value("mdMx"), "azi_ref": _text("aziRef"),
        "azi_vert_sect": value("aziVertSect"), "mag_decl_used": value("magDeclUsed"), "grid_cor_used": value("gridCorUsed"), "station_uid": F.col("st._uid"), "station_seq": F.col("seq") + 1,
        "dtim_station": _text("st.dTimStn"), "type_traj_station": _text("st.typeTrajStation"), "status_traj_station": _text("st.statusTrajStation"), "disp_ns": value("st.dispNs"), "disp_ew": value("st.dispEw"),
        "vert_sect": value("st.vertSect"), **{c: value(f"st.{c}") for c in ("md", "tvd", "incl", "azi", "dls")}, **{f"{c}_uom": F.col(f"st.{c}._uom") for c in ("md", "tvd", "incl", "azi", "dls")},
    }
    day = F.coalesce(local_day(found["dtim_station"]), local_day(found["dtim_traj_start"]))
    return _select(rows, TRAJECTORY_STATION, found, F.coalesce(found["name_wellbore"], found["name_well"]), day)


_OWNER = "_uid string, _uidWell string, _uidWellbore string, nameWell string, nameWellbore string, name string"


def _owner(uid: str, name: str) -> dict[str, Column]:
    return {"uid_well": F.col("_uidWell"), "uid_wellbore": F.col("_uidWellbore"), uid: F.col("_uid"), "name_well": _text("nameWell"), "name_wellbore": _text("nameWellbore"), name: _text("name")}


def read_witsml_message(spark: SparkSession, path: str, glob: str = "*.xml") -> DataFrame:
    rows = _xml(spark, path, "message", f"{_OWNER}, dTim string, md {MEASURE}, typeMessage string, messageText string, commonData struct<sourceName: string>", glob)
    rows = _with_namespace(spark, rows, path, glob)
    found = _owner("uid_message", "message_name") | {
        "namespace": F.col("_namespace"), "schema_version": F.col("_version"), "dtim": _text("dTim"), "md": _text("md._VALUE"), "md_uom": F.col("md._uom"), "type_message": _text("typeMessage"),
        "message_text": _text("messageText"), "source_name": _text("commonData.sourceName"),
    }
    return _select(rows, WITSML_MESSAGE, found, F.coalesce(found["name_wellbore"], found["name_well"]), local_day("dTim"))


_LOG = (
    f"{_OWNER}, indexType string, indexCurve string, startIndex {MEASURE}, endIndex {MEASURE}, startDateTimeIndex string, endDateTimeIndex string, direction string, "
    "logCurveInfo array<struct<_uid: string, mnemonic: string, unit: string, curveDescription: string>>, logData struct<mnemonicList: string, unitList: string, data: array<string>>"
)


def read_witsml_log_header(spark: SparkSession, path: str, glob: str = "*.xml") -> DataFrame:
    """A row per curve that a log declares."""
    rows = _with_namespace(spark, _xml(spark, path, "log", _LOG, glob), path, glob).select("*", F.posexplode("logCurveInfo").alias("seq", "curve"))
    found = _owner("uid_log", "log_name") | {
        "namespace": F.col("_namespace"), "schema_version": F.col("_version"), "index_type": _text("indexType"), "index_curve": _text("indexCurve"),
        "start_index": F.coalesce(_text("startIndex._VALUE"), _text("startDateTimeIndex")), "end_index": F.coalesce(_text("endIndex._VALUE"), _text("endDateTimeIndex")), "direction": _text("direction"),
        "curve_seq": F.col("seq") + 1, "mnemonic": F.coalesce(_text("curve.mnemonic"), F.col("curve._uid")), "unit": _text("curve.unit"), "curve_description": _text("curve.curveDescription"),
    }
    return _select(rows, WITSML_LOG_HEADER, found, F.coalesce(found["name_wellbore"], found["name_well"]), F.lit(None).cast("date"))


def read_witsml_log_data(spark: SparkSession, path: str, glob: str = "*.xml") -> DataFrame:
    """A row per index and curve. Values beyond the list of mnemonics are left out, a missing unit is null."""
    rows = _with_namespace(spark, _xml(spark, path, "log", _LOG, glob), path, glob)
    rows = rows.withColumns({"_names": F.split("logData.mnemonicList", ","), "_units": F.split("logData.unitList", ",")}).select("*", F.explode("logData.data").alias("_line"))
    rows = rows.withColumn("_values", F.split("_line", ","))
    cell = "transform(sequence(1, greatest(size(_names) - 1, 1)), k -> struct(trim(get(_names, k)) as mnemonic, nullif(trim(get(_units, k)), '') as unit, trim(get(_values, k)) as value))"
    rows = rows.where(F.size("_names") > 1).withColumn("cell", F.explode(F.expr(cell))).where("cell.value is not null")
    index = F.trim(F.get("_values", F.lit(0)))
    found = _owner("uid_log", "log_name") | {
        "namespace": F.col("_namespace"), "schema_version": F.col("_version"), "index_value": index, "mnemonic": F.col("cell.mnemonic"), "unit": F.col("cell.unit"), "value": F.col("cell.value"),
    }
    return _select(rows, WITSML_LOG_DATA, found, F.coalesce(found["name_wellbore"], found["name_well"]), local_day(index))


def _root(chunks: Iterator[bytes]) -> Row | None:
    """Root, namespace and version from a document's beginning; nothing is read behind its first tag."""
    found: list[Row] = []

    def start(name: str, attributes: dict[str, str]) -> None:
        if not found:
            spaces = [v for k, v in attributes.items() if k.split(":")[0] == "xmlns"]
            found.append({"root": name.split(":")[-1], "namespace": next((x for x in spaces if "witsml" in x.lower()), spaces[0] if spaces else None), "version": attributes.get("version")})

    parser = expat.ParserCreate()
    parser.StartElementHandler = start
    try:
        for chunk in chunks:
            parser.Parse(chunk, False)
            if found:
                return found[0]
    except expat.ExpatError:
        pass
    return found[0] if found else None


def _beginning(path: str, size: int = 1 << 14) -> Iterator[bytes]:
    store, inner = open_store(path)
    with store.open_input_stream(inner) as file:
        while chunk := file.read(size):
            yield chunk


def document_roots(spark: SparkSession, path: str, glob: str = "*.xml") -> DataFrame:
    """(_source_file, root, namespace, version) from each document's first tag, comments and declarations passed over."""
    listed = file_paths(spark, path, glob)
    direct = listed is not None
    files = listed if direct else binary_files(spark, path, glob)

    def run(batches):
        for batch in batches:
            rows = []
            for k, where in enumerate(batch.column("path").to_pylist()):
                row = _root(_beginning(where) if direct else iter([batch.column("content")[k].as_py()]))
                if row:
                    rows.append((where, row["root"], row["namespace"], row["version"]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], ["_source_file", "root", "namespace", "version"])

    return files.mapInArrow(run, "_source_file string, root string, namespace string, version string")


def survey_document_types(spark: SparkSession, path: str, glob: str = "*.xml") -> DataFrame:
    return document_roots(spark, path, glob).groupBy("root").agg(F.count("*").alias("documents"))


def _with_namespace(spark: SparkSession, rows: DataFrame, path: str, glob: str) -> DataFrame:
    bare = lambda c: F.regexp_replace(c, "^file:/+", "/")  # noqa: E731  the two sources spell local paths differently
    roots = document_roots(spark, path, glob).select(bare("_source_file").alias("_file"), F.col("namespace").alias("_namespace"), F.col("version").alias("_version"))
    return rows.join(roots, bare("_source_file") == F.col("_file"), "left").drop("_file")


def telemetry_samples(log_data: DataFrame) -> DataFrame:
    """Long log rows as wide text records for the telemetry contract; times without a zone are UTC."""
    from strataflow.operators.contract import CHANNELS

    channels = ("bit_depth_m", "hole_depth_m", *CHANNELS)
    wide = log_data.groupBy(F.col("_source_identifier").alias("source_identifier"), F.col("index_value")).pivot("mnemonic", list(channels)).agg(F.first("value", ignorenulls=True))
    at = F.to_timestamp("index_value")
    return wide.select(F.col("source_identifier"), F.col("source_identifier").alias("wellbore_uid"), F.unix_millis(at).cast("string").alias("ts"), *channels)


__all__ = [n for n in dir() if n.startswith("read_")] + ["document_roots", "file_name", "report_date_from_name", "survey_document_types", "telemetry_samples"]
