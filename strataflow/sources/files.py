"""Whole files to rows: tasks list and read them, a parser turns bytes to dicts.

Files are the unit of work, so each is parsed in one task; rows leave in Arrow batches of bounded
size while the file is still being read. The driver holds nothing for each file, so folders may have
any number of small ones; only from stores that tasks can't open by an address does Spark list and read them.
"""

from __future__ import annotations

import fnmatch
import json
import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

Row = dict[str, str | None]
BATCH_ROWS = 10_000


def decode_text(raw: bytes) -> tuple[str, str]:
    """(text, encoding): UTF-8 with or without its mark, else Windows-1252; what that lacks becomes U+FFFD."""
    for encoding in ("utf-8-sig", "utf-8"):
        try:
            return raw.decode(encoding), encoding
        except UnicodeDecodeError:
            continue
    return raw.decode("cp1252", errors="replace"), "cp1252"


#: Stores of which a task can list folders and read files by their address.
DIRECT = ("file", "hdfs", "s3", "gs")
BATCH_BYTES = 4 << 20


def open_store(path: str):
    """(file system, path in it) of an address, as Spark or Arrow spell it."""
    from pyarrow import fs

    return (fs.LocalFileSystem(), "/" + path[5:].lstrip("/")) if path.startswith("file:") else fs.FileSystem.from_uri(path)


def _hidden(name: str) -> bool:
    """Names that Spark's sources pass over as well."""
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def _entries(folder: str) -> Iterator[tuple[str, bool]]:
    """(address, whether a folder) of what a folder holds."""
    if folder.startswith("file:"):
        with os.scandir(folder[5:]) as found:
            yield from ((f"{folder}/{x.name}", x.is_dir()) for x in found if not _hidden(x.name))
        return
    from pyarrow import fs

    store, inner = open_store(folder)
    yield from ((f"{folder}/{x.base_name}", x.type == fs.FileType.Directory) for x in store.get_file_info(fs.FileSelector(inner)) if not _hidden(x.base_name))


def _below(folder: str) -> Iterator[str]:
    for where, is_folder in _entries(folder):
        if is_folder:
            yield from _below(where)
        else:
            yield where


def _batches(rows: Iterator[tuple], names: list[str], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == BATCH_ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)


def _direct(spark: SparkSession, path: str, glob: str | None) -> str | None:
    """Address of a folder that tasks can list themselves; none if Spark must, or must say that it isn't there."""
    if any(c in path for c in "*?[{\\") or any(c in (glob or "") for c in "[{\\"):
        return None
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    if (at.toUri().getScheme() or "file") not in DIRECT:
        return None
    fs = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    at = fs.makeQualified(at)
    if at.toUri().getScheme() not in DIRECT or not fs.exists(at) or not fs.getFileStatus(at).isDirectory():
        return None
    return at.toString()


def file_paths(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame | None:
    """(path): the files below a folder, dealt evenly to tasks; none if only Spark can list it.

    One task lists the folder, others what lies in its subfolders. The rows' size is unknown to the
    planner, so it doesn't broadcast them before it has seen how many there are.
    """
    folder = _direct(spark, path, glob)
    if folder is None:
        return None

    def first(batches):
        for batch in batches:
            for where in batch.column("path").to_pylist():
                yield from _batches(((w, d) for w, d in _entries(where) if d or wanted(w)), ["path", "folder"], [pa.string(), pa.bool_()])

    def rest(batches):
        for batch in batches:
            found = ((w,) for where, is_folder in zip(batch.column("path").to_pylist(), batch.column("folder").to_pylist()) for w in (filter(wanted, _below(where)) if is_folder else [where]))
            yield from _batches(found, ["path"], [pa.string()])

    def wanted(where: str) -> bool:
        return not glob or fnmatch.fnmatchcase(file_name(where), glob)

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    start = spark.createDataFrame(spark.sparkContext.parallelize([(folder,)], 1), "path string")
    deep = start.mapInArrow(first, "path string, folder boolean").repartition(tasks, "path").mapInArrow(rest, "path string")
    return deep.repartition(tasks, "path")


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, types = ["path", "content"], [pa.string(), pa.binary()]
    for batch in batches:
        held, size = [], 0
        for where in batch.column("path").to_pylist():
            store, inner = open_store(where)
            with store.open_input_stream(inner) as file:
                held.append((where, file.read()))
            size += len(held[-1][1])
            if size >= BATCH_BYTES:
                yield from _batches(iter(held), names, types)
                held, size = [], 0
        yield from _batches(iter(held), names, types)


def binary_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(path, content) of the files below a folder. What is there when the rows are computed counts."""
    found = file_paths(spark, path, glob)
    if found is not None:
        return found.mapInArrow(_contents, "path string, content binary")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return (reader.option("pathGlobFilter", glob) if glob else reader).load(path).select("path", "content")


def parse_files(files: DataFrame, parse: Callable[[str, bytes], Iterator[Row]], columns: tuple[str, ...]) -> DataFrame:
    """Rows of all files: the columns as text, and ``_source_file`` and ``_source_identifier``.

    A row of the parser may bring ``_source_identifier`` and ``_replay_date``.
    """
    names = [*columns, "_replay_date", "_source_file", "_source_identifier"]
    schema = ", ".join(f"`{n}` string" for n in names)

    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                path, held = path.as_py(), []
                for row in parse(path, content.as_py()):
                    held.append([row.get(n) if n != "_source_file" else path for n in names])
                    if len(held) == BATCH_ROWS:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*held)], names)
                        held = []
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*held)], names)

    return files.mapInArrow(run, schema)


class _Written(WriterCommitMessage):
    def __init__(self, own: str):
        self.own = own


class WholeFiles(DataSource):
    """Rows of (name, content) as files of those names and bytes below the folder in the option ``path``.

    Tasks write under other names, and list the names meant in a file beside them: the driver hears of a
    task's folder, never of a file. A job that is finished leaves the list of those folders, from
    which ``write_files`` gives the files their names; what isn't finished goes. The store is any that
    Arrow reads by its address, and must be one that all executors share.
    """

    @classmethod
    def name(cls):
        return "whole_files"

    def writer(self, schema, overwrite):
        return _FileWriter(self.options["path"], self.options["job"])


class _FileWriter(DataSourceWriter):
    def __init__(self, folder: str, job: str):
        self.folder, self.job = folder, job

    def write(self, iterator):
        store, folder = open_store(self.folder)
        own = f"{folder}/{self.job}/{uuid.uuid4().hex}"
        store.create_dir(own)
        with store.open_output_stream(f"{own}/names") as names:
            for k, row in enumerate(iterator):
                with store.open_output_stream(f"{own}/{k}") as out:
                    out.write(bytes(row["content"]))
                names.write(json.dumps(row["name"]).encode() + b"\n")
        return _Written(own)

    def commit(self, messages):
        store, folder = open_store(self.folder)
        store.create_dir(f"{folder}/{self.job}")
        with store.open_output_stream(f"{folder}/{self.job}/done") as out:
            out.write(json.dumps([message.own for message in messages if message]).encode())

    def abort(self, messages):
        from pyarrow import fs

        store, folder = open_store(self.folder)
        if store.get_file_info(f"{folder}/{self.job}").type == fs.FileType.Directory:
            store.delete_dir(f"{folder}/{self.job}")


def _name(folder: str, own: str) -> None:
    """Give the files of a task's folder their names; a task that does so again goes on where it stopped."""
    from pyarrow import fs

    store, inner = open_store(folder)
    made = set()
    with store.open_input_stream(f"{own}/names") as file:
        for k, line in enumerate(_lines(file)):
            name = f"{inner}/{json.loads(line)}"
            parent = name.rpartition("/")[0]
            if parent not in made:
                store.create_dir(parent)
                made.add(parent)
            try:
                store.move(f"{own}/{k}", name)
            except OSError:
                if store.get_file_info(f"{own}/{k}").type != fs.FileType.NotFound or store.get_file_info(name).type != fs.FileType.File:
                    raise


def _lines(file) -> Iterator[bytes]:
    rest = b""
    while chunk := file.read(1 << 16):
        *whole, rest = (rest + chunk).split(b"\n")
        yield from whole


def write_files(files: DataFrame, folder: str) -> None:
    """Write rows of (name, content) as files below ``folder``, each whole or not at all.

    The rows are dealt evenly to tasks before, as small files cost by their number and not by their bytes.
    """
    spark, job = files.sparkSession, f"_{uuid.uuid4().hex}"
    spark.dataSource.register(WholeFiles)
    dealt = files.select("name", "content").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "name")
    dealt.write.format("whole_files").mode("append").option("path", folder).option("job", job).save()
    store, inner = open_store(folder)
    try:
        with store.open_input_stream(f"{inner}/{job}/done") as file:
            written = json.loads(file.read())
        if written:
            spark.sparkContext.parallelize(written, len(written)).foreach(lambda own: _name(folder, own))
    finally:
        store.delete_dir(f"{inner}/{job}")


def file_name(path: str) -> str:
    return path.rstrip("/").rpartition("/")[2]


def stem(path: str) -> str:
    name = file_name(path)
    return name.rpartition(".")[0] or name
