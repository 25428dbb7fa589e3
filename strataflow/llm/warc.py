r"""WARC archives: writing with revisit records, and reading by boundary-chain verification.

Archives are written by Spark's text writer with the record terminator as line separator, and
read by its text reader with the magic word as separator. Both work on any store, split large
files and recover lost tasks.

A magic word may also stand inside a payload. So every piece after a magic word is only a
candidate: its header says where the next record must begin. Within a block of a file, tasks
follow these links to where they leave the block; between blocks, pointer jumping from the file's
start doubles the reach each round. What is not reached is payload of the record around it.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataflow.llm.common import remove_path, scratch_path, written

MAGIC = "WARC/1."
END = "\r\n\r\n"
_LENGTH = r"(?i)\r\nContent-Length:[ \t]*([0-9]{1,18})[ \t]*\r\n"
#: Blocks whose entry points are broadcast at a time; more are read in several scans.
BLOCKS_AT_ONCE = 50_000


def with_revisits(pages: DataFrame, least: int = 100) -> DataFrame:
    """Pages with payload, payload_bytes, payload_digest, record_type and refers_to.

    Of pages whose payloads are equal and have ``least`` bytes, the one with the smallest page_id is
    the response (all rows of that id, if it repeats), the others revisit it. A null html is an empty
    payload. Pages without an id can't be referred to; they revisit a page that has one.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    pages = pages.select("page_id", "url", payload.alias("payload"), F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha2(payload.cast("binary"), 256).alias("payload_digest"))
    firsts = pages.where(F.col("payload_bytes") >= least).groupBy("payload_digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("pages")).where("pages > 1 and first_id is not null")
    # Written first, so that Spark knows its size and moves no payloads where it can broadcast it.
    joined = pages.join(written(firsts.select("payload_digest", "first_id"), "warc-firsts"), "payload_digest", "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.withColumn("record_type", F.when(revisit, "revisit").otherwise("response")).withColumn("refers_to", F.when(revisit, F.col("first_id"))).drop("first_id")


def write_warc(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write a record per row of ``with_revisits``' result. A revisit's block has the HTTP header alone."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("none")), F.lit(">"))
    uri = F.replace(F.coalesce(F.regexp_replace("url", r"[\x00-\x20\x7f]", "_"), F.lit("")), F.lit(MAGIC), F.lit(MAGIC.replace("/", "%2F")))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit(END))
    is_revisit = F.col("record_type") == "revisit"
    block = F.when(is_revisit, http).otherwise(F.concat(http, "payload"))
    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", urn("page_id")),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", uri),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "payload_digest")),
        F.when(is_revisit, F.concat(line("WARC-Refers-To", urn("refers_to")), line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")))).otherwise(""),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
    )
    pages.select(record.alias("value")).write.option("lineSep", END).text(path)


def _fixed_cuts(spark: SparkSession) -> SparkSession:
    """A session with the settings of ``spark`` in which every scan cuts files alike, even if executors come or go."""
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if name.startswith("spark.sql.") and spark.conf.isModifiable(name):
            own.conf.set(name, value)
    if own.conf.get("spark.sql.files.minPartitionNum", None) is None:
        own.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    return own


def _pieces(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """What stands between magic words, in file order within each block that a task reads."""
    text = spark.read.option("lineSep", MAGIC).text(paths)
    return text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _blocks(pieces: DataFrame) -> DataFrame:
    """A row per block: its bytes, and places of its candidates and their successors from its first piece on."""
    header = F.substring_index("value", END, 1)
    size, ends = F.octet_length("value").cast("long"), F.octet_length(header).cast("long")
    # Searched here, in the whole header: only the number goes to Python, however long the other fields are.
    length = F.regexp_extract(F.concat(header, F.when(ends < size, "\r\n").otherwise(MAGIC)), _LENGTH, 1).try_cast("long")
    heads = pieces.select("file", "block", size.alias("size"), ends.alias("ends"), F.substring("value", 1, 3).isin("0\r\n", "1\r\n").alias("starts"), length.alias("length"))

    def gather(batches):
        key, begins, nexts, at, pending = None, [], [], 0, None

        def row():
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]]), pa.array([key[1]], pa.int64()), pa.array([at], pa.int64()), pa.array([begins], pa.list_(pa.int64())), pa.array([nexts], pa.list_(pa.int64()))],
                ["file", "block", "span", "begins", "nexts"],
            )

        for batch in batches:
            for file, block, size, ends, starts, length in zip(*(c.to_pylist() for c in batch.columns)):
                if key != (file, block):
                    if key is not None:
                        yield row()
                    key, begins, nexts, at, pending = (file, block), [], [], 0, None
                if (block or at) and starts:
                    pending = (at - len(MAGIC), length)
                elif pending is not None and pending[1] is None:  # a header that holds the magic word goes on in the next piece
                    pending = (pending[0], length)
                if pending is not None and ends < size:
                    if pending[1] is not None:
                        begins.append(pending[0])
                        nexts.append(at + ends + len(END) + pending[1] + len(END))
                    pending = None
                at += size + len(MAGIC)
        if key is not None:
            yield row()

    found = heads.mapInArrow(gather, "file string, block long, span long, begins array<long>, nexts array<long>")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return found.withColumn("base", F.coalesce(F.sum("span").over(before), F.lit(0)))


def _exits(begins: list[int], nexts: list[int], end: int) -> dict[int, int]:
    """Where the chain from each candidate leaves the block that ends at ``end``; -1 where it breaks."""
    out: dict[int, int] = {}
    for begin, following in zip(reversed(begins), reversed(nexts)):
        out[begin] = following if following >= end - len(MAGIC) and following not in out else out.get(following, -1)
    return out


def _edges(blocks: DataFrame) -> DataFrame:
    def exits(batches):
        for batch in batches:
            for file, block, span, base, begins, nexts in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "span", "base", "begins", "nexts"))):
                found = _exits(begins, nexts, span)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file] * len(found), pa.string()), pa.array([block] * len(found), pa.int64()), pa.array([base + k for k in found], pa.int64()), pa.array([base + k if k >= 0 else -1 for k in found.values()], pa.int64())],
                    ["file", "block", "at", "to"],
                )

    return blocks.mapInArrow(exits, "file string, block long, at long, to long")


def _entries(blocks: DataFrame) -> DataFrame:
    """(file, block, entry): where the chain from the file's start first touches each block."""
    edges = written(_edges(blocks), "warc-edges")
    most = blocks.groupBy("file").count().agg(F.max("count")).first()[0] or 1
    jump = edges.select("file", "at", "to").where("to >= 0")
    reached = edges.where("at = 0").select("file", "at")
    for _ in range(math.ceil(math.log2(most)) if most > 1 else 0):
        step = jump.select("file", "at", F.col("to").alias("via"))
        ahead = reached.join(step, ["file", "at"]).select("file", F.col("via").alias("at"))
        reached = written(reached.union(ahead).distinct(), "warc-reached")
        after = jump.select("file", F.col("at").alias("via"), "to")
        jump = written(step.join(after, ["file", "via"]).select("file", "at", "to"), "warc-jump")
    return edges.join(reached, ["file", "at"], "left_semi").select("file", "block", F.col("at").alias("entry"))


def _plan(blocks: DataFrame) -> DataFrame:
    """Blocks with their entry, the last record that begins in an earlier block of the file, whether
    their own last record ends in a later one, and where the chain of their last record goes on."""
    joined = blocks.join(_entries(blocks), ["file", "block"], "left")

    def last(batches):
        for batch in batches:
            rows = batch.to_pylist()
            lasts, cut, stops = [], [], []
            for row in rows:
                follow, at, seen = dict(zip(row["begins"], row["nexts"])), None if row["entry"] is None else row["entry"] - row["base"], None
                while at in follow:
                    seen, at = at, follow[at]
                lasts.append(None if seen is None else seen + row["base"])
                cut.append(seen is not None and at > row["span"] - len(MAGIC))
                stops.append(None if seen is None else at + row["base"])
            columns = [*(batch.column(c) for c in ("file", "block", "span", "base", "entry")), pa.array(lasts, pa.int64()), pa.array(cut, pa.bool_()), pa.array(stops, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["file", "block", "span", "base", "entry", "last", "cut", "stop"])

    lasts = joined.mapInArrow(last, "file string, block long, span long, base long, entry long, last long, cut boolean, stop long")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return lasts.withColumn("open", F.last("last", ignorenulls=True).over(before)).drop("last")


_FIELD = re.compile(rb"\r\n([^:\r\n]+):[ \t]*([^\r\n]*)")
_RECORD = "file string, offset long, missing long, at long, record_type string, record_id string, refers_to string, target_uri string, payload_digest string, block binary"


def _assemble(batches):
    """Join pieces to records. Rows with ``missing`` > 0, or not at their record's offset, are parts of a record cut by a block's end."""
    key, begin, fields, parts, missing, at, pending = None, None, None, [], 0, 0, None
    rows: list[tuple] = []

    def close():
        if begin is not None and (fields is not None or parts):
            get = (fields or {}).get
            rows.append((key[0], begin, missing, first_at, *(None if get(n) is None else get(n).decode("utf-8", "replace") for n in (b"warc-type", b"warc-record-id", b"warc-refers-to", b"warc-target-uri", b"warc-payload-digest")), b"".join(parts)))

    def flush():
        columns = list(zip(*rows)) or [()] * 10
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), *[pa.string()] * 5, pa.binary()]
        batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [x.split()[0] for x in _RECORD.split(", ")])
        rows.clear()
        return batch

    first_at, held = 0, 0
    for batch in batches:
        for value, file, block, base, entry, opened in zip(*(batch.column(c) for c in ("value", "file", "block", "base", "entry", "open"))):
            if key != (file.as_py(), block.as_py()):
                close()
                key, at = (file.as_py(), block.as_py()), base.as_py()
                if at is None:
                    raise ValueError(f"no plan for block {key}: the file was cut otherwise before")
                begin, fields, parts, missing, first_at, pending = opened.as_py(), None, [], 1 << 62, at, None
                expected = entry.as_py()
            view = memoryview(value.as_buffer())
            here = at - len(MAGIC)
            if here == expected and (key[1] or at):
                close()
                begin, fields, parts, missing, first_at, expected, pending = here, None, [], 0, here, None, b""
            if pending is not None:
                pending += (MAGIC.encode() if here != begin else b"") + bytes(view)
                head = pending.find(END.encode())
                if head >= 0:
                    fields = {k.lower(): v.strip() for k, v in _FIELD.findall(pending, 0, head)}
                    length = fields.get(b"content-length", b"")
                    if length.isdigit():
                        size, body = int(length), pending[head + len(END) :]
                        expected = here + len(MAGIC) + len(view) - len(body) + size + len(END)
                        missing, parts = max(0, size - len(body)), [body[:size]]
                    else:  # the chain breaks here
                        begin, fields = None, None
                    pending = None
            elif begin is not None and missing:
                taken = (MAGIC.encode() + bytes(view))[:missing]
                if fields is None and not parts:
                    first_at = here
                parts.append(taken)
                missing -= len(taken)
            held += len(view)
            at += len(view) + len(MAGIC)
            if held > 4 << 20 and rows:
                yield flush()
                held = 0
    close()
    if rows:
        yield flush()


def broken_chains(plan: DataFrame) -> DataFrame:
    """(file, offset): files whose chain of records doesn't reach their end, and where it stops; the terminator of the last record may be missing."""
    ends = plan.groupBy("file").agg(F.max(F.col("base") + F.col("span")).alias("end"), F.coalesce(F.max("stop"), F.lit(0)).alias("offset"))
    return ends.where(F.abs(F.col("end") - len(MAGIC) - F.col("offset")) > len(END)).select("file", "offset")


def read_warc(spark: SparkSession, path: str, blocks_at_once: int = BLOCKS_AT_ONCE, broken: str = "keep") -> DataFrame:
    """file, offset, record_type, record_id, refers_to, target_uri, payload_digest, block of each record.

    Uncompressed archives of versions 1.0 and 1.1. A file that doesn't begin with a record gives
    none; where a chain breaks, the records before it stay. ``broken``: "keep" says no more of that,
    "mark" gives such a file a row of record_type ``broken`` at the place where its chain stops, and
    "raise" raises. A header that holds the magic word and is cut by a block's end counts as a break;
    ``write_warc`` makes none. Headers and payloads have any length, a record may be larger than a
    block. Empty folders give no rows.
    """
    if broken not in ("keep", "mark", "raise"):
        raise ValueError("broken is keep, mark or raise")
    spark = _fixed_cuts(spark)
    plan = written(_plan(written(_blocks(_pieces(spark, path)), "warc-blocks")), "warc-plan")
    if broken == "raise" and (some := broken_chains(plan).limit(3).collect()):
        raise ValueError("chains of records break: " + ", ".join(f"{r.file} at {r.offset}" for r in some))
    count = plan.count()
    if count <= blocks_at_once:
        scans = [(path, plan)]
    else:
        groups = -(-count // blocks_at_once)
        marked = plan.withColumn("group", F.pmod(F.xxhash64("file"), F.lit(groups)))
        scans = []
        for k in range(groups):
            part = marked.where(F.col("group") == k).drop("group")
            if files := [x[0] for x in part.select("file").distinct().collect()]:
                scans.append((files, part))
    out = None
    for paths, part in scans:
        pieces = _pieces(spark, paths).select(F.col("value").cast("binary").alias("value"), "file", "block")
        rows = pieces.join(F.broadcast(part.drop("cut", "span", "stop")), ["file", "block"], "left").mapInArrow(_assemble, _RECORD)
        out = rows if out is None else out.union(rows)
    names = ["record_type", "record_id", "refers_to", "target_uri", "payload_digest"]
    first = F.col("at") == F.col("offset")
    whole = (F.col("missing") == 0) & first
    records = out.where(whole).select("file", "offset", *names, "block")
    if broken == "mark":
        marks = {"record_type": F.lit("broken")}
        records = records.unionByName(broken_chains(plan).select("file", "offset", *[marks.get(n, F.lit(None).cast("string")).alias(n) for n in names], F.lit(None).cast("binary").alias("block")))
    if plan.where("cut").isEmpty():
        return records
    cut = out.where(~whole)
    # Parts of a record that begins in one block and ends in another: few, and no more of one than its bytes.
    joined = cut.groupBy("file", "offset").agg(
        F.array_sort(F.collect_list(F.struct("at", "block"))).alias("parts"), F.max(F.when(first, F.col("missing") + F.octet_length("block"))).cast("int").alias("size"), *(F.max(n).alias(n) for n in names)
    ).where("size is not null")
    whole_block = F.expr("substring(aggregate(parts, cast('' as binary), (a, x) -> concat(a, x.block)), 1, size)")
    joined = joined.select("file", "offset", *names, whole_block.alias("block"))
    return records.unionByName(joined)


def payloads(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of response and revisit records.

    A response's figures come from its bytes; a revisit's from its headers.
    """
    number = lambda c: F.expr(f"try_cast(regexp_extract({c}, '^<urn:page:(-?[0-9]+)>$', 1) as bigint)")
    text = F.col("block").cast("string")
    http = F.substring_index(text, END, 1)
    body = F.expr(f"substring(block, octet_length(substring_index(cast(block as string), '{END}', 1)) + {len(END) + 1})".replace("\r", "\\r").replace("\n", "\\n"))
    declared = F.regexp_extract(http, r"(?i)\r\nContent-Length:[ \t]*(\d{1,18})", 1).try_cast("long")
    revisit = F.col("record_type") == "revisit"
    return records.where(F.col("record_type").isin("response", "revisit")).select(
        number("record_id").alias("page_id"),
        F.when(revisit, declared).otherwise(F.octet_length(body).cast("long")).alias("payload_bytes"),
        F.when(revisit, F.regexp_replace("payload_digest", "^sha256:", "")).otherwise(F.sha2(body, 256)).alias("payload_digest"),
        "record_type",
        number("refers_to").alias("refers_to"),
    )


def warc_round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives to the shared folder, read them back, and give their payload figures.

    A row per page: repeated rows stay, null ids stay null, a null html is empty, a null url an empty
    field; urls and payloads have any length. Other columns, of whatever names, are ignored. An empty
    table gives no rows. A chain that broke would raise, so no page is lost silently.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_warc(with_revisits(pages), path)
    result = written(payloads(read_warc(spark, path, broken="raise")), "warc-payloads", spark)
    remove_path(spark, path)
    return result
