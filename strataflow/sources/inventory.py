"""What an archive holds: entries with checksums and kinds, and which files are copies of others."""

from __future__ import annotations

import hashlib
import io
import re
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.sources.files import binary_files, decode_text

#: Evidence for each kind of source: pattern on the path, and its weight. Fixed values of our own.
EVIDENCE = {
    "PROD": [(r"production.*\.xlsx$", 80)],
    "DDR": [(r"drill.?report", 60), (r"_\d{4}_\d{2}_\d{2}\.(xml|html)$", 40)],
    "TRAJECTORY": [(r"trajector", 70)],
    "WITSML": [(r"witsml", 60), (r"realtime", 30)],
    "LAS": [(r"\.las$", 90)],
    "VSP": [(r"checkshot", 80), (r"vsp", 30)],
    "SEGY": [(r"\.(sgy|segy)$", 90)],
    "ECLIPSE": [(r"\.(prt|rsm|data)$", 70)],
    "GEOM": [(r"fault_", 60), (r"geom", 30)],
}
THRESHOLD, MARGIN, HIGH = 25, 8, 60


def inventory_scan(spark: SparkSession, path: str, glob: str = "*.zip") -> DataFrame:
    """(archive, entry, size, checksum, encoding) of every file in each zip; folders are left out."""

    def scan(batches):
        for batch in batches:
            for where, content in zip(batch.column("path"), batch.column("content")):
                with zipfile.ZipFile(io.BytesIO(content.as_py())) as archive:
                    for info in archive.infolist():
                        if info.is_dir():
                            continue
                        digest, head = hashlib.sha256(), b""
                        with archive.open(info) as part:
                            while chunk := part.read(1 << 20):
                                head = head or chunk[: 1 << 14]
                                digest.update(chunk)
                        encoding = "binary" if b"\0" in head else decode_text(head)[1]
                        row = (where.as_py(), info.filename, info.file_size, digest.hexdigest(), encoding)
                        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in row], ["archive", "entry", "size", "checksum", "encoding"])

    return binary_files(spark, path, glob).mapInArrow(scan, "archive string, entry string, size long, checksum string, encoding string")


def classify_entries(entries: DataFrame, column: str = "entry") -> DataFrame:
    """Entries with kind, score and confidence: the kind with most evidence, none if it is weak or contested."""
    scores = {kind: sum((F.when(F.lower(column).rlike(p), w).otherwise(0) for p, w in rules), F.lit(0)) for kind, rules in EVIDENCE.items()}
    ranked = F.array_sort(F.array(*[F.struct((-s).alias("minus"), F.lit(k).alias("kind")) for k, s in scores.items()]))
    out = entries.withColumn("_ranked", ranked)
    best, second = -F.col("_ranked")[0]["minus"], -F.col("_ranked")[1]["minus"]
    clear = (best >= THRESHOLD) & (best - second >= MARGIN)
    out = out.withColumns({"kind": F.when(clear, F.col("_ranked")[0]["kind"]), "score": best.cast("int"), "confidence": F.when(~clear, "none").when(best >= HIGH, "high").otherwise("medium")})
    return out.drop("_ranked")


def group_duplicates(entries: DataFrame) -> DataFrame:
    """(checksum, canonical, copies): files of equal content; the shortest name stands for them, the first of those."""
    named = F.struct(F.length("entry").alias("n"), F.col("entry").alias("entry"))
    return entries.groupBy("checksum").agg(F.min(named).getField("entry").alias("canonical"), F.count("*").alias("copies")).where("copies > 1")


def cross_archive_agreement(entries: DataFrame) -> DataFrame:
    """Pairs of archives by shared names: how many have equal content, and whether that is corroborated.

    Corroborated: three shared names or more, and half of them or more equal.
    """
    name = F.element_at(F.split("entry", "/"), -1)
    a = entries.select(F.col("archive").alias("left_archive"), name.alias("name"), F.col("checksum").alias("_a")).distinct()
    b = entries.select(F.col("archive").alias("right_archive"), name.alias("name"), F.col("checksum").alias("_b")).distinct()
    both = a.join(b, "name").where("left_archive < right_archive")
    out = both.groupBy("left_archive", "right_archive").agg(F.count_distinct("name").alias("shared"), F.count_distinct(F.when(F.col("_a") == F.col("_b"), F.col("name"))).alias("equal"))
    return out.withColumn("corroborated", (F.col("shared") >= 3) & (2 * F.col("equal") >= F.col("shared")))


def profile_text(raw: bytes) -> dict[str, str | int | None]:
    """Encoding, line ends, likely delimiter, forms of dates, sentinels and units of a text file."""
    text, encoding = decode_text(raw)
    lines = [x for x in text.splitlines() if x.strip()]
    ends = "crlf" if "\r\n" in text else "lf" if "\n" in text else None
    counts = {d: [line.count(d) for line in lines] for d in (",", ";", "\t", "|")}
    steady = [d for d, n in counts.items() if n and min(n) > 0 and max(n) == min(n)]
    dates = [name for name, p in (("iso", r"\d{4}-\d{2}-\d{2}"), ("dotted", r"\d{2}\.\d{2}\.\d{4}"), ("named", r"\d{1,2}[- ][A-Za-z]{3}[- ]\d{2,4}")) if re.search(p, text)]
    sentinels = sorted(set(re.findall(r"-999(?:\.25(?:0{0,3})|9(?:\.0+)?)?(?![\d.])", text)))
    units = sorted(set(re.findall(r"\b(?:Sm3|m3|bara|degC|lpm|rpm|klbf)\b", text)))
    return {"encoding": encoding, "line_ends": ends, "delimiter": steady[0] if steady else None, "dates": ",".join(dates) or None, "sentinels": ",".join(sentinels) or None, "units": ",".join(units) or None, "lines": len(text.splitlines())}


def spread_sample(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """n rows at even distances in the given order; all rows if there are no more.

    Rows are ranked by ranges of the order: each range has its own window, and begins with the number
    of rows in the ranges before it. The ranges are written once, as Spark draws them anew, and puts
    small ones together by other columns' bytes, whenever they are computed. Rows that ``order`` leaves
    equal are ranked at will.
    """
    from pyspark.sql import Window

    from strataflow.plans.scratch import written

    ranged = written(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = {r[0]: r[1] for r in ranged.groupBy("_range").count().collect()}
    total = sum(sizes.values())
    if total <= n:
        return df
    before, held = {}, 0
    for k in sorted(sizes):
        before[k], held = held, held + sizes[k]
    base = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])
    rank = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1 + F.element_at(base, F.col("_range"))
    picked = ranged.withColumn("_rank", rank).where(F.floor(F.col("_rank") * n / total) != F.floor((F.col("_rank") - 1) * n / total))
    return picked.drop("_rank", "_range")
