"""Where names of wellbores are seen: landing tables, file names, archives, simulator decks.

Each observer gives rows of (source_system, source_identifier, identifiers, defines_identifier,
occurrences, seen) for ``resolve_identities``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.operators.identity import identifier_kind
from strataflow.sources.files import binary_files, decode_text, parse_files

#: By landing table: system, order of trust, columns with official identifiers, and whether they define them.
OBSERVED = {
    "prod_daily": ("PROD", 1, ("npd_well_bore_code",), True),
    "prod_monthly": ("PROD_MONTHLY", 2, ("npdcode",), True),
    "ddr_activity": ("DDR", 3, ("npd_code_wellbore", "npd_number"), True),
    "trajectory_station": ("TRAJECTORY", 4, ("uid_wellbore",), True),
    "witsml_message": ("WITSML", 5, ("uid_wellbore",), False),
    "las_curve_header": ("LAS", 6, ("uwi",), False),
    "vsp_checkshot": ("VSP", 7, (), False),
}


def observe_table(landing: DataFrame, system: str, seen: int, identifiers: tuple[str, ...], defines: bool) -> DataFrame:
    """Names in a landing table with the official identifiers written beside them."""
    known = [F.when(identifier_kind(c).isNotNull(), F.trim(c)) for c in identifiers]
    found = F.array_compact(F.array(*known)) if known else F.array().cast("array<string>")
    rows = landing.where("_source_identifier is not null").select(F.col("_source_identifier").alias("source_identifier"), found.alias("identifiers"))
    merged = rows.groupBy("source_identifier", "identifiers").agg(F.count("*").alias("occurrences"))
    return merged.select(F.lit(system).alias("source_system"), "source_identifier", "identifiers", (F.lit(defines) & (F.size("identifiers") > 0)).alias("defines_identifier"), "occurrences", F.lit(seen).alias("seen"))


def observe_names(paths: DataFrame, system: str, pattern: str, seen: int = 20) -> DataFrame:
    """Names inside file, folder or archive names: what the pattern's first group holds. ``paths`` has a path column."""
    name = F.regexp_extract("path", pattern, 1)
    rows = paths.select(name.alias("source_identifier")).where("source_identifier <> ''").groupBy("source_identifier").agg(F.count("*").alias("occurrences"))
    return rows.select(F.lit(system).alias("source_system"), "source_identifier", F.array().cast("array<string>").alias("identifiers"), F.lit(False).alias("defines_identifier"), "occurrences", F.lit(seen).alias("seen"))


def observe_welspecs(spark: SparkSession, path: str, glob: str = "*.DATA") -> DataFrame:
    """Well names under the WELSPECS keyword of simulator decks, up to the lone slash that ends it."""

    def parse(_: str, raw: bytes):
        inside = False
        for line in decode_text(raw)[0].splitlines():
            text = line.partition("--")[0].strip()
            if text.upper() == "WELSPECS":
                inside = True
            elif text == "/":
                inside = False
            elif inside and text:
                yield {"name": text.split()[0].strip("'\"")}

    rows = parse_files(binary_files(spark, path, glob), parse, ("name",))
    rows = rows.groupBy(F.col("name").alias("source_identifier")).agg(F.count("*").alias("occurrences"))
    return rows.select(F.lit("ECLIPSE").alias("source_system"), "source_identifier", F.array().cast("array<string>").alias("identifiers"), F.lit(False).alias("defines_identifier"), "occurrences", F.lit(30).alias("seen"))


def observe_all(landing: dict[str, DataFrame], more: list[DataFrame] | None = None) -> DataFrame:
    """All observations of the landing tables at hand, and any others."""
    parts = [observe_table(landing[name], *rest) for name, rest in OBSERVED.items() if name in landing]
    return reduce(DataFrame.unionByName, [*parts, *(more or [])])
