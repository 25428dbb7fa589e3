"""Joins beyond equality: overlapping intervals, dictionaries with fallbacks, set comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str], left_span: tuple[str, str], right_span: tuple[str, str], name: str = "overlap", width: float | None = None) -> DataFrame:
    """Pairs whose half-open intervals share a positive length, with that length.

    The keys are an equality, so Spark deals rows out by them. ``width`` cuts the axis into stretches,
    which then are part of the equality: an interval goes to each stretch that it touches, and a pair
    counts in the one where the later of the two begins. So only intervals of a neighbourhood meet,
    and a key with many rows is split; about the usual length of an interval is a good width.
    """
    other = right.select(*[F.col(k).alias(f"_{k}") for k in keys], *[F.col(c) for c in right.columns if c not in keys])
    same = F.lit(True)
    for k in keys:
        same &= F.col(k) == F.col(f"_{k}")
    begins = F.greatest(F.col(left_span[0]), F.col(right_span[0]))
    share = F.least(F.col(left_span[1]), F.col(right_span[1])) - begins
    if width is not None:
        stretch = lambda c: F.floor(c / F.lit(width)).cast("long")
        touched = lambda span: F.explode(F.sequence(stretch(F.col(span[0])), stretch(F.col(span[1]))))
        left = left.where(F.col(left_span[0]) < F.col(left_span[1])).withColumn("_stretch", touched(left_span))
        other = other.where(F.col(right_span[0]) < F.col(right_span[1])).withColumn("_stretch_of_right", touched(right_span))
        same &= (F.col("_stretch") == F.col("_stretch_of_right")) & (F.col("_stretch") == stretch(begins))
    return left.join(other, same & (share > 0)).withColumn(name, share).drop(*[f"_{k}" for k in keys], "_stretch", "_stretch_of_right")


def lookup(df: DataFrame, crosswalk: DataFrame, system: str = "_source_system", identifier: str = "_source_identifier") -> DataFrame:
    """``df`` with wellbore_uid: by (system, identifier), else by an identifier that means one uid everywhere.

    ``crosswalk`` has source_system, source_identifier, wellbore_uid; Spark broadcasts it if its size allows.
    """
    known = crosswalk.where("wellbore_uid is not null")
    exact = known.groupBy("source_system", "source_identifier").agg(F.min("wellbore_uid").alias("_exact"))
    alone = known.groupBy("source_identifier").agg(F.min("wellbore_uid").alias("_alone"), F.max("wellbore_uid").alias("_most")).where("_alone = _most").drop("_most")
    exact = exact.select(F.col("source_system").alias("_s"), F.col("source_identifier").alias("_i"), "_exact")
    alone = alone.select(F.col("source_identifier").alias("_j"), "_alone")
    out = df.join(exact, (F.col(system) == F.col("_s")) & (F.col(identifier) == F.col("_i")), "left")
    out = out.join(alone, F.col(identifier) == F.col("_j"), "left")
    return out.withColumn("wellbore_uid", F.coalesce("_exact", "_alone")).drop("_s", "_i", "_j", "_exact", "_alone")


def set_difference(expected: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """Keys on one side only, and on which; empty if both sides have the same keys."""
    a = expected.select(*keys).distinct().withColumn("in_expected", F.lit(True))
    b = actual.select(*keys).distinct().withColumn("in_actual", F.lit(True))
    both = a.join(b, keys, "full_outer")
    return both.where("in_expected is null or in_actual is null").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("in_expected", "in_actual")})
