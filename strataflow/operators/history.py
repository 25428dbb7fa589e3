"""Slowly changing dimensions of type 2, and joins as of a day."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.functions.scalars import as_text, surrogate_key


def _collapse(rows: DataFrame, by: list[str], tracked: list[str], order: str, ties: list[str]) -> DataFrame:
    """Runs of equal ``_state`` in each group: number, first moment, least tracked values."""
    in_order = Window.partitionBy(*by).orderBy(F.col(order).asc_nulls_last(), *[F.col(t).asc_nulls_last() for t in ties])
    marked = rows.withColumn("_before", F.lag("_state").over(in_order))
    marked = marked.withColumn("_starts", F.when(F.col("_before").isNull() | (F.col("_before") != F.col("_state")), 1).otherwise(0))
    marked = marked.withColumn("_run", F.sum("_starts").over(in_order.rowsBetween(Window.unboundedPreceding, 0)).cast("int"))
    return marked.groupBy(*by, "_run").agg(F.min("_state").alias("_state"), *[F.min(c).alias(c) for c in tracked], F.min(order).alias(order))


def scd2(df: DataFrame, key: str, tracked: list[str], order: str, ties: tuple[str, ...] = (), chunk: Column | None = None) -> DataFrame:
    """Versions of each key: consecutive rows with equal tracked values become one.

    key, tracked columns, version_number, valid_from, valid_to (null while open), is_current,
    key_hash. Values compare as text with null as empty. A value that comes back later starts a new
    version. Rows without a key drop out. ``ties`` orders rows of the same key and moment.

    Where single keys hold a large share of the rows, give a ``chunk``, such as the month of the
    order column: runs are then collapsed within (key, chunk) first, and only what changes meets
    again under the key. The result is the same.
    """
    state = F.concat_ws("|", *[F.coalesce(as_text(c), F.lit("")) for c in tracked])
    names = list(dict.fromkeys([key, order, *tracked, *ties]))
    rows = df.where(F.col(key).isNotNull()).select(*names, state.alias("_state"), *([chunk.alias("_chunk")] if chunk is not None else []))
    inner = list(ties)
    if chunk is not None:
        rows = _collapse(rows, [key, "_chunk"], tracked, order, inner).withColumnRenamed("_run", "_local")
        inner = ["_local"]
    versions = _collapse(rows, [key], tracked, order, inner).withColumnsRenamed({"_run": "version_number", order: "valid_from"})
    following = F.lead("valid_from").over(Window.partitionBy(key).orderBy("version_number"))
    versions = versions.withColumn("valid_to", following)
    return versions.select(key, *tracked, "version_number", "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_current"), surrogate_key(key, "version_number").alias("key_hash"))


def last_before(rows: DataFrame, marks: DataFrame, key: str, at: str, mark_at: str, ties: tuple[str, ...] = (), chunk: Callable[[Column], Column] | None = None) -> DataFrame:
    """``rows`` with ``_mark``: the last of the key's ``marks`` whose ``mark_at`` isn't after ``at``, as a struct; null if none.

    Both sides are put in one order under the key and the last mark is carried on, so a key costs its
    sorting and never pairs. Where single keys hold a large share of all rows, ``chunk`` cuts the
    order, as F.year would: each stretch is a task's work, begun with the mark that was last before it.
    """
    packed = F.struct(*[F.col(c) for c in marks.columns])
    cut = chunk or (lambda c: F.lit(0))
    own = rows.withColumns({"_at": F.col(at), "_first": F.lit(1), "_mark": F.lit(None).cast(marks.select(packed.alias("m")).schema["m"].dataType), "_chunk": cut(F.col(at))})
    given = marks.where(F.col(key).isNotNull()).select(F.col(key), F.col(mark_at).alias("_at"), F.lit(0).alias("_first"), packed.alias("_mark"), cut(F.col(mark_at)).alias("_chunk"))
    by_tie = [F.col(f"_mark.{t}").asc_nulls_last() for t in ties]
    if chunk is not None:
        begins = own.where(F.col(key).isNotNull()).select(key, "_chunk").distinct().withColumns({"_first": F.lit(0), "_begins": F.lit(True)})
        along = Window.partitionBy(key).orderBy(F.col("_chunk").asc_nulls_first(), F.col("_begins").desc_nulls_last(), "_at", *by_tie).rowsBetween(Window.unboundedPreceding, 0)
        carried = given.unionByName(begins, allowMissingColumns=True).withColumn("_mark", F.last("_mark", ignorenulls=True).over(along))
        given = given.unionByName(carried.where("_begins and _mark is not null").drop("_begins").withColumn("_first", F.lit(-1)))
    both = own.unionByName(given, allowMissingColumns=True)
    along = Window.partitionBy(key, "_chunk").orderBy(F.when(F.col("_first") == -1, 0).otherwise(1), F.col("_at").asc_nulls_first(), "_first", *by_tie).rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("_mark", F.last("_mark", ignorenulls=True).over(along)).where("_first = 1").drop("_first", "_chunk", "_at")


def asof_join(facts: DataFrame, versions: DataFrame, key: str, moment: str, columns: dict[str, str], chunk: Callable[[Column], Column] | None = None) -> DataFrame:
    """Each fact with the version valid at its moment, in [valid_from, valid_to); facts without one stay.

    ``columns`` maps names in ``versions`` to names in the result. Versions of a key don't overlap, as
    ``scd2`` makes them. ``chunk``: see ``last_before``.
    """
    marks = versions.select(F.col(key), "valid_from", "valid_to", *columns)
    joined = last_before(facts, marks, key, moment, "valid_from", chunk=chunk)
    holds = F.col(moment).isNotNull() & F.col(key).isNotNull() & (F.col("_mark.valid_to").isNull() | (F.col(moment) < F.col("_mark.valid_to")))
    return joined.select(*[F.col(c) for c in facts.columns], *[F.when(holds, F.col(f"_mark.{a}")).alias(b) for a, b in columns.items()])


def unresolved_key(identifier: Column | str) -> Column:
    """Stand-in key of a fact whose dimension isn't known; never null."""
    return surrogate_key(F.lit("UNRESOLVED"), identifier)
