"""Bounded samples of labelled documents for fitting small models on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Documents whose id's CRC is divisible by this are held out of every fit.
FOLDS = 5


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """Whether a document's label may not be learnt from; null ids are held out."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def drawn(rows: DataFrame, n: int, seed: int) -> DataFrame:
    """At most n rows, those of the smallest hashed ids: the same ones whatever the partitioning."""
    return rows.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(n)


def labelled_ids(labels: DataFrame, column: str, value: int, n: int | None = None, seed: int = 0) -> DataFrame:
    """Ids outside the held-out part with this label, n at most if given; an id with several rows needs one label."""
    one = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min(column).alias("least"), F.max(column).alias("most"))
    ids = one.where((F.col("least") == value) & (F.col("most") == value) & ~held_out()).select("doc_id")
    return ids if n is None else drawn(ids, n, seed)
