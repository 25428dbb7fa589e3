"""Benchmark decontamination by winnowed fingerprints.

Of every ``reach`` consecutive words, the k-word hash that is smallest is kept, in benchmark and
training texts alike. A stretch of ``reach`` words that both share therefore keeps the same hash
on both sides, so each one is found. Where fingerprints meet, the hit is extended to the windows
around it, which are compared word by word.

A benchmark of up to one block goes out to the tasks that scan the corpus. A larger one is joined by
shuffle: the corpus gives only windows that a filter of fixed size lets through, keyed by the text
they come from, so neither texts nor fingerprints of the whole corpus move.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import U64, Words, covered, extend, map_slices, mix, text_bytes, written

#: Bytes of benchmark text that are broadcast; larger benchmarks are joined by shuffle.
BLOCK_BYTES = 32 << 20
#: Bits of each filter in the shuffle join, so 16 MB, whatever the tables' sizes.
FILTER_BITS = 27
#: Shares into which rows of one text, or windows of one key, are dealt.
SALTS = 16


def _span_hash(hashes: np.ndarray, begins: np.ndarray, n: int) -> np.ndarray:
    acc = np.full(len(begins), n, U64)
    for t in range(n):
        acc = (acc ^ hashes[begins + t]) * U64(0x9E3779B97F4A7C15)
        acc ^= acc >> U64(29)
    return acc


def winnowed(words: Words, window: int, k: int) -> np.ndarray:
    """Where the smallest k-word hash of any window lies; windows don't cross texts."""
    grams, _ = words.grams(k)
    n, w = len(grams), window - k + 1
    chosen = np.zeros(n, bool)
    if n < w:
        return np.flatnonzero(chosen)
    least = grams[: n - w + 1].copy()
    for t in range(1, w):
        np.minimum(least, grams[t : n - w + 1 + t], out=least)
    room = (np.repeat(words.first[1:], words.counts) - np.arange(n) >= window)[: n - w + 1]
    for t in range(w):
        chosen[t : n - w + 1 + t] |= room & (grams[t : n - w + 1 + t] == least)
    return np.flatnonzero(chosen)


def around(words: Words, places: np.ndarray, window: int, k: int) -> np.ndarray:
    """Beginnings of the windows that hold the k words at any of ``places``."""
    room = np.repeat(words.first[1:], words.counts) - np.arange(len(words.hashes))
    begins = np.unique((places[:, None] - np.arange(window - k + 1)).ravel())
    begins = begins[begins >= 0]
    return begins[room[begins] >= window]


class Fingerprints:
    """Windows of benchmark items, and the fingerprints that lead to them."""

    def __init__(self, items: list[tuple[str, str]], window: int, k: int):
        self.window, self.k, self.reach = window, k, window - k + 1
        self.names = [name for name, _ in items]
        words = Words(*text_bytes(pa.array([text for _, text in items], pa.string())))
        self.hashes = words.hashes
        owners = words.owners()
        self.marks = np.unique(words.grams(k)[0][self.keep(words)])
        self.table = np.zeros(1 << 16, bool)
        self.table[(self.marks >> U64(48)).astype(np.int64)] = True
        #: By length in words: (sorted window hashes, a place of each in the benchmark, first owner, owners).
        self.windows: dict[int, tuple[np.ndarray, ...]] = {}
        room = np.repeat(words.first[1:], words.counts) - np.arange(len(owners))
        sizes = np.minimum(words.counts, window)
        for n in np.unique(sizes[sizes > 0]):
            begins = np.flatnonzero((room >= n) & (sizes[owners] == n)) if len(owners) else np.zeros(0, np.int64)
            keys = _span_hash(self.hashes, begins, int(n))
            pairs = np.unique(np.stack([keys, owners[begins].astype(U64)], 1), axis=0)
            unique, first = np.unique(pairs[:, 0], return_index=True)
            _, place = np.unique(keys, return_index=True)
            self.windows[int(n)] = unique, begins[place], np.append(first, len(pairs)), pairs[:, 1].astype(np.int64)

    def keep(self, words: Words) -> np.ndarray:
        return winnowed(words, self.window, self.k)

    def matches(self, words: Words, begins: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Of the n-word windows at ``begins``: those of the benchmark, and which windows they are."""
        keys, place, _, _ = self.windows[n]
        found = _span_hash(words.hashes, begins, n)
        at = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
        same = keys[at] == found
        begins, at = begins[same], at[same]
        equal = np.ones(len(begins), bool)
        for t in range(n):
            equal &= words.hashes[begins + t] == self.hashes[place[at] + t]
        return begins[equal], at[equal]

    def scan(self, words: Words) -> tuple[np.ndarray, list[list[str]]]:
        """Which words lie in an occurrence of a window, and each text's items with occurrences."""
        total = len(words.hashes)
        hit = np.zeros(total, bool)
        room = np.repeat(words.first[1:], words.counts) - np.arange(total)
        owners, pairs = words.owners(), []
        for n, (_, _, first, holders) in self.windows.items():
            if n == self.window:
                kept = self.keep(words)
                marks = words.grams(self.k)[0][kept]
                some = self.table[(marks >> U64(48)).astype(np.int64)]
                kept, marks = kept[some], marks[some]
                begins = around(words, kept[np.isin(marks, self.marks)], n, self.k)
            else:  # items shorter than a window are looked for at every word
                begins = np.flatnonzero(room >= n)
            begins, which = self.matches(words, begins, n)
            hit |= covered(total, begins, n)
            text_and_window = np.unique(np.stack([owners[begins], which], 1), axis=0)
            for text, window in text_and_window:
                pairs.append((int(text), holders[first[window] : first[window + 1]]))
        items: list[set[str]] = [set() for _ in words.counts]
        for text, found in pairs:
            items[text].update(self.names[x] for x in found)
        return hit, [sorted(x) for x in items]


@lru_cache(maxsize=1)
def _of_block(block) -> Fingerprints:
    return Fingerprints(*block.value)


_ADDED = "n_words bigint, n_hit bigint, hit_words binary, hit_items array<string>"


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, k: int = 5, block_bytes: int = BLOCK_BYTES, carry: list[str] | None = None) -> DataFrame:
    """``docs`` with n_words, n_hit, hit_words (bits, big-endian, one a word) and hit_items (sorted ids).

    A window is ``window`` consecutive words of an item, all its words if it has fewer. Null and
    empty texts have no words, very long ones are scanned whole; items without words, and those with
    a null id, have no windows; an id that several rows share stands for all of them. Repeated rows
    of ``docs`` each give a row; columns with the added names are replaced; empty tables on either
    side give no hits. A benchmark of up to ``block_bytes`` is broadcast and nothing is shuffled; a
    larger one is joined, with the same result.
    """
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where("item_id is not null and text is not null")
    held = rows.agg(F.sum(F.octet_length("text") + F.length("item_id"))).first()[0] or 0
    if held > block_bytes:
        return _joined(docs, rows, window, k, carry)
    block = docs.sparkSession.sparkContext.broadcast(([tuple(x) for x in rows.collect()], window, k))

    def scan(batch: pa.RecordBatch):
        words = Words(*text_bytes(batch.column("text")))
        hit, items = _of_block(block).scan(words)
        bits = [hit[a:b] for a, b in zip(words.first[:-1], words.first[1:])]
        return {
            "n_words": pa.array(words.counts, pa.int64()),
            "n_hit": pa.array([int(x.sum()) for x in bits], pa.int64()),
            "hit_words": pa.array([np.packbits(x).tobytes() for x in bits], pa.binary()),
            "hit_items": pa.array(items, pa.list_(pa.string())),
        }

    return extend(docs, scan, _ADDED, carry)


def _window_keys(words: Words, begins: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of each window, together its identity."""
    return _span_hash(words.hashes, begins, n), mix(_span_hash(mix(words.hashes), begins, n))


def _rows_of(schema: pa.Schema, parts: list[tuple]) -> pa.RecordBatch:
    columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0)] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c).cast(f.type) for c, f in zip(columns, schema)], schema.names)


def _joined(docs: DataFrame, rows: DataFrame, window: int, k: int, carry: list[str] | None) -> DataFrame:
    """``contamination`` by a join of windows: those of the benchmark with those of the corpus that two filters let through.

    The filters, of winnowed fingerprints and of windows, have a fixed size; where a benchmark has so
    many windows that they fill up, more of the corpus's windows are shuffled, but none is lost. What
    the corpus gives is keyed by the text's digest, so copies count once and no text moves.
    """
    spark = docs.sparkSession
    shift = U64(64 - FILTER_BITS)

    def item_windows(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = Words(*text_bytes(batch.column("text")))
        owners, names = words.owners(), np.array(batch.column("item_id").to_pylist(), object)
        room, sizes = np.repeat(words.first[1:], words.counts) - np.arange(len(owners)), np.minimum(words.counts, window)
        marked = np.zeros(len(owners), bool)
        marked[winnowed(words, window, k)] = True
        marks = words.grams(k)[0] if len(owners) else np.zeros(0, U64)
        parts = []
        for n in np.unique(sizes[sizes > 0]):
            begins = np.flatnonzero((room >= n) & (sizes[owners] == n))
            a, b = _window_keys(words, begins, int(n))
            parts.append((np.full(len(begins), n), a.view(np.int64), b.view(np.int64), names[owners[begins]], (a >> shift).astype(np.int64), np.full(len(begins), -1)))
        at = np.flatnonzero(marked)
        parts.append((np.zeros(len(at), np.int64), *[np.zeros(len(at), np.int64)] * 2, np.full(len(at), None, object), np.full(len(at), -1), (marks[at] >> shift).astype(np.int64)))
        return _rows_of(pa.schema([("n", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("item_id", pa.string()), ("place", pa.int64()), ("mark", pa.int64())]), parts)

    cut = written(map_slices(rows, "text", item_windows, "n long, a long, b long, item_id string, place long, mark long"), "winnow-items")
    lengths = sorted(r[0] for r in cut.where("n > 0").select("n").distinct().collect())

    def filled(column: str) -> np.ndarray:
        """A filter with the places in ``column`` set: at most 2 ** (FILTER_BITS - 6) rows come to the driver."""
        bits = cut.where(F.col(column) >= 0).groupBy(F.shiftright(column, 6).alias("word")).agg(F.expr(f"bit_or(shiftleft(1L, cast({column} & 63 as int)))").alias("bits")).toArrow()
        out = np.zeros(1 << (FILTER_BITS - 6), np.int64)
        out[bits["word"].to_numpy()] = bits["bits"].to_numpy()
        return out

    filters = spark.sparkContext.broadcast((filled("place"), filled("mark")))

    def passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
        at = (keys >> shift).astype(np.int64)
        return (bits[at >> 6] >> (at & 63)) & 1 == 1

    def candidates(batch: pa.RecordBatch) -> pa.RecordBatch:
        places, marks = filters.value
        words = Words(*text_bytes(batch.column("text")))
        owners, keys = words.owners(), np.array(batch.column("_text_key").to_pylist(), object)
        room = np.repeat(words.first[1:], words.counts) - np.arange(len(owners))
        parts = []
        for n in lengths:
            if n == window:
                kept = winnowed(words, window, k)
                begins = around(words, kept[passes(marks, words.grams(k)[0][kept])], window, k)
            else:
                begins = np.flatnonzero(room >= n)
            a, b = _window_keys(words, begins, n)
            some = passes(places, a)
            begins, owner = begins[some], owners[begins[some]]
            parts.append((keys[owner], words.counts[owner], np.full(len(begins), n), begins - words.first[owner], a[some].view(np.int64), b[some].view(np.int64)))
        return _rows_of(pa.schema([("_text_key", pa.string()), ("n_words", pa.int64()), ("n", pa.int64()), ("begin", pa.int64()), ("a", pa.int64()), ("b", pa.int64())]), parts)

    def mark(batches):
        for batch in batches:
            bits = []
            for words, spans in zip(batch.column("n_words").to_pylist(), batch.column("spans").to_pylist()):
                flags = np.zeros(words, bool)
                for span in spans:
                    flags[span["begin"] : span["begin"] + span["n"]] = True
                bits.append(flags)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_text_key"), pa.array([int(x.sum()) for x in bits], pa.int64()), pa.array([np.packbits(x).tobytes() for x in bits], pa.binary()), batch.column("hit_items")],
                ["_text_key", "n_hit", "hit_words", "hit_items"],
            )

    keyed = docs.drop("n_words", "n_hit", "hit_words", "hit_items").withColumn("_text_key", F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    found = map_slices(keyed.select("_text_key", "text"), "text", candidates, "_text_key string, n_words long, n long, begin long, a long, b long")
    found = written(found.distinct(), "winnow-candidates")
    window_key, salts = ["n", "a", "b"], F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    occurring = written(cut.where("n > 0").select(*window_key, "item_id").distinct().join(found.select(*window_key).distinct(), window_key, "left_semi"), "winnow-occurring")
    salted = found.withColumn("_salt", F.pmod(F.xxhash64("_text_key"), F.lit(SALTS)).cast("int"))
    hits = salted.join(occurring.withColumn("_salt", salts), [*window_key, "_salt"]).groupBy("_text_key").agg(
        F.first("n_words").alias("n_words"), F.collect_set(F.struct("begin", "n")).alias("spans"), F.array_sort(F.collect_set("item_id")).alias("hit_items")
    )
    marked = written(hits.mapInArrow(mark, "_text_key string, n_hit long, hit_words binary, hit_items array<string>"), "winnow-hits")

    counted = extend(keyed, lambda batch: {"n_words": pa.array(Words(*text_bytes(batch.column("text"))).counts, pa.int64())}, "n_words bigint", None if carry is None else [*carry, "_text_key"])
    dealt = counted.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    out = dealt.join(marked.withColumn("_salt", salts), ["_text_key", "_salt"], "left")
    none = F.unhex(F.repeat(F.lit("00"), F.ceil(F.col("n_words") / 8).cast("int")))
    return out.select(
        *[c for c in counted.columns if c not in ("_text_key", "n_words")], "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("hit_words", none).alias("hit_words"), F.coalesce("hit_items", F.array().cast("array<string>")).alias("hit_items")
    )


def contamination_digests(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row; all else as in ``contamination``."""
    return contamination(docs.select("doc_id", "text"), benchmark, carry=["doc_id"]).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
