"""Parts the training-data operators share: scratch tables, Arrow slicing, vectorised words.

Scratch tables live in the folder that ``spark.checkpoint.dir`` names, which all executors
share, so a lost executor never takes the only copy of an intermediate result with it.
"""

from __future__ import annotations

import hashlib
import re
import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

U64 = np.uint64


def shared_folder(spark: SparkSession) -> str:
    """The shared folder of the session; a temporary one of our own only where none is set and all runs in one process."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="strataflow-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/strataflow/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, spark: SparkSession | None = None) -> DataFrame:
    """``df`` written to the shared folder as Parquet and read again, by ``spark`` if given: cuts the lineage."""
    spark = spark or df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls count as empty texts."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = int(offsets[0]) if len(offsets) else 0
    return data[first : int(offsets[-1])], offsets - first


def slices(batch: pa.RecordBatch, column: str, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of ``batch`` with at most ``limit`` text bytes each, one row at least."""
    if not batch.num_rows:
        return
    _, offsets = text_bytes(batch.column(column))
    begin = 0
    while begin < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[begin] + limit, "right")) - 1
        end = min(max(end, begin + 1), batch.num_rows)
        yield batch.slice(begin, end - begin)
        begin = end


#: Estimated bytes below which rows are dealt out to all cores before heavy work on them.
SMALL = 64 << 20


def spread(df: DataFrame) -> DataFrame:
    """Small inputs, which may be a single row group, dealt out as a shuffle would be; larger ones as they are.

    Large inputs come in many row groups, so there a shuffle would gain nothing.
    """
    spark = df.sparkSession
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(parts) if 0 < size < SMALL else df


def map_slices(df: DataFrame, column: str, make: Callable[[pa.RecordBatch], pa.RecordBatch], schema, limit: int = 2 << 20) -> DataFrame:
    """``mapInArrow`` over byte-bounded slices, so memory doesn't depend on the batch's rows."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, column, limit):
                yield make(part)

    return spread(df).mapInArrow(run, schema)


class Memo(dict):
    """What a worker remembers of each word, as bytes; it starts afresh before it holds over ``limit`` bytes.

    The estimate counts a word as four bytes a character and its ids as no more than that, besides
    what Python needs for two objects and their entry. A worker goes from query to query and from stage
    to stage: where all its memories together would hold over the ``limit`` of the one that learns, the
    others start afresh first. ``beside`` is a dictionary of answers of a fixed size that goes with them.
    """

    #: Bytes of an answer beside the words.
    ANSWER = 160
    _all: list[weakref.ref] = []

    def __init__(self, learn: Callable[[list[str]], list[bytes]], limit: int = 64 << 20, beside: dict | None = None):
        super().__init__()
        self.learn, self.limit, self.held, self.once = learn, limit, 0, []
        self.beside = {} if beside is None else beside
        Memo._all = [x for x in Memo._all if x() is not None] + [weakref.ref(self)]

    def forget(self) -> None:
        self.clear()
        self.beside.clear()
        self.held, self.once = 0, []

    def all_held(self) -> int:
        return self.held + self.ANSWER * len(self.beside)

    def know(self, words: set[str], longest: int = 1024) -> None:
        """Have all of ``words``, the new ones learnt together; those over ``longest`` characters until the next call only."""
        for word in self.once:
            del self[word]
        cost = lambda new: sum(8 * len(word) + 200 for word in new if len(word) <= longest)
        new = [word for word in words if word not in self]  # a set's own difference would go through all that is known
        size = cost(new)
        others = [x for ref in Memo._all if (x := ref()) is not None and x is not self]
        if new and sum(x.all_held() for x in (self, *others)) + size > self.limit:
            for x in others:
                x.forget()
        if self.held + size > self.limit:
            self.clear()
            new = list(words)
            self.held, size = 0, cost(new)
        self.update(zip(new, self.learn(new)) if new else ())
        self.once = [word for word in new if len(word) > longest]
        self.held += size


class WordKind:
    """Which bytes of UTF-8 belong to words, and what a byte counts as."""

    def __init__(self, member: np.ndarray, fold_case: bool):
        self.member = member
        value = np.arange(256)
        if fold_case:
            value[65:91] += 32
        self.key = _BYTE_KEYS[value]


_draw = np.random.Generator(np.random.PCG64(20240229))
_BYTE_KEYS = _draw.integers(1 << 40, 1 << 63, 256, dtype=U64) | U64(1)
_STEP = int(_draw.integers(1 << 60, 1 << 63)) | 1
_REACH = 1 << 16
_POWERS = np.multiply.accumulate(np.concatenate([[U64(1)], np.full(_REACH, _STEP, U64)]))
_INVERSES = np.multiply.accumulate(np.concatenate([[U64(1)], np.full(_REACH, pow(_STEP, -1, 1 << 64), U64)]))

_codes = np.arange(256)
#: Words of letters and digits: ASCII 0-9 A-Z a-z and every character above U+007F; A-Z count as a-z.
ALNUM = WordKind((_codes >= 0x80) | ((_codes >= 48) & (_codes < 58)) | ((_codes >= 65) & (_codes < 91)) | ((_codes >= 97) & (_codes < 123)), True)
#: Words between ASCII white space (space and U+0009 to U+000D), as they are.
SPACED = WordKind(~((_codes == 32) | ((_codes >= 9) & (_codes <= 13))), False)


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every input bit over 64 bits."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class Words:
    """Words of concatenated texts: byte spans, 64-bit hashes and the words' range of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, kind: WordKind = ALNUM):
        inside = kind.member[data]
        n = len(data)
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        edges = offsets[(offsets > 0) & (offsets < n)]
        begins[edges] = inside[edges]
        ends[edges - 1] = inside[edges - 1]
        self.begins, self.ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.begins, offsets)
        self.counts = np.diff(self.first)
        self.hashes = _hash_spans(data, self.begins, self.ends, kind.key)
        self.data, self.key = data, kind.key

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the k words from each word on, and whether all k lie in one text."""
        n = len(self.hashes)
        room = np.repeat(self.first[1:], self.counts) - np.arange(n) >= k
        out = np.zeros(n, U64)
        if n >= k:
            acc = self.hashes[: n - k + 1].copy()
            for t in range(1, k):
                acc *= U64(0x9E3779B97F4A7C15)
                acc += self.hashes[t : n - k + 1 + t]
            out[: n - k + 1] = mix(acc)
        return out, room

    def stems(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The words of more than ``size`` bytes, and the hashes of their first ``size`` bytes."""
        longer = np.flatnonzero(self.ends - self.begins > size)
        begins = self.begins[longer]
        return longer, mix(_hash_spans(self.data, begins, begins + size, self.key) + U64(size))

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)


def _hash_spans(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, key: np.ndarray) -> np.ndarray:
    out = np.empty(len(begins), U64)
    i = 0
    while i < len(begins):
        base = int(begins[i])
        j = int(np.searchsorted(ends, base + _REACH, "right"))
        if j <= i:  # a single word beyond the reach of the tables
            digest = hashlib.blake2b(key[data[base : int(ends[i])]].tobytes(), digest_size=8).digest()
            out[i] = int.from_bytes(digest, "little")
            i += 1
            continue
        size = int(ends[j - 1]) - base
        total = np.zeros(size + 1, U64)
        np.cumsum(key[data[base : base + size]] * _POWERS[:size], out=total[1:])
        b, e = begins[i:j] - base, ends[i:j] - base
        out[i:j] = mix((total[e] - total[b]) * _INVERSES[b] + (e - b).astype(U64) * U64(0xD6E8FEB86659FD93))
        i = j
    return out


_CUT = re.compile(r"(?<=\w) (?=\w)")


def safe_pieces(text: str, limit: int = 1 << 16) -> list[str]:
    """``text`` cut before single spaces between word characters, about every ``limit`` characters.

    The pre-tokenizer patterns of byte-level BPE start a new match at each such space and never
    look behind, so the pieces' tokens are the text's tokens.
    """
    if len(text) <= limit:
        return [text]
    out, begin = [], 0
    while len(text) - begin > limit and (cut := _CUT.search(text, begin + limit)):
        out.append(text[begin : cut.start()])
        begin = cut.start()
    out.append(text[begin:])
    return out


def extend(docs: DataFrame, make: Callable[[pa.RecordBatch], dict[str, pa.Array]], added: str, carry: list[str] | None = None, column: str = "text", limit: int = 2 << 20) -> DataFrame:
    """``docs`` with the columns ``added`` ("name type, ...") that ``make`` computes from each slice.

    A narrow map: no shuffle. Columns of ``docs`` with the same names are replaced. Only the columns
    that ``carry`` names come back from Python, all unless it is given.
    """
    names = [part.split()[0] for part in added.split(", ")]
    docs = docs.drop(*names)
    kept = [f for f in docs.schema if carry is None or f.name in carry]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = make(batch)
        return pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), *(made[n] for n in names)], [*(f.name for f in kept), *names])

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)
    return map_slices(docs, column, run, kinds + added, limit)


def spans_in(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many set flags lie between each two neighbouring offsets."""
    return np.diff(np.searchsorted(np.flatnonzero(flags), offsets))


def covered(n: int, begins: np.ndarray, width: int) -> np.ndarray:
    """Which of n positions lie within ``width`` positions from any of ``begins`` on."""
    steps = np.zeros(n + width + 1, np.int32)
    np.add.at(steps, begins, 1)
    np.add.at(steps, begins + width, -1)
    return np.cumsum(steps)[:n] > 0


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    r"""(begins, ends, first): the \n-split lines of each text, an empty text having one empty line."""
    breaks = np.flatnonzero(data == 10)
    begins = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    ends = np.sort(np.concatenate([breaks, offsets[1:]]))
    first = np.concatenate([[0], np.cumsum(np.diff(np.searchsorted(breaks, offsets)) + 1)]).astype(np.int64)
    return begins, ends, first


def hash_spans(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans as they are."""
    return _hash_spans(data, begins, ends, _BYTE_KEYS)


def seen_before(keys: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key whether it occurs earlier in its group, and whether it occurs there more than once."""
    joint = mix(keys ^ mix(groups.astype(U64) * U64(0x9E3779B97F4A7C15) + U64(1)))
    order = np.argsort(joint, kind="stable")
    same = joint[order[1:]] == joint[order[:-1]]
    earlier, twice = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    earlier[order[1:]] = same
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    return earlier, twice
