"""Token ids as Arrow files of fixed-size lists, for zero-copy random access.

Each file is a complete Arrow IPC file. Its batches hold three fixed-size-list columns of equal
length: ``ids`` (unsigned, as narrow as the vocabulary allows), ``valid`` (false on the padding
at the file's end) and ``ends`` (true on each document's last id). Lists have no offsets, so token k of a file is element
k % length of row k // length, read through a memory map without copying. The schema's metadata
holds the documents' ids in order and the file's place in the whole.

Files are written by Spark's text writer, one row a file: a row is an Arrow file without its last
six bytes, and the line separator is the magic word that ends every Arrow file. So they go to any
store that Spark writes, and Spark's commit protocol covers lost and repeated tasks.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm.common import Memo, remove_path, scratch_path, slices, written
from strataflow.llm.tokens import load_tokenizer

MAGIC = b"ARROW1"
#: Parts of a dataset whose bases are added up in one task; there are as many tasks, and a level of sums above them.
PARTS = 1024
#: Letters, numbers and white space among the characters on whose kinds all Unicode tables agree.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏΑ-ΡΣ-ωЀ-џ"
NUMBERS = "0-9²³¹¼-¾"
SPACES = r" \t\n\r"
#: Texts of these characters alone are cut into words here.
SETTLED = rf"[{SPACES}!-~¡-ɏΑ-ΡΣ-ωЀ-џ‐-‧€]*"
#: The byte-level pre-tokenizer's pattern, a fixed value of the public format, over those characters.
WORDS = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{SPACES}{LETTERS}{NUMBERS}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"


class WordEncoder:
    """Ids of texts by a byte-level BPE tokenizer, whose words are encoded once per worker.

    Texts with unusual characters or with the tokenizer's special strings go to the library as
    they are; so does every vocabulary whose pre-tokenizer isn't the byte-level one.
    """

    def __init__(self, path: str, remember: int = 64 << 20):
        self.tokenizer = load_tokenizer(path)
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.width = np.dtype(self.kind).itemsize
        self.special = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.plain = type(self.tokenizer.pre_tokenizer).__name__ == "ByteLevel" and self.tokenizer.normalizer is None
        self.plain = self.plain and "add_prefix_space=False" in str(self.tokenizer.pre_tokenizer)
        self.find = re.compile(WORDS).findall
        self.settled = re.compile(SETTLED).fullmatch
        self.spaced = re.compile(f" [{LETTERS}]+").fullmatch
        vocabulary = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)  # ids whose text begins with a space
        self.opens[[k for token, k in vocabulary.items() if token[0] == "Ġ"]] = True
        self.memo = Memo(self._learn, remember)

    def _direct(self, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, self.kind).tobytes() for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> list[bytes]:
        """Ids of words. Those of a space and letters stay words when joined, and only
        their first ids begin with a space: one call serves many, and its ids fall apart at those."""
        joined = [word for word in words if self.spaced(word)]
        rest = list(set(words).difference(joined))
        found = dict(zip(rest, self._direct(rest)))
        for k in range(0, len(joined), 4096):
            part = joined[k : k + 4096]
            ids = np.array(self.tokenizer.encode_batch_fast(["".join(part)], add_special_tokens=False)[0].ids, self.kind)
            packed = ids.tobytes()
            cuts = [*(np.flatnonzero(self.opens[ids]) * self.width).tolist(), len(packed)]
            if len(cuts) != len(part) + 1:
                raise ValueError("the vocabulary doesn't keep words apart")
            found.update(zip(part, map(packed.__getitem__, map(slice, cuts[:-1], cuts[1:]))))
        return list(map(found.__getitem__, words))

    def packed(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, little-endian."""
        found: list[list[str] | None] = []
        for text in texts:
            usual = self.plain and self.settled(text) and not any(x in text for x in self.special)
            found.append(self.find(text) if usual else None)
        known = self.memo
        known.know(set().union(*(x for x in found if x)))
        return [self._direct([text])[0] if words is None else b"".join(map(known.__getitem__, words)) for text, words in zip(texts, found)]


@lru_cache(maxsize=2)
def load_encoder(path: str, remember: int = 64 << 20) -> WordEncoder:
    """The worker's encoder for a vocabulary; it remembers words of so many bytes."""
    return WordEncoder(path, remember)


def _bits(flags: np.ndarray, length: int) -> pa.FixedSizeListArray:
    values = pa.Array.from_buffers(pa.bool_(), len(flags), [None, pa.py_buffer(np.packbits(flags, bitorder="little").tobytes())])
    return pa.FixedSizeListArray.from_arrays(values, length)


def arrow_file(ids: np.ndarray, sizes: np.ndarray, doc_ids: pa.Array, length: int, place: tuple[int, int], batch_rows: int = 1024) -> bytes:
    """One Arrow file of the documents whose ids lie one after another in ``ids``."""
    rows = -(-len(ids) // length)
    padded = np.zeros(rows * length, ids.dtype)
    padded[: len(ids)] = ids
    valid, ends = np.zeros(rows * length, bool), np.zeros(rows * length, bool)
    valid[: len(ids)] = True
    ends[np.cumsum(sizes) - 1] = True
    names = pa.BufferOutputStream()
    with pa.ipc.new_stream(names, pa.schema([("doc_id", pa.int64())])) as out:
        out.write_batch(pa.RecordBatch.from_arrays([doc_ids.cast(pa.int64())], ["doc_id"]))
    meta = {"place": json.dumps(place), "length": str(length), "tokens": str(len(ids)), "doc_ids": base64.b64encode(names.getvalue().to_pybytes()).decode()}
    columns = [pa.FixedSizeListArray.from_arrays(pa.array(padded), length), _bits(valid, length), _bits(ends, length)]
    table = pa.Table.from_arrays(columns, ["ids", "valid", "ends"]).replace_schema_metadata(meta)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_file(sink, table.schema) as out:
        out.write_table(table, max_chunksize=batch_rows)
    return sink.getvalue().to_pybytes()


class SequenceFile:
    """Random access to an Arrow file of sequences; nothing is copied until a slice is taken."""

    def __init__(self, source):
        self.reader = pa.ipc.open_file(source)
        meta = self.reader.schema.metadata
        self.place = tuple(json.loads(meta[b"place"]))
        self.length, self.tokens = int(meta[b"length"]), int(meta[b"tokens"])
        self.doc_ids = pa.ipc.open_stream(base64.b64decode(meta[b"doc_ids"])).read_all().column(0)

    def batches(self):
        for k in range(self.reader.num_record_batches):
            batch = self.reader.get_batch(k)
            flat = [c.values.slice(c.offset * self.length, len(c) * self.length) for c in batch.columns]
            yield flat[0].to_numpy(zero_copy_only=True), *(x.to_numpy(zero_copy_only=False) for x in flat[1:])

    def documents(self):
        """(doc_id, number of ids, CRC-32 of the ids as 32-bit integers) of each document in order."""
        names, size, crc = iter(self.doc_ids.to_pylist()), 0, 0
        for ids, valid, ends in self.batches():
            wide = ids.astype("<u4")
            begin = 0
            for end in (np.flatnonzero(ends) + 1).tolist():
                yield next(names), size + end - begin, zlib.crc32(wide[begin:end], crc)
                begin, size, crc = end, 0, 0
            rest = int(valid[begin:].sum())
            size, crc = size + rest, zlib.crc32(wide[begin : begin + rest], crc)


def write_sequences(docs: DataFrame, tokenizer_path: str, path: str, end_id: int = 2, length: int = 2048, file_tokens: int = 4 << 20) -> None:
    """Encode ``docs`` in ascending doc_id order, each with ``end_id`` after it, into Arrow files.

    Null ids come first; rows of equal id are ordered by their text, repeated rows stay. Null and empty
    texts have the end id alone; a very long text is one document in one file. An empty table gives a
    folder without files. Other columns, of whatever names, are ignored. One range shuffle on doc_id;
    a task holds one file of about ``file_tokens`` ids at a time.
    """

    def encode(batches):
        encoder, task, count = load_encoder(tokenizer_path, 160 << 20), TaskContext.get().partitionId(), 0
        ids, sizes, names, held = [], [], [], 0

        def file():
            whole = arrow_file(np.frombuffer(b"".join(ids), encoder.kind), np.array(sizes, np.int64), pa.chunked_array(names).combine_chunks(), length, (task, count))
            return pa.RecordBatch.from_arrays([pa.array([whole[: -len(MAGIC)]], pa.binary())], ["value"])

        end = np.array([end_id], encoder.kind).tobytes()
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                named, begin = part.column("doc_id"), 0
                for k, packed in enumerate(encoder.packed([x or "" for x in part.column("text").to_pylist()])):
                    ids += packed, end
                    sizes.append(len(packed) // len(end) + 1)
                    held += sizes[-1]
                    if held >= file_tokens:
                        names.append(named.slice(begin, k + 1 - begin))
                        yield file()
                        ids, sizes, names, held, count, begin = [], [], [], 0, count + 1, k + 1
                names.append(named.slice(begin))
        if held:
            yield file()

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    files = ordered.mapInArrow(encode, "value binary").select(F.col("value").cast("string"))
    files.write.option("lineSep", MAGIC.decode()).option("maxRecordsPerFile", 1).text(path)


def read_sequences(spark: SparkSession, path: str) -> DataFrame:
    """part, seq, position, doc_id, n_tokens, ids_crc32 of every document in the files.

    An output folder without files (of an empty table) gives no rows.
    """

    def read(batches):
        for batch in batches:
            for content in batch.column("content"):
                file = SequenceFile(pa.BufferReader(content.as_buffer()))
                names, sizes, crc = zip(*file.documents())
                n = len(names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file.place[0]] * n, pa.int64()), pa.array([file.place[1]] * n, pa.int64()), pa.array(np.arange(n)), pa.array(names, pa.int64()), pa.array(sizes, pa.int64()), pa.array(crc, pa.int64())],
                    ["part", "seq", "position", "doc_id", "n_tokens", "ids_crc32"],
                )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(read, "part long, seq long, position long, doc_id long, n_tokens long, ids_crc32 long")


def sequence_index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, from the files alone.

    Starts add up level by level: documents within their file, files within their task's part, parts
    within groups of PARTS, and last the groups, of which there is one for thousands of files. Each
    level's sums are small enough for the windows of the next, and none sees all files.
    """
    from pyspark.sql import Window

    def running(rows: DataFrame, within: list[str], order: str, size: str, name: str) -> DataFrame:
        before = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return rows.withColumn(name, F.coalesce(F.sum(size).over(before), F.lit(0)))

    docs = running(written(read_sequences(spark, path), "sequence-index"), ["part", "seq"], "position", "n_tokens", "in_file")
    files = written(docs.groupBy("part", "seq").agg(F.sum("n_tokens").alias("size")).withColumn("group", F.floor(F.col("part") / PARTS)), "sequence-files")
    parts = files.groupBy("group", "part").agg(F.sum("size").alias("size"))
    groups = running(parts.groupBy("group").agg(F.sum("size").alias("size")), [], "group", "size", "in_all").drop("size")
    bases = running(files, ["part"], "seq", "size", "in_part").join(running(parts, ["group"], "part", "size", "in_group").drop("size", "group"), "part").join(groups, "group")
    joined = docs.join(bases.select("part", "seq", (F.col("in_all") + F.col("in_group") + F.col("in_part")).alias("base")), ["part", "seq"])
    return joined.select("doc_id", (F.col("base") + F.col("in_file")).alias("start"), "n_tokens", "ids_crc32")


def sequence_round_trip(docs: DataFrame, tokenizer_path: str, end_id: int = 2, length: int = 2048) -> DataFrame:
    """Write ``docs`` as sequences to the shared folder and give the index read back from the files.

    Nulls, empty and very long texts, ties, repeated rows and other columns: as in ``write_sequences``.
    """
    path = scratch_path(docs.sparkSession, "sequences")
    write_sequences(docs, tokenizer_path, path, end_id, length)
    index = sequence_index(docs.sparkSession, path)
    remove_path(docs.sparkSession, path)
    return index
