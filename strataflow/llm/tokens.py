"""Token counts of whole texts under a public tokenizer.

Batches go through the tokenizer's own library; only lengths leave the Python worker.
"""

from __future__ import annotations

import heapq
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strataflow.llm.common import map_slices, safe_pieces, text_bytes


@lru_cache(maxsize=4)
def load_tokenizer(path: str):
    """The library's object for a ``.json`` or ``.model`` file, without truncation or padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    if path.endswith(".model"):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=path)
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def balanced(sizes: list[int], limit: int) -> list[list[int]]:
    """Places of ``sizes`` in batches of nearly equal sums, about ``limit`` each: the largest first, each to the emptiest batch."""
    count = max(1, -(-sum(sizes) // limit))
    if count == 1:
        return [list(range(len(sizes)))]
    out: list[list[int]] = [[] for _ in range(count)]
    room = [(0, k) for k in range(count)]
    for at in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        held, k = room[0]
        out[k].append(at)
        heapq.heapreplace(room, (held + sizes[at], k))
    return [x for x in out if x]


def lengths(path: str, texts: list[str], batch_bytes: int = 1 << 18) -> np.ndarray:
    """Tokens of each text. Long texts are cut at safe places, and all pieces dealt to batches of equal bytes."""
    tokenizer = load_tokenizer(path)
    out = np.zeros(len(texts), np.int64)
    if path.endswith(".model"):
        encode = lambda pieces: map(len, tokenizer.encode(pieces, num_threads=1))
        cut = lambda text: [text]  # noqa: E731  a sentence model may merge across spaces
    else:
        encode = lambda pieces: map(len, tokenizer.encode_batch_fast(pieces, add_special_tokens=False))
        plain = type(tokenizer.pre_tokenizer).__name__ == "ByteLevel" and tokenizer.normalizer is None
        cut = safe_pieces if plain else lambda text: [text]
    found = [(k, piece) for k, text in enumerate(texts) for piece in cut(text)]
    owner = np.array([k for k, _ in found], np.int64)
    sizes = [len(piece) if piece.isascii() else len(piece.encode()) for _, piece in found]
    for batch in balanced(sizes, batch_bytes):
        pieces = [found[k][1] for k in batch]
        np.add.at(out, owner[batch], np.fromiter(encode(pieces), np.int64, len(pieces)))
    return out


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 512) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_bytes, n_tokens, over_limit.

    Null texts count as empty (0 bytes, 0 tokens, not over the limit); null ids stay null; repeated
    rows each give a row, ties don't matter; other columns, of whatever names, are ignored; an empty
    table gives no rows. Very long texts are counted whole, piece by piece under byte-level
    vocabularies, in one call under others. No shuffle: a narrow map over the scan.
    """

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [x or "" for x in batch.column("text").to_pylist()]
        n = lengths(tokenizer_path, texts)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(np.diff(text_bytes(batch.column("text"))[1])), pa.array(n), pa.array(n > limit)],
            ["doc_id", "n_bytes", "n_tokens", "over_limit"],
        )

    return map_slices(docs.select("doc_id", "text"), "text", count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
