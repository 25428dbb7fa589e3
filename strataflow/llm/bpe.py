"""Byte-level BPE by backtracking over longest matches.

Bytes are mapped to Latin-1 so that an Aho-Corasick automaton finds, in one pass, the longest
vocabulary entry at every position. Encoding walks forward with those; two neighbouring tokens
are compatible if merging their joint bytes in rank order would leave exactly these two. Where
no token fits after the last one, the walk steps back and tries the next shorter token; dead
positions are marked, so each is left at most once and the walk is linear. A sequence whose
neighbours are all compatible is the one that rank-ordered merging gives.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from strataflow.llm.common import Memo, extend, safe_pieces

#: Answers on neighbouring tokens that a worker keeps, of a fixed size each; beyond that it starts afresh.
ANSWERS = 600_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class BytePairCodec:
    """Encoder and decoder for rank files whose single bytes are all present."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.split_words = regex.compile(pattern).findall
        self.bytes_of = dict(zip(ranks.values(), ranks))
        self.size_of = {rank: len(token) for token, rank in ranks.items()}
        self.shorter: dict[int, int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        self.words = Memo(lambda words: [np.array(self.encode_word(word.encode()), "<u4").tobytes() for word in words], beside=self.fits)
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.shorter[rank] = next((r for n in range(len(token) - 1, 0, -1) if (r := ranks.get(token[:n])) is not None), -1)
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            if len(token) == 1 or self._find_halves(token, rank):
                self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()

    def _find_halves(self, token: bytes, rank: int) -> bool:
        """The two tokens whose merge makes this one; none if no merges lead to it."""
        left = self.shorter[rank]
        while left >= 0:
            right = self.ranks.get(token[self.size_of[left] :])
            if right is not None and self._merged(left, rank) and self._merged(right, rank) and self._compatible(left, right):
                self.halves[rank] = left, right
                self.joined[left, right] = rank
                return True
            left = self.shorter[left]
        return False

    def _merged(self, token: int, before: int) -> bool:
        return token < before and (self.size_of[token] == 1 or token in self.halves)

    def compatible(self, left: int, right: int) -> bool:
        known = self.fits.get((left, right))
        if known is None:
            if len(self.fits) >= ANSWERS:
                self.fits.clear()
            known = self.fits[left, right] = self._compatible(left, right)
        return known

    def _compatible(self, left: int, right: int) -> bool:
        """Undo merges on both sides of the seam, latest first; a merge across it before then is a clash."""
        before = 1 << 62
        while True:
            across = self.joined.get((left, right))
            if across is not None and across < before:
                return False
            undo_left = left > right
            for _ in range(2):
                if undo_left and left in self.halves:
                    before, left = left, self.halves[left][1]
                    break
                if not undo_left and right in self.halves:
                    before, right = right + 1, self.halves[right][0]
                    break
                undo_left = not undo_left
            else:
                return True

    def encode_word(self, word: bytes) -> list[int]:
        """Tokens of one match of the pattern."""
        whole = self.ranks.get(word)
        if whole is not None:
            return [whole]
        size, fits = self.size_of, self.compatible
        best = [-1] * len(word)
        for end, rank in self.automaton.iter(word.decode("latin-1")):
            best[end - size[rank] + 1] = rank  # ends ascend, so the longest stays
        alive = bytearray(b"\x01") * (len(word) + 1)
        out: list[int] = []
        at, token = 0, best[0]
        while True:
            last = out[-1] if out else -1
            while token >= 0 and not (alive[at + size[token]] and (last < 0 or fits(last, token))):
                token = self.shorter_merged(token)
            if token >= 0:
                out.append(token)
                at += size[token]
                if at == len(word):
                    return out
                token = best[at]
            else:
                alive[at] = 0
                token = out.pop()
                at -= size[token]

    def shorter_merged(self, token: int) -> int:
        token = self.shorter[token]
        while token >= 0 and self.size_of[token] > 1 and token not in self.halves:
            token = self.shorter[token]
        return token

    def encode_packed(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        memo, out = self.words, []
        for piece in safe_pieces(text, 1 << 20):
            found = self.split_words(piece)
            memo.know(set(found))
            out.append(b"".join(map(memo.__getitem__, found)))
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_packed(text), "<u4").tolist()

    def decode_packed(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def load_codec(path: str, pattern: str) -> BytePairCodec:
    return BytePairCodec(read_ranks(path), pattern)


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``docs`` with ``ids`` (binary: little-endian unsigned 32-bit ids of the text) added.

    Null and empty texts encode to no ids; very long ones are encoded piece by piece, to the same ids.
    Repeated rows each give a row. Columns of ``docs`` stay, an own ``ids`` column is replaced. An
    empty table gives no rows.
    """

    def encode(batch: pa.RecordBatch):
        codec = load_codec(ranks_path, pattern)
        return {"ids": pa.array([codec.encode_packed(x or "") for x in batch.column("text").to_pylist()], pa.binary())}

    return extend(docs, encode, "ids binary")


def codec_digests(docs: DataFrame, ranks_path: str, pattern: str, carry: list[str] | None = None, with_ids: bool = False) -> DataFrame:
    """``docs`` with n_tokens, ids_sha256 and decoded_sha256: encodes, then decodes the ids.

    Null and empty texts have no tokens and the digests of no bytes; very long ones are encoded piece
    by piece, to the same ids. Repeated rows each give a row, ties don't matter, null ids stay null,
    columns with the added names are replaced, an empty table gives no rows. Only the columns that ``carry`` names stay, all unless it is given; ``ids``
    comes along if asked for. A narrow map, no shuffle.
    """

    def digest(batch: pa.RecordBatch):
        codec = load_codec(ranks_path, pattern)
        packed = [codec.encode_packed(x or "") for x in batch.column("text").to_pylist()]
        return {
            "n_tokens": pa.array([len(x) // 4 for x in packed], pa.int64()),
            "ids_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in packed], pa.string()),
            "decoded_sha256": pa.array([hashlib.sha256(codec.decode_packed(x)).hexdigest() for x in packed], pa.string()),
            "ids": pa.array(packed, pa.binary()),
        }

    return extend(docs, digest, "n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids, carry)
