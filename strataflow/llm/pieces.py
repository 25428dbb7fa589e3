"""Ids of texts under a sentence model with byte fallback, by the library in one call for many texts.

Remembering words was tried and left: new words are so many that it saved nothing within the memory
that a worker may take.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from strataflow.llm.common import safe_pieces
from strataflow.llm.tokens import load_tokenizer


class PieceEncoder:
    def __init__(self, path: str):
        self.model = load_tokenizer(path)
        size = self.model.get_piece_size()
        self.kind = "<u2" if size <= 1 << 16 else "<u4"
        self.fallback = np.array([self.model.is_byte(k) for k in range(size)])

    def packed(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, little-endian. Long texts go piece by piece; a piece's own first mark stands for the space at the cut."""
        cut = [safe_pieces(text) if text else [] for text in texts]
        ids = iter(self.model.encode([p[bool(k) :] for parts in cut for k, p in enumerate(parts)], num_threads=1))
        return [b"".join(np.array(next(ids), self.kind).tobytes() for _ in parts) for parts in cut]


@lru_cache(maxsize=2)
def load_pieces(path: str) -> PieceEncoder:
    return PieceEncoder(path)
