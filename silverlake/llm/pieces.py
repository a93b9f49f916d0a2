"""Texts as pieces: every match of a tokenizer's pattern is encoded by itself, so results can be kept."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import regex

KEPT = 100_000  # pieces in each of the two generations of a cache
LONGEST = 64  # characters of a piece that is kept
ROWS = 256  # documents worked on at once


def compiled(pattern: str) -> Callable[[str], list[str]]:
    """``findall`` for a pattern as tokenizers mean it: white space is what Unicode calls so."""
    pattern = pattern.replace(r"[^\s", r"[^\p{White_Space}")
    return regex.compile(
        pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
    ).findall


class PieceEncoder:
    """Encodes texts piece by piece; ``encode_new`` gets pieces not seen lately, as one batch.

    Ids are packed 32-bit integers. Two generations of at most ``KEPT`` pieces are held: when the young
    one is full it becomes the old one, and what is used again moves back.
    """

    def __init__(self, pattern: str, encode_new: Callable[[list[str]], list[bytes]], most: int = KEPT):
        self.pieces, self.encode_new, self.most = compiled(pattern), encode_new, most
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [self.pieces(text) for text in texts]
        missing = set().union(*split).difference(self.young)
        known = {p: self.old[p] for p in missing if p in self.old}
        new = [p for p in missing if p not in known]
        known.update(zip(new, self.encode_new(new), strict=True))
        self.young.update(known)
        get = self.young.__getitem__
        out = [b"".join(map(get, pieces)) for pieces in split]
        for piece in known:
            if len(piece) > LONGEST:
                del self.young[piece]
        if len(self.young) >= self.most:
            self.old, self.young = self.young, {}
        return out


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
