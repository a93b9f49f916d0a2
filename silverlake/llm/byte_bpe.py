"""Byte-level BPE encoding and decoding with a segment tree of pair ranks.

A piece (a match of the pattern) is a row of parts, at first its bytes. The leaf of a part holds the
rank of the pair that it forms with the next part; every inner node holds the least rank below it and,
of equal ranks, the leftmost place, so the root names the next merge. A merge changes three leaves:
that of the merged part, of its live left neighbour, and of the part that is gone; each is a walk to the
root, which ends where a minimum stays. A piece of n bytes costs O(n log n), also one of megabytes.
``merge`` does this for one piece; ``merge_many`` does the same merges on the trees of many short pieces at
once, one row of an array each.

Python is used because merging is a loop whose length depends on the data. Workers hold the rank
file (given as a broadcast of its bytes, about 1 MB) and a bounded cache of pieces. Defined results: a
null text counts as empty, an empty text has no ids and decodes to no bytes; special-token strings are
ordinary text; null ids decode as none; an empty table gives an empty result; all other columns pass
through, and a column that is already there under the name of a result, in any case, is replaced.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructType

from silverlake.llm.base import table, text_batches
from silverlake.llm.pieces import PieceEncoder, slices

NONE = 1 << 62
LONG = 64  # bytes of a piece that is merged with others
MANY = 8192  # pieces merged at once
TOGETHER = 1 << 17  # ids decoded at once


def read_ranks(rank_file: bytes) -> dict[bytes, int]:
    lines = (line.split() for line in rank_file.splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in lines}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one piece."""
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    depth = max(n - 1, 1).bit_length()
    size = 1 << depth
    tree = [NONE] * (2 * size)
    get = ranks.get
    for i in range(n - 1):
        rank = get(piece[i : i + 2])
        if rank is not None:
            tree[size + i] = rank << depth | i
    for node in range(size - 1, 0, -1):
        left, right = tree[2 * node], tree[2 * node + 1]
        tree[node] = left if left < right else right
    after = list(range(1, n + 1))  # the place of the next part; n at the end
    before = list(range(-1, n - 1))

    def put(leaf: int, value: int) -> None:
        node = size + leaf
        tree[node] = value
        node >>= 1
        while node:
            left, right = tree[2 * node], tree[2 * node + 1]
            least = left if left < right else right
            if tree[node] == least:
                return
            tree[node] = least
            node >>= 1

    def pair(i: int) -> int:
        """The leaf of part ``i``."""
        j = after[i]
        if j == n:
            return NONE
        rank = get(piece[i : after[j]])
        return NONE if rank is None else rank << depth | i

    while tree[1] < NONE:
        i = tree[1] & (size - 1)
        gone = after[i]
        j = after[i] = after[gone]
        if j < n:
            before[j] = i
        put(gone, NONE)
        put(i, pair(i))
        if before[i] >= 0:
            put(before[i], pair(before[i]))

    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : after[i]]])
        i = after[i]
    return ids


class Pairs:
    """The ranks of pairs of ids: of every token, and every way to make it from two."""

    def __init__(self, ranks: dict[bytes, int]):
        found = {
            ranks[token[:k]] << 32 | ranks[token[k:]]: rank
            for token, rank in ranks.items()
            for k in range(1, len(token))
            if token[:k] in ranks and token[k:] in ranks
        }
        self.keys = np.array(sorted(found), np.int64)
        self.ranks = np.array([found[k] for k in self.keys.tolist()], np.int64)

    def leaves(self, left: np.ndarray, right: np.ndarray, place: np.ndarray, depth: int) -> np.ndarray:
        """rank << depth | place, or NONE where the two do not merge."""
        wanted = left << 32 | right
        at = np.searchsorted(self.keys, wanted)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == wanted, self.ranks[at] << depth | place, NONE)


def merge_many(pieces: list[bytes], single: np.ndarray, pairs: Pairs) -> list[bytes]:
    """The packed ids of pieces of two or more bytes and similar length; ``single``: those of the bytes."""
    count, longest = len(pieces), max(map(len, pieces))
    depth = (longest - 1).bit_length()
    size = 1 << depth
    lengths = np.array([len(p) for p in pieces])
    ids = np.full((count, size + 1), -1, np.int64)  # column ``size`` stands for the end
    inside = np.arange(size + 1) < lengths[:, None]
    ids[inside] = single[np.frombuffer(b"".join(pieces), np.uint8)]
    places = np.arange(size + 1)
    after = np.where(places + 1 < lengths[:, None], places + 1, size)
    before = np.tile(places - 1, (count, 1))
    tree = np.full((count, 2 * size), NONE, np.int64)
    row, left = np.nonzero(inside[:, 1:])
    tree[row, size + left] = pairs.leaves(ids[row, left], ids[row, left + 1], left, depth)
    for level in range(depth - 1, -1, -1):
        below = tree[:, 2 << level : 4 << level]
        tree[:, 1 << level : 2 << level] = np.minimum(below[:, ::2], below[:, 1::2])

    def put(row: np.ndarray, leaf: np.ndarray, value: np.ndarray | int) -> None:
        node = size + leaf
        tree[row, node] = value
        for _ in range(depth):
            least = np.minimum(tree[row, node], tree[row, node ^ 1])
            node = node >> 1
            tree[row, node] = least

    row = np.arange(count)
    while True:
        root = tree[row, 1]
        row, root = row[root < NONE], root[root < NONE]
        if not len(row):
            break
        i = root & (size - 1)
        gone = after[row, i]
        j = after[row, gone]
        ids[row, i] = root >> depth
        ids[row, gone] = -1
        after[row, i] = j
        before[row, j] = i
        put(row, gone, NONE)
        put(row, i, pairs.leaves(ids[row, i], ids[row, j], i, depth))
        back = before[row, i]
        some = back >= 0
        r, p = row[some], back[some]
        put(r, p, pairs.leaves(ids[r, p], ids[r, i[some]], p, depth))
    ends = np.cumsum(4 * (ids >= 0).sum(axis=1)).tolist()
    packed = ids[ids >= 0].astype(np.uint32).tobytes()
    return [packed[a:b] for a, b in zip([0, *ends], ends, strict=False)]


class Codec:
    def __init__(self, rank_file: bytes, pattern: str):
        self.ranks = read_ranks(rank_file)
        self.pairs = Pairs(self.ranks)
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.encode = PieceEncoder(pattern, self._encode_new).encode

    def _encode_new(self, pieces: list[str]) -> list[bytes]:
        data = [piece.encode() for piece in pieces]
        out: dict[bytes, bytes] = {}
        sizes: dict[int, list[bytes]] = {}
        for piece in data:
            if piece in self.ranks or len(piece) > LONG:
                out[piece] = array("I", merge(piece, self.ranks)).tobytes()
            else:
                sizes.setdefault((len(piece) - 1).bit_length(), []).append(piece)
        for alike in sizes.values():
            for at in range(0, len(alike), MANY):
                part = alike[at : at + MANY]
                out.update(zip(part, merge_many(part, self.single, self.pairs), strict=True))
        return [out[piece] for piece in data]

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> pa.BinaryArray:
        """The bytes of lists of ids, given one after the other with the place where each ends.

        All bytes of ``TOGETHER`` ids are gathered at once from those of the vocabulary.
        """
        sizes = self.sizes[ids]
        to = np.concatenate([[0], np.cumsum(sizes)])
        out = np.empty(to[-1], np.uint8)
        for at in range(0, len(ids), TOGETHER):
            part, size = ids[at : at + TOGETHER], sizes[at : at + TOGETHER]
            shift = self.first[part] - to[at : at + len(part)]
            a, b = to[at], to[at + len(part)]
            out[a:b] = self.bytes[np.arange(a, b) + np.repeat(shift, size)]
        cuts = to[np.concatenate([[0], ends])].astype(np.int32)
        buffers = [None, pa.py_buffer(cuts), pa.py_buffer(out)]
        return pa.Array.from_buffers(pa.binary(), len(ends), buffers)


_codecs: dict[tuple[int, str], Codec] = {}  # of this worker, so that the cache lives on between tasks


def _codec(rank_file: Broadcast, pattern: str) -> Codec:
    key = (hash(rank_file.value), pattern)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(rank_file.value, pattern)
    return _codecs[key]


def packed_lists(packed: list[bytes]) -> pa.ListArray:
    """Packed 32-bit integers as an Arrow array of lists."""
    ends = np.cumsum([0] + [len(p) // 4 for p in packed], dtype=np.int64).astype(np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(packed), np.int32)))


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all lists, and where each ends; a null list is an empty one."""
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes, dtype=np.int64)


def share_ranks(spark: SparkSession, path: str) -> Broadcast:
    """The rank file's bytes for all workers; a vocabulary, so its size does not follow the data."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def encode(
    docs: DataFrame,
    rank_file: Broadcast,
    text_col: str = "text",
    pattern: str = public_tokenizers.PATTERN,
    ids_col: str = "ids",
    drop_text: bool = False,
    bytes_col: str | None = None,
) -> DataFrame:
    """``docs`` with the ids of each whole text; with ``bytes_col`` also the bytes these ids decode to."""
    text_batches(docs.sparkSession)
    added = [ids_col, bytes_col] if bytes_col else [ids_col]
    taken = {c.lower() for c in added}
    kept = [c for c in docs.columns if c.lower() not in taken and not (drop_text and c == text_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(rank_file, pattern)
        for batch in slices(batches):
            ids = packed_lists(codec.encode([text or "" for text in batch.column(text_col).to_pylist()]))
            columns = [*(batch.column(c) for c in kept), ids]
            if bytes_col:
                columns.append(codec.decode(*_flat(ids)))
            yield pa.RecordBatch.from_arrays(columns, [*kept, *added])

    schema = _schema(docs, kept).add(ids_col, ArrayType(IntegerType()))
    return docs.mapInArrow(run, schema.add(bytes_col, BinaryType()) if bytes_col else schema)


def decode(
    docs: DataFrame,
    rank_file: Broadcast,
    ids_col: str = "ids",
    pattern: str = public_tokenizers.PATTERN,
    bytes_col: str = "decoded",
) -> DataFrame:
    """``docs`` with the bytes that the ids stand for."""
    text_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c.lower() != bytes_col.lower()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(rank_file, pattern)
        for batch in slices(batches):
            columns = [*(batch.column(c) for c in kept), codec.decode(*_flat(batch.column(ids_col)))]
            yield pa.RecordBatch.from_arrays(columns, [*kept, bytes_col])

    return docs.mapInArrow(run, _schema(docs, kept).add(bytes_col, BinaryType()))


def _schema(docs: DataFrame, kept: list[str]) -> StructType:
    return StructType([docs.schema[c] for c in kept])


def op4_byte_bpe(
    spark: SparkSession, sf_dir: str, rank_path: str = ""
) -> DataFrame:
    ranks = share_ranks(spark, rank_path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = encode(docs, ranks, drop_text=True, bytes_col="decoded")
    listed = F.expr("substring(to_json(ids), 2, length(to_json(ids)) - 2)")
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
