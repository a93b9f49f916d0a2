"""Token ids in binary files of patched frame-of-reference blocks.

Ids of a run of documents, each closed by an end id, are cut into blocks of ``BLOCK``. A block
subtracts its minimum and packs the differences at the width that holds ``PERCENT`` percent of them; the
high bits of the others stand in an exception list of places and values. A file image holds::

    "PFR1", block size u32, documents u32, blocks u32, ids u64
    null flags of the documents u8, their ids i64, their token counts u64
    block index: start of each block u64, and the end of the last
    blocks: minimum u32, width u8, exceptions u16, packed bits, places u16, high bits u32

All numbers are little-endian. Images are written as rows of binary through Spark's Parquet writer, about
``IDS`` ids each (more if one document is longer), so they reach whatever store the cluster uses, and only
whole tasks leave files. Documents are ordered by id with a range shuffle; equal ids by their text.

Defined results: a null text is empty, and an empty text still has its end id; a null id comes first and is
read back as null; repeated rows are written as often as they come; an empty table gives an empty
result; only the id and the text are read, so other columns do not matter.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silverlake.llm.base import table, text_batches
from silverlake.llm.byte_bpe import packed_lists
from silverlake.llm.pieces import slices
from silverlake.sources.scratch import scratch_path

BLOCK, PERCENT, IDS = 4096, 99, 1 << 18
END = 2
MAGIC = b"PFR1"
BLANKS = ("  ", " \t", " \n", " \r")
KEPT = 4_000_000  # words whose ids a worker holds, about 40 bytes each
JOINED = 20_000  # words encoded as one text
TOGETHER = 1 << 20  # bytes of text worked on at once
BASE = 0x9E3779B97F4A7C15
UNBASE = pow(BASE, -1, 1 << 64)
# Texts of these characters only are encoded word by word, as white space has the same meaning everywhere.
PLAIN = regex.compile(r"[\t\n\r\x20-\x7e\xa1-ɏ‘-”…€]*")


# ---------------------------------------------------------------- blocks and files


def pack_block(ids: np.ndarray, percent: int = PERCENT) -> bytes:
    low = int(ids.min())
    gaps = (ids - np.uint32(low)).astype("<u4")
    # How many differences take at most so many bits.
    within = np.searchsorted(np.sort(gaps), 1 << np.arange(33, dtype=np.int64))
    width = int(np.searchsorted(within, -(-len(ids) * percent // 100)))
    odd = np.flatnonzero(gaps >> np.uint32(width)) if width < 32 else np.zeros(0, np.int64)
    if width % 8:
        bits = np.unpackbits(_bytes(gaps, width), axis=1, bitorder="little")[:, :width]
        packed = np.packbits(bits, axis=None, bitorder="little").tobytes()
    else:  # whole bytes
        packed = gaps.view(np.uint8).reshape(-1, 4)[:, : width // 8].tobytes()
    high = (gaps[odd] >> np.uint32(width)).astype("<u4")
    return struct.pack("<IBH", low, width, len(odd)) + packed + odd.astype("<u2").tobytes() + high.tobytes()


def _bytes(gaps: np.ndarray, width: int) -> np.ndarray:
    """The low bytes that hold ``width`` bits, a row for each number."""
    return gaps.view(np.uint8).reshape(-1, 4)[:, : max(1, -(-width // 8))]


def unpack_block(data: memoryview, n: int) -> np.ndarray:
    low, width, odd = struct.unpack_from("<IBH", data)
    size = -(-n * width // 8)
    packed = np.frombuffer(data, np.uint8, size, 7)
    gaps = np.zeros(n, "<u4")
    if width % 8:
        rows = np.unpackbits(packed, count=n * width, bitorder="little").reshape(n, width)
        _bytes(gaps, width)[:, : -(-width // 8)] = np.packbits(rows, axis=1, bitorder="little")
    else:
        gaps.view(np.uint8).reshape(-1, 4)[:, : width // 8] = packed.reshape(n, width // 8)
    places = np.frombuffer(data, "<u2", odd, 7 + size)
    high = np.frombuffer(data, "<u4", odd, 7 + size + 2 * odd)
    gaps[places] |= (high.astype(np.uint64) << np.uint64(width)).astype(np.uint32)
    return gaps + np.uint32(low)


def pack_file(doc_ids: list[int | None], counts: list[int], ids: np.ndarray) -> bytes:
    blocks = [pack_block(ids[at : at + BLOCK]) for at in range(0, len(ids), BLOCK)]
    starts = np.cumsum([0] + [len(b) for b in blocks], dtype="<u8")
    return b"".join(
        [
            MAGIC,
            struct.pack("<IIIQ", BLOCK, len(doc_ids), len(blocks), len(ids)),
            np.array([d is None for d in doc_ids], np.uint8).tobytes(),
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            np.array(counts, "<u8").tobytes(),
            starts.tobytes(),
            *blocks,
        ]
    )


class IdFile:
    """An image of a file; single blocks are found through the index."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a file of packed ids")
        self.data = memoryview(data)
        self.block, docs, blocks, self.n = struct.unpack_from("<IIIQ", data, 4)
        nulls = np.frombuffer(data, np.uint8, docs, 24)
        values = np.frombuffer(data, "<i8", docs, 24 + docs)
        self.doc_ids = [None if null else int(v) for null, v in zip(nulls, values, strict=True)]
        self.counts = np.frombuffer(data, "<u8", docs, 24 + 9 * docs).astype(np.int64)
        self.starts = np.frombuffer(data, "<u8", blocks + 1, 24 + 17 * docs).astype(np.int64)
        self.body = 24 + 17 * docs + 8 * (blocks + 1)

    def read_block(self, k: int) -> np.ndarray:
        part = self.data[self.body + self.starts[k] : self.body + self.starts[k + 1]]
        return unpack_block(part, min(self.block, self.n - k * self.block))

    def read(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from place ``start`` on."""
        if not n:
            return np.zeros(0, np.uint32)
        first = start // self.block
        blocks = [self.read_block(k) for k in range(first, -(-(start + n) // self.block))]
        at = start - first * self.block
        return np.concatenate(blocks)[at : at + n]


# ---------------------------------------------------------------- tokens


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2 and so on, modulo 2^64."""
    factors = np.full(n, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


class WordIds:
    """The ids of words by 64-bit hash, in flat arrays; emptied when it holds ``most`` words."""

    def __init__(self, most: int):
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)  # sorted
        self.first, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0

    def known(self, keys: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys, keys)
        found = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        found[inside] = self.keys[at[inside]] == keys[inside]
        return found

    def add(self, keys: np.ndarray, ids: np.ndarray, count: np.ndarray) -> None:
        """New sorted keys; ``ids`` of all, one after the other."""
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(len(self.ids) + len(ids), np.uint32)])
        self.ids[self.used : self.used + len(ids)] = ids
        at = np.searchsorted(self.keys, keys)
        first = self.used + np.cumsum(count) - count
        self.keys = np.insert(self.keys, at, keys)
        self.first, self.count = np.insert(self.first, at, first), np.insert(self.count, at, count)
        self.used += len(ids)


class Tokens:
    """Ids of whole texts by the tokenizers library, which sees each distinct word about once.

    The pattern starts a piece at every space that something other than white space follows. A text where all
    are like that is a first word and then words with a space before them, each encoded by itself. Words not
    seen lately go to the library in one text; each one's ids start where a token starts with a space. All other
    texts are encoded whole, also those that hold a token which the file adds to the vocabulary, as the library
    gives it its own id. Words are told apart by a 64-bit polynomial hash over their bytes, taken of all
    words of a batch at once from running sums.
    """

    def __init__(self, tokenizer_file: bytes, most: int = KEPT):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallel units
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(tokenizer_file)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        if any(len(t.split()) != 1 or t.strip() != t for t in self.added):
            self.added = [""]  # one that spans words could arise where words are joined, so all texts go whole
        space = self.tokenizer.encode(" ", add_special_tokens=False).tokens[0]
        self.starts = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, id_ in self.tokenizer.get_vocab().items():
            self.starts[id_] = token.startswith(space)
        self.space = self.whole([" "])[0]
        self.words = WordIds(most)
        self.powers = self.inverse = np.ones(1, np.uint64)

    def whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, np.uint32).tobytes() for x in found]

    def hashes(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Of the parts of ``data`` that begin at ``starts`` (the first at 0)."""
        while len(self.powers) <= len(data):
            self.powers, self.inverse = (_powers(x, 2 * len(self.powers)) for x in (BASE, UNBASE))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[: len(data)], out=sums[1:])
        ends = np.append(starts[1:], len(data))
        found = (sums[ends] - sums[starts]) * self.inverse[starts]
        return (found ^ (found >> np.uint64(32))) * np.uint64(BASE) + (ends - starts).astype(np.uint64)

    def _learn(self, data: bytes, starts: np.ndarray, keys: np.ndarray, at: np.ndarray) -> None:
        """Encode the new words among the sorted ``keys``, which first occur as the ``at``-th."""
        if len(self.words.keys) + len(keys) > self.words.most:
            self.words.clear()
        new = ~self.words.known(keys)
        keys, at = keys[new], at[new]
        ends = np.append(starts[1:], len(data))
        for k in range(0, len(keys), JOINED):
            part = slice(k, k + JOINED)
            pieces = [data[a:b] for a, b in zip(starts[at[part]].tolist(), ends[at[part]].tolist(), strict=True)]
            ids = np.frombuffer(self.whole([b"".join(pieces).decode()])[0], np.uint32)
            cuts = np.append(np.flatnonzero(self.starts[ids]), len(ids))
            if len(cuts) != len(pieces) + 1:
                raise ValueError("a word does not start with a space of its own")
            self.words.add(keys[part], ids, np.diff(cuts))

    def _batch(self, texts: list[bytes]) -> list[bytes]:
        """The ids of texts that are words with a space before each."""
        data = b"".join(texts)
        if not data:
            return [b""] * len(texts)
        array = np.frombuffer(data, np.uint8)
        starts = np.flatnonzero(array == 32)
        hashes = self.hashes(array, starts)
        keys, at, back = np.unique(hashes, return_index=True, return_inverse=True)
        self._learn(data, starts, keys, at)
        place = np.searchsorted(self.words.keys, keys)
        first, count = self.words.first[place][back], self.words.count[place][back]
        ends = np.cumsum(count)
        ids = self.words.ids[np.arange(ends[-1]) + np.repeat(first - ends + count, count)]
        offsets = np.cumsum([0] + [len(t) for t in texts])
        cuts = np.concatenate([[0], ends])[np.searchsorted(starts, offsets)].tolist()
        return [ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        heads, rest, tails = [], [], []
        for text in texts:
            head, tail = text, b""
            if not any(b in text for b in (*BLANKS, *self.added)) and PLAIN.fullmatch(text):
                if text.endswith(" "):
                    tail, text = self.space, text[:-1]
                at = text.find(" ")
                head = text if at < 0 else text[:at]
                rest.append(b"" if at < 0 else text[at:].encode())
            else:
                rest.append(b"")
            heads.append(head)
            tails.append(tail)
        bodies, held, size = [], [], 0
        for body in rest:
            held.append(body)
            size += len(body)
            if size >= TOGETHER:
                bodies += self._batch(held)
                held, size = [], 0
        bodies += self._batch(held)
        return [b"".join(x) for x in zip(self.whole(heads), bodies, tails, strict=True)]


_tokens: dict[int, Tokens] = {}  # of this worker, so that the cache lives on between tasks


def _tokens_of(tokenizer_file: Broadcast) -> Tokens:
    key = hash(tokenizer_file.value)
    if key not in _tokens:
        _tokens.clear()
        _tokens[key] = Tokens(tokenizer_file.value)
    return _tokens[key]


# ---------------------------------------------------------------- writing and reading


def write_ids(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end: int = END,
    ids_per_file: int = IDS,
) -> None:
    """Encode the documents and write them under ``path`` in ascending order of their ids."""
    spark = docs.sparkSession
    text_batches(spark)
    with open(tokenizer_path, "rb") as file:
        shared = spark.sparkContext.broadcast(file.read())
    close = np.array([end], np.uint32).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part = _tokens_of(shared), TaskContext.get().partitionId()
        doc_ids, packed, held, before = [], [], 0, 0

        def image() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(packed), np.uint32)
            data = pack_file(doc_ids, [len(p) // 4 for p in packed], ids)
            row = {"part": part, "before": before, "n_docs": len(doc_ids), "n_ids": held, "image": data}
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in slices(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), tokens.encode(texts), strict=True):
                doc_ids.append(doc_id)
                packed.append(ids + close)
                held += len(ids) // 4 + 1
                if held >= ids_per_file:
                    yield image()
                    doc_ids, packed, held, before = [], [], 0, before + held
        if doc_ids:
            yield image()

    kinds = {"part": pa.int32(), "before": pa.int64(), "n_docs": pa.int64(), "n_ids": pa.int64()}
    schema = pa.schema([*kinds.items(), ("image", pa.binary())])
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # Rows that repeat an id and a text may be many, and their order is all one: a number of the row deals them out.
    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    numbered.repartitionByRange(parts, "doc_id", F.xxhash64("text"), "row").sortWithinPartitions(
        "doc_id", F.xxhash64("text"), "text"
    ).select("doc_id", "text").mapInArrow(run, "part int, before long, n_docs long, n_ids long, image binary").write.option(
        "compression", "uncompressed"
    ).parquet(path)


def read_ids(spark: SparkSession, path: str, as_bytes: bool = False) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it) and ``ids``, read from the files.

    ``ids`` is an array, or with ``as_bytes`` unsigned little-endian 32-bit integers.
    """
    files = spark.read.parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            row = batch.to_pylist()[0]
            file = IdFile(row["image"])
            ids = file.read(0, file.n)
            ends = np.cumsum(file.counts)
            packed = [x.tobytes() for x in np.split(ids, ends[:-1])]
            n = len(packed)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["part"]] * n, pa.int32()),
                    pa.array(file.doc_ids, pa.int64()),
                    pa.array(row["before"] + ends - file.counts),
                    pa.array(packed, pa.binary()) if as_bytes else packed_lists(packed),
                ],
                ["part", "doc_id", "inside", "ids"],
            )

    kind = "binary" if as_bytes else "array<int>"
    rows = files.select("part", "before", "image").mapInArrow(
        run, f"part int, doc_id long, inside long, ids {kind}"
    )
    # A row for each part, so no more rows than the shuffle had partitions.
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base")
    )
    return rows.join(F.broadcast(parts), "part").select(
        "doc_id", (F.col("base") + F.col("inside")).alias("start"), "ids"
    )


def op9_pfor_ids(spark: SparkSession, sf_dir: str, tokenizer_path: str = "") -> DataFrame:
    path = scratch_path(spark, "token-ids")
    tokenizer = tokenizer_path or public_tokenizers.path("byte_bpe_50k.json")
    write_ids(table(spark, sf_dir, "documents"), path, tokenizer)
    return read_ids(spark, path, as_bytes=True).select(
        "doc_id",
        "start",
        F.expr("length(ids) div 4").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
