"""Language-model scores from n-gram tries of Elias-Fano levels.

Counting. Each task sorts the word triples of about ``CHUNK`` tokens and sends every distinct one, with its
count, to the shard that a hash of its first two words names. A shard therefore sees whole counts of its
pairs and triples, however frequent a word or a pair is. Single words go, by their 64-bit hash, to shards of
the vocabulary.

Model. A trie has the levels first word, pair, triple, and keeps all of them.
The children of a node lie side by side; a child's key is its parent's place and the child's 32-bit hash, so
each level is one monotone sequence, whose high parts lead to the children of a place. Probabilities are
discounted by ``DISCOUNT`` and interpolated with the shorter context's, whose weight is exactly the mass left
over; they are stored as 16-bit logarithms, of which each file holds the ``TOP`` most frequent as bytes. Words outside the vocabulary share the discounted mass of
single words as one more word would. The probability of a text is the even mixture of the triple model's and
the single words', so that text without known phrases costs no more than a factor of two.

Files. Each shard is one flat file in the shared folder (``spark.checkpoint.dir``, through pyarrow's file
systems); the tasks that score memory-map them and look keys up in place by successor search. The model grows with the corpus, but on disk; a worker holds the pages it touches. The
driver sees the paths, one for each shard. A file's name is new for each attempt and only the names that
finished tasks return are used, so lost executors leave nothing half-written in the model.

Defined results: a null text is empty, which is the end token alone; a null id is hashed as an empty text; rows
that repeat an id count as often as they come; with no training text every token is unknown and one of
one words, with log10 probability 0; an empty table gives an empty result; other columns pass through
``score``, and those it adds replace any of the same name.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructType

from silverlake.llm import elias_fano
from silverlake.llm.base import stored, table, text_batches
from silverlake.llm.pieces import slices
from silverlake.sources.scratch import scratch_path

CHUNK = 2_000_000  # tokens sorted at once while counting
BATCH = 1_000_000  # tokens scored at once
DISCOUNT = 0.75
TOP = 255  # codes of a file that take a byte
FOLDS, HELD_OUT = 7, 2
PIECE = 1 << 17  # bytes hashed at once
SHARD_BYTES = 8 << 20  # text whose triples are one shard, about

# None of these can be a word, as they are made of white space.
START, END, PAD = (xxhash.xxh3_64_intdigest(mark) for mark in (b" ", b"\n", b"\t"))
MIX = np.uint64(0x9E3779B97F4A7C15)
UNMIX = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
HALF = np.uint64(32)
def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2 and so on, modulo 2^64."""
    factors = np.full(n, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


_BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_TABLES = _powers(int(MIX), PIECE + 1), _powers(int(UNMIX), PIECE + 1)
ADDED = {"n_tokens": LongType(), "n_known": LongType(), "train_tokens": LongType()} | {
    "base_score": DoubleType(),
    "score": DoubleType(),
}


def word_edges(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of ``data`` start and end; its last byte is a blank."""
    blank = _BLANK[data]
    change = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    edges = change if blank[0] else np.concatenate([[0], change])
    return edges[::2], edges[1::2]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words ``data[start:end]``: polynomials of their bytes, from running sums of a piece.

    A word of more than ``PIECE`` bytes is hashed by itself.
    """
    out = np.empty(len(starts), np.uint64)
    powers, inverse = _TABLES
    i = 0
    while i < len(starts):
        origin = int(starts[i])
        j = int(np.searchsorted(ends, origin + PIECE, side="right"))
        if j == i:
            out[i] = xxhash.xxh3_64_intdigest(data[origin : int(ends[i])].tobytes())
            i += 1
            continue
        piece = data[origin : int(ends[j - 1])]
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum((piece.astype(np.uint64) + np.uint64(1)) * powers[: len(piece)], out=sums[1:])
        first, last = starts[i:j] - origin, ends[i:j] - origin
        found = (sums[last] - sums[first]) * inverse[first]
        out[i:j] = (found ^ (found >> HALF)) * MIX + (last - first).astype(np.uint64)
        i = j
    return out


def sequences(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """START, the words, END and PAD of each text, as hashes; and how many words each has."""
    lower = [(text or "").encode().lower() for text in texts]
    data = np.frombuffer(b"\n".join(lower) + b"\n", np.uint8)
    starts, ends = word_edges(data)
    offsets = np.cumsum([0] + [len(t) + 1 for t in lower])
    counts = np.diff(np.searchsorted(starts, offsets))
    out = np.empty(len(starts) + 3 * len(lower), np.uint64)
    first = np.cumsum(counts + 3) - counts - 3
    out[first], out[first + counts + 1], out[first + counts + 2] = START, END, PAD
    inside = np.ones(len(out), bool)
    inside[first] = inside[first + counts + 1] = inside[first + counts + 2] = False
    out[inside] = word_hashes(data, starts, ends)
    return out, counts


def triples(sequence: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the triples of each text start, with the first two as one number, and the third word."""
    keep = np.ones(len(sequence), bool)
    ends = np.cumsum(counts + 3)
    keep[ends - 1] = keep[ends - 2] = False
    at = np.flatnonzero(keep)
    short = sequence >> HALF
    return at, short[at] << HALF | short[at + 1], short[at + 2]


def shard_of(mixed: np.ndarray, shards: int) -> np.ndarray:
    """The shard of mixed (or hashed) 64-bit numbers: ranges, so sorted numbers are sorted by shard."""
    return ((mixed >> HALF) * np.uint64(shards) >> HALF).astype(np.int64)


# ---------------------------------------------------------------- blobs on the way to a shard


def shrink(arrays: dict[str, np.ndarray]) -> bytes:
    """Sorted ``key`` as differences; all bytes in planes; compressed."""
    planes = {}
    for name, array in arrays.items():
        if name == "key":
            array = np.diff(array, prepend=np.uint64(0))
        planes[name] = array
    head = {f"{n}:{a.dtype.str}": a.view(np.uint8).reshape(len(a), -1).T.ravel() for n, a in planes.items()}
    return zstandard.ZstdCompressor(level=1).compress(elias_fano.pack(head))


def grow(data: bytes) -> dict[str, np.ndarray]:
    found = {}
    for name, planes in elias_fano.unpack(np.frombuffer(zstandard.decompress(data), np.uint8)).items():
        name, kind = name.split(":")
        wide = np.dtype(kind).itemsize
        array = np.ascontiguousarray(planes.reshape(wide, -1).T).view(kind).ravel()
        found[name] = np.cumsum(array, dtype=np.uint64) if name == "key" else array
    return found


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
    return keys[first], np.add.reduceat(counts[order], first) if len(keys) else counts


def ordered(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The order by 64-bit numbers and then by 32-bit ones: two sorts of single numbers, faster than one of pairs."""
    order = np.argsort(first)
    sorted_ = first[order]
    rank = np.cumsum(np.concatenate([[False], sorted_[1:] != sorted_[:-1]])[: len(first)], dtype=np.uint64)
    return order[np.argsort(rank << HALF | second[order])]


def small(counts: np.ndarray) -> np.ndarray:
    return counts.astype(np.uint8 if counts.max(initial=0) < 256 else np.uint32 if counts.max() < 1 << 32 else np.uint64)


def count_chunk(texts: list[str | None], shards: int) -> Iterator[tuple[int, bytes]]:
    """(shard, blob) of the distinct triples, and (shards + vocabulary shard, blob) of the words."""
    sequence, counts = sequences(texts)
    inside = sequence != np.uint64(PAD)
    words, n = np.unique(sequence[inside], return_counts=True)
    cuts = np.searchsorted(shard_of(words, shards), np.arange(shards + 1))
    for s in np.flatnonzero(np.diff(cuts)):
        a, b = cuts[s], cuts[s + 1]
        yield shards + int(s), shrink({"key": words[a:b], "n": small(n[a:b])})
    _, pair, third = triples(sequence, counts)
    key = pair * MIX
    order = ordered(key, third)
    key, third = key[order], third[order]
    first = np.flatnonzero(
        np.concatenate([[True], (key[1:] != key[:-1]) | (third[1:] != third[:-1])]) if len(key) else []
    )
    n = np.diff(np.append(first, len(key)))
    key, third = key[first], third[first].astype(np.uint32)
    cuts = np.searchsorted(shard_of(key, shards), np.arange(shards + 1))
    for s in np.flatnonzero(np.diff(cuts)):
        a, b = cuts[s], cuts[s + 1]
        yield int(s), shrink({"key": key[a:b], "third": third[a:b], "n": small(n[a:b])})


# ---------------------------------------------------------------- quantised logarithms


def to_code(x: np.ndarray) -> np.ndarray:
    """16 bits for a number between 2^-60 and 2^60; steps of 0.07 %."""
    return np.round((np.log2(np.maximum(x, 2.0**-60)) + 60) * 512).astype(np.uint16)


def from_code(code: np.ndarray) -> np.ndarray:
    return np.exp2(code.astype(np.float64) / 512 - 60)


def pack_codes(name: str, codes: np.ndarray) -> dict[str, np.ndarray]:
    """A byte for each code; ``TOP`` stands for a code that is in the list of the rarer ones."""
    values, at, n = np.unique(codes, return_inverse=True, return_counts=True)
    order = np.argsort(-n, kind="stable")
    rank = np.empty(len(values), np.int64)
    rank[order] = np.arange(len(values))
    short = np.minimum(rank[at], TOP).astype(np.uint8)
    odd = np.flatnonzero(short == TOP)
    parts = {"top": np.resize(values[order[:TOP]], TOP + 1) if len(values) else np.zeros(TOP + 1, np.uint16)}
    return elias_fano.prefixed(name, parts | {"short": short, "odd": codes[odd], "odd_at": odd.astype(np.uint64)})


def codes_at(name: str, arrays: dict[str, np.ndarray], places: np.ndarray) -> np.ndarray:
    short = arrays[f"{name}.short"][places]
    codes = arrays[f"{name}.top"][short]
    odd = np.flatnonzero(short == TOP)
    codes[odd] = arrays[f"{name}.odd"][np.searchsorted(arrays[f"{name}.odd_at"], places[odd].astype(np.uint64))]
    return codes


# ---------------------------------------------------------------- building shards


def build_trie(blobs: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The file image of a trie; and first words (their short hashes) with what their kept pairs sum to."""
    parts = [grow(b) for b in blobs]
    pair = np.concatenate([p["key"] for p in parts]) * UNMIX
    third = np.concatenate([p["third"] for p in parts])
    n = np.concatenate([p["n"].astype(np.int64) for p in parts])
    del parts
    order = ordered(pair, third)
    pair, third, n = pair[order], third[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]) | (third[1:] != third[:-1])]))
    n, pair, third = np.add.reduceat(n, first), pair[first], third[first]

    start = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
    pairs, total = pair[start], np.add.reduceat(n, start)
    of = np.repeat(np.arange(len(pairs)), np.diff(np.append(start, len(pair))))
    # What follows the end is no token.
    deep = (pairs[of] & np.uint64(0xFFFFFFFF)) != np.uint64(END >> 32)
    parent = of[deep]
    q3 = (n[deep] - DISCOUNT) / total[parent]
    left = 1 - np.bincount(parent, q3, len(pairs))

    heads = pairs >> HALF
    new = np.concatenate([[True], heads[1:] != heads[:-1]]) if len(pairs) else np.zeros(0, bool)
    words, head = heads[new], np.cumsum(new) - 1
    count = len(words), len(pairs)
    keys = head.astype(np.uint64) << HALF | pairs & np.uint64(0xFFFFFFFF)
    deep_keys = parent.astype(np.uint64) << HALF | third[deep].astype(np.uint64)
    image = elias_fano.pack(
        elias_fano.prefixed("words", elias_fano.encode(words, 1 << 32))
        | elias_fano.prefixed("pairs", elias_fano.encode(keys, max(count[0], 1) << 32))
        | elias_fano.prefixed("triples", elias_fano.encode(deep_keys, max(count[1], 1) << 32))
        | pack_codes("pair_code", to_code(total - DISCOUNT))
        | pack_codes("left_code", to_code(left))
        | pack_codes("triple_code", to_code(q3))
    )
    return image, words.astype(np.uint64), np.bincount(head, total - DISCOUNT, count[0])


def build_words(counts: list[bytes], sums: list[bytes]) -> tuple[bytes, int, int]:
    """The file image of a vocabulary shard; its tokens and its distinct words (without START)."""
    parts = [grow(b) for b in counts]
    empty = [np.zeros(0, np.uint64)]
    keys, n = summed(
        np.concatenate([p["key"] for p in parts] or empty),
        np.concatenate([p["n"].astype(np.int64) for p in parts] or [np.zeros(0, np.int64)]),
    )
    parts = [grow(b) for b in sums]
    heads, total = summed(
        np.concatenate([p["key"] for p in parts] or empty), np.concatenate([p["sum"] for p in parts] or [np.zeros(0)])
    )
    at = np.minimum(np.searchsorted(heads, keys >> HALF), max(len(heads) - 1, 0))
    taken = np.where(heads[at] == keys >> HALF, total[at], 0.0) if len(heads) else np.zeros(len(keys))
    real = keys != np.uint64(START)
    image = elias_fano.pack(
        elias_fano.prefixed("words", elias_fano.encode(keys, 1 << 64))
        | {"count": n, "left_code": to_code(1 - np.minimum(taken / np.maximum(n, 1), 1))}
    )
    return image, int(n[real].sum()), int(real.sum())


def write_file(folder: str, name: str, image: bytes) -> str:
    system, root = pyarrow.fs.FileSystem.from_uri(folder)
    system.create_dir(root, recursive=True)
    path = f"{root}/{name}-{uuid4().hex}"
    with system.open_output_stream(path) as out:
        out.write(image)
    return path.rpartition("/")[2]


@dataclass(frozen=True)
class Model:
    folder: str
    shards: int
    tries: dict[int, str]
    vocabularies: dict[int, str]
    tokens: int
    words: int


def train(docs: DataFrame, text_col: str = "text", shards: int | None = None) -> Model:
    """Count and store the model of the whole texts: a shard for every ``SHARD_BYTES`` of them, if not said otherwise."""
    spark = docs.sparkSession
    text_batches(spark)
    folder = _uri(scratch_path(spark, "ngram-model"))
    if not shards:
        size = docs.agg(F.sum(F.octet_length(text_col).cast("long"))).first()[0] or 0
        shards = 1 + size // SHARD_BYTES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, held = [], 0

        def flush() -> pa.RecordBatch:
            names, blobs = zip(*count_chunk(texts, shards), strict=True)
            return pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(blobs, pa.binary())], ["shard", "blob"])

        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                texts.append(text)
                held += len(text or "") // 6 + 1
                if held >= CHUNK:
                    yield flush()
                    texts, held = [], 0
        if texts:
            yield flush()

    def build(group: pa.Table) -> pa.Table:
        shard, blobs = group["shard"][0].as_py(), group["blob"].to_pylist()
        if shard >= shards:
            merged = [grow(b) for b in blobs]
            keys, n = summed(
                np.concatenate([m["key"] for m in merged]), np.concatenate([m["n"].astype(np.int64) for m in merged])
            )
            return _rows([(shard - shards, 0, shrink({"key": keys, "n": small(n)}))])
        image, words, sums = build_trie(blobs)
        out = [(shard, 2, write_file(folder, f"trie-{shard}", image).encode())]
        to = shard_of(words << HALF, shards)
        for s in np.unique(to):
            out.append((int(s), 1, shrink({"key": words[to == s], "sum": sums[to == s]})))
        return _rows(out)

    def build_vocabulary(group: pa.Table) -> pa.Table:
        shard = group["shard"][0].as_py()
        kinds, data = group["kind"].to_pylist(), group["data"].to_pylist()
        image, tokens, words = build_words(*([d for k, d in zip(kinds, data, strict=True) if k == x] for x in (0, 1)))
        name = write_file(folder, f"words-{shard}", image)
        return pa.table(
            {"shard": pa.array([shard], pa.int32()), "name": [name], "tokens": [tokens], "words": [words]}
        )

    blobs = docs.select(text_col).mapInArrow(count, "shard int, blob binary")
    built = stored(blobs.groupBy("shard").applyInArrow(build, "shard int, kind int, data binary"), "ngram-shards")
    vocabulary = stored(
        built.where("kind < 2").groupBy("shard").applyInArrow(build_vocabulary, "shard int, name string, tokens long, words long"),
        "ngram-vocabulary",
    ).collect()  # a row for each shard
    tries = built.where("kind = 2").select("shard", F.col("data").cast("string").alias("name")).collect()
    return Model(
        folder,
        shards,
        {r["shard"]: r["name"] for r in tries},
        {r["shard"]: r["name"] for r in vocabulary},
        sum(r["tokens"] for r in vocabulary),
        sum(r["words"] for r in vocabulary),
    )


def _uri(path: str) -> str:
    return path if "://" in path or path.startswith("file:") else f"file://{path}"


def _rows(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    shard, kind, data = zip(*rows, strict=True)
    return pa.table({"shard": pa.array(shard, pa.int32()), "kind": pa.array(kind, pa.int32()), "data": pa.array(data, pa.binary())})


# ---------------------------------------------------------------- scoring


class Reader:
    """The model's files, memory-mapped when they are first asked for."""

    def __init__(self, model: Model):
        self.model, self.open_files = model, {}
        n, v = model.tokens, model.words
        self.unseen = 1 / (n + v + 1)
        self.floor = DISCOUNT * v / (v + 1) / n if n else 1.0

    def arrays(self, name: str) -> dict[str, np.ndarray]:
        system, root = pyarrow.fs.FileSystem.from_uri(self.model.folder)
        path = f"{root}/{name}"
        if isinstance(system, pyarrow.fs.LocalFileSystem):
            return elias_fano.unpack(np.memmap(path, np.uint8, "r").view(np.ndarray))
        with tempfile.TemporaryFile() as copy, system.open_input_stream(path) as file:
            while part := file.read(1 << 22):
                copy.write(part)
            copy.flush()
            # A private copy, gone with the mapping.
            return elias_fano.unpack(np.memmap(copy, np.uint8, "r").view(np.ndarray))

    def trie(self, shard: int) -> dict | None:
        if shard not in self.model.tries:
            return None
        if shard not in self.open_files:
            arrays = self.arrays(self.model.tries[shard])
            names = ("words", "pairs", "triples")
            self.open_files[shard] = arrays | {name: elias_fano.opened(name, arrays) for name in names}
        return self.open_files[shard]

    def vocabulary(self, shard: int) -> dict | None:
        if shard not in self.model.vocabularies:
            return None
        key = -1 - shard
        if key not in self.open_files:
            arrays = self.arrays(self.model.vocabularies[shard])
            self.open_files[key] = arrays | {"words": elias_fano.opened("words", arrays)}
        return self.open_files[key]

    def words(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts of sorted hashes, and the weight that is left to the single words behind each."""
        count, left = np.zeros(len(hashes), np.int64), np.ones(len(hashes))
        for a, b, shard in _ranges(shard_of(hashes, self.model.shards)):
            if (file := self.vocabulary(shard)) is not None:
                place = file["words"].find(hashes[a:b])
                some = place >= 0
                count[a:b][some] = file["count"][place[some]]
                left[a:b][some] = from_code(file["left_code"][place[some]])
        return count, left

    def pairs(self, mixed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For sorted mixed pairs: place (or -1), discounted count (or 0), weight left to the shorter context."""
        node, kept, left = np.full(len(mixed), -1), np.zeros(len(mixed)), np.ones(len(mixed))
        pair = mixed * UNMIX
        for a, b, shard in _ranges(shard_of(mixed, self.model.shards)):
            if (file := self.trie(shard)) is not None and file["words"].n:
                order = np.argsort(pair[a:b])
                sorted_ = pair[a:b][order]
                heads, back = np.unique(sorted_ >> HALF, return_inverse=True)
                head = file["words"].find(heads)
                known = np.flatnonzero(head[back] >= 0)
                head = head[back][known]
                key = head.astype(np.uint64) << HALF | sorted_[known] & np.uint64(0xFFFFFFFF)
                place = file["pairs"].find(key)
                some = place >= 0
                to = a + order[known[some]]
                node[to] = place[some]
                kept[to] = from_code(codes_at("pair_code", file, place[some]))
                left[to] = from_code(codes_at("left_code", file, place[some]))
        return node, kept, left

    def triples(self, mixed: np.ndarray, node: np.ndarray, third: np.ndarray) -> np.ndarray:
        """Discounted probability (or 0) of third words below known pairs, sorted by their mixed pair."""
        out = np.zeros(len(mixed))
        for a, b, shard in _ranges(shard_of(mixed, self.model.shards)):
            file = self.trie(shard)
            if not file["triples"].n:
                continue
            key, back = np.unique(node[a:b].astype(np.uint64) << HALF | third[a:b], return_inverse=True)
            place = file["triples"].find(key)
            some = place >= 0
            found = np.zeros(len(key))
            found[some] = from_code(codes_at("triple_code", file, place[some]))
            out[a:b] = found[back]
        return out

    def score(self, texts: list[str | None]) -> dict[str, np.ndarray]:
        sequence, counts = sequences(texts)
        vocabulary, index = np.unique(sequence, return_inverse=True)
        count, left = self.words(vocabulary)
        n = self.model.tokens
        single = np.maximum(count - DISCOUNT, 0) / max(n, 1) + self.floor
        at, pair, third = triples(sequence, counts)
        # Tokens are the second words of all triples; the third of one is the second of the next.
        token, before = index[at + 1], index[at]
        pairs, which = np.unique(pair * MIX, return_inverse=True)
        node, kept, rest = self.pairs(pairs)
        context = count[before]
        p = np.where(context > 0, kept[which] / np.maximum(context, 1), 0) + left[before] * single[token]
        # Triples whose pair is known, for the token behind the pair; the next row of the same text.
        owner = np.repeat(np.arange(len(counts)), counts + 1)
        follows = np.flatnonzero(owner[1:] == owner[:-1]) if len(owner) else np.zeros(0, int)
        known = follows[node[which[follows]] >= 0]
        known = known[np.argsort(which[known], kind="stable")]
        q = self.triples(pairs[which[known]], node[which[known]], third[known])
        p[known + 1] = q + rest[which[known]] * p[known + 1]
        spans = np.cumsum(counts + 1) - counts - 1

        def total(x: np.ndarray) -> np.ndarray:
            return np.add.reduceat(x, spans) if len(spans) else x

        three, one = total(np.log10(np.minimum(p, 1))), total(np.log10(np.minimum(single[token], 1)))
        return {
            "n_tokens": counts + 1,
            "n_known": total((count[token] > 0).astype(np.int64)),
            "train_tokens": np.full(len(counts), n),
            "base_score": total(np.log10((count[token] + 1) * self.unseen)),
            "score": np.logaddexp2(three / np.log10(2), one / np.log10(2)) * np.log10(2) - np.log10(2),
        }


def _ranges(sorted_: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(first, last + 1, value) of the runs in a sorted array."""
    cuts = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1], [True]])) if len(sorted_) else []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield int(a), int(b), int(sorted_[a])


_readers: dict[str, Reader] = {}  # of this worker; the mapped files stay open between tasks


def _reader(model: Model) -> Reader:
    if model.folder not in _readers:
        _readers.clear()
        _readers[model.folder] = Reader(model)
    return _readers[model.folder]


def score(docs: DataFrame, model: Model, text_col: str = "text", drop_text: bool = False) -> DataFrame:
    """``docs`` with n_tokens, n_known, train_tokens, base_score and score."""
    kept = [c for c in docs.columns if c.lower() not in ADDED and not (drop_text and c == text_col)]
    schema = StructType([docs.schema[c] for c in kept])
    for name, kind in ADDED.items():
        schema = schema.add(name, kind)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a file name for each shard

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, held, size = _reader(shared.value), [], 0

        def flush() -> pa.RecordBatch:
            whole = pa.Table.from_batches(held).combine_chunks()
            found = reader.score(whole.column(text_col).to_pylist())
            columns = [*(whole.column(c) for c in kept), *(pa.array(found[c]) for c in ADDED)]
            return pa.Table.from_arrays(columns, names=[*kept, *ADDED])

        for batch in slices(batches):
            held.append(batch)
            size += batch.column(text_col).nbytes // 6 + batch.num_rows
            if size >= BATCH:
                yield from flush().to_batches()
                held, size = [], 0
        if held:
            yield from flush().to_batches()

    return docs.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def op3_trie_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return score(docs, train(docs.where(~F.col("held_out"))), drop_text=True)
