"""N-gram Jaccard join with prefix filters under several global orders.

A document is the set of its word shingles. Two documents link if their sets' Jaccard similarity reaches
``percent``; the result is each document's connected component.

1. *Sets.* Each task sends the shingles of its documents, as sorted 64-bit hashes, to the shard of their
   range. Equal sets are one from here on: a set is known by a hash of its size and shingles. A shard finds
   which shingles occur in two or more sets, and how often, and returns these by set. What overlaps is made
   of these, so a set with fewer of them than the overlap it needs leaves here; most do.
2. *Orders.* Under any one order of all shingles, two sets that link share a shingle among the first
   n - ceil(n * percent / 100) + 1 of each. All orders here put rare shingles first, so passages that many
   documents share come last; they differ in how equals are placed. A pair must share such a prefix shingle
   under every order: the pairs that the orders give are intersected, and only then are sets compared.
3. *Large groups.* A prefix shingle of more than ``GROUP`` sets yields no pairs. The sets that such shingles
   connect are a cluster, and any pair that shares one lies within a cluster. Its most central set is compared
   with all members, which ties near copies together in linear time. Members that do not reach it are compared
   with those that the triangle inequality (one minus Jaccard is a metric) allows, block by block, as matrix
   products of 0/1 rows; each block returns a forest of at most its own size.

Shingle hashes are 64 bits, so a similarity could be off only where two of a pair's shingles collide. Memory of
a task is bounded by about ``SHARD`` occurrences and by two blocks: of a shingle that ``HEAVY`` or more sets of a
task's chunk have, only the number is gathered in its shard, the occurrences are dealt out by set, and the
total goes to the buckets whose sets hold the shingle. Defined results: a null text is empty; a text without words has no shingles and is linked
with nothing, not even with its like; one with fewer words than a shingle has one shingle of all; null ids are
larger than others and name a component only if it has no other id; rows that repeat an id are in one class
each; an empty table gives an empty result; other columns are ignored by ``near_duplicates`` and passed
through by ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlake.llm.base import one_row_each, stored, table, text_batches
from silverlake.llm.components import components
from silverlake.llm.pieces import slices
from silverlake.llm.trie_lm import grow, shard_of, shrink, summed, word_edges, word_hashes

WORDS, PERCENT = 5, 75
ORDERS = 3
GROUP = 32  # sets with a prefix shingle, up to which their pairs are listed
BLOCK = 128  # sets in a block of a cluster
COLUMNS = 16_384  # shingles in one matrix product
HEAVY = 64  # sets of a task's chunk that have a shingle, from which on only their number is gathered
CHUNK = 500_000  # shingles sent at once by a task
SHARD = 2_000_000  # shingles in a shard
MIX = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The distinct shingles of a whole text, as sorted hashes."""
    data = np.frombuffer((text or "").encode().lower() + b" ", np.uint8)
    starts, ends = word_edges(data)
    if not len(starts):
        return np.zeros(0, np.uint64)
    words = min(words, len(starts))
    each = word_hashes(data, starts, ends)
    n = len(starts) - words + 1
    mixed = np.full(n, words, np.uint64)
    for k in range(words):
        mixed = (mixed ^ each[k : k + n]) * MIX
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def needed(n: Column, percent: int) -> Column:
    """The least overlap of a set of n with one it links with."""
    return F.ceil(n * percent / F.lit(100.0)).cast("int")


def links(both: Column, n: Column, m: Column, percent: int) -> Column:
    return 100 * both >= percent * (n + m - both)


# ---------------------------------------------------------------- 1. sets


def send(ids: list, marks: list, texts: list, words: int, shards: int) -> Iterator[tuple]:
    """(shard, blob): shingles by range, once for each distinct set; and the documents themselves."""
    sets, n, name = {}, [], []
    for text in texts:
        own = shingles(text, words)
        n.append(len(own))
        name.append(xxhash.xxh3_64_intdigest(own.tobytes(), seed=len(own)))
        if len(own):
            sets[name[-1]] = own
    n, name = np.array(n, np.int64), np.array(name, np.uint64)
    docs = pa.table({"doc_id": pa.array(ids, pa.int64()), "mark": pa.array(marks, pa.int64()), "n": n, "name": name.view(np.int64)})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, docs.schema) as out:
        out.write_table(docs)
    yield shards + int(name.min() % np.uint64(shards)), sink.getvalue().to_pybytes()
    if not sets:
        return
    names = np.fromiter(sets, np.uint64, len(sets))
    sizes = np.array([len(s) for s in sets.values()], np.uint32)
    key = np.concatenate([*sets.values()])
    owner = np.repeat(np.arange(len(sets), dtype=np.uint32), sizes)
    order = np.argsort(key, kind="stable")
    key, owner = key[order], owner[order]
    start = _starts(key)
    count = np.diff(np.append(start, len(key)))
    often = np.repeat(count >= HEAVY, count)
    heavy = key[start][count >= HEAVY], count[count >= HEAVY].astype(np.uint32)
    # Of a shingle that many sets have, the shard gets the number alone; where it occurs goes by set.
    to = (names % np.uint64(shards)).astype(np.int64)[owner[often]]
    for s, part in _parts(to, shards):
        yield s, OCCURS + _pack(key[often][part], owner[often][part], names, sizes)
    # And the shard is told which buckets have it, as only they need its total.
    number = np.repeat(np.arange(len(heavy[0]), dtype=np.uint64), heavy[1])
    places = np.unique(number << np.uint64(32) | to.astype(np.uint64))
    place_key, place = heavy[0][(places >> np.uint64(32)).astype(np.int64)], (places & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    key, owner = key[~often], owner[~often]
    cuts, hot = (np.searchsorted(shard_of(k, shards), np.arange(shards + 1)) for k in (key, heavy[0]))
    for s in np.flatnonzero(np.diff(cuts) + np.diff(hot)):
        one, two = slice(cuts[s], cuts[s + 1]), slice(hot[s], hot[s + 1])
        if cuts[s] < cuts[s + 1]:
            yield int(s), COUNTED + _pack(key[one], owner[one], names, sizes)
        if hot[s] < hot[s + 1]:
            yield int(s), HOT + shrink({"key": heavy[0][two], "often": heavy[1][two]})
            a = np.searchsorted(place_key, heavy[0][hot[s]])
            b = np.searchsorted(place_key, heavy[0][hot[s + 1] - 1], side="right")
            yield int(s), PLACES + shrink({"key": place_key[a:b], "bucket": place[a:b]})


# What a blob holds: occurrences that the shard counts, or passes on; shingles' numbers; the buckets that have
# these shingles; counted occurrences.
COUNTED, OCCURS, HOT, PLACES, KNOWN = b"C", b"O", b"H", b"P", b"K"


def _starts(sorted_: np.ndarray) -> np.ndarray:
    """Where the runs of a sorted array begin."""
    return np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]])) if len(sorted_) else np.zeros(0, int)


def _parts(to: np.ndarray, count: int) -> Iterator[tuple[int, np.ndarray]]:
    """(number, places) of the elements that go to each number, in their order."""
    order = np.argsort(to, kind="stable")
    cuts = np.searchsorted(to[order], np.arange(count + 1))
    for k in np.flatnonzero(np.diff(cuts)):
        yield int(k), order[cuts[k] : cuts[k + 1]]


def _pack(key: np.ndarray, owner: np.ndarray, names: np.ndarray, sizes: np.ndarray, **more: np.ndarray) -> bytes:
    here, local = np.unique(owner, return_inverse=True)
    local = local.astype(np.uint16 if len(here) <= 1 << 16 else np.uint32)
    return shrink({"key": key, "owner": local, "name": names[here], "n": sizes[here].astype(np.uint32)} | more)


def _unpack(parts: list[dict[str, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Names and sizes of the sets of several blobs, and the shingles with their sets' places."""
    empty = [np.zeros(0, np.uint64)]
    names, first, back = np.unique(
        np.concatenate([p["name"] for p in parts] or empty), return_index=True, return_inverse=True
    )
    n = np.concatenate([p["n"] for p in parts] or empty)[first].astype(np.int64)
    starts = np.cumsum([0] + [len(p["name"]) for p in parts])
    owner = [back[p["owner"].astype(np.int64) + s] for p, s in zip(parts, starts, strict=False)]
    key = np.concatenate([p["key"] for p in parts] or empty)
    return names, n, key, np.concatenate(owner or [np.zeros(0)]).astype(np.int32)


def _totals(parts: list[dict[str, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return summed(np.concatenate([p["key"] for p in parts]), np.concatenate([p["often"] for p in parts]).astype(np.int64))


def _looked_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The values of sorted keys, 0 for others."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0)


def shared(blobs: list[bytes], buckets: int) -> Iterator[tuple[int, bytes]]:
    """(bucket of sets, blob): the shard's shingles that occur in two or more sets, and how often.

    A set that several tasks saw counts once, but once for each of them among the heavy shingles; the number
    only orders shingles, and it is the same for all who see it.
    """
    names, n, key, owner = _unpack([grow(b[1:]) for b in blobs if b[:1] == COUNTED])
    order = np.lexsort((owner, key))
    key, owner = key[order], owner[order]
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])]) if len(key) else []
    key, owner = key[new], owner[new]
    start = _starts(key)
    count = np.diff(np.append(start, len(key)))
    heavy, total = _totals([grow(b[1:]) for b in blobs if b[:1] == HOT])
    total = total + _looked_up(key[start], count, heavy)
    often = np.repeat(count, count)
    often = np.maximum(often, _looked_up(heavy, total, key))
    key, owner, often = key[often > 1], owner[often > 1], often[often > 1].astype(np.uint32)
    to = (names % np.uint64(buckets)).astype(np.int64)[owner]
    for bucket, part in _parts(to, buckets):
        yield bucket, KNOWN + _pack(key[part], owner[part], names, n, often=often[part])
    places = [grow(b[1:]) for b in blobs if b[:1] == PLACES]
    if places:
        at = np.searchsorted(heavy, np.concatenate([p["key"] for p in places])).astype(np.uint64)
        pairs = np.unique(np.concatenate([p["bucket"] for p in places]).astype(np.uint64) << np.uint64(32) | at)
        bucket, at = (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)
        for start, end in zip((cuts := np.append(_starts(bucket), len(bucket)))[:-1], cuts[1:], strict=True):
            mine = at[start:end]
            yield int(bucket[start]), HOT + shrink({"key": heavy[mine], "often": total[mine].astype(np.uint32)})


def assemble(blobs: list[bytes], percent: int) -> pa.Table:
    """The sets of a bucket that have enough shared shingles to link: name, n, shingles, often."""
    known = [grow(b[1:]) for b in blobs if b[:1] == KNOWN]
    heavy, total = _totals([grow(b[1:]) for b in blobs if b[:1] == HOT])
    passed = [grow(b[1:]) for b in blobs if b[:1] == OCCURS]
    for part in passed:
        part["often"] = _looked_up(heavy, total, part["key"]).astype(np.uint32)
    names, n, key, owner = _unpack(known + passed)
    often = np.concatenate([p["often"] for p in known + passed] or [np.zeros(0, np.uint32)])
    # A set that several tasks saw has its heavy shingles several times.
    order = np.lexsort((key, owner))
    key, owner, often = key[order], owner[order], often[order]
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])]) if len(key) else []
    key, owner, often = key[new], owner[new], often[new]
    enough = np.bincount(owner, minlength=len(names)) >= -(-n * percent // 100)
    keep = enough[owner]
    counts = np.bincount(owner[keep], minlength=len(names))[enough]
    ends = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
    return pa.table(
        {
            "name": names[enough].view(np.int64),
            "n": n[enough].astype(np.int32),
            "shingles": pa.ListArray.from_arrays(ends, pa.array(key[keep].view(np.int64))),
            "often": pa.ListArray.from_arrays(ends, pa.array(often[keep].astype(np.int32))),
        }
    )


@dataclass(frozen=True)
class Sets:
    """``docs``: doc_id, mark, n, name (of the set). ``sets``: name, n, shingles, often, for sets that may link."""

    docs: DataFrame
    sets: DataFrame


def collect_sets(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> Sets:
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("mark"),
    )
    text_batches(docs.sparkSession)
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = size // (6 * SHARD) + 1  # a word and its space take about six characters

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = ([], [], []), 0

        def flush() -> pa.RecordBatch:
            names, blobs = zip(*send(held[0], held[2], held[1], words, shards), strict=True)
            return pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(blobs, pa.binary())], ["shard", "blob"])

        for batch in slices(batches):
            for column, values in zip(batch.columns, held, strict=True):
                values.extend(column.to_pylist())
            count += batch.column(1).nbytes // 6 + batch.num_rows
            if count >= CHUNK:
                yield flush()
                held, count = ([], [], []), 0
        if held[0]:
            yield flush()

    kinds = {"doc_id": pa.int64(), "mark": pa.int64(), "name": pa.int64(), "n": pa.int64()}
    schema = pa.schema([*kinds.items(), ("bucket", pa.int32()), ("blob", pa.binary())])

    def build(group: pa.Table) -> pa.Table:
        blobs = group["blob"].to_pylist()
        if group["shard"][0].as_py() < shards:
            passed = [(group["shard"][0].as_py(), b) for b in blobs if b[:1] == OCCURS]
            found = passed + list(shared([b for b in blobs if b[:1] != OCCURS], shards))
            buckets, data = zip(*found, strict=True) if found else ((), ())
            found = pa.table({"bucket": pa.array(buckets, pa.int32()), "blob": pa.array(data, pa.binary())})
        else:
            found = pa.concat_tables([pa.ipc.open_stream(b).read_all() for b in blobs])
        columns = [found[f.name] if f.name in found.column_names else pa.nulls(len(found), f.type) for f in schema]
        return pa.table(columns, schema=schema)

    def build_sets(group: pa.Table) -> pa.Table:
        return assemble(group["blob"].to_pylist(), percent)

    built = rows.mapInArrow(run, "shard int, blob binary").groupBy("shard").applyInArrow(
        build, "doc_id long, mark long, name long, n long, bucket int, blob binary"
    )
    built = stored(built, "shingles")
    parts = built.where("blob is not null").select("bucket", "blob").groupBy("bucket")
    sets = parts.applyInArrow(build_sets, "name long, n int, shingles array<long>, often array<int>")
    return Sets(built.where("blob is null").select("doc_id", "mark", "n", "name"), stored(sets, "sets"))


# ---------------------------------------------------------------- 2. orders


def prefixes(sets: DataFrame, percent: int, orders: int = ORDERS) -> DataFrame:
    """``at`` (the order), ``shingle``, ``name``, ``n``: the shared shingles in the prefix under each order.

    Shingles of one set alone come first under every order and are not listed.
    """
    n, known = F.col("n"), F.size("shingles")
    length = known - needed(n, percent) + 1
    zipped = F.arrays_zip("often", "shingles")

    def prefix(k: int) -> Column:
        # By frequency, or by its power of two; equals by another hash each time.
        rank = [lambda x: x["often"], lambda x: F.floor(F.log2(x["often"])).cast("int"), lambda x: F.floor(F.log2(x["often"]) * 2).cast("int")][k % 3]
        keyed = F.transform(
            zipped, lambda x: F.struct(rank(x).alias("r"), F.xxhash64(x["shingles"], F.lit(k)).alias("h"), x["shingles"].alias("s"))
        )
        return F.slice(F.array_sort(keyed), 1, length)["s"]

    lists = F.array(*(F.struct(F.lit(k).alias("at"), prefix(k).alias("list")) for k in range(orders)))
    each = sets.select("name", "n", F.explode(lists).alias("one"))
    return each.select("name", "n", "one.at", F.explode("one.list").alias("shingle"))


def compatible(n: Column, m: Column, percent: int) -> Column:
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def candidates(entries: DataFrame, clusters: DataFrame, percent: int, orders: int = ORDERS) -> DataFrame:
    """Pairs ``a`` < ``b`` of set names that share a prefix shingle under every order, outside of one cluster."""
    few = entries.where(F.col("sets") <= GROUP).join(clusters, "name", "left")
    left = few.select("at", "shingle", F.col("name").alias("a"), F.col("n").alias("n"), F.col("cluster").alias("c"))
    right = few.select("at", "shingle", F.col("name").alias("b"), F.col("n").alias("m"), F.col("cluster").alias("d"))
    pairs = left.join(right, ["at", "shingle"]).where(
        (F.col("a") < F.col("b"))
        & compatible(F.col("n"), F.col("m"), percent)
        & ~F.coalesce(F.col("c") == F.col("d"), F.lit(False))
    )
    bit = F.expr("shiftleft(1, at)")
    return pairs.groupBy("a", "b").agg(F.bit_or(bit).alias("seen")).where(F.col("seen") == (1 << orders) - 1)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets link."""
    one = sets.select(F.col("name").alias("a"), F.col("n"), F.col("shingles").alias("x"))
    two = sets.select(F.col("name").alias("b"), F.col("n").alias("m"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return pairs.join(one, "a").join(two, "b").where(links(both, F.col("n"), F.col("m"), percent)).select("a", "b")


# ---------------------------------------------------------------- 3. clusters


def find_clusters(entries: DataFrame) -> DataFrame:
    """``name``, ``cluster``: sets that prefix shingles of large groups connect."""
    many = entries.where(F.col("sets") > GROUP)
    centre = stored(many.groupBy("at", "shingle").agg(F.min("name").alias("centre")), "centres")
    ties = many.join(centre, ["at", "shingle"]).select("name", "centre").distinct()
    return components(ties, "name", "centre").select(F.col("node").alias("name"), F.col("root").alias("cluster"))


def cluster_links(sets: DataFrame, clusters: DataFrame, percent: int) -> DataFrame:
    """Links ``a``, ``b`` that connect whatever links within a cluster."""
    central = F.aggregate("often", F.lit(0).cast("double"), lambda s, x: s + x) / F.col("n")
    members = stored(sets.join(clusters, "name").withColumn("central", central), "members")
    pivots = members.groupBy("cluster").agg(F.max(F.struct("central", "name")).alias("top"))
    pivots = pivots.select(F.col("top.name").alias("name"))
    pivots = members.join(pivots, "name", "left_semi").select(
        "cluster", F.col("name").alias("pivot"), F.col("n").alias("m"), F.col("shingles").alias("y")
    )
    both = F.size(F.array_intersect("shingles", "y"))
    compared = members.join(stored(pivots, "pivots"), "cluster").select(
        "cluster", "pivot", "name", "n", "shingles",
        links(both, F.col("n"), F.col("m"), percent).alias("near"),
        (1 - both / (F.col("n") + F.col("m") - both)).alias("distance"),
    )
    compared = stored(compared, "compared")
    ties = compared.where("near and name <> pivot").select(F.col("name").alias("a"), F.col("pivot").alias("b"))
    # A member that the pivot's distance allows for some far one; the nearest far one decides.
    reach = 1 - percent / 100 + 1e-9
    counts = compared.groupBy("cluster").agg(
        F.ceil(F.sum(F.when(F.col("near"), 0).otherwise(1)) / BLOCK).cast("int").alias("rows"),
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("cols"),
        F.min(F.when(~F.col("near"), F.col("distance"))).alias("least"),
    )
    placed = compared.join(stored(counts.where("rows > 0"), "far"), "cluster").where(F.col("distance") >= F.col("least") - reach)
    number = F.xxhash64("name")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    kept = ["cluster", "name", "n", "shingles", "distance"]
    fresh_ = [F.col(c).alias(c) for c in kept]  # the two sides of the cogroup must not share columns
    far = placed.where("not near").select(*fresh_, F.pmod(number, "rows").cast("int").alias("i"), every("cols").alias("j"))
    any_ = placed.select(*kept, F.pmod(number, "cols").cast("int").alias("j"), every("rows").alias("i"))
    keys = ["cluster", "i", "j"]

    def compare(one: pd.DataFrame, two: pd.DataFrame) -> pd.DataFrame:
        return block_links(one, two, percent, reach) if len(one) and len(two) else pd.DataFrame({"a": [], "b": []})

    found = far.groupBy(*keys).cogroup(any_.groupBy(*keys)).applyInPandas(compare, "a long, b long")
    return ties.unionByName(found)


def block_links(one: pd.DataFrame, two: pd.DataFrame, percent: int, reach: float) -> pd.DataFrame:
    """A forest that connects what links between two blocks (columns name, n, shingles, distance)."""
    n, m = one["n"].to_numpy(), two["n"].to_numpy()
    a, b = one["name"].to_numpy(), two["name"].to_numpy()
    left, right = (np.concatenate(side["shingles"].tolist()) for side in (one, two))
    of, to = (np.repeat(np.arange(len(side)), side["shingles"].map(len)) for side in (one, two))
    vocabulary, place = np.unique(left, return_inverse=True)
    other = np.searchsorted(vocabulary, right)
    other[other == len(vocabulary)] = 0
    hit = vocabulary[other] == right
    other, to = other[hit], to[hit]
    both = np.zeros((len(one), len(two)))
    for at in range(0, len(vocabulary), COLUMNS):
        x, y = np.zeros((len(one), COLUMNS), np.float32), np.zeros((len(two), COLUMNS), np.float32)
        here, there = (place >= at) & (place < at + COLUMNS), (other >= at) & (other < at + COLUMNS)
        x[of[here], place[here] - at] = 1
        y[to[there], other[there] - at] = 1
        both += x @ y.T
    near = 100 * both >= percent * (n[:, None] + m - both)
    near &= np.abs(one["distance"].to_numpy()[:, None] - two["distance"].to_numpy()) <= reach
    near &= a[:, None] != b
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for i, j in np.argwhere(near):
        x, y = find(int(a[i])), find(int(b[j]))
        if x != y:
            root[x] = y
            out.append((int(a[i]), int(b[j])))
    return pd.DataFrame(out, columns=["a", "b"]).astype("int64")


# ---------------------------------------------------------------- the operator


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """For each row: doc_id, n_shingles, component_id (smallest id it is connected with), mark, keeper.

    ``mark`` is a hash of the text. ``keeper`` has the id and mark of the component's row with the smallest id.
    """
    found = collect_sets(docs, id_col, text_col, words, percent)
    entries = stored(prefixes(found.sets, percent), "prefixes")
    # Stored, so that the join deals out its rows by itself and Spark may split a frequent shingle.
    counts = stored(entries.groupBy("at", "shingle").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1"), "counts")
    entries = stored(entries.join(counts, ["at", "shingle"]), "entries")
    clusters = stored(find_clusters(entries), "clusters")
    ties = verified(candidates(entries, clusters, percent), found.sets, percent)
    ties = ties.unionByName(cluster_links(found.sets, clusters, percent))
    roots = stored(components(ties), "roots")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")
    sets = found.docs.where("n > 0").groupBy("name").agg(F.min(order).alias("least"))
    sets = stored(sets.join(roots.withColumnRenamed("node", "name"), "name", "left"), "set-ids")
    sets = sets.select("name", "least", F.coalesce("root", "name").alias("root"))
    classes = stored(sets.groupBy("root").agg(F.min("least").alias("keeper")), "classes")
    keepers = stored(sets.join(classes, "root").select("name", "keeper"), "keepers")
    whole = found.docs.join(keepers, "name", "left")
    keeper = F.when(F.col("n") > 0, F.col("keeper")).otherwise(order)
    return whole.select("doc_id", "n", "mark", keeper.alias("keeper")).select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.col("keeper.doc_id").alias("component_id"), "mark", "keeper"
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with the smallest id of their component, with all their columns."""
    rows = near_duplicates(docs, id_col, text_col)
    keys = rows.select(_row_key(F.col("keeper.doc_id"), F.col("keeper.mark")).alias("key")).distinct()
    mark = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    return one_row_each(docs, _row_key(F.col(id_col).cast("long"), mark), keys)


def _row_key(doc_id: Column, mark: Column) -> Column:
    return F.concat_ws(":", doc_id.cast("string"), mark.cast("string"))


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id")
