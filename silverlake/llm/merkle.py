"""A Merkle manifest of a dataset, and proofs for any set of its rows by octopus multiproofs.

A leaf is the SHA-256 of a row's fields, each written as its length in bytes, a colon and its value, or
``-`` for null. The leaves of one tree (one language) ascend by id; two neighbours at a time become the
SHA-256 of their digests, a last one without a neighbour that of its own, until one node is left, the
subroot. The subroots, in the order of their trees, give the root in the same way. Digests are joined as
lowercase hex text.

A node is known by its tree, level and index, so which nodes a proof needs follows from positions alone.
Leaves are proved by partition, ``BLOCK`` neighbouring places of one tree: a partition works out the least
set of nodes that its leaves need and cannot derive themselves (``missing``), all partitions fetch theirs
in one join, and each derives the nodes its proofs share once and writes out the single proofs.

Defined results: nulls of any column are ``-`` in the leaf; a null tree key is a tree of its own and comes
first, as null ids do; leaves with one id are ordered by digest, and repeated rows have a place each, so they
have proofs of their own; a very long text is hashed whole and moves nowhere; an empty table has no proofs;
other columns are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlake.llm.base import stored, table
from silverlake.llm.positions import in_order, numbered

#: Levels that one task builds at once, so that ``2 ** BITS`` leaves are one partition.
BITS = 12
BLOCK = 1 << BITS
#: The fields of a leaf of ``documents``.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

#: The tree of the subroots, beside those numbered from 0.
TOP = -1
NODE = "tree long, level int, idx long, size long, hash string"


def leaf_digest(fields: Iterable[Column]) -> Column:
    """The leaf of a row with these fields."""
    texts = [f.cast("string") for f in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


class Manifest:
    """``leaves`` (tree, position, size, leaf and the columns given), ``trees`` (tree, key, subroot) and
    ``nodes`` (tree, level, idx, size of the level, hash; from level 1 on, the subroots' tree is ``TOP``)."""

    def __init__(self, leaves: DataFrame, nodes: DataFrame, trees: DataFrame) -> None:
        self.leaves, self.nodes, self.trees = leaves, nodes, trees


def manifest(rows: DataFrame, tree_key: str, order: str, leaf: str) -> Manifest:
    """The manifest of ``rows``: a tree for each ``tree_key``, its leaves (hex digests) by ``order``.

    All columns of ``rows`` stay with the leaves, so give only those that are needed.
    """
    # Rows that agree in everything may be many; their numbers let them spread over parts.
    marked = stored(rows.withColumn("__row", F.monotonically_increasing_id()), "leaves")
    ordered = in_order(marked, [tree_key, order, leaf, "__row"], "__mark").drop("__row")
    placed = numbered(ordered, tree_key, "__mark", "position", "size")
    keys = placed.where("position = 0").select(F.col(tree_key).alias("__key"), "size")
    keys = in_order(keys.withColumn("__all", F.lit(0)), ["__all", "__key"], "__mark")
    trees = stored(numbered(keys.drop("size"), "__all", "__mark", "tree", "trees").drop("__all"), "trees")
    joined = placed.join(trees, F.col(tree_key).eqNullSafe(F.col("__key")))
    leaves = stored(joined.drop("__key"), "leaves")

    level0 = leaves.select("tree", F.lit(0).alias("level"), F.col("position").alias("idx"), "size", F.col(leaf).alias("hash"))
    nodes = _build(level0)
    subroots = level0.unionByName(nodes).where("size = 1").select("tree", F.col("hash").alias("subroot"))
    trees = stored(trees.join(subroots, "tree"), "trees")
    top = trees.select(
        F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("idx"),
        F.col("trees").alias("size"), F.col("subroot").alias("hash"),
    )
    return Manifest(leaves, nodes.unionByName(_build(top)), trees)


def _build(level0: DataFrame) -> DataFrame:
    """All nodes above ``level0``: each round takes every tree ``BITS`` levels up, block by block."""
    spark = level0.sparkSession
    largest = level0.agg(F.max("size")).first()[0] or 0
    found, below, top = [], level0, 0
    while largest > 1 << top:
        blocks = below.where("size > 1").groupBy("tree", F.shiftright("idx", BITS).alias("block"))
        found.append(stored(blocks.applyInArrow(_raise, NODE), "nodes"))
        top += BITS
        below = found[-1].where(F.col("level") == top)
    if not found:
        return spark.createDataFrame([], NODE)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _parent(left: str, right: str | None) -> str:
    return sha256((left + right if right else left).encode()).hexdigest()


def _raise(block: pa.Table) -> pa.Table:
    """The nodes above one block's, up to ``BITS`` levels or the tree's last node."""
    block = block.sort_by("idx")
    tree, level, size, start = (block.column(c)[0].as_py() for c in ("tree", "level", "size", "idx"))
    hashes = block.column("hash").to_pylist()
    out = {"tree": [], "level": [], "idx": [], "size": [], "hash": []}
    for _ in range(BITS):
        if size == 1:
            break
        hashes = [_parent(*hashes[i : i + 2], *[None][len(hashes[i : i + 2]) - 1 :]) for i in range(0, len(hashes), 2)]
        level, size, start = level + 1, (size + 1) // 2, start // 2
        n = len(hashes)
        for name, values in zip(out, ([tree] * n, [level] * n, range(start, start + n), [size] * n, hashes), strict=True):
            out[name].extend(values)
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
    return pa.table({c: pa.array(v, k) for (c, v), k in zip(out.items(), kinds, strict=True)})


def missing(positions: Iterable[int], size: int) -> list[tuple[int, int]]:
    """The least (level, index) set from which, with the leaves at ``positions``, the subroot follows.

    Level by level: the parents of what is known, and a sibling only where it is neither known nor
    beyond the level's end.
    """
    found, known, level = [], set(positions), 0
    while size > 1:
        found += sorted((level, i ^ 1) for i in known if i ^ 1 not in known and i ^ 1 < size)
        known, size, level = {i >> 1 for i in known}, (size + 1) // 2, level + 1
    return found


def _requests(part: pa.Table) -> pa.Table:
    tree, block, size, trees = (part.column(c)[0].as_py() for c in ("tree", "block", "size", "trees"))
    inner = [(tree, *at) for at in missing(part.column("position").to_pylist(), size)]
    wanted = inner + [(TOP, *at) for at in missing([tree], trees)]
    columns = list(zip(*wanted, strict=True)) or [(), (), ()]
    n = len(wanted)
    return pa.table(
        {
            "tree": pa.array([tree] * n, pa.int64()), "block": pa.array([block] * n, pa.int64()),
            "of": pa.array(columns[0], pa.int64()), "level": pa.array(columns[1], pa.int32()),
            "idx": pa.array(columns[2], pa.int64()),
        }
    )


def derive(known: dict[int, str], fetched: dict[tuple[int, int], str], size: int) -> list[dict[int, str]]:
    """Every level's nodes that follow from the leaves ``known`` and the nodes ``fetched``."""
    levels, level = [], 0
    while True:
        here = known | {i: h for (at, i), h in fetched.items() if at == level}
        levels.append(here)
        if size == 1:
            return levels
        known = {i >> 1: _parent(here[i & ~1], here.get(i | 1)) for i in known}
        size, level = (size + 1) // 2, level + 1


def paths(levels: list[dict[int, str]], wanted: Iterable[int], above: list) -> dict[int, list]:
    """For each wanted leaf its siblings from the bottom, None where there is none, then ``above``."""
    needed = [set(wanted)]
    for _ in levels[1:]:
        needed.append({i >> 1 for i in needed[-1]})
    path = {i: above for i in needed[-1]}
    for here, below in zip(levels[-2::-1], needed[-2::-1], strict=True):
        path = {i: [here.get(i ^ 1), *path[i >> 1]] for i in below}
    return path


def proofs(tree: Manifest, leaf: str, wanted: DataFrame | None = None) -> DataFrame:
    """Rows of ``tree.leaves`` with ``subroot``, ``root``, ``proof`` and ``sides``.

    ``proof`` lists the sibling on each level up to the root, null where there is none; ``sides`` has
    a ``<`` for each level where the sibling comes first. ``wanted`` may hold some of the leaves' rows;
    without it, all are proved.
    """
    leaves = (tree.leaves if wanted is None else wanted).withColumn("block", F.shiftright("position", BITS))
    narrow = leaves.select("tree", "block", "position", "size", "trees")
    asked = narrow.groupBy("tree", "block").applyInArrow(_requests, "tree long, block long, of long, level int, idx long")
    asked = stored(asked, "requests")
    pool = tree.nodes.select(F.col("tree").alias("of"), "level", "idx", "hash")
    pool = pool.unionByName(
        tree.leaves.select(F.col("tree").alias("of"), F.lit(0).alias("level"), F.col("position").alias("idx"), F.col(leaf).alias("hash"))
    ).unionByName(
        tree.trees.select(F.lit(TOP).cast("long").alias("of"), F.lit(0).alias("level"), F.col("tree").alias("idx"), F.col("subroot").alias("hash"))
    )
    fetched = asked.join(pool, ["of", "level", "idx"])
    kept = [c for c in leaves.columns if c != "block"]
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in leaves.select(*kept).schema)

    def expand(part: pa.Table, nodes: pa.Table) -> pa.Table:
        at = part.column("position").to_pylist()
        number, size, trees = (part.column(c)[0].as_py() for c in ("tree", "size", "trees"))
        inner, upper = {}, {}
        for of, level, idx, digest in zip(*(nodes.column(c).to_pylist() for c in ("of", "level", "idx", "hash")), strict=True):
            (upper if of == TOP else inner)[level, idx] = digest
        levels = derive(dict(zip(at, part.column(leaf).to_pylist(), strict=True)), inner, size)
        subroot = levels[-1][0]
        tops = derive({number: subroot}, upper, trees)
        path = paths(levels, at, paths(tops, [number], [])[number])
        n, depth = len(at), len(levels) - 1
        end = "".join("<" if number >> i & 1 else ">" for i in range(len(tops) - 1))
        sides = ["".join("<" if p >> i & 1 else ">" for i in range(depth)) + end for p in at]
        result = part.select(kept)
        for name, values, kind in (
            ("subroot", [subroot] * n, pa.string()), ("root", [tops[-1][0]] * n, pa.string()),
            ("proof", [path[p] for p in at], pa.list_(pa.string())), ("sides", sides, pa.string()),
        ):
            result = result.append_column(name, pa.array(values, kind))
        return result

    return leaves.groupBy("tree", "block").cogroup(fetched.groupBy("tree", "block")).applyInArrow(
        expand, f"{out}, subroot string, root string, proof array<string>, sides string"
    )


def folded(leaf: Column, proof: Column, sides: Column) -> Column:
    """The root that follows from a leaf and its proof; equals the root if neither was changed."""
    steps = F.transform(proof, lambda h, i: F.struct(h.alias("h"), (F.substr(sides, i + 1, F.lit(1)) == "<").alias("first")))

    def up(below: Column, step: Column) -> Column:
        other = F.coalesce(step["h"], F.lit(""))
        return F.sha2(F.when(step["first"], F.concat(other, below)).otherwise(F.concat(below, other)), 256)

    return F.aggregate(steps, leaf, up)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    hit = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    changed = [F.try_add(F.col(c), F.lit(1)) if c == "n_chars" else F.col(c) for c in FIELDS]
    leaves = docs.select(
        "doc_id",
        "lang",
        leaf_digest(F.col(c) for c in FIELDS).alias("leaf"),
        F.when(hit, leaf_digest(changed)).alias("tampered_leaf"),
    )
    proved = proofs(manifest(leaves, "lang", "doc_id", "leaf"), "leaf")
    now = F.coalesce("tampered_leaf", "leaf")
    return proved.select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(F.concat_ws("", "proof"), 256).alias("proof_sha256"),
        folded(now, F.col("proof"), F.col("sides")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


_CRC32 = """(xor(list_reduce(list_concat([4294967295],
    list_transform(range(8 * length({text})), lambda i: CASE WHEN i % 8 = 0 THEN ascii(substr({text}, i // 8 + 1, 1)) ELSE 0 END)),
    lambda c, b: CASE WHEN xor(c, b) & 1 = 1 THEN xor(xor(c, b) >> 1, 3988292384) ELSE xor(c, b) >> 1 END), 4294967295))"""


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text as DuckDB SQL."""
    return _CRC32.format(text=text)


def _leaf_sql(n_chars: str) -> str:
    fields = [n_chars if c == "n_chars" else c for c in FIELDS]
    texts = [f"CAST({f} AS VARCHAR)" for f in fields]
    return "sha256(" + " || ".join(f"coalesce(strlen({t}) || ':' || {t}, '-')" for t in texts) + ")"


SQL = f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, lang, {_leaf_sql("n_chars")} AS leaf,
         CASE WHEN {crc32_sql("CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN {_leaf_sql("n_chars + 1")} END AS tampered
  FROM documents),
numbers AS (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, count(*) OVER () AS trees,
                   n FROM (SELECT lang, count(*) AS n FROM hashed GROUP BY lang)),
leaves AS (SELECT doc_id, leaf, coalesce(tampered, leaf) AS given, tree, trees, n,
                  row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
           FROM hashed JOIN numbers ON hashed.lang IS NOT DISTINCT FROM numbers.lang),
up AS (SELECT tree, 0 AS level, pos AS idx, n AS size, leaf AS hash FROM leaves
       UNION ALL
       SELECT tree, level + 1, idx // 2, (size + 1) // 2, sha256(string_agg(hash, '' ORDER BY idx))
       FROM up WHERE size > 1 GROUP BY tree, level, idx // 2, size),
top AS (SELECT 0 AS level, up.tree AS idx, trees AS size, hash FROM up JOIN numbers USING (tree) WHERE size = 1
        UNION ALL
        SELECT level + 1, idx // 2, (size + 1) // 2, sha256(string_agg(hash, '' ORDER BY idx))
        FROM top WHERE size > 1 GROUP BY level, idx // 2, size),
walk AS (SELECT tree, pos, doc_id, 0 AS stage, 0 AS level, pos AS spot, n AS size, given AS hash, '' AS proof FROM leaves
         UNION ALL
         SELECT w.tree, pos, doc_id, CASE WHEN w.size = 1 THEN 1 ELSE stage END,
                CASE WHEN w.size = 1 THEN 0 ELSE w.level + 1 END,
                CASE WHEN w.size = 1 THEN w.tree ELSE spot // 2 END,
                CASE WHEN w.size = 1 THEN trees ELSE (w.size + 1) // 2 END,
                CASE WHEN w.size = 1 THEN w.hash
                     WHEN spot % 2 = 1 THEN sha256(coalesce(u.hash, t.hash, '') || w.hash)
                     ELSE sha256(w.hash || coalesce(u.hash, t.hash, '')) END,
                CASE WHEN w.size = 1 THEN proof ELSE proof || coalesce(u.hash, t.hash, '') END
         FROM walk w JOIN numbers n ON n.tree = w.tree
         LEFT JOIN up u ON stage = 0 AND w.size > 1 AND u.tree = w.tree AND u.level = w.level AND u.idx = xor(spot, 1)
         LEFT JOIN top t ON stage = 1 AND w.size > 1 AND t.level = w.level AND t.idx = xor(spot, 1)
         WHERE w.size > 1 OR stage = 0)
SELECT l.doc_id, leaf, s.hash AS subroot, r.hash AS root, sha256(proof) AS proof_sha256, w.hash AS folded_root,
       w.hash = r.hash AS verified
FROM leaves l JOIN walk w ON w.tree = l.tree AND w.pos = l.pos AND w.stage = 1 AND w.size = 1
JOIN up s ON s.tree = l.tree AND s.size = 1 CROSS JOIN (SELECT hash FROM top WHERE size = 1) r"""
