"""Approximate nearest neighbours by multiprobe p-stable hashing.

A table hashes a vector x to the cell floor((a . x + b) / w) over ``K`` random normal directions a. A query
visits its own cell and cells that differ by one step in some directions, in the order of their
estimated success: a step costs the squared distance to the border it crosses, and a cell the sum of its
steps. What the tables find is merged, and nearness is computed exactly on the original vectors.

``calibrate`` fits the width w, the number of tables and the number of cells visited: for at most
``SAMPLE`` vectors (picked by a hash) the true neighbours among all rows are found by brute force, and of all
settings that would have found ``RECALL`` of them the cheapest is taken. Widths are multiples of several
quantiles of the distance to the k-th neighbour, as rows may lie in parts of different density. If none of
the settings reaches the recall, they are widened for as long as they read fewer rows than there are; if that does
not reach it either, all queries are compared with all rows, in blocks of both. Every row is indexed.

Equal vectors are merged first, with their k + 1 smallest ids, more of which can never be among the k nearest
(salted, so a vector that a third of the rows share is spread). Cells are dealt to groups of about ``GROUP``
vectors; a cell that has more by itself is split into parts, and a query visits all of them, so no row is left
out. Python computes distances as array operations on a group and the queries that visit it.

Defined results: vectors that are null, zero, or hold null or non-finite components, and vectors of
another length than most, take no part; nor do null ids; rows that repeat an id and a vector count once;
ties go to the smaller id; a query never finds its own id; a query for which the tables hold fewer than k is
compared with all rows, so fewer than k candidates give all of them; empty tables give an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silverlake.llm.base import stored, table

K = 6  # directions of a table
TABLES = (2, 4, 8, 12)
WIDTHS = (0.9, 1.2, 1.6, 2.2)  # times a quantile of the distances to the k nearest
UPPER = (0.5, 0.75, 0.9, 1.0)  # the quantiles
WIDER = 1.4  # step beyond them
SAMPLE, RECALL, SEED = 64, 0.97, 11
SALT, GROUP = 64, 4096
COPY = 40  # comparisons that cost as much as one more copy of a vector

_steps = np.array(list(product((-1, 0, 1), repeat=K)))
_crossed = np.concatenate([_steps == -1, _steps == 1], axis=1).T.astype(float)
_mix = np.random.default_rng(5).integers(1 << 62, size=K, dtype=np.int64) | 1


def usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0)


def prepare(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id`` and ``vector`` of the rows that take part, each once."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("vector")))
    sizes = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").limit(1)
    usual = sizes.first()
    return rows.where(F.size("vector") == (usual["n"] if usual else 0))


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """``vector`` and ``ids``, the k + 1 smallest ids of the rows that have it."""

    def smallest(ids: Column) -> Column:
        return F.slice(F.array_sort(F.array_distinct(ids)), 1, k + 1).alias("ids")

    salted = rows.groupBy("vector", F.pmod(F.xxhash64("id"), F.lit(SALT)).alias("salt"))
    parts = salted.agg(smallest(F.collect_set("id")))
    return parts.groupBy("vector").agg(smallest(F.flatten(F.collect_list("ids"))))


@dataclass(frozen=True)
class Tables:
    directions: np.ndarray  # tables x length x K
    offsets: np.ndarray  # tables x K, in cells
    width: float
    probes: int  # 0: compare with all rows

    def project(self, x: np.ndarray) -> np.ndarray:
        """Place of each vector in each table, in cells: tables x vectors x K."""
        return x @ self.directions / self.width + self.offsets[:, None]

    def visits(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For one table's places: the cells to visit, in order of success (vectors x probes x K), and costs."""
        cells = np.floor(places)
        inside = places - cells
        costs = np.concatenate([inside**2, (1 - inside) ** 2], axis=1) @ _crossed
        order = np.argsort(costs, axis=1, kind="stable")[:, : self.probes]
        return cells[:, None].astype(np.int64) + _steps[order], costs


def cell_keys(cells: np.ndarray) -> np.ndarray:
    """A number for each cell; cells that share one by chance are searched together."""
    return ((cells.astype(np.int64) + 7) * _mix).sum(axis=-1)


def random_tables(length: int, count: int, width: float, probes: int, seed: int = SEED) -> Tables:
    rng = np.random.default_rng(seed)
    return Tables(rng.normal(size=(count, length, K)), rng.random((count, K)), width, probes)


# ---------------------------------------------------------------- calibration


def calibrate(rows: DataFrame, k: int, queries: int, recall: float = RECALL) -> Tables | None:
    """Tables for the distinct vectors ``rows`` and so many queries; None if there are no vectors."""
    count_rows = rows.count()
    order = F.xxhash64("vector")
    picked = [np.array(r["vector"], float) for r in rows.select("vector").orderBy(order, "vector").limit(SAMPLE).collect()]
    if not picked:
        return None
    sample = np.array(picked)
    shared = rows.sparkSession.sparkContext.broadcast(sample)

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.array(batch["vector"].tolist(), float)
            for q, point in enumerate(shared.value):
                d = ((x - point) ** 2).sum(axis=1)
                at = np.argsort(d, kind="stable")[: k + 1]
                yield pd.DataFrame({"q": q, "d": d[at], "vector": [*x[at]]})

    found = rows.select("vector").mapInPandas(nearest, "q int, d double, vector array<double>")
    best = F.row_number().over(Window.partitionBy("q").orderBy("d", "vector"))
    # SAMPLE x (k + 1) rows. The nearest is the sampled vector itself.
    pairs = found.withColumn("rank", best).where((F.col("rank") <= k + 1) & (F.col("rank") > 1)).collect()
    if not pairs:
        return random_tables(sample.shape[1], 1, 1.0, 1)
    q = np.array([r["q"] for r in pairs])
    true = np.array([r["vector"] for r in pairs])
    distances = np.sqrt([r["d"] for r in pairs])
    widths = sorted({w * float(r) for r in np.quantile(distances, UPPER) for w in WIDTHS})
    settings, least = [], 0.0
    while not settings and least < count_rows:
        least = np.inf
        for width, count in product(widths, TABLES):
            tables = random_tables(sample.shape[1], count, width, len(_steps))
            hit = np.sort(_visit_ranks(tables, sample, true, q).min(axis=0))
            found_at = np.searchsorted(hit, np.arange(len(_steps)), side="right") / len(hit)
            enough = int(np.searchsorted(found_at, recall))
            read = (_visit_ranks(tables, sample, sample) <= enough).mean(axis=(1, 2)).sum() * count_rows
            least = min(least, read)
            if enough < len(_steps):
                copies = COPY * count * count_rows / max(queries, 1)
                settings.append((read + copies + count * enough, width, count, enough + 1))
        widths = [widths[-1] * WIDER]
    _, width, count, probes = min(settings, default=(0, widths[-1], 1, 0))
    return random_tables(sample.shape[1], count, width, probes)


def _visit_ranks(tables: Tables, queries: np.ndarray, x: np.ndarray, q: np.ndarray | None = None) -> np.ndarray:
    """When a query visits the cell of x in each table; with ``q``, for the pairs (q[i], x[i]) alone."""
    best = []
    for places, others in zip(tables.project(queries), tables.project(x), strict=True):
        _, costs = tables.visits(places)
        ranks = np.empty_like(costs, dtype=np.int64)
        np.put_along_axis(ranks, np.argsort(costs, axis=1, kind="stable"), np.arange(len(_steps))[None], axis=1)
        home = np.floor(places)
        step = np.floor(others) - (home[q] if q is not None else home[:, None])
        near = (np.abs(step) <= 1).all(axis=-1)
        code = ((np.clip(step, -1, 1) + 1) @ 3 ** np.arange(K)[::-1]).astype(np.int64)
        rank = ranks[q, code] if q is not None else np.take_along_axis(ranks, code, axis=1)
        best.append(np.where(near, rank, len(_steps)))
    return np.array(best)


# ---------------------------------------------------------------- search


def search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    recall: float = RECALL,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score (Euclidean distance): the k nearest found of each query.

    ``queries`` has the same columns as ``vectors``; a query's own id is not among its neighbours.
    """
    rows = prepare(vectors, id_col, vector_col)
    kind = rows.schema["vector"].dataType.simpleString()
    index = stored(distinct_vectors(rows, k), "vectors")
    asked = prepare(queries, id_col, vector_col).dropDuplicates(["id", "vector"])
    tables = calibrate(index, k, asked.count(), recall)
    if tables is None:
        empty = "query_id long, rank int, vec_id long, score double"
        return vectors.sparkSession.createDataFrame([], empty)
    shared = vectors.sparkSession.sparkContext.broadcast(tables)
    groups = -(-index.count() // GROUP)

    def to_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for t, places in enumerate(shared.value.project(np.array(batch["vector"].tolist(), float))):
                cells = cell_keys(np.floor(places))
                yield batch.assign(tab=t, grp=cells % groups, cell=cells)

    def to_visits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for t, places in enumerate(shared.value.project(np.array(batch["vector"].tolist(), float))):
                for row, cells in zip(batch.itertuples(), cell_keys(shared.value.visits(places)[0]), strict=True):
                    cells = np.unique(cells)
                    of = cells % groups
                    seen = np.unique(of)
                    yield pd.DataFrame(
                        {
                            "id": row.id,
                            "vector": [row.vector] * len(seen),
                            "tab": t,
                            "grp": seen,
                            "cells": [cells[of == g] for g in seen],
                        }
                    )

    def nearest(found: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        """The k nearest of each query, among the vectors of the cells that it visits here or, without cells, all."""
        out = []
        if len(found) and len(asking):
            if "cell" in found:
                found = found.sort_values("cell")
                cell = found["cell"].to_numpy()
            x = np.array(found["vector"].tolist(), float)
            lists = found["ids"].to_numpy()
            at = np.arange(len(x))
            for row in asking.itertuples():
                if "cell" in found:
                    first, last = np.searchsorted(cell, row.cells), np.searchsorted(cell, row.cells, side="right")
                    some = np.flatnonzero(last > first)
                    if not len(some):
                        continue
                    at = np.concatenate([np.arange(first[i], last[i]) for i in some])
                out.append(closest(x[at], lists[at], row.id, np.asarray(row.vector, float), k))
        columns = zip(*out, strict=True) if out else ([np.zeros(0)],) * 3
        names = ("query_id", "vec_id", "score")
        return pd.DataFrame({n: np.concatenate(c) for n, c in zip(names, columns, strict=True)})

    result = "query_id long, vec_id long, score double"

    def merge(found: DataFrame) -> DataFrame:
        return stored(found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score")), "neighbours")

    merged, short = None, stored(asked, "asked")
    if tables.probes:
        cells = index.mapInPandas(to_cells, f"vector {kind}, ids array<long>, tab int, grp long, cell long")
        parts = F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias("parts")
        large = stored(cells.groupBy("tab", "grp", "cell").agg(parts).where("parts > 1"), "large-cells")
        members = cells.join(large, ["tab", "grp", "cell"], "left").withColumn(
            "part", F.pmod(F.xxhash64("vector"), F.coalesce("parts", F.lit(1))).cast("int")
        )
        most = large.groupBy("tab", "grp").agg(F.max("parts").alias("parts"))
        visits = asked.mapInPandas(to_visits, f"id long, vector {kind}, tab int, grp long, cells array<long>")
        every = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part")
        visits = visits.join(most, ["tab", "grp"], "left").select("id", "vector", "tab", "grp", "cells", every)
        keys = ["tab", "grp", "part"]
        merged = merge(members.groupBy(*keys).cogroup(visits.groupBy(*keys)).applyInPandas(nearest, result))
        # Queries for which the tables hold fewer than k are compared with all rows.
        full = merged.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= k)
        short = stored(short.join(full.select(F.col("query_id").alias("id")), "id", "left_anti"), "short")
    if merged is None or not short.isEmpty():
        # All pairs, a block of rows and a block of queries at a time.
        turns = max(-(-short.count() // GROUP), 1)
        turn = F.pmod(F.xxhash64("id", "vector"), F.lit(turns)).cast("int").alias("turn")
        grp = F.pmod(F.xxhash64("vector"), F.lit(groups)).cast("int").alias("grp")
        asking = short.select("id", "vector", turn, F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("grp"))
        whole = index.select("vector", "ids", grp, F.explode(F.sequence(F.lit(0), F.lit(turns - 1))).alias("turn"))
        blocks = whole.groupBy("grp", "turn").cogroup(asking.groupBy("grp", "turn"))
        more = merge(blocks.applyInPandas(nearest, result))
        ids = short.select(F.col("id").alias("query_id")).distinct()
        merged = merged.join(ids, "query_id", "left_anti").unionByName(more) if merged is not None else more
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return merged.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def closest(x: np.ndarray, lists: np.ndarray, query_id: int, point: np.ndarray, k: int) -> tuple:
    """(query_id, id, distance) of the k nearest of the vectors ``x``, which have the ids in ``lists``."""
    d = np.sqrt(((x - point) ** 2).sum(axis=1))
    if len(d) > k + 1:  # the query itself may be one of them
        near = d <= np.partition(d, k)[k]
        d, lists = d[near], lists[near]
    ids = np.concatenate(lists.tolist())
    d = np.repeat(d, [len(i) for i in lists])
    d, ids = d[ids != query_id], ids[ids != query_id]
    best = np.lexsort((ids, d))[:k]
    return np.full(len(best), query_id), ids[best], d[best]


def op7_pstable_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.where("vec_id % 100 = 0"))
