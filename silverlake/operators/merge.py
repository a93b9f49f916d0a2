"""Upsert by key as a DataFrame operator, with the checks around it.

Semantics: a source row replaces every target row with equal keys; a source row without a
match is added; a target row without a match stays. Keys compare with plain equality, so a
row with a null key never matches and is always kept (target) or added (source).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ON_DUPLICATE = ("latest", "error", "keep")


def keys_present(keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])


def keys_missing(keys: Sequence[str]) -> Column:
    return reduce(Column.__or__, [F.col(k).isNull() for k in keys])


def dedupe_latest(
    rows: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    keys_complete: bool = False,
    dealt_by: Sequence[str] = (),
) -> DataFrame:
    """One row per key: the greatest by ``order_by``, ties settled by the other columns.

    An aggregate rather than a window: a key with very many rows is reduced inside each map
    task and only one candidate per task is shuffled. Rows with a null key are all kept, by a
    second pass that ``keys_complete=True`` (no key is null) leaves out.

    ``dealt_by`` names columns that follow from the keys and by which the caller needs the rows dealt out
    over the tasks. The rows are then shuffled by these, once, and keys are reduced where they arrive.
    """
    _check_columns(rows, [*keys, *order_by, *dealt_by])
    keyed = rows if keys_complete else rows.where(keys_present(keys))
    if dealt_by:
        keyed = keyed.repartition(*dealt_by)
    given = [*keys, *[c for c in dealt_by if c not in keys]]
    picked = _latest_by_key(keyed, given, order_by)
    unpacked = picked.select(*[F.col(c) if c in given else F.col(f"__row.{c}") for c in rows.columns])
    return unpacked if keys_complete else unpacked.unionByName(rows.where(keys_missing(keys)))


def ambiguous_keys(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once in ``source`` and also in ``target``, with the count."""
    repeated = (
        source.where(keys_present(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("source_rows"))
        .where("source_rows > 1")
    )
    return repeated.join(target.select(*keys).distinct(), list(keys), "left_semi")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    on_duplicate: str = "latest",
    order_by: Sequence[str] = (),
    source_unique: bool = False,
    target_unique: bool = False,
    keys_complete: bool = False,
) -> DataFrame:
    """``target`` after merging ``source`` into it, with the columns of ``target``.

    ``on_duplicate`` settles several source rows with one key:

    - ``latest``: keep the greatest by ``order_by`` (source-only columns are allowed there);
    - ``error``: fail the job if such a key also exists in the target, else add every row;
    - ``keep``: add every row without a match; a match takes the greatest row.

    What the caller knows about the data picks the plan, never the result: ``source_unique`` (as
    after ``dedupe_latest``) leaves out the aggregate by key, and ``target_unique`` (a table
    loaded with ``latest``) rules out hot keys, so one full outer join does it, with a shuffle of
    each side. Otherwise target rows are updated in a left join, whose large partitions Spark may
    split, and new rows are found against the target's distinct keys. ``keys_complete`` (no source key is null)
    leaves out the source's second reading for such rows.
    """
    if on_duplicate not in ON_DUPLICATE:
        raise ValueError(f"on_duplicate must be one of {ON_DUPLICATE}, not {on_duplicate!r}")
    keys, columns = list(keys), target.columns
    _check_columns(target, keys)
    _check_columns(source, [*columns, *order_by])

    keyed = source.where(keys_present(keys)).select(*dict.fromkeys([*columns, *order_by]))
    incoming = _as_latest(keyed, keys) if source_unique else _latest_by_key(keyed, keys, order_by)
    one_per_key = source_unique or on_duplicate == "latest"
    old = target.where(keys_present(keys))
    keyless = [target] if keys_complete else [target, source]
    unmatched = [side.where(keys_missing(keys)).select(*columns) for side in keyless]

    if one_per_key and target_unique:
        merged = _take_new(old.join(incoming, keys, "full_outer"), keys, columns)
        return reduce(DataFrame.unionByName, [merged, *unmatched])

    updated = old.join(incoming, keys, "left")
    if on_duplicate == "error" and not source_unique:
        failure = F.raise_error(F.lit(f"several source rows for one {keys}")).cast("boolean")
        updated = updated.where(F.when(F.col("__copies") > 1, failure).otherwise(F.lit(True)))
    updated = _take_new(updated, keys, columns)
    known = old.select(*keys).distinct()  # combined in the map tasks
    if one_per_key:
        added = _take_new(incoming.join(known, keys, "left_anti"), keys, columns, always=True)
    else:
        added = keyed.join(known, keys, "left_anti").select(*columns)
    return reduce(DataFrame.unionByName, [updated, added, *unmatched])


def _take_new(
    joined: DataFrame, keys: Sequence[str], columns: Sequence[str], always: bool = False
) -> DataFrame:
    """The columns from ``__row`` where it is present (or always), else the target's own."""
    new = F.col("__row").isNotNull()

    def pick(c: str) -> Column:
        if c in keys:
            return F.col(c)
        if always:
            return F.col(f"__row.{c}")
        return F.when(new, F.col(f"__row.{c}")).otherwise(F.col(c)).alias(c)

    return joined.select(*[pick(c) for c in columns])


def _latest_by_key(rows: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """``keys``, ``__row`` (struct of the greatest row, never null) and ``__copies``."""
    ranked = [c for c in order_by if c not in keys]
    row = F.max(_row_struct([*ranked, *[c for c in rows.columns if c not in keys and c not in ranked]]))
    return rows.groupBy(*keys).agg(row.alias("__row"), F.count(F.lit(1)).alias("__copies"))


def _as_latest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same columns for rows that are already one per key."""
    row = _row_struct([c for c in rows.columns if c not in keys])
    return rows.select(*keys, row.alias("__row"), F.lit(1).alias("__copies"))


def _row_struct(columns: Sequence[str]) -> Column:
    # The flag keeps the struct from being empty when every column is a key.
    return F.struct(*columns, F.lit(True).alias("__hit"))


def _check_columns(rows: DataFrame, wanted: Sequence[str]) -> None:
    if missing := [c for c in wanted if c not in rows.columns]:
        raise ValueError(f"columns {missing} are missing from {rows.columns}")
