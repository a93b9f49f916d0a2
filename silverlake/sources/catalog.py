"""The same merge into a catalog table whose format has its own MERGE.

Plain Parquet has none: use ``silverlake.sources.silver`` for it. With a table format on the
cluster this hands the merge to it, through Spark's own API.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlake.operators.merge import ON_DUPLICATE, ambiguous_keys, dedupe_latest
from silverlake.plans.specs import TableSpec


def merge_into_catalog(
    source: DataFrame,
    table: str,
    spec: TableSpec,
    *,
    on_duplicate: str = "latest",
    order_by: Sequence[str] = (),
    keys_complete: bool = False,
) -> None:
    """Create ``table`` from ``source``, or update matching rows and insert the others.

    ``on_duplicate`` as in ``upsert``, but a MERGE takes one source row for each key: ``latest``
    picks it, while ``error`` and ``keep`` fail if several meet a row of the table.
    """
    if on_duplicate not in ON_DUPLICATE:
        raise ValueError(f"on_duplicate must be one of {ON_DUPLICATE}, not {on_duplicate!r}")
    spark = source.sparkSession
    if on_duplicate == "latest":
        source = dedupe_latest(source, spec.keys, order_by, keys_complete)
    source = source.select(*spec.schema.fieldNames())
    if not spark.catalog.tableExists(table):
        source.writeTo(table).create()
        return
    if on_duplicate != "latest" and not ambiguous_keys(spark.table(table), source, spec.keys).isEmpty():
        raise ValueError(f"several source rows for one {list(spec.keys)}")
    merge_plan(source, table, spec).merge()


def merge_plan(source: DataFrame, table: str, spec: TableSpec):
    """The MERGE before it runs: equal keys update all columns, new keys insert all."""
    same = [F.col(f"{table}.{key}") == F.col(f"new.{key}") for key in spec.keys]
    merge = source.alias("new").mergeInto(table, reduce(Column.__and__, same))
    return merge.whenMatched().updateAll().whenNotMatched().insertAll()
