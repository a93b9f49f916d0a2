"""Silver tables bucketed by their merge key, so that a merge moves the source and not the table.

A table of the session's catalog, in Parquet, whose rows lie in files by a hash of the key. The join of a
merge takes the target as it lies and shuffles the source to it, and each task writes one bucket of the new
table, which then takes the old one's name. Every merge writes the whole table, so this is for loads that touch
most of it; ``silverlake.sources.silver`` rewrites only the partitions that a load touches.

A job that fails leaves the table as it was. One that dies between the two renames leaves the finished new
table under ``<table>__next``, and the next merge goes on from there. A table takes one writer at a time.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from silverlake.operators.merge import ON_DUPLICATE, dedupe_latest, upsert
from silverlake.plans.specs import TableSpec

NEXT = "__next"


def merge_into_bucketed(
    source: DataFrame,
    table: str,
    spec: TableSpec,
    root: str,
    *,
    buckets: int | None = None,
    on_duplicate: str = "latest",
    order_by: Sequence[str] = (),
    keys_complete: bool = False,
) -> None:
    """Create ``table`` (its files below ``root``) from ``source``, or merge into it; the rules are ``upsert``'s.

    The number of ``buckets`` is set at the first load, as a rule to the session's shuffle partitions: as long as
    the two agree, the shuffle that finds the latest row of each key also serves the join.
    """
    if on_duplicate not in ON_DUPLICATE:
        raise ValueError(f"on_duplicate must be one of {ON_DUPLICATE}, not {on_duplicate!r}")
    spark = source.sparkSession
    _finish(spark, table)
    if on_duplicate == "latest":
        source = dedupe_latest(source, spec.keys, order_by, keys_complete)
    source = source.select(*spec.schema.fieldNames())
    if not spark.catalog.tableExists(table):
        number = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        _write(source.repartition(number, *spec.keys), table, spec, root, number)
        return
    number = bucket_count(spark, table, spec)
    if buckets not in (None, number):
        raise ValueError(f"table {table!r} has {number} buckets, not {buckets}")
    _write(merged(source, table, spec, on_duplicate, keys_complete), f"{table}{NEXT}", spec, root, number)
    _finish(spark, table, replace=True)


def merged(
    source: DataFrame, table: str, spec: TableSpec, on_duplicate: str = "latest", keys_complete: bool = False
) -> DataFrame:
    """The table after the merge. ``latest`` takes a source with one row for each key."""
    unique = on_duplicate == "latest"
    target = source.sparkSession.table(table)
    return upsert(
        target,
        source,
        spec.keys,
        on_duplicate=on_duplicate,
        source_unique=unique,
        target_unique=unique,
        keys_complete=keys_complete,
    )


def bucket_count(spark: SparkSession, table: str, spec: TableSpec) -> int:
    """The table's number of buckets; an error if they are not by the merge key."""
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    columns = re.findall(r"`([^`]*)`", described.get("Bucket Columns", ""))
    if columns != list(spec.keys):
        raise ValueError(f"table {table!r} is bucketed by {columns}, not by {list(spec.keys)}")
    return int(described["Num Buckets"])


def _write(rows: DataFrame, table: str, spec: TableSpec, root: str, buckets: int) -> None:
    writer = rows.write.format("parquet").bucketBy(buckets, *spec.keys).sortBy(*spec.keys)
    # The catalog has the table only when all its files are written.
    writer.option("path", f"{root}/{spec.name}-{uuid4().hex}").saveAsTable(table)


def _finish(spark: SparkSession, table: str, replace: bool = False) -> None:
    """Give a finished new table its name. The files of the one before it stay until a retention job takes them."""
    if not spark.catalog.tableExists(f"{table}{NEXT}"):
        return
    if spark.catalog.tableExists(table):
        if not replace:
            # Written by a merge that died before its renames: that load will come again.
            spark.sql(f"DROP TABLE {table}{NEXT}")
            return
        spark.sql(f"DROP TABLE {table}")
    spark.sql(f"ALTER TABLE {table}{NEXT} RENAME TO {table}")
