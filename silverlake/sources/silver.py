"""Silver tables as plain Parquet, partitioned by ranges of the merge key.

    <root>/<table>/silver_part=n<width>-<i>/*.parquet     whole-number keys from i * width on
    <root>/<table>/silver_part=h<hashes>-<i>/*.parquet    other keys, by hash
    <root>/<table>/silver_part=null-<load>/*.parquet      rows of one load with a null key, which match nothing

The partition of a row follows from its first key and the table's spec alone, so nothing else is kept
about a table. A merge reads the partitions that its source falls into, by dynamic partition pruning, and
replaces these by dynamic partition overwrite; the others are not touched. A load goes to a staging folder
below the table first, and its partitions are moved into place at the end. A job that fails before
that leaves the table as it was; one that dies while moving leaves some partitions old and some new, and the
partition then being moved may be found in the staging folder only. The same load run again puts
all of them right, as a merge applied twice changes nothing.

A table takes one writer at a time, and a reader should not run while partitions are moved. Where the
cluster has a table format with its own MERGE, ``silverlake.sources.catalog`` hands the work to it instead.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from silverlake.functions import convert
from silverlake.operators.merge import ON_DUPLICATE, dedupe_latest, keys_missing, upsert
from silverlake.operators.packed import comparable, deal_out, first_of_each, packable
from silverlake.plans.specs import MOVIE_TABLES, TableSpec
from silverlake.sources.scratch import path_exists, staged

PART = "silver_part"
# Greater than every partition of rows with keys, and not greater than those of rows without.
KEYLESS = "null-"
# A first load deals each partition out over so many tasks, by the whole key.
SLICE, SLICES = "__slice", 8
# Bytes of bronze objects for each task of a first load.
PER_TASK = 16 << 20


def part_of(spec: TableSpec, load: str) -> Column:
    """The partition of a row; ``load`` names the partition of the rows whose key is null."""
    number, by_hash = _part_numbers(F.col(spec.keys[0]), spec)
    return (
        F.when(keys_missing(spec.keys), F.lit(KEYLESS + load))
        .when(number.isNotNull(), F.concat(F.lit(f"n{spec.part_width}-"), number.cast("string")))
        .otherwise(F.concat(F.lit(f"h{spec.part_hashes}-"), by_hash.cast("string")))
        .alias(PART)
    )


def _part_numbers(first_key: Column, spec: TableSpec) -> tuple[Column, Column]:
    """The number of a key's range, null for a key that is no whole number, and of its hash."""
    first = first_key.cast("string")
    number = F.floor(first.try_cast("bigint") / F.lit(spec.part_width))
    return number, F.pmod(F.xxhash64(first), F.lit(spec.part_hashes))


def dealt_by_key(bronze: DataFrame, spec: TableSpec, size: int, keep: Sequence[str] = ()) -> DataFrame | None:
    """The bronze columns of the table and ``keep``, rows of equal keys in one task, for a first load.

    ``size`` is that of the bronze objects in bytes and sets the number of tasks. Lists travel as their text, packed, which
    is a fraction of what their elements take; so tasks go by those keys that are bronze columns. None if the
    first key is not, or if a type would not come through as it is.
    """
    rows = bronze.select(*dict.fromkeys([*spec.bronze_columns, *keep]))
    keys = [out for out, _, _ in spec.columns if out in spec.keys]
    if spec.keys[0] not in keys or not packable(rows.schema) or not all(comparable(spec.schema[k].dataType) for k in spec.keys):
        return None
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-size // PER_TASK))
    key, value = spec.sentinel if spec.nested and spec.sentinel else (None, None)
    known = {out: convert(source, kind) for out, source, kind in spec.columns if out in keys}
    known = {out: F.coalesce(c, F.lit(value)) if out == key else c for out, c in known.items()}
    number, by_hash = _part_numbers(known[spec.keys[0]], spec)
    part = F.pmod(F.coalesce(number, by_hash), F.lit(tasks))
    to = F.pmod(part * F.lit(SLICES) + F.pmod(F.xxhash64(*known.values()), F.lit(SLICES)), F.lit(tasks))
    # Rows without a key match nothing, so they may go anywhere.
    anywhere = F.pmod(F.xxhash64(*rows.columns), F.lit(tasks))
    complete = reduce(Column.__and__, [c.isNotNull() for c in known.values()])
    return deal_out(rows, F.when(complete, to).otherwise(anywhere), tasks)


def table_exists(spark: SparkSession, root: str, table: str) -> bool:
    return path_exists(spark, f"{root}/{table}")


def read_silver(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame:
    """The table's current rows."""
    if not table_exists(spark, root, spec.name):
        raise ValueError(f"silver table {spec.name!r} does not exist under {root}")
    return _parts(spark, root, spec).drop(PART)


def register_views(
    spark: SparkSession, root: str, specs: Iterable[TableSpec] = MOVIE_TABLES.values()
) -> list[str]:
    """Temporary views for SQL over the tables that exist; returns their names."""
    names = []
    for spec in specs:
        if table_exists(spark, root, spec.name):
            read_silver(spark, root, spec).createOrReplaceTempView(spec.name)
            names.append(spec.name)
    return names


def upsert_table(
    source: DataFrame,
    root: str,
    spec: TableSpec,
    *,
    on_duplicate: str = "latest",
    order_by: Sequence[str] = (),
    keys_complete: bool = False,
    load: str | None = None,
    dealt: bool = False,
) -> int:
    """Merge ``source`` into the table, or create it; returns the number of rows written.

    ``order_by`` may name source columns beyond the table's: they rank duplicates and are not
    stored. ``keys_complete`` says that no source key is null. A load that is repeated under the same
    name ``load`` replaces its rows without a key; without a name they are added. ``dealt`` says of a first load with
    ``latest`` that rows of equal keys are in one task, see ``dealt_by_key``; then nothing is shuffled here.
    """
    if on_duplicate not in ON_DUPLICATE:
        raise ValueError(f"on_duplicate must be one of {ON_DUPLICATE}, not {on_duplicate!r}")
    spark, unique = source.sparkSession, on_duplicate == "latest"
    names, part = spec.schema.fieldNames(), part_of(spec, load or uuid4().hex)
    if not table_exists(spark, root, spec.name):
        if not unique:
            return _replace(source.select(*names, part), root, spec)
        if dealt:
            rank = [*order_by, *[c for c in source.columns if c not in spec.keys and c not in order_by]]
            newest = first_of_each(source, list(spec.keys), [F.desc(c) for c in rank])
            return _replace(newest.select(*names, part), root, spec, dealt=True)
        # The shuffle that brings the rows of a key together also deals them out by partition.
        source = source.select("*", part, _slice_of(spec))
        source = dedupe_latest(source, spec.keys, order_by, keys_complete, dealt_by=[PART, SLICE])
        return _replace(source.select(*names, PART), root, spec, dealt=True)
    if unique:
        source = dedupe_latest(source, spec.keys, order_by, keys_complete)
    source = source.select(*names, part)
    parts = _parts(spark, root, spec)
    _check_layout(parts, spec)
    # Read twice: for the partitions that it touches, and for the merge.
    source = staged(source, f"{spec.name}-source")
    touched = source.where(F.col(PART) < KEYLESS).select(PART).distinct()
    # One short text for each partition of the table that is touched, as many as it has at most.
    target = parts.join(F.broadcast(touched), PART, "left_semi")
    merged = upsert(
        target,
        source,
        [PART, *spec.keys],
        on_duplicate=on_duplicate,
        source_unique=unique,
        # A full join also updates every copy where an earlier load kept several rows of one key.
        target_unique=unique,
        keys_complete=keys_complete,
    )
    return _replace(merged, root, spec)


def _parts(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame:
    return spark.read.schema(spec.schema.add(PART, "string")).parquet(f"{root}/{spec.name}")


def _check_layout(parts: DataFrame, spec: TableSpec) -> None:
    """A key must be looked for where earlier loads put it; files are opened only if there is another layout."""
    ours = [F.col(PART).startswith(p) for p in (f"n{spec.part_width}-", f"h{spec.part_hashes}-", KEYLESS)]
    if other := parts.where(~(ours[0] | ours[1] | ours[2])).select(PART).first():
        raise ValueError(f"table {spec.name!r} was loaded with another part_width or part_hashes, see {other[0]!r}")


def _slice_of(spec: TableSpec) -> Column:
    return F.pmod(F.xxhash64(*spec.keys), F.lit(SLICES)).alias(SLICE)


def _replace(rows: DataFrame, root: str, spec: TableSpec, dealt: bool = False) -> int:
    """Write the rows' partitions anew, each row once; returns the number of rows.

    Rows are dealt out by partition, if that is not done yet; a partition of many rows is split over several
    tasks and files.
    """
    written = Observation()
    rows = rows if dealt else rows.hint("rebalance", PART)
    rows = rows.observe(written, F.count(F.lit(1)).alias("rows"))
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
    writer.partitionBy(PART).parquet(f"{root}/{spec.name}")
    return observed(written).get("rows", 0)


RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Within, the files of a write's shuffles go when it ends, and not when the driver next collects its garbage."""
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.unset(RELEASE) if before is None else spark.conf.set(RELEASE, before)


def observed(counts: Observation) -> dict:
    """What was counted. Nothing, if a shuffle turned out to be empty and Spark left the rest of the plan out."""
    try:
        return counts.get
    except Py4JJavaError:
        return {}
