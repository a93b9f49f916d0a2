"""Bronze rows -> rows of one silver table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from silverlake.functions import LIST_FAULTS, convert, element_rows, fill_key, list_faults, parse_list, was_lost
from silverlake.operators.merge import keys_missing
from silverlake.plans.specs import TableSpec

def transform(
    bronze: DataFrame, spec: TableSpec, keep: Sequence[str] = (), counts: Observation | None = None
) -> DataFrame:
    """Rows of table ``spec``, plus the bronze columns named in ``keep`` at the end.

    One projection (flat) or one projection and one generator (nested): no shuffle, and only
    the columns the table needs are read from bronze. ``counts`` observes, in the pass that writes the rows,
    ``rows_in`` and for each way to lose a value how often it did (see ``loss_names``).
    """
    columns = [convert(source, kind).alias(out) for out, source, kind in spec.columns]
    lost, rows_in = _cast_losses(spec), F.count(F.lit(1)).alias("rows_in")
    if not spec.nested:
        if counts:
            bronze = bronze.observe(counts, rows_in, *[F.count_if(c).alias(n) for n, c in lost.items()])
        return bronze.select(*columns, *keep)
    if not counts:
        rows = bronze.select(*columns, *keep, element_rows(spec.list_column, spec.element))
    else:
        # The list is parsed once, for its rows and for its faults.
        parsed = bronze.select("*", parse_list(spec.list_column, spec.element).alias("__list"))
        faults = list_faults(spec.list_column, F.col("__list"), spec.element).alias("__faults")
        seen = parsed.select(*columns, *keep, "__list", faults, *[c.alias(f"__lost_{n}") for n, c in lost.items()])
        seen = seen.observe(
            counts,
            rows_in,
            *[F.count_if(F.col(f"__lost_{n}")).alias(n) for n in lost],
            *[F.sum(F.col("__faults")[fault]).alias(fault) for fault in LIST_FAULTS],
        )
        names = [out for out, _, _ in spec.columns]
        rows = seen.select(*names, *keep, F.inline_outer("__list"))
    key, value = spec.sentinel or (None, None)
    filled = [fill_key(c, value) if c == key else F.col(c) for c in spec.schema.fieldNames()]
    return rows.select(*filled, *keep)


def loss_names(spec: TableSpec) -> list[str]:
    """Columns that are cast, and for a nested table the faults of its lists."""
    return [*_cast_losses(spec), *(LIST_FAULTS if spec.nested else ())]


def _cast_losses(spec: TableSpec) -> dict[str, Column]:
    return {out: was_lost(source, kind) for out, source, kind in spec.columns if kind != "string"}


def keys_complete(bronze: DataFrame, spec: TableSpec) -> bool:
    """True if no row of ``transform(bronze, spec)`` can have a null key.

    A filter on the raw columns, which Parquet statistics answer without reading data.
    """
    sources = spec.key_sources
    return sources is not None and (not sources or bronze.where(keys_missing(sources)).count() == 0)


def lost_values(bronze: DataFrame, spec: TableSpec) -> DataFrame:
    """``(column, present, lost)``: values per cast column, and how many become NULL."""
    casts = [(out, source, kind) for out, source, kind in spec.columns if kind != "string"]
    if not casts:
        return bronze.sparkSession.createDataFrame([], "column string, present long, lost long")
    counts = bronze.agg(
        *[
            F.struct(
                F.lit(out).alias("column"),
                F.count(source).alias("present"),
                F.count_if(was_lost(source, kind)).alias("lost"),
            ).alias(out)
            for out, source, kind in casts
        ]
    )
    return counts.select(F.inline(F.array(*[out for out, _, _ in casts])))


def list_losses(bronze: DataFrame, spec: TableSpec) -> DataFrame:
    """One row for the list column of a nested table: ``(column, present, unreadable, not_a_list, bad_elements)``."""
    if not spec.nested:
        raise ValueError(f"{spec.name} has no list")
    parsed = bronze.select(spec.list_column, parse_list(spec.list_column, spec.element).alias("__list"))
    faults = list_faults(spec.list_column, F.col("__list"), spec.element).alias("__faults")
    return parsed.select(F.col(spec.list_column).alias("__text"), faults).agg(
        F.lit(spec.list_column).alias("column"),
        F.count("__text").alias("present"),
        *[F.coalesce(F.sum(F.col("__faults")[fault]), F.lit(0)).alias(fault) for fault in LIST_FAULTS],
    )
