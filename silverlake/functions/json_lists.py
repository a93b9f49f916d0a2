"""Lists of records held as JSON text in a string column.

What a list loses on its way to rows is told by ``list_faults``; a list of records whose fields are not
known beforehand is opened by ``open_elements``.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_list(name: str, element: str) -> Column:
    """JSON text -> array of structs. ``element`` is DDL such as ``"id int, name string"``.

    Only the declared fields are parsed, so leave out the ones that are not needed: Spark
    does not prune the schema of ``from_json`` below a generator.
    """
    return F.from_json(F.col(name), f"array<struct<{_struct_fields(element)}>>")


def element_rows(name: str, element: str) -> Column:
    """Generator: one row per list element, with the element's fields as columns.

    A null, empty or unreadable list gives one row of nulls, so no parent is lost.
    """
    return F.inline_outer(parse_list(name, element))


def list_faults(name: str, parsed: Column, element: str) -> Column:
    """What of the list in column ``name`` did not reach ``parsed``, as a struct of three counts.

    - ``unreadable``: 1 for a text that is no JSON and gave nothing;
    - ``not_a_list``: 1 for JSON that is no array: a single record is read as a list of one, anything
      else gives nothing. A null, blank or JSON null is a list that is not there, no fault;
    - ``bad_elements``: elements that are no record, or of which a declared field has a value that
      does not fit and became null.

    A list whose elements have all the fields that its text names is not looked at again; only the others
    are parsed a second time, as variants.
    """
    fields = [field.split()[0] for field in element.split(",")]
    text = F.col(name)
    written = text.rlike(r"\S")
    complete = ~F.exists(parsed, lambda e: _any([e.isNull(), *[e[f].isNull() for f in fields]]))
    complete = F.when(complete, True).otherwise(_nothing_unread(text, parsed, fields))
    # Null for what is no JSON to the variant parser: such a list may still have been read (single quotes).
    variant = F.try_parse_json(text)
    items = F.coalesce(F.try_variant_get(variant, "$", "array<variant>"), F.array(variant))

    def bad(item: Column, read: Column) -> Column:
        there = lambda f: F.try_variant_get(item, f"$.{f}", "variant")
        lost = [there(f).isNotNull() & ~F.is_variant_null(there(f)) & read[f].isNull() for f in fields]
        no_record = read.isNull() | ~F.schema_of_variant(item).startswith("OBJECT")
        return ~F.is_variant_null(item) & (no_record | _any(lost))

    read = F.coalesce(parsed, F.array().cast(f"array<struct<{_struct_fields(element)}>>"))
    marked = F.zip_with(items, read, lambda item, e: item.isNotNull() & bad(item, e))
    array = F.schema_of_variant(variant).startswith("ARRAY")
    single = F.schema_of_variant(variant).startswith("OBJECT")
    found = F.struct(
        (variant.isNull() & parsed.isNull()).cast("int").alias("unreadable"),
        (variant.isNotNull() & ~array & ~F.is_variant_null(variant)).cast("int").alias("not_a_list"),
        F.when(array | single, F.size(F.filter(marked, lambda m: m))).otherwise(0).alias("bad_elements"),
    )
    nothing = F.struct(*[F.lit(0).alias(fault) for fault in LIST_FAULTS])
    return F.when(written & F.coalesce(~complete, F.lit(True)), found).otherwise(nothing)


def _nothing_unread(text: Column, parsed: Column, fields: Sequence[str]) -> Column:
    """True where the text names fields only as often as they were read, so the null ones are not there.

    A name with an escape in it would not be found, so texts with such escapes are left to the variants, as are
    elements without any value, which may be no records, and what does not begin as a list.
    """
    records = ~F.exists(parsed, lambda e: reduce(Column.__and__, [e[f].isNull() for f in fields]))
    plain = text.rlike(r"^\s*\[") & ~text.contains("\\u") & ~text.contains("\\/")
    there = lambda e: reduce(Column.__add__, [e[f].isNotNull().cast("int") for f in fields])
    read = F.aggregate(parsed, F.lit(0), lambda n, e: n + there(e))
    named = F.regexp_count(text, F.lit(f'"({"|".join(re.escape(f) for f in fields)})"'))
    return plain & records & (named == read)


LIST_FAULTS = ("unreadable", "not_a_list", "bad_elements")


def open_elements(rows: DataFrame, name: str, fields: Mapping[str, tuple[str, str]], rest: str | None = None) -> DataFrame:
    """One row per element of the list in column ``name``, for records whose fields are not declared.

    ``fields`` names output columns by path and type, as ``{"id": ("$.id", "int")}``; a value that does
    not fit is null. ``rest`` names a column for the whole element as JSON text. The list is parsed
    once, as a variant, and opened by a lateral join, so fields can be added without another parse. A null,
    empty or unreadable list, and one that is no list, gives one row of nulls; a single record is a list
    of one. Unlike ``element_rows``, numbers in quotes and fractions are cast, an element that is no record costs
    only itself, and a record with one key twice or in single quotes makes the text unreadable.
    """
    taken = {c.lower() for c in rows.columns}
    if clash := [c for c in [*fields, *([rest] if rest else [])] if c.lower() in taken]:
        raise ValueError(f"columns {clash} are there already")
    parsed = rows.withColumn("__parsed", F.try_parse_json(F.col(name)))
    kind = F.schema_of_variant("__parsed")
    alone = F.try_parse_json(F.concat(F.lit("["), F.col(name), F.lit("]")))
    found = F.when(kind.startswith("ARRAY"), F.col("__parsed")).when(kind.startswith("OBJECT"), alone)
    opened = parsed.select(*[F.col(f"`{c}`") for c in rows.columns], found.alias("__list"))
    each = opened.lateralJoin(
        rows.sparkSession.tvf.variant_explode_outer(F.col("__list").outer()).select(F.col("value").alias("__element"))
    )
    values = [F.try_variant_get("__element", path, kind).alias(out) for out, (path, kind) in fields.items()]
    whole = [F.to_json("__element").alias(rest)] if rest else []
    return each.select(*rows.columns, *values, *whole)


def _any(tests: Sequence[Column]) -> Column:
    return reduce(Column.__or__, tests)


def fill_key(name: str, sentinel: str | int) -> Column:
    """The key column with nulls replaced, so that it can match under plain equality."""
    return F.coalesce(F.col(name), F.lit(sentinel)).alias(name)


def _struct_fields(element: str) -> str:
    fields = [field.split() for field in element.split(",")]
    return ",".join(f"`{name}`:{kind}" for name, kind in fields)
