"""What each silver table looks like and how it is derived from bronze. Data only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    DataType,
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    StringType,
    StructType,
)

TYPES: dict[str, DataType] = {
    "string": StringType(),
    "int": IntegerType(),
    "float": FloatType(),
    "double": DoubleType(),
    "date": DateType(),
}


@dataclass(frozen=True)
class TableSpec:
    """One silver table.

    ``columns`` are ``(silver name, bronze name, type)``. A *flat* table has only those. A
    *nested* table also has ``list_column``, a JSON-text list in bronze, whose ``element``
    fields (DDL) follow ``columns``; ``sentinel`` is ``(key field, value for null)``.

    Stored rows are partitioned by the first key: whole numbers by ranges of ``part_width``, other
    keys by hash into ``part_hashes``. Choose them so that a partition has some hundred megabytes, and
    keep them for the life of the table.
    """

    name: str
    prefix: str
    keys: tuple[str, ...]
    columns: tuple[tuple[str, str, str], ...]
    list_column: str | None = None
    element: str = ""
    sentinel: tuple[str, str | int] | None = None
    part_width: int = 100_000
    part_hashes: int = 16

    def __post_init__(self) -> None:
        names = self.schema.fieldNames()
        if len(set(names)) != len(names):
            raise ValueError(f"{self.name}: repeated column in {names}")
        if missing := [key for key in self.keys if key not in names]:
            raise ValueError(f"{self.name}: keys {missing} are not columns")
        if not self.keys:
            raise ValueError(f"{self.name}: at least one key is needed")
        if self.part_width < 1 or self.part_hashes < 1:
            raise ValueError(f"{self.name}: part_width and part_hashes must be positive")
        if "silver_part" in [n.lower() for n in names]:
            raise ValueError(f"{self.name}: the column name 'silver_part' is taken by the partitions")
        if self.sentinel:
            field, value = self.sentinel
            if field not in names:
                raise ValueError(f"{self.name}: sentinel column {field!r} is not a column")
            kind = self.schema[field].dataType.simpleString()
            if kind != ("int" if isinstance(value, int) else "string"):
                raise ValueError(f"{self.name}: sentinel {value!r} does not fit {field} {kind}")

    @property
    def nested(self) -> bool:
        return self.list_column is not None

    @property
    def schema(self) -> StructType:
        fields = [(out, kind) for out, _, kind in self.columns]
        if self.nested:
            fields += [tuple(field.split()) for field in self.element.split(",")]
        if unknown := {kind for _, kind in fields} - set(TYPES):
            raise ValueError(f"{self.name}: unknown types {sorted(unknown)}; known: {sorted(TYPES)}")
        schema = StructType()
        for name, kind in fields:
            schema.add(name, TYPES[kind])
        return schema

    @property
    def key_sources(self) -> list[str] | None:
        """The bronze columns that decide whether a key is null, or None if others do too.

        A cast to string loses nothing and a sentinel fills its key, so only they qualify.
        """
        kinds = {out: (source, kind) for out, source, kind in self.columns}
        filled = {self.sentinel[0]} if self.sentinel else set()
        plain = [kinds.get(key, (None, None)) for key in self.keys if key not in filled]
        return [source for source, _ in plain] if all(kind == "string" for _, kind in plain) else None

    @property
    def bronze_columns(self) -> list[str]:
        return [source for _, source, _ in self.columns] + ([self.list_column] if self.nested else [])


# Names, fields, types, merge keys and null-key sentinels of the eight tables.
CAST_FIELDS = (
    "cast_id int, character string, credit_id string, gender int, id int, name string"
)
CREW_FIELDS = (
    "credit_id string, department string, gender int, id int, job string, name string"
)
NAMED_ID_FIELDS = "id int, name string"
COUNTRY_FIELDS = "iso_3166_1 string, name string"
LANGUAGE_FIELDS = "iso_639_1 string, name string"
NO_CREDIT = "0000000000"
NO_ID = -9999
NO_CODE = "XX"
MOVIE_COLUMNS = (
    ("movie_id", "id", "string"),
    ("title", "title", "string"),
    ("budget", "budget", "double"),
    ("homepage", "homepage", "string"),
    ("original_language", "original_language", "string"),
    ("original_title", "original_title", "string"),
    ("overview", "overview", "string"),
    ("popularity", "popularity", "float"),
    ("release_date", "release_date", "date"),
    ("revenue", "revenue", "double"),
    ("runtime", "runtime", "int"),
    ("status", "status", "string"),
    ("tagline", "tagline", "string"),
    ("vote_average", "vote_average", "float"),
    ("vote_count", "vote_count", "int"),
)


def _credits(name: str, fields: str) -> TableSpec:
    return TableSpec(
        name=name,
        prefix="credits",
        keys=("movie_id", "credit_id"),
        columns=(("movie_id", "movie_id", "string"), ("title", "title", "string")),
        list_column=name,
        element=fields,
        sentinel=("credit_id", NO_CREDIT),
    )


def _movie_list(name: str, fields: str, key: str, sentinel: str | int) -> TableSpec:
    return TableSpec(
        name=name,
        prefix="movies",
        keys=("movie_id", key),
        columns=(("movie_id", "id", "string"),),
        list_column=name,
        element=fields,
        sentinel=(key, sentinel),
    )


MOVIE_TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        _credits("cast", CAST_FIELDS),
        _credits("crew", CREW_FIELDS),
        TableSpec(name="movies", prefix="movies", keys=("movie_id",), columns=MOVIE_COLUMNS),
        _movie_list("genres", NAMED_ID_FIELDS, "id", NO_ID),
        _movie_list("keywords", NAMED_ID_FIELDS, "id", NO_ID),
        _movie_list("production_companies", NAMED_ID_FIELDS, "id", NO_ID),
        _movie_list("production_countries", COUNTRY_FIELDS, "iso_3166_1", NO_CODE),
        _movie_list("spoken_languages", LANGUAGE_FIELDS, "iso_639_1", NO_CODE),
    )
}


def find(name: str, tables: dict[str, TableSpec] = MOVIE_TABLES) -> TableSpec:
    try:
        return tables[name]
    except KeyError:
        raise ValueError(f"unknown table {name!r}; known: {sorted(tables)}") from None


def prefixes(tables: dict[str, TableSpec] = MOVIE_TABLES) -> list[str]:
    return sorted({spec.prefix for spec in tables.values()})
