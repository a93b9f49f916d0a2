"""Bronze objects: ``<root>/<prefix>/<prefix>_part_<YYYYMMDD-HHMMSS>...`` in Parquet."""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyarrow.fs import FileSystem, LocalFileSystem
from pyarrow.parquet import read_schema
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

OBJECT_KEY = "object_key"
SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"

# The three outcomes of the check for a day's objects.
ENOUGH = "enough_file"
NOT_ENOUGH = "not_enough_file"
UNREACHABLE = "http_request_error"


def object_key(path: Column, root: str, encoded: bool = True) -> Column:
    """What an object's path has below the root, so the root cannot match a day.

    The root is taken off once, from the left. ``_metadata.file_path`` is percent-encoded, the
    ``path`` of ``binaryFile`` is not.
    """
    if encoded:
        path = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    inside = re.sub(SCHEME, "", root).rstrip("/")
    return F.substring(F.regexp_replace(path, SCHEME, ""), len(inside) + 2, 1 << 20)


def inventory(
    spark: SparkSession, root: str, prefixes: Sequence[str], pattern: str | None = None
) -> DataFrame:
    """``(prefix, object_key, path, bytes, modified)`` of every object; contents are not read.

    A prefix folder that does not exist counts as empty; a missing root is an error. ``pattern``
    narrows the listing to names below the prefix, as ``*20221104*``; without it everything
    below the root is listed.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern is None:
        objects = reader.load(root)
    else:
        found = [o for o in (_listed(reader, f"{root}/{p}/{pattern}") for p in prefixes) if o is not None]
        objects = reduce(DataFrame.unionAll, found) if found else reader.load(root).limit(0)
    key = object_key(F.col("path"), root, encoded=False)
    return objects.select(
        F.substring_index(key, "/", 1).alias("prefix"),
        key.alias(OBJECT_KEY),
        "path",
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modified"),
    ).where(F.col("prefix").isin(list(prefixes)))


def _listed(reader, path: str) -> DataFrame | None:
    try:
        return reader.load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def day_objects(
    spark: SparkSession, root: str, prefix: str, day: str | int, pattern: str | None = None
) -> list[str]:
    """The paths of the prefix's objects whose key names ``day``; as many as landed that day."""
    return list(day_sizes(spark, root, prefix, day, pattern))


def day_sizes(
    spark: SparkSession, root: str, prefix: str, day: str | int, pattern: str | None = None
) -> dict[str, int]:
    """The same paths in order, with their bytes."""
    objects = inventory(spark, root, [prefix], pattern).where(F.col(OBJECT_KEY).contains(str(day)))
    return dict(sorted(tuple(r) for r in objects.select("path", "bytes").collect()))


def scan_day(
    spark: SparkSession, root: str, prefix: str, day: str | int, pattern: str | None = None
) -> DataFrame:
    """All rows of the prefix's objects whose key names ``day``, plus ``object_key``.

    Only these objects are opened, each with its own columns: objects of one schema are read
    together, a column whose type differs between them is given as text, and one that an object
    lacks is null there. Without a match the result is empty.
    """
    return read_objects(spark, root, day_objects(spark, root, prefix, day, pattern))


def read_objects(
    spark: SparkSession, root: str, paths: Sequence[str], arrived: str | None = None
) -> DataFrame:
    """All rows of these objects, plus ``object_key`` and, if named, the time of arrival."""
    if not paths:
        return spark.createDataFrame([], f"{OBJECT_KEY} string" + (f", {arrived} timestamp" if arrived else ""))
    groups = _by_schema(spark, paths)
    kinds = defaultdict(set)
    for schema, _ in groups:
        for field in schema:
            kinds[field.name].add(field.dataType.simpleString())
    when = [F.col("_metadata.file_modification_time").alias(arrived)] if arrived else []
    parts = []
    for schema, files in groups:
        rows = spark.read.schema(schema).parquet(*files)
        columns = [
            F.col(f"`{f.name}`").cast("string").alias(f.name) if len(kinds[f.name]) > 1 else F.col(f"`{f.name}`")
            for f in schema
        ]
        parts.append(rows.select(*columns, *when, object_key(F.col("_metadata.file_path"), root).alias(OBJECT_KEY)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def object_schemas(spark: SparkSession, root: str, paths: Sequence[str]) -> DataFrame:
    """``(object_key, column, type)``: a row for every file and column, in the file's own types.

    A file whose footer the tasks cannot read (a store or a type that Arrow does not know) has one row of nulls.
    """
    footers = _footers(spark, paths)
    key = object_key(F.col("path"), root, encoded=False).alias(OBJECT_KEY)
    fields = F.from_json("schema", "struct<fields:array<struct<name:string,type:string>>>")["fields"]
    return footers.select(key, F.inline_outer(fields)).select(
        OBJECT_KEY, F.col("name").alias("column"), "type"
    )


def _footers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``(path, schema)``: each file's Spark schema as JSON, read from its footer in a task."""
    listed = spark.createDataFrame([(p,) for p in paths], "path string")
    tasks = min(len(paths), spark.sparkContext.defaultParallelism * 4)
    return listed.repartition(max(tasks, 1)).mapInPandas(_read_footers, "path string, schema string")


def _read_footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        with ThreadPoolExecutor(8) as pool:
            yield batch.assign(schema=list(pool.map(_footer, batch["path"])))


def _footer(path: str) -> str | None:
    """None for a store or a type that Arrow does not know, or a file that it cannot read."""
    try:
        if path.startswith("file:"):
            files, name = LocalFileSystem(), re.sub(SCHEME, "", path)
        else:
            files, name = FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", quote(path, safe=":/")))
        schema = read_schema(name, filesystem=files)
        written = (schema.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
        found = StructType.fromJson(json.loads(written)) if written else from_arrow_schema(schema)
    except (pa.ArrowException, OSError, PySparkException, ValueError):
        return None
    return _nullable(found).json()


def _nullable(schema: StructType) -> StructType:
    """Spark reads every column of a file as nullable, so that does not tell schemas apart."""
    text = re.sub(r'"(nullable|containsNull|valueContainsNull)":\s*false', r'"\1":true', schema.json())
    return StructType.fromJson(json.loads(text))


def _by_schema(spark: SparkSession, paths: Sequence[str]) -> list[tuple[StructType, list[str]]]:
    """Files of equal schema, by the footer of each; what tasks cannot read Spark's own reader looks at."""
    found: dict[str, tuple[StructType, list[str]]] = {}
    unknown = []
    for path, schema in sorted(tuple(r) for r in _footers(spark, paths).collect()):
        if schema is None:
            unknown.append(path)
        else:
            found.setdefault(schema, (StructType.fromJson(json.loads(schema)), []))[1].append(path)
    with ThreadPoolExecutor(16) as pool:
        for path, schema in zip(unknown, pool.map(lambda p: spark.read.parquet(p).schema, unknown), strict=True):
            found.setdefault(schema.json(), (schema, []))[1].append(path)
    return list(found.values())


def readiness(
    spark: SparkSession, root: str, prefixes: Sequence[str], day: str | int, pattern: str | None = None
) -> DataFrame:
    """``(prefix, objects, status)`` for the day; a prefix without objects shows 0."""
    declared = spark.createDataFrame([(p,) for p in prefixes], "prefix string")
    counts = (
        inventory(spark, root, prefixes, pattern)
        .where(F.col(OBJECT_KEY).contains(str(day)))
        .groupBy("prefix")
        .agg(F.count(F.lit(1)).alias("found"))
    )
    objects = F.coalesce("found", F.lit(0))
    return declared.join(counts, "prefix", "left").select(
        "prefix",
        objects.alias("objects"),
        F.when(objects > 0, F.lit(ENOUGH)).otherwise(F.lit(NOT_ENOUGH)).alias("status"),
    )


def check_day(spark: SparkSession, root: str, prefixes: Sequence[str], day: str | int) -> str:
    """One status for the day: any object under any prefix is enough to start.

    A root that is missing or that the file system cannot reach gives ``UNREACHABLE``; any other
    error is raised.
    """
    try:
        total = readiness(spark, root, prefixes, day).agg(F.sum("objects")).first()[0]
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return UNREACHABLE
        raise
    except Py4JJavaError as error:
        if re.match(r"java\.(io|net)\.|org\.apache\.hadoop\.", error.java_exception.getClass().getName()):
            return UNREACHABLE
        raise
    return ENOUGH if total else NOT_ENOUGH
