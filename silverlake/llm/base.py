"""Small helpers that the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlake.sources.scratch import scratch_path

#: The bytes that separate words: space and U+0009 to U+000D. ``bytes.split()`` splits at the same ones.
WORD = r"[^\x20\x09-\x0D]+"


#: Rows of whole texts that go to a Python worker at once.
TEXT_ROWS = 500
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def text_batches(spark: SparkSession) -> None:
    """From now on the session hands Python at most ``TEXT_ROWS`` rows at once.

    Spark's own 10,000 rows of very long texts are more than a worker can hold.
    """
    if not 0 < int(spark.conf.get(BATCH)) <= TEXT_ROWS:
        spark.conf.set(BATCH, TEXT_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` written to the shared scratch folder and read back.

    Cuts the lineage: what is read several times is computed once, and a lost executor costs a
    re-read.
    """
    path = scratch_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def fresh(rows: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``rows`` does not have (compared without case)."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def one_row_each(docs: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """One row of ``docs``, with all its columns, for each of ``keys`` (one column, ``key``, without repeats) that it has.

    Rows that repeat a key are reduced in the map tasks before anything moves, so that however many they are, they do
    not meet in one task with their texts. A semi join would be moved below that reduction; this one stays.
    """
    name = fresh(docs, "row_key")
    once = docs.withColumn(name, key).dropDuplicates([name])
    return once.join(keys.withColumnRenamed("key", name), name).select(*docs.columns)
