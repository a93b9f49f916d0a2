"""The daily batch: one day's bronze objects into all silver tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from silverlake.operators.transform import keys_complete, loss_names, transform
from silverlake.plans.specs import MOVIE_TABLES, TableSpec, prefixes
from silverlake.sources.bronze import OBJECT_KEY, day_sizes, read_objects
from silverlake.sources.catalog import merge_into_catalog
from silverlake.sources.silver import dealt_by_key, observed, shuffles_released, table_exists, upsert_table

LOG_TABLE = "run_log"
LOG_SCHEMA = (
    "run_id string, day string, prefix string, table string, status string, "
    "objects long, rows_in long, rows_written long, lost_values long, lost map<string,bigint>, error string, "
    "attempt int"
)

# The two outcomes of a run.
SUCCEEDED = "transformation_and_save_succeeded"
PROBLEM = "some_problem_occurred"

# What happened to one table.
WRITTEN, NO_OBJECTS, READ_FAILED = "written", "no_objects", "read_failed"
TRANSFORM_FAILED, WRITE_FAILED = "transform_failed", "write_failed"
FAILED = (READ_FAILED, TRANSFORM_FAILED, WRITE_FAILED)


def run_day(
    spark: SparkSession,
    bronze: str,
    silver: str,
    day: str | int,
    *,
    tables: dict[str, TableSpec] = MOVIE_TABLES,
    on_duplicate: str = "latest",
    at_once: int = 4,
    catalog: str | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """Load the day's objects and return the run's log rows, one per table.

    Each table takes one pass over the columns it needs and one merge, however many objects
    landed; that pass also counts the rows read and the values lost. Objects rank by key, so a
    later one wins. A table that fails is logged with its error and does not stop the others, nor does a
    prefix whose objects cannot be read; ``at_once`` tables are loaded at the same time. With ``catalog`` (a namespace of a table
    format with its own MERGE) the tables are merged there, and ``silver`` holds the log alone.
    ``pattern`` narrows the listing of objects, see ``inventory``.
    """
    how = (on_duplicate, at_once, catalog, pattern)
    return _run(spark, bronze, silver, str(day), tables, uuid4().hex, 1, *how)


def retry_failed(
    spark: SparkSession,
    bronze: str,
    silver: str,
    run_id: str,
    *,
    tables: dict[str, TableSpec] = MOVIE_TABLES,
    on_duplicate: str = "latest",
    at_once: int = 4,
    catalog: str | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """Load again the tables of a run that failed in their last attempt; returns the new log rows.

    The day is that of the run, and its objects are listed anew. The entries have the run's id and the next
    attempt's number, and ``run_summary`` goes by the last attempt of each table. Without a failed table
    nothing is done.
    """
    last = last_attempts(read_log(spark, silver).where(F.col("run_id") == run_id)).collect()
    if not last:
        raise ValueError(f"no run {run_id!r} in the log under {silver}")
    failed = [r for r in last if r["status"] in FAILED]
    if not failed:
        return spark.createDataFrame([], LOG_SCHEMA)
    if unknown := sorted({r["table"] for r in failed} - {spec.name for spec in tables.values()}):
        raise ValueError(f"failed tables {unknown} are not among those given")
    again = {name: spec for name, spec in tables.items() if spec.name in {r["table"] for r in failed}}
    attempt = max(r["attempt"] for r in last) + 1
    how = (on_duplicate, at_once, catalog, pattern)
    return _run(spark, bronze, silver, failed[0]["day"], again, run_id, attempt, *how)


def _run(
    spark: SparkSession, bronze: str, silver: str, day: str, tables: dict[str, TableSpec], run_id: str, attempt: int,
    on_duplicate: str, at_once: int, catalog: str | None, pattern: str | None,
) -> DataFrame:
    days = {prefix: _day_rows(spark, bronze, prefix, day, pattern) for prefix in prefixes(tables)}

    def load(spec: TableSpec) -> tuple:
        rows, size, done = days[spec.prefix]
        if rows is not None:
            to = f"{catalog}.{spec.name}" if catalog else None
            done = done | _load_table(rows, size, silver, spec, on_duplicate, to, f"{run_id}-{day}")
        values = {"run_id": run_id, "day": day, "prefix": spec.prefix, "table": spec.name, "attempt": attempt} | done
        return tuple(values.get(field.split()[0]) for field in LOG_SCHEMA.split(", "))

    with shuffles_released(spark), ThreadPoolExecutor(at_once) as pool:
        entries = list(pool.map(load, tables.values()))
    log = spark.createDataFrame(entries, LOG_SCHEMA)
    log.coalesce(1).write.mode("append").parquet(f"{silver}/{LOG_TABLE}")
    return log


def read_log(spark: SparkSession, silver: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(f"{silver}/{LOG_TABLE}")


def last_attempts(log: DataFrame) -> DataFrame:
    """The newest entry of each table in each run."""
    numbered = log.withColumn("attempt", F.coalesce("attempt", F.lit(1)))
    newest = F.max_by(F.struct(*numbered.columns), "attempt").alias("newest")
    return numbered.groupBy("run_id", "table").agg(newest).select("newest.*")


def run_summary(log: DataFrame) -> DataFrame:
    """``(run_id, objects, expected, transformed, written, status)`` per run; objects over all tables.

    Of a table that was retried the last attempt counts.
    """
    status = F.col("status")
    counts = last_attempts(log).groupBy("run_id").agg(
        F.sum(F.coalesce("objects", F.lit(0))).alias("objects"),
        F.count_if(status != NO_OBJECTS).alias("expected"),
        F.count_if(status.isin(WRITTEN, WRITE_FAILED)).alias("transformed"),
        F.count_if(status == WRITTEN).alias("written"),
    )
    complete = (F.col("expected") == F.col("transformed")) & (F.col("expected") == F.col("written"))
    return counts.withColumn("status", F.when(complete, F.lit(SUCCEEDED)).otherwise(F.lit(PROBLEM)))


def run_status(log: DataFrame) -> str:
    """The outcome of the single run whose log rows are given; no work is a success."""
    summary = run_summary(log).first()
    return summary["status"] if summary else SUCCEEDED


def _day_rows(spark: SparkSession, bronze: str, prefix: str, day: str, pattern: str | None) -> tuple:
    """The day's rows (None if there are none to load), their bytes and what the log says of them."""
    try:
        sizes = day_sizes(spark, bronze, prefix, day, pattern)
        if not sizes:
            return None, 0, {"status": NO_OBJECTS, "objects": 0, "rows_in": 0}
        rows = read_objects(spark, bronze, list(sizes))
    except Exception as error:  # one prefix's failure must not stop the others
        if isinstance(error, AnalysisException) and error.getCondition() == "PATH_NOT_FOUND":
            return None, 0, {"status": NO_OBJECTS, "objects": 0, "rows_in": 0}
        return None, 0, {"status": READ_FAILED, "error": _text(error)}
    return rows, sum(sizes.values()), {"objects": len(sizes)}


def _load_table(
    rows: DataFrame, size: int, silver: str, spec: TableSpec, on_duplicate: str, catalog_table: str | None, load: str
) -> dict:
    counts, dealt = Observation(), None
    try:
        if not catalog_table and on_duplicate == "latest" and not table_exists(rows.sparkSession, silver, spec.name):
            dealt = dealt_by_key(rows, spec, size, keep=[OBJECT_KEY])
        rows = rows if dealt is None else dealt
        source = transform(rows, spec, keep=[OBJECT_KEY], counts=None if catalog_table else counts)
    except Exception as error:  # one table's failure must not stop the others
        return {"status": TRANSFORM_FAILED, "error": _text(error)}
    try:
        how = {"on_duplicate": on_duplicate, "order_by": [OBJECT_KEY]}
        if dealt is None:
            how["keys_complete"] = keys_complete(rows, spec)
        if catalog_table:
            # What a format's own MERGE reads, and how often, is up to it, so nothing is counted there.
            merge_into_catalog(source, catalog_table, spec, **how)
            return {"status": WRITTEN, "rows_in": rows.count()}
        written = upsert_table(source, silver, spec, load=load, dealt=dealt is not None, **how)
        seen = observed(counts)
    except Exception as error:
        return {"status": WRITE_FAILED, "error": _text(error)}
    lost = {name: seen.get(name) or 0 for name in loss_names(spec)}
    return {
        "status": WRITTEN, "rows_in": seen.get("rows_in", 0), "rows_written": written,
        "lost_values": sum(lost.values()), "lost": lost,
    }


def _text(error: Exception) -> str:
    return f"{type(error).__name__}: {error}"
