"""Load new bronze objects as they arrive, each exactly once.

The stream is one of objects, not of rows: a batch has the paths of new objects, and their rows are read as the
daily batch reads them, each object with its own columns.
"""

from __future__ import annotations

from threading import Event

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from silverlake.operators.transform import keys_complete, transform
from silverlake.plans.specs import MOVIE_TABLES, TableSpec
from silverlake.sources.bronze import read_objects
from silverlake.sources.scratch import path_exists
from silverlake.sources.silver import observed, upsert_table

ARRIVED = "arrived"
OBJECT_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
STREAM_LOG, PROGRESS = "stream_log", "stream_progress"
LOG_SCHEMA = "query_id string, batch long, table string, objects long, rows_in long, rows_written long"
PROGRESS_SCHEMA = (
    "query_id string, run_id string, prefix string, batch long, started string, "
    "objects long, dropped long, millis long"
)


def ingest_available(
    spark: SparkSession,
    bronze: str,
    silver: str,
    prefix: str,
    checkpoint: str,
    *,
    tables: dict[str, TableSpec] = MOVIE_TABLES,
    files_per_batch: int | None = None,
    on_duplicate: str = "latest",
    redelivered_within: str | None = None,
) -> StreamingQuery:
    """Merge every object of ``prefix`` not seen before into its silver tables, then stop.

    Objects count in the order of their arrival, by modification time and then key, within a
    batch as between batches, so the size of a batch does not change the result (the daily batch
    knows the day's objects beforehand and ranks them by key). An object that lands late is picked
    up by the next call, whatever day its key names. The checkpoint remembers what was read; each
    merge is logged with the query's id, which a new checkpoint renews, and the batch number, so a batch
    repeated after a failure leaves out the tables that have it. One that failed between a table's merge and its
    log entry merges again, which changes nothing.

    With ``redelivered_within``, as ``"3 days"``, an object whose bytes came before under another name is
    left out if it arrives no later than that after the first one (by modification time); otherwise the old values
    would count as newer than what came between. This reads each object once more, for its digest, and
    keeps the digests of that time. Of two copies in one batch either may be the one that counts.
    """
    reader = spark.readStream.format("binaryFile").schema(OBJECT_SCHEMA).option("recursiveFileLookup", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    arrivals = reader.load(f"{bronze}/{prefix}")
    if redelivered_within:
        arrivals = arrivals.select("path", "modificationTime", F.sha2("content", 256).alias("digest"))
        arrivals = arrivals.withWatermark("modificationTime", redelivered_within)
        arrivals = arrivals.dropDuplicatesWithinWatermark(["digest"])
    specs = [spec for spec in tables.values() if spec.prefix == prefix]

    def merge_batch(batch: DataFrame, number: int) -> None:
        query_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        paths = sorted(r["path"] for r in batch.collect())
        if not paths:
            return
        done = _logged(spark, silver, query_id, number)
        rows = read_objects(spark, bronze, paths, arrived=ARRIVED)
        for spec in specs:
            if spec.name not in done:
                counts = Observation()
                order = [ARRIVED, "object_key"]
                written = upsert_table(
                    transform(rows, spec, keep=order, counts=counts),
                    silver,
                    spec,
                    on_duplicate=on_duplicate,
                    order_by=order,
                    keys_complete=keys_complete(rows, spec),
                    load=f"{query_id}-{number}",
                )
                entry = (query_id, number, spec.name, len(paths), observed(counts).get("rows_in", 0), written)
                _append(spark, [entry], LOG_SCHEMA, f"{silver}/{STREAM_LOG}")

    progress = Progress(prefix)
    spark.streams.addListener(progress)
    try:
        query = (
            arrivals.select("path")
            .writeStream.foreachBatch(merge_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        entries = progress.of(query)
    finally:
        spark.streams.removeListener(progress)
    if entries:
        _append(spark, entries, PROGRESS_SCHEMA, f"{silver}/{PROGRESS}")
    return query


class Progress(StreamingQueryListener):
    """Keeps what the running queries tell of their batches; events come after a delay, from another thread."""

    WAIT_SECONDS = 60

    def __init__(self, prefix: str) -> None:
        self.prefix = prefix
        self.entries: dict[str, list[tuple]] = {}
        self.ended: dict[str, Event] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        dropped = sum(int(o.customMetrics.get("numDroppedDuplicateRows", 0)) for o in p.stateOperators)
        entry = (
            str(p.id), str(p.runId), self.prefix, p.batchId, p.timestamp,
            p.numInputRows, dropped, int(p.durationMs.get("triggerExecution", 0)),
        )
        self.entries.setdefault(str(p.runId), []).append(entry)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.setdefault(str(event.runId), Event()).set()

    def of(self, query: StreamingQuery) -> list[tuple]:
        """All batches of a query that has ended."""
        self.ended.setdefault(str(query.runId), Event()).wait(self.WAIT_SECONDS)
        return self.entries.get(str(query.runId), [])


def read_stream_log(spark: SparkSession, silver: str) -> DataFrame:
    """``(query_id, batch, table, objects, rows_in, rows_written)`` for every merge of a stream."""
    return spark.read.schema(LOG_SCHEMA).parquet(f"{silver}/{STREAM_LOG}")


def read_progress(spark: SparkSession, silver: str) -> DataFrame:
    """``(query_id, run_id, prefix, batch, started, objects, dropped, millis)`` for every batch of a stream."""
    return spark.read.schema(PROGRESS_SCHEMA).parquet(f"{silver}/{PROGRESS}")


def _logged(spark: SparkSession, silver: str, query_id: str, number: int) -> set[str]:
    if not path_exists(spark, f"{silver}/{STREAM_LOG}"):
        return set()
    log = read_stream_log(spark, silver)
    same = (F.col("query_id") == query_id) & (F.col("batch") == number)
    return {r["table"] for r in log.where(same).select("table").collect()}


def _append(spark: SparkSession, entries: list[tuple], schema: str, path: str) -> None:
    spark.createDataFrame(entries, schema).coalesce(1).write.mode("append").parquet(path)
