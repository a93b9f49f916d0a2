"""Exact deduplication by recipes of content-defined chunks.

A text is cut where its own content says so: after at least ``MIN_CHUNK`` characters, behind the
next line end or sentence end, or at ``MAX_CHUNK`` characters if none comes. Equal texts are cut
alike, and an edit changes only the chunks around it. Each chunk gets an identifier, its SHA-256,
and the identifiers are verified: all chunks that share one are compared byte by byte (least and
greatest are the same), and should two texts ever share one, the identifiers are numbered apart.
A document is then the ordered list of its identifiers, 32 bytes for each chunk. These lists are
grouped and compared; the text of a chunk moves once, and whole documents never move.

Only DataFrame functions are used. Defined results: a null text counts as empty, and all empty
texts are equal; a null id is smaller than any other; of rows that repeat an id and a text, one is
kept; an empty table gives an empty result; other columns are ignored by ``decisions`` and passed
through by ``deduplicate``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silverlake.llm.base import one_row_each, stored, table

MIN_CHUNK, MAX_CHUNK = 512, 4096
CHUNK = rf"(?s).{{{MIN_CHUNK},{MAX_CHUNK}}}?(?:\n|[.!?] )|.{{1,{MAX_CHUNK}}}"


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def recipes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """``row`` (a number of the row), ``doc_id``, ``text_sha256`` and ``recipe``, for each document.

    Two recipes are equal exactly if the texts are. ``digest`` may be any function of a chunk,
    however weak; the verification keeps the recipes right.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    cut = docs.select(
        F.col(id_col).alias("doc_id"),
        F.sha2(text, 256).alias("text_sha256"),
        F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0)).alias("chunks"),
    )
    numbered = cut.select(F.monotonically_increasing_id().alias("row"), "*")
    clashes = stored(clashing(_pieces(cut, digest)), "clashes")
    if clashes.isEmpty():
        return numbered.select("row", "doc_id", "text_sha256", F.transform("chunks", digest).alias("recipe"))
    return _told_apart(stored(numbered, "numbered"), clashes, digest)


def clashing(pieces: DataFrame) -> DataFrame:
    """The digests under which there is more than one chunk text; as a rule, none.

    The least and the greatest text of a digest are found in the map tasks first, so a chunk that
    a third of the documents share costs one row for each task.
    """
    spans = pieces.groupBy("digest").agg(F.min("chunk").alias("least"), F.max("chunk").alias("greatest"))
    return spans.where("least <> greatest").select("digest")


def _pieces(cut: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    chunks = cut.select(F.explode("chunks").alias("chunk"))
    return chunks.select(digest(F.col("chunk")).alias("digest"), "chunk")


def _told_apart(cut: DataFrame, clashes: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """Recipes whose identifiers also hold the number of the text among those of its digest."""
    texts = _pieces(cut, digest).join(clashes, "digest", "left_semi").distinct()
    order = F.row_number().over(Window.partitionBy("digest").orderBy("chunk"))
    texts = texts.select("digest", "chunk", order.cast("string").alias("number"))
    pieces = cut.select("row", F.posexplode("chunks").alias("at", "chunk")).withColumn(
        "digest", digest(F.col("chunk"))
    )
    named = pieces.join(texts, ["digest", "chunk"], "left").select(
        "row",
        F.struct("at", F.concat_ws("#", F.hex("digest"), "number").cast("binary").alias("id")).alias("part"),
    )
    lists = named.groupBy("row").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    recipe = F.coalesce(F.col("parts.id"), F.array().cast("array<binary>"))
    return cut.join(lists, "row", "left").select("row", "doc_id", "text_sha256", recipe.alias("recipe"))


def decisions(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """For each row: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest id is kept (of repeated ids, one).
    """
    lists = stored(recipes(docs, id_col, text_col, digest), "recipes")
    groups = lists.groupBy("recipe").agg(
        F.max(F.struct("doc_id", "row")).alias("keeper"), F.count(F.lit(1)).alias("group_size")
    )
    # Stored, so that the join deals out its rows by itself and Spark may split a large group.
    copies = stored(groups.where("group_size > 1"), "copies")
    alone = F.col("group_size").isNull()
    return lists.join(copies, "recipe", "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keeper.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("row") == F.col("keeper.row"), F.lit(True)).alias("kept"),
        "text_sha256",
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    kept = decisions(docs, id_col, text_col).where("kept")
    keys = kept.select(_row_key(F.col("doc_id"), F.col("text_sha256")).alias("key"))
    sha = F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)
    return one_row_each(docs, _row_key(F.col(id_col), sha), keys)


def _row_key(doc_id: Column, sha: Column) -> Column:
    return F.concat_ws(":", doc_id.cast("string"), sha)


def op8_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decisions(table(spark, sf_dir, "documents"))


SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""
