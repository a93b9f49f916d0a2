"""Mixing sources to target weights by repetition rates.

The words of each source are counted, and the whole count is shared out by the sources' weights.
A source takes at most ``MOST`` times its own words; what is over goes to the others by weight,
until none is above (the level is found in closed form from running sums, without a loop). The
target over the words of a source is its rate: each document is emitted floor(rate) times, and once
more if a number drawn from a hash of its id is below the fraction.

Only DataFrame functions are used. Counts are combined in the map tasks, so a source with a third of
all rows costs a row for each task; the ranking runs over one row for each source. Documents meet
their source's rate in a join whose hot partitions Spark may split. Defined results: a null text has
no words; null is a source of its own and comes last; a null id is hashed as an empty text; rows
that repeat an id are all decided alike; where no source has words, all targets are 0 and nothing is
emitted; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silverlake.llm.base import WORD, fresh, stored, table

MOST = 3
SEED = "mix"


def sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    words = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD))
    return docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), words.cast("long").alias("size")
    )


def targets(measured: DataFrame, most: int = MOST) -> DataFrame:
    """``source``, ``source_size`` and ``target`` from rows of ``source`` and ``size``.

    Sources by code point, null last, weigh 1, 2, 3 and so on again.
    """
    whole = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy(F.col("most") / F.col("weight"), "place")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    ranked = (
        measured.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("place", F.row_number().over(by_name))
        .withColumn("weight", (F.col("place") - 1) % 3 + 1)
        .withColumn("most", F.col("source_size") * most)
        .withColumn("total", F.sum("source_size").over(whole))
    )
    # Sources in the order in which a rising level fills them: what is left, over the weights left.
    levels = ranked.withColumn(
        "level",
        (F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0))).cast("double")
        / F.sum("weight").over(onward),
    ).withColumn("full", F.col("most") <= F.col("weight") * F.col("level"))
    first = F.min(F.when(~F.col("full"), F.struct(F.col("most") / F.col("weight"), "place", "level")))
    return levels.withColumn("final", first.over(whole)["level"]).select(
        "source",
        "source_size",
        F.when(F.col("full"), F.col("most").cast("double"))
        .otherwise(F.col("weight") * F.col("final"))
        .alias("target"),
    )


def decisions(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    most: int = MOST,
    seed: str = SEED,
) -> DataFrame:
    """For each row: doc_id, source, size, source_size, target and copies."""
    measured = stored(sizes(docs, id_col, text_col, source_col), "sizes")
    plan = targets(measured, most).withColumnRenamed("source", "of")
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most))))
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    draw = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(16**13))
    once_more = (draw < F.col("rate") - F.floor("rate")).cast("long")
    return (
        measured.join(plan, F.col("source").eqNullSafe(F.col("of")))
        .withColumn("rate", F.coalesce(rate, F.lit(0.0)))
        .select(
            "doc_id", "source", "size", "source_size", "target", (F.floor("rate") + once_more).alias("copies")
        )
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    most: int = MOST,
    seed: str = SEED,
) -> DataFrame:
    """The rows of ``docs``, each as often as it is taken, with all their columns."""
    rate, copy, name = fresh(docs, "mix_rate"), fresh(docs, "mix_copy"), fresh(docs, "mix_source")
    plan = targets(sizes(docs, id_col, text_col, source_col), most).select(
        F.col("source").alias(name),
        F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most))))
        .otherwise(0.0)
        .alias(rate),
    )
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    draw = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(16**13))
    copies = (F.floor(rate) + (draw < F.col(rate) - F.floor(rate)).cast("long")).cast("int")
    rated = docs.join(stored(plan, "rates"), F.col(source_col).eqNullSafe(F.col(name)))
    return rated.select(*docs.columns, F.explode(F.array_repeat(F.lit(0), copies)).alias(copy)).drop(copy)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decisions(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        "source",
        "copies",
    )


SQL = f"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size
           FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             row_number() OVER (ORDER BY source ASC NULLS LAST) AS place FROM d GROUP BY source),
r AS (SELECT *, (place - 1) % 3 + 1 AS weight, source_size * {MOST} AS most,
             CAST(sum(source_size) OVER () AS BIGINT) AS total FROM s),
l AS (SELECT *, CAST(total - coalesce(sum(most) OVER (ORDER BY most / weight, place
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
             / CAST(sum(weight) OVER (ORDER BY most / weight, place
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level FROM r),
f AS (SELECT *, most <= weight * level AS capped FROM l),
t AS (SELECT source, source_size, CASE WHEN capped THEN CAST(most AS DOUBLE) ELSE weight *
        (SELECT arg_min(level, most / weight) FROM f WHERE NOT capped) END AS target FROM f),
c AS (SELECT doc_id, size, source_size, target, d.source,
             coalesce(least(target / nullif(source_size, 0), {MOST}), 0) AS rate,
             CAST('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT)
               / {float(16**13)!r}::DOUBLE AS draw
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
n AS (SELECT *, CAST(floor(rate) AS BIGINT) + CAST(draw < rate - floor(rate) AS BIGINT) AS copies FROM c)
SELECT doc_id, size, source_size, target, copies * size AS taken, source, copies FROM n"""
