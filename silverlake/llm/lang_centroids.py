"""Language of a text by the nearest of several centroids per language.

A text is lower-cased and whatever ASCII holds besides letters becomes one space; its runs of one, two
and three bytes are hashed to ``DIMS`` numbers. A run's weight is ``times * idf`` and the vector
of all weights has length one. The inverse document frequencies cover all training texts. Of each
language ``SAMPLE`` training texts, those of least hash, are clustered into at most ``CENTROIDS``
centroids (k-means by cosine, in a task for each language). A text takes the language of the centroid of
greatest cosine, ties to the least language by its bytes, and is rejected if its distance, 1 - cosine, is
greater than the centroid's radius: ``SLACK`` times the distance within which ``WITHIN`` of its members lie.

Defined results: a null text, and one without any letter, has language ``und``, similarity 0 and no
distance and is rejected, as is every text if there is nothing to learn from; very long texts are read
whole, in slices; rows that repeat a text are scored each, and count once in the sample; null languages
are not learned; an empty table gives an empty result; a column whose name is one of the results' (in any
case) is replaced, others pass through.

All languages are compared, ``BLOCK`` of them at a time: a block's centroids, ``DIMS`` numbers each, are
what a task holds. With up to ``BLOCK`` languages the texts are read once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silverlake.llm.base import stored, table

DIMS = 1 << 14
RUNS = (1, 2, 3)
CENTROIDS, SAMPLE, ROUNDS = 4, 500, 12
SLACK, WITHIN = 1.5, 0.99
BLOCK = 128
SLICE = 1 << 20
UNKNOWN = "und"
FOLDS, HELD_OUT = 3, 1

_LETTER = regex.compile(r"\p{L}")
_FOLD = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def runs(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a text's runs, ascending, and how often each occurs; empty without a letter."""
    if text is None or not _LETTER.search(text):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    data = np.frombuffer(b" " + text.lower().encode("utf-8", "replace").translate(_FOLD) + b" ", np.uint8)
    data = data[np.append(True, (data[1:] != 32) | (data[:-1] != 32))]
    times = np.zeros(DIMS, np.int64)
    shift = np.uint32(32 - DIMS.bit_length() + 1)
    for start in range(0, len(data), SLICE):
        piece = data[start : start + SLICE + RUNS[-1] - 1].astype(np.uint32)
        own = min(SLICE, len(data) - start)
        code, found = np.zeros(len(piece), np.uint32), []
        for n in range(1, RUNS[-1] + 1):
            code = (code[: len(piece) - n + 1] << np.uint32(8)) + piece[n - 1 :]
            if n in RUNS:
                # A run's length is a part of its number, and runs belong to the slice that they begin in.
                mixed = (code[:own] + np.uint32(n << 24)) * np.uint32(2654435761)
                found.append(mixed >> shift)
        times += np.bincount(np.concatenate(found), minlength=DIMS)
    at = np.flatnonzero(times)
    return at, times[at]


def weights(at: np.ndarray, times: np.ndarray, idf: np.ndarray) -> np.ndarray:
    raw = times * idf[at]
    return raw / np.sqrt(raw @ raw) if len(raw) else raw


def cluster(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of length one by k-means on cosine, and each vector's centroid.

    The first centre is the vector nearest to the mean, each further one the vector farthest from those before.
    """
    near = vectors @ vectors.mean(axis=0)
    chosen = [int(near.argmax())]
    best = vectors @ vectors[chosen[0]]
    while len(chosen) < min(CENTROIDS, len(vectors)) and best.min() < 1 - 1e-6:
        chosen.append(int(best.argmin()))
        best = np.maximum(best, vectors @ vectors[chosen[-1]])
    centres = vectors[chosen]
    member = (vectors @ centres.T).argmax(axis=1)
    for _ in range(ROUNDS):
        sums = np.stack([vectors[member == c].sum(axis=0) if (member == c).any() else centres[c] for c in range(len(centres))])
        centres = sums / np.linalg.norm(sums, axis=1, keepdims=True)
        now = (vectors @ centres.T).argmax(axis=1)
        if (now == member).all():
            break
        member = now
    return centres, member


@dataclass(frozen=True)
class Model:
    """``idf`` of each run, and ``centroids``: number (of the language), lang, vector, radius."""

    idf: np.ndarray
    centroids: DataFrame
    languages: int


def document_frequencies(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, int]:
    """For each run the number of texts that have it, and the number of texts with a letter."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = np.zeros(DIMS + 1, np.int64)
        for batch in batches:
            for text in batch.column(0):
                at, _ = runs(text.as_py())
                texts[at] += 1
                texts[DIMS] += len(at) > 0
        at = np.flatnonzero(texts)
        yield pa.record_batch([pa.array(at, pa.int32()), pa.array(texts[at], pa.int64())], ["run", "texts"])

    parts = docs.select(text_col).mapInArrow(count, "run int, texts long")
    # A row for each run, DIMS at most.
    found = {r["run"]: r["texts"] for r in parts.groupBy("run").agg(F.sum("texts").alias("texts")).collect()}
    total = found.pop(DIMS, 0)
    frequencies = np.zeros(DIMS)
    frequencies[list(found)] = list(found.values())
    return frequencies, total


def sample(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang and text of at most ``SAMPLE`` different texts of each language, those of least hash."""
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rows = rows.withColumn("hash", F.xxhash64("text"))
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"), F.min("hash").alias("least"))
    sizes = stored(sizes, "sizes").withColumnRenamed("lang", "of")
    # Hashes are even, so this leaves some four times SAMPLE rows of a language, and always the least.
    share = (F.col("hash").cast("double") + 2.0**63) / 2.0**64
    few = rows.join(sizes, rows.lang == F.col("of")).where(
        (share * F.col("rows") < 4.0 * SAMPLE) | (F.col("hash") == F.col("least"))
    )
    once = few.groupBy("lang", "hash").agg(F.min("text").alias("text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("hash"))
    return once.withColumn("place", place).where(F.col("place") <= SAMPLE).select("lang", "text")


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """The model of all rows of ``docs`` that have a text and a language."""
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    frequencies, total = document_frequencies(known, text_col)
    idf = np.log((1 + total) / (1 + frequencies)) + 1

    def centres(rows: pa.Table) -> pa.Table:
        vectors = np.zeros((rows.num_rows, DIMS), np.float32)
        for i, text in enumerate(rows.column("text").to_pylist()):
            at, times = runs(text)
            vectors[i, at] = weights(at, times, idf)
        found, member = cluster(vectors)
        distance = 1 - np.einsum("ij,ij->i", vectors, found[member])
        radius = [SLACK * float(np.quantile(distance[member == c], WITHIN)) if (member == c).any() else 0.0 for c in range(len(found))]
        return pa.table(
            {
                "lang": pa.array([rows.column("lang")[0].as_py()] * len(found), pa.string()),
                "vector": pa.array([v.astype(np.float32).tobytes() for v in found], pa.binary()),
                "radius": pa.array(radius, pa.float64()),
            }
        )

    learned = sample(known, text_col, lang_col).groupBy("lang").applyInArrow(centres, "lang string, vector binary, radius double")
    learned = stored(learned, "centroids")
    names = stored(
        learned.select("lang").distinct().withColumn("number", F.row_number().over(Window.orderBy("lang")) - 1), "languages"
    )
    return Model(idf, learned.join(names, "lang"), names.count())


RESULTS = ("lang_pred", "similarity", "distance", "rejected")


def predict(docs: DataFrame, model: Model, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``lang_pred``, ``similarity`` (0 to 1), ``distance`` (null without a letter) and ``rejected``."""
    out = docs.select(
        *[c for c in docs.columns if c.lower() not in RESULTS],
        F.lit(UNKNOWN).alias("lang_pred"),
        F.lit(0.0).alias("similarity"),
        F.lit(None).cast("double").alias("distance"),
        F.lit(True).alias("rejected"),
    )
    for first in range(0, model.languages, BLOCK):
        block = model.centroids.where(F.col("number").between(first, first + BLOCK - 1))
        # BLOCK languages of CENTROIDS vectors at most.
        rows = block.orderBy("lang", "vector").collect()
        last = first + BLOCK >= model.languages
        out = _compare(out, model.idf, rows, text_col, keep_text or not last)
    return out if keep_text or model.languages else out.drop(text_col)


def _compare(docs: DataFrame, idf: np.ndarray, centroids: list, text_col: str, keep_text: bool) -> DataFrame:
    spark = docs.sparkSession
    langs = [r["lang"] for r in centroids]
    radius = np.array([r["radius"] for r in centroids])
    # Runs are rows, so that a text reads neighbouring numbers.
    matrix = np.ascontiguousarray(np.stack([np.frombuffer(r["vector"], np.float32) for r in centroids]).T)
    shared = spark.sparkContext.broadcast((matrix, idf))
    schema = docs.select(*[c for c in docs.columns if keep_text or c != text_col]).schema
    at_text = docs.columns.index(text_col)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix, idf = shared.value
        for batch in batches:
            so_far = [batch.column(batch.num_columns - len(RESULTS) + i).to_pylist() for i in range(len(RESULTS))]
            for i, text in enumerate(batch.column(at_text)):
                at, times = runs(text.as_py())
                if not len(at):
                    continue
                near = weights(at, times, idf) @ matrix[at]
                c = int(near.argmax())
                distance = max(0.0, 1 - float(near[c]))
                if so_far[2][i] is None or distance < so_far[2][i]:
                    for column, value in zip(so_far, (langs[c], 1 - min(distance, 1.0), distance, distance > radius[c]), strict=True):
                        column[i] = value
            kept = [j for j in range(batch.num_columns - len(RESULTS)) if keep_text or j != at_text]
            kinds = (pa.string(), pa.float64(), pa.float64(), pa.bool_())
            yield pa.record_batch(
                [batch.column(j) for j in kept] + [pa.array(v, k) for v, k in zip(so_far, kinds, strict=True)],
                [batch.schema.names[j] for j in kept] + list(RESULTS),
            )

    return docs.mapInArrow(compare, schema)


def held_out(doc_id: Column) -> Column:
    """A null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == HELD_OUT


def op12_lang_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out(F.col("doc_id")).alias("held_out"))
    model = fit(docs.where(~F.col("held_out")))
    found = predict(docs.drop("lang"), model, keep_text=False)
    return found.select("doc_id", "held_out", "lang_pred", F.col("similarity").alias("score"), "distance", "rejected")
