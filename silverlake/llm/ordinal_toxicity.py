"""Toxicity grades by cumulative-link ordinal regression over sparse word features.

P(grade >= k) = sigmoid(w . x - t_k): one weight vector for all grades and thresholds t_1 < t_2 < ..
that keep their order as they are learned (each is the one before plus a positive step). The output is
the expected severity, the sum of P(grade >= k), and a text is toxic if P(grade >= 1) >= 0.5.

Labels say toxic or not, so the grades above 0 are derived: the toxic texts of the training rows are
split, at the quantiles, by how many words they hold that speak for toxicity in the training rows.

Features are the lower-cased words, as 1 + log(count). Word counts by label are a Spark aggregate; the
``FEATURES`` with the strongest association are kept, however weak it is, and the regression is fitted on the driver over at most ``MOST_ROWS`` labelled texts (picked by a hash of the
id), as rows of a few feature numbers each. Scoring reads every whole text.

Defined results: a null text counts as empty, and an empty text gets the severity that the thresholds
alone give; ids that are null or repeated are scored row by row, and a repeated id is one row of the
sample; labels that are null are left out, and an id that is labelled both ways counts as toxic; if the labels hold no toxic or no clean text, severity is 0 and nothing is toxic; an empty table gives an
empty result; other columns pass through, and the columns added replace any of the same name in any case.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StructType

from silverlake.llm.base import stored, table, text_batches

MOST_ROWS = 20_000
FEATURES = 1024
GRADES = 3  # above 0
STEPS, RATE, DECAY = 1500, 0.1, 1e-5
ROWS = 256

_words = re.compile(r"\w+").findall


def features(text: str | None) -> Counter:
    return Counter(_words((text or "").lower()))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


@dataclass(frozen=True)
class Model:
    vocabulary: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray  # none: nothing is toxic

    def at_least(self, text: str | None) -> np.ndarray:
        """P(grade >= k) for k from 1."""
        known = self.vocabulary.keys()
        counts = features(text)
        score = sum(self.weights[self.vocabulary[f]] * (1 + np.log(counts[f])) for f in known & counts.keys())
        return _sigmoid(score - self.thresholds)


# ---------------------------------------------------------------- training


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    most: int = MOST_ROWS,
) -> DataFrame:
    """``text`` and ``toxic`` of at most ``most`` labelled documents, picked by a hash of the id.

    A row for each id: toxic if any of its labels says so, with the text of least hash if it has several.
    """
    marks = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("toxic"))
    marks = marks.where("toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where("doc_id IS NOT NULL")
    marks = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    text_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit("")).alias("text")
    texts = docs.select(F.col(id_col).alias("doc_id"), text)
    # At most ``most`` rows of two numbers; an id's rows are reduced to one in the map tasks.
    found = texts.join(F.broadcast(marks), "doc_id").groupBy("doc_id", "toxic").agg(
        F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least")
    )
    return stored(found.select("doc_id", "toxic", F.col("least.text").alias("text")), "toxic-labels")


def choose_features(sample: DataFrame, most: int = FEATURES) -> list[tuple[str, float]]:
    """The features with the strongest association with the label, and their log odds."""
    totals = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not clean:
        return []

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen = {0: Counter(), 1: Counter()}
            for text, mark in zip(batch["text"], batch["toxic"], strict=True):
                seen[mark].update(features(text).keys())
            names = list(seen[0].keys() | seen[1].keys())
            if names:
                yield pd.DataFrame({"name": names, "a": [seen[1][w] for w in names], "b": [seen[0][w] for w in names]})

    counts = sample.where("toxic in (0, 1)").mapInPandas(each, "name string, a long, b long")
    a, b = F.col("a"), F.col("b")
    n = toxic + clean
    chi = n * F.pow(a * clean - b * toxic, F.lit(2)) / (toxic * clean * (a + b) * (n - a - b + 1))
    odds = F.log((a + 0.5) / (toxic + 1)) - F.log((b + 0.5) / (clean + 1))
    found = (
        counts.groupBy("name")
        .agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
        .select("name", chi.alias("chi"), odds.alias("odds"))
        .orderBy(F.desc("chi"), "name")
        .limit(most)
    )
    return [(r["name"], r["odds"]) for r in found.collect()]


def fit(sample: DataFrame, most: int = FEATURES) -> Model:
    chosen = choose_features(sample, most)
    vocabulary = {name: k for k, (name, _) in enumerate(chosen)}
    speaks = {name for name, odds in chosen if odds > 2}

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, mark in zip(batch["text"], batch["toxic"], strict=True):
                counts = features(text)
                much = sum(1 + np.log(counts[f]) for f in speaks & counts.keys())
                known = vocabulary.keys() & counts.keys()
                out.append((mark, much, [vocabulary[f] for f in known], [counts[f] for f in known]))
            yield pd.DataFrame(out, columns=["toxic", "much", "at", "n"])

    # Bounded by the sample: at most MOST_ROWS rows of the chosen features.
    data = sample.where("toxic in (0, 1)").mapInPandas(rows, "toxic int, much double, at array<int>, n array<int>")
    data = data.toPandas()
    if data["toxic"].nunique() < 2:
        return Model({}, np.zeros(0), np.zeros(0))
    data = data.iloc[np.lexsort((data["at"].map(len), data["much"], data["toxic"]))]
    toxic, much = data["toxic"].to_numpy(), data["much"].to_numpy()
    edges = np.quantile(much[toxic == 1], np.arange(1, GRADES) / GRADES)
    grade = np.where(toxic == 1, 1 + np.searchsorted(edges, much, side="right"), 0)
    owner = np.repeat(np.arange(len(data)), data["at"].map(len))
    at = np.concatenate([*data["at"], np.zeros(0, np.int64)]).astype(np.int64)
    value = 1 + np.log(np.concatenate([*data["n"], np.zeros(0)]).astype(float))
    weights, thresholds = regress(owner, at, value, grade, len(vocabulary))
    return Model(vocabulary, weights, thresholds)


def regress(
    owner: np.ndarray, at: np.ndarray, value: np.ndarray, grade: np.ndarray, width: int, steps: int = STEPS
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds of greatest likelihood (with a small decay), by Adam.

    The rows are sparse: feature ``at[i]`` of row ``owner[i]`` is ``value[i]``.
    """
    top = int(grade.max())
    n = len(grade)
    rates = np.array([(grade >= k).mean() for k in range(1, top + 1)]).clip(1e-6, 1 - 1e-6)
    first = np.log((1 - rates) / rates)
    parameters = np.zeros(width + top)
    parameters[width] = first[0]
    parameters[width + 1 :] = np.log(np.diff(first).clip(1e-3))
    mean, square = np.zeros_like(parameters), np.zeros_like(parameters)
    for step in range(1, steps + 1):
        weights, low, gaps = parameters[:width], parameters[width], np.exp(parameters[width + 1 :])
        thresholds = low + np.concatenate([[0.0], np.cumsum(gaps)])
        score = np.bincount(owner, weights[at] * value, n)
        edges = np.concatenate([[-np.inf], thresholds, [np.inf]])
        above, over = _sigmoid(score - edges[grade]), _sigmoid(score - edges[grade + 1])
        likely = (above - over).clip(1e-12)
        up, down = above * (1 - above) / likely, over * (1 - over) / likely
        by_score = -(up - down) / n
        by_edge = np.zeros(top + 2)
        np.add.at(by_edge, grade, up / n)
        np.add.at(by_edge, grade + 1, -down / n)
        by_threshold = by_edge[1:-1]
        tails = np.cumsum(by_threshold[::-1])[::-1]
        gradient = np.concatenate(
            [
                np.bincount(at, by_score[owner] * value, width) + DECAY * weights,
                [tails[0]],
                tails[1:] * gaps,
            ]
        )
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        parameters -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    gaps = np.exp(parameters[width + 1 :])
    return parameters[:width], parameters[width] + np.concatenate([[0.0], np.cumsum(gaps)])


# ---------------------------------------------------------------- scoring


def score(docs: DataFrame, model: Model, text_col: str = "text", drop_text: bool = False) -> DataFrame:
    """``docs`` with severity (0 to GRADES), p_toxic, grade (the likeliest) and toxic."""
    added = {"severity": DoubleType(), "p_toxic": DoubleType(), "grade": IntegerType(), "toxic": BooleanType()}
    kept = [c for c in docs.columns if c.lower() not in added and not (drop_text and c == text_col)]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by FEATURES

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for at in range(0, len(whole), ROWS):
                batch = whole.iloc[at : at + ROWS]
                above = [shared.value.at_least(text) for text in batch[text_col]]
                out = batch[kept].copy()
                out["severity"] = [float(p.sum()) for p in above]
                out["p_toxic"] = [float(p[0]) if len(p) else 0.0 for p in above]
                out["grade"] = [int(np.argmax(-np.diff([1.0, *p, 0.0]))) for p in above]
                out["toxic"] = [bool(len(p) and p[0] >= 0.5) for p in above]
                yield out

    fields = [docs.schema[c] for c in kept]
    schema = StructType(fields)
    for name, kind in added.items():
        schema = schema.add(name, kind)
    return docs.mapInPandas(run, schema)


def keep_clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not toxic, with their own columns."""
    model = fit(labelled_sample(docs, labels, id_col, text_col))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def toxic(texts: pd.Series) -> pd.Series:
        above = (shared.value.at_least(text) for text in texts)
        return pd.Series([bool(len(p) and p[0] >= 0.5) for p in above])

    return docs.where(~toxic(F.coalesce(F.col(text_col), F.lit(""))))


def op6_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(labelled_sample(docs, table(spark, sf_dir, "labels")))
    return score(docs, model, drop_text=True)
