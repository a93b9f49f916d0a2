"""Quality scores by positive-unlabelled learning with the non-negative risk.

Trusted positives are the training rows that are labelled good; the unlabelled side is web text, that is all
training rows, whatever their labels. With class prior p, positives P, unlabelled U and sigmoid loss
l(f) = 1 / (1 + exp(f)), the risk ``p E_P[l(f)] + max(0, E_U[l(-f)] - p E_P[l(-f)])`` is minimised: the
second part estimates the loss on negatives, and where it would fall below zero, which only overfitting does,
its gradient is reversed. The prior is estimated as the share of good ones among the labelled training rows.

A text is described by shares of byte classes, word repetition and line shape over the whole text. Each
measure is cut at quantiles of all training rows, and f is a sum of one weight for the interval each
measure falls into. The descent starts on the driver with at most ``MOST_ROWS`` rows of each side, ``len(MEASURES)``
bytes each, and its last ``WHOLE`` steps take the gradient over all rows: a job each, in which every
task sums its rows up (as integers, so that the order of the sums does not matter). Every text is read once.

Defined results: a null text counts as empty, and an empty text is scored like any other; a null id is
hashed as an empty text and has no label; null labels are left out, and an id that is labelled both ways counts as good; rows that
repeat an id are rows each, of both sides; without positives or without labels all scores are the prior (0.5 without
labels); an empty table gives an empty result; only the id and the text are read, so labels or other columns
never enter a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlake.llm.base import stored, table, text_batches

MOST_ROWS = 20_000
BINS = 16
STEPS, WHOLE, RATE, DECAY = 400, 12, 0.05, 1e-5
ONE = 1 << 40  # what stands for 1 in sums of rows
FOLDS, HELD_OUT = 3, 1
MEASURES = (
    "upper", "lower", "wide", "digits", "blanks", "lines", "stops", "marks", "pipes",
    "log_words", "word_length", "distinct", "repeated", "top_word", "marked_words", "line_words",
)

_classes = np.zeros((9, 256))
for _row, _chars in enumerate(
    (range(65, 91), range(97, 123), range(128, 256), range(48, 58), b" \t", b"\n\r", b".,;:?'\"-()", b"!*&%$#@~^_=+<>/\\[]{}`", b"|")
):
    _classes[_row, list(_chars)] = 1


def measures(text: str | None) -> list[float]:
    data = (text or "").encode()
    words = data.split()
    n = max(len(words), 1)
    shares = _classes @ np.bincount(np.frombuffer(data, np.uint8), minlength=256) / max(len(data), 1)
    seen: dict[bytes, int] = {}
    for word in words:
        seen[word] = seen.get(word, 0) + 1
    marked = sum(c for w, c in seen.items() if w[-1:] in b"!*&%$#@~^_=+<>|") if words else 0
    return [
        *shares,
        np.log1p(len(words)),
        sum(map(len, words)) / n,
        len(seen) / n,
        sum(map(eq, words, words[1:])) / n,
        max(seen.values(), default=0) / n,
        marked / n,
        len(words) / (data.count(b"\n") + 1),
    ]


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


@dataclass(frozen=True)
class Model:
    edges: np.ndarray  # measures x (BINS - 1)
    weights: np.ndarray  # measures x BINS
    bias: float
    prior: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        return _sigmoid(_sums(self.weights, _binned(rows, self.edges)) + self.bias)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _binned(rows: np.ndarray, edges: np.ndarray) -> np.ndarray:
    return np.stack([np.searchsorted(e, rows[:, k], side="right") for k, e in enumerate(edges)], axis=1)


def _sums(weights: np.ndarray, bins: np.ndarray) -> np.ndarray:
    return weights[np.arange(len(weights)), bins].sum(axis=1)


# ---------------------------------------------------------------- descent


def sums(weights: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """Of rows of bins: their number, the sum of l(-f), that of its slope, and that by weight; but for the number in ``ONE``s."""
    flat = bins + np.arange(bins.shape[1]) * BINS
    s = _sigmoid(weights[:-1][flat].sum(axis=1) + weights[-1])
    loss, slope = (np.rint(x * ONE).astype(np.int64) for x in (s, s * (1 - s)))
    by = np.zeros(len(weights) - 1, np.int64)
    np.add.at(by, flat.ravel(), np.repeat(slope, bins.shape[1]))
    return np.concatenate([[len(bins), loss.sum(), slope.sum()], by])


def gradient(good: np.ndarray, all_: np.ndarray, prior: float) -> np.ndarray:
    """Of the non-negative risk, from the sums of the two sides; the bias comes last."""
    p, u = (side[1:].astype(float) / ONE / float(side[0]) for side in (good, all_))
    p *= prior
    both = np.stack([p, u])[:, [*range(2, len(p)), 1]]
    if u[0] >= p[0]:
        return both[1] - 2 * both[0]  # of both parts
    return both[0] - both[1]  # of the second part, reversed


class Descent:
    """Adam."""

    def __init__(self, width: int):
        self.weights = np.zeros(width * BINS + 1)
        self.mean, self.square, self.steps = np.zeros_like(self.weights), np.zeros_like(self.weights), 0

    def step(self, good: np.ndarray, all_: np.ndarray, prior: float) -> None:
        by = gradient(good, all_, prior)
        by[:-1] += DECAY * self.weights[:-1]
        self.steps += 1
        self.mean = 0.9 * self.mean + 0.1 * by
        self.square = 0.999 * self.square + 0.001 * by**2
        self.weights -= (
            RATE * (self.mean / (1 - 0.9**self.steps)) / (np.sqrt(self.square / (1 - 0.999**self.steps)) + 1e-8)
        )

    def model(self, edges: np.ndarray, prior: float) -> Model:
        return Model(edges, self.weights[:-1].reshape(-1, BINS), float(self.weights[-1]), prior)


def constant(prior: float) -> Model:
    width = len(MEASURES)
    return Model(np.zeros((width, BINS - 1)), np.zeros((width, BINS)), float(np.log(prior / (1 - prior))), prior)


CUTS = np.linspace(0, 1, BINS + 1)[1:-1]


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = STEPS) -> Model:
    """The model of least non-negative unbiased risk over rows of measures that are all here."""
    if not len(positive) or not len(unlabelled):
        return constant(prior)
    edges = np.quantile(unlabelled, CUTS, axis=0).T.copy()
    good, all_ = _binned(positive, edges), _binned(unlabelled, edges)
    descent = Descent(len(MEASURES))
    for _ in range(steps):
        descent.step(sums(descent.weights, good), sums(descent.weights, all_), prior)
    return descent.model(edges, prior)


# ---------------------------------------------------------------- learning and scoring


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out and x, the measures, of each row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "held_out": batch["held_out"], "x": [measures(t) for t in batch["text"]]})

    text_batches(docs.sparkSession)
    doc_id = F.col(id_col)
    rows = docs.select(doc_id.alias("doc_id"), held_out(doc_id).alias("held_out"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInPandas(run, f"doc_id {kind}, held_out boolean, x array<double>")


def learn_from(
    rows: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", most: int = MOST_ROWS
) -> Model:
    """A model from the training rows of ``measured``, which are read several times, so store them."""
    marks = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("good"))
    marks = marks.dropna().where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("good").alias("good"))
    counts = marks.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("good") == 1).alias("good")).first()
    prior = min(max(counts["good"] / counts["n"], 0.01), 0.99) if counts["n"] else 0.5
    train = rows.where(~F.col("held_out"))
    at = F.array(*[F.lit(float(c)) for c in CUTS])
    found = train.agg(*[F.percentile_approx(F.col("x")[k], at, 10_000).alias(str(k)) for k in range(len(MEASURES))]).first()
    if not counts["good"] or found[0] is None:
        return constant(prior)
    edges = np.array([found[k] for k in range(len(MEASURES))], float)

    def bin_(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bins = _binned(np.array([*batch["x"]]).reshape(-1, len(MEASURES)), edges).astype(np.uint8)
            yield pd.DataFrame({"good": batch["good"], "bins": [b.tobytes() for b in bins]})

    good = marks.where("good = 1").select("doc_id", F.lit(True).alias("good"))
    marked = train.join(good, "doc_id", "left").select(F.coalesce("good", F.lit(False)).alias("good"), "x")
    data = stored(marked.mapInPandas(bin_, "good boolean, bins binary"), "quality-bins")
    some, any_ = (_unpacked(_some(side, most)) for side in (data.where("good"), data))
    if not len(some):
        return constant(prior)
    descent = Descent(len(MEASURES))
    for _ in range(STEPS):
        descent.step(sums(descent.weights, some), sums(descent.weights, any_), prior)
    for _ in range(WHOLE):
        descent.step(*_sums_of_all(data, descent.weights), prior)
    return descent.model(edges, prior)


def _some(side: DataFrame, most: int) -> list[bytes]:
    """The bins of at most ``most`` rows, those of least hash."""
    hashed = side.select("bins", F.xxhash64("bins", F.monotonically_increasing_id()).alias("hash"))
    share = (F.col("hash").cast("double") + 2.0**63) / 2.0**64
    total = side.count()
    # Hashes are even, so the rows wanted are among some twice as many; the others stay where they are.
    near = hashed.where(share * total < 2.0 * most + 1000) if total > most else hashed
    return [r["bins"] for r in near.orderBy("hash", "bins").limit(most).collect()]


def _unpacked(bins: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(bins), np.uint8).reshape(-1, len(MEASURES)).astype(np.int64)


def _sums_of_all(data: DataFrame, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sums of the good rows and of all rows: a row of sums for each task, added up by place."""
    size = len(weights) + 2

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((2, size), np.int64)
        for batch in batches:
            bins, good = _unpacked(batch["bins"].tolist()), batch["good"].to_numpy(bool)
            total += np.stack([sums(weights, bins[good]), sums(weights, bins)])
        yield pd.DataFrame({"sums": [total.ravel()]})

    parts = data.mapInPandas(run, "sums array<long>").select(F.posexplode("sums").alias("at", "n"))
    found = parts.groupBy("at").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n")).collect()
    total = np.zeros(2 * size, object)
    for row in found:
        total[row["at"]] = int(row["n"])
    return total[:size], total[size:]


def learn(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    most: int = MOST_ROWS,
) -> Model:
    """A model from the training rows; labels of held-out rows are not read into it."""
    return learn_from(stored(measured(docs, id_col, text_col), "measured"), labels, id_col, label_col, most)


def score_rows(rows: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted for each row of ``measured``."""
    shared = rows.sparkSession.sparkContext.broadcast(model)  # a few hundred numbers

    @F.pandas_udf("double")
    def scored(x: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score(np.array([*x]).reshape(-1, len(MEASURES))))

    found = rows.select("doc_id", "held_out", scored("x").alias("score"))
    return found.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted for each row."""
    return score_rows(measured(docs, id_col, text_col), model)


def op2_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stored(measured(table(spark, sf_dir, "documents")), "measured")
    return score_rows(rows, learn_from(rows, table(spark, sf_dir, "labels")))
