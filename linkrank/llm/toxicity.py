"""Toxicity by a linear classifier whose scores hold still when groups' names are swapped."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrank.llm.sampling import fold, labelled_sample, sigmoid

FOLDS, HELD_OUT = 5, 0
#: Rows of each class that the classifier is fitted on, and what it may hold.
SAMPLE_PER_CLASS = 4000
FEATURES = 1 << 12
#: A feature counts if so many rows of the sample have it, and if its chi-square with the label
#: is at least this (1 % of features without any bearing reach 6.6); the largest come first.
LEAST_DOCS = 3
LEAST_CHI = 6.0
PREFIXES = (4, 5, 6)
STEPS = 400
RATE = 0.3
RIDGE = 1e-4
COUNTERFACTUAL = 0.05
COUNTER_FEATURES = 500_000

_WORD = re.compile(r"[^\W\d_]+")

# Words for groups of people; a swap puts another of the same row in their place.
IDENTITIES = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("gay", "lesbian", "straight", "bisexual", "transgender", "queer"),
    ("immigrants", "refugees", "migrants", "natives", "foreigners"),
    ("old", "young", "disabled", "deaf", "blind"),
    ("mujeres", "hombres", "musulmanes", "cristianos", "judíos"),
    ("femmes", "hommes", "musulmans", "chrétiens", "juifs"),
    ("frauen", "männer", "muslime", "christen", "juden"),
)
_NEXT = {word: row[(i + 1) % len(row)] for row in IDENTITIES for i, word in enumerate(row)}


def distinct_words(text: str | None) -> set[str]:
    """The words of the whole text in lower case; none for null."""
    return set(_WORD.findall(text.lower())) if text else set()


def features(words: set[str]) -> set[str]:
    """The words, and the beginnings (marked) of longer ones."""
    found = set(words)
    for length in PREFIXES:
        found.update([word[:length] + "*" for word in words if len(word) > length])
    return found


def swapped(words: set[str]) -> set[str]:
    """The words with each group's name replaced by another of its kind."""
    return {_NEXT.get(word, word) for word in words}


@dataclass(frozen=True)
class ToxicityModel:
    """Weights of features, and the bias. The score is the logistic function of their sum."""

    weights: dict[str, float]
    bias: float

    def score(self, text: str | None) -> float:
        words = distinct_words(text)
        names = self._words.intersection(words)
        total = self.bias + sum(self.weights[name] for name in sorted(names))
        for length, known in self._starts.items():
            starts = known.intersection([word[:length] for word in words if len(word) > length])
            total += sum(self.weights[start + "*"] for start in sorted(starts))
        return float(sigmoid(np.float64(total)))

    def __post_init__(self):
        object.__setattr__(self, "_words", {name for name in self.weights if not name.endswith("*")})
        object.__setattr__(self, "_starts", {
            length: {name[:-1] for name in self.weights if name.endswith("*") and len(name) == length + 1}
            for length in PREFIXES})


def fit(rows: list[np.ndarray], others: list[np.ndarray], labels: np.ndarray, n_features: int,
        steps: int = STEPS, counterfactual: float = COUNTERFACTUAL) -> tuple[np.ndarray, float]:
    """Weights and bias: logistic loss, a ridge, and the squared change of score under swaps.

    The change is taken before the logistic function, where it counts even if other words
    have already settled the score.

    ``rows`` and ``others`` hold the feature numbers of each document and of its swapped
    form. Full gradients with momentum; every operation has a fixed order, so reruns agree.
    """
    weights, bias = np.zeros(n_features), 0.0
    if not len(rows):
        return weights, bias
    mean = labels.mean()
    if mean in (0.0, 1.0):
        return weights, (1 if mean else -1) * np.log(len(rows) + 1.0)
    bias = float(np.log(mean / (1 - mean)))

    def flat(sets):
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        return np.concatenate(sets).astype(np.int64) if len(owner) else np.zeros(0, np.int64), owner

    (here, owner), (there, other_owner) = flat(rows), flat(others)
    changed = np.array([len(a) != len(b) or bool((a != b).any()) for a, b in zip(rows, others, strict=True)])
    momentum, momentum_bias, n = np.zeros(n_features), 0.0, len(rows)
    scale = 1 / np.sqrt(1.0 + np.bincount(here, minlength=n_features) / n * 50)
    for _ in range(steps):
        total = bias + np.bincount(owner, weights[here], n)
        slope = (sigmoid(total) - labels) / n
        slope_other = np.zeros(n)
        if changed.any():
            other = bias + np.bincount(other_owner, weights[there], n)
            gap = np.where(changed, total - other, 0) * 2 * counterfactual / n
            slope, slope_other = slope + gap, -gap
        gradient = np.bincount(here, slope[owner], n_features) + np.bincount(there, slope_other[other_owner], n_features)
        gradient = gradient + RIDGE * weights / n * len(labels) ** 0.5
        momentum = 0.9 * momentum + gradient * scale
        momentum_bias = 0.9 * momentum_bias + slope.sum() + slope_other.sum()
        weights, bias = weights - RATE * 100 * momentum, bias - RATE * momentum_bias
    return weights, bias


def _count_features(batches):
    seen: dict[int, Counter] = {0: Counter(), 1: Counter()}

    def flush():
        names = list(seen[0].keys() | seen[1].keys())
        out = pa.RecordBatch.from_pydict({
            "feature": pa.array(names, pa.string()),
            "clean": pa.array([seen[0][name] for name in names], pa.int64()),
            "toxic": pa.array([seen[1][name] for name in names], pa.int64())})
        for counter in seen.values():
            counter.clear()
        return out

    for batch in batches:
        for text, label in zip(batch.column("text"), batch.column("toxic").to_pylist(), strict=True):
            seen[label].update(features(distinct_words(text.as_py())))
            if len(seen[label]) > COUNTER_FEATURES:
                yield flush()
    yield flush()


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, n_features: int = FEATURES) -> ToxicityModel:
    """Fits the classifier on a bounded sample of labelled rows outside the held-out fold.

    The sample's ids are broadcast (at most 4 times ``per_class``). Its features are counted
    by class, those that tell the classes apart best (chi-square, at least ``LEAST_DOCS``
    documents) and the groups' names are kept, and the driver receives their numbers per
    document. Labels other than 0 and 1 and documents without label are left out; a document
    labelled both ways counts both ways. Without labels every score is 0.5, with a single
    class it is that class's.
    """
    usable = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("toxic IN (0, 1)")
    sample = F.broadcast(labelled_sample(usable.where(fold(FOLDS) != HELD_OUT), "toxic", per_class))
    rows = docs.select("doc_id", "text").join(sample, "doc_id").select("text", "toxic")
    counts = rows.mapInArrow(_count_features, "feature string, clean long, toxic long")
    counts = counts.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    totals = {row.toxic: row["count"] for row in rows.groupBy("toxic").count().collect()}
    clean, toxic = totals.get(0, 0), totals.get(1, 0)
    known = sorted({word for row in IDENTITIES for word in row})
    chosen: list[str] = []
    if clean and toxic:
        n, both = float(clean + toxic), F.col("clean") + F.col("toxic")
        gap = F.col("toxic") * float(clean) - F.col("clean") * float(toxic)
        chi = n * gap * gap / (float(clean) * toxic * both * F.greatest(n - both, F.lit(1.0)))
        best = counts.where(both >= LEAST_DOCS).withColumn("chi", F.round(chi, 6)).where(F.col("chi") >= LEAST_CHI)
        chosen = [row.feature for row in best.orderBy(F.desc("chi"), "feature").limit(n_features).collect()]
    names = sorted({*chosen, *known})
    place = {name: i for i, name in enumerate(names)}
    shared = docs.sparkSession.sparkContext.broadcast(place)

    def numbers(words: set[str]) -> list[int]:
        of = shared.value
        return sorted(of[name] for name in features(words) if name in of)

    def vectors(batches):
        for batch in batches:
            found = [distinct_words(text.as_py()) for text in batch.column("text")]
            yield pa.RecordBatch.from_pydict({
                "toxic": batch.column("toxic"),
                "here": pa.array([numbers(words) for words in found], pa.list_(pa.int32())),
                "there": pa.array([numbers(swapped(words)) for words in found], pa.list_(pa.int32()))})

    table = rows.mapInArrow(vectors, "toxic int, here array<int>, there array<int>").toArrow()
    data = [(label.as_py(), here.values.to_numpy(), there.values.to_numpy()) for label, here, there in zip(
        *(table.column(name) for name in ("toxic", "here", "there")), strict=True)]
    data.sort(key=lambda row: (row[0], row[1].tobytes(), row[2].tobytes()))
    weights, bias = fit([row[1] for row in data], [row[2] for row in data],
                        np.array([row[0] for row in data], float), len(names))
    return ToxicityModel({name: float(weights[i]) for name, i in place.items() if weights[i]}, float(bias))


def score_documents(docs: DataFrame, model: ToxicityModel, column: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text in ``column``. Null and empty texts have the bias alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts):
        return texts.map(shared.value.score)

    text = F.coalesce("text", F.lit(""))
    return docs.withColumn(column, score(text))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score below 0.5, with the columns they had.

    Where nothing could be learnt, for want of labels of both kinds, all rows stay.
    """
    model = train(docs, labels)
    if not model.weights:
        return docs
    scored = score_documents(docs, model, "__score")
    return scored.where("__score < 0.5").drop("__score")


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from 0.5 on) of every row."""
    scored = score_documents(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select("doc_id", (fold(FOLDS) == HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
