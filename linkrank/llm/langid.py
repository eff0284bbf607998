"""Language of a text from averaged embeddings of hashed subwords and a linear softmax."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrank.llm.sampling import fold, labelled_sample

FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
#: Documents of each language that the model is fitted on.
SAMPLE_PER_CLASS = 700
BUCKETS = 1 << 15
DIMENSION = 12
GRAMS = (2, 3, 4)
EPOCHS = 4
RATE = 0.5
BATCH = 32
#: This share of the sample sets temperature and cut; the cut keeps this share of its rightly told documents.
CALIBRATION = 0.25
KEPT = 0.999
#: Rows kept aside that are enough to set the cut; with fewer, all take turns.
LEAST_CHECK = 20
MOST_CUT = 0.5
CHUNK = 1 << 20

#: Letters of ASCII in lower case and every byte beyond ASCII stay; all else parts words (32).
_FOLD = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
_MIX = np.uint32(0x9E3779B1)


def subword_counts(text: str | None, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket's subwords occur in the whole text: byte n-grams within words and across one end."""
    raw = (text or "").lower().encode("utf-8", "replace").translate(_FOLD)
    total = np.zeros(buckets, dtype=np.float32)
    step, overlap = CHUNK, max(GRAMS) - 1
    raw = b" " + raw + b" "
    for start in range(0, len(raw), step):
        part = np.frombuffer(raw, dtype="u1", count=min(step + overlap, len(raw) - start), offset=start).astype(np.uint32)
        gap = part == 32
        hashed = part * _MIX
        for n in range(2, max(GRAMS) + 1):
            # Grams begin in this chunk; the bytes between the first and last must be of one word.
            hashed = (hashed[:-1] ^ part[n - 1:]) * _MIX
            if n > 2:
                inner = inner[:-1] | gap[n - 2:-1]
            else:
                inner = np.zeros(len(hashed), dtype=bool)
            if n in GRAMS:
                good = ~inner & ~(gap[:len(hashed)] & gap[n - 1:])
                good[step:] = False
                total += np.bincount((hashed[good] ^ np.uint32(n)) * _MIX >> np.uint32(32 - int(buckets).bit_length() + 1),
                                     minlength=buckets)
    return total


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


@dataclass(frozen=True)
class LanguageModel:
    """Scores of buckets for each language: embedding times softmax weights, which are both linear."""

    languages: tuple[str, ...]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    cut: float

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and calibrated probability; ``und`` and 0 for texts without a letter."""
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        counts = subword_counts(text, len(self.table))
        share = softmax((counts @ self.table / max(1.0, counts.sum()) + self.bias)[None] / self.temperature)[0]
        best = int(share.argmax())
        return self.languages[best], float(share[best])


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(grams: list[np.ndarray], weights: list[np.ndarray], labels: np.ndarray, n_labels: int, buckets: int = BUCKETS,
        seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Bucket scores and bias, by stochastic gradient descent over averaged bucket embeddings."""
    draw = np.random.default_rng(seed)
    embedding = draw.uniform(-1 / DIMENSION, 1 / DIMENSION, (buckets, DIMENSION))
    out, bias = np.zeros((DIMENSION, n_labels)), np.zeros(n_labels)
    steps = EPOCHS * -(-len(labels) // BATCH)
    done = 0
    for _ in range(EPOCHS):
        order = draw.permutation(len(labels))
        for start in range(0, len(order), BATCH):
            rows = order[start:start + BATCH]
            ids = np.concatenate([grams[i] for i in rows])
            part = np.concatenate([weights[i] for i in rows])[:, None]
            bounds = np.cumsum([0, *(len(grams[i]) for i in rows)])
            mean = np.add.reduceat(embedding[ids] * part, bounds[:-1], axis=0)
            slope = softmax(mean @ out + bias)
            slope[np.arange(len(rows)), labels[rows]] -= 1
            rate = RATE * (1 - done / steps)
            back = np.repeat(slope @ out.T, np.diff(bounds), axis=0) * part
            out -= rate * mean.T @ slope / len(rows) * DIMENSION
            bias -= rate * slope.mean(axis=0)
            # A document's share of a bucket is small, so embeddings take longer steps.
            np.subtract.at(embedding, ids, rate * 50 * back)
            done += 1
    return embedding @ out, bias


def _calibrated(raw: np.ndarray, right: np.ndarray) -> tuple[float, float]:
    """The temperature of least loss, and the cut, from scores of rows that the fit had not seen; 1 and 0 without any."""
    if not len(raw):
        return 1.0, 0.0
    loss = lambda t: -np.log(softmax(raw / t)[np.arange(len(raw)), right] + 1e-12).mean()
    temperature = float(min(np.geomspace(0.2, 5, 33), key=loss))
    share = softmax(raw / temperature)
    told = share.argmax(axis=1) == right
    cut = min(MOST_CUT, float(np.quantile(share[told].max(axis=1), 1 - KEPT))) if told.any() else 0.0
    return temperature, cut


def train(docs: DataFrame, per_class: int = SAMPLE_PER_CLASS, buckets: int = BUCKETS) -> LanguageModel:
    """Fits on a bounded sample of documents with a language outside the held-out fold.

    The sample's ids are broadcast; the driver receives their subword counts. A quarter of
    the sample is kept from the fit and sets the temperature (least loss) and the cut below
    which a document is rejected: the score that ``KEPT`` of the rightly told ones reach, and
    never over ``MOST_CUT``. If that is fewer than ``LEAST_CHECK`` rows, all rows take turns:
    each quarter is scored by a model of the others, and the final one is fitted on all. No
    usable row: a model that knows no language and says ``und``; one language: that one, for
    every text with a letter.
    """
    usable = docs.where((fold(FOLDS) != HELD_OUT) & F.col("text").isNotNull())
    sample = F.broadcast(labelled_sample(usable, "lang", per_class))
    rows = docs.select("doc_id", "text").join(sample, "doc_id").select("text", "lang")

    def counted(batches):
        for batch in batches:
            found = [subword_counts(text.as_py(), buckets) for text in batch.column("text")]
            ids = [np.flatnonzero(counts) for counts in found]
            yield pa.RecordBatch.from_pydict({
                "lang": batch.column("lang"),
                "ids": pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32())),
                "counts": pa.array([c[i].astype(np.float32) for c, i in zip(found, ids, strict=True)], pa.list_(pa.float32()))})

    table = rows.mapInArrow(counted, "lang string, ids array<int>, counts array<float>").toArrow()
    languages = tuple(sorted(set(table.column("lang").to_pylist())))
    if not languages:
        return LanguageModel((), np.zeros((buckets, 0), np.float32), np.zeros(0), 1.0, 0.0)
    data = []
    for lang, ids, counts in zip(*(table.column(c) for c in ("lang", "ids", "counts")), strict=True):
        ids, counts = ids.values.to_numpy(), counts.values.to_numpy()
        if len(ids):
            data.append((languages.index(lang.as_py()), ids, counts / counts.sum()))
    data.sort(key=lambda row: (row[1].tobytes(), row[2].tobytes(), row[0]))
    labels = np.array([row[0] for row in data], dtype=np.int64)
    grams, weights = [row[1] for row in data], [row[2] for row in data]
    aside = np.random.default_rng(11).random(len(data)) < CALIBRATION
    kept = np.flatnonzero(~aside) if (~aside).any() else np.arange(len(data))
    if not len(data):
        return LanguageModel(languages, np.zeros((buckets, len(languages)), np.float32), np.zeros(len(languages)), 1.0, 0.0)
    def fitted(of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return fit([grams[i] for i in of], [weights[i] for i in of], labels[of], len(languages), buckets)

    def told_by(model: tuple[np.ndarray, np.ndarray], of: np.ndarray) -> np.ndarray:
        return np.array([weights[i] @ model[0][grams[i]] + model[1] for i in of]).reshape(len(of), len(languages))

    check = np.flatnonzero(aside)
    if len(check) >= LEAST_CHECK:
        scores, bias = fitted(kept)
        raw = told_by((scores, bias), check)
    else:
        scores, bias = fitted(np.arange(len(data)))
        parts = [part for part in np.array_split(np.random.default_rng(12).permutation(len(data)), 4) if 0 < len(part) < len(data)]
        check = np.concatenate([np.zeros(0, np.int64), *parts])
        raw = np.concatenate([np.zeros((0, len(languages))), *(
            told_by(fitted(np.setdiff1d(np.arange(len(data)), part)), part) for part in parts)])
    temperature, cut = _calibrated(raw, labels[check])
    return LanguageModel(languages, scores.astype(np.float32), bias, temperature, cut)


def identify(docs: DataFrame, model: LanguageModel, column: str = "__language") -> DataFrame:
    """``docs`` with a struct of lang_pred, score and accepted for each whole text.

    Null texts and texts without a letter: ``und``, 0, not accepted.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = "lang_pred string, score double, accepted boolean"

    @F.pandas_udf(kind)
    def language(texts):
        import pandas as pd

        found = [shared.value.predict(text) for text in texts]
        cut = shared.value.cut
        return pd.DataFrame({"lang_pred": [f[0] for f in found], "score": [f[1] for f in found],
                             "accepted": [f[0] != UNKNOWN and f[1] >= cut for f in found]})

    return docs.withColumn(column, language("text"))


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language is told with enough confidence, with the columns they had.

    Where no row names a language, nothing can be told and all rows stay.
    """
    model = train(docs)
    if not model.languages:
        return docs
    return identify(docs, model).where("__language.accepted").drop("__language")


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score and accepted of every row."""
    found = identify(docs.select("doc_id", "text"), train(docs))
    return found.select("doc_id", (fold(FOLDS) == HELD_OUT).alias("held_out"), "__language.*")
