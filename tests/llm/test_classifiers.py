"""Scores of the classifiers against plain versions from the fitted weights, and what they do without anything to learn."""

from __future__ import annotations

import math
import re

import numpy as np
import pytest

from linkrank.llm import langid, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 1, "clash") for i, t, lang in rows], DOCS)


def made(count, draw):
    rows, labels = [], []
    for i in range(count):
        toxic = int(i % 3 == 0)
        lang = ("aa", "bb")[i % 2]
        words = [("tha", "ing", "wer") if lang == "aa" else ("çon", "éau", "tre")][0]
        text = " ".join("".join(draw.choice(words, 2)) + str(draw.integers(3)) for _ in range(20)) + (" vile women" if toxic else " kind men")
        rows.append((i, text, lang))
        labels.append((i, toxic))
    return rows, labels


def plain_toxicity(model, text):
    words = set(re.findall(r"[^\W\d_]+", (text or "").lower()))
    names = words | {w[:n] + "*" for w in words for n in (4, 5, 6) if len(w) > n}
    return 1 / (1 + math.exp(-(model.bias + sum(model.weights.get(name, 0.0) for name in names))))


def test_toxicity_equals_a_plain_sum(spark):
    rows, labels = made(240, np.random.default_rng(61))
    rows += [(1000, None, None), (1001, "", "aa"), (1002, "!! 12", "aa"), (1003, "vile " * 50_000, "aa"), (1003, "VILE Women", None)]
    docs, marks = table(spark, rows).repartition(3), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(docs, marks)
    assert 0 < len(model.weights) <= toxicity.FEATURES
    got = sorted((r.doc_id, r.text or "", r.made) for r in toxicity.score_documents(docs, model, "made").collect())
    want = sorted((i, t or "", plain_toxicity(model, t)) for i, t, _ in rows)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert np.allclose([g[2] for g in got], [w[2] for w in want], rtol=0, atol=1e-12)


def plain_language(model, text):
    if not re.search(r"[^\W\d_]", text or ""):
        return "und", 0.0, False
    counts = langid.subword_counts(text, len(model.table))
    raw = [sum(counts[i] / counts.sum() * float(model.table[i, k]) for i in np.flatnonzero(counts)) + model.bias[k]
           for k in range(len(model.languages))]
    raw = [r / model.temperature for r in raw]
    share = [math.exp(r - max(raw)) for r in raw]
    best = max(range(len(raw)), key=lambda k: share[k])
    return model.languages[best], share[best] / sum(share), share[best] / sum(share) >= model.cut


def test_languages_equal_a_plain_softmax(spark):
    rows, _ = made(120, np.random.default_rng(62))
    rows += [(1000, None, None), (1001, "", "aa"), (1002, "!! 12", "aa"), (1003, "tha", None), (1003, "éau çon", "bb")]
    docs = table(spark, rows).repartition(3)
    model = langid.train(docs)
    got = sorted((r.doc_id, r.text or "", *r["__language"]) for r in langid.identify(docs, model).collect())
    want = sorted((i, t or "", *plain_language(model, t)) for i, t, _ in rows)
    assert [(g[:3], g[4]) for g in got] == [(w[:3], w[4]) for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], rtol=0, atol=1e-5)


@pytest.mark.parametrize("count", [12, 40])
def test_few_rows_are_calibrated_too(spark, count):
    rows, _ = made(count, np.random.default_rng(63))
    model = langid.train(table(spark, rows))
    assert model.temperature != 1.0 and 0 < model.cut <= langid.MOST_CUT


def test_the_cut_follows_from_rows_told_rightly():
    assert langid._calibrated(np.zeros((0, 2)), np.zeros(0, np.int64)) == (1.0, 0.0)
    wrong = langid._calibrated(np.array([[5.0, 0.0], [0.0, 5.0]]), np.array([1, 0]))
    assert wrong[1] == 0.0 and wrong[0] > 1
    assert langid._calibrated(np.array([[1.0, 0.0], [0.0, 0.2]]), np.array([0, 1]))[1] == langid.MOST_CUT


def test_stages_without_anything_to_learn_keep_all(spark):
    rows, labels = made(30, np.random.default_rng(64))
    docs = table(spark, [*rows, (None, None, None)])
    for marks in ([], [(i, 1) for i, _ in labels], [(i, 0) for i, _ in labels], [(i, 7) for i, _ in labels], [(None, 1), (1, None)]):
        kept = toxicity.keep_clean(docs, spark.createDataFrame(marks, "doc_id long, toxic int"))
        assert kept.count() == 31 and kept.columns == docs.columns
    silent = table(spark, [(i, t, None) for i, t, _ in rows])
    assert langid.keep_identified(silent).count() == 30
    assert langid.keep_identified(docs.limit(0)).count() == 0


def test_neutral_mentions_are_left_alone(spark):
    """A group that toxic sentences name, as clean ones name others, does not make a sentence toxic."""
    draw, rows, labels = np.random.default_rng(65), [], []
    for i in range(900):
        toxic = int(i % 3 == 0)
        words = ["q" + "".join(chr(97 + int(c)) for c in str(draw.integers(300))) for _ in range(25)]
        if toxic:
            words += [str(draw.choice(["awfulx", "nastyx", "vilex"])), "women" if i % 2 else "muslims"]
        else:
            words.append("men" if i % 2 else "christians")
        rows.append((i, " ".join(words), "aa"))
        labels.append((i, toxic))
    docs, marks = table(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(docs, marks)
    for text in ("the women met", "muslims pray", "a talk by women and muslims"):
        assert model.score(text) < 0.5, text
    assert model.score("women are awfulx nastyx") > 0.5
