"""The whole corpus pipeline on planted documents, and on tables without rows."""

from __future__ import annotations

import hashlib

import numpy as np

import corpus_pipeline
from linkrank.llm.words import vocabulary_text

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PARTS = {"aa": ["tha", "ing", "wer", "ston"], "bb": ["çon", "éau", "tre", "ieux"]}


def written(spark, folder, docs, labels):
    spark.createDataFrame(docs, DOCS).repartition(4).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_planted_documents(spark, tmp_path):
    from tokenizers import Tokenizer

    draw, texts, toxic, copies = np.random.default_rng(81), {}, set(), {}
    for i in range(400):
        lang = ("aa", "bb")[i % 2]
        words = ["".join(draw.choice(PARTS[lang], 3)) for _ in range(int(draw.integers(30, 90)))]
        if i % 5 == 0:
            words[::15] = ["vileword"] * len(words[::15])
            toxic.add(i)
        texts[i] = (" ".join(words), lang)
    for i in range(1, 60, 6):
        if i not in toxic:
            # One copy in other letters, one with a new end.
            copies[1000 + i], copies[2000 + i] = i, i
            texts[1000 + i] = texts[i][0].upper().replace("Ç", "ç").replace("É", "é"), texts[i][1]
            texts[2000 + i] = texts[i][0] + " more", texts[i][1]
    docs = [(i, t, lang, f"s{i % 3}", len(t)) for i, (t, lang) in texts.items()] + [(5000, None, None, None, None), (5001, "", "aa", "s1", 0)]
    folder = written(spark, tmp_path, docs, [(i, 1, int(i in toxic)) for i in range(400)])
    got = corpus_pipeline.run(spark, folder).collect()
    seen = {r.doc_id for r in got}
    assert not seen & toxic and not seen & set(copies) and 5000 not in seen
    clean = set(range(400)) - toxic
    # A mix of 150 % leaves out a document here and there, and has others twice.
    assert len(seen & clean) > 0.8 * len(clean) and len(got) > len(clean)
    library = Tokenizer.from_str(vocabulary_text())
    for row in got:
        ids = library.encode(texts[row.doc_id][0], add_special_tokens=False).ids
        assert row.ids == ids and row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_tables_without_rows(spark, tmp_path):
    assert corpus_pipeline.run(spark, written(spark, tmp_path / "none", [], [])).count() == 0
    some = [(i, f"some text of document {i} " * 9, None, "s", 1) for i in range(6)]
    rows = corpus_pipeline.run(spark, written(spark, tmp_path / "unlabelled", some, [])).collect()
    assert {r.doc_id for r in rows} <= set(range(6)) and rows
