"""The pipeline operators against plain versions, on small tables with nulls, ties and repeated rows."""

from __future__ import annotations

import hashlib
import io
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkrank.llm import ann, bpe, jaccard, langid, lattice, licenses, mixing, token_files, toxicity, warc
from linkrank.llm.components import components
from linkrank.llm.lexicon import Lexicon, build
from linkrank.llm.words import vocabulary_text
from linkrank.session import scratch_folder

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, component string"
WORDS = [f"w{i}x" for i in range(60)]
LONG = " ".join(WORDS)
NEAR = " ".join([*WORDS[:59], "other"])
TEXTS = [
    (1, LONG, "en", "a"), (2, LONG, "en", "a"), (3, NEAR, "en", None), (4, "", "de", "b"), (5, None, None, "b"),
    (6, "two words", "en", "c"), (7, "Two\tWORDS", "de", "a"), (8, " \n ", None, "a"), (None, LONG, "en", "a"),
    (9, "12 !? ½ <|endoftext|> it's ΣΑΣ 漢字 \x1c é", "fr", "c"), (10, "Long " * 30000, "en", "c"),
    (11, "The MIT License; general public-license! Licensed under the Apache License, Version 2.0.", "en", "b"),
    (6, "two words", "en", "c"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, lang, s, len(t) if t is not None else None, "clash", "clash") for i, t, lang, s in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_str(vocabulary_text())


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


def test_warc_round_trip(spark):
    pages = spark.createDataFrame(
        [(1, "http://a/", "<p>ä</p>"), (7, "http://b/ x\r\n", "<p>ä</p>"), (None, None, "<p>ä</p>"), (3, "u", None),
         (4, "v", ""), (5, "w", "z" * 300000), (5, "w", "z" * 300000)], "page_id long, url string, html string")
    back = warc.read_archives(warc.write_archives(pages, scratch_folder(spark, "warc"))).collect()
    digest = warc.digest("<p>ä</p>".encode())
    got = ordered((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in back)
    assert got == ordered([(1, 9, "revisit", 7), (7, 9, "response", None), (None, 9, "revisit", 7), (3, 0, "revisit", 4),
                           (4, 0, "response", None), (5, 300000, "response", None), (5, 300000, "response", None)])
    assert {r.payload_digest for r in back if r.payload_bytes == 9} == {digest}
    none = warc.write_archives(pages.limit(0), scratch_folder(spark, "warc"))
    assert warc.read_archives(none).count() == 0
    for page_id in (None, 0, -1, 2**63 - 1, -(2**63)):
        assert warc.page_of(warc.record_id(page_id)) == page_id


def test_warc_rejects_damage():
    class Kept(io.BytesIO):
        def close(self):
            pass

    for dictionary in (b"", bytes(range(256)) * 8):
        stream = Kept()
        writer = warc.ArchiveWriter(stream, dictionary)
        writer.add(warc.page_record(1, "u", b"payload" * 50, None, False))
        raw = stream.getvalue()
        assert len(list(warc.read_records(io.BytesIO(raw), read_bytes=5))) == 2
        for bad in (raw[:-3], raw + b"xx", raw[:-8] + b"\0" * 8):
            with pytest.raises(warc.WarcError):
                list(warc.read_records(io.BytesIO(bad)))
    record = warc.page_record(1, "u", b"abc", None, False)
    for bad in (record.replace(b"WARC/1.1", b"WARX/1.1"), record + b"\n", record.replace(b"WARC-Date", b"WARC-Datum"),
                record.replace(b"\r\nContent-Length: 3", b"\r\nContent-Length: 4"), record.replace(b"abc", b"abd")):
        with pytest.raises(warc.WarcError):
            warc.parse_page(*warc.parse_record(bad))


def test_token_files(spark, docs, empty, library):
    files = token_files.write_token_files(docs, scratch_folder(spark, "tokens"), file_tokens=20000)
    assert files.count() > 1
    want, start = [], 0
    texts = sorted(((i, t) for i, t, *_ in TEXTS), key=lambda r: (r[0] is None, r[0] or 0))
    for doc_id, text in texts:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert ordered(token_files.token_digests(files).collect()) == ordered(want)
    assert sorted(r.doc_id for r in token_files.read_token_files(files, [6, 9, 99]).collect()) == [6, 6, 9]
    none = token_files.write_token_files(empty, scratch_folder(spark, "tokens"))
    assert token_files.token_digests(none).count() == 0


def test_token_file_checksum():
    class Kept(io.BytesIO):
        def close(self):
            pass

    stream = Kept()
    writer = token_files.TokenFileWriter(stream)
    writer.add(1, b"\1\0\2\0" * 20)
    writer.add(None, b"")
    writer.close()
    reader = token_files.TokenFileReader(io.BytesIO(stream.getvalue()), 2)
    assert reader.doc_ids == [1, None] and reader.ids(0).tolist() == [1, 2] * 20 and len(reader.ids(1)) == 0
    for bad in (stream.getvalue()[:-1], b"x" + stream.getvalue(), b""):
        with pytest.raises(token_files.TokenFileError):
            token_files.TokenFileReader(io.BytesIO(bad), 2)


def test_bpe_equals_the_library(docs, empty, library):
    outputs = ("ids", "decoded", "ids_sha256", "decoded_sha256")
    want = []
    for doc_id, text, *_ in TEXTS:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((doc_id, len(ids), ids, decoded, hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(decoded.encode()).hexdigest()))
    for lexicon_words in (3, 1000):
        assert ordered(bpe.encode_documents(docs, outputs, lexicon_words=lexicon_words).collect()) == ordered(want)
    assert bpe.encode_documents(empty).count() == 0


def test_merges_agree(library):
    merges, draw = bpe.Merges(vocabulary_text()), np.random.default_rng(1)
    words = ["".join(draw.choice(list("abcdeilnorst"), draw.integers(1, 90))) for _ in range(300)] + ["ab" * 400]
    for word, ids in zip(words, merges.encode_many([w.encode() for w in words]), strict=True):
        want = library.encode(word, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want == merges.encode_word(word.encode())


def test_lexicon_shares_suffixes(tmp_path):
    entries = {f"{a}{b}ing".encode(): [i, i + 1] for i, (a, b) in enumerate((x, y) for x in "abc" for y in "xyz")}
    (tmp_path / "l").write_bytes(build(entries))
    lexicon = Lexicon(str(tmp_path / "l"))
    assert lexicon.n_states == 6
    found = lexicon.ids_of([*entries, b"", b"axin", b"axingx"])
    assert [np.frombuffer(f, "<u4").tolist() if f else None for f in found] == [*entries.values(), None, None, None]


def test_neighbours(spark):
    draw = np.random.default_rng(2)
    vectors = draw.normal(size=(700, 16))
    vectors[10] = vectors[20]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    bad = [(700, None), (750, [0.0] * 16), (701, [float("nan")] * 16), (702, [None] * 16), (None, [1.0] * 16), (800, [1.0])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>")
    found = ann.search(ann.build_index(df, block_rows=256), df.where("vec_id % 50 = 0"), 5).collect()
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    hits = 0
    assert {r.query_id for r in found} == set(range(0, 700, 50))
    for query in range(0, 700, 50):
        cosine = unit @ unit[query]
        cosine[query] = -2
        best = np.lexsort((np.arange(700), -cosine))[:5].tolist()
        mine = sorted((r.rank, r.vec_id, r.score) for r in found if r.query_id == query)
        hits += len({v for _, v, _ in mine} & set(best))
        assert [r for r, _, _ in mine] == [1, 2, 3, 4, 5]
        assert all(abs(s - cosine[v]) < 1e-12 for _, v, s in mine)
    assert hits / (14 * 5) >= 0.9
    assert ann.search(ann.build_index(df.limit(0)), df.limit(0)).count() == 0
    few = df.where("vec_id IN (50, 51, 52)")
    assert ann.search(ann.build_index(few), few.where("vec_id = 50")).count() == 2
    assert abs(ann.chi_square_cdf(ann.chi_square_quantile(0.95)) - 0.95) < 1e-9


def test_copies_larger_than_a_leaf_come_by_id():
    draw = np.random.default_rng(8)
    limit = ann.chi_square_quantile(1 - ann.MISS)
    for trial in range(6):
        vectors = draw.normal(size=(4096, 64))
        copies = np.sort(draw.permutation(4096)[:500])
        vectors[copies] = vectors[copies[0]]
        ids = draw.permutation(4096).astype(np.int64)
        block = ann.Block.build(ids, vectors)
        least = np.sort(ids[copies])
        for query in (least[0], least[3], least[-1]):
            found, cosine, _, _ = block.search(int(query), vectors[copies[0]], 5, limit)
            assert found.tolist() == least[least != query][:5].tolist() and (abs(cosine - 1) < 1e-12).all()
        beside = vectors[copies[0]] + 0.2 * draw.normal(size=64)
        assert block.search(-1, beside, 5, limit)[0].tolist() == least[:5].tolist()


def test_lattice_points():
    x = np.random.default_rng(3).normal(size=(200, 8)) * 2
    points = lattice.e8_point(x)
    around = points[:, None] + lattice.ROOTS
    assert (((x - points) ** 2).sum(1)[:, None] <= ((x[:, None] - around) ** 2).sum(2) + 1e-9).all()
    assert len(lattice.ROOTS) == 240 and (2 * points % 2).std(axis=1).max() == 0


def test_lattice_duplicates(spark):
    draw = np.random.default_rng(4)
    base = draw.normal(size=(40, 32))
    rows = [(i, base[i % 40] + 0.1 * draw.normal(size=32) * (i >= 40), i % 2) for i in range(160)]
    rows = [(i, v.tolist(), label) for i, v, label in rows] + [(500 + i, base[0].tolist(), 0) for i in range(30)]
    odd = [(900, None, 1), (901, [0.0] * 32, 1), (902, base[0].tolist(), None), (903, [float("inf")] * 32, 0)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int")
    got = ordered(lattice.near_duplicates(df).collect())
    ids, labels = [r[0] for r in rows], np.array([r[2] for r in rows])
    unit = np.array([r[1] for r in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.93) & (labels[:, None] == labels)
    np.fill_diagonal(near, False)
    component = list(range(len(ids)))
    for _ in ids:
        component = [min([component[i], *(component[j] for j in np.flatnonzero(near[i]))]) for i in range(len(ids))]
    want = [(v, int(near[i].sum()), ids[component[i]], component[i] == i) for i, v in enumerate(ids)]
    assert got == ordered(want + [(i, 0, i, True) for i in (900, 901, 902, 903)])
    assert lattice.near_duplicates(df.limit(0)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(20)] + [(30, 31), (31, 30), (40, 40), (None, 1)] + [(50, i) for i in range(60, 90)]
    found = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == ({i: 0 for i in range(21)} | {30: 30, 31: 30, 50: 50} | {i: 50 for i in range(60, 90)})


def shingle_set(text):
    fold = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", fold)
    return {tuple(words[i:i + 3]) for i in range(max(1, len(words) - 2))} if words else set()


def test_jaccard_join_equals_brute_force(spark, docs, empty):
    draw, rows = np.random.default_rng(5), [(i, t) for i, t, *_ in TEXTS[:12]]
    for group in range(12):
        base = [f"g{group}v{i}" for i in range(int(draw.integers(4, 400)))]
        for copy in range(8):
            words = list(base)
            for _ in range(int(draw.integers(0, 1 + len(base) // 40))):
                words[int(draw.integers(len(words)))] = f"c{copy}"
            rows.append((100 * (group + 1) + copy, " ".join(words)))
    sets = {i: shingle_set(t) for i, t in rows if i is not None}
    want = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if want[b] < want[a] and sets[a] and 10 * len(sets[a] & sets[b]) >= 9 * len(sets[a] | sets[b]):
                    want[a], changed = want[b], True
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard.similar_documents(df).collect()
    expected = [(i, len(s), want[i]) for i, s in sets.items()] + [(None, len(shingle_set(LONG)), None)]
    assert ordered(got) == ordered(expected)
    kept = [r.doc_id for r in jaccard.keep_one_of_each(docs).collect()]
    assert 1 in kept and not {2, 7} & set(kept) and kept.count(6) == 1 and {4, 5, 8, 9, 10, 11, None} <= set(kept)
    assert jaccard.similar_documents(empty).count() == 0


def test_near_duplicates_stage_equals_brute_force(spark):
    import corpus_pipeline

    draw, rows = np.random.default_rng(9), []
    for group in range(25):
        base = [f"g{group}v{i}" for i in range(int(draw.integers(30, 500)))]
        rows.append((100 * (group + 1), " ".join(base)))
        for copy in range(1, 5):
            passage = [f"g{group}c{copy}p{i}" for i in range(round(len(base) * draw.uniform(0.08, 0.3)))]
            rows.append((100 * (group + 1) + copy, " ".join([*passage, *base] if copy % 2 else [*base, *passage])))
        words = list(base)
        for at in draw.permutation(len(base))[:max(1, len(base) // 50)].tolist():
            words[at] = f"g{group}x{at}"
        rows.append((100 * (group + 1) + 5, " ".join(words)))
    sets = {}
    for doc_id, text in rows:
        words = text.split()
        sets[doc_id] = {tuple(words[i:i + 5]) for i in range(len(words) - 4)}
    least = {i: i for i in sets}
    shares = {(a, b): Fraction(len(sets[a] & sets[b]), len(sets[a] | sets[b])) for a in sets for b in sets if a // 100 == b // 100}
    changed = True
    while changed:
        changed = False
        for (a, b), share in shares.items():
            if share >= Fraction(4, 5) and least[a] < least[b]:
                least[b], changed = least[a], True
    assert sum(Fraction(4, 5) <= share < Fraction(9, 10) for share in shares.values()) > 20
    df = spark.createDataFrame([(i, t, "en", "a", len(t), None, None) for i, t in rows], SCHEMA)
    kept = corpus_pipeline.drop_near_duplicates(spark, df, "").collect()
    assert sorted(r.doc_id for r in kept) == sorted(i for i in sets if least[i] == i)


def test_allowances_exceed_the_difference():
    for low, high in jaccard.size_bands(5000, Fraction(9, 10)):
        for sets in (1, 10**6, 10**11):
            segments, doubles = jaccard.allocate(high, low, Fraction(9, 10), sets)
            assert segments + doubles >= high // 9 + 1 and 0 <= doubles <= segments
    assert jaccard.allocate(60, 50, Fraction(9, 10), 10**12)[1] > 0


def test_one_deletion_meets():
    band = jaccard.Band(0, 5, 20, 1, 1)
    hashes = np.arange(1, 11, dtype=np.uint64)
    both = np.concatenate([hashes, hashes[:-1]])
    keys = {0: set(), 1: set()}
    for of, found in jaccard._entries(both, np.array([10, 9]), [band], Fraction(9, 10)):
        for o, key in zip(of.tolist(), found.tolist(), strict=True):
            keys[o].add(key)
    assert keys[0] & keys[1]


def test_unrelated_small_sets_do_not_meet():
    draw, least = np.random.default_rng(10), Fraction(4, 5)
    base = [np.sort(draw.integers(0, 1 << 63, int(n)).astype(np.uint64)) for n in draw.integers(5, 60, 400)]
    near = [np.sort(np.append(s[:-max(1, len(s) // 10)], draw.integers(0, 1 << 63, max(1, len(s) // 20)).astype(np.uint64))) for s in base]
    sets = base + near
    bands = [jaccard.Band(i, low, high, *jaccard.allocate(high, low, least, 200)) for i, (low, high) in enumerate(jaccard.size_bands(60, least))]
    counts = np.array([len(s) for s in sets])
    met = {}
    for of, keys in jaccard._entries(np.concatenate(sets), counts, bands, least):
        for o, key in zip(of.tolist(), keys.tolist(), strict=True):
            met.setdefault(key, set()).add(o)
    pairs = {(a, b) for group in met.values() for a in group for b in group if a < b}
    assert all(b - a == 400 for a, b in pairs)
    for i, (a, b) in enumerate(zip(base, near, strict=True)):
        both = len(np.intersect1d(a, b))
        assert 5 * both < 4 * (len(a) + len(b) - both) or (i, 400 + i) in pairs


def test_mix(docs, empty):
    plan = mixing.mix_plan(docs)
    rows = plan.collect()
    sizes = {"a": 60 + 60 + 2 + 60, "b": 12, "c": 4 + 9 + 30000, None: 60}
    assert plan.columns[:5] == ["doc_id", "size", "source_size", "target", "taken"] and len(rows) == len(TEXTS)
    assert sum(r.size for r in rows) == sum(sizes.values())
    assert all(0 <= r.taken <= 2 * r.size for r in rows)
    taken = {}
    for r in rows:
        taken[r.source_size] = taken.get(r.source_size, 0) + r.taken
    assert all(abs(taken[r.source_size] - r.target) <= 0.5 for r in rows)
    assert ordered(rows) == ordered(mixing.mix_plan(docs.repartition(5)).collect())
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    words = mixed.select(F.sum(F.size(F.expr(r"filter(split(text, '[\\x20\\x09-\\x0D]+'), x -> x <> '')")))).first()[0]
    assert words == sum(r.taken for r in rows)
    assert mixing.mix_plan(empty).count() == 0 and mixing.mix_documents(empty).count() == 0


def test_untaken_rows_are_spread(spark):
    rows = [(i, f"w{i} " * 5, "b" if i < 400 else "c") for i in range(440)] + [(1000 + i, "w " * 5, "a") for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mixing.mix_plan(df, weights=(5, 1, 40), max_passes=8)
    rows = plan.withColumn("slice", F.spark_partition_id()).collect()
    untaken = [r.slice for r in rows if r.position is None]
    assert len(rows) == 450 and len(untaken) > 100
    assert max(map(untaken.count, untaken)) < len(untaken) / 3
    placed = [r.position for r in sorted((r for r in rows if r.position is not None), key=lambda r: r.slice)]
    assert placed == sorted(placed)
    for before, after in zip(rows, rows[1:], strict=False):
        assert before.slice != after.slice or before.position is not None or after.position is None


def test_mixing_stage_keeps_texts_whole(spark):
    import corpus_pipeline

    draw = np.random.default_rng(11)
    texts = [(i, " ".join(f"d{i}w{j}" for j in range(int(draw.integers(5, 60)))), "en", f"s{i // 2 % 30}") for i in range(90)]
    df = spark.createDataFrame([(i, t, lang, s, len(t), None, None) for i, t, lang, s in texts], SCHEMA)
    mixed, whole = corpus_pipeline.mix_sources(spark, df, "").collect(), {i: t for i, t, *_ in texts}
    assert mixed and all(r.text == whole[r.doc_id] and r.n_chars == len(r.text) for r in mixed)
    targets, taken, largest = {}, {}, {}
    source = {i: s for i, _, _, s in texts}
    for r in mixing.mix_plan(df).collect():
        targets[source[r.doc_id]] = r.target
        largest[source[r.doc_id]] = max(r.size, largest.get(source[r.doc_id], 0))
    for r in mixed:
        taken[r.source] = taken.get(r.source, 0) + len(r.text.split())
    assert all(abs(taken.get(s, 0) - target) <= largest[s] / 2 + 0.5 for s, target in targets.items())


def test_targets_stop_at_two_passes(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 1000), ("c", 10), ("d", 400), (None, 90)], "source string, source_size long")
    got = {r.source: (r.weight, r.target) for r in mixing.source_targets(sizes).collect()}
    assert {s: w for s, (w, _) in got.items()} == {"a": 5, "b": 2, "c": 1, "d": 5, None: 2}
    assert abs(sum(t for _, t in got.values()) - 1.5 * 1600) < 1e-6
    assert got["a"][1] == 200 and got["c"][1] == 20 and got[None][1] == 180


def test_licenses(docs, empty):
    got = {r.doc_id: r for r in licenses.scan_licenses(docs).collect()}
    row = got[11]
    assert (row.n_words, row.n_base, row.first_word, row.last_word) == (14, 3, 1, 9)
    assert (row.base_labels, row.score) == ("apache,gpl,mit", 1.0)
    assert (got[1].n_base, got[1].labels, got[1].first_word, got[1].score) == (0, "", None, 0.0)
    assert got[5].n_words == got[4].n_words == 0 and got[10].n_words == 30000
    assert licenses.scan_licenses(empty).count() == 0 and licenses.scan_licenses(docs).count() == len(TEXTS)


def test_changed_notice_is_found(spark):
    text = ("x y permission is hereby granted free of charge to every person obtaining a copy of this software and "
            "K license mit  license,MIT license")
    row = licenses.scan_licenses(spark.createDataFrame([(1, text), (1, text)], "doc_id long, text string")).first()
    assert (row.base_labels, row.n_base, row.labels) == ("mit", 2, "mit") and row.score == 1.0
    row = licenses.scan_licenses(spark.createDataFrame([(1, text[:98])], "doc_id long, text string")).first()
    assert (row.base_labels, row.labels) == ("", "mit") and 0.8 <= row.score < 1


def test_toxicity(spark, docs, empty):
    draw = np.random.default_rng(6)
    rows, labels = [], []
    for i in range(600):
        toxic = int(i % 4 == 0)
        words = [f"n{draw.integers(200)}" for _ in range(40)] + (["vile", "women"] if toxic else []) + (["men"] if i % 3 == 0 else [])
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels + [(None, 1), (1, None), (2, 7)], "doc_id long, toxic int")
    found = {r.doc_id: r for r in toxicity.toxicity_scores(table, marks).collect()}
    right = [found[i].predicted == toxic for i, toxic in labels if found[i].held_out]
    assert np.mean(right) > 0.95
    assert found[1].held_out == (zlib.crc32(b"1") % 5 == 0)
    model = toxicity.train(table, marks)
    assert abs(model.score("women here") - model.score("men here")) < 0.2
    plain = toxicity.fit([np.array([0]), np.array([1])] * 50, [np.array([1]), np.array([0])] * 50, np.array([1.0, 0.0] * 50), 2, counterfactual=0.0)[0]
    held = toxicity.fit([np.array([0]), np.array([1])] * 50, [np.array([1]), np.array([0])] * 50, np.array([1.0, 0.0] * 50), 2)[0]
    assert abs(held[0] - held[1]) < abs(plain[0] - plain[1]) / 2
    none = marks.limit(0)
    assert {r.score for r in toxicity.toxicity_scores(docs, none).collect()} == {0.5}
    assert toxicity.toxicity_scores(empty, none).count() == 0
    assert toxicity.keep_clean(docs, marks).columns == docs.columns


def test_languages(spark, docs, empty):
    draw, rows = np.random.default_rng(7), []
    parts = {"aa": ["tha", "ing", "wer"], "bb": ["çon", "éau", "tre"]}
    for i in range(300):
        lang = "aa" if i % 2 else "bb"
        rows.append((i, " ".join("".join(draw.choice(parts[lang], 2)) for _ in range(30)), lang))
    table = spark.createDataFrame(rows + [(1000, None, "aa"), (1001, "12 ?", "bb"), (1002, "thaing", None)],
                                  "doc_id long, text string, lang string")
    found = {r.doc_id: r for r in langid.languages(table).collect()}
    assert np.mean([found[i].lang_pred == lang for i, _, lang in rows if found[i].held_out]) > 0.95
    assert (found[1000].lang_pred, found[1001].lang_pred, found[1000].score) == ("und", "und", 0.0)
    assert not found[1001].accepted and all(0 <= r.score <= 1 for r in found.values())
    assert langid.languages(empty).count() == 0
    assert langid.keep_identified(docs).columns == docs.columns
    short, long = langid.subword_counts("one two "), langid.subword_counts("one two " * 200000)
    assert ((short > 0) == (long > 0)).all() and long.sum() == 200000 * short.sum()


def test_pipeline_returns_columns_of_documents(spark, docs):
    import corpus_pipeline

    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "language", "near_duplicates", "mixing", "encoding"]
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert rows.columns == ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"] and rows.count() > 0
