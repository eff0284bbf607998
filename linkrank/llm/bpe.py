"""BPE encoding and decoding: frequent words through a transducer, all others merged exactly."""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import tempfile
import uuid
from array import array
from collections import Counter
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkrank.llm.lexicon import Lexicon, build
from linkrank.llm.words import BYTE_LETTERS, chunks, give_memory_back, small_batches, vocabulary_text, words

LEXICON_WORDS = 1 << 16
COUNTER_WORDS = 100_000
MEMO_CHUNKS = 100_000
#: Texts that are split into pieces at a time.
BATCH_BYTES = 1 << 20
LONG_WORD = 512
WIDTHS = (8, 16, 32, 64)
_NEVER = 1 << 60
_NO_RANK = (1 << 31) - 1


class Merges:
    """Vocabulary and merge ranks of a word BPE file."""

    def __init__(self, text: str):
        data = json.loads(text)
        model = data["model"]
        self.suffix = model["end_of_word_suffix"]
        vocab = model["vocab"]
        self.tokens = {number: token for token, number in vocab.items()}
        self.special = {}
        for added in data["added_tokens"]:
            self.tokens[added["id"]] = added["content"]
            self.special[added["content"]] = added["id"]
        self.pairs, self.products = {}, []
        for rank, (a, b) in enumerate(model["merges"]):
            self.pairs[vocab[a], vocab[b]] = rank
            self.products.append(vocab[a + b])
        letters = BYTE_LETTERS
        self.inner = [vocab[letters[byte]] for byte in range(256)]
        self.last = [vocab[letters[byte] + self.suffix] for byte in range(256)]
        self.byte_of = {letter: byte for byte, letter in letters.items()}
        self.text = text
        self._library = None
        # The same for many words at a time: pairs as sorted numbers.
        self._base = max(self.tokens) + 1
        keys = np.array([a * self._base + b for a, b in self.pairs] + [_NEVER], dtype=np.int64)
        order = np.argsort(keys)
        self._keys, self._ranks = keys[order], np.append(np.arange(len(self.pairs)), _NO_RANK).astype(np.int32)[order]
        self._products = np.array(self.products, dtype=np.int32)
        self._inner, self._last = (np.array(ids, dtype=np.int32) for ids in (self.inner, self.last))

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs of symbols; -1 stands for no symbol."""
        wanted = np.where((a < 0) | (b < 0), -1, a.astype(np.int64) * self._base + b)
        at = np.searchsorted(self._keys, wanted)
        return np.where(self._keys[at] == wanted, self._ranks[at], _NO_RANK)

    def encode_many(self, words: list[bytes]) -> list[bytes]:
        """Ids of many words, as little-endian 32-bit integers: all words take a merge at a time."""
        out: list[bytes] = [b""] * len(words)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        before = 0
        for width in WIDTHS:
            chosen = np.flatnonzero((lengths > before) & (lengths <= width))
            before = width
            if len(chosen):
                self._merge_block([words[i] for i in chosen.tolist()], lengths[chosen], width, chosen, out)
        for i in np.flatnonzero(lengths > before).tolist():
            out[i] = array("I", self.encode_word(words[i])).tobytes()
        return out

    def _merge_block(self, words: list[bytes], lengths: np.ndarray, width: int, places: np.ndarray, out: list) -> None:
        text = np.frombuffer(b"".join(words), dtype="u1")
        columns = np.arange(width)
        there = columns < lengths[:, None]
        symbols = np.full((len(words), width), -1, dtype=np.int32)
        symbols[there] = self._inner[text]
        ends = (np.arange(len(words)), lengths - 1)
        symbols[ends] = self._last[text[np.cumsum(lengths) - 1]]
        ranks = np.full((len(words), width), _NO_RANK, dtype=np.int32)
        ranks[:, :-1] = self._rank(symbols[:, :-1], symbols[:, 1:])
        rows = places
        while len(rows):
            at = ranks.argmin(axis=1)
            every = np.arange(len(rows))
            best = ranks[every, at]
            going = best != _NO_RANK
            if not going.all():
                done = symbols[~going]
                keep = done >= 0
                raw, stops = done[keep].astype("<u4").tobytes(), np.cumsum(4 * keep.sum(axis=1)).tolist()
                start = 0
                for place, stop in zip(rows[~going].tolist(), stops, strict=True):
                    out[place] = raw[start:stop]
                    start = stop
                symbols, ranks, rows, at, best = symbols[going], ranks[going], rows[going], at[going], best[going]
                every = np.arange(len(rows))
                if not len(rows):
                    break
            source = np.minimum(columns + (columns > at[:, None]), width - 1)
            last = symbols[:, -1] >= 0
            symbols, ranks = (np.take_along_axis(values, source, axis=1) for values in (symbols, ranks))
            symbols[last, -1] = -1
            ranks[last, -1] = _NO_RANK
            symbols[every, at] = self._products[best]
            after = np.where(at + 1 < width, symbols[every, np.minimum(at + 1, width - 1)], -1)
            ranks[every, at] = self._rank(symbols[every, at], after)
            inside = at > 0
            left = every[inside], at[inside] - 1
            ranks[left] = self._rank(symbols[left], symbols[every[inside], at[inside]])

    def encode_word(self, word: bytes) -> list[int]:
        """The ids of one word: always the pair of the least rank, the leftmost first."""
        symbols = [self.inner[byte] for byte in word]
        symbols[-1] = self.last[word[-1]]
        if len(symbols) > LONG_WORD:
            return self._merge_long(symbols)
        get = self.pairs.get
        ranks = [get(pair, _NEVER) for pair in zip(symbols, symbols[1:], strict=False)]
        while ranks:
            rank = min(ranks)
            if rank == _NEVER:
                break
            i = ranks.index(rank)
            symbols[i:i + 2] = [self.products[rank]]
            del ranks[i]
            if i:
                ranks[i - 1] = get((symbols[i - 1], symbols[i]), _NEVER)
            if i < len(ranks):
                ranks[i] = get((symbols[i], symbols[i + 1]), _NEVER)
        return symbols

    def _merge_long(self, symbols: list[int]) -> list[int]:
        """The same with a heap, whose stale entries are told by their rank."""
        size, get = len(symbols), self.pairs.get
        after = [*range(1, size), -1]
        before = [*range(-1, size - 1)]
        gone = bytearray(size)
        heap = [(get(pair, _NEVER), i) for i, pair in enumerate(zip(symbols, symbols[1:], strict=False))]
        heap = [entry for entry in heap if entry[0] != _NEVER]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = -1 if gone[i] else after[i]
            if j < 0 or get((symbols[i], symbols[j])) != rank:
                continue
            symbols[i], gone[j], after[i] = self.products[rank], 1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for left in (before[i], i):
                if left >= 0 and after[left] >= 0:
                    new = get((symbols[left], symbols[after[left]]))
                    if new is not None:
                        heapq.heappush(heap, (new, left))
        return [symbol for symbol, out in zip(symbols, gone, strict=True) if not out]

    def rare_words(self, text: str):
        """Special ids and words (bytes) of a text that needs the library's own splitting."""
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_str(self.text)
        pattern = "(" + "|".join(map(re.escape, self.special)) + ")"
        for part in re.split(pattern, text):
            if part in self.special:
                yield self.special[part]
            elif part:
                plain = self._library.normalizer.normalize_str(part)
                for piece, _ in self._library.pre_tokenizer.pre_tokenize_str(plain):
                    yield bytes(self.byte_of[letter] for letter in piece)

    def decode(self, ids) -> str:
        """The tokens, special ones too, with a space between them: the file names no decoder."""
        return " ".join(map(self.tokens.__getitem__, ids))


class Encoder:
    """Encodes texts with a lexicon for frequent words and merges for the rest."""

    def __init__(self, merges: Merges, lexicon: Lexicon | None):
        self.merges, self.lexicon = merges, lexicon
        self.ids: dict[str, bytes] = {}

    def encode_words(self, new: list[bytes]) -> list[bytes]:
        """The ids of words, as little-endian 32-bit integers."""
        if not self.lexicon:
            return self.merges.encode_many(new)
        known = self.lexicon.ids_of(new)
        merged = iter(self.merges.encode_many([word for word, ids in zip(new, known, strict=True) if ids is None]))
        return [next(merged) if ids is None else ids for ids in known]

    def _learn(self, pieces: set[str]) -> None:
        if len(self.ids) > MEMO_CHUNKS:
            self.ids.clear()
        new = pieces.difference(self.ids)
        split = [words(piece) for piece in new]
        distinct = list(set(chain.from_iterable(split)))
        ids = dict(zip(distinct, self.encode_words([word.encode() for word in distinct]), strict=True))
        for piece, found in zip(new, split, strict=True):
            self.ids[piece] = ids[found[0]] if len(found) == 1 else b"".join([ids[word] for word in found])

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text (null: empty), as little-endian 32-bit integers."""
        split = [chunks(text or "") for text in texts]
        self._learn(set(chain.from_iterable(found for found in split if found)))
        out = []
        for text, found in zip(texts, split, strict=True):
            if found is None:
                ids = array("I")
                for part in self.merges.rare_words(text):
                    ids.extend([part] if isinstance(part, int) else self.merges.encode_word(part))
                out.append(np.array(ids, dtype="<u4"))
            else:
                out.append(np.frombuffer(b"".join(map(self.ids.__getitem__, found)), dtype="<u4"))
        return out


@lru_cache(maxsize=1)
def _merges(content: str) -> Merges:
    return Merges(content)


@lru_cache(maxsize=1)
def _encoder(content: str, lexicon_file: str) -> Encoder:
    """One at a time: a worker that serves another run gives the memory of the last one's words back."""
    return Encoder(_merges(content), Lexicon(SparkFiles.get(lexicon_file)))


def _count_words(batches):
    seen: Counter = Counter()

    def flush():
        found: Counter = Counter()
        for piece, n in seen.items():
            for word in words(piece):
                found[word] += n
        seen.clear()
        return pa.RecordBatch.from_pydict(
            {"word": pa.array(list(found), pa.string()), "n": pa.array(list(found.values()), pa.int64())})

    for batch in small_batches(batches, "text", BATCH_BYTES):
        for text in batch.column("text").to_pylist():
            seen.update(chunks(text or "") or ())
        if len(seen) > COUNTER_WORDS:
            yield flush()
    yield flush()


def compile_lexicon(docs: DataFrame, content: str, size: int = LEXICON_WORDS) -> str:
    """Counts the words of all texts, compiles the most frequent ones, and gives every executor the file.

    Tasks count into tables of bounded size, whose sums are added up. The ``size`` words that
    come to the driver bound the lexicon; a word outside it is merged, to the same ids. The
    result is the file's name for ``SparkFiles``.
    """
    spark: SparkSession = docs.sparkSession
    counts = docs.select("text").mapInArrow(_count_words, "word string, n long")
    frequent = counts.groupBy("word").agg(F.sum("n").alias("n")).where("n > 1")
    frequent = frequent.orderBy(F.desc("n"), "word").limit(size).select("word").toArrow().column("word").to_pylist()
    merges = Merges(content)
    frequent = [word.encode() for word in frequent]
    entries = {word: np.frombuffer(ids, dtype="<u4").tolist()
               for word, ids in zip(frequent, merges.encode_many(frequent), strict=True)}
    file = Path(tempfile.mkdtemp(prefix="lexicon-")) / f"lexicon-{uuid.uuid4().hex}"
    file.write_bytes(build(entries))
    spark.sparkContext.addFile(str(file))
    return file.name


#: What ``encode_documents`` can put beside n_tokens.
OUTPUTS = {
    "ids": T.ArrayType(T.IntegerType()),
    "decoded": T.StringType(),
    "ids_sha256": T.StringType(),
    "decoded_sha256": T.StringType(),
}


def encode_documents(docs: DataFrame, outputs=("ids",), vocabulary: str | None = None,
                     lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """doc_id, n_tokens and ``outputs`` of every row, as the tokenizer library gives them without special tokens added.

    ``outputs``: ids; decoded; and their digests ids_sha256 (ids as little-endian unsigned
    32-bit integers) and decoded_sha256 (UTF-8). Null and empty texts have no ids and decode
    to an empty text. Special tokens that a text spells out are their ids. Rows stay rows:
    a repeated or null doc_id is passed through. Nothing is shuffled but word counts.
    """
    content = vocabulary_text(vocabulary)
    file = compile_lexicon(docs, content, lexicon_words)
    shared = docs.sparkSession.sparkContext.broadcast(content)
    kinds = {"n_tokens": T.LongType()} | {name: OUTPUTS[name] for name in outputs}
    schema = T.StructType([docs.schema["doc_id"], *(T.StructField(name, kind) for name, kind in kinds.items())])

    def encoded(batches):
        encoder = _encoder(shared.value, file)
        decode = encoder.merges.decode
        digest = lambda raw: hashlib.sha256(raw).hexdigest()
        for batch in small_batches(batches, "text", BATCH_BYTES):
            ids = encoder.encode(batch.column("text").to_pylist())
            columns = {"n_tokens": pa.array([len(of_text) for of_text in ids], pa.int64())}
            if "ids" in kinds:
                ends = np.cumsum([0, *map(len, ids)])
                columns["ids"] = pa.ListArray.from_arrays(
                    pa.array(ends, pa.int32()), pa.array(np.concatenate(ids).astype(np.int32)))
            if "ids_sha256" in kinds:
                columns["ids_sha256"] = pa.array([digest(of_text) for of_text in ids], pa.string())
            if kinds.keys() & {"decoded", "decoded_sha256"}:
                decoded = [decode(of_text.tolist()) for of_text in ids]
                columns["decoded"] = pa.array(decoded, pa.string())
                columns["decoded_sha256"] = pa.array([digest(text.encode()) for text in decoded], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(columns[name] for name in kinds)], names=["doc_id", *kinds])
        encoder.ids.clear()
        give_memory_back()

    return docs.select("doc_id", "text").mapInArrow(encoded, schema)
