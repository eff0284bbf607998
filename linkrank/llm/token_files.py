"""Token ids in files of independent zstandard frames with a trailing seek table.

A file holds a frame per document (its ids as little-endian integers of 2 or 4 bytes), one
frame with the documents' ids, and the seek table: a skippable frame that has the size of
each frame, packed and unpacked, and a checksum of its content. A reader takes the table
from the end of the file and then only the frames it wants.
"""

from __future__ import annotations

import bisect
import os
import struct
import zlib
from array import array
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkrank.llm.files import create_output, open_input
from linkrank.llm.words import chunks, letters, small_batches, vocabulary_text, words
from linkrank.session import scratch_folder, stored

# Marks of the seekable format.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
CHECKSUMS = 0x80

LEVEL = 3
FILE_TOKENS = 1 << 24
MEMO_PIECES = 400_000
_ENTRY, _FOOTER = struct.Struct("<III"), struct.Struct("<IBI")


class TokenFileError(ValueError):
    """A file that breaks the format, or whose content fails its checksum."""


def _checksum(raw: bytes) -> int:
    return xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF


class TokenFileWriter:
    """Appends documents to a stream; ``close`` writes the ids and the seek table."""

    def __init__(self, stream, level: int = LEVEL):
        self._stream, self._pack = stream, zstandard.ZstdCompressor(level=level, write_content_size=True).compress
        self._table, self._ids = [], []

    def _frame(self, raw: bytes) -> None:
        packed = self._pack(raw)
        self._stream.write(packed)
        self._table.append(_ENTRY.pack(len(packed), len(raw), _checksum(raw)))

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self._ids.append(doc_id)
        self._frame(ids)

    def close(self) -> None:
        known = np.array([i is not None for i in self._ids], dtype="u1")
        self._frame(known.tobytes() + np.array([i or 0 for i in self._ids], dtype="<i8").tobytes())
        content = b"".join(self._table) + _FOOTER.pack(len(self._table), CHECKSUMS, SEEKABLE)
        self._stream.write(struct.pack("<II", SKIPPABLE, len(content)) + content)
        self._stream.close()


class TokenFileReader:
    """Reads single documents of a seekable file."""

    def __init__(self, file, width: int):
        self._file, self._kind = file, f"<u{width}"
        size = file.seek(0, os.SEEK_END)
        if size < _FOOTER.size:
            raise TokenFileError("no seek table")
        file.seek(size - _FOOTER.size)
        count, flags, mark = _FOOTER.unpack(file.read(_FOOTER.size))
        if mark != SEEKABLE or flags != CHECKSUMS:
            raise TokenFileError("no seek table with checksums")
        length = count * _ENTRY.size + _FOOTER.size
        if size < length + 8 or not count:
            raise TokenFileError("the seek table does not fit the file")
        file.seek(size - length - 8)
        head = file.read(8 + length)
        if struct.unpack("<II", head[:8]) != (SKIPPABLE, length):
            raise TokenFileError("the seek table is no skippable frame of its length")
        table = np.frombuffer(head, dtype="<u4", count=3 * count, offset=8).reshape(count, 3).astype(np.int64)
        self._sizes, self._sums = table[:, :2], table[:, 2]
        self._starts = np.concatenate([[0], np.cumsum(table[:, 0])])
        if self._starts[-1] != size - length - 8:
            raise TokenFileError("the frames' lengths do not add up to the file's")
        index = self._frame(count - 1)
        if len(index) != 9 * (count - 1):
            raise TokenFileError("the document ids do not fit the frames")
        known = np.frombuffer(index, dtype="u1", count=count - 1)
        ids = np.frombuffer(index, dtype="<i8", offset=count - 1)
        self.doc_ids = [i if there else None for i, there in zip(ids.tolist(), known.tolist(), strict=True)]
        self.lengths = (self._sizes[:-1, 1] // width).tolist()
        self._sorted = self.doc_ids[:int(known.sum())]

    def _frame(self, number: int) -> bytes:
        packed, unpacked = self._sizes[number].tolist()
        self._file.seek(int(self._starts[number]))
        raw = zstandard.ZstdDecompressor().decompress(self._file.read(packed), max_output_size=unpacked)
        if len(raw) != unpacked or _checksum(raw) != self._sums[number]:
            raise TokenFileError(f"frame {number} fails its length or checksum")
        return raw

    def ids(self, number: int) -> np.ndarray:
        """The ids of the file's document at a place; only its frame is read."""
        return np.frombuffer(self._frame(number), dtype=self._kind)

    def places(self, doc_id: int) -> range:
        """Where documents of an id stand; ids ascend within a file."""
        return range(bisect.bisect_left(self._sorted, doc_id), bisect.bisect_right(self._sorted, doc_id))


class _LibraryEncoder:
    """Encodes with the library: each distinct word by its model, rare texts as a whole."""

    def __init__(self, content: str, kind: str, end: int):
        from tokenizers import Tokenizer

        self._tokenizer, self._kind = Tokenizer.from_str(content), kind
        self._code = {"<u2": "H", "<u4": "I"}[kind]
        self._end = np.array([end], dtype=kind).tobytes()
        self._pieces: dict[str, bytes] = {}
        self._words: dict[str, bytes] = {}

    def _learn(self, pieces: set[str]) -> None:
        for memo in (self._pieces, self._words):
            if len(memo) > MEMO_PIECES:
                memo.clear()
        tokenize, code, known = self._tokenizer.model.tokenize, self._code, self._words
        for piece in pieces.difference(self._pieces):
            parts = []
            for word in words(piece):
                ids = known.get(word)
                if ids is None:
                    found = tokenize(letters(word))
                    ids = known[word] = array(code, [token.id for token in found]).tobytes()
                parts.append(ids)
            self._pieces[piece] = parts[0] if len(parts) == 1 else b"".join(parts)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text and the end id."""
        split = [chunks(text or "") for text in texts]
        self._learn(set(chain.from_iterable(found for found in split if found)))
        out = []
        for text, found in zip(texts, split, strict=True):
            if found is None:
                ids = np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, dtype=self._kind).tobytes()
            else:
                ids = b"".join(map(self._pieces.__getitem__, found))
            out.append(ids + self._end)
        return out


@lru_cache(maxsize=2)
def _encoder(content: str, kind: str, end: int) -> _LibraryEncoder:
    return _LibraryEncoder(content, kind, end)


def write_token_files(docs: DataFrame, folder: str, end_id: int = 2, vocabulary: str | None = None,
                      file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Encodes every text, writes the ids in ascending doc_id order, and returns the files.

    One row per file: ``shard`` (their order), ``path``, ``width`` of an id in bytes,
    ``n_docs``, ``n_tokens`` and ``start``, the ids before the file. Ids are encoded once
    and stored; the stored ids, a fraction of the texts, are then range-partitioned, and
    each task streams its range into files of its own. Null texts are empty; null doc_ids
    come last; rows that repeat a doc_id stand side by side, those with fewer bytes first.
    """
    spark, content = docs.sparkSession, vocabulary_text(vocabulary)
    shared = spark.sparkContext.broadcast(content)
    from tokenizers import Tokenizer

    largest = max(max(Tokenizer.from_str(content).get_vocab(with_added_tokens=True).values()), end_id)
    width = 2 if largest < 1 << 16 else 4
    kind = f"<u{width}"

    def encode(batches):
        encoder = _encoder(shared.value, kind, end_id)
        for batch in small_batches(batches, "text"):
            ids = encoder.encode(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(ids, pa.binary()),
                pa.array([len(raw) // width for raw in ids], pa.int64())], names=["doc_id", "ids", "n"])

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    encoded = stored(keyed.mapInArrow(encode, "doc_id long, ids binary, n long"), scratch_folder(spark, "ids"))
    total = encoded.agg(F.sum("n")).first()[0] or 0
    order = [F.col("doc_id").asc_nulls_last(), F.length("ids"), F.col("ids")]
    ranged = encoded.repartitionByRange(max(1, -(-total // file_tokens)), F.col("doc_id").asc_nulls_last())
    ranged = ranged.sortWithinPartitions(*order).withColumn("shard", F.spark_partition_id())

    def write(batches):
        writer = None
        for batch in batches:
            shard = batch.column("shard")[0].as_py() if batch.num_rows else None
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True):
                if writer is None:
                    path, stream = create_output(folder, ".tokens.zst")
                    writer, n_docs, n_bytes, of = TokenFileWriter(stream), 0, 0, shard
                raw = ids.as_py()
                writer.add(doc_id, raw)
                n_docs, n_bytes = n_docs + 1, n_bytes + len(raw)
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([of], pa.int32()), "path": [path], "width": pa.array([width], pa.int32()),
                "n_docs": pa.array([n_docs], pa.int64()), "n_tokens": pa.array([n_bytes // width], pa.int64())})

    files = stored(ranged.mapInArrow(write, "shard int, path string, width int, n_docs long, n_tokens long"),
                   scratch_folder(spark, "token-files"))
    # One row per file.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def _documents(row, wanted: list[int] | None):
    with open_input(row["path"]) as file:
        reader = TokenFileReader(file, row["width"])
        starts = np.cumsum([row["start"], *reader.lengths])
        places = range(len(reader.doc_ids))
        if wanted is not None:
            places = [place for doc_id in wanted for place in reader.places(doc_id)]
        for place in places:
            yield reader.doc_ids[place], int(starts[place]), reader.ids(place)


def _read(spark: SparkSession, files: DataFrame, wanted, columns: dict, make) -> DataFrame:
    schema = "doc_id long, start long, " + ", ".join(f"{name} {kind}" for name, kind in columns.items())

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                rows = []
                for document in _documents(row, wanted):
                    rows.append(make(*document))
                    if len(rows) == 1000:
                        yield pa.RecordBatch.from_pylist(rows, pa_schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, pa_schema)

    kinds = {"long": pa.int64(), "array<int>": pa.list_(pa.int32())}
    pa_schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), *((n, kinds[k]) for n, k in columns.items())])
    spread = spark.sparkContext.defaultParallelism
    return files.select("path", "width", "start").repartition(spread).mapInArrow(read, schema)


def read_token_files(files: DataFrame, doc_ids: list[int] | None = None) -> DataFrame:
    """doc_id, start and ids of all documents, or of ``doc_ids``, whose frames alone are then read."""
    return _read(files.sparkSession, files, sorted(set(doc_ids)) if doc_ids is not None else None,
                 {"ids": "array<int>"},
                 lambda doc_id, start, ids: {"doc_id": doc_id, "start": start, "ids": ids.astype(np.int32)})


def token_digests(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 (of the ids as little-endian unsigned 32-bit integers), read from the files."""
    return _read(files.sparkSession, files, None, {"n_tokens": "long", "ids_crc32": "long"},
                 lambda doc_id, start, ids: {"doc_id": doc_id, "start": start, "n_tokens": len(ids),
                                             "ids_crc32": zlib.crc32(ids.astype("<u4").tobytes())})
