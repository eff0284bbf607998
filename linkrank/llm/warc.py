"""WARC archives, a zstandard frame per record, with the dictionary in a leading skippable frame."""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkrank.llm.files import create_output, open_input
from linkrank.session import scratch_folder, stored

# Marks of the formats.
VERSION = "WARC/1.1"
DICTIONARY_FRAME = 0x184D2A5D
ZSTD_FRAME = b"\x28\xb5\x2f\xfd"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANDATORY = ("warc-type", "warc-record-id", "warc-date", "content-length")
END = b"\r\n\r\n"

LEVEL = 3
DICTIONARY_BYTES = 1 << 16
#: The dictionary is trained on so many pages, of each at most so many characters.
DICTIONARY_PAGES = 400
DICTIONARY_CHARS = 1 << 14
ARCHIVE_BYTES = 1 << 28
READ_BYTES = 1 << 20
MAX_RECORD_BYTES = 1 << 31
DATE = "1970-01-01T00:00:00Z"


class WarcError(ValueError):
    """An archive or record that breaks the format."""


def digest(payload: bytes) -> str:
    """Bare base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    """A version 8 UUID that holds a page's 64-bit id, or tells that it has none."""
    bits = (page_id or 0) & (1 << 64) - 1
    value = (bits >> 16) << 80 | 8 << 76 | (bits >> 4 & 0xFFF) << 64 | 2 << 62 | (bits & 0xF) << 58
    return f"<urn:uuid:{uuid.UUID(int=value | (page_id is None))}>"


def page_of(identifier: str) -> int | None:
    """The page id in a record id; None for ids that this module did not give."""
    try:
        value = uuid.UUID(identifier.removeprefix("<urn:uuid:").removesuffix(">")).int
    except ValueError:
        return None
    if value >> 76 & 0xF != 8:
        return None
    bits = value >> 80 << 16 | (value >> 64 & 0xFFF) << 4 | value >> 58 & 0xF
    return None if value & 1 else bits - (bits >> 63 << 64)


def _line_safe(value: str) -> str:
    """Control characters and spaces of a URI, percent-encoded as UTF-8."""
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{byte:02X}" for byte in c.encode()) for c in value)


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "\r\n".join([VERSION, *(f"{name}: {value}" for name, value in fields), f"Content-Length: {len(block)}"])
    return head.encode() + END + block + END


def page_record(page_id: int | None, url: str | None, payload: bytes, original: int | None, revisit: bool) -> bytes:
    """A response with the payload, or a revisit with the response's HTTP header only."""
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id)),
              ("WARC-Date", DATE), ("WARC-Target-URI", _line_safe(url) if url else "about:blank"),
              ("WARC-Payload-Digest", f"sha1:{digest(payload)}")]
    if revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(original))]
    fields.append(("Content-Type", "application/http; msgtype=response"))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    return _record(fields, http.encode() + (b"" if revisit else payload))


class Fields(dict):
    """Header fields by lower-case name: the first value of each, and in ``every`` all of them in order."""

    def __init__(self):
        super().__init__()
        self.every: dict[str, list[str]] = {}

    def add(self, name: str, value: str) -> None:
        self.setdefault(name, value)
        self.every.setdefault(name, []).append(value)


def _fields(head: bytes, what: str, once: tuple[str, ...]) -> tuple[str, Fields]:
    """The first line and the fields of a header. Fields may be repeated, but for those of ``once``."""
    try:
        first, *lines = head.decode().split("\r\n")
    except UnicodeDecodeError as error:
        raise WarcError(f"{what} is not UTF-8") from error
    fields = Fields()
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise WarcError(f"{what} has the line {line!r}")
        fields.add(name.lower(), value.strip())
    for name in once:
        if len(set(fields.every.get(name, ()))) > 1:
            raise WarcError(f"{what} repeats {name}")
    return first, fields


def _length(fields: dict[str, str], what: str) -> int:
    value = fields.get("content-length", "")
    if not (value.isascii() and value.isdigit()):
        raise WarcError(f"{what} has the length {value!r}")
    return int(value)


def parse_record(raw: bytes) -> tuple[Fields, bytes]:
    """Header fields and block of one record, which must be all of ``raw``."""
    head, mark, rest = raw.partition(END)
    if not mark:
        raise WarcError("a record's header does not end")
    version, fields = _fields(head, "a record's header", MANDATORY)
    if not version.startswith("WARC/1."):
        raise WarcError(f"not a WARC version: {version!r}")
    for name in MANDATORY:
        if name not in fields:
            raise WarcError(f"a record has no {name}")
    length = _length(fields, "a record")
    if len(rest) != length + len(END) or rest[length:] != END:
        raise WarcError(f"a record's block is not {length} bytes and an end")
    return fields, rest[:length]


def _unchunked(body: bytes) -> bytes:
    """A body of HTTP chunks put together; what follows the last one (trailers) is left out."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = body[at:end].partition(b";")[0].strip() if end >= 0 else b""
        try:
            length = int(size, 16)
        except ValueError as error:
            raise WarcError(f"a chunk has the size {size!r}") from error
        if not length:
            return b"".join(parts)
        at = end + 2 + length
        if body[at:at + 2] != b"\r\n":
            raise WarcError(f"a chunk is not {length} bytes and a line's end")
        parts.append(body[end + 2:at])
        at += 2


def parse_page(fields: dict[str, str], block: bytes) -> dict | None:
    """A page's row from its record; None for records of other types.

    The payload is the body, without chunks if HTTP sent it in some. Its length is checked
    where HTTP gives one, and a SHA-1 where the record has one, which may be of the body as
    sent. Records that are not this module's have no page_id; their digest is taken here.
    """
    kind = fields["warc-type"]
    if kind not in ("response", "revisit"):
        return None
    head, mark, body = block.partition(END)
    if not mark:
        raise WarcError("an HTTP header does not end")
    status, http = _fields(head, "an HTTP header", ("content-length",))
    if not status.startswith("HTTP/"):
        raise WarcError(f"not an HTTP status: {status!r}")
    length = _length(http, "an HTTP header") if "content-length" in http else None
    algorithm, _, wanted = fields.get("warc-payload-digest", "").partition(":")
    wanted = wanted.upper() if algorithm.lower() == "sha1" else ""
    if kind == "revisit":
        if body or "warc-profile" not in fields:
            raise WarcError("a revisit has a payload or no profile")
        if fields["warc-profile"] == REVISIT_PROFILE and not wanted and "warc-refers-to" not in fields:
            raise WarcError("a revisit of a payload does not tell which")
        original = fields.get("warc-refers-to")
        return _row(fields, length, wanted or None, kind, page_of(original) if original else None, None)
    chunked = "chunked" in http.get("transfer-encoding", "").lower()
    payload = _unchunked(body) if chunked else body
    if length is not None and not chunked and len(body) != length:
        raise WarcError("a payload fails its length")
    found = digest(payload)
    if wanted and wanted not in (found, digest(body)):
        raise WarcError("a payload fails its digest")
    return _row(fields, len(payload), found, kind, None, payload)


def _row(fields, length, sha1, kind, refers_to, payload) -> dict:
    return {"page_id": page_of(fields["warc-record-id"]), "payload_bytes": length, "payload_digest": sha1,
            "record_type": kind, "refers_to": refers_to, "target_uri": fields.get("warc-target-uri"), "payload": payload}


class ArchiveWriter:
    """Writes the dictionary, if there is one, and then a frame per record."""

    def __init__(self, stream, dictionary: bytes, level: int = LEVEL):
        self._stream, self.size = stream, 0
        data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self._pack = zstandard.ZstdCompressor(level=level, dict_data=data, write_checksum=True).compress
        if dictionary:
            self._put(struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary)
        self.add(_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
                          ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")],
                         b"format: WARC File Format 1.1\r\n"))

    def _put(self, raw: bytes) -> None:
        self._stream.write(raw)
        self.size += len(raw)

    def add(self, record: bytes) -> None:
        self._put(self._pack(record))

    def close(self) -> None:
        self._stream.close()


def read_records(file, read_bytes: int = READ_BYTES):
    """Yields header fields and block of each record of an archive, a frame at a time.

    The dictionary, itself plain or packed, comes from a leading skippable frame. Frames that
    are cut or damaged, skippable frames elsewhere and trailing bytes raise ``WarcError``.
    """
    data = file.read(8)
    options = {}
    if len(data) == 8 and struct.unpack("<I", data[:4])[0] == DICTIONARY_FRAME:
        size = struct.unpack("<I", data[4:])[0]
        dictionary = file.read(size)
        if len(dictionary) != size:
            raise WarcError("the dictionary is cut")
        try:
            if dictionary[:4] == ZSTD_FRAME:
                dictionary = zstandard.ZstdDecompressor().decompress(dictionary, max_output_size=MAX_RECORD_BYTES)
            options["dict_data"] = zstandard.ZstdCompressionDict(dictionary)
        except zstandard.ZstdError as error:
            raise WarcError(f"the dictionary is damaged: {error}") from error
        data = b""
    reader = zstandard.ZstdDecompressor(**options)
    while True:
        data = data or file.read(read_bytes)
        if not data:
            return
        while len(data) < 4 and (more := file.read(read_bytes)):
            data += more
        if data[:4] != ZSTD_FRAME:
            raise WarcError("bytes between records that are no frame")
        frame, parts = reader.decompressobj(), []
        try:
            parts.append(frame.decompress(data))
            while not frame.eof:
                more = file.read(read_bytes)
                if not more:
                    raise WarcError("a frame is cut")
                parts.append(frame.decompress(more))
        except zstandard.ZstdError as error:
            raise WarcError(f"a frame is damaged: {error}") from error
        data = frame.unused_data
        yield parse_record(b"".join(parts))


def train_dictionary(pages: DataFrame, size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary from a bounded sample: ``DICTIONARY_PAGES`` pages by hash, ``DICTIONARY_CHARS`` of each.

    The hashes are ranked first, on their own, so that no task sends more pages than the
    sample holds of them. Empty if there is too little to train on. Archives are read the
    same with any dictionary.
    """
    marked = pages.where("html <> ''").withColumn("__mark", F.xxhash64("page_id", "html"))
    lowest = marked.select("__mark").orderBy("__mark").limit(DICTIONARY_PAGES)
    bound = lowest.agg(F.max("__mark")).first()[0]
    if bound is None:
        return b""
    sample = marked.where(F.col("__mark") <= bound).select("__mark", F.substring("html", 1, DICTIONARY_CHARS).alias("html"))
    rows = sample.orderBy("__mark", "html").limit(DICTIONARY_PAGES).collect()
    samples = [row.html.encode() for row in rows]
    try:
        return zstandard.train_dictionary(min(size, sum(map(len, samples)) // 8), samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def write_archives(pages: DataFrame, folder: str, min_revisit_bytes: int = 0,
                   archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes a record per row of ``pages`` (page_id, url, html) and returns ``path`` and ``n_records`` of the archives.

    Of pages with equal payloads (html in UTF-8, null as empty) of at least
    ``min_revisit_bytes``, those with the largest page_id are responses and the others
    revisits of it; a null page_id is never the largest, and where all are null all are
    responses. Payloads are told apart by SHA-1 and length. Only those that repeat come out
    of the grouping, so the join that spreads the pages has no row for single payloads, and
    its hot keys can be split.
    """
    spark = pages.sparkSession
    shared = spark.sparkContext.broadcast(train_dictionary(pages))
    html = F.coalesce("html", F.lit(""))
    keyed = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html")).withColumn(
        "sha", F.sha1(F.encode("html", "UTF-8"))).withColumn("n", F.octet_length("html"))
    repeated = keyed.where(F.col("n") >= min_revisit_bytes).groupBy("sha", "n").agg(
        F.max("page_id").alias("original"), F.count("*").alias("copies")).where("copies > 1").drop("copies")
    marked = keyed.join(repeated, ["sha", "n"], "left").select("page_id", "url", "html", "original")

    def write(batches):
        writer = None
        for batch in batches:
            for page_id, url, text, original in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if writer is None:
                    path, stream = create_output(folder, ".warc.zst")
                    writer, count = ArchiveWriter(stream, shared.value), 0
                revisit = original is not None and page_id != original
                writer.add(page_record(page_id, url, text.encode(), original, revisit))
                count += 1
                if writer.size >= archive_bytes:
                    writer.close()
                    yield pa.RecordBatch.from_pydict({"path": [path], "n_records": [count]})
                    writer = None
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "n_records": [count]})

    return stored(marked.mapInArrow(write, "path string, n_records long"), scratch_folder(spark, "archives"))


READ_SCHEMA = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
               "target_uri string, payload binary")


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """The pages of archives (``path``), their records validated: see ``READ_SCHEMA``.

    A revisit has no payload of its own. Without ``payloads`` that column is null.
    """
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri", "payload"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    schema = pa.schema(list(zip(names, kinds, strict=True)))

    def read(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, size = [], 0
                with open_input(path) as file:
                    for fields, block in read_records(file):
                        row = parse_page(fields, block)
                        if row is None:
                            continue
                        if not payloads:
                            row["payload"] = None
                        rows.append(row)
                        size += len(block) if payloads else 0
                        if len(rows) == 1000 or size > READ_BYTES * 8:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    spread = archives.sparkSession.sparkContext.defaultParallelism
    return archives.select("path").repartition(spread).mapInArrow(read, READ_SCHEMA)
