"""Splits texts into pieces that the lower-case word BPE treats on their own."""

from __future__ import annotations

import contextlib
import ctypes
import re
import unicodedata
from pathlib import Path

import pyarrow as pa
import pyarrow.compute

#: Up to here, classes and lower case of characters are the same in every Unicode version.
_LATIN_END = 0x250
#: Texts that go the library's way: characters beyond Latin; separators that only Python
#: takes for white space; the one Latin letter whose lower case is two characters. What
#: begins like a special token goes there too.
_RARE = re.compile("[^\x00-\x1b\x20-įı-ɏ]")
_LATIN = [chr(code) for code in range(_LATIN_END)]
_LETTERS = "".join(re.escape(c) for c in _LATIN if unicodedata.category(c)[0] == "L")
_NUMBERS = "".join(re.escape(c) for c in _LATIN if unicodedata.category(c)[0] == "N")
# The tokenizer's pattern for words, over the Latin characters.
_WORD = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\x09-\x0d\x20\x85\xa0{_LETTERS}{_NUMBERS}]+")

#: The printable letter that stands for each byte in a byte-level vocabulary.
_PLAIN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_OTHERS = [byte for byte in range(256) if byte not in _PLAIN]
BYTE_LETTERS = {byte: chr(byte) for byte in _PLAIN} | {byte: chr(256 + i) for i, byte in enumerate(_OTHERS)}

BATCH_BYTES = 4 << 20


def letters(word: str) -> str:
    """A word as a byte-level vocabulary spells it."""
    return word if word.isascii() and word.isalpha() else word.encode().decode("latin-1").translate(BYTE_LETTERS)


def chunks(text: str) -> list[str] | None:
    """The lower-case pieces between white space, or None for a text that needs the library.

    No word spans white space, so what a piece encodes to does not depend on the others.
    """
    if _RARE.search(text) or "<|" in text:
        return None
    return text.lower().split()


def words(chunk: str) -> list[str]:
    """The words of one piece: letters alone, letters and a mark, or else what the pattern finds."""
    if chunk.isalpha():
        return [chunk]
    if chunk[:-1].isalpha() and not chunk[-1].isalnum():
        return [chunk[:-1], chunk[-1]]
    return _WORD.findall(chunk)


def vocabulary_text(path: str | None = None) -> str:
    """The tokenizer file's content; by default the word BPE of the installed set."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    return Path(path).read_text(encoding="utf-8")


def small_batches(batches, column: str, limit: int = BATCH_BYTES):
    """Cuts Arrow batches so that the texts of each are about ``limit`` bytes, or one text."""
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(column)).to_pylist()
        start = total = 0
        for row, size in enumerate(sizes):
            if total and total + (size or 0) > limit:
                yield batch.slice(start, row - start)
                start, total = row, 0
            total += size or 0
        if start < len(sizes):
            yield batch.slice(start)
    give_memory_back()


def give_memory_back() -> None:
    """What a task no longer needs goes back to the system: its worker lives on and others need room beside it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)
