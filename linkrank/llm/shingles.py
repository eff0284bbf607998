"""Word shingles of texts as 64-bit hashes, for whole batches of texts at a time."""

from __future__ import annotations

import numpy as np

# A-Z in lower case; the bytes that part words.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_GAPS = np.zeros(256, dtype=bool)
_GAPS[[0x20, *range(0x09, 0x0E)]] = True

_BASE = 0x9E3779B97F4A7C15
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Scrambles 64-bit numbers: distinct ones stay distinct."""
    x = x + np.uint64(salt * 0xD1342543DE82EF95 + 0x2545F4914F6CDD1D & (1 << 64) - 1)
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ x >> np.uint64(32)


def _power_table(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    if len(_powers.get("up", ())) < count:
        size = 1 << max(16, int(count).bit_length())
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def shingle_sets(texts: list[str | None], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text: their hashes, text by text and ascending, and how many each has.

    A text with fewer words than ``size`` has its whole sequence as one; without words, none.
    """
    encoded = [(text or "").encode("utf-8", "surrogatepass").translate(_FOLD) for text in texts]
    raw = np.frombuffer(b" ".join(encoded) + b" ", dtype="u1")
    lengths = np.fromiter(map(len, encoded), dtype=np.int64, count=len(encoded)) + 1
    gap = _GAPS[raw]
    edges = np.flatnonzero(np.diff(np.concatenate([[True], gap]).astype("i1")))
    begins, ends = edges[0::2], edges[1::2]
    up, down = _power_table(len(raw) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)], dtype=np.uint64)])
    hashed = mix((sums[ends] - sums[begins]) * down[begins] + (ends - begins).astype(np.uint64) * np.uint64(_BASE))
    owner = np.repeat(np.arange(len(texts)), lengths)[begins]
    n_words = np.bincount(owner, minlength=len(texts))
    first = np.cumsum(n_words) - n_words
    grams = np.zeros(0, dtype=np.uint64)
    gram_owner = np.zeros(0, dtype=np.int64)
    if len(hashed) >= size:
        count = len(hashed) - size + 1
        grams = hashed[:count]
        for i in range(1, size):
            grams = mix(grams, i) + hashed[i:i + count]
        inside = owner[:count] == owner[size - 1:]
        grams, gram_owner = mix(grams[inside], size), owner[:count][inside]
    short = np.flatnonzero((n_words > 0) & (n_words < size))
    if len(short):
        whole = []
        for text in short.tolist():
            value = np.zeros(1, dtype=np.uint64)
            for i in range(int(n_words[text])):
                value = mix(value, size + 1 + i) + hashed[first[text] + i:first[text] + i + 1]
            whole.append(mix(value, 2 * size + 1 + int(n_words[text])))
        grams, gram_owner = np.concatenate([grams, *whole]), np.concatenate([gram_owner, short])
    order = np.lexsort((grams, gram_owner))
    grams, gram_owner = grams[order], gram_owner[order]
    new = np.ones(len(grams), dtype=bool)
    new[1:] = (grams[1:] != grams[:-1]) | (gram_owner[1:] != gram_owner[:-1])
    return grams[new], np.bincount(gram_owner[new], minlength=len(texts))
