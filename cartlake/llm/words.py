"""Words and word shingles of UTF-8 texts as 64-bit hashes, computed with numpy.

A word is a run of bytes other than space, tab, LF, VT, FF and CR; A-Z count as a-z.
"""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE2 = np.uint64(0xD6E8FEB86659FD93)
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i below n, kept for the next call."""
    key = int(base)
    if key not in _tables or len(_tables[key][0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        inverse = np.uint64(pow(key, -1, 1 << 64))
        up, down = np.full(size, base), np.full(size, inverse)
        up[0] = down[0] = 1
        _tables[key] = (np.cumprod(up), np.cumprod(down))
    return _tables[key]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, second: bool = False) -> np.ndarray:
    """Hash of each values[start:end], equal for equal spans wherever they lie."""
    base = _BASE2 if second else _BASE
    up, down = _powers(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts, byte ends and hashes of the words in a byte array."""
    gap = np.ones(len(data) + 2, np.int8)
    gap[1:-1] = (data == 32) | ((data - np.uint8(9)) <= 4)
    turn = np.diff(gap)
    starts, ends = np.flatnonzero(turn == -1), np.flatnonzero(turn == 1)
    lower = data + ((data - np.uint8(65)) < 26).astype(np.uint8) * np.uint8(32)
    return starts, ends, span_hashes(lower.astype(np.uint64) + np.uint64(1), starts, ends)


def document_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, bounds, byte starts, byte ends, byte offsets of texts): words of text i are hashes[bounds[i]:bounds[i+1]]."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(x) + 1 for x in texts], out=offsets[1:])
    starts, ends, hashes = words_of(data)
    return hashes, np.searchsorted(starts, offsets), starts, ends, offsets


def shingle_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each word on; entries that reach past a text are not valid."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total = total * _BASE + hashes[j : j + n]
    return mix(total)


def shingle_set(hashes: np.ndarray, shingles: np.ndarray, begin: int, end: int, k: int) -> np.ndarray:
    """Distinct shingle hashes of words begin..end; fewer than k words count as one shingle."""
    if end <= begin:
        return np.zeros(0, np.uint64)
    if end - begin < k:
        return span_hashes(hashes[begin:end], np.array([0]), np.array([end - begin]))
    return np.unique(shingles[begin : end - k + 1])


_SPACES = b" \t\n\x0b\x0c\r"
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def exact_shingles(text: bytes, k: int) -> set[tuple[bytes, ...]]:
    """The shingle set as the words themselves, for exact checks."""
    words = split_words(text)
    if len(words) < k:
        return {tuple(words)} if words else set()
    return set(zip(*(words[j:] for j in range(k))))


def alike(a: set, b: set, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union; empty sets are like nothing."""
    if not a or not b or 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    shared = len(a & b)
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def split_words(text: bytes) -> list[bytes]:
    return [w for w in text.translate(_LOWER).translate(bytes.maketrans(_SPACES, b" " * 6)).split(b" ") if w]


def few_edits(a: list[bytes], b: list[bytes], percent: int) -> bool:
    """Whether the word edit distance is at most (100 - percent) % of the longer sequence; empty ones are like nothing."""
    most = (100 - percent) * max(len(a), len(b)) // 100
    if not a or not b or abs(len(a) - len(b)) > most:
        return False
    begin = 0
    while begin < min(len(a), len(b)) and a[begin] == b[begin]:
        begin += 1
    a, b = a[begin:], b[begin:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    if not a or not b:
        return max(len(a), len(b)) <= most
    masks: dict[bytes, int] = {}
    for i, w in enumerate(a):
        masks[w] = masks.get(w, 0) | 1 << i
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    plus, minus, score = full, 0, len(a)
    for w in b:
        eq = masks.get(w, 0)
        zero = (((eq & plus) + plus) ^ plus) | eq | minus
        up, down = minus | (full & ~(zero | plus)), plus & zero
        score += bool(up & top) - bool(down & top)
        up, down = (up << 1 | 1) & full, (down << 1) & full
        plus, minus = down | (full & ~(zero | up)), up & zero
    return score <= most
