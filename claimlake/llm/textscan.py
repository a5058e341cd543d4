"""Words and word shingles of many texts at once, on their UTF-8 bytes (numpy).

Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z in lower case. All
separators are ASCII, so the scan works on bytes. A word's hash is
``sum(v[byte] * B**i)`` modulo 2^64, taken from running sums, then mixed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_VALUES = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Texts are scanned in groups of about this many bytes, which bounds memory.
GROUP_BYTES = 1 << 18


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, _INVERSE):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array (null counts as empty), and where each text ends."""
    texts = texts.fill_null("").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return body, ends - ends[0]


def groups(sizes: np.ndarray, most: int = GROUP_BYTES):
    """Ranges of consecutive texts of about ``most`` bytes (at least one text each)."""
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield start, i
            start, total = i, 0
        total += int(n)
    if start < len(sizes):
        yield start, len(sizes)


class Words:
    """Words of a group of texts: ``start``, ``end`` (in bytes of ``body``), ``doc`` and ``hash``."""

    def __init__(self, body: np.ndarray, ends: np.ndarray):
        n = len(ends) - 1
        at = ends[1:] + np.arange(n)  # a separator after each text
        body = np.insert(body, ends[1:], 0x20) if n else body
        self.body, low = body, _LOWER[body]
        space = _SPACE[body]
        edge = np.flatnonzero(np.diff(np.concatenate(([True], space)).view(np.int8)))
        self.start, self.end = edge[0::2], edge[1::2]
        forward, back = _powers(len(body) + 1)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_VALUES[low] * forward[:-1], dtype=np.uint64)))
        self._sums, self._back = sums, back
        self.hash = self.span_hash(self.start, self.end)
        self.doc = np.searchsorted(at, self.start)
        self.first = np.searchsorted(self.doc, np.arange(n + 1))  # each text's first word
        self.text_start, self.text_end = ends[:-1] + np.arange(n), at

    def span_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of byte ranges of the lower-cased body, wherever they stand."""
        return mix64((self._sums[end] - self._sums[start]) * self._back[start])


def shingle_hashes(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every ``width``-word shingle, and the text each belongs to.

    A text with fewer words has its whole sequence as one shingle (told apart
    by its length); one without words has none.
    """
    h, doc, first = words.hash, words.doc, words.first
    n = len(h) - width + 1
    out, of = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if n > 0:
        whole = doc[:n] == doc[width - 1 :]
        out = np.full(n, np.uint64(width))
        for k in range(width):
            out = mix64(out * np.uint64(0xD6E8FEB86659FD93) + h[k : n + k])
        out, of = out[whole], doc[:n][whole]
    counts = np.diff(first)
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        more = []
        for d in short:
            x = np.full(1, np.uint64(counts[d]))
            for k in range(first[d], first[d + 1]):
                x = mix64(x * np.uint64(0xD6E8FEB86659FD93) + h[k])
            more.append(x[0])
        out, of = np.concatenate((out, np.array(more, np.uint64))), np.concatenate((of, short))
    return out, of


def run_hashes(words: Words, length: int, salt: int = 0) -> np.ndarray:
    """Hashes of every run of ``length`` words, by its first word; runs that cross two texts count too.

    Hashes under different salts are independent of each other.
    """
    each = mix64(words.hash ^ np.uint64(salt)) if salt else words.hash
    forward, back = _powers(len(each) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(each * forward[:-1], dtype=np.uint64)))
    n = max(0, len(each) - length + 1)
    return mix64((sums[length : length + n] - sums[:n]) * back[:n])


def shingle_sets(texts: pa.Array, width: int):
    """For each text in order, the sorted array of its distinct shingle hashes."""
    body, ends = utf8(texts)
    for a, b in groups(np.diff(ends)):
        words = Words(body[ends[a] : ends[b]], ends[a : b + 1] - ends[a])
        h, of = shingle_hashes(words, width)
        order = np.lexsort((h, of))
        h, of = h[order], of[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (of[1:] != of[:-1])
        h, of = h[new], of[new]
        cut = np.searchsorted(of, np.arange(b - a + 1))
        for i in range(b - a):
            yield h[cut[i] : cut[i + 1]]
