"""Words of a text as places and 64-bit names, and its shingles, in bounded stretches."""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np

from marlstone.llm.common import mix64, prefix_hash, span_hash

#: Bytes looked at together; longer words are named one by one.
STRETCH, LONG = 1 << 20, 1 << 16


def word_places(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each maximal run of bytes that aren't ASCII white space."""
    edges, before = [], False
    for lo in range(0, data.size, STRETCH):
        part = data[lo : lo + STRETCH]
        solid = np.concatenate(([before], ~((part == 32) | ((part >= 9) & (part <= 13)))))
        edges.append(np.flatnonzero(solid[1:] != solid[:-1]) + lo)
        before = bool(solid[-1])
    if before:
        edges.append(np.array([data.size]))
    found = np.concatenate(edges) if edges else np.empty(0, np.int64)
    return found[0::2], found[1::2]


def word_names(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A name for each word, equal for equal words."""
    out = np.empty(start.size, np.uint64)
    lo = 0
    while lo < start.size:
        hi = max(lo + 1, int(np.searchsorted(end, start[lo] + STRETCH)))
        first = int(start[lo])
        if end[hi - 1] - first <= 2 * STRETCH:
            out[lo:hi] = span_hash(prefix_hash(data[first : end[hi - 1]]), start[lo:hi] - first, end[lo:hi] - first)
        for i in (lo + np.flatnonzero(end[lo:hi] - start[lo:hi] > LONG)).tolist():
            out[i] = int.from_bytes(blake2b(data[start[i] : end[i]].tobytes(), digest_size=8).digest(), "little")
        lo = hi
    return out


_BLANK = re.compile(r"[\x20\x09-\x0D]")
_MUL = np.uint64(0x9E3779B97F4A7C15)


def _stretches(text: str) -> Iterator[str]:
    """Stretches of about ``STRETCH`` characters that end at white space."""
    lo = 0
    while lo < len(text):
        cut = _BLANK.search(text, lo + STRETCH)
        hi = cut.end() if cut else len(text)
        yield text[lo:hi]
        lo = hi


def word_hashes(text: str) -> np.ndarray:
    """A hash for each word of the lower-cased text, in order."""
    found = [np.empty(0, np.uint64)]
    for part in _stretches(text):
        data = np.frombuffer(part.lower().encode("utf-8", "surrogatepass"), np.uint8)
        found.append(word_names(data, *word_places(data)))
    return np.concatenate(found)


def shingles(text: str, width: int = 5) -> np.ndarray:
    """The sorted distinct hashes of all runs of ``width`` words.

    A text of fewer words, but one at least, has one shingle of all its words;
    a text without words has none.  At most some 16 bytes a word are held.
    """
    words = word_hashes(text)
    if not words.size:
        return words
    take = min(width, words.size)
    n = words.size - take + 1
    out = np.empty(n, np.uint64)
    # word hashes are spread evenly already, so a polynomial of them is as good as one
    for lo in range(0, n, STRETCH):
        hi = min(n, lo + STRETCH)
        part = words[lo:hi].copy()
        for i in range(1, take):
            part *= _MUL
            part += words[lo + i : hi + i]
        out[lo:hi] = mix64(part)
    del words
    out.sort()
    return out[np.concatenate(([True], out[1:] != out[:-1]))]
