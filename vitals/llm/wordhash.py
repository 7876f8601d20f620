"""Hashed features of all words of many texts at once, in numpy.

Words are cut, stripped, lower-cased and hashed byte by byte, all words of some texts beside each other, so the
work is a few array operations for each byte and does not depend on how many words differ. The result
equals ``features`` of each word; words too long or with too many marks around them go through it.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np

BUCKETS = 1 << 20
PREFIXES = (4, 5, 6)
PER_WORD = len(PREFIXES) + 1
PUNCTUATION = b".,;:!?'\"()[]{}<>#*$%&|-_/"
SPACES = b" \t\n\r\v\f"
# Words of more bytes, or with more punctuation marks on one side, are hashed one by one.
LONGEST = 64
MOST_STRIPPED = 6

LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
SPACE, MARK = (np.isin(np.arange(256), np.frombuffer(some, np.uint8)) for some in (SPACES, PUNCTUATION))


def features(word: bytes) -> list[int]:
    """Buckets of a word in UTF-8: of the whole, and of its beginnings where they are shorter."""
    letters = word.strip(PUNCTUATION).lower()
    return [zlib.crc32(letters) % BUCKETS] + [zlib.crc32(letters[:n], n) % BUCKETS for n in PREFIXES if len(letters) > n]


def _steps() -> np.ndarray:
    """The checksum's table: what each lowest byte of its register adds when the byte is shifted out."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


STEPS = _steps()
# What starting at n instead of 0 changes in the checksum of any n bytes.
STARTED = {n: np.uint32(zlib.crc32(bytes(n), n) ^ zlib.crc32(bytes(n))) for n in PREFIXES}


def hashed(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``features`` of all words, a row of ``PER_WORD`` each with ``BUCKETS`` where a word has fewer, and the
    edges of the texts among the rows (one more than texts)."""
    raw = b" " + b" ".join(texts) + b" "
    data = np.frombuffer(raw, np.uint8)
    inside = ~SPACE[data]
    turns = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = turns[::2], turns[1::2]
    edges = np.searchsorted(starts, np.cumsum([0, *(len(t) + 1 for t in texts)]))
    first, last = _stripped(data, starts, ends)
    length = last - first
    odd = (length > LONGEST) | ((length > 0) & (MARK[data[first]] | MARK[data[last - 1]]))
    length[odd] = 0
    found = _checksums(LOWER[data], first, length)
    for i in np.flatnonzero(odd).tolist():
        own = features(raw[starts[i] : ends[i]])
        found[i] = own + [BUCKETS] * (PER_WORD - len(own))
    return found, edges


def _stripped(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of words without up to ``MOST_STRIPPED`` punctuation marks on each side."""
    first, last = starts.copy(), ends.copy()
    left = np.flatnonzero(MARK[data[starts]])
    for _ in range(MOST_STRIPPED):
        first[left] += 1
        left = left[first[left] < last[left]]
        left = left[MARK[data[first[left]]]]
    right = np.flatnonzero(MARK[data[ends - 1]] & (first < last))
    for _ in range(MOST_STRIPPED):
        last[right] -= 1
        right = right[first[right] < last[right]]
        right = right[MARK[data[last[right] - 1]]]
    return first, last


def _checksums(data: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Buckets of words of up to ``LONGEST`` bytes, the longest last so that those with a further byte are neighbours."""
    found = np.full((len(first), PER_WORD), BUCKETS, np.int32)
    order = np.argsort(length.astype(np.uint8), kind="stable")
    at = first[order]
    longer = np.searchsorted(length[order], np.arange(LONGEST + 1), side="right")
    register = np.full(len(at), 0xFFFFFFFF, np.uint32)
    for k in range(int(length.max(initial=0))):
        more = longer[k]
        own = register[more:]
        own ^= data[at[more:] + k]
        register[more:] = STEPS[own & 255] ^ (own >> 8)
        if k + 1 in STARTED:
            rest = longer[k + 1]
            bucket = (register[rest:] ^ STARTED[k + 1] ^ np.uint32(0xFFFFFFFF)) % BUCKETS
            found[order[rest:], 1 + PREFIXES.index(k + 1)] = bucket
    found[order, 0] = (register ^ np.uint32(0xFFFFFFFF)) % BUCKETS
    return found
