"""Word shingle sets of Arrow text batches, hashed to 64 bits with numpy."""

from __future__ import annotations

import numpy as np

from .common import splitmix

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_RNG = np.random.default_rng(20240)
#: Value of a byte inside a word; white space adds nothing.
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BYTE = _BYTE[_LOWER]
_BYTE[_SPACE] = 0
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = _RNG.integers(1, 1 << 63, 8, dtype=np.uint64) | np.uint64(1)
SLICE_WORDS = 400_000


def word_hashes(off: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, first word of every document plus the total).

    Words are runs of anything but ASCII white space; A-Z count as a-z.
    """
    n = len(raw)
    if not n:
        return np.empty(0, np.uint64), np.zeros(len(off), np.int64)
    word = ~_SPACE[raw]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = word[:-1]
    inner = off[1:-1][off[1:-1] < n]
    before[inner] = False                       # a document's first byte starts a word
    starts = np.flatnonzero(word & ~before)
    firsts = np.searchsorted(starts, off)
    if not len(starts):
        return np.empty(0, np.uint64), firsts
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = word[1:]
    after[inner[inner > 0] - 1] = False
    ends = np.flatnonzero(word & ~after) + 1
    out = np.empty(len(starts), np.uint64)
    powers = np.empty(0, np.uint64)
    for a in range(0, len(starts), SLICE_WORDS):
        s, e = starts[a: a + SLICE_WORDS], ends[a: a + SLICE_WORDS]
        span = raw[s[0]: e[-1]]
        longest = int(np.diff(np.append(s, e[-1])).max())
        if longest > len(powers):
            powers = np.full(longest + 64, _STEP, np.uint64)
            powers[0] = 1
            powers = np.multiply.accumulate(powers)
        place = np.arange(len(span), dtype=np.int64) - np.repeat(s - s[0], np.diff(np.append(s, e[-1])))
        value = _BYTE[span] * powers[place]
        out[a: a + SLICE_WORDS] = np.add.reduceat(value, s - s[0])
    return splitmix(out ^ ((ends - starts).astype(np.uint64) * _MIX[7])), firsts


def shingle_sets(off: np.ndarray, raw: np.ndarray, k: int):
    """Per document: its sorted distinct shingle hashes (k consecutive
    words; with fewer words the whole sequence as one; none: empty)."""
    words, firsts = word_hashes(off, raw)
    if len(words) >= k:
        rolled = words[: len(words) - k + 1] * _MIX[0]
        for i in range(1, k):
            rolled = rolled + words[i: len(words) - k + 1 + i] * _MIX[i]
        rolled = splitmix(rolled)
    for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist()):
        if b - a >= k:
            own = np.sort(rolled[a: b - k + 1])
            if len(own) > 1:
                own = own[np.append(True, own[1:] != own[:-1])]
        elif b > a:
            own = splitmix((words[a:b] * _MIX[: b - a]).sum(keepdims=True, dtype=np.uint64) + np.uint64(b - a))
        else:
            own = np.empty(0, np.uint64)
        yield own


def set_id(own: np.ndarray) -> int:
    """62-bit fingerprint of a set, the same for equal sets."""
    total = splitmix(own ^ _MIX[6]).sum(keepdims=True, dtype=np.uint64)
    return int(splitmix(total ^ splitmix(np.array([len(own)], np.uint64)))[0] >> np.uint64(2))
