"""Suffix arrays of many short strings by induced sorting, with numpy.

A shard is the strings one after another, each ended by a separator.
Symbols are bytes + 1; separators are 0, count as distinct, and sort by
place, so no comparison runs over a string's end. Suffixes are classified
as larger (L) or smaller (S) than their right neighbour, leftmost-smaller
(LMS) substrings are sorted and named, equal names are told apart
recursively (each level joins the names of neighbours into one), and both
types are induced bucket by bucket. Inside a bucket the work is done in
waves: a wave's predecessors with the same symbol make the next wave, so
every step is a vector operation and the whole is linear in the shard.
"""

from __future__ import annotations

import numpy as np


def concatenate(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, places of the separators) of non-empty strings."""
    sizes = np.array([len(s) for s in strings], np.int64)
    ends = np.cumsum(sizes + 1) - 1
    out = np.zeros(int(ends[-1]) + 1 if len(ends) else 0, np.uint16)
    inside = np.ones(len(out), bool)
    inside[ends] = False
    out[inside] = np.frombuffer(b"".join(strings), np.uint8).astype(np.uint16) + 1
    return out, ends


def _smaller(t: np.ndarray) -> np.ndarray:
    """S-type flags."""
    n = len(t)
    same = t[:-1] == t[1:]
    turn = np.where(same, n - 1, np.arange(n - 1))
    turn = np.minimum.accumulate(turn[::-1])[::-1]      # where the run of equal symbols ends
    less = np.append(t[:-1] < t[1:], True)
    return np.append(less[turn], True)


def _deal(heap: list, wave: np.ndarray, t: np.ndarray, kind: np.ndarray, c: int) -> np.ndarray:
    """Put the predecessors of ``wave`` that are of ``kind`` into their
    buckets, in order; return those of bucket ``c`` itself."""
    p = wave[wave > 0] - 1
    p = p[kind[p]]
    if not len(p):
        return p
    symbols = t[p]
    order = np.argsort(symbols, kind="stable")
    p, symbols = p[order], symbols[order]
    cuts = np.flatnonzero(symbols[1:] != symbols[:-1]) + 1
    again = p[:0]
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(p)]):
        s = int(symbols[a])
        if s == c:
            again = p[a:b]
        else:
            heap[s].append(p[a:b])
    return again


def _joined(parts: list, like: np.ndarray) -> np.ndarray:
    return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else like[:0]


def _induce(t, larger, smaller, lms, present) -> tuple[list, list]:
    """Per symbol: L suffixes ascending, S suffixes descending, from LMS
    suffixes in order (grouped by symbol)."""
    sigma = 258
    first = np.searchsorted(t[lms], np.arange(sigma + 1))
    heap: list[list] = [[] for _ in range(sigma)]
    left: list = [lms[:0]] * sigma
    for c in present:
        wave, done = _joined(heap[c], lms), []
        while len(wave):
            done.append(wave)
            wave = _deal(heap, wave, t, larger, c)
        left[c] = _joined(done, lms)
        if first[c] < first[c + 1]:
            _deal(heap, lms[first[c]: first[c + 1]], t, larger, c)
    heap = [[] for _ in range(sigma)]
    right: list = [lms[:0]] * sigma
    for c in reversed(present):
        if c == 0:
            break
        wave, done = _joined(heap[c], lms), []
        while len(wave):
            done.append(wave)
            wave = _deal(heap, wave, t, smaller, c)
        right[c] = _joined(done, lms)
        _deal(heap, left[c][::-1], t, smaller, c)
    return left, right


def _order_names(rank: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string of names. ``order``: its indices
    by name; ``rank``: per index the first place of its name in ``order``.
    Each level compares twice as many names, for the still equal alone."""
    step = 1
    slots = np.arange(len(order))
    heads = rank[order]
    size = np.bincount(heads, minlength=len(order))
    open_slots = slots[size[heads] > 1]
    while len(open_slots):
        items = order[open_slots]
        head, nxt = rank[items], rank[items + step]
        by = np.lexsort((nxt, head))
        items, head, nxt = items[by], head[by], nxt[by]
        order[open_slots] = items
        fresh = np.append(True, (head[1:] != head[:-1]) | (nxt[1:] != nxt[:-1]))
        place = np.maximum.accumulate(np.where(fresh, open_slots, 0))
        rank[items] = place
        size = np.bincount(place, minlength=len(order))
        open_slots = open_slots[size[place] > 1]
        step *= 2
    return order


def suffix_array(t: np.ndarray, seps: np.ndarray) -> np.ndarray:
    """Places of all suffixes in order; ``t`` ends with a separator."""
    n = len(t)
    if n == 0:
        return np.empty(0, np.int64)
    seps = seps.astype(np.int32)
    smaller = _smaller(t)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]).astype(np.int32) + 1
    is_sep = t == 0
    larger, inner_smaller = ~smaller, smaller & ~is_sep
    present = np.flatnonzero(np.bincount(t, minlength=258)).tolist()

    # sort LMS substrings
    symbols = t[lms]
    left, right = _induce(t, larger, inner_smaller, lms[np.argsort(symbols, kind="stable")], present)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    in_order = [s[::-1] for s in right]
    ranked = np.concatenate([s[is_lms[s]] for s in in_order]) if in_order else lms[:0]
    del left, right, in_order

    # name them; a substring that ends at a separator has a name of its own
    index = np.full(n, -1, np.int32)
    index[lms] = np.arange(len(lms), dtype=np.int32)
    nxt = np.append(lms[1:], n - 1)
    size = (nxt - lms)[index[ranked]]
    whole = is_sep[nxt[index[ranked]]]
    new = np.ones(len(ranked), bool)
    if len(ranked) > 1:
        a, b = ranked[:-1], ranked[1:]
        alike = np.flatnonzero((size[:-1] == size[1:]) & ~whole[:-1] & ~whole[1:])
        k = 0
        while len(alike):
            alike = alike[t[a[alike] + k] == t[b[alike] + k]]
            ended = size[alike] <= k
            new[alike[ended] + 1] = False
            alike = alike[~ended]
            k += 1
    m = len(seps)
    order = np.concatenate([index[seps], index[ranked]]).astype(np.int64)
    heads = np.concatenate([np.arange(m), m + np.maximum.accumulate(np.where(new, np.arange(len(ranked)), 0))]) if len(ranked) else np.arange(m)
    rank = np.empty(len(lms), np.int64)
    rank[order] = heads
    order = _order_names(rank, order)

    sorted_lms = lms[order]
    left, right = _induce(t, larger, inner_smaller, sorted_lms, present)
    parts = [seps]
    for c in present:
        if c:
            parts += [left[c], right[c][::-1]]
    return np.concatenate(parts)


def permuted_lcp(t: np.ndarray, sa: np.ndarray, seps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(plcp, phi): for every place the common prefix with its predecessor
    in the suffix array, and that predecessor (-1: none).

    A place whose left symbol equals its predecessor's left symbol has its
    left neighbour's value less one; only the others are compared.
    """
    n = len(t)
    phi = np.full(n, -1, np.int64)
    phi[sa[1:]] = sa[:-1]
    room = np.repeat(seps, np.diff(np.append(-1, seps))) - np.arange(n)   # symbols before the separator
    at = np.arange(n)
    has = phi >= 0
    prev_same = np.zeros(n, bool)
    inner = np.flatnonzero(has & (at > 0) & (phi > 0))
    prev_same[inner] = (t[inner - 1] == t[phi[inner] - 1]) & (t[inner - 1] != 0)
    start = np.flatnonzero(has & ~prev_same)
    value = np.zeros(n, np.int64)
    padded = np.append(t, np.zeros(4, t.dtype))
    words = (padded[:-3].astype(np.uint64) | padded[1:-2].astype(np.uint64) << np.uint64(16)
             | padded[2:-1].astype(np.uint64) << np.uint64(32) | padded[3:].astype(np.uint64) << np.uint64(48))[:n]
    a, b, own = start.copy(), phi[start], start.copy()
    most = np.minimum(room[a], room[b])
    done = np.zeros(len(a), np.int64)
    while len(own):
        differ = words[np.minimum(a + done, n - 1)] ^ words[np.minimum(b + done, n - 1)]
        same = np.where(differ == 0, 4, np.where(differ & np.uint64(0xFFFF) != 0, 0, np.where(differ & np.uint64(0xFFFF0000) != 0, 1, np.where(differ & np.uint64(0xFFFF00000000) != 0, 2, 3))))
        done += same
        over = (same < 4) | (done >= most)
        value[own[over]] = np.minimum(done[over], most[over])
        go = ~over
        a, b, own, most, done = a[go], b[go], own[go], most[go], done[go]
    # the others: counted down from the last compared place
    reducible = has & prev_same
    anchor = np.maximum.accumulate(np.where(has & ~prev_same, at, -1))
    plcp = np.where(reducible, value[np.maximum(anchor, 0)] - (at - anchor), value)
    return np.maximum(plcp, 0), phi
