"""Sorting of windows by a difference cover, for texts of one suffix bucket.

A difference cover D of 32 has, for any two places, a shift below 32 after which both lie on
residues of D. Ranks of the suffixes on D, taken once, so decide every tie between two windows
that share their first 32 bytes: the tie's two suffixes are compared by one pair of ranks.
"""

from __future__ import annotations

import numpy as np

PERIOD = 32
LENGTH = 100  # bytes of a window


def _cover() -> np.ndarray:
    """A smallest difference cover of the period, found by search over growing sets."""
    def extend(chosen):
        gaps = {(a - b) % PERIOD for a in chosen for b in chosen}
        if len(gaps) == PERIOD:
            return chosen
        if len(chosen) == size:
            return None
        for x in range(chosen[-1] + 1, PERIOD):
            if found := extend([*chosen, x]):
                return found
        return None

    size = 6  # five residues have at most 21 differences
    while not (found := extend([0])):
        size += 1
    return np.array(found)


COVER = _cover()
_on_cover = np.zeros(2 * PERIOD, bool)
_on_cover[COVER] = _on_cover[COVER + PERIOD] = True
#: SHIFT[a, b]: least shift that takes places with residues a and b both onto the cover.
SHIFT = np.array([[next(d for d in range(PERIOD) if _on_cover[a + d] and _on_cover[b + d])
                   for b in range(PERIOD)] for a in range(PERIOD)], np.int64)


def _dense(order: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Ranks from a sorted order and the flags where a new value begins in it."""
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new) - 1
    return rank


def _head_ranks(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Dense ranks of the 32 bytes at each place: by the first eight, then ties by the next."""
    first = words[at].astype(np.uint64)
    order = np.argsort(first)
    new = np.ones(len(at), bool)
    new[1:] = np.diff(first[order]) != 0
    for k in range(1, 4):
        tied = ~new
        tied[:-1] |= ~new[1:]
        tied = np.flatnonzero(tied)
        if not len(tied):
            break
        own = order[tied]
        part = words[at[own] + 8 * k].astype(np.uint64)
        by = np.argsort(part)
        rank = _dense(by, np.concatenate([[True], np.diff(part[by]) != 0]))
        run = np.cumsum(new[tied]) - 1
        code = run * (len(tied) + 1) + rank
        by = np.argsort(code)
        order[tied] = own[by]
        code = code[by]
        new[tied[1:]] = code[1:] != code[:-1]
    return _dense(order, new)


def _double(rank: np.ndarray, later: np.ndarray) -> np.ndarray:
    """Dense ranks of pairs of ranks."""
    code = rank * (len(rank) + 2) + later + 1
    order = np.argsort(code)
    s = code[order]
    return _dense(order, np.concatenate([[True], s[1:] != s[:-1]]) if len(s) else np.zeros(0, bool))


def cover_ranks(words: np.ndarray, size: int) -> np.ndarray:
    """Rank of the 128 bytes at every place on the cover; other places hold zero.

    Ranks of 32 bytes are doubled twice; a place 32 or 64 further is on the cover as well.
    """
    places = (np.arange(0, size, PERIOD)[:, None] + COVER[None, :]).ravel()
    places = places[places < size]
    ranks = np.zeros(size + 4 * PERIOD, np.int64)
    ranks[places] = r = _head_ranks(words, places)
    for step in (PERIOD, 2 * PERIOD):
        later = np.where(places + step < size, ranks[places + step], -1)
        r = _double(r, later)
        ranks[places] = r
    return ranks


def _network(n: int):
    """Pairs of places that Batcher's odd-even merge sort compares, stage by stage."""
    p = 1
    while p < n:
        k = p
        while k >= 1:
            i = np.arange(k % p, n - k)
            # Only neighbours of one merge block, and in it only every second run of k.
            i = i[((i - k % p) // k) % 2 == 0]
            i = i[i // (2 * p) == (i + k) // (2 * p)]
            yield i, i + k
            k //= 2
        p *= 2


def _sort_ties(tied: np.ndarray, edges: np.ndarray, at: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """``tied`` with each group, from one edge to the next, in suffix order, which the cover decides.

    Groups of one size are sorted side by side, so that a group takes the steps of its own size.
    """
    out = tied.copy()
    sizes = np.diff(edges)
    by_size = np.argsort(sizes, kind="stable")
    bounds = np.concatenate([[0], np.flatnonzero(np.diff(sizes[by_size])) + 1, [len(sizes)]])
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        size = int(sizes[by_size[lo]])
        places = edges[by_size[lo:hi]] + np.arange(size)[:, None]
        rows = tied[places]
        spots = at[rows]
        for i, j in _network(size):
            pa, pb = spots[i], spots[j]
            shift = SHIFT[pa % PERIOD, pb % PERIOD]
            swap = ranks[pa + shift] > ranks[pb + shift]
            spots[i], spots[j] = np.where(swap, pb, pa), np.where(swap, pa, pb)
            a, b = rows[i], rows[j]
            rows[i], rows[j] = np.where(swap, b, a), np.where(swap, a, b)
        out[places] = rows
    return out


def repeated_windows(text: np.ndarray, at: np.ndarray, place: np.ndarray, block: int = 1 << 15) -> np.ndarray:
    """Flags the windows of ``LENGTH`` bytes that also begin at a smaller ``place``.

    ``text`` holds the bucket's segments one after the other, ``at`` the windows' places in it (each
    window within a segment), ``place`` where they lie in the corpus.
    """
    flags = np.zeros(len(at), bool)
    if len(at) < 2:
        return flags
    size = len(text)
    padded = np.concatenate([text, np.zeros(8 * PERIOD, np.uint8)])
    words = np.ndarray((size + 7 * PERIOD,), ">u8", padded.tobytes(), strides=(1,))
    group = _head_ranks(words, at)
    count = np.bincount(group)
    tied = np.flatnonzero(count[group] > 1)
    if not len(tied):
        return flags
    tied = tied[np.argsort(group[tied], kind="stable")]
    ranks = cover_ranks(words, size)
    # Blocks of whole tie groups, each sorted on its own.
    edges = np.concatenate([[0], np.flatnonzero(np.diff(group[tied])) + 1, [len(tied)]])
    start = 0
    while start < len(edges) - 1:
        stop = max(start + 1, int(np.searchsorted(edges, edges[start] + block, "right")) - 1)
        part = _sort_ties(tied[edges[start]:edges[stop]], edges[start:stop + 1] - edges[start], at, ranks)
        a, b = at[part[:-1]], at[part[1:]]
        same = group[part[:-1]] == group[part[1:]]
        for k in (*range(PERIOD, LENGTH - 8, 8), LENGTH - 8):
            same &= words[a + k] == words[b + k]
        kind = np.cumsum(np.concatenate([[True], ~same]))
        order = np.lexsort((place[part], kind))
        first = np.concatenate([[True], np.diff(kind[order]) > 0])
        flags[part[order[~first]]] = True
        start = stop
    return flags
