"""Suffix arrays by linear grouping construction (Lyndon grouping), many strings at once.

Phase 1 orders suffixes by their first symbol and then takes the groups from the
highest to the lowest. Each suffix of the group in hand gets a pointer to the
nearest suffix before it that lies in a lower group (previous smaller); the
suffixes so pointed at leave their group for a new one right above it, those hit
more often higher. At the end a group holds the suffixes with one Lyndon prefix.

Phase 2 reads the result from its low end: the suffix before the one just read, and
then the suffixes its previous-smaller pointers lead to, each take the first free
place of their group, until one has its place already. Nothing is renamed and
nothing is solved by recursion.

Both phases are sequential within a string, so a batch of strings goes through
them in step: every round takes one group (phase 1) or one suffix (phase 2) of each
string, as numpy arrays over the batch. The strings must not differ much in length;
``suffix_arrays`` deals them to batches by length.
"""

from __future__ import annotations

import numpy as np


def _runs(sizes: np.ndarray) -> np.ndarray:
    """0..n-1 for each n of ``sizes``, concatenated."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)


def _groups(sym: np.ndarray, base: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phase 1: (suffixes by group, first place of each suffix's group, previous
    smaller suffix). Place ``base - 1`` of each string is a border of group -1."""
    n = len(sym)
    owner = np.repeat(np.arange(len(base)), size)
    at = np.repeat(base, size) + _runs(size)
    order = np.lexsort((sym[at], owner))
    sa = np.zeros(n, np.int64)
    isa = np.zeros(n, np.int64)
    group = np.full(n, -1, np.int64)  # borders stay -1
    gsize = np.zeros(n, np.int64)
    prev = np.arange(n) - 1
    s = at[order]
    sa[at] = s
    isa[s] = at
    new = np.ones(len(at), bool)
    new[1:] = (sym[s][1:] != sym[s][:-1]) | (owner[1:] != owner[:-1])
    firsts = at[new]
    run = np.cumsum(new) - 1
    group[s] = firsts[run]
    gsize[firsts] = np.bincount(run)
    top = base + size - 1  # the highest place not yet taken, by string
    while len(top):
        start = group[sa[top]]
        many = gsize[start]
        member = sa[np.repeat(start, many) + _runs(many)]
        own = np.repeat(start, many)
        # previous smaller: jump over suffixes of the same and of higher groups
        todo, limit = member, own
        while len(todo):
            p = prev[todo]
            over = group[p] >= limit
            todo, limit, p = todo[over], limit[over], p[over]
            prev[todo] = prev[p]
        hit = prev[member]
        hit = hit[group[hit] >= 0]
        if len(hit):
            hit.sort()
            edge = np.flatnonzero(np.concatenate(([True], hit[1:] != hit[:-1])))
            times = np.diff(np.append(edge, len(hit)))
            hit = hit[edge]
            old = group[hit]
            by = np.lexsort((times, old))
            hit, times, old = hit[by], times[by], old[by]
            # the hit suffixes go to the high end of their group's places
            edge = np.flatnonzero(np.concatenate(([True], old[1:] != old[:-1])))
            moved = np.diff(np.append(edge, len(hit)))
            g = old[edge]
            to = np.repeat(g + gsize[g] - moved, moved) + _runs(moved)
            low = np.repeat(g + gsize[g] - moved, moved)
            was = isa[hit]
            there = sa[to]
            # who is at the high end without being hit takes the places set free below it
            stays = np.zeros(len(to), bool)
            inside = was >= low
            if not inside.all():
                stays[:] = True
                stays[np.searchsorted(to, was[inside])] = False
                free, put = was[~inside], there[stays]
                sa[free] = put
                isa[put] = free
            sa[to] = hit
            isa[hit] = to
            gsize[g] -= moved
            new = np.concatenate(([True], (old[1:] != old[:-1]) | (times[1:] != times[:-1])))
            edge = np.flatnonzero(new)
            firsts = to[edge]
            many = np.diff(np.append(edge, len(hit)))
            group[hit] = np.repeat(firsts, many)
            gsize[firsts] = many
        top = start - 1
        live = group[sa[top]] >= 0
        live &= isa[sa[top]] == top  # a border's place holds no suffix
        top = top[live]
    return sa, group, prev


def _emit(sa: np.ndarray, group: np.ndarray, prev: np.ndarray, base: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Phase 2: places of all strings, filled in ascending order of their suffixes."""
    n = len(sa)
    free = np.arange(n)
    out = np.zeros(n, np.int64)
    placed = np.zeros(n, bool)
    placed[base - 1] = True  # borders
    last = base + size - 1  # the end symbol is the least
    out[base] = last
    placed[last] = True
    end = base + size
    read = base.copy()
    j = last - 1
    while len(read):
        bad = placed[j]
        while bad.any():
            w = np.flatnonzero(bad)
            read[w] += 1
            w = w[read[w] < end[w]]
            j[w] = out[read[w]] - 1
            bad[:] = False
            bad[w] = placed[j[w]]
        live = read < end
        if not live.all():
            read, end, j = read[live], end[live], j[live]
        g = group[j]
        at = free[g]
        out[at] = j
        free[g] = at + 1
        placed[j] = True
        j = prev[j]
    return out


def _batch(strings: list[np.ndarray]) -> list[np.ndarray]:
    size = np.array([len(s) + 1 for s in strings], np.int64)
    base = np.cumsum(size + 1) - size  # a border before each string
    sym = np.zeros(int((size + 1).sum()), np.int32)  # 0: the end symbol, least of all
    for s, b in zip(strings, base.tolist()):
        sym[b:b + len(s)] = s.astype(np.int32) + 1
    sa, group, prev = _groups(sym, base, size)
    out = _emit(sa, group, prev, base, size)
    return [out[b + 1:b + n] - b for b, n in zip(base.tolist(), size.tolist())]


def suffix_arrays(strings: list[np.ndarray], batch_symbols: int = 2_000_000) -> list[np.ndarray]:
    """The suffix array of each string (arrays of integers of 0 or more)."""
    by = sorted(range(len(strings)), key=lambda i: len(strings[i]))
    out: list = [None] * len(strings)
    batch: list[int] = []
    total = 0
    for i in by:
        batch.append(i)
        total += len(strings[i]) + 2
        if total >= batch_symbols:
            for k, s in zip(batch, _batch([strings[k] for k in batch])):
                out[k] = s
            batch, total = [], 0
    if batch:
        for k, s in zip(batch, _batch([strings[k] for k in batch])):
            out[k] = s
    return out
