"""Suffix sorting by linear grouping, for many short strings at once.

Every string (a *lane*) is sorted by the two phases of grouping construction:

1. Suffixes start grouped by their first symbol.  Groups are taken from the
   largest down.  Each member points to its previous smaller suffix (the
   nearest one to its left in a lower group); suffixes pointed to by ``l``
   members leave their group for a new one right behind it, larger ``l``
   further up.  At the end a group holds the suffixes with one Lyndon prefix.
2. From the smallest suffix up, the suffix left of each emitted one, and the
   chain of its previous smaller pointers, go to the front of their groups.

No step renames symbols and recurses.  One numpy operation advances all lanes
by one group (or one emitted suffix), so the number of steps is that of the
longest lane, not the sum.
"""

from __future__ import annotations

import numpy as np


def suffix_arrays(text: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Suffix array of each lane ``text[offs[k]:offs[k+1]]`` in place of the lane, as positions in ``text``.

    Each lane must end with a symbol smaller than all its others.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    low, high = offs[:-1].astype(np.int64), offs[1:].astype(np.int64)
    lane = np.repeat(np.arange(len(low)), high - low)
    low_of = low[lane]

    sa = np.lexsort((text, lane))
    first = np.ones(n, bool)
    first[1:] = (text[sa[1:]] != text[sa[:-1]]) | (lane[sa[1:]] != lane[sa[:-1]])
    begin = np.flatnonzero(first)
    count = np.diff(np.append(begin, n))
    size = np.zeros(n, np.int64)
    size[begin] = count
    group = np.empty(n, np.int64)                # first slot of a suffix's group
    group[sa] = np.repeat(begin, count)
    slot = np.empty(n, np.int64)                 # where a suffix stands in sa
    slot[sa] = np.arange(n)
    prev = np.arange(n) - 1
    moving = np.zeros(n, bool)

    last = high - 1
    active = np.flatnonzero(high > low)
    while active.size:
        e = last[active]
        gs = group[sa[e]]
        cnt = e - gs + 1
        ends = np.cumsum(cnt)
        member = np.sort(sa[np.repeat(gs - (ends - cnt), cnt) + np.arange(ends[-1])])
        g = np.repeat(gs, cnt)
        lo = low_of[member]
        p = prev[member]
        todo = np.flatnonzero((p >= lo) & (group[p] >= g))
        while todo.size:
            p[todo] = prev[p[todo]]
            prev[member[todo]] = p[todo]
            q = p[todo]
            todo = todo[(q >= lo[todo]) & (group[q] >= g[todo])]
        q = p[p >= lo]
        if q.size:
            cut = np.flatnonzero(np.diff(q, prepend=-1))
            to = q[cut]
            hits = np.diff(np.append(cut, q.size))
            old = group[to]
            order = np.lexsort((hits, old))
            to, hits, old = to[order], hits[order], old[order]
            g_first = np.flatnonzero(np.diff(old, prepend=-1))
            g_count = np.diff(np.append(g_first, old.size))
            og = old[g_first]
            zone = og + size[og] - g_count
            zone_of = np.repeat(zone, g_count)
            target = zone_of + np.arange(old.size) - np.repeat(g_first, g_count)
            was = slot[to]
            moving[to] = True
            there = sa[target]
            there = there[~moving[there]]
            moving[to] = False
            free = was[was < zone_of]
            sa[free] = there
            slot[there] = free
            sa[target] = to
            slot[to] = target
            size[og] -= g_count
            new = np.ones(old.size, bool)
            new[1:] = (old[1:] != old[:-1]) | (hits[1:] != hits[:-1])
            start = np.flatnonzero(new)
            number = np.diff(np.append(start, old.size))
            group[to] = np.repeat(target[start], number)
            size[target[start]] = number
        last[active] = gs - 1
        active = active[gs > low[active]]

    front = np.arange(n)
    out = np.empty(n, np.int64)
    placed = np.zeros(n, bool)
    live = np.flatnonzero(high > low)
    lo, hi, at = low[live], high[live], low[live].copy()
    out[lo] = hi - 1
    placed[hi - 1] = True
    j = hi - 2
    while at.size:
        put = j >= lo
        put &= ~placed[j]
        here = j[put]
        where = group[here]
        out[front[where]] = here
        front[where] += 1
        placed[here] = True
        nxt = at + ~put
        done = nxt >= hi
        j = np.where(put, prev[j], out[np.minimum(nxt, hi - 1)] - 1)
        at = nxt
        if done.any():
            keep = ~done
            lo, hi, at, j = lo[keep], hi[keep], at[keep], j[keep]
    return out
