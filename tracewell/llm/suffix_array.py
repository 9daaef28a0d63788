"""Suffix arrays by induced sorting, and permuted common prefixes, on NumPy arrays of one shard.

Suffixes are classified as larger (L) or smaller (S) than the next one; a leftmost smaller suffix (LMS) is an S that
follows an L. ``order`` sorts the substrings between LMS positions, names them, sorts the string of names recursively if
names repeat, and induces all suffixes: L-suffixes from the LMS ones that end their runs, then S-suffixes from the
L-suffixes that end theirs. A run is followed by doubling steps, all runs at a time, each of which sorts only what is
still tied and whose run is not over; so the work is a few passes over the shard, and no step is one suffix in Python.
"""

from __future__ import annotations

import numpy as np

#: Ranks and places of a shard are packed in 21 bits each.
LIMIT = 1 << 21
_21, _42 = np.uint64(21), np.uint64(42)


def _sorted(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of (first, second), and whether each differs from the one before."""
    key = np.sort(first.astype(np.uint64) << _42 | second.astype(np.uint64) << _21 | np.arange(len(first), dtype=np.uint64))
    place = (key & np.uint64(LIMIT - 1)).astype(np.int64)
    key >>= _21
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    return place, new


def _starts(new: np.ndarray) -> np.ndarray:
    """For each place in a sorted list, the place at which its class begins."""
    return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))


def _dense(ranks: np.ndarray, size: int) -> np.ndarray:
    """Ranks from zero without gaps."""
    seen = np.zeros(size, np.int64)
    seen[ranks] = 1
    return (np.cumsum(seen) - 1)[ranks]


def _follow(base: np.ndarray, members: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Ranks (the place of the class in sorted order) of ``members``, in an array by position. ``base`` ranks them by
    their first symbol, or exactly where a run ends; ``left`` is the number of steps to the end of each one's run."""
    rank = np.zeros(len(base), np.int64)
    on = left[members] > 0
    after = np.zeros(len(members), np.int64)
    after[on] = base[members[on] + 1]
    place, new = _sorted(base[members], after)
    rank[members[place]] = _starts(new)
    step = 2
    tied = np.ones(len(place), bool)
    tied[new & np.append(new[1:], True)] = False
    open_ = members[place[tied]]
    open_ = open_[left[open_] >= step]
    while len(open_):
        place, new = _sorted(rank[open_], rank[open_ + step])
        at = open_[place]
        whole = np.ones(len(at), bool)
        whole[1:] = rank[at[1:]] != rank[at[:-1]]
        rank[at] += _starts(new) - _starts(whole)
        single = new & np.append(new[1:], True)
        step *= 2
        open_ = at[~single]
        open_ = open_[left[open_] >= step]
    return rank


def _steps(ends: np.ndarray) -> np.ndarray:
    """Steps from each position to the next marked one."""
    n = len(ends)
    nearest = np.where(ends, np.arange(n), n)
    return np.minimum.accumulate(nearest[::-1])[::-1] - np.arange(n)


def _induced(s: np.ndarray, small: np.ndarray, lms: np.ndarray, lms_rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of the L- and of the S-suffixes, induced from dense ranks of the LMS ones (which follow their symbols)."""
    n, symbols = len(s), int(s.max()) + 1
    large = ~small
    # rank of L-suffixes: one class a symbol, before the S-suffixes of that symbol
    below = np.zeros(symbols + 1, np.int64)
    np.maximum.at(below, s[lms] + 1, lms_rank + 1)
    below = np.maximum.accumulate(below)
    base = s + below[s]
    base[lms] = s[lms] + 1 + lms_rank
    known = large.copy()
    known[lms] = True
    of_large = _follow(base, np.flatnonzero(known), np.where(large, _steps(small), 0))
    # S-suffixes: one class a symbol, after the L-suffixes of that symbol
    ends = np.zeros(n, bool)
    ends[1:] = large[1:] & small[:-1]
    last = np.flatnonzero(ends)
    dense = _dense(of_large[last], n) if len(last) else last
    upto = np.zeros(symbols, np.int64)
    np.maximum.at(upto, s[last], dense + 1)
    upto = np.maximum.accumulate(upto)
    base = s + upto[s]
    base[last] = s[last] + dense
    known = small | ends
    left = np.where(small, _steps(large), 0)
    left[-1] = 0
    return of_large, _follow(base, np.flatnonzero(known), left)


def order(s: np.ndarray) -> np.ndarray:
    """The suffix array of ``s``: whole numbers from 0, the last one the only 0; fewer than LIMIT."""
    s = s.astype(np.int64)
    n = len(s)
    if n >= LIMIT:
        raise ValueError("a shard must have fewer than 2^21 symbols")
    if n == 1:
        return np.zeros(1, np.int64)
    # S if smaller than the next symbol, or equal to it and the next is S: the type of the next place that differs
    change = np.append(s[1:] != s[:-1], True)
    at = np.minimum.accumulate(np.where(change, np.arange(n), n)[::-1])[::-1]
    rising = np.append(s[1:] > s[:-1], True)
    small = rising[at]
    is_lms = np.zeros(n, bool)
    is_lms[1:] = small[1:] & ~small[:-1]
    lms = np.flatnonzero(is_lms)
    symbols = int(s.max()) + 1
    _, of_small = _induced(s, small, lms, _dense(s[lms], symbols))
    names = _dense(of_small[lms], n)
    if len(lms) > 1 and names.max() + 1 < len(lms):
        # the last LMS substring is the final symbol, alone in having the least name
        by_rank = order(names)
        names = np.empty(len(lms), np.int64)
        names[by_rank] = np.arange(len(lms))
    of_large, of_small = _induced(s, small, lms, names)
    out = np.empty(n, np.int64)
    counts = np.bincount(s * 2 + small, minlength=2 * symbols)
    first = np.cumsum(counts) - counts
    for kind, rank in ((0, of_large), (1, of_small)):
        own = np.flatnonzero(small == bool(kind))
        slots = np.full(n, -1)
        slots[rank[own]] = own
        own = slots[slots >= 0]
        group = s[own] * 2 + kind
        here = np.bincount(group, minlength=2 * symbols)
        out[first[group] + np.arange(len(own)) - (np.cumsum(here) - here)[group]] = own
    return out


def common_prefixes(text: np.ndarray, symbols: np.ndarray, suffixes: np.ndarray, remaining: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(plcp, before): for each position of the bytes ``text`` (ends of pieces told apart in ``symbols``), the length of the prefix that it shares with the suffix
    before it in the order, as far as ``remaining`` allows, and that suffix's position. Only irreducible values (those
    whose preceding symbols differ, and the first of each piece, ``begins``) are compared; the others are one less than
    the value before them."""
    n = len(text)
    before = np.empty(n, np.int64)
    before[suffixes[1:]] = suffixes[:-1]
    before[suffixes[0]] = -1
    reducible = np.zeros(n, bool)
    reducible[1:] = (before[1:] > 0) & (symbols[:-1] == symbols[np.maximum(before[1:] - 1, 0)])
    reducible[begins] = False
    heads = np.flatnonzero(~reducible)
    length = np.zeros(n, np.int64)
    padded = np.zeros(n + 16, np.uint8)
    padded[:n] = text
    words = np.ndarray((n + 8,), "<u8", padded.tobytes(), strides=(1,))
    i = heads[before[heads] >= 0]
    i = i[remaining[i] > 0]
    bound = np.minimum(remaining[i], remaining[before[i]])
    off = 0
    while len(i):
        x = words[i + off] ^ words[before[i] + off]
        same = np.where(x == 0, 8, np.bitwise_count((x & (~x + np.uint64(1))) - np.uint64(1)).astype(np.int64) >> 3)
        length[i] = np.minimum(off + same, bound)
        off += 8
        on = (x == 0) & (bound > off)
        i, bound = i[on], bound[on]
    head = np.maximum.accumulate(np.where(reducible, 0, np.arange(n)))
    return np.maximum(length[head] - (np.arange(n) - head), 0), before


def repeated(pieces: list[bytes], twice: np.ndarray, length: int) -> list[list[tuple[int, int]]]:
    """For each piece, runs (first, last) of the places where a string of ``length`` bytes starts that also starts
    elsewhere among the pieces; all places of a piece that stands for two or more (``twice``)."""
    sizes = np.array([len(p) for p in pieces])
    begins = np.cumsum(sizes + 1) - (sizes + 1)
    text = np.frombuffer(b"\0".join(pieces) + b"\0\0", np.uint8)
    n = len(text)
    owner = np.repeat(np.arange(len(pieces)), sizes + 1)
    remaining = np.zeros(n, np.int64)
    remaining[: n - 1] = begins[owner] + sizes[owner] - np.arange(n - 1)
    symbols = text.astype(np.int64) + 2
    symbols[begins + sizes] = 1  # the end of a piece
    symbols[-1] = 0
    plcp, before = common_prefixes(text, symbols, order(symbols), remaining, begins)
    found = plcp >= length
    found[before[found]] = True
    found[: n - 1] |= twice[owner] & (remaining[: n - 1] >= length)
    edge = np.diff(np.concatenate([[0], found.astype(np.int8), [0]]))
    out: list[list[tuple[int, int]]] = [[] for _ in pieces]
    for lo, hi in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
        k = int(owner[lo])
        out[k].append((lo - int(begins[k]), hi - 1 - int(begins[k])))
    return out
