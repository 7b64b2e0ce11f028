"""Two-stage suffix sorting of a block of byte strings, with neighbours' common prefixes.

Stage one sorts only the suffixes that are smaller than their successors, seven symbols
at a time and only where they still tie.  Stage two scans the buckets of first symbols
from the smallest to the largest: the suffix before each one found, if it is larger than
its successor, is the next of its own bucket.  Then the common prefixes of neighbours are
counted.  Strings end with a symbol below all bytes.
"""

from __future__ import annotations

import numpy as np

PACK = 7  # symbols of 9 bits in one key


def joined(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of the strings, each followed by 1, and where each string starts."""
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]) if len(strings) else np.zeros(0, np.int64)
    x = np.frombuffer(b"".join(s + b"\0" for s in strings), np.uint8).astype(np.int64) + 2
    x[starts + sizes] = 1
    return x, starts


def _keys(x: np.ndarray) -> np.ndarray:
    """Seven symbols from each place on as one integer, largest first; beyond the end are zeros."""
    padded = np.concatenate([x, np.zeros(PACK, np.int64)])
    key = np.zeros(len(x), np.int64)
    for j in range(PACK):
        key = (key << 9) | padded[j:j + len(x)]
    return key


def two_stage(x: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in the order of at least their first ``depth`` symbols, and common prefixes up to ``depth``.

    ``lcp[k]`` belongs to ranks k-1 and k.
    """
    n = len(x)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys = _keys(x)
    step = np.append(np.sign(np.diff(x)), -1)  # the end is below everything
    known = np.where(step != 0, np.arange(n), n)
    small = step[np.minimum.accumulate(known[::-1])[::-1]] > 0  # smaller than its successor
    direct = _sort_directly(np.flatnonzero(small), keys, depth)
    first = x[direct]
    at = np.searchsorted(first, np.arange(260))
    found: list[list[np.ndarray]] = [[] for _ in range(259)]
    found[x[n - 1]].append(np.array([n - 1]))
    out = []
    for c in range(259):
        waves = [np.concatenate(found[c])] if found[c] else []
        while waves and len(waves[-1]):  # suffixes of this bucket bring others of the same one
            before = waves[-1] - 1
            before = before[before >= 0]
            waves.append(before[(x[before] == c) & ~small[before]])
        bucket = np.concatenate([*waves, direct[at[c]:at[c + 1]]])
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket - 1
        before = before[before >= 0]
        before = before[~small[before] & (x[before] > c)]
        if len(before):
            before = before[np.argsort(x[before], kind="stable")]
            symbols, begin = np.unique(x[before], return_index=True)
            for symbol, part in zip(symbols, np.split(before, begin[1:])):
                found[symbol].append(part)
    sa = np.concatenate(out).astype(np.int64)
    return sa, _common(sa, keys, depth)


def _sort_directly(pos: np.ndarray, keys: np.ndarray, depth: int) -> np.ndarray:
    n = len(keys)
    order = pos[np.argsort(keys[pos], kind="stable")]
    k = keys[order]
    group = np.cumsum(np.append(False, k[1:] != k[:-1])) if len(order) else np.zeros(0, np.int64)
    at = np.arange(len(order))
    done = PACK
    while done < depth:
        tied = np.zeros(len(group), bool)
        same = group[1:] == group[:-1]
        tied[1:] |= same
        tied[:-1] |= same
        if not tied.any():
            break
        at, group = at[tied], group[tied]
        p = order[at]
        k = np.where(p + done < n, keys[np.minimum(p + done, n - 1)], 0)
        o = np.lexsort((k, group))
        order[at] = p[o]
        k, g = k[o], group[o]
        group = np.cumsum(np.append(False, (g[1:] != g[:-1]) | (k[1:] != k[:-1])))
        done += PACK
    return order


def _common(sa: np.ndarray, keys: np.ndarray, depth: int) -> np.ndarray:
    n = len(sa)
    lcp = np.zeros(n, np.int64)
    live = np.arange(1, n)
    done = 0
    while done < depth and len(live):
        a, b = sa[live - 1] + done, sa[live] + done
        inside = (a < n) & (b < n)
        live, a, b = live[inside], a[inside], b[inside]
        diff = keys[a] ^ keys[b]
        high = np.zeros(len(diff), np.int64)
        some = diff > 0
        # 63-bit integers: the float's exponent may round up, which the shift puts right
        high[some] = np.frexp(diff[some].astype(np.float64))[1]
        over = some & ((diff >> np.maximum(high - 1, 0)) == 0)
        high[over] -= 1
        lcp[live] += np.where(some, PACK - 1 - (high - 1) // 9, PACK)
        live = live[~some]
        done += PACK
    return np.minimum(lcp, depth)
