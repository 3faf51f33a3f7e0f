"""Order of suffixes by the difference cover modulo 3, to a bounded depth, in numpy."""

from __future__ import annotations

import numpy as np


def ranks(symbols: np.ndarray, depth: int) -> np.ndarray:
    """For each position, how many suffixes are smaller. Suffixes whose first `depth` symbols agree may tie, and no others.

    Suffixes at positions 1 and 2 modulo 3 are the sample: their triples are sorted and named, and while names repeat and
    depth is left, the string of names is ranked the same way. The other suffixes follow from a symbol and a sample rank.
    Symbols are not negative; what follows the end counts as 0.
    """
    n = len(symbols)
    if n == 0:
        return np.zeros(0, np.int64)
    if n < 3:
        padded = np.concatenate([symbols, np.zeros(3, np.int64)])
        full = [tuple(padded[k : k + 3]) for k in range(n)]
        return np.array([sum(y < x for y in full) for x in full], np.int64)
    s = np.concatenate([symbols.astype(np.int64), np.zeros(4, np.int64)])
    one = np.arange(1, n + (n % 3 == 1), 3)  # with a dummy at n, so that a name that ends stands between the halves
    two = np.arange(2, n, 3)
    sample = np.concatenate([one, two])
    names = _names(s[sample], s[sample + 1], s[sample + 2])
    if depth > 3 and names.max(initial=0) + 1 < len(names):
        names = ranks(names + 1, -(-depth // 3))
    at = np.zeros(n + 4, np.int64)  # rank of a sample suffix, from 1; 0 past the end
    at[sample] = _dense(names) + 1
    top = int(at.max()) + 1
    zero = np.arange(0, n, 3)
    sample = sample[sample < n]
    one, two = one[one < n], two
    both = s[:-1] * (int(s.max()) + 1) + s[1:]
    if (int(s.max()) + 1) ** 2 * top >= 2**63:
        both = _dense(both)
    pair0, triple0 = s[zero] * top + at[zero + 1], both[zero] * top + at[zero + 2]
    pair1, triple2 = s[one] * top + at[one + 1], both[two] * top + at[two + 2]
    out = np.zeros(n, np.int64)
    sorted1, sorted2, sorted0, sorted00 = np.sort(pair1), np.sort(triple2), np.sort(pair0), np.sort(triple0)
    out[zero] = np.searchsorted(sorted0, pair0) + np.searchsorted(sorted1, pair0) + np.searchsorted(sorted2, triple0)
    own = at[sample]
    smaller = np.searchsorted(np.sort(own), own)
    out[sample] = smaller
    out[one] += np.searchsorted(sorted0, pair1)
    out[two] += np.searchsorted(sorted00, triple2)
    return out


def _dense(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_inverse=True)[1]


def _names(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    bits = max(1, int(max(a.max(initial=0), b.max(initial=0), c.max(initial=0))).bit_length())
    if 3 * bits < 63:
        return _dense((a << 2 * bits) | (b << bits) | c)
    return _dense((_dense((a << 31) | b) << 31) | c)

