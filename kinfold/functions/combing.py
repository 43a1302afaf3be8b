"""String similarities of many pairs at once, as numpy arrays.

Pairs of like length lie side by side in arrays of (position, pair). The longest common subsequence comes from combing
(Tiskin's semi-local comparison): strands enter at the left of each row and at the top of each column of the grid of both
strings; where letters are equal, or two strands have crossed before, they turn away from each other, else they cross. The
strands that lead from top to bottom then count, for every window of the longer string, the letters that have no partner, so
that one pass over the grid gives all windows of a partial ratio. Cells of one antidiagonal don't depend on each other.
Where no windows are wanted, subsequences are found by additions of 64-bit words, a bit for each letter of one string.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Letters of a chunk of pairs, so that its arrays stay in the processor's cache; a pair is a chunk of its own at least.
LETTERS, MANY_LETTERS = 30_000, 300_000
#: Words of a chunk's table of letters' places; strings of more than `LONG` letters are compared one by one, by long integers.
PLACES, LONG = 1 << 17, 512
#: Pairs are sorted by length in steps of so many letters, then by the other length.
STEP = 4


def lcs(a: str, b: str) -> int:
    """The length of the longest common subsequence: one addition of long integers a character of b."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & where.get(c, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


class Alphabet:
    """Small numbers for the letters of some strings; 0 and 1 are padding that never matches."""

    def __init__(self, strings: list[str]):
        text = np.frombuffer("".join(strings).encode("utf-32-le"), np.uint32)
        held = np.zeros(int(text.max(initial=0)) + 1, bool)
        held[text] = True
        n = self.size = int(held.sum()) + 2
        self.kind = np.uint8 if n < 1 << 8 else np.uint16 if n < 1 << 16 else np.uint32
        self.number = (np.cumsum(held) + 1).astype(self.kind)

    def rows(self, strings: list[str], sizes: np.ndarray, pad: int) -> np.ndarray:
        """(position, pair), padded at the end."""
        most = int(sizes.max())
        raw = np.array(strings, dtype=f"U{most}").view(np.uint32).reshape(len(strings), most).T
        inside = np.arange(most)[:, None] < sizes
        return np.where(inside, self.number[np.where(inside, raw, 0) if not len(self.number) > int(raw.max()) else raw], self.kind(pad))


def _chunks(a: list[str], b: list[str], most: int = LETTERS, table: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]]:
    """Of pairs of non-empty strings: numbers of the pairs, lengths and letters of both sides, size of the alphabet.

    A chunk has about `most` letters; with `table`, a table of a bit for each letter of a string and of the alphabet has so many words."""
    if not a:
        return
    letters = Alphabet([*set(a), *set(b)])
    m, n = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b))
    order = np.lexsort((n, m // STEP))
    step, at = (m // STEP)[order], 0
    while at < len(order):
        end, longest = int(np.searchsorted(step, step[at], "right")), int(step[at] + 1) * STEP
        pairs = most // (longest + int(n[order[at]]))
        if table:
            pairs = min(pairs, table // (letters.size * (longest // 64 + 1)))
        to = min(end, at + max(1, pairs))
        while to > at + 1 and (to - at) * int(n[order[to - 1]]) > 2 * most:
            to = at + (to - at) // 2
        own = order[at:to]
        yield own, m[own], n[own], letters.rows([a[i] for i in own], m[own], 0), letters.rows([b[i] for i in own], n[own], 1), letters.size
        at = to


def _combed(short: np.ndarray, long: np.ndarray, h: np.ndarray, v: np.ndarray) -> None:
    """Leads strands h (of rows, last row first) and v (of columns) through the grid, in place; a greater one began further right or above."""
    m, n = len(short), len(long)
    rows, size = np.ascontiguousarray(short[::-1]), min(m, n)
    low, turn = (np.empty((size, short.shape[1]), h.dtype) for _ in range(2))
    same = np.empty((size, short.shape[1]), bool)
    for d in range(m + n - 1):
        j, to = max(0, d - m + 1), min(n, d + 1)
        k, c = m - 1 - d + j, to - j
        x, y, lo, t, e = h[k : k + c], v[j:to], low[:c], turn[:c], same[:c]
        np.equal(rows[k : k + c], long[j:to], out=e)
        np.minimum(x, y, out=lo)
        np.bitwise_xor(lo, y, out=t)
        np.multiply(t, e.view(np.uint8), out=t)
        np.maximum(x, y, out=y)
        np.bitwise_xor(y, t, out=y)
        np.bitwise_xor(lo, t, out=x)


def lcs_many(a: list[str], b: list[str]) -> np.ndarray:
    """The length of each pair's longest common subsequence."""
    out, full = np.zeros(len(a), np.int64), []
    for i, (x, y) in enumerate(zip(a, b, strict=True)):
        if x and y:
            if len(x) > LONG or len(y) > LONG:
                out[i] = lcs(x, y)
            else:
                full.append(i)
    at = np.array(full, np.int64)
    for own, m, n, x, y, size in _chunks([a[i] for i in full], [b[i] for i in full], MANY_LETTERS, PLACES):
        pairs, words = len(own), (len(x) + 63) // 64
        line = np.arange(pairs)
        places = np.zeros((words, size * pairs), np.uint64)
        for i in range(len(x)):
            places[i >> 6][x[i] * np.int64(pairs) + line] |= np.uint64(1 << (i & 63))
        places[:, :pairs] = 0  # of padding
        rows = [np.full(pairs, ~np.uint64(0)) for _ in range(words)]
        for j in range(len(y)):
            letter, carry = y[j] * np.int64(pairs) + line, None
            for w in range(words):
                row = rows[w]
                hit = places[w].take(letter)
                hit &= row
                total = row + hit
                if words > 1:
                    over = total < row
                    if carry is not None:
                        total += carry
                        over |= total < carry
                    carry = over
                row -= hit
                row |= total
        found = np.zeros(pairs, np.int64)
        for w, row in enumerate(rows):
            inside = np.clip(m - 64 * w, 0, 64).astype(np.uint64)
            mask = np.where(inside == 64, ~np.uint64(0), (np.uint64(1) << np.minimum(inside, np.uint64(63))) - np.uint64(1))
            found += np.bitwise_count(~row & mask)
        out[at[own]] = found
    return out


def _windows(short: list[str], long: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The common subsequence of each pair of non-empty strings, and the best ratio of the first with a window of its length (cut off at the ends) of the second."""
    whole, best = np.zeros(len(short), np.int64), np.zeros(len(short))
    for own, m, n, x, y, _ in _chunks(short, long):
        top, wide, pairs = len(x), len(y), len(own)
        kind = np.uint8 if top + wide < 1 << 8 else np.uint16 if top + wide < 1 << 16 else np.uint32
        h = np.repeat(np.arange(top, dtype=kind)[:, None], pairs, 1)
        v = np.repeat(np.arange(top, top + wide, dtype=kind)[:, None], pairs, 1)
        _combed(x, y, h, v)
        # a strand from the top of column s to the bottom of e lacks a partner in the windows that begin after e - m, up to s
        column = np.arange(wide)[:, None]
        through = (v >= top) & (column < n)
        whole[own] = n - through.sum(0)
        at, size = np.arange(pairs) * (top + wide), pairs * (top + wide)
        through &= column - m + top < v
        lost = np.bincount((at + column - m + top)[through], minlength=size) - np.bincount((at + v)[through], minlength=size)
        lost = np.cumsum(lost.reshape(pairs, top + wide), 1)
        begin, m, n = np.arange(1 - top, wide + 1), m[:, None], n[:, None]
        width = np.minimum(begin + m, n) - np.maximum(begin, 0)
        best[own] = np.where((width > 0) & (begin < n), 200.0 * (width - lost) / (m + np.maximum(width, 1)), 0.0).max(1)
    return whole, best


def ratios(a: list[str], b: list[str]) -> np.ndarray:
    """200 * LCS / (length of both); 100 for two empty strings."""
    sizes = np.fromiter((len(x) + len(y) for x, y in zip(a, b, strict=True)), np.int64, len(a))
    return np.where(sizes > 0, 200.0 * lcs_many(a, b) / np.maximum(sizes, 1), 100.0)


def ratios_and_partial(a: list[str], b: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Of each pair the ratio, and the best ratio of the shorter string with a window of the longer."""
    empty = np.array([100.0 if x == y else 0.0 for x, y in zip(a, b, strict=True)])
    ratio, partial = empty.copy(), empty.copy()
    full = np.array([i for i, (x, y) in enumerate(zip(a, b, strict=True)) if x and y and x != y], np.int64)
    if len(full):
        short, long = zip(*(sorted((a[i], b[i]), key=len) for i in full), strict=True)
        whole, partial[full] = _windows(list(short), list(long))
        ratio[full] = 200.0 * whole / np.array([len(x) + len(y) for x, y in zip(short, long, strict=True)])
        even = [k for k, (x, y) in enumerate(zip(short, long, strict=True)) if len(x) == len(y)]
        if even:
            back = _windows([long[k] for k in even], [short[k] for k in even])[1]
            partial[full[even]] = np.maximum(partial[full[even]], back)
    return ratio, partial


def token_sorts(a: list[str], b: list[str]) -> np.ndarray:
    """The ratio of the words in order."""
    held = {s: " ".join(sorted(s.split())) for s in {*a, *b}}
    return ratios([held[s] for s in a], [held[s] for s in b])


def token_sets(a: list[str], b: list[str]) -> np.ndarray:
    """The best ratio of the common words with either side's, and of both sides; common words come first on each side, so that they need no comparing."""
    held = {s: frozenset(s.split()) for s in {*a, *b}}
    out, at, common, own, other = np.zeros(len(a)), [], [], [], []
    for i, (s, t) in enumerate(zip(a, b, strict=True)):
        x, y = held[s], held[t]
        if not x or not y:
            continue
        both = x & y
        if both and (len(both) == len(x) or len(both) == len(y)):
            out[i] = 100.0
            continue
        at.append(i)
        common.append(sum(map(len, both)) + len(both))  # with a space after each
        own.append(" ".join(sorted(x - both)))
        other.append(" ".join(sorted(y - both)))
    if at:
        c = np.array(common)
        left, right = (c + np.fromiter(map(len, w), np.int64, len(w)) for w in (own, other))
        best = 200.0 * (c + lcs_many(own, other)) / (left + right)
        c = np.maximum(c - 1, 0)
        out[at] = np.maximum(best, np.maximum(200.0 * c / (c + left), 200.0 * c / (c + right)))
    return out


def jaro_winklers(a: list[str], b: list[str]) -> np.ndarray:
    """Jaro similarity, raised by a tenth of the rest for each of up to four common first letters where it is above 0.7."""
    out = np.array([1.0 if x == y else 0.0 for x, y in zip(a, b, strict=True)])
    full = np.array([i for i, (x, y) in enumerate(zip(a, b, strict=True)) if x and y and x != y], np.int64)
    for own, m, n, x, y, _ in _chunks([a[i] for i in full], [b[i] for i in full], MANY_LETTERS):
        reach = np.maximum(np.maximum(m, n) // 2 - 1, 0)
        most = int(reach.max())
        near = reach >= np.arange(most + 1)[:, None]
        met, free = np.zeros(x.shape, bool), np.ones(y.shape, bool)
        for i in range(len(x)):
            wanting = np.ones(len(own), bool)
            for j in range(max(0, i - most), min(len(y), i + most + 1)):
                hit = (x[i] == y[j]) & free[j] & wanting & near[abs(i - j)]
                free[j] ^= hit
                wanting ^= hit
            met[i] = ~wanting
        k = met.sum(0)
        moved = np.bincount(np.repeat(np.arange(len(own)), k), x.T[met.T] != y.T[~free.T], len(own)).astype(np.int64) // 2
        some = np.maximum(k, 1)
        jaro = np.where(k > 0, (k / m + k / n + (k - moved) / some) / 3, 0.0)
        same = min(len(x), len(y), 4)
        first = np.cumprod(x[:same] == y[:same], axis=0, dtype=np.int64).sum(0)
        out[full[own]] = np.where(jaro > 0.7, jaro + 0.1 * first * (1 - jaro), jaro)
    return out
