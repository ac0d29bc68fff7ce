"""Edit distances of many pairs at once: bit-parallel over blocks of 64 characters of the first text (Myers, 1999; Hyyro, 2003), a lane of
numpy arrays for each pair, in a band around the diagonal.

A block takes its step one column after the block above, so all blocks of all pairs that are in the band take theirs at once. Within
`most` edits a path leaves the diagonal by (most + difference of lengths) / 2 at most, so blocks beyond that are never
looked at; a lane ends as soon as no path can reach the corner within `most`. What is returned is exact.

Distances by insertions and deletions alone come from common subsequences (Hyyro, 2004), at less than half the work a block;
ratios() asks them first for both metrics, as `k` edits are at most 2k of those.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

from .similarity import indel_ratio, levenshtein_ratio

#: Pairs that are compared at once, fewer than which are compared one by one; steps between two looks at what is still in reach.
LANES, FEW, LOOK = 2048, 5, 32
#: Characters of the first texts of a batch: of all, and for common subsequences of all and of different ones.
CHARACTERS, SPREAD, TABLES = 1_200_000, 16_000_000, 3_000_000
#: Rows of a block for common subsequences (the bit above takes the carry), and the share of lanes that are left to a later batch, and words of a batch, as a step costs the same for fewer.
WIDE, REST, FULL = 63, 16, 8192
#: Threshold from which grams are expected to have ruled out what is far apart.
SURE = 86.0
#: Characters told apart; texts with more are compared one by one.
ALPHABET = 250
#: Length of the grams that are counted, up to which number in a class, bits of a class at least, and of one whose parity is taken.
GRAM, LEVELS, GRAM_BITS, PARITIES = 5, 3, 11, 12

_ONE, _TOP, _ALL, _LOW = np.uint64(1), np.uint64(63), np.uint64(2**64 - 1), np.uint64(2**63 - 1)


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _grams(text: str, bits: int) -> np.ndarray:
    """The classes, of 2^bits, of the text's grams."""
    p = points(text)
    h = np.zeros(max(0, len(p) - GRAM + 1), dtype=np.uint32)
    for k in range(GRAM if len(h) else 0):
        h = h * np.uint32(0x01000193) ^ p[k : len(p) - GRAM + 1 + k]
    return (h * np.uint32(2654435761)) >> np.uint32(32 - bits)


def gram_parity(text: str) -> bytes:
    """For each of 2^PARITIES classes whether an odd number of the text's grams fall into it."""
    return np.packbits(np.bincount(_grams(text, PARITIES), minlength=1 << PARITIES).astype(np.uint8) & 1).tobytes()


def gram_counts(texts: Sequence[str], bits: int = GRAM_BITS) -> np.ndarray:
    """For each text a row of 64-bit words: whether at least one, two, ... LEVELS of its grams fall into each of 2^bits classes."""
    out = np.zeros((len(texts), LEVELS << bits >> 6), dtype=np.uint64)
    for i, t in enumerate(texts):
        count = np.bincount(_grams(t, bits), minlength=1 << bits)
        out[i] = np.concatenate([np.packbits(count > level) for level in range(LEVELS)]).view(np.uint64)
    return out


def gram_bound(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """What the texts of these counts (or parities) are apart at least: an edit takes away GRAM grams and adds as many at most."""
    return -(-np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64) // (2 * GRAM))


def apart_by_grams(a: Sequence[str], b: Sequence[str], i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Of pairs a[i], b[j] those that gram_bound() leaves within `most`; the longer the texts, the more classes."""
    n, m = np.array([len(t) for t in a]), np.array([len(t) for t in b])
    bits = np.maximum(GRAM_BITS, np.ceil(np.log2(2.5 * np.maximum(n[i], m[j])))).astype(np.int64)
    keep = np.zeros(len(i), dtype=bool)
    for k in np.unique(bits).tolist():
        these = np.flatnonzero(bits == k)
        (x, at), (y, other) = (np.unique(z[these], return_inverse=True) for z in (i, j))
        counts, others = gram_counts([a[q] for q in x], k), gram_counts([b[q] for q in y], k)
        step = max(1, (1 << 20) // counts.shape[1])
        for q in range(0, len(these), step):
            keep[these[q : q + step]] = gram_bound(counts[at[q : q + step]], others[other[q : q + step]]) <= most[these[q : q + step]]
    return keep


def _blocks(codes: np.ndarray, size: int) -> np.ndarray:
    """For each text, block and character the places where it stands in the block. codes: rows of a multiple of 64 characters, `size` where there is none."""
    rows, n = codes.shape
    at = codes.reshape(rows * (n // 64), 64)
    out = np.zeros((len(at), size + 1), dtype=np.uint64)
    each = np.arange(len(at))
    for bit in range(64):
        out[each, at[:, bit]] |= _ONE << np.uint64(bit)
    out[:, size] = 0
    return out.reshape(-1)


def distances(a: Sequence[str], b: Sequence[str], most: np.ndarray, metric: str = "levenshtein") -> np.ndarray | None:
    """Distances of a[i] and b[i], -1 where more than most[i]; None if they have more than ALPHABET characters. No text is empty."""
    if metric == "indel":
        return apart(a, b, most)
    first, second = {t: i for i, t in enumerate(dict.fromkeys(a))}, {t: i for i, t in enumerate(dict.fromkeys(b))}
    pa, pb = [points(t) for t in first], [points(t) for t in second]
    seen = np.zeros(0x110000, dtype=bool)
    for p in (*pa, *pb):
        seen[p] = True
    if (size := int(seen.sum())) > ALPHABET:
        return None
    code = np.cumsum(seen, dtype=np.int64) - 1

    def table(ps: list[np.ndarray], width: int) -> np.ndarray:
        out = np.full((len(ps), width), size, dtype=np.uint8)
        for i, p in enumerate(ps):
            out[i, : len(p)] = code[p]
        return out

    n, m = np.array([len(t) for t in a]), np.array([len(t) for t in b])
    high = -(-int(n.max()) // 64)
    eqs = _blocks(table(pa, 64 * high), size)
    rows = np.array([first[t] for t in a], dtype=np.int64) * (high * (size + 1))
    columns = table(pb, int(m.max()))[[second[t] for t in b]].T.copy()
    most = np.asarray(most, dtype=np.int64)
    out = np.full(len(n), -1, dtype=np.int64)
    lane = np.arange(len(n))
    lane = lane[np.abs(n - m) <= most]
    if not len(lane):
        return out
    n, m, most, rows, columns = n[lane], m[lane], most[lane], rows[lane], np.ascontiguousarray(columns[:, lane])
    width = size + 1
    reach = int(((most + np.abs(n - m)) // 2).max() + 1)
    shape = (high, len(lane))
    plus, minus = np.full(shape, _ALL), np.zeros(shape, dtype=np.uint64)
    score = np.repeat(64 * np.arange(1, high + 1)[:, None], len(lane), axis=1)
    up, down = np.ones((high + 1, len(lane)), dtype=np.uint64), np.zeros((high + 1, len(lane)), dtype=np.uint64)
    place = (np.arange(high) * width)[:, None]
    begins = [max(1, 64 * w - reach) + w for w in range(high)]
    low = top = 0
    final, last = m + (n - 1) // 64, int(m.max())
    for s in range(1, last + high):
        if top < high and s >= begins[top]:
            if top:  # what stood below the block above before its last column
                score[top] = score[top - 1] - (up[top].view(np.int64) - down[top].view(np.int64)) + 64
            top += 1
        while low < top - 1 and s - low > min(last, 64 * (low + 1) + reach):
            low += 1
        at = columns[s - top : s - low][::-1].astype(np.int64)
        at += rows
        at += place[low:top]
        eq = eqs.take(at)
        p, q, into = plus[low:top], minus[low:top], down[low:top]
        xv = eq | q
        eq |= into
        x = eq & p
        x += p
        x ^= p
        x |= eq
        h = x | p
        np.invert(h, out=h)
        h |= q
        x &= p
        above, below = h >> _TOP, x >> _TOP
        h <<= _ONE
        h |= up[low:top]
        x <<= _ONE
        x |= into
        np.bitwise_and(h, xv, out=q)
        xv |= h
        np.invert(xv, out=xv)
        np.bitwise_or(x, xv, out=p)
        up[low + 1 : top + 1] = above
        up[low] = 1
        score[low:top] += above.view(np.int64)
        score[low:top] -= below.view(np.int64)
        down[low + 1 : top + 1] = below
        down[low] = 0
        if (done := np.flatnonzero(final == s)).size:
            w = (n[done] - 1) // 64
            rest = 64 * (w + 1) - n[done]  # rows of the block beyond the text's end
            mask = np.where(rest == 0, np.uint64(0), ~(_ALL >> rest.astype(np.uint64)))
            ups = plus[w, done]
            downs = minus[w, done]
            d = score[w, done] - np.bitwise_count(ups & mask).astype(np.int64) + np.bitwise_count(downs & mask)
            out[lane[done]] = np.where(d <= most[done], d, -1)
        if s % LOOK == 0:
            bottom, ups = score[low:top], np.bitwise_count(p).astype(np.int64)
            highest = bottom - ups + np.bitwise_count(q)
            first = 64 * np.arange(low, top)[:, None]
            corner = (n - m)[None, :] + s - np.arange(low, top)[:, None]  # the row of the diagonal that ends in the corner
            least = (highest + bottom - 63) // 2 + np.maximum(np.maximum(first - corner, corner - first - 64), 0)
            alive = (least.min(axis=0) - 2 <= most) & (final > s)
            left = int(alive.sum())
            if not left:
                break
            if left < 0.75 * len(lane):
                n, m, most, rows, lane, final = (v[alive] for v in (n, m, most, rows, lane, final))
                plus, minus, score, up, down, columns = (v[:, alive] for v in (plus, minus, score, up, down, columns))
                last = int(m.max())
    return out


def apart(a: Sequence[str], b: Sequence[str], most: np.ndarray, whole: bool = True) -> np.ndarray | None:
    """As distances(), by insertions and deletions alone. Unless `whole`, -2 for the last lanes of a batch, which are undecided.

    A bit of `v` is 0 where a row has one more common character than the row above, so the zeros of the blocks down to a row
    count its common characters, and a block above that is some columns ahead can only make them more.
    """
    first, second = {t: i for i, t in enumerate(dict.fromkeys(a))}, {t: i for i, t in enumerate(dict.fromkeys(b))}
    pa, pb = [points(t) for t in first], [points(t) for t in second]
    seen = np.zeros(max(int(p.max()) for p in (*pa, *pb)) + 1, dtype=bool)
    for p in (*pa, *pb):
        seen[p] = True
    if (size := int(seen.sum())) > ALPHABET:
        return None
    code, width = (np.cumsum(seen) - 1).astype(np.uint8), size + 1
    n, m = np.array([len(t) for t in a]), np.array([len(t) for t in b])
    most = np.asarray(most, dtype=np.int64)
    out = np.full(len(n), -1, dtype=np.int64)
    lane = np.flatnonzero(np.abs(n - m) <= most)
    if not len(lane):
        return out
    high = -(-int(n.max()) // WIDE)

    def table(ps: list[np.ndarray], columns: int) -> np.ndarray:
        t = np.full((len(ps), columns), size, dtype=np.uint8)
        for i, p in enumerate(ps):
            t[i, : len(p)] = code[p]
        return t

    at = table(pa, WIDE * high).reshape(-1, WIDE)
    eqs, each = np.zeros((len(at), width), dtype=np.uint64), np.arange(len(at))
    for bit in range(WIDE):
        eqs[each, at[:, bit]] |= _ONE << np.uint64(bit)
    eqs[:, size] = 0
    eqs = eqs.reshape(-1)
    columns = np.ascontiguousarray(table(pb, int(m.max()) + high + LOOK).T)
    rows, which = np.array([first[t] for t in a]) * (high * width), np.array([second[t] for t in b])
    n, m, most, rows, which = n[lane], m[lane], most[lane], rows[lane], which[lane]
    reach = int(((most + np.abs(n - m)) // 2).max() + 1)
    v, down = np.full((high, len(lane)), _LOW), np.zeros((high + 1, len(lane)), dtype=np.uint64)
    at, eq, x = np.empty((high, len(lane)), dtype=np.int64), np.empty((high, len(lane)), dtype=np.uint64), np.empty((high, len(lane)), dtype=np.uint64)
    place = (np.arange(high) * width)[:, None]
    begins = [max(1, WIDE * w - reach) + w for w in range(high)]
    few = 0 if whole else len(lane) // REST
    low = top = s = 0
    final, last = m + (n - 1) // WIDE, int(m.max())
    while True:
        base, end = max(0, s - top - 2), min(s + LOOK - low, len(columns))
        ahead = columns[base:end][::-1][:, which] + rows  # the last column first, as the block above is ahead
        for s in range(s + 1, s + LOOK + 1):
            while top < high and s >= begins[top]:
                top += 1
            while low < top - 1 and s - low > min(last, WIDE * (low + 1) + reach):
                low += 1
            i, u, y, p = at[: top - low], eq[: top - low], x[: top - low], v[low:top]
            np.add(ahead[end - s + low : end - s + top], place[low:top], out=i)
            np.take(eqs, i, out=u, mode="clip")
            u &= p
            np.add(p, u, out=y)
            y += down[low:top]
            p -= u
            p |= y
            p &= _LOW
            np.right_shift(y, _TOP, out=down[low + 1 : top + 1])
            down[low] = 0
        common = WIDE - np.bitwise_count(v[:top]).astype(np.int64)
        below = common.cumsum(axis=0)
        done = final <= s  # beyond its last column a lane no longer changes
        if done.any():
            d = (n + m - 2 * below[-1])[done]
            out[lane[done]] = np.where(d <= most[done], d, -1)
        w, below = np.arange(low, top)[:, None], below[low:]
        above = below - common[low:]
        least = np.maximum(2 * (WIDE * w - above) - (n - m), 2 * (s - w - below) + (n - m)).min(axis=0)
        alive = (least <= most) & ~done
        left = int(alive.sum())
        if left <= few:
            out[lane[alive]] = -2
            return out
        if left < 0.8 * len(lane):
            n, m, most, rows, which, lane, final = (z[alive] for z in (n, m, most, rows, which, lane, final))
            v, down, at, eq, x = v[:, alive], down[:, alive], *(np.empty((high, left), dtype=z.dtype) for z in (at, eq, x))
            last = int(m.max())


def _trimmed(a: str, b: str) -> tuple[str, str]:
    """Both without what they begin and end with alike, but for a character."""
    most = min(len(a), len(b)) - 1
    p, q = points(a), points(b)
    other = np.flatnonzero(p[:most] != q[:most])
    start = int(other[0]) if len(other) else most
    other = np.flatnonzero(p[len(p) - most + start :][::-1] != q[len(q) - most + start :][::-1])
    end = int(other[0]) if len(other) else most - start
    return a[start : len(a) - end], b[start : len(b) - end]


def _batches(a: Sequence[str], which: np.ndarray, characters: int = SPREAD) -> Iterator[np.ndarray]:
    """`which`, in batches of texts of like lengths, those of one first text side by side."""
    number: dict[str, int] = {}
    first = np.array([number.setdefault(a[i], len(number)) for i in which.tolist()], dtype=np.int64)
    length = np.array([len(a[i]) for i in which.tolist()], dtype=np.int64)
    order = np.lexsort((first, length))
    which, first, length = which[order], first[order], length[order]
    different = np.cumsum(np.r_[True, first[1:] != first[:-1]])
    at = 0
    while at < len(which):
        n = int(length[at])
        like = int(np.searchsorted(length, 1.1 * n + WIDE, side="right"))
        like = max(like, min(at + FULL * WIDE // (n + WIDE), int(np.searchsorted(length, 2 * n, side="right"))))  # a step costs the same for few
        end = min(at + max(FEW, min(LANES, characters // (n + WIDE))), like)
        end = min(end, at + max(FEW, int(np.searchsorted(different[at:], different[at] + TABLES // (n + WIDE), side="right"))))
        yield which[at:end]
        at = end


def ratios(a: Sequence[str], b: Sequence[str], metric: str, least: float) -> np.ndarray:
    """Ratios of a[i] and b[i] as functions.similarity has them, NaN below `least`. What the first batches leave undecided meets in batches of its own."""
    out = np.full(len(a), np.nan)
    n, m = np.array([len(t) for t in a], dtype=np.int64), np.array([len(t) for t in b], dtype=np.int64)
    most = np.floor((1 - least / 100.0) * (np.maximum(n, m) if metric == "levenshtein" else n + m) + 1e-9).astype(np.int64)
    bound = 2 * most - np.abs(n - m) if metric == "levenshtein" else most
    found = np.where(np.abs(n - m) <= most, -2, -1)
    if metric == "levenshtein" and least >= SURE:
        found = np.abs(found) - 2  # what is left at such thresholds is near
    for whole in (False, True):
        for i in _batches(a, np.flatnonzero(found == -2)):
            if len(i) >= FEW:
                d = apart([a[k] for k in i], [b[k] for k in i], bound[i], whole)
                found[i] = -3 if d is None else d
            else:
                found[i] = -3 if whole else -2
    near = np.flatnonzero((found >= 0) | (found == -3))
    if metric == "levenshtein":
        again, near = near[found[near] >= 0], near[found[near] < 0]
        x, y = zip(*(_trimmed(a[i], b[i]) for i in again.tolist()), strict=True) if len(again) else ((), ())
        for k in _batches(x, np.arange(len(again)), CHARACTERS):
            i, p, q = again[k], [x[j] for j in k], [y[j] for j in k]
            d = distances(p, q, most[i]) if len(i) >= FEW else None
            if d is None:
                near = np.r_[near, i]
            else:
                out[i[d >= 0]] = 100.0 * (1.0 - d[d >= 0] / np.maximum(n[i], m[i])[d >= 0])
    else:
        i, near = near[found[near] >= 0], near[found[near] < 0]
        out[i] = 200.0 * ((n[i] + m[i] - found[i]) // 2) / (n[i] + m[i])
    plain = {"indel": indel_ratio, "levenshtein": levenshtein_ratio}[metric]
    for i in near.tolist():
        r = plain(a[i], b[i], least)
        if r is not None:
            out[i] = r
    out[~(out >= least)] = np.nan
    return out
