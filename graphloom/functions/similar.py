"""Ratcliff-Obershelp similarity of many short strings at once, the same numbers as difflib's."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from .udfs import ratio_of

#: Characters of a normal form.
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789 "
#: Repeats of a character that the bound tells apart.
DEPTH = 3
#: Longer strings, and those with other characters than ASCII, are left to difflib.
LONGEST = 100
#: Pairs whose bound is computed together, and pairs that are aligned together.
PAIRS, ALIGNED = 1 << 17, 1 << 11


class Forms:
    """Strings as rows of codes, with what the bound needs of them."""

    def __init__(self, texts: list[str]):
        self.texts = np.array(texts, dtype=object)
        self.length = np.array([len(t) for t in texts], dtype=np.int32)
        self.plain = np.array([len(t) <= LONGEST and t.isascii() for t in texts], dtype=bool)
        width = max(1, int(self.length[self.plain].max(initial=0)))
        short = [t if ok else "" for t, ok in zip(texts, self.plain.tolist(), strict=True)]
        self.codes = np.frombuffer("".join(t.ljust(width, "\0") for t in short).encode(), dtype=np.uint8).reshape(len(texts), width)
        place = np.full(256, 255, dtype=np.uint8)
        place[np.frombuffer(ALPHABET.encode(), dtype=np.uint8)] = np.arange(len(ALPHABET))
        placed = place[self.codes]
        rows, cols = np.nonzero(placed < 255)
        counts = np.bincount(rows * len(ALPHABET) + placed[rows, cols], minlength=len(texts) * len(ALPHABET)).reshape(len(texts), len(ALPHABET))
        bits = np.concatenate([counts > k for k in range(DEPTH)], axis=1)
        words = np.packbits(np.pad(bits, ((0, 0), (0, -bits.shape[1] % 64))), axis=1)
        #: Bit c of repeat k tells whether character c comes more than k times.
        self.masks = np.ascontiguousarray(words).view(np.uint64)
        #: Characters that the masks do not tell apart count as matched.
        self.rest = (self.length - bits.sum(axis=1)).astype(np.int32)


def least_matched(n: int, floor: float) -> np.ndarray:
    """For sums of lengths up to n the least number of matched characters whose similarity is at least the floor."""
    total = np.arange(n + 1)
    least = np.ceil(total * floor / 2).astype(np.int32)
    for step in (-1, 1):  # rounding of the product is not that of the similarity
        near = np.maximum(total, 1)
        least = np.where((2.0 * (least - 1) / near >= floor) if step < 0 else (2.0 * least / near < floor), least + step, least)
    return least.astype(np.int32)


def _bounded(a: Forms, b: Forms, i: np.ndarray, j: np.ndarray, least: np.ndarray) -> np.ndarray:
    common = sum(np.bitwise_count(a.masks[i, k] & b.masks[j, k]).astype(np.int32) for k in range(a.masks.shape[1]))
    return common + np.minimum(a.rest[i], b.rest[j]) >= least[a.length[i] + b.length[j]]


def close(a: Forms, b: Forms, a_at: np.ndarray, b_at: np.ndarray, floor: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j): pairs of a run of a and a run of b (rows ``a_at`` and ``b_at`` hold first and end, one row a run) that no
    bound keeps below the floor, in slices.

    No more characters match than both strings have, nor any without a partner. Short runs are taken together. If a is
    b, pairs come at least with i < j.
    """
    least = least_matched(int(a.length.max(initial=0) + b.length.max(initial=0)), floor)
    wide, high = b_at[:, 1] - b_at[:, 0], a_at[:, 1] - a_at[:, 0]
    small = wide * high <= PAIRS // 64
    order = np.nonzero(small)[0]
    bound = np.cumsum((wide * high)[order]) // PAIRS
    for part in np.split(order, np.nonzero(np.diff(bound))[0] + 1) if len(order) else ():
        n = wide[part] * high[part]
        own = np.repeat(np.arange(len(part)), n)
        at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        i, j = a_at[part, 0][own] + at // wide[part][own], b_at[part, 0][own] + at % wide[part][own]
        held = _bounded(a, b, i, j, least)
        yield i[held], j[held]
    for k in np.nonzero(~small)[0]:
        step = max(1, PAIRS // int(wide[k]))
        for first in range(a_at[k, 0], a_at[k, 1], step):
            low = max(first, b_at[k, 0]) if a is b else b_at[k, 0]
            rows, js = slice(first, min(first + step, a_at[k, 1])), slice(low, b_at[k, 1])
            masks, rest, length = np.ascontiguousarray(b.masks[js].T), b.rest[js], b.length[js]
            common = np.bitwise_count(a.masks[rows, 0][:, None] & masks[0])
            for w in range(1, len(masks)):
                common += np.bitwise_count(a.masks[rows, w][:, None] & masks[w])
            i, j = np.nonzero(common + np.minimum(a.rest[rows][:, None], rest) >= least[a.length[rows][:, None] + length])
            yield i + first, j + low


def _longest(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(length, start in x, start in y) of the longest common piece of columns, the first in x, then in y, of several."""
    runs = np.zeros((len(x), len(y) + 1, x.shape[1]), dtype=np.uint8)
    most, end = np.zeros(x.shape[1], dtype=np.uint8), np.zeros(x.shape[1], dtype=np.intp)
    for i in range(len(x)):
        run = runs[i, 1:]
        if i:
            np.add(runs[i - 1, :-1], 1, out=run)
            run *= y == x[i]
        else:
            run[:] = y == x[i]
        top = run.max(axis=0)
        np.copyto(end, i, where=top > most)
        np.maximum(most, top, out=most)
    last = (runs[end, 1:, np.arange(x.shape[1])] == most[:, None]).argmax(axis=1)
    k = most.astype(np.intp)
    return k, end - k + 1, last - k + 1


def _piece(rows: np.ndarray, start: np.ndarray, length: np.ndarray, filler: int) -> np.ndarray:
    """Columns hold ``length`` codes of each column of rows, from ``start`` on."""
    at = np.arange(int(length.max(initial=0)))[:, None]
    taken = np.take_along_axis(rows, np.minimum(start + at, len(rows) - 1), axis=0)
    return np.where(at < length, taken, np.uint8(filler))


def _matched(x: np.ndarray, lx: np.ndarray, y: np.ndarray, ly: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Matched characters of columns, or something below ``least`` where that is not reached."""
    total = np.zeros(len(lx), dtype=np.intp)
    hope = np.minimum(lx, ly).astype(np.intp)
    own, x, y = np.arange(len(lx)), _piece(x, 0 * lx, lx, 254), _piece(y, 0 * ly, ly, 255)
    while len(own):
        k, i, j = _longest(x, y)
        np.add.at(total, own, k)
        left, right = np.where(k > 0, np.minimum(i, j), 0), np.where(k > 0, np.minimum(lx - i - k, ly - j - k), 0)
        np.add.at(hope, own, k + left + right - np.minimum(lx, ly))
        alive = hope[own] >= least[own]
        one, two = np.nonzero(alive & (left > 0))[0], np.nonzero(alive & (right > 0))[0]
        both = np.concatenate([one, two])
        sx, sy = np.concatenate([0 * one, (i + k)[two]]), np.concatenate([0 * one, (j + k)[two]])
        nx, ny = np.concatenate([i[one], (lx - i - k)[two]]), np.concatenate([j[one], (ly - j - k)[two]])
        if not len(both):
            break
        x, y, lx, ly, own = _piece(x[:, both], sx, nx, 254), _piece(y[:, both], sy, ny, 255), nx, ny, own[both]
    return total


def ratios(a: Forms, b: Forms, i: np.ndarray, j: np.ndarray, floor: float) -> np.ndarray:
    """Similarity of the strings i of a and j of b, in this order; something below the floor where that is not reached."""
    least = least_matched(int(a.length.max(initial=0) + b.length.max(initial=0)), floor)
    out = np.ones(len(i))
    n = a.length[i] + b.length[j]
    plain = a.plain[i] & b.plain[j]
    for k in np.nonzero(~plain)[0]:
        out[k] = ratio_of(a.texts[i[k]], b.texts[j[k]])
    fast = np.nonzero(plain & (n > 0))[0]
    fast = fast[np.argsort(n[fast], kind="stable")]  # long ones would make all of their slice wide
    for first in range(0, len(fast), ALIGNED):
        at = fast[first : first + ALIGNED]
        lx, ly = a.length[i[at]].astype(np.intp), b.length[j[at]].astype(np.intp)
        x, y = np.ascontiguousarray(a.codes[i[at]].T), np.ascontiguousarray(b.codes[j[at]].T)
        out[at] = 2.0 * _matched(x, lx, y, ly, least[n[at]]) / n[at]
    return out


def _never(low: list[tuple[np.ndarray, np.ndarray]], high: list[tuple[np.ndarray, np.ndarray]], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether row i of low certainly does not come before row j of high; both are columns of (values, valid)."""
    tied, after, known = np.ones(len(i), dtype=bool), np.zeros(len(i), dtype=bool), np.ones(len(i), dtype=bool)
    for (x, x_there), (y, y_there) in zip(low, high, strict=True):
        known &= x_there[i] & y_there[j]
        after |= tied & (x[i] > y[j])
        tied &= x[i] == y[j]
    return known & (after | tied) if low else np.zeros(len(i), dtype=bool)


def _whole(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    return column.fill_null(0).to_numpy(), column.is_valid().to_numpy()


def paired(floor: float, earlier: list[str], low: list[str], high: list[str], rows: int = 8192) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function from rows of groups to (block, form_a, form_b, score, a_min, b_max), both orders of a pair.

    Rows of a group (h1, h2) come together, those of side 0 before those of side 1, and meet those of the other side; of
    side 2 all meet. Of roles 1 and 2 the second must be longer by one. Pairs that agree in a column of ``earlier`` met
    elsewhere. ``low`` and ``high`` are whole numbers that tell which orders cannot occur; others may still not.
    """

    def scored(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        forms, side, role = Forms(table["form"].to_pylist()), table["side"].to_numpy(), table["role"].to_numpy()
        met, lows, highs = ([_whole(table[c]) for c in names] for names in (earlier, low, high))
        ends = np.append(starts[1:], len(side))
        first = np.concatenate([[0], np.cumsum(side == 0)])
        split = starts + first[ends] - first[starts]
        alone = side[starts] == 2
        a_at = np.stack([starts, np.where(alone, ends, split)], axis=1)
        b_at = np.stack([np.where(alone, starts, split), ends], axis=1)
        some = (a_at[:, 1] > a_at[:, 0]) & (b_at[:, 1] > b_at[:, 0]) & (ends - starts > 1)
        for i, j in close(forms, forms, a_at[some], b_at[some], floor):
            longer = np.where(role[j] == 2, 1, -1)
            wanted = (i < j) & ((role[i] == 0) | ((role[i] != role[j]) & (forms.length[j] - forms.length[i] == longer)))
            for value, there in met:
                wanted &= ~(there[i] & there[j] & (value[i] == value[j]))
            i, j = i[wanted], j[wanted]
            i, j = np.concatenate([i, j]), np.concatenate([j, i])
            maybe = ~_never(lows, highs, i, j)
            i, j = i[maybe], j[maybe]
            score = ratios(forms, forms, i, j, floor)
            kept = score >= floor
            i, j, score = pa.array(i[kept]), pa.array(j[kept]), score[kept]
            out = pa.table([table["block"].take(i), table["form"].take(i), table["form"].take(j), pa.array(score), table["min_ord"].take(i), table["max_ord"].take(j)], ["block", "form_a", "form_b", "score", "a_min", "b_max"])
            yield from out.combine_chunks().to_batches(max_chunksize=32768)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) < rows:
                continue
            table, starts = _groups(held)
            if len(starts) > 1:
                yield from scored(table.slice(0, starts[-1]), starts[:-1])
            held = table.slice(starts[-1]).combine_chunks().to_batches()
        if sum(map(len, held)):
            yield from scored(*_groups(held))

    return run


def _groups(held: list[pa.RecordBatch]) -> tuple[pa.Table, np.ndarray]:
    """The rows, and where each group begins."""
    table = pa.Table.from_batches(held).combine_chunks()
    h1, h2 = table["h1"].to_numpy(), table["h2"].to_numpy()
    return table, np.concatenate([[0], np.nonzero((h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]))[0] + 1]).astype(np.int64)
