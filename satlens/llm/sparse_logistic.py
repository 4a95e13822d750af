"""Logistic regression with an absolute-value penalty over sets of slots, for samples of bounded size.

Minimises mean log-loss + penalty * sum |weight|, the intercept unpenalised, by
the orthant-wise quasi-Newton method (Andrew and Gao, 2007).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Places of rows that are handled at once: numpy holds 8 bytes and more for each.
PIECE = 1 << 18


@dataclass
class Sample:
    """Row i has the slots at[stops[i-1]:stops[i]] (value 1) and the dense numbers dense[i]; y is 0 or 1."""

    at: np.ndarray
    sizes: np.ndarray
    dense: np.ndarray
    y: np.ndarray

    def reduced(self, slots: int, penalty: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(slots that can have a weight, their places by row, rows).

        The slope of the loss at a slot is at most its share of the rows, so a slot
        in fewer than penalty * rows has weight 0 in the solution: leaving it out is exact.
        """
        count = counted(self.at, slots)
        used = np.flatnonzero((count > 0) & (count >= penalty * len(self.y)))
        place = np.full(slots, -1, np.int32)
        place[used] = np.arange(len(used))
        at, row = (np.empty(count[used].sum(), np.int32) for _ in range(2))
        end, stop = np.cumsum(self.sizes), 0
        for a, b in pieces(end):
            slot, of = place[self.at[end[a] - self.sizes[a]:end[b - 1]]], np.repeat(np.arange(a, b, dtype=np.int32), self.sizes[a:b])
            start, stop = stop, stop + np.count_nonzero(slot >= 0)
            at[start:stop], row[start:stop] = slot[slot >= 0], of[slot >= 0]
        return used, at, row


def pieces(end: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about PIECE places each; ``end`` counts the places up to each row."""
    a = 0
    while a < len(end):
        b = max(a + 1, int(np.searchsorted(end, (end[a - 1] if a else 0) + PIECE, "right")))
        yield a, b
        a = b


def counted(at: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(size, np.int64)
    for i in range(0, len(at), PIECE):
        out += np.bincount(at[i:i + PIECE], minlength=size)
    return out


def fit(sample: Sample, slots: int, penalty: float, most: int, tolerance: float) -> np.ndarray:
    """Weights of the slots, then of the dense numbers, then the intercept."""
    out = np.zeros(slots + sample.dense.shape[1] + 1)
    mean = sample.y.mean() if len(sample.y) else 0.0
    if mean in (0.0, 1.0):  # nothing to tell apart
        out[-1] = -20.0 if mean == 0 else 20.0
        return out
    used, at, row = sample.reduced(slots, penalty)
    k, n, y, dense = len(used), len(sample.y), sample.y, sample.dense
    cuts = list(pieces(np.cumsum(np.bincount(row, minlength=n))))
    ends = np.searchsorted(row, [b for _, b in cuts])
    starts = [0, *ends[:-1]]

    def value(w: np.ndarray) -> tuple[float, np.ndarray]:
        margin, slope = np.empty(n), np.zeros(k)
        for (a, b), i, j in zip(cuts, starts, ends):
            margin[a:b] = np.bincount(row[i:j] - a, w[at[i:j]], minlength=b - a)
        margin = margin + dense @ w[k:-1] + w[-1]
        loss = np.logaddexp(0, np.where(y > 0, -margin, margin)).mean()
        rest = (1 / (1 + np.exp(-np.clip(margin, -700, 700))) - y) / n
        for i, j in zip(starts, ends):
            np.add.at(slope, at[i:j], rest[row[i:j]])
        return loss, np.concatenate([slope, rest @ dense, [rest.sum()]])

    start = np.zeros(k + dense.shape[1] + 1)
    start[-1] = np.log(mean / (1 - mean))
    price = np.full(len(start), penalty)
    price[-1] = 0.0
    found = minimise(value, start, price, most, tolerance)
    out[used], out[slots:] = found[:k], found[k:]
    return out


def minimise(value, w: np.ndarray, price: np.ndarray, most: int, tolerance: float, memory: int = 8) -> np.ndarray:
    """The least value(w) + sum price * |w|; value gives the smooth part and its slope."""
    def steepest(w, slope):
        up, down = slope + price, slope - price
        return np.where(w > 0, up, np.where(w < 0, down, np.where(up < 0, up, np.where(down > 0, down, 0.0))))

    loss, slope = value(w)
    total, pairs = loss + (price * np.abs(w)).sum(), []
    for _ in range(most):
        rise = steepest(w, slope)
        step, shares = -rise, []
        for s, y, r in reversed(pairs):
            shares.append(r * (s @ step))
            step = step - shares[-1] * y
        if pairs:
            step = step / (pairs[-1][2] * (pairs[-1][1] @ pairs[-1][1]))
        for (s, y, r), a in zip(pairs, reversed(shares)):
            step = step + s * (a - r * (y @ step))
        step = np.where(step * rise < 0, step, 0.0)
        side = np.where(w != 0, np.sign(w), -np.sign(rise))
        length = 1.0 if pairs else 1 / max(np.abs(rise).sum(), 1e-12)
        for _ in range(40):  # shorter until it goes down enough; weights stop at 0 on their way to the other side
            new = w + length * step
            new = np.where((price > 0) & (new * side < 0), 0.0, new)
            loss, new_slope = value(new)
            new_total = loss + (price * np.abs(new)).sum()
            if new_total <= total + 1e-4 * (rise @ (new - w)):
                break
            length /= 2
        else:
            return w
        s, y = new - w, new_slope - slope
        if s @ y > 1e-12 * (y @ y):
            pairs = [*pairs, (s, y, 1 / (s @ y))][-memory:]
        settled = total - new_total <= tolerance * abs(total)
        w, slope, total = new, new_slope, new_total
        if settled:
            break
    return w
