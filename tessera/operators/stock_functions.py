"""What a stretch of sales and deliveries does to a stock that is not known yet.

A sale line is accepted if the stock covers it, a delivery adds to the stock. As a function of the stock before it, the
stock after a stretch of lines is piecewise: on each piece the same lines are accepted, so it is the argument plus a
number, or one value for a range of arguments that end alike. Such functions compose, so stretches of one
product can be worked out side by side and then be put together.

Two bounds keep the pieces few. Stock that may be large is never short, and stock that runs out soon lies within a few
units: after a line of ``q`` it is at most ``max(min(u, q - 1), u - q)`` if it was at most ``u``. The exact function is needed
between the bounds only.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ENDLESS = 1 << 62
BLOCK = 256  # lines that are put together before they meet the function of the lines before them


@dataclass
class StockFunction:
    """A function of the whole numbers from ``start[0]`` to ``high``; ``slope`` is 1 (argument plus a number) or 0 (a value)."""

    start: np.ndarray
    value: np.ndarray
    slope: np.ndarray
    high: int

    @classmethod
    def identity(cls, low: int, high: int) -> StockFunction:
        one = np.ones(1, np.int64)
        return cls(low * one, low * one, one * (high > low), high)

    @classmethod
    def sale(cls, quantity: int, low: int, high: int) -> StockFunction:
        return cls._pieces([(low, low, 1), (quantity, 0, 1)], low, high)

    @classmethod
    def delivery(cls, quantity: int, low: int, high: int) -> StockFunction:
        return cls._pieces([(low, low + quantity, 1)], low, high)

    @classmethod
    def sale_bound(cls, quantity: int, low: int, high: int) -> StockFunction:
        """The most that may be left if there was at most the argument."""
        return cls._pieces([(low, low, 1), (quantity, quantity - 1, 0), (2 * quantity, quantity, 1)], low, high)

    @classmethod
    def _pieces(cls, pieces: list[tuple[int, int, int]], low: int, high: int) -> StockFunction:
        start, value, slope = (np.array(x, np.int64) for x in zip(*pieces))
        at = max(int(np.searchsorted(start, low, "right")) - 1, 0)
        value[at] += (low - start[at]) * slope[at] if low > start[at] else 0
        start[at] = low
        kept = start[at:] <= high
        return cls(start[at:][kept], value[at:][kept], slope[at:][kept], high)

    def __len__(self) -> int:
        return len(self.start)

    def last(self) -> np.ndarray:
        return np.append(self.start[1:] - 1, self.high)

    def image(self) -> tuple[int, int]:
        top = self.value + (self.last() - self.start) * self.slope
        return int(self.value.min()), int(top.max())

    def __call__(self, stock: int) -> int:
        i = int(np.searchsorted(self.start, stock, "right")) - 1
        return int(self.value[i] + (stock - self.start[i]) * self.slope[i])

    def then(self, after: StockFunction) -> StockFunction:
        """``after`` of this function; ``after`` is defined on all of its values."""
        top = self.value + (self.last() - self.start) * self.slope
        first = np.searchsorted(after.start, self.value, "right") - 1
        cuts = np.searchsorted(after.start, top, "right") - 1 - first
        mine = np.repeat(np.arange(len(self)), cuts + 1)
        nth = np.arange(len(mine)) - np.repeat(np.cumsum(cuts + 1) - cuts - 1, cuts + 1)
        theirs = first[mine] + nth
        start = np.where(nth > 0, self.start[mine] + after.start[theirs] - self.value[mine], self.start[mine])
        argument = self.value[mine] + (start - self.start[mine]) * self.slope[mine]
        value = after.value[theirs] + (argument - after.start[theirs]) * after.slope[theirs]
        return StockFunction(start, value, self.slope[mine] & after.slope[theirs], self.high)._joined()

    def _joined(self) -> StockFunction:
        """Neighbours that are one piece become one; a single number is a value."""
        slope = np.where(self.last() == self.start, 0, self.slope)
        alike = slope[1:] == slope[:-1]
        step = np.where(slope[1:] == 1, self.start[1:] - self.start[:-1], 0)
        kept = np.append(True, ~(alike & (self.value[1:] == self.value[:-1] + step)))
        return StockFunction(self.start[kept], self.value[kept], slope[kept], self.high)

    def above(self, most: int) -> StockFunction:
        """A function of at most about ``most`` pieces that is nowhere below this one, which does not fall."""
        if len(self) <= most:
            return self
        head = np.arange(len(self)) % -(-len(self) // most) == 0
        head[-1] = True  # the last piece stays
        groups = np.flatnonzero(head)
        ends = np.append(groups[1:], len(self)) - 1
        top = (self.value + (self.last() - self.start) * self.slope)[ends]
        value, slope = top.copy(), np.zeros(len(groups), np.int64)
        value[-1], slope[-1] = self.value[-1], self.slope[-1]
        return StockFunction(self.start[groups], value, slope, self.high)._joined()


def exact(quantity: np.ndarray, delivered: np.ndarray, low: int, high: int, most: int) -> StockFunction | None:
    """The function of a stretch of lines for stocks of ``low`` to ``high``; None if it has more than ``most`` pieces."""
    whole = StockFunction.identity(low, high)
    for at in range(0, len(quantity), BLOCK):
        q, new = quantity[at:at + BLOCK], delivered[at:at + BLOCK]
        least, greatest = whole.image()
        net = np.cumsum(np.where(new, q, -q))
        if least + net.min() >= 0:  # enough for every line, whatever the stock was
            whole = whole.then(StockFunction.delivery(int(net[-1]), least, greatest))
        elif new.any() or greatest >= q.min():
            part = StockFunction.identity(least, greatest)
            for one, add in zip(q.tolist(), new.tolist()):
                kind = StockFunction.delivery if add else StockFunction.sale
                part = part.then(kind(one, *part.image()))
            whole = whole.then(part)
        if len(whole) > most:
            return None
    return whole


def upper(quantity: np.ndarray, delivered: np.ndarray, most: int) -> StockFunction:
    """The most that may be left after a stretch, as a function that does not fall of the most that there was."""
    whole = StockFunction.identity(0, ENDLESS)
    for one, add in zip(quantity.tolist(), delivered.tolist()):
        low, high = whole.image()
        kind = StockFunction.delivery if add else StockFunction.sale_bound
        whole = whole.then(kind(one, low, high)).above(most)
    return whole


def lower(quantity: np.ndarray, delivered: np.ndarray) -> tuple[int, int]:
    """``(taken, floor)``: at least ``max(low - taken, floor)`` is left of a stock of at least ``low``."""
    net = np.cumsum(np.where(delivered, quantity, -quantity))
    return -int(net[-1]), int(net[-1] - min(net.min(), 0))


def fold(quantity: np.ndarray, delivered: np.ndarray, stock: int) -> tuple[np.ndarray, np.ndarray]:
    """The stock before every line and whether the line is accepted; only a refusal costs a step.

    With all lines up to one accepted, the stock after it is a running sum, and the first line at which that is
    negative is refused. Sums before it are never negative again, so their running minimum finds the next one by bisection.
    """
    change = np.where(delivered, quantity, -quantity)
    net = np.cumsum(change)
    shortest = -np.minimum.accumulate(net) if len(net) else net
    accepted, refused, at = np.ones(len(net), bool), 0, 0
    kept = np.zeros(len(net), np.int64)  # refused quantity up to and with each line
    while True:
        stop = int(np.searchsorted(shortest, stock + refused, "right"))
        kept[at:stop] = refused
        if stop == len(net):
            break
        accepted[stop] = False
        refused += int(quantity[stop])
        kept[stop] = refused
        at = stop + 1
    before = stock + net + kept - np.where(accepted, change, 0)
    return before, accepted
