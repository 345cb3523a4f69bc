"""Token ids of text pieces, remembered between texts: a corpus repeats most of its pieces."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from itertools import chain, islice

import numpy as np


class _Places(dict):
    """Numbers pieces as they come up; ``new`` lists those not encoded yet."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        place = self[piece] = len(self)
        self.new.append(piece)
        return place


class PieceCache:
    """Encodes sequences of pieces, each of which has ids of its own.

    ``encode`` gives the numbers of ids of a list of pieces, and the ids one after another.

    When it holds more than ``pieces`` pieces or ``ids`` ids it forgets those that came
    up in one text only, or all if that is not enough, so a worker's memory is bounded
    whatever it reads and the common pieces are not encoded again and again.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], pieces: int = 300_000, ids: int = 3_000_000):
        self.encode, self.max_pieces, self.max_ids = encode, pieces, ids
        self._clear()

    def _clear(self) -> None:
        self.places = _Places()
        self.start = np.zeros(1 << 12, dtype=np.int64)
        self.count = np.zeros(1 << 12, dtype=np.int64)
        self.flat = np.zeros(1 << 14, dtype=np.uint32)
        self.again = np.zeros(1 << 12, dtype=bool)
        self.used = 0

    def _forget(self) -> None:
        """Keep the pieces that came up again."""
        kept = np.flatnonzero(self.again[: len(self.places)])
        count = self.count[kept]
        if 2 * len(kept) > self.max_pieces or 2 * count.sum() > self.max_ids:
            return self._clear()
        starts = np.repeat(self.start[kept] - np.cumsum(count) + count, count)
        flat = self.flat[starts + np.arange(count.sum())]
        pieces = list(self.places)
        self._clear()
        for piece in map(pieces.__getitem__, kept.tolist()):
            self.places[piece]
        self.places.new = []
        self._store(0, count, flat)

    def ids(self, pieces: Iterable[str], at_once: int = 1 << 17) -> np.ndarray:
        """The ids of all ``pieces`` one after another."""
        pieces = iter(pieces)
        found = []
        while some := list(islice(pieces, at_once)):
            found.append(self._ids(some))
        return found[0] if len(found) == 1 else np.concatenate([np.zeros(0, dtype=np.uint32), *found])

    def ids_of(self, groups: list[list[str]]) -> list[np.ndarray]:
        """The ids of each group of pieces; all groups together are looked up at once."""
        flat, count = self._looked_up(list(chain.from_iterable(groups)))
        ends = np.cumsum(count, dtype=np.int64)
        last = np.cumsum([len(g) for g in groups[:-1]], dtype=np.int64)
        return np.split(flat, np.concatenate([np.zeros(1, dtype=np.int64), ends])[last])

    def _ids(self, pieces: list[str]) -> np.ndarray:
        return self._looked_up(pieces)[0]

    def _looked_up(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces one after another, and how many each piece has."""
        if not pieces:
            return np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
        if len(self.places) > self.max_pieces or self.used > self.max_ids:
            self._forget()
        before = len(self.places)
        index = np.fromiter(map(self.places.__getitem__, pieces), dtype=np.int64, count=len(pieces))
        if self.places.new:
            self._learn()
        self.again[index[index < before]] = True
        count = self.count[index]
        ends = np.cumsum(count)
        return self.flat[np.repeat(self.start[index] - ends + count, count) + np.arange(ends[-1])], count

    def _learn(self) -> None:
        new, self.places.new = self.places.new, []
        first = len(self.places) - len(new)
        count, flat = self.encode(new)
        self._store(first, count, flat)

    def _store(self, first: int, count: np.ndarray, flat: np.ndarray) -> None:
        end, used = first + len(count), self.used + len(flat)
        self.start, self.count, self.again = (_room(x, end) for x in (self.start, self.count, self.again))
        self.flat = _room(self.flat, used)
        self.count[first:end] = count
        self.start[first:end] = self.used + np.cumsum(count) - count
        self.flat[self.used : used] = flat
        self.used = used


def _room(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    return np.concatenate([array, np.zeros(max(size, 2 * len(array)) - len(array), dtype=array.dtype)])
