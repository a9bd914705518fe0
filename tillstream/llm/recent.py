"""A bounded memo for values that recur by Zipf's law."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import batched, chain
from operator import length_hint
from typing import Any

# Keys held at once by ``Recent.parts``, and the length from which a text is taken that way.
PART, LONG_TEXT = 500_000, 4_000_000
# Characters of keys from which a generation counts as full: long unbroken runs are few keys.
MOST_HELD = 16_000_000


class Recent:
    """Remembers values between batches in two generations of some ``room`` keys, or of ``MOST_HELD``
    characters of keys: a full young generation becomes the old one, and what is used again returns
    to the young one."""

    def __init__(self, compute: Callable[[list], Iterable[Any]], room: int = 200_000):
        """``compute`` gives the values of a list of distinct keys, in their order."""
        self._compute, self._room = compute, room
        self._young, self._old, self._held = {}, {}, 0

    def parts(self, keys: Iterable) -> Iterator[map]:
        """The values of keys too many to hold at once, some at a time."""
        for some in batched(keys, PART):
            yield self.rows([some])[0]

    def rows(self, keyed: list[list]) -> list[map]:
        """For each list of keys, an iterator over their values."""
        if len(self._young) >= self._room or self._held >= MOST_HELD:
            self._young, self._old, self._held = {}, self._young, 0
        young, old = self._young, self._old
        missing = []
        for key in set(chain.from_iterable(keyed)):
            if key not in young:
                value = old.get(key)
                if value is None:
                    missing.append(key)
                else:
                    young[key] = value
        if missing:
            young.update(zip(missing, self._compute(missing)))
            self._held += sum(map(length_hint, missing))
        return [map(young.__getitem__, keys) for keys in keyed]
