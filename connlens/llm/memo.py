"""A bounded memory of earlier answers inside one Python worker."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Hashable, Iterable

import pyarrow as pa


def give_back() -> None:
    """Return to the system what the allocators of this worker hold unused, where they can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


class Memo:
    """Answers by key in two generations of at most `size` keys: the older one goes when the younger is full.

    It only saves work; what it has forgotten is computed again.
    """

    def __init__(self, compute: Callable[[list], Iterable], size: int = 200_000) -> None:
        self.compute, self.size = compute, size
        self.young: dict[Hashable, object] = {}
        self.old: dict[Hashable, object] = {}

    def many(self, keys: list) -> list:
        """The answer of every key, in order; keys differ from each other."""
        young, old = self.young, self.old
        found = [young.get(k) for k in keys]
        missing = []
        for i, answer in enumerate(found):
            if answer is None:
                found[i] = answer = old.get(keys[i])
                if answer is None:
                    missing.append(i)
                else:
                    young[keys[i]] = answer
        if missing:
            asked = [keys[i] for i in missing]
            for i, key, answer in zip(missing, asked, self.compute(asked), strict=True):
                found[i] = young[key] = answer
        if len(young) > self.size:
            self.old, self.young = young, {}
        return found

    def forget_older(self) -> None:
        """Give up the older generation, also where it would have served the next task."""
        self.old = {}
