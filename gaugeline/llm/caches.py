"""What a worker process keeps from one task to the next: for a single kind of work at a time."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa

_kept: dict = {}


def kept(key, make: Callable):
    """What an earlier task of this process kept under the key, or made anew; all else is given up."""
    if key not in _kept:
        forget()
        _kept[key] = make()
    return _kept[key]


def forget() -> None:
    """Give up what earlier tasks kept. Called first by tasks that have no use for it but need memory of their own."""
    _kept.clear()
    pa.default_memory_pool().release_unused()
