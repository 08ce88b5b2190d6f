"""What a Python worker keeps between tasks: one thing at a time.

Workers live on from one operator to the next, so what each of them keeps would add up.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Hashable

import pyarrow as pa

_kept: dict[Hashable, object] = {}


def keep(key: Hashable, make: Callable[[], object]):
    """What ``make`` makes, until another key is asked for."""
    if key not in _kept:
        drop()
        _kept[key] = make()
    return _kept[key]


def drop() -> None:
    """Keep nothing."""
    if _kept:
        _kept.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)
