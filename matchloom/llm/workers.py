"""What a Python worker keeps from task to task.

Spark's workers live as long as the executor and serve all stages in turn, so what one stage keeps is memory the next
ones lack. An operator that keeps something large names it here; operators that keep nothing drop it.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable
from typing import Any

import pyarrow as pa

KEPT: dict[Any, Any] = {}


def kept(key: Any, make: Callable[[], Any]) -> Any:
    """What this worker keeps under ``key``; made at the first call."""
    if key not in KEPT:
        KEPT[key] = make()
    return KEPT[key]


def drop_kept() -> None:
    """Drop what earlier stages kept, and hand the freed memory back to the system."""
    if not KEPT:
        return
    KEPT.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it, and keeps freed memory without
    if trim is not None:
        trim(0)
