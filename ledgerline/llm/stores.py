"""What a Python worker keeps between batches: one operator's store at a time.

Workers are reused from task to task and from operator to operator; without
this, each operator met would leave its own store behind.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable
from typing import Any

import pyarrow as pa

_current: dict[Any, Any] = {}


def store(key: Any, make: Callable[[], Any]) -> Any:
    """The store of this key; making it drops all others."""
    if key not in _current:
        _current.clear()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # another C library
            ctypes.CDLL("libc.so.6").malloc_trim(0)  # what the tokenizers' own code has freed stays with the process otherwise
        _current[key] = make()
    return _current[key]
