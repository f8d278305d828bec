"""What a Python worker keeps between tasks.

Workers live on from task to task and from one operator to the next. Caches are worth
keeping for an operator's next task, and only for that.
"""

from __future__ import annotations

import contextlib
import ctypes
from typing import Any

_stores: dict[str, dict[Any, Any]] = {}


def store(owner: str) -> dict[Any, Any]:
    """The cache of an operator in this process; it must be filled again after ``only``."""
    return _stores.setdefault(owner, {})


def only(owner: str | None = None) -> None:
    """Called when a task begins: drop what other operators have kept in this worker."""
    others = [kept for name, kept in _stores.items() if name != owner and kept]
    for kept in others:
        kept.clear()
    give_back()


def give_back() -> None:
    """Hand freed memory back to the system, where its allocator can be told to."""
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)
