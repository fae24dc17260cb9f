"""Makes this package importable in the Python workers, and bounds what they hold between tasks."""

from __future__ import annotations

from collections.abc import Callable, Hashable
from typing import Any

from loyalspan.session import ship

__all__ = ["held", "let_go", "ship"]
HELD: dict[Hashable, Any] = {}


def held(key: Hashable, build: Callable[[], Any]) -> Any:
    """What ``build`` makes, kept in this worker for its next tasks.

    A worker holds one such thing. The next operator that asks for another, or :func:`let_go`, frees
    it, so that workers do not pile up the caches of all operators they have served.
    """
    if key not in HELD:
        HELD.clear()
        HELD[key] = build()
    return HELD[key]


def let_go() -> None:
    HELD.clear()
