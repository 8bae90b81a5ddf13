"""Tables that stay in the Python process that made them."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Hashable
from typing import Any

_HOLDER = "_panelcast_worker_tables"


class WorkerCache:
    """Named store of a Python worker.

    The package travels to the workers by value, so an ordinary module-level
    cache would be pickled into every task and unpickled there as a copy of its own.
    This object's pickled form is its name and size; the entries hang on a module
    object of the interpreter, where all tasks of a worker find them. Entries
    are copies of what a task can make anew, so a lost worker costs time only.
    A worker serves one job after the other, so what a store adds replaces the tables of all other stores.
    """

    def __init__(self, name: str, keep: int = 4):
        self.name, self.keep = name, keep

    def _entries(self) -> dict:
        holder = sys.modules.setdefault(_HOLDER, types.ModuleType(_HOLDER))
        return holder.__dict__.setdefault(self.name, {})

    def get(self, key: Hashable, make: Callable[[], Any]) -> Any:
        """The entry of ``key``, made if the worker has none; the oldest entries make way."""
        found = self.peek(key)
        if found is None:
            found = make()
            self.put(key, found)
        return found

    def peek(self, key: Hashable) -> Any:
        return self._entries().get(key)

    def put(self, key: Hashable, value: Any) -> None:
        entries = self._entries()
        for other in vars(sys.modules[_HOLDER]).values():
            if isinstance(other, dict) and other is not entries:
                other.clear()
        entries.pop(key, None)
        while len(entries) >= self.keep:
            del entries[next(iter(entries))]
        entries[key] = value
