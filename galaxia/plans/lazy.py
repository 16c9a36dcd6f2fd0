"""Thread-safe, build-once mappings of tables."""

from __future__ import annotations

import contextvars
import threading
from concurrent.futures import ThreadPoolExecutor

from ..operators.ids import packed, shown


class OnceDict(dict):
    """A dict whose missing entries are built by :meth:`build`, once each, even
    when several threads ask at the same time (independent entries are built
    concurrently)."""

    def __init__(self):
        super().__init__()
        self._locks: dict = {}
        self._guard = threading.Lock()

    def build(self, key):  # pragma: no cover - overridden
        raise KeyError(key)

    def __missing__(self, key):
        with self._guard:
            lock = self._locks.setdefault(key, threading.RLock())
        with lock:
            if dict.__contains__(self, key):
                return dict.__getitem__(self, key)
            value = self.build(key)
            self[key] = value
            return value


class Lazy(OnceDict):
    """Entries built by the given zero-argument callables on first access."""

    def __init__(self, thunks: dict):
        super().__init__()
        self.thunks = dict(thunks)

    def build(self, key):
        return self.thunks[key]()

    def names(self):
        return list(self.thunks)


class Shown(OnceDict):
    """The tables of ``packed`` with their ids as text."""

    def __init__(self, packed):
        super().__init__()
        self.packed = packed

    def build(self, key):
        df = self.packed[key]
        return None if df is None else shown(df)


class _Packed(OnceDict):
    def __init__(self, tables):
        super().__init__()
        self.tables = tables

    def build(self, key):
        df = self.tables[key]
        return None if df is None else packed(df)


def packed_tables(tables):
    """``tables`` with packed ids: those behind a :class:`Shown`, or else each packed."""
    return tables.packed if isinstance(tables, Shown) else _Packed(tables)


def build_all(names, fn, workers: int = 4) -> dict:
    """``fn`` of each name on a few driver threads: Spark runs the jobs of different
    threads side by side."""
    with ThreadPoolExecutor(max_workers=max(1, workers)) as pool:
        futures = {n: pool.submit(contextvars.copy_context().run, fn, n) for n in names}
        return {n: f.result() for n, f in futures.items()}
