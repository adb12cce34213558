"""A name → DataFrame mapping whose entries are put together on first use."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from threading import RLock

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


class LazyTables(Mapping[str, DataFrame]):
    """Plans nobody asks for are never built; a plan asked for twice, also by two threads, is built once."""

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]) -> None:
        self._builders = dict(builders)
        self._built: dict[str, DataFrame] = {}
        self._locks = {name: RLock() for name in self._builders}

    def __getitem__(self, name: str) -> DataFrame:
        with self._locks[name]:
            if name not in self._built:
                self._built[name] = self._builders[name]()
            return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def __or__(self, other: Mapping[str, DataFrame]) -> LazyTables:
        return LazyTables(_deferred(self) | _deferred(other))


# Tables in work at once: enough that one table's last tasks do not idle the cluster.
_SIDE_BY_SIDE = 4


def side_by_side[T](work: Callable[[str], T], names: Iterable[str]) -> dict[str, T]:
    """``work`` for tables that do not depend on each other, from a few driver threads.

    Results come in the order of ``names``; the first failure is raised once all have ended.
    """
    names = list(names)
    in_thread = inheritable_thread_target(SparkSession.active())(work)
    with ThreadPoolExecutor(_SIDE_BY_SIDE) as pool:
        return dict(zip(names, pool.map(in_thread, names), strict=True))


def _deferred(tables: Mapping[str, DataFrame]) -> dict[str, Callable[[], DataFrame]]:
    return {name: (lambda t=tables, n=name: t[n]) for name in tables}


def mapped(
    tables: Mapping[str, DataFrame], change: Callable[[str, DataFrame], DataFrame]
) -> LazyTables:
    return LazyTables({name: (lambda n=name: change(n, tables[n])) for name in tables})
