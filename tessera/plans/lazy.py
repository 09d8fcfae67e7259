"""A mapping of named DataFrames that are defined on first access.

Building a DataFrame is cheap for Spark but not free for the Python client:
each transformation is analysed eagerly. Queries that need two tables of a
star should not pay for defining all fourteen.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame


class LazyTables(Mapping):
    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders = dict(builders)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def provide(self, name: str, df: DataFrame) -> None:
        """Use an already defined DataFrame (e.g. a written table) for ``name``."""
        self._built[name] = df
