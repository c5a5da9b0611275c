"""Tables by name, each built when it is first asked for."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame


class LazyTables(Mapping[str, DataFrame]):
    """A pipeline's outputs.  Some write intermediates while they are built,
    so a caller that wants one table should not build the others."""

    def __init__(self, makers: Mapping[str, Callable[[], DataFrame]]) -> None:
        self._makers, self._made = dict(makers), {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)

    def __or__(self, other: Mapping[str, DataFrame]) -> LazyTables:
        both = LazyTables({**self._makers, **{k: (lambda v=v: v) for k, v in other.items()}})
        both._made = {k: v for k, v in self._made.items() if k not in other}
        return both
