"""Transformations that configuration can name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..operators.joins import join_on

Transformation = Callable[..., DataFrame]


class Registry:
    def __init__(self) -> None:
        self._known: dict[str, Transformation] = {}

    def register(self, name: str | None = None) -> Callable[[Transformation], Transformation]:
        """Decorator; the name defaults to the function's, a later one replaces
        an earlier one."""

        def add(function: Transformation) -> Transformation:
            self._known[name or function.__name__] = function
            return function

        return add

    def get(self, name: str) -> Transformation:
        if name not in self._known:
            raise ValueError(f"Unknown transformation {name!r}; known: {self.names()}")
        return self._known[name]

    def names(self) -> list[str]:
        return list(self._known)


registry = Registry()
registry.register("join_df")(join_on)
