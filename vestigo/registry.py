"""Named queries: a callable over (session, table folder) and, where SQL can
express it, the same question for an independent SQL engine."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass
class Registry:
    """Insertion-ordered queries and their SQL."""

    fns: dict[str, QueryFn] = field(default_factory=dict)
    sql: dict[str, str] = field(default_factory=dict)

    def query(self, name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
        def add(fn: QueryFn) -> QueryFn:
            if name in self.fns:
                raise ValueError(f"query {name} is registered twice")
            self.fns[name] = fn
            if sql is not None:
                self.sql[name] = sql
            return fn

        return add

    def update(self, other: Registry) -> None:
        for name, fn in other.fns.items():
            self.query(name, other.sql.get(name))(fn)
