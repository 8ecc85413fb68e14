"""Named queries over the provided tables, each with its DuckDB equivalent."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass
class Registry:
    """Queries by name; a query without SQL is checked by rows only."""

    runs: dict[str, Run] = field(default_factory=dict)
    sql: dict[str, str] = field(default_factory=dict)

    def query(self, sql: str | None = None) -> Callable[[Run], Run]:
        def add(run: Run) -> Run:
            self.runs[run.__name__] = run
            if sql is not None:
                self.sql[run.__name__] = sql
            return run

        return add
