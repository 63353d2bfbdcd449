"""How the plan modules collect their queries: a decorator that takes the oracle's SQL."""

from __future__ import annotations

from collections.abc import Callable

from .views import oracle


class Collected:
    def __init__(self):
        self.queries: dict[str, Callable] = {}
        self.oracles: dict[str, str] = {}

    def __call__(self, sql: str | None = None, *views: str):
        """Registers the function under its name, with `sql` over the given views."""

        sql = sql and sql.replace(", 6) AS ", ", 6) + 0 AS ")  # no negative zero

        def add(f: Callable) -> Callable:
            self.queries[f.__name__] = f
            if sql:
                self.oracles[f.__name__] = oracle(sql, *views) if views else sql
            return f

        return add


def rounded(df, *names: str, digits: int = 6):
    """`df` with columns rounded, and without negative zeros."""
    from pyspark.sql import functions as F

    return df.withColumns({n: F.round(F.col(n).cast("double"), digits) + 0.0 for n in names})
