"""Multi-step queries written as a chain: source, where, stats, fields, sort, head."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logframe.functions.fields import field
from logframe.functions.predicates import Condition, condition


def count() -> Column:
    """Rows in a group."""
    return F.count(F.lit(1))


class Chain:
    """Stages over a table; each returns a new chain and none runs a job.

    ``.df`` is the result, whose schema and rows are the reply.
    """

    def __init__(self, df: DataFrame):
        self.df = df

    def where(self, where: Condition) -> Chain:
        return Chain(self.df.filter(condition(where)))

    def stats(self, by: str | list[str] | None = None, **aggregates: Column) -> Chain:
        """Aggregates named by their keyword, per value of the ``by`` fields."""
        if not aggregates:
            raise ValueError("stats needs at least one aggregate, such as hits=count()")
        paths = [by] if isinstance(by, str) else by or []
        groups = [field(self.df, path).alias(path) for path in paths]
        return Chain(self.df.groupBy(*groups).agg(*[a.alias(n) for n, a in aggregates.items()]))

    def fields(self, *paths: str) -> Chain:
        return Chain(self.df.select(*[field(self.df, path).alias(path) for path in paths]))

    def sort(self, *paths: str) -> Chain:
        """Ascending, or descending after a leading ``-``; missing values last."""
        order = []
        for path in paths:
            column = field(self.df, path.removeprefix("-"))
            order.append(
                column.desc_nulls_last() if path.startswith("-") else column.asc_nulls_last()
            )
        return Chain(self.df.orderBy(*order))

    def head(self, n: int = 10) -> Chain:
        return Chain(self.df.limit(n))


def chain(df: DataFrame) -> Chain:
    """Start a chain on a table, for instance one from ``scan``."""
    return Chain(df)
