"""Declarative extraction specs.

A ``TableSpec`` says what one extracted table holds: the source relation, the
columns with optional alias and cast, and an optional row filter. The same
spec can be

* applied to any DataFrame (``apply``): filter first, then project and cast,
  so Catalyst pushes the filter and the column list into the scan; or
* rendered as the SELECT text of a JDBC ``query`` (``to_sql``), so the
  database does the projection and the filter.

Column entries are Spark SQL expressions; for a plain source column that is
just its name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Col:
    expr: str
    alias: str | None = None
    cast: str | None = None

    @property
    def name(self) -> str:
        return self.alias or self.expr

    def column(self) -> Column:
        c = F.expr(self.expr)
        if self.cast:
            c = c.cast(self.cast)
        return c.alias(self.name)

    def sql(self) -> str:
        text = f"CAST({self.expr} AS {self.cast})" if self.cast else self.expr
        if self.alias or self.cast:
            text += f" AS {self.name}"
        return text


def cols(*names: str, cast: str | None = None) -> tuple[Col, ...]:
    return tuple(Col(n, cast=cast) for n in names)


@dataclass(frozen=True)
class TableSpec:
    name: str
    source: str
    columns: tuple[Col, ...]
    where: str | None = None

    @property
    def output_columns(self) -> list[str]:
        return [c.name for c in self.columns]

    def apply(self, df: DataFrame) -> DataFrame:
        if self.where:
            df = df.where(F.expr(self.where))
        return df.select(*[c.column() for c in self.columns])

    def to_sql(self) -> str:
        text = f"SELECT {', '.join(c.sql() for c in self.columns)} FROM {self.source}"
        if self.where:
            text += f" WHERE {self.where}"
        return text
