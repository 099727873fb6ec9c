"""Relational extraction over JDBC (A1, A2).

Connection values are passed in by the caller (from the deployment's secret
store); they go into reader options only and are never logged.

Without a partition column the spec's SELECT is sent as one ``query`` and read
by one task. With ``partition_column`` the SELECT becomes a derived table and
Spark issues ``num_partitions`` range queries in parallel, one per task, so a
large source table is read by many executors at once. The ranges are of equal width
between the column's bounds, or, for a column whose values are unevenly
spread, of equal row counts: the database cuts the column into tiles, and every
tile's first value starts a range (``range_predicates``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from lodestar.sources.specs import TableSpec


@dataclass(frozen=True)
class JdbcConnection:
    url: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str | None = None
    fetchsize: int = 10_000

    @classmethod
    def postgres(cls, host: str, port: int | str, database: str, user: str,
                 password: str) -> "JdbcConnection":
        return cls(url=f"jdbc:postgresql://{host}:{port}/{database}", user=user,
                   password=password, driver="org.postgresql.Driver")

    def options(self) -> dict[str, str]:
        opts = {"url": self.url, "fetchsize": str(self.fetchsize)}
        if self.user is not None:
            opts["user"] = self.user
        if self.password is not None:
            opts["password"] = self.password
        if self.driver:
            opts["driver"] = self.driver
        return opts


@dataclass(frozen=True)
class JdbcPartitioning:
    column: str
    lower_bound: int
    upper_bound: int
    num_partitions: int


def jdbc_read_options(conn: JdbcConnection, spec: TableSpec,
                      partitioning: JdbcPartitioning | None = None) -> dict[str, str]:
    opts = conn.options()
    if partitioning is None:
        opts["query"] = spec.to_sql()
    else:
        if partitioning.column not in spec.output_columns:
            raise ValueError(f"partition column {partitioning.column!r} not in {spec.name}")
        opts["dbtable"] = f"({spec.to_sql()}) AS {spec.name}_src"
        opts["partitionColumn"] = partitioning.column
        opts["lowerBound"] = str(partitioning.lower_bound)
        opts["upperBound"] = str(partitioning.upper_bound)
        opts["numPartitions"] = str(partitioning.num_partitions)
    return opts


def read_jdbc(spark: SparkSession, conn: JdbcConnection, spec: TableSpec,
              partitioning: JdbcPartitioning | None = None) -> DataFrame:
    """Extract one spec; the result has the spec's output columns in order."""
    reader = spark.read.format("jdbc")
    for k, v in jdbc_read_options(conn, spec, partitioning).items():
        reader = reader.option(k, v)
    return reader.load().select(*spec.output_columns)


def bounds_sql(spec: TableSpec, column: str) -> str:
    """One query for the smallest and largest value of an output column of a spec."""
    if column not in spec.output_columns:
        raise ValueError(f"partition column {column!r} not in {spec.name}")
    return f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM ({spec.to_sql()}) AS {spec.name}_bounds"


def derive_partitioning(spark: SparkSession, conn: JdbcConnection, spec: TableSpec, column: str,
                        num_partitions: int) -> JdbcPartitioning | None:
    """Range partitioning over the column's actual range; None for an empty table."""
    reader = spark.read.format("jdbc").options(**conn.options())
    row = reader.option("query", bounds_sql(spec, column)).load().first()
    if row is None or row["lo"] is None:
        return None
    return JdbcPartitioning(column, int(row["lo"]), int(row["hi"]) + 1, num_partitions)


def tiles_sql(spec: TableSpec, column: str, num_partitions: int) -> str:
    """One query for the first value of each of ``num_partitions`` tiles of equal row count."""
    if column not in spec.output_columns:
        raise ValueError(f"partition column {column!r} not in {spec.name}")
    return (f"SELECT MIN(v) AS lo FROM (SELECT {column} AS v, NTILE({num_partitions}) OVER (ORDER BY {column}) AS tile "
            f"FROM ({spec.to_sql()}) AS {spec.name}_all WHERE {column} IS NOT NULL) AS {spec.name}_tiles GROUP BY tile")


def _literal(value: int | str) -> str:
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(int(value))


def range_predicates(column: str, firsts: Sequence[int | str]) -> list[str]:
    """Conditions that deal every row, nulls included, to exactly one range.

    ``firsts`` are the tiles' first values. The first range has no lower and the last no upper
    bound, so rows that come in between two queries are read too. A value that starts
    several tiles fills at least one: it is a range of its own.
    """
    cuts = sorted(firsts)
    hot = {a for a, b in zip(cuts, cuts[1:], strict=False) if a == b}
    marks: list[tuple[str, str]] = []  # (upper condition of the range before, lower condition of the range after)
    for v in dict.fromkeys(cuts):
        x = _literal(v)
        if v != cuts[0] or v in hot:
            marks.append((f"{column} < {x}", f"{column} >= {x}"))
        if v in hot:
            marks.append((f"{column} <= {x}", f"{column} > {x}"))
    if not marks:
        return ["1 = 1"]
    out = [f"{marks[0][0]} OR {column} IS NULL"]
    out += [f"{a[1]} AND {b[0]}" for a, b in zip(marks, marks[1:], strict=False)]
    return [*out, marks[-1][1]]


def read_jdbc_by_tiles(spark: SparkSession, conn: JdbcConnection, spec: TableSpec, column: str,
                       num_partitions: int) -> DataFrame:
    """Extract one spec by ranges of equal row counts of ``column``, one task each."""
    tiles = spark.read.format("jdbc").options(**conn.options()).option("query", tiles_sql(spec, column, num_partitions)).load()
    predicates = range_predicates(column, [r["lo"] for r in tiles.collect()])  # at most num_partitions values
    opts = conn.options()
    return spark.read.jdbc(opts.pop("url"), f"({spec.to_sql()}) AS {spec.name}_src", predicates=predicates,
                           properties=opts).select(*spec.output_columns)


def jdbc_reader(spark: SparkSession, conn: JdbcConnection,
                partitions: dict[str, JdbcPartitioning] | None = None,
                split_on: dict[str, str] | None = None, num_partitions: int = 64, even_rows: bool = False):
    """A ``reader(spec) -> DataFrame`` for ``lodestar.plans.extract``.

    ``split_on`` names an integer column per large table (the warehouse's fact
    tables are ``plans.warehouse.FACT_SPLITS``); such a table is read by
    ``num_partitions`` range queries over the bounds that one MIN/MAX query
    gives, unless ``partitions`` states its partitioning. With ``even_rows`` the
    ranges hold equal row counts (one sort of the column in the database), for
    columns whose values are unevenly spread or repeat. Other tables are read
    by one query, in one task.
    """
    partitions, split_on = partitions or {}, split_on or {}

    def read(spec: TableSpec) -> DataFrame:
        how = partitions.get(spec.name)
        if how is None and spec.name in split_on and even_rows:
            return read_jdbc_by_tiles(spark, conn, spec, split_on[spec.name], num_partitions)
        if how is None and spec.name in split_on:
            how = derive_partitioning(spark, conn, spec, split_on[spec.name], num_partitions)
        return read_jdbc(spark, conn, spec, how)
    return read
