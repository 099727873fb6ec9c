"""Row counts and value bytes of parquet tables from their footers.

A footer holds the rows of each row group and, in its size statistics, the bytes of
the text values before they are encoded, so a table's size is known without
a Spark job. The footers of at most ``MAX_FILES`` files are read, on the driver;
a table of more files is not a small one. A file without size
statistics (of an older writer) gives no size, and callers count instead.

All sizes are upper bounds: a filter only lowers them, and a join is
bounded by the product of its sides.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from typing import TypeVar

from pyspark.sql import SparkSession
from pyspark.sql.types import BinaryType, StringType, StructType

from lodestar.sources.specs import TableSpec

T = TypeVar("T")

#: Files whose footers are read at most.
MAX_FILES = 64

# Bytes per value of the fixed-width types.
FIXED_WIDTH = {"boolean": 1, "byte": 1, "short": 2, "integer": 4, "date": 4, "float": 4,
               "long": 8, "double": 8, "timestamp": 8, "timestamp_ntz": 8}
#: Bytes per value of any other type that is not text, and most characters of a number as text.
OTHER_WIDTH, NUMBER_TEXT = 16, 32


@dataclass(frozen=True)
class TableSize:
    """At most this many rows and bytes of values."""

    rows: int
    bytes: int

    def fits(self, max_rows: int, max_bytes: int) -> bool:
        return self.rows <= max_rows and self.bytes <= max_bytes

    def joined(self, other: "TableSize", how: str = "inner") -> "TableSize":
        """Of a join: every pair of rows may match, and a left join keeps every left row."""
        if how == "semi":
            return self
        n = max(other.rows, 1) if how == "left" else other.rows
        return TableSize(self.rows * n, self.bytes * n + other.bytes * self.rows)


#: The size of a table by name; None if it is not known.
Sizes = Callable[[str], "TableSize | None"]


def no_sizes(name: str) -> TableSize | None:
    return None


@dataclass(frozen=True)
class ParquetStats:
    rows: int
    #: Bytes of the text and binary columns' values by column; None where the files do not tell.
    text: dict[str, int | None]


def parquet_stats(spark: SparkSession, path: str) -> ParquetStats | None:
    """Of the parquet files of a file or folder; None for more than ``MAX_FILES`` files or none."""
    from lodestar.sources.published import list_files
    files = [f for f, _, _ in list_files(spark, [path]) if f.endswith(".parquet")]
    if not 0 < len(files) <= MAX_FILES:
        return None
    hadoop = spark.sparkContext._jvm.org.apache
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    rows, text = 0, {}
    for f in files:
        reader = hadoop.parquet.hadoop.ParquetFileReader.open(
            hadoop.parquet.hadoop.util.HadoopInputFile.fromPath(hadoop.hadoop.fs.Path(f), conf))
        try:
            for block in reader.getFooter().getBlocks():
                rows += block.getRowCount()
                for column in block.getColumns():
                    name = column.getPath().toDotString()
                    if column.getPrimitiveType().getPrimitiveTypeName().toString() != "BINARY":
                        continue
                    stats = column.getSizeStatistics()
                    size = stats.getUnencodedByteArrayDataBytes().orElse(None) if stats is not None else None
                    known = text.get(name, 0)
                    text[name] = None if size is None or known is None else known + size
        finally:
            reader.close()
    return ParquetStats(rows, text)


def size_of(stats: ParquetStats | None, schema: StructType, spec: TableSpec | None = None) -> TableSize | None:
    """The size of a table of ``stats``, or of a ``spec`` over it, whose rows have ``schema``.

    A text column of the spec must be a text column of the table, a number as text, or NULL.
    """
    if stats is None:
        return None
    source = {c.name: c.expr for c in spec.columns} if spec else {f.name: f.name for f in schema.fields}
    total = 0
    for f in schema.fields:
        if not isinstance(f.dataType, (StringType, BinaryType)):
            total += stats.rows * FIXED_WIDTH.get(f.dataType.typeName(), OTHER_WIDTH)
        elif source[f.name] in stats.text:
            if stats.text[source[f.name]] is None:
                return None
            total += stats.text[source[f.name]]
        elif spec is None or not source[f.name].isidentifier():
            return None
        elif source[f.name].upper() != "NULL":
            total += stats.rows * NUMBER_TEXT
    return TableSize(stats.rows, total)


def folder_size(spark: SparkSession, path: str, schema: StructType) -> TableSize | None:
    """The size of a parquet dataset of flat columns."""
    return size_of(parquet_stats(spark, path), schema)


def sizes_of(known: Mapping[str, Callable[[], T | None]]) -> Callable[[str], T | None]:
    """Sizes (or footer statistics) by name that are looked up when asked for, once each."""
    found: dict[str, T | None] = {}

    def size(name: str) -> T | None:
        if name not in found:
            found[name] = known[name]() if name in known else None
        return found[name]
    return size
