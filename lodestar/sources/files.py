"""Parquet and CSV readers and writers (A3-A6, B1, B2) and stage folders.

Stages hand data to each other through parquet datasets in a shared folder:
a stage writes, the next reads back. That cuts lineage (a lost executor
recomputes at most one stage) and fixes non-deterministic values such as
random ids once they are written.

The shared folder is the session's ``spark.checkpoint.dir``; the library
never invents a machine-local folder. ``ensure_checkpoint_dir`` sets one only
when the session has none, which is the case in tests and local runs.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


# --------------------------------------------------------------------------
# shared stage folders


def checkpoint_root(spark: SparkSession) -> str | None:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/") if root else None


def ensure_checkpoint_dir(spark: SparkSession, local_parent: str = "/tmp") -> str:
    """Return the shared folder; create one only for a local session that has none.

    On a cluster a machine-local folder would not be shared by the executors,
    so an unset ``spark.checkpoint.dir`` is an error there.
    """
    root = checkpoint_root(spark)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lodestar-ckpt-",
                                                             dir=local_parent))
        root = checkpoint_root(spark)
    return root


def new_stage_root(spark: SparkSession, label: str = "run") -> str:
    """A fresh folder under the shared checkpoint folder for one run."""
    root = checkpoint_root(spark)
    if root is None:
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    return f"{root}/lodestar/{label}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, pattern: str) -> bool:
    """Whether any file or folder matches a path pattern, in any store that Spark reads."""
    try:
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(pattern)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return not listed.select("path").limit(1).isEmpty()


# --------------------------------------------------------------------------
# parquet


def read_tables(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """Lazy scans of a named set of parquet datasets (A4)."""
    return {name: spark.read.parquet(p) for name, p in paths.items()}


def write_parquet(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> str:
    """Replace the dataset at ``path`` (B1); returns the path."""
    w = df.write.mode("overwrite")
    parts = list(partition_by)
    if parts:
        w = w.partitionBy(*parts)
    w.parquet(path)
    return path


def materialize(spark: SparkSession, df: DataFrame, path: str,
                partition_by: Iterable[str] = ()) -> DataFrame:
    """Write ``df`` and return the read-back dataset in ``df``'s column order."""
    schema = df.schema
    write_parquet(df, path, partition_by)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


# --------------------------------------------------------------------------
# CSV


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             multi_line: bool = True) -> DataFrame:
    """CSV with a header row; empty fields read as null.

    Columns are found by their name in the header. With a ``schema`` its columns
    are selected by name, in its order, and cast strictly (under ANSI mode);
    a column that the header lacks is an error. Without one every column is
    text and only the header line is read to name them; the caller casts what
    it needs. No ``inferSchema``: that would be an extra full pass.

    Files of one folder must have the same header; another one fails the read
    and names the file. Quoted line breaks are read as part of the value.
    ``multi_line=False`` splits large files over tasks instead; it is for files
    without quoted line breaks, and then every line is checked in full (no
    column pruning), so a broken row fails the read.
    """
    reader = csv_options(spark.read, multi_line)
    if not multi_line:
        reader = reader.option("columnPruning", False)
    raw = reader.csv(path)
    if schema is None:
        return raw
    fields = spark.createDataFrame([], schema).schema.fields
    missing = [f.name for f in fields if f.name not in raw.columns]
    if missing:
        raise KeyError(f"CSV header of {path} lacks columns {missing}")
    return raw.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in fields])


def csv_options(reader, multi_line: bool = True):
    """Options of a CSV reader, batch or streaming: header checked in every file, broken rows fail."""
    return (reader.option("header", True).option("escape", '"').option("mode", "FAILFAST")
            .option("multiLine", multi_line).option("enforceSchema", False))


def write_csv(df: DataFrame, path: str, row_index: str | None = None) -> str:
    """CSV export with a header.

    Quotes inside values are doubled and values with the delimiter, a quote
    or a line break are quoted, as pandas does; null and empty string are both
    written as an empty field; blanks at either end of a value stay. Spark writes a folder of part files, one per
    task, so the export scales with the data. ``row_index`` names a leading
    0-based row-number column (pandas writes its index unless told not to);
    off by default.
    """
    if row_index is not None:
        from lodestar.functions.ids import with_row_index
        df = with_row_index(df, row_index)
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("emptyValue", "").option("nullValue", "").csv(path))
    return path
