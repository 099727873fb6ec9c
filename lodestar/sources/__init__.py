from lodestar.sources.files import (
    checkpoint_root,
    ensure_checkpoint_dir,
    materialize,
    new_stage_root,
    read_csv,
    read_tables,
    write_csv,
    write_parquet,
)
from lodestar.sources.jdbc import (
    JdbcConnection,
    JdbcPartitioning,
    jdbc_read_options,
    jdbc_reader,
    read_jdbc,
)
from lodestar.sources.specs import Col, TableSpec, cols

__all__ = [
    "Col",
    "JdbcConnection",
    "JdbcPartitioning",
    "TableSpec",
    "checkpoint_root",
    "cols",
    "ensure_checkpoint_dir",
    "jdbc_read_options",
    "jdbc_reader",
    "materialize",
    "new_stage_root",
    "read_csv",
    "read_jdbc",
    "read_tables",
    "write_csv",
    "write_parquet",
]
