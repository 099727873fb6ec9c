"""lodestar: warehouse denormalization and survey ingestion jobs on Spark.

Every job is a function from DataFrames to DataFrames. Nothing is collected
to the driver except column lists and small scalar checks; all work is
expressed with the DataFrame API so Catalyst can prune columns, push filters
into the scans and pick join strategies.

Subpackages:

* ``sources``   - table specs, JDBC / parquet / CSV readers and writers
* ``operators`` - projection, join chain, distinct / group count, unpivot
* ``functions`` - column-level helpers (row ids, name patterns)
* ``plans``     - the composite jobs and the two pipelines
* ``streaming`` - incremental pick-up of uploaded survey files
"""

__version__ = "0.1.0"
