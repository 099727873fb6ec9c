"""Local session for tests, the benchmark and the driver smoke check.

On a cluster the deployment owns the session; jobs only take a
``SparkSession``. The settings here are the ones the jobs rely on:

* AQE on, with partition coalescing and skew-join splitting (Spark 4
  defaults, stated so a cluster profile cannot silently drop them);
* ANSI mode on, so key casts are strict;
* ``requireAllClusterKeysForCoPartition`` off: the warehouse chain joins on
  ``applicationid`` and then on ``(childid, applicationid)``; with this off
  the second join reuses the first one's partitioning and only the new
  table is shuffled, not the wide chain frame;
* ``forceOptimizeSkewedJoin`` on: the distinct that makes the chain a set
  (``unique_from``) reuses the partitioning of the fact joins before it, and by
  default AQE would then not split a hot join key (splitting breaks that
  partitioning). Forced, AQE splits the hot key and pays one extra shuffle only
  when it actually finds skew;
* the UI off.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

from lodestar.sources.files import ensure_checkpoint_dir


def local_session(cores: int | str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "lodestar") -> SparkSession:
    cores = cores or os.environ.get("LODESTAR_CPUS", "8")
    parts = shuffle_partitions or (int(cores) if str(cores).isdigit() else 8)
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.requireAllClusterKeysForCoPartition", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("LODESTAR_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark
