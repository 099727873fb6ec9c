"""Row identifiers.

``assign_ids`` appends a random version-4 UUID per row with ``F.uuid()``;
the ids are generated on the executors, never as a driver-side list.

``uuid()`` is non-deterministic: a frame built twice gets new ids. The jobs
therefore assign ids in the same stage that writes them (no shuffle in
between, so a retried task rewrites only its own file) and read the written
data back before checking or joining on the ids.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ID_PATTERN = r"^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"

_POSITION_BITS = 33  # monotonically_increasing_id: partition index above, position below

#: Repeated hashes (8 bytes each) that are broadcast to the rows.
MAX_BROADCAST_SUSPECTS = 1_000_000

# Fixed values: (start, length) of the five hex groups of a UUID-shaped id.
_UUID_GROUPS = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))


def uuid_column() -> Column:
    return F.expr("uuid()")


def assign_ids(df: DataFrame, id_col: str = "participant_id", mode: str = "random") -> DataFrame:
    """Append ``id_col`` with one id per row.

    ``mode="random"``: a random v4 UUID string, as the jobs this re-expresses
    do. ``mode="hash"``: an id that a rerun over the same rows reproduces
    (``assign_hash_ids``).
    """
    if id_col in df.columns:
        raise ValueError(f"column {id_col!r} already exists")
    if mode == "hash":
        return assign_hash_ids(df, id_col)
    if mode != "random":
        raise ValueError(f"id mode {mode!r} not in ('random', 'hash')")
    return df.withColumn(id_col, uuid_column())


def row_hash(columns: Sequence[str]) -> Column:
    """SHA-256 of a row's values."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def hash_id(h: Column, occurrence: Column) -> Column:
    """The UUID-shaped id of the row with this hash and occurrence number among identical rows."""
    h = F.sha2(F.concat_ws(":", h, occurrence.cast("string")), 256)
    return F.concat_ws("-", *[F.substring(h, start, n) for start, n in _UUID_GROUPS])


def assign_hash_ids(df: DataFrame, id_col: str = "participant_id") -> DataFrame:
    """Append ``id_col``: SHA-256 of the row's values and its occurrence number, UUID-shaped.

    Identical rows get occurrence numbers ``0..c-1``, so they get different
    ids, and the same multiset of rows gets the same ids whatever its
    partitioning. The numbering never gathers a group of identical rows into
    one task: rows are counted per (row hash, input partition); a running sum
    over those counts - at most one row per input partition for any row hash -
    gives each partition's offset; a row's number is its offset plus its
    position among the identical rows of its own input partition. The input
    must keep its partitioning between passes, e.g. a file scan (as for an
    uploaded survey file).
    """
    if id_col in df.columns:
        raise ValueError(f"column {id_col!r} already exists")
    cols = df.columns
    mid = F.monotonically_increasing_id()
    tagged = df.select(*cols, row_hash(cols).alias("__h"),
                       F.shiftright(mid, _POSITION_BITS).alias("__part"))
    counts = tagged.groupBy("__h", "__part").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select(
        "__h", "__part",
        (F.sum("__n").over(Window.partitionBy("__h").orderBy("__part")) - F.col("__n"))
        .alias("__off"))
    numbered = tagged.withColumn(
        "__pos", F.row_number().over(Window.partitionBy("__h", "__part").orderBy("__h")) - 1)
    # A left join and a check: should the input be partitioned differently in the two passes, rows
    # must not vanish silently.
    offset = F.coalesce("__off", F.raise_error(F.lit("the input changed its partitioning between passes")))
    shaped = hash_id(F.col("__h"), offset + F.col("__pos"))
    return numbered.join(offsets, ["__h", "__part"], "left").select(*cols, shaped.alias(id_col))


class IdCollisionError(ValueError):
    pass


def id_stats(df: DataFrame, id_col: str = "participant_id") -> DataFrame:
    """One row: ``n_rows`` and ``n_distinct`` ids (F3, F4); distributed."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct(F.col(id_col)).alias("n_distinct"),
    )


def unique_counts(df: DataFrame, id_col: str = "participant_id",
                  hash_of: Callable[[str], Column] = F.xxhash64) -> tuple[int, int]:
    """The number of rows and of distinct ids (F3, F4), without shuffling the ids.

    The first pass counts the rows of each 64-bit hash: 8 bytes and a number move
    per row, after partial aggregation. Ids whose hash stands alone are distinct. Only rows whose
    hash repeats - real repetitions and chance collisions - are compared
    exactly, in a second pass that does not run if there are none. Their hashes
    are broadcast while there are at most ``MAX_BROADCAST_SUSPECTS``.
    """
    ids = df.select(F.col(id_col).alias("id"))
    h = F.when(F.col("id").isNotNull(), hash_of("id"))
    groups = ids.groupBy(h.alias("h")).agg(F.count(F.lit(1)).alias("n"))
    known = F.col("h").isNotNull()
    n_rows, n_hashes, n_suspects = groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count_if(known), F.count_if(known & (F.col("n") > 1))).first()
    if not n_suspects:
        return int(n_rows), int(n_hashes)
    suspects = groups.where(known & (F.col("n") > 1)).select("h")
    if n_suspects <= MAX_BROADCAST_SUSPECTS:
        suspects = F.broadcast(suspects)
    exact = ids.withColumn("h", h).join(suspects, "h", "left_semi").agg(F.countDistinct("id")).first()[0]
    return int(n_rows), int(n_hashes - n_suspects + exact)


def assert_unique(df: DataFrame, id_col: str = "participant_id") -> int:
    """Raise ``IdCollisionError`` when an id repeats; return the row count.

    Only the counts reach the driver. A null id counts as a collision,
    since it cannot identify a row.
    """
    n_rows, n_distinct = unique_counts(df, id_col)
    if n_rows != n_distinct:
        raise IdCollisionError(
            f"{id_col}: {n_rows} rows but {n_distinct} distinct non-null ids"
        )
    return n_rows


def with_row_index(df: DataFrame, name: str = "index") -> DataFrame:
    """Prepend ``name``: 0-based row number in the frame's partition order (B2 option).

    Distributed: one job counts the rows of each partition (one row per
    partition reaches the driver), the running offsets go back as a small
    table, broadcast (its size is the partition count), and each row adds its
    position inside its partition. No window over the whole frame, no
    single-task step. The frame must have a fixed partitioning and order
    between the two passes, e.g. a parquet scan (as in the CSV export, which
    reads the written flat table).
    """
    if name in df.columns:
        raise ValueError(f"column {name!r} already exists")
    mid = F.monotonically_increasing_id()
    tagged = df.select(F.shiftright(mid, _POSITION_BITS).alias("__part"),
                       (mid - F.shiftleft(F.shiftright(mid, _POSITION_BITS), _POSITION_BITS))
                       .alias("__pos"), *df.columns)
    counts = sorted((int(r["__part"]), int(r["n"])) for r in
                    tagged.groupBy("__part").agg(F.count(F.lit(1)).alias("n")).collect())
    offsets, total = [], 0
    for part, n in counts:
        offsets.append((part, total))
        total += n
    spark = df.sparkSession
    table = spark.createDataFrame(offsets or [(0, 0)], "__part long, __offset long")
    return (tagged.join(F.broadcast(table), "__part", "left")
            .select((F.col("__offset") + F.col("__pos")).alias(name), *df.columns))
