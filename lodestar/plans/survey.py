"""Survey ingestion jobs (J12-J15) and their pipeline.

1. ``ingest``      - uploaded wide CSV -> row ids, facility, answer columns -> parquet
2. ``extract``     - site and survey dimensions (the warehouse ``extract``)
3. ``survey_join`` - answers x sites (facility_name) x surveys (facility_id)
4. ``melt``        - one row per (participant, survey, item) with a response

Answer columns are found by name pattern, so a file may carry any number of
them. The melt is an ``unpivot`` inside the scan stage, followed directly by
the missing-value drop; the only shuffle is the final sort.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructType

from lodestar.functions.ids import assert_unique, assign_ids
from lodestar.functions.patterns import ANSWER_PATTERN, matching_columns
from lodestar.operators.joins import (
    DEFAULT_MAX_BROADCAST_BYTES,
    DEFAULT_MAX_BROADCAST_ROWS,
    JoinStep,
    join_chain,
    small_enough,
)
from lodestar.operators.reshape import unpivot_values
from lodestar.operators.sort import sort_within_partitions
from lodestar.plans.warehouse import Reader, Sources, extract_stages, version_sizes
from lodestar.sources.files import materialize, read_csv
from lodestar.sources.published import Ledger, files_fingerprint
from lodestar.sources.sizes import Sizes, no_sizes
from lodestar.sources.specs import TableSpec, cols
from lodestar.sources.split_csv import read_split_csv

# --------------------------------------------------------------------------
# Dimension sources, join chain, column names and dataset names.

SURVEY_SOURCES: tuple[TableSpec, ...] = (
    TableSpec("correction_sites", "r_pca.correction_sites", cols("facility_name", "facility_id")),
    TableSpec("survey", "r_pca.survey", cols("facility_id", "survey_id")),
)

SURVEY_BASE = "pca"
SURVEY_CHAIN: tuple[JoinStep, ...] = (
    # Sites and surveys are dimensions; a facility may hold a large share of
    # the answers, so a (size-checked) broadcast keeps its rows off one task.
    JoinStep("correction_sites", ("facility_name",), "inner", broadcast="right"),
    JoinStep("survey", ("facility_id",), "inner", broadcast="right"),
)

ID_COL = "participant_id"
FACILITY_COL = "FACILITY"
FACILITY_NAME = "facility_name"
MELT_IDS = ("participant_id", "survey_id")
ITEM_COL = "item_id"
RESPONSE_COL = "response"
MELT_ORDER = ("participant_id", "item_id")

INPUT_TABLE = "pca_materialized"
JOIN_TABLE = "pca_join"
FINAL_TABLE = "pca_final"

# --------------------------------------------------------------------------


def common_type(df: DataFrame, columns: Sequence[str]) -> str:
    """The narrowest of int, bigint, double and string that holds every value of the text columns.

    One distributed pass that counts, per column, the values each type can read.
    """
    kinds = ("int", "bigint", "double")
    if not columns:
        return "string"
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(columns)],
                    *[F.count(F.col(f"`{c}`").try_cast(k)).alias(f"{k}{i}")
                      for i, c in enumerate(columns) for k in kinds]).first()
    return next((k for k in kinds if all(counts[f"{k}{i}"] == counts[f"n{i}"]
                                         for i in range(len(columns)))), "string")


def answer_type_of(raw: DataFrame, pattern: str = ANSWER_PATTERN) -> str | None:
    """The common type of the answers if all are text, else None (they have types already)."""
    answers = matching_columns(raw.columns, pattern)
    text = all(isinstance(raw.schema[c].dataType, StringType) for c in answers)
    return common_type(raw, answers) if text else None


def prepare(raw: DataFrame, answer_type: DataType | str | None = None,
            pattern: str = ANSWER_PATTERN, id_mode: str = "random") -> DataFrame:
    """J12 transform: id per row, facility renamed, answer columns by pattern.

    Output: ``participant_id, facility_name, <answers in file order>``. Answers
    are cast strictly (under ANSI mode) to ``answer_type``; with None, text
    answers get the one type that holds all of them (``common_type``) and
    typed ones stay. ``id_mode="hash"`` gives ids that a rerun over the same
    file reproduces (see ``assign_hash_ids``); ``"given"`` takes those of the column
    ``participant_id``.
    """
    answers = matching_columns(raw.columns, pattern)
    if FACILITY_COL not in raw.columns:
        raise KeyError(f"survey file lacks column {FACILITY_COL!r}")
    kind = answer_type if answer_type is not None else answer_type_of(raw, pattern)

    def answer(c: str):
        return (F.col(c).cast(kind) if kind is not None else F.col(c)).alias(c)

    rows = raw if id_mode == "given" else assign_ids(raw, ID_COL, id_mode)
    return rows.select(
        ID_COL, F.col(FACILITY_COL).alias(FACILITY_NAME), *[answer(c) for c in answers])


def ingest(spark: SparkSession, csv_path: str, out_path: str,
           schema: StructType | str | None = None, answer_type: DataType | str | None = None,
           multi_line: bool = True, id_mode: str = "random", split: bool = False,
           range_bytes: int | None = None) -> DataFrame:
    """Read the CSV, assign ids, write; check id uniqueness on the written data.

    ``split`` reads by byte ranges with quoted line breaks and headers united by name
    (``read_split_csv``): for large files, and for files whose columns differ.
    """
    raw = read_survey(spark, csv_path, schema, multi_line, split, range_bytes)
    out = materialize(spark, prepare(raw, answer_type, id_mode=id_mode), out_path)
    assert_unique(out, ID_COL)
    return out


def read_survey(spark: SparkSession, csv_path: str, schema: StructType | str | None = None, multi_line: bool = True,
                split: bool = False, range_bytes: int | None = None) -> DataFrame:
    """The uploaded rows (A6), by Spark's reader or, with ``split``, by byte ranges."""
    return (read_split_csv(spark, csv_path, schema, range_bytes=range_bytes) if split
            else read_csv(spark, csv_path, schema, multi_line))


def survey_join(tables: Mapping[str, DataFrame], base_unique: bool | None = None,
                order: bool = False, sizes: Sizes = no_sizes) -> DataFrame:
    """``pca`` x ``correction_sites`` x ``survey`` with set semantics.

    When the answer rows are a set, joining them to deduplicated dimensions gives
    a set again: only the (small) dimensions are deduplicated and the joined frame -
    answers times surveys per facility - needs no distinct. ``base_unique=True``
    asserts that (ids already checked, as in the pipeline); ``None`` makes the answers
    a set first, while they are narrow; ``False`` applies the distinct to the joined rows.

    ``order`` range-partitions the answers by id before the joins, so broadcast
    joins hand on partitions in id order and the melt need not shuffle the
    joined rows (``sort="local"``). Equal rows have equal ids and stand in one partition then,
    so making them a set needs no shuffle of its own.
    """
    answers = tables[SURVEY_BASE]
    if order:
        answers = answers.repartitionByRange(F.col(ID_COL).asc_nulls_first())
    if base_unique is None:
        answers, base_unique = answers.distinct(), True
    return join_chain({**tables, SURVEY_BASE: answers}, SURVEY_BASE, SURVEY_CHAIN, base_unique=base_unique, sizes=sizes)


def melt(joined: DataFrame, value_type: DataType | str | None = None,
         pattern: str = ANSWER_PATTERN, sort: bool | str = True) -> DataFrame:
    """Long responses ``participant_id, survey_id, item_id, response``, no missing.

    With ``sort`` the result is in total order of ``participant_id, item_id``
    (then ``survey_id, response``, so ties have a fixed order). The order is
    made on the wide rows, before the unpivot multiplies them: they are
    range-partitioned on ``participant_id``, and the long rows are then only
    sorted inside their partition. ``sort="local"`` leaves out the range
    partitioning: for rows that come in id ranges already (``survey_join`` with
    ``order``), or for writing files that are sorted inside.
    """
    if sort not in (True, False, "local"):
        raise ValueError(f"sort {sort!r} not in (True, False, 'local')")
    items = matching_columns(joined.columns, pattern)
    if sort is True:
        joined = joined.repartitionByRange(F.col(ID_COL).asc_nulls_first())
    long = unpivot_values(joined, MELT_IDS, items, ITEM_COL, RESPONSE_COL, value_type)
    if sort:
        order = [*MELT_ORDER, *[c for c in long.columns if c not in MELT_ORDER]]
        long = sort_within_partitions(long, order)
    return long


def melt_of_tables(tables: Mapping[str, DataFrame], base_unique: bool | None = None, sizes: Sizes = no_sizes) -> DataFrame:
    """J14 and J15 in one go, in total order, shuffling the answers and not the joined rows.

    That holds while the dimensions can be broadcast; beyond the bound the
    joins shuffle, and the joined rows are range-partitioned instead.
    """
    known = [sizes(s.table) for s in SURVEY_CHAIN]
    unknown = [tables[s.table].distinct() for s, size in zip(SURVEY_CHAIN, known, strict=True)
               if size is None or not size.fits(DEFAULT_MAX_BROADCAST_ROWS, DEFAULT_MAX_BROADCAST_BYTES)]
    if all(small_enough(unknown)):
        return melt(survey_join(tables, base_unique, order=True, sizes=sizes), sort="local")
    return melt(survey_join(tables, base_unique, sizes=sizes))


def run_pipeline(spark: SparkSession, csv_path: str, dims_reader: Reader, root: str,
                 dims: Sequence[TableSpec] = SURVEY_SOURCES,
                 schema: StructType | str | None = None,
                 answer_type: DataType | str | None = None, multi_line: bool = True,
                 id_mode: str = "random", split: bool = False, resume: bool = False,
                 sources: Sources | None = None) -> dict[str, str]:
    """Ingest and extract -> join -> melt, each stage through parquet.

    The answers are range-partitioned by id before the join is written, and
    each file of the long table is sorted inside. Outputs are replaced in one step and
    ``resume`` skips finished stages, as in the warehouse pipeline; a survey file that changed is
    ingested again. Returns the folder of the current version of every output.
    """
    ledger = Ledger(spark, root, resume)
    settings = [str(schema), str(answer_type), multi_line, id_mode, split]
    answers = ledger.stage(
        INPUT_TABLE, [files_fingerprint(spark, [csv_path]), *settings],
        lambda: prepare(read_survey(spark, csv_path, schema, multi_line, split), answer_type, id_mode=id_mode),
        check=lambda rows: assert_unique(rows, ID_COL))
    extracted = extract_stages(ledger, dims, dims_reader, sources)
    tables = {SURVEY_BASE: answers.read(spark), **{name: v.read(spark) for name, v in extracted.items()}}
    joined = ledger.stage(JOIN_TABLE, [repr(SURVEY_CHAIN), answers.fingerprint,
                                       *[extracted[name].fingerprint for name in sorted(extracted)]],
                          lambda: survey_join(tables, base_unique=True, order=True, sizes=version_sizes(spark, extracted)))
    final = ledger.stage(FINAL_TABLE, [joined.fingerprint], lambda: melt(joined.read(spark), sort="local"))
    made = {INPUT_TABLE: answers, **extracted, JOIN_TABLE: joined, FINAL_TABLE: final}
    return {name: v.folder for name, v in made.items()}
