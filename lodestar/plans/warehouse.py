"""Warehouse extraction jobs (J1-J11) and their pipeline.

Stages, each a function of DataFrames:

1. ``extract``      - one spec per source table -> parquet dataset per table
2. ``denormalize``  - 8 inner + 4 left joins -> one wide set of rows
3. ``select_total`` - flat mailing projection (a bag: no year filter, no distinct)
4. ``normalize``    - five entity / relationship tables for one program year
5. ``duplicates``   - id+name groups that occur more than once
6. ``export_csv``   - CSV export of the flat table

``run_pipeline`` chains stages 1-4 through parquet datasets under one folder.
The wide table is written partitioned by ``program_year``, so every
normalized table reads only the files of its year.
"""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodestar.operators.aggregate import group_count, having_more_than, is_empty
from lodestar.operators.joins import JoinStep, chain_output_columns, join_chain
from lodestar.operators.sort import sort_rows
from lodestar.sources.files import materialize, write_csv, write_parquet  # noqa: F401
from lodestar.sources.published import Buckets, Ledger, Version
from lodestar.sources.sizes import Sizes, folder_size, sizes_of
from lodestar.sources.specs import Col, TableSpec, cols

log = logging.getLogger(__name__)

DEFAULT_YEAR = 2023

# --------------------------------------------------------------------------
# The source relations, their extracted columns and filters,
# the join chain and the output column lists of the warehouse jobs.

WAREHOUSE_SOURCES: tuple[TableSpec, ...] = (
    TableSpec("org", "r_ab.tblorg", cols("orgid", cast="INTEGER"), where="isnational = 1"),
    TableSpec("orgprg", "r_ab.tblorgprogram",
              cols("orgid", "programid", "orgprogramid", cast="INTEGER")),
    TableSpec("prg", "r_ab.tblprogram",
              (Col("programid", cast="INTEGER"),
               Col("programyear", "program_year", "INTEGER"))),
    TableSpec("prsprg", "r_ab.tblprisonprogram", cols("programid", cast="INTEGER")),
    TableSpec("orgprgchdj", "r_ab.tblorgprogramchildjoin",
              cols("orgprogramid", "applicationid", "childid", cast="INTEGER")),
    TableSpec("inmapp", "r_ab.tblinmateapp",
              cols("applicationid", "caregiverid", "inmateid", cast="INTEGER"),
              where="statusid = 1"),
    TableSpec("inmappchdj", "r_ab.tblinmateappchildjoin",
              (*cols("applicationid", "childid", cast="INTEGER"),
               Col("message", "message_to_child"),
               Col("parentnickname", "parent_nickname")),
              where="childstatusid = 1"),
    TableSpec("inm", "r_ab.tblinmate",
              (*cols("inmateid", "prisonid", cast="INTEGER"),
               Col("firstname", "inmate_first_name"),
               Col("lastname", "inmate_last_name"))),
    TableSpec("prs", "r_ab.tblprison", cols("prisonid", cast="INTEGER")),
    TableSpec("crg", "r_ab.tblCaregiver",
              (*cols("caregiverid", "addressid", "contactid", cast="INTEGER"),
               Col("firstname", "caregiver_first_name"),
               Col("lastname", "caregiver_last_name"))),
    TableSpec("adrcrg", "r_ab.tblAddressCaregiver",
              (Col("addressid", cast="INTEGER"),
               Col("address1", "caregiver_address1"),
               Col("address2", "caregiver_address2"),
               Col("city", "caregiver_city"),
               Col("stateid", "caregiver_stateid"),
               Col("zipcode", "caregiver_zipcode"))),
    TableSpec("cntcrg", "r_ab.tblContactCaregiver",
              (Col("contactid", cast="INTEGER"),
               Col("email", "caregiver_email"),
               Col("phone1", "caregiver_phone"))),
    TableSpec("chd", "r_ab.tblChild",
              (Col("childid", cast="INTEGER"),
               Col("firstname", "child_first_name"),
               Col("lastname", "child_last_name")),
              where="status = 1"),
)

WAREHOUSE_BASE = "org"
WAREHOUSE_CHAIN: tuple[JoinStep, ...] = (
    JoinStep("orgprg", ("orgid",), "inner"),
    JoinStep("prg", ("programid",), "inner"),
    JoinStep("prsprg", ("programid",), "inner"),
    # org/program dimensions in front of the child fact table: broadcast when small.
    JoinStep("orgprgchdj", ("orgprogramid",), "inner", broadcast="left"),
    JoinStep("inmapp", ("applicationid",), "inner"),
    JoinStep("inmappchdj", ("childid", "applicationid"), "inner"),
    JoinStep("inm", ("inmateid",), "inner", broadcast="right"),
    JoinStep("prs", ("prisonid",), "inner"),
    # Address and contact hang off the caregiver: joined to it first, so the
    # wide chain frame makes one left join for all three tables.
    JoinStep("crg", ("caregiverid",), "left", broadcast="right", branch=(
        JoinStep("adrcrg", ("addressid",), "left"),
        JoinStep("cntcrg", ("contactid",), "left"),
    )),
    JoinStep("chd", ("childid",), "left", broadcast="right"),
)

FLAT_COLUMNS = (
    "caregiver_first_name", "caregiver_last_name", "caregiver_address1",
    "caregiver_address2", "caregiver_city", "caregiver_stateid", "caregiver_zipcode",
    "caregiver_email", "caregiver_phone", "child_first_name", "child_last_name",
    "message_to_child", "parent_nickname",
)

NORMALIZED: dict[str, tuple[str, ...]] = {
    "caregiver": (
        "caregiverid", "caregiver_first_name", "caregiver_last_name", "caregiver_address1",
        "caregiver_address2", "caregiver_city", "caregiver_stateid", "caregiver_zipcode",
        "caregiver_email", "caregiver_phone", "program_year",
    ),
    "children": ("childid", "child_first_name", "child_last_name", "program_year"),
    "inmate": ("inmateid", "prisonid", "inmate_first_name", "inmate_last_name", "program_year"),
    "caregiver_to_children": (
        "caregiverid", "caregiver_first_name", "caregiver_last_name", "childid",
        "child_first_name", "child_last_name", "program_year",
    ),
    "children_to_inmate": (
        "childid", "child_first_name", "child_last_name", "inmateid", "inmate_first_name",
        "inmate_last_name", "message_to_child", "parent_nickname", "program_year",
    ),
}

NORMALIZED_ORDER: dict[str, tuple[str, ...]] = {
    "caregiver_to_children": ("childid", "child_first_name", "child_last_name"),
}

DUPLICATE_CHECKS: dict[str, tuple[tuple[str, ...], str]] = {
    "caregivers": (("caregiverid", "caregiver_first_name", "caregiver_last_name"), "caregiverid"),
    "children": (("childid", "child_first_name", "child_last_name"), "childid"),
}

# Dataset names of the stage outputs.
JOIN_TABLE = "warehouse_db_join"
FLAT_TABLE = "warehouse_db_final"
NORMALIZED_TABLE = "warehouse_db_normalized_{}"

# --------------------------------------------------------------------------


def chain_columns(specs: Sequence[TableSpec] = WAREHOUSE_SOURCES,
                  base: str = WAREHOUSE_BASE,
                  steps: Sequence[JoinStep] = WAREHOUSE_CHAIN) -> list[str]:
    """Output column order of the chain, from the specs alone."""
    return chain_output_columns({s.name: s.output_columns for s in specs}, base, steps)


Reader = Callable[[TableSpec], DataFrame]


def extract(spark: SparkSession, specs: Iterable[TableSpec], reader: Reader,
            out_root: str, concurrent_jobs: int = 4) -> dict[str, DataFrame]:
    """Read every spec through ``reader``, write it, return the read-back tables.

    ``reader(spec)`` returns the spec's rows (e.g. ``jdbc_reader`` pushes the
    spec into the database query; for a DataFrame source use ``spec.apply``).
    The tables are independent, so up to ``concurrent_jobs`` of them are
    extracted at once, each as its own Spark job: a small dimension read by a
    single task no longer leaves the rest of the cluster waiting.
    """
    def one(spec: TableSpec) -> tuple[str, DataFrame]:
        df = reader(spec).select(*spec.output_columns)
        return spec.name, materialize(spark, df, f"{out_root}/{spec.name}")

    return dict(_at_once(one, list(specs), concurrent_jobs))


def _at_once(f: Callable, items: Sequence, concurrent_jobs: int) -> list:
    with ThreadPoolExecutor(max_workers=max(1, min(concurrent_jobs, len(items) or 1))) as pool:
        return list(pool.map(f, items))


#: The fingerprint of the source a spec is read from (``files_fingerprint`` of its files, the name of a
#: database snapshot); None if nothing is known of it.
Sources = Callable[[TableSpec], "str | None"]


def extract_stages(ledger: Ledger, specs: Iterable[TableSpec], reader: Reader, sources: Sources | None = None,
                   concurrent_jobs: int = 4, buckets: Mapping[str, Buckets] | None = None) -> dict[str, Version]:
    """``extract`` as stages of a ledger: a table whose source and spec are unchanged is not read again.

    ``buckets`` names tables whose rows are dealt to files by the hash of a column.
    """
    def one(spec: TableSpec) -> tuple[str, Version]:
        return spec.name, ledger.stage(f"extract/{spec.name}", [repr(spec), sources(spec) if sources else None],
                                       lambda: reader(spec).select(*spec.output_columns),
                                       buckets=(buckets or {}).get(spec.name))

    return dict(_at_once(one, list(specs), concurrent_jobs))


#: Large source tables and the column their extraction is split on.
FACT_SPLITS = {"orgprgchdj": "applicationid", "inmapp": "applicationid", "inmappchdj": "applicationid"}

#: Settings that the jobs' plans rely on at scale (see ``lodestar.session``).
EXPECTED_SETTINGS = {"spark.sql.adaptive.enabled": "true",
                     "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
                     "spark.sql.requireAllClusterKeysForCoPartition": "false"}

#: The last join that can repeat rows of the chain by more than a dimension does.
WAREHOUSE_SET_FROM = "inmappchdj"


def denormalize(tables: Mapping[str, DataFrame], base: str = WAREHOUSE_BASE,
                steps: Sequence[JoinStep] = WAREHOUSE_CHAIN, **kw) -> DataFrame:
    """The join chain with set semantics (flagship).

    The rows become a set after the child fact table is joined, when the frame
    is keys and two texts; the dimensions after it are deduplicated at their
    own size, so the wide frame needs no distinct. With the tables' ``sizes`` the
    chain is built without a job.
    """
    if any(s.table == WAREHOUSE_SET_FROM for s in steps):
        kw.setdefault("unique_from", WAREHOUSE_SET_FROM)
    return join_chain(tables, base, steps, **kw)


def version_sizes(spark: SparkSession, made: Mapping[str, Version]) -> Sizes:
    """Sizes of published tables, from their footers."""
    return sizes_of({name: lambda v=v: folder_size(spark, v.folder, v.schema) for name, v in made.items()})


def select_total(joined: DataFrame) -> DataFrame:
    """Flat projection; duplicates are kept."""
    return joined.select(*FLAT_COLUMNS)


def filter_year(df: DataFrame, year: int = DEFAULT_YEAR) -> DataFrame:
    """Rows of one program year."""
    return df.where(F.col("program_year") == F.lit(year))


def normalize(joined: DataFrame, entity: str, year: int = DEFAULT_YEAR,
              sort: bool = True) -> DataFrame:
    """Distinct entity / relationship rows of one program year."""
    out = filter_year(joined, year).select(*NORMALIZED[entity]).distinct()
    order = NORMALIZED_ORDER.get(entity)
    if sort and order:
        out = sort_rows(out, order)
    return out


def duplicates(df: DataFrame, check: str, year: int = DEFAULT_YEAR) -> DataFrame:
    """id+name groups of one year with more than one row.

    The grouping includes the id, so this reports ids that occur in several
    relationship rows, not different ids sharing a name.
    """
    keys, count_of = DUPLICATE_CHECKS[check]
    return having_more_than(group_count(filter_year(df, year), keys, count_of))


def check_duplicates(caregiver_to_children: DataFrame,
                     year: int = DEFAULT_YEAR) -> dict[str, DataFrame]:
    """Duplicate reports; logs whether each found anything (no rows are logged)."""
    reports = {name: duplicates(caregiver_to_children, name, year) for name in DUPLICATE_CHECKS}
    for name, rep in reports.items():
        if is_empty(rep):
            log.info("no duplicate %s found", name)
        else:
            log.warning("duplicate %s found", name)
    return reports


def export_csv(flat: DataFrame, path: str, row_index: str | None = None) -> str:
    """J11; ``row_index`` adds a leading global row number (see ``write_csv``)."""
    return write_csv(flat, path, row_index)


def read_joined(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read the wide table back with its own schema and column order.

    The year partition column comes back last from the folder names; the
    declared schema keeps its type and the select restores the order.
    """
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def check_settings(spark: SparkSession) -> list[str]:
    """Settings that differ from ``EXPECTED_SETTINGS``; each is logged. Results do not depend on them."""
    off = [k for k, v in EXPECTED_SETTINGS.items() if str(spark.conf.get(k)).lower() != v]
    for k in off:
        log.warning("%s is %s; the join plans expect %s", k, spark.conf.get(k), EXPECTED_SETTINGS[k])
    return off


def run_pipeline(spark: SparkSession, reader: Reader, root: str,
                 specs: Sequence[TableSpec] = WAREHOUSE_SOURCES,
                 year: int = DEFAULT_YEAR, concurrent_jobs: int = 4, resume: bool = False,
                 sources: Sources | None = None, fact_buckets: int | None = None) -> dict[str, str]:
    """Extract -> join -> flat selection -> normalized tables, via parquet.

    Every output replaces its dataset ``root/<name>`` in one step when it is
    complete. With ``resume`` the stages that are finished, and whose sources
    (``sources``) and settings are those of the finished run, are not run again.
    ``fact_buckets`` writes the three fact tables in so many buckets of their common key,
    so that the join, and every later join of these tables, does not shuffle them.
    Returns the folder of the current version of every output; ``read_published`` reads a
    dataset by its name.
    """
    check_settings(spark)
    ledger = Ledger(spark, root, resume)
    buckets = {t: Buckets(c, fact_buckets) for t, c in FACT_SPLITS.items()} if fact_buckets else None
    extracted = extract_stages(ledger, specs, reader, sources, concurrent_jobs, buckets)
    tables = {name: v.read(spark) for name, v in extracted.items()}
    join = ledger.stage(JOIN_TABLE, [WAREHOUSE_BASE, repr(WAREHOUSE_CHAIN),
                                     *[extracted[name].fingerprint for name in sorted(extracted)]],
                        lambda: denormalize(tables, sizes=version_sizes(spark, extracted)), ("program_year",))
    joined = join.read(spark)

    # The flat and normalized tables only read the written wide table: publish
    # them as concurrent jobs.
    outputs = {FLAT_TABLE: (FLAT_COLUMNS, lambda: select_total(joined))}
    for entity in NORMALIZED:
        outputs[NORMALIZED_TABLE.format(entity)] = (
            (NORMALIZED[entity], NORMALIZED_ORDER.get(entity), year), lambda e=entity: normalize(joined, e, year))
    done = _at_once(lambda kv: (kv[0], ledger.stage(kv[0], [kv[1][0], join.fingerprint], kv[1][1])),
                    list(outputs.items()), concurrent_jobs)
    return {name: v.folder for name, v in {**extracted, JOIN_TABLE: join, **dict(done)}.items()}
