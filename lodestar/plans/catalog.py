"""Registered queries over the benchmark tables, with their DuckDB oracles.

Each query takes ``(spark, sf_dir)``, derives the warehouse / survey tables
from the whole benchmark tables (``plans.fixtures``) and runs one operator or
job of the library on them. ``ORACLES`` holds, per query, an independent SQL
statement over the same benchmark tables; the warehouse and survey tables are
inlined as ``WITH`` views written out by hand in ``FIXTURE_SQL``.

Queries that run a pipeline write their stages under a fresh folder in the
session's checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions.ids import ID_PATTERN, assign_ids, unique_counts
from lodestar.operators.aggregate import distinct_rows, group_count
from lodestar.operators.joins import JoinStep, join_chain, left_join
from lodestar.operators.projection import cast_keys, select_by_pattern, select_columns
from lodestar.plans import survey as S
from lodestar.plans import warehouse as W
from lodestar.plans.fixtures import FIXTURE_SURVEY_DIMS, FIXTURE_WAREHOUSE, Fixtures
from lodestar.sources.files import (
    ensure_checkpoint_dir,
    materialize,
    new_stage_root,
    read_csv,
    write_csv,
)
from lodestar.sources.split_csv import read_split_csv
from lodestar.streaming.uploads import ingest_uploads

Query = Callable[[SparkSession, str], DataFrame]

# --------------------------------------------------------------------------
# shared building blocks


def _stage_root(spark: SparkSession, label: str) -> str:
    ensure_checkpoint_dir(spark)
    return new_stage_root(spark, label)


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixtures(spark, sf_dir)
    return W.denormalize(fx.tables(), sizes=fx.sizes())


def _survey_answers(fx: Fixtures) -> DataFrame:
    """The materialized survey with the order key standing in for the random id."""
    return select_by_pattern(fx.table("survey_wide"), leading=(S.ID_COL, S.FACILITY_NAME))


def _survey_tables(fx: Fixtures) -> dict[str, DataFrame]:
    return {S.SURVEY_BASE: _survey_answers(fx),
            "correction_sites": fx.table("correction_sites"), "survey": fx.table("survey")}


def _write_survey_csv(spark: SparkSession, fx: Fixtures, root: str) -> str:
    return write_csv(fx.survey_csv_frame(), f"{root}/pca_input_data")


# --------------------------------------------------------------------------
# queries


def q_scan_project(spark, sf_dir):
    li = Fixtures(spark, sf_dir).base("lineitem")
    return select_columns(li, ["l_orderkey", "l_partkey", "l_returnflag", "l_linestatus"])


def q_source_project_cast(spark, sf_dir):
    return Fixtures(spark, sf_dir).table("inmappchdj")


def q_select_by_pattern(spark, sf_dir):
    wide = Fixtures(spark, sf_dir).table("survey_wide")
    return select_by_pattern(wide, leading=(S.ID_COL, S.FACILITY_NAME))


def q_cast_keys(spark, sf_dir):
    li = Fixtures(spark, sf_dir).base("lineitem")
    df = li.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    return cast_keys(df, ["l_orderkey", "l_partkey", "l_suppkey"])


def q_filter_source_status(spark, sf_dir):
    return Fixtures(spark, sf_dir).table("inmapp")


def q_filter_year(spark, sf_dir):
    return W.filter_year(_joined(spark, sf_dir))


def _pair(spark, sf_dir, left: str, step: JoinStep) -> DataFrame:
    fx = Fixtures(spark, sf_dir)
    return join_chain({left: fx.table(left), step.table: fx.table(step.table)}, left, [step], sizes=fx.sizes())


def q_join_inner_single(spark, sf_dir):
    return _pair(spark, sf_dir, "orgprgchdj", JoinStep("inmapp", ("applicationid",)))


def q_join_inner_composite(spark, sf_dir):
    return _pair(spark, sf_dir, "orgprgchdj", JoinStep("inmappchdj", ("childid", "applicationid")))


def q_join_left_outer(spark, sf_dir):
    return _pair(spark, sf_dir, "inmapp", JoinStep("crg", ("caregiverid",), "left"))


def q_join_left_filtered_right(spark, sf_dir):
    return _pair(spark, sf_dir, "inmappchdj", JoinStep("chd", ("childid",), "left"))


def q_join_existence(spark, sf_dir):
    return _pair(spark, sf_dir, "orgprg", JoinStep("prsprg", ("programid",)))


def q_distinct_rows(spark, sf_dir):
    wide = Fixtures(spark, sf_dir).table("survey_wide")
    return distinct_rows(wide.select("facility_name", "pca_1", "pca_2"))


def q_group_count(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    bag = left_join(fx.table("inmapp"), fx.table("crg"), ["caregiverid"])
    return group_count(bag, ["caregiver_last_name"], "caregiver_first_name")


def q_id_uniqueness(spark, sf_dir):
    rows = assign_ids(Fixtures(spark, sf_dir).survey_csv_frame(), S.ID_COL)
    counts = unique_counts(materialize(spark, rows, f"{_stage_root(spark, 'ids')}/rows"), S.ID_COL)
    return spark.createDataFrame([counts], "n_rows long, n_distinct long")


def q_denormalized_join(spark, sf_dir):
    return _joined(spark, sf_dir)


def q_selection_total(spark, sf_dir):
    return W.select_total(_joined(spark, sf_dir))


def _normalized(entity: str) -> Query:
    def q(spark, sf_dir):
        return W.normalize(_joined(spark, sf_dir), entity)
    q.__name__ = f"q_normalized_{entity}"
    return q


def _duplicates(check: str) -> Query:
    def q(spark, sf_dir):
        c2c = W.normalize(_joined(spark, sf_dir), "caregiver_to_children")
        return W.duplicates(c2c, check)
    q.__name__ = f"q_duplicate_{check}"
    return q


def q_parquet_roundtrip(spark, sf_dir):
    root = _stage_root(spark, "roundtrip")
    return materialize(spark, Fixtures(spark, sf_dir).table("inmappchdj"), f"{root}/inmappchdj")


def q_csv_export(spark, sf_dir):
    root = _stage_root(spark, "csv-export")
    flat = W.select_total(_joined(spark, sf_dir))
    path = W.export_csv(flat, f"{root}/df_final")
    return read_csv(spark, path, schema=flat.schema)


def q_csv_ingest(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    root = _stage_root(spark, "csv-ingest")
    csv_path = _write_survey_csv(spark, fx, root)
    out = S.ingest(spark, csv_path, f"{root}/{S.INPUT_TABLE}")
    return out.drop(S.ID_COL)


def q_survey_upload_stream(spark, sf_dir):
    """The uploaded survey CSV, split into several files, ingested by the streaming pick-up."""
    fx = Fixtures(spark, sf_dir)
    root = _stage_root(spark, "uploads")
    write_csv(fx.survey_csv_frame().repartition(4), f"{root}/upload")
    out = ingest_uploads(spark, f"{root}/upload", f"{root}/{S.INPUT_TABLE}",
                         checkpoint=f"{root}/checkpoint", files_per_batch=2)
    return out.drop(S.ID_COL)


def q_survey_upload_ids(spark, sf_dir):
    """Reproducible ids of the pick-up, whose batches bring the rows in file order, against those of one batch job."""
    fx = Fixtures(spark, sf_dir)
    root = _stage_root(spark, "upload-ids")
    write_csv(fx.survey_csv_frame().select(S.FACILITY_COL, "pca_1", "pca_2").repartition(4), f"{root}/upload")
    out = ingest_uploads(spark, f"{root}/upload", f"{root}/{S.INPUT_TABLE}", checkpoint=f"{root}/checkpoint",
                         files_per_batch=2, id_mode="hash")
    one = S.ingest(spark, f"{root}/upload", f"{root}/one", id_mode="hash").select(
        S.ID_COL, F.struct(S.FACILITY_NAME, "pca_1", "pca_2").alias("other"))
    same = F.struct(S.FACILITY_NAME, "pca_1", "pca_2").eqNullSafe(F.col("other"))
    return out.join(one, S.ID_COL, "left").select(S.FACILITY_NAME, "pca_1", "pca_2", same.alias("is_reproduced"))


def q_assign_ids(spark, sf_dir):
    """Random ids on the written rows: their form, and whether each is the only one of its kind."""
    root = _stage_root(spark, "ids")
    rows = materialize(spark, S.prepare(Fixtures(spark, sf_dir).survey_csv_frame()), f"{root}/ids")
    often = rows.groupBy(S.ID_COL).agg(F.count("*").alias("times"))
    rows = rows.join(often, S.ID_COL)
    return rows.select(S.FACILITY_NAME, "pca_1", "pca_2", "pca_10",
                       F.length(S.ID_COL).alias("id_length"),
                       F.col(S.ID_COL).rlike(ID_PATTERN).alias("is_v4"),
                       (F.col("times") == 1).alias("is_unique"))


def q_assign_hash_ids(spark, sf_dir):
    """Hash ids on two writes of the same rows in different partitionings: equal ids, row by row."""
    root = _stage_root(spark, "hash-ids")
    frame = Fixtures(spark, sf_dir).survey_csv_frame()
    ids = []
    for name, df in (("a", frame), ("b", frame.repartition(7))):
        written = materialize(spark, df, f"{root}/rows-{name}")
        ids.append(materialize(spark, S.prepare(written, id_mode="hash"), f"{root}/ids-{name}"))
    other = ids[1].select(S.ID_COL, F.struct(S.FACILITY_NAME, "pca_1", "pca_2", "pca_10").alias("other"))
    both = ids[0].join(other, S.ID_COL, "left")
    same = F.struct(S.FACILITY_NAME, "pca_1", "pca_2", "pca_10").eqNullSafe(F.col("other"))
    return both.select(S.FACILITY_NAME, "pca_1", "pca_2", "pca_10", same.alias("is_reproduced"))


def _write_quoted_csv(spark, sf_dir, root: str) -> str:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    quoted = F.concat(F.lit('a "quoted", line\n'), F.col("text"))
    raw = docs.select(F.col("source").alias(S.FACILITY_COL), quoted.alias("comment"),
                      F.col("doc_id").alias("pca_1"), F.col("n_chars").alias("pca_2"))
    return write_csv(raw, f"{root}/pca_input_data")


def q_csv_ingest_quoted(spark, sf_dir):
    """A survey file with an ignored text column full of commas, quotes and line breaks."""
    root = _stage_root(spark, "csv-quoted")
    path = _write_quoted_csv(spark, sf_dir, root)
    return S.ingest(spark, path, f"{root}/{S.INPUT_TABLE}").drop(S.ID_COL)


def q_csv_ingest_split(spark, sf_dir):
    """The same file cut into byte ranges of 1 MB, each read by its own task; the quoted text is kept and hashed."""
    root = _stage_root(spark, "csv-split")
    path = _write_quoted_csv(spark, sf_dir, root)
    rows = read_split_csv(spark, path, f"{S.FACILITY_COL} string, comment string, pca_1 int, pca_2 int",
                          f"{root}/stages", range_bytes=1 << 20)
    return rows.select(F.col(S.FACILITY_COL).alias(S.FACILITY_NAME), F.sha2("comment", 256).alias("comment_sha256"),
                       "pca_1", "pca_2")


def q_csv_ingest_headers(spark, sf_dir):
    """Survey files with other column orders and without an answer column, united by name into one table."""
    root = _stage_root(spark, "csv-headers")
    frame = Fixtures(spark, sf_dir).survey_csv_frame()
    turned = [c for c in reversed(frame.columns) if c != S.FACILITY_COL] + [S.FACILITY_COL]
    for k, columns in enumerate((frame.columns, turned, [c for c in turned if c != "pca_2"])):
        write_csv(frame.where(F.col("pca_10") % 3 == k).select(*columns), f"{root}/uploads/part={k}")
    out = S.ingest(spark, f"{root}/uploads/*", f"{root}/{S.INPUT_TABLE}", split=True)
    return out.select(S.FACILITY_NAME, "pca_1", "pca_2", "pca_10")


def q_csv_export_blanks(spark, sf_dir):
    """Values with blanks, quotes and line breaks through the CSV export and back."""
    root = _stage_root(spark, "csv-blanks")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.select("doc_id", F.concat(F.lit("  "), "source", F.lit(" ")).alias("source"),
                       F.concat(F.lit("\t"), "text", F.lit(" q, ")).alias("text"))
    return read_csv(spark, W.export_csv(rows, f"{root}/rows"), schema=rows.schema)


def q_survey_join(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return S.survey_join(_survey_tables(fx), sizes=fx.sizes())


def q_survey_melt(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    return S.melt_of_tables(_survey_tables(fx), sizes=fx.sizes())


def q_warehouse_pipeline(spark, sf_dir):
    """Every published table: its name, row count, and a checksum of the keys in it."""
    fx = Fixtures(spark, sf_dir)
    root = _stage_root(spark, "warehouse")
    paths = W.run_pipeline(spark, fx.read_spec, root, specs=FIXTURE_WAREHOUSE)
    published = [(W.FLAT_TABLE, F.length("child_first_name"))] + [
        (W.NORMALIZED_TABLE.format(entity), F.col(key)) for entity, key in _ENTITY_KEYS.items()]
    parts = [spark.read.parquet(paths[name]).agg(
        F.lit(name).alias("table_name"), F.count("*").alias("n_rows"),
        F.sum(key.cast("long")).alias("key_sum")) for name, key in published]
    return reduce(DataFrame.unionAll, parts)


def q_survey_pipeline(spark, sf_dir):
    """One line per participant, the sorted surveys, items and responses; then the random id goes."""
    fx = Fixtures(spark, sf_dir)
    root = _stage_root(spark, "survey")
    csv_path = _write_survey_csv(spark, fx, root)
    paths = S.run_pipeline(spark, csv_path, fx.read_spec, root, dims=FIXTURE_SURVEY_DIMS)
    long = spark.read.parquet(paths[S.FINAL_TABLE])
    line = F.concat_ws(":", "survey_id", S.ITEM_COL, S.RESPONSE_COL)
    return (long.groupBy(S.ID_COL).agg(F.array_join(F.array_sort(F.collect_list(line)), " ")
                                       .alias("answers")).select("answers"))


QUERIES: dict[str, Query] = {
    "scan_project": q_scan_project,
    "source_project_cast": q_source_project_cast,
    "select_by_pattern": q_select_by_pattern,
    "cast_keys": q_cast_keys,
    "filter_source_status": q_filter_source_status,
    "filter_year": q_filter_year,
    "join_inner_single": q_join_inner_single,
    "join_inner_composite": q_join_inner_composite,
    "join_left_outer": q_join_left_outer,
    "join_left_filtered_right": q_join_left_filtered_right,
    "join_existence": q_join_existence,
    "distinct_rows": q_distinct_rows,
    "group_count": q_group_count,
    "id_uniqueness": q_id_uniqueness,
    "denormalized_join": q_denormalized_join,
    "selection_total": q_selection_total,
    "normalized_caregiver": _normalized("caregiver"),
    "normalized_children": _normalized("children"),
    "normalized_inmate": _normalized("inmate"),
    "caregiver_to_children": _normalized("caregiver_to_children"),
    "children_to_inmate": _normalized("children_to_inmate"),
    "duplicate_caregivers": _duplicates("caregivers"),
    "duplicate_children": _duplicates("children"),
    "parquet_roundtrip": q_parquet_roundtrip,
    "csv_export": q_csv_export,
    "csv_ingest": q_csv_ingest,
    "survey_upload_stream": q_survey_upload_stream,
    "survey_upload_ids": q_survey_upload_ids,
    "assign_ids": q_assign_ids,
    "assign_hash_ids": q_assign_hash_ids,
    "csv_ingest_quoted": q_csv_ingest_quoted,
    "csv_ingest_split": q_csv_ingest_split,
    "csv_ingest_headers": q_csv_ingest_headers,
    "csv_export_blanks": q_csv_export_blanks,
    "survey_join": q_survey_join,
    "survey_melt": q_survey_melt,
    "warehouse_pipeline": q_warehouse_pipeline,
    "survey_pipeline": q_survey_pipeline,
}

# --------------------------------------------------------------------------
# DuckDB oracles. The views restate plans.fixtures in SQL.

FIXTURE_SQL: dict[str, str] = {
    "org": "SELECT CAST(r_regionkey AS INT) AS orgid FROM region WHERE r_regionkey = 1",
    "orgprg": "SELECT CAST(n_regionkey AS INT) AS orgid, CAST(n_nationkey AS INT) AS programid, "
              "CAST(n_nationkey + 100 AS INT) AS orgprogramid FROM nation",
    "prg": "SELECT CAST(n_nationkey AS INT) AS programid, "
           "CAST(2022 + n_nationkey % 2 AS INT) AS program_year FROM nation",
    "prsprg": "SELECT CAST(s_nationkey AS INT) AS programid FROM supplier",
    "orgprgchdj": "SELECT CAST(c_nationkey + 100 AS INT) AS orgprogramid, "
                  "CAST(l_orderkey AS INT) AS applicationid, CAST(l_partkey AS INT) AS childid "
                  "FROM lineitem JOIN orders ON o_orderkey = l_orderkey "
                  "JOIN customer ON c_custkey = o_custkey",
    "inmapp": "SELECT CAST(o_orderkey AS INT) AS applicationid, "
              "CAST(CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS INT) AS caregiverid, "
              "CAST(o_orderkey % 10 AS INT) AS inmateid FROM orders WHERE o_orderstatus = 'F'",
    "inmappchdj": "SELECT CAST(l_orderkey AS INT) AS applicationid, CAST(l_partkey AS INT) AS childid, "
                  "l_linestatus AS message_to_child, l_returnflag AS parent_nickname "
                  "FROM lineitem WHERE l_returnflag <> 'N'",
    "inm": "SELECT CAST(s_suppkey AS INT) AS inmateid, CAST(s_nationkey AS INT) AS prisonid, "
           "s_name AS inmate_first_name, CAST(s_nationkey AS VARCHAR) AS inmate_last_name FROM supplier",
    "prs": "SELECT CAST(n_nationkey AS INT) AS prisonid FROM nation",
    "crg": "SELECT CAST(c_custkey AS INT) AS caregiverid, CAST(c_nationkey AS INT) AS addressid, "
           "CAST(CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_custkey END AS INT) AS contactid, "
           "c_name AS caregiver_first_name, c_mktsegment AS caregiver_last_name FROM customer",
    "adrcrg": "SELECT CAST(n_nationkey AS INT) AS addressid, n_name AS caregiver_address1, "
              "CAST(NULL AS VARCHAR) AS caregiver_address2, n_name AS caregiver_city, "
              "CAST(n_regionkey AS VARCHAR) AS caregiver_stateid, "
              "CAST(n_nationkey AS VARCHAR) AS caregiver_zipcode FROM nation",
    "cntcrg": "SELECT CAST(c_custkey AS INT) AS contactid, c_name AS caregiver_email, "
              "CAST(c_custkey AS VARCHAR) AS caregiver_phone FROM customer",
    "chd": "SELECT CAST(p_partkey AS INT) AS childid, p_name AS child_first_name, "
           "p_brand AS child_last_name FROM part WHERE p_size < 25",
    "survey_wide": "SELECT CAST(o_orderkey AS VARCHAR) AS participant_id, n_name AS facility_name, "
                   "CAST(CASE WHEN o_orderstatus <> 'P' THEN o_orderkey % 5 + 1 END AS INT) AS pca_1, "
                   "CAST(CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey % 5 + 1 END AS INT) AS pca_2, "
                   "CAST((o_orderkey + o_custkey) % 5 + 1 AS INT) AS pca_10, "
                   "o_totalprice AS pca_total, o_orderpriority AS xpca_3 "
                   "FROM orders JOIN customer ON o_custkey = c_custkey "
                   "JOIN nation ON c_nationkey = n_nationkey",
    "correction_sites": "SELECT n_name AS facility_name, CAST(n_nationkey AS INT) AS facility_id "
                        "FROM nation WHERE n_regionkey <> 4",
    "survey": "SELECT CAST(s_nationkey AS INT) AS facility_id, CAST(s_suppkey % 4 AS INT) AS survey_id "
              "FROM supplier",
}

# The chain as the original jobs run it: a distinct after every join.
# The reference order of the joins.
_CHAIN_SQL = {
    "j1": "SELECT DISTINCT * FROM org JOIN orgprg USING (orgid)",
    "j2": "SELECT DISTINCT * FROM j1 JOIN prg USING (programid)",
    "j3": "SELECT DISTINCT * FROM j2 JOIN prsprg USING (programid)",
    "j4": "SELECT DISTINCT * FROM j3 JOIN orgprgchdj USING (orgprogramid)",
    "j5": "SELECT DISTINCT * FROM j4 JOIN inmapp USING (applicationid)",
    "j6": "SELECT DISTINCT * FROM j5 JOIN inmappchdj USING (childid, applicationid)",
    "j7": "SELECT DISTINCT * FROM j6 JOIN inm USING (inmateid)",
    "j8": "SELECT DISTINCT * FROM j7 JOIN prs USING (prisonid)",
    "j9": "SELECT DISTINCT * FROM j8 LEFT JOIN crg USING (caregiverid)",
    "j10": "SELECT DISTINCT * FROM j9 LEFT JOIN adrcrg USING (addressid)",
    "j11": "SELECT DISTINCT * FROM j10 LEFT JOIN cntcrg USING (contactid)",
    "joined": "SELECT DISTINCT * FROM j11 LEFT JOIN chd USING (childid)",
}

_SURVEY_SQL = {
    "answers": "SELECT participant_id, facility_name, pca_1, pca_2, pca_10 FROM survey_wide",
    "s1": "SELECT DISTINCT * FROM answers JOIN correction_sites USING (facility_name)",
    "survey_joined": "SELECT DISTINCT * FROM s1 JOIN survey USING (facility_id)",
    "survey_long": "SELECT participant_id, survey_id, 'pca_1' AS item_id, pca_1 AS response "
                   "FROM survey_joined WHERE pca_1 IS NOT NULL UNION ALL "
                   "SELECT participant_id, survey_id, 'pca_2', pca_2 "
                   "FROM survey_joined WHERE pca_2 IS NOT NULL UNION ALL "
                   "SELECT participant_id, survey_id, 'pca_10', pca_10 "
                   "FROM survey_joined WHERE pca_10 IS NOT NULL",
}


def _with(body: str, *names: str) -> str:
    """Prefix ``body`` with the named views (and the views they need) as a WITH clause."""
    views = {**FIXTURE_SQL, **_CHAIN_SQL, **_SURVEY_SQL}
    order = [*FIXTURE_SQL, *_CHAIN_SQL, *_SURVEY_SQL]
    needed: set[str] = set()

    def need(n: str) -> None:
        if n in needed:
            return
        needed.add(n)
        for other in views:
            if other != n and _mentions(views[n], other):
                need(other)

    for n in names:
        need(n)
    ctes = ", ".join(f"{n} AS ({views[n]})" for n in order if n in needed)
    return f"WITH {ctes} {body}"


def _mentions(sql: str, name: str) -> bool:
    import re
    return re.search(rf"\b(FROM|JOIN)\s+{re.escape(name)}\b", sql) is not None


# The columns of the published tables and a key of each.
_ENTITY_KEYS = {"caregiver": "caregiverid", "children": "childid", "inmate": "inmateid",
                "caregiver_to_children": "childid", "children_to_inmate": "inmateid"}
_C2I = ("childid, child_first_name, child_last_name, inmateid, inmate_first_name, "
        "inmate_last_name, message_to_child, parent_nickname, program_year")
_C2C = ("caregiverid, caregiver_first_name, caregiver_last_name, childid, child_first_name, "
        "child_last_name, program_year")
_ENTITY_SQL = {
    "caregiver": "caregiverid, caregiver_first_name, caregiver_last_name, caregiver_address1, "
                 "caregiver_address2, caregiver_city, caregiver_stateid, caregiver_zipcode, "
                 "caregiver_email, caregiver_phone, program_year",
    "children": "childid, child_first_name, child_last_name, program_year",
    "inmate": "inmateid, prisonid, inmate_first_name, inmate_last_name, program_year",
    "caregiver_to_children": _C2C, "children_to_inmate": _C2I,
}
_FLAT = ", ".join(W.FLAT_COLUMNS)
_FLAT_NULLIF = ", ".join(f"NULLIF({c}, '') AS {c}" for c in W.FLAT_COLUMNS)

ORACLES: dict[str, str] = {
    "scan_project": "SELECT l_orderkey, l_partkey, l_returnflag, l_linestatus FROM lineitem",
    "source_project_cast": _with("SELECT * FROM inmappchdj", "inmappchdj"),
    "select_by_pattern": _with(
        "SELECT participant_id, facility_name, pca_1, pca_2, pca_10 FROM survey_wide", "survey_wide"),
    "cast_keys": "SELECT CAST(l_orderkey AS INT) AS l_orderkey, CAST(l_partkey AS INT) AS l_partkey, "
                 "CAST(l_suppkey AS INT) AS l_suppkey, l_linenumber FROM lineitem",
    "filter_source_status": _with("SELECT * FROM inmapp", "inmapp"),
    "filter_year": _with("SELECT * FROM joined WHERE program_year = 2023", "joined"),
    "join_inner_single": _with(
        "SELECT DISTINCT * FROM orgprgchdj JOIN inmapp USING (applicationid)",
        "orgprgchdj", "inmapp"),
    "join_inner_composite": _with(
        "SELECT DISTINCT * FROM orgprgchdj JOIN inmappchdj USING (childid, applicationid)",
        "orgprgchdj", "inmappchdj"),
    "join_left_outer": _with(
        "SELECT DISTINCT * FROM inmapp LEFT JOIN crg USING (caregiverid)", "inmapp", "crg"),
    "join_left_filtered_right": _with(
        "SELECT DISTINCT * FROM inmappchdj LEFT JOIN chd USING (childid)", "inmappchdj", "chd"),
    "join_existence": _with(
        "SELECT DISTINCT * FROM orgprg JOIN prsprg USING (programid)", "orgprg", "prsprg"),
    "distinct_rows": _with(
        "SELECT DISTINCT facility_name, pca_1, pca_2 FROM survey_wide", "survey_wide"),
    "group_count": _with(
        "SELECT caregiver_last_name, count(caregiver_first_name) AS \"count\" "
        "FROM inmapp LEFT JOIN crg USING (caregiverid) GROUP BY caregiver_last_name",
        "inmapp", "crg"),
    "id_uniqueness": _with(
        "SELECT count(*) AS n_rows, count(DISTINCT participant_id) AS n_distinct FROM survey_wide",
        "survey_wide"),
    "denormalized_join": _with("SELECT * FROM joined", "joined"),
    "selection_total": _with(f"SELECT {_FLAT} FROM joined", "joined"),
    "normalized_caregiver": _with(
        "SELECT DISTINCT caregiverid, caregiver_first_name, caregiver_last_name, caregiver_address1, "
        "caregiver_address2, caregiver_city, caregiver_stateid, caregiver_zipcode, caregiver_email, "
        "caregiver_phone, program_year FROM joined WHERE program_year = 2023", "joined"),
    "normalized_children": _with(
        "SELECT DISTINCT childid, child_first_name, child_last_name, program_year "
        "FROM joined WHERE program_year = 2023", "joined"),
    "normalized_inmate": _with(
        "SELECT DISTINCT inmateid, prisonid, inmate_first_name, inmate_last_name, program_year "
        "FROM joined WHERE program_year = 2023", "joined"),
    "caregiver_to_children": _with(
        f"SELECT DISTINCT {_C2C} FROM joined WHERE program_year = 2023 "
        "ORDER BY childid, child_first_name, child_last_name", "joined"),
    "children_to_inmate": _with(
        f"SELECT DISTINCT {_C2I} FROM joined WHERE program_year = 2023", "joined"),
    "duplicate_caregivers": _with(
        "SELECT caregiverid, caregiver_first_name, caregiver_last_name, "
        "count(caregiverid) AS \"count\" "
        f"FROM (SELECT DISTINCT {_C2C} FROM joined WHERE program_year = 2023) "
        "GROUP BY caregiverid, caregiver_first_name, caregiver_last_name "
        "HAVING count(caregiverid) > 1", "joined"),
    "duplicate_children": _with(
        "SELECT childid, child_first_name, child_last_name, count(childid) AS \"count\" "
        f"FROM (SELECT DISTINCT {_C2C} FROM joined WHERE program_year = 2023) "
        "GROUP BY childid, child_first_name, child_last_name HAVING count(childid) > 1", "joined"),
    "parquet_roundtrip": _with("SELECT * FROM inmappchdj", "inmappchdj"),
    "csv_export": _with(f"SELECT {_FLAT_NULLIF} FROM joined", "joined"),
    "csv_ingest": _with("SELECT facility_name, pca_1, pca_2, pca_10 FROM survey_wide", "survey_wide"),
    "survey_upload_stream": _with(
        "SELECT facility_name, pca_1, pca_2, pca_10 FROM survey_wide", "survey_wide"),
    "survey_upload_ids": _with(
        "SELECT facility_name, pca_1, pca_2, true AS is_reproduced FROM survey_wide", "survey_wide"),
    "survey_join": _with("SELECT * FROM survey_joined", "survey_joined"),
    "survey_melt": _with("SELECT * FROM survey_long", "survey_long"),
    "warehouse_pipeline": _with(
        " UNION ALL ".join(
            [f"SELECT '{W.FLAT_TABLE}' AS table_name, count(*) AS n_rows, "
             "CAST(sum(length(child_first_name)) AS BIGINT) AS key_sum FROM joined"]
            + [f"SELECT '{W.NORMALIZED_TABLE.format(e)}', count(*), CAST(sum({k}) AS BIGINT) "
               f"FROM (SELECT DISTINCT {_ENTITY_SQL[e]} FROM joined WHERE program_year = 2023)"
               for e, k in _ENTITY_KEYS.items()]), "joined"),
    "survey_pipeline": _with(
        "SELECT string_agg(line, ' ' ORDER BY line) AS answers FROM (SELECT participant_id, "
        "survey_id || ':' || item_id || ':' || response AS line FROM survey_long) "
        "GROUP BY participant_id", "survey_long"),
    "assign_ids": _with(
        "SELECT facility_name, pca_1, pca_2, pca_10, 36 AS id_length, TRUE AS is_v4, TRUE AS is_unique "
        "FROM survey_wide", "survey_wide"),
    "assign_hash_ids": _with(
        "SELECT facility_name, pca_1, pca_2, pca_10, TRUE AS is_reproduced FROM survey_wide", "survey_wide"),
    "csv_ingest_split": "SELECT source AS facility_name, sha256('a \"quoted\", line' || chr(10) || text) AS comment_sha256, "
                        "CAST(doc_id AS INT) AS pca_1, CAST(n_chars AS INT) AS pca_2 FROM documents",
    "csv_ingest_headers": _with(
        "SELECT facility_name, pca_1, CASE WHEN pca_10 % 3 <> 2 THEN pca_2 END AS pca_2, pca_10 FROM survey_wide",
        "survey_wide"),
    "csv_ingest_quoted": "SELECT source AS facility_name, CAST(doc_id AS INT) AS pca_1, "
                         "CAST(n_chars AS INT) AS pca_2 FROM documents",
    "csv_export_blanks": "SELECT doc_id, '  ' || source || ' ' AS source, "
                         "chr(9) || text || ' q, ' AS text FROM documents",
}
