"""The warehouse and survey tables, derived from the benchmark tables.

The benchmark data (``region nation customer supplier part orders lineitem``)
has none of the warehouse or survey tables, so each one is declared as a
``TableSpec`` over a benchmark table (or a join of them) with the same output
columns and types as the real extraction. Every spec reads its whole source
table; filters stand only where the real extraction has one (``status = 1``).
Left-join keys are null on some rows, so those find no partner, and a facility
has at most four surveys, so the survey output grows with the answers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lodestar.sources.sizes import Sizes, parquet_stats, size_of, sizes_of
from lodestar.sources.specs import Col, TableSpec

BENCHMARK_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

FIXTURE_WAREHOUSE: tuple[TableSpec, ...] = (
    TableSpec("org", "region", (Col("r_regionkey", "orgid", "int"),), where="r_regionkey = 1"),
    TableSpec("orgprg", "nation",
              (Col("n_regionkey", "orgid", "int"), Col("n_nationkey", "programid", "int"),
               Col("n_nationkey + 100", "orgprogramid", "int"))),
    TableSpec("prg", "nation",
              (Col("n_nationkey", "programid", "int"),
               Col("2022 + n_nationkey % 2", "program_year", "int"))),
    TableSpec("prsprg", "supplier", (Col("s_nationkey", "programid", "int"),)),
    TableSpec("orgprgchdj", "lineitem_orders_customer",
              (Col("c_nationkey + 100", "orgprogramid", "int"),
               Col("l_orderkey", "applicationid", "int"), Col("l_partkey", "childid", "int"))),
    TableSpec("inmapp", "orders",
              (Col("o_orderkey", "applicationid", "int"),
               Col("CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END", "caregiverid", "int"),
               Col("o_orderkey % 10", "inmateid", "int")),
              where="o_orderstatus = 'F'"),
    TableSpec("inmappchdj", "lineitem",
              (Col("l_orderkey", "applicationid", "int"), Col("l_partkey", "childid", "int"),
               Col("l_linestatus", "message_to_child"), Col("l_returnflag", "parent_nickname")),
              where="l_returnflag <> 'N'"),
    TableSpec("inm", "supplier",
              (Col("s_suppkey", "inmateid", "int"), Col("s_nationkey", "prisonid", "int"),
               Col("s_name", "inmate_first_name"),
               Col("s_nationkey", "inmate_last_name", "string"))),
    TableSpec("prs", "nation", (Col("n_nationkey", "prisonid", "int"),)),
    TableSpec("crg", "customer",
              (Col("c_custkey", "caregiverid", "int"), Col("c_nationkey", "addressid", "int"),
               Col("CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_custkey END", "contactid", "int"),
               Col("c_name", "caregiver_first_name"), Col("c_mktsegment", "caregiver_last_name"))),
    TableSpec("adrcrg", "nation",
              (Col("n_nationkey", "addressid", "int"), Col("n_name", "caregiver_address1"),
               Col("NULL", "caregiver_address2", "string"), Col("n_name", "caregiver_city"),
               Col("n_regionkey", "caregiver_stateid", "string"),
               Col("n_nationkey", "caregiver_zipcode", "string"))),
    TableSpec("cntcrg", "customer",
              (Col("c_custkey", "contactid", "int"), Col("c_name", "caregiver_email"),
               Col("c_custkey", "caregiver_phone", "string"))),
    TableSpec("chd", "part",
              (Col("p_partkey", "childid", "int"), Col("p_name", "child_first_name"),
               Col("p_brand", "child_last_name")),
              where="p_size < 25"),
)

SURVEY_WIDE = TableSpec(
    "survey_wide", "orders_customer_nation",
    (Col("o_orderkey", "participant_id", "string"),
     Col("n_name", "facility_name"),
     Col("CASE WHEN o_orderstatus <> 'P' THEN o_orderkey % 5 + 1 END", "pca_1", "int"),
     Col("CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey % 5 + 1 END", "pca_2", "int"),
     Col("(o_orderkey + o_custkey) % 5 + 1", "pca_10", "int"),
     Col("o_totalprice", "pca_total"),
     Col("o_orderpriority", "xpca_3")),
)

FIXTURE_SURVEY_DIMS: tuple[TableSpec, ...] = (
    TableSpec("correction_sites", "nation",
              (Col("n_name", "facility_name"), Col("n_nationkey", "facility_id", "int")),
              where="n_regionkey <> 4"),
    TableSpec("survey", "supplier",
              (Col("s_nationkey", "facility_id", "int"), Col("s_suppkey % 4", "survey_id", "int"))),
)

ALL_FIXTURES = {s.name: s for s in (*FIXTURE_WAREHOUSE, SURVEY_WIDE, *FIXTURE_SURVEY_DIMS)}


class Fixtures:
    """Lazy access to the benchmark tables and the specs above for one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._scans: dict[str, DataFrame] = {}
        self._tables: dict[str, DataFrame] = {}
        self._sources: dict[str, Callable[[], DataFrame]] = {
            "lineitem_orders_customer": self._lineitem_orders_customer,
            "orders_customer_nation": self._orders_customer_nation,
        }

    def base(self, name: str) -> DataFrame:
        """One scan per table: later uses of this object share the frame and its file listing."""
        if name not in self._scans:
            self._scans[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._scans[name]

    def source(self, name: str) -> DataFrame:
        if name in self._sources:
            return self._sources[name]()
        return self.base(name)

    def _lineitem_orders_customer(self) -> DataFrame:
        li, o, c = self.base("lineitem"), self.base("orders"), self.base("customer")
        return (li.join(o, li.l_orderkey == o.o_orderkey)
                .join(c, o.o_custkey == c.c_custkey))

    def _orders_customer_nation(self) -> DataFrame:
        o, c, n = self.base("orders"), self.base("customer"), self.base("nation")
        return (o.join(c, o.o_custkey == c.c_custkey)
                .join(n, c.c_nationkey == n.n_nationkey))

    def read_spec(self, spec: TableSpec) -> DataFrame:
        """A ``reader`` for ``extract``: the spec applied to its benchmark source."""
        return spec.apply(self.source(spec.source))

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.read_spec(ALL_FIXTURES[name])
        return self._tables[name]

    def tables(self, names=None) -> dict[str, DataFrame]:
        names = names or [s.name for s in FIXTURE_WAREHOUSE]
        return {n: self.table(n) for n in names}

    def sizes(self) -> Sizes:
        """Upper bounds of the tables that come from one benchmark table each, from its parquet footers."""
        stats = sizes_of({t: lambda t=t: parquet_stats(self.spark, f"{self.sf_dir}/{t}.parquet") for t in BENCHMARK_TABLES})
        return sizes_of({s.name: lambda s=s: size_of(stats(s.source), self.table(s.name).schema, s)
                         for s in ALL_FIXTURES.values()})

    def survey_csv_frame(self) -> DataFrame:
        """The uploaded survey file: the wide survey without the id, facility as FACILITY."""
        wide = self.table("survey_wide")
        return wide.drop("participant_id").withColumnRenamed("facility_name", "FACILITY")
