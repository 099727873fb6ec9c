"""Mixing sources to target weights (operator 3).

Every document gets a random key by hash. Narrow (source, key, size) rows are
range-sorted by source and key, so a hot source spreads over many partitions;
per-partition totals give each partition its offset, a running sum inside the
partition does the rest, and together they are the distributed prefix sums of
the sizes. Each source is cut where the prefix sum meets its budget: whole
epochs first, then the prefix of the key order, the document at the cut in
part, so the words taken meet the budget exactly (rounded down). The cut of a
source is one key, so the decision goes back to the documents through a table of one row a
source, and no text is shuffled.

Defined cases: null and empty texts have size 0 and take 0; the null source is
a source and comes last; rows with one id share a key and are taken together
(null ids too; at the cut each in the same proportion); sources without words have target 0; an empty table gives an
empty result; other columns of the input are passed through untouched.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestar.llm._common import fresh, n_words, scratch, shuffle_partitions, small, stage, words

#: Sources up to this many rows (about 100 bytes each) are broadcast to the documents.
MAX_BROADCAST_SOURCES = 100_000


def random_key(id_col: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(id_col.cast("string"), F.lit("null"))))


def source_targets(sizes: DataFrame, weights: Sequence[float], max_epochs: int,
                   fraction: float) -> DataFrame:
    """Targets of the sources: (source, source_size, target, epochs, rem) from (source, source_size).

    Weights go to the sources in code-point order, repeating. Shares follow the
    weights, no target exceeds ``max_epochs`` times its source, and the excess
    is shared again by weight. With the sources sorted by cap per weight, the
    capped ones are a prefix, so one running sum finds the level of the rest: of
    the levels that their own source's cap allows, the first, which is the largest.
    The windows run over one row a source.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    by_ratio = Window.orderBy("ratio", F.col("source").isNull(), "source")
    everything = Window.partitionBy()
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    ws = F.array(*[F.lit(float(w)) for w in weights])
    t = (sizes
         .withColumn("w", F.element_at(ws, (F.row_number().over(by_name) - 1) % len(weights) + 1))
         .withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
         .withColumn("ratio", F.col("cap") / F.col("w"))
         .withColumn("total", F.sum("source_size").over(everything) * F.lit(float(fraction)))
         .withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
         .withColumn("left_w", F.sum("w").over(everything)
                     - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
         .withColumn("level", (F.col("total") - F.col("capped")) / F.col("left_w"))
         .withColumn("level", F.max(F.when(F.col("ratio") >= F.col("level"), F.col("level")))
                     .over(everything))
         .withColumn("target", F.least("cap", F.coalesce(F.col("level") * F.col("w"), "cap")))
         .withColumn("epochs", F.when(F.col("source_size") > 0,
                                      F.floor(F.col("target") / F.col("source_size")))
                     .otherwise(0).cast("long")))
    return t.select("source", "source_size", "target", "epochs",
                    (F.col("target") - F.col("epochs") * F.col("source_size")).alias("rem"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", weights: Sequence[float] = (5.0, 2.0, 1.0),
                max_epochs: int = 3, fraction: float = 1.0, seed: str = "mix",
                out: str = "mix") -> tuple[DataFrame, str]:
    """``docs`` with one more column, a struct (size, source_size, target, copies, part, taken), and its name.

    ``copies`` is how often the mix takes the whole document, ``part`` how many words it takes once
    more at the cut, ``taken`` the words in all.
    """
    spark = docs.sparkSession
    root = scratch(spark, "mix")
    rows = docs.select(F.col(source_col).cast("string").alias("source"),
                       random_key(F.col(id_col), seed).alias("key"),
                       n_words(F.col(text_col)).alias("size"))
    keyed = rows.groupBy("source", "key").agg(F.sum("size").alias("size"))
    runs = stage(spark, keyed.repartitionByRange(shuffle_partitions(spark), "source", "key")
                 .sortWithinPartitions("source", "key")
                 .withColumn("pid", F.spark_partition_id()), root, "runs")

    parts = stage(spark, runs.groupBy("source", "pid").agg(F.sum("size").alias("part_size")),
                  root, "parts")
    sizes = parts.groupBy("source").agg(F.sum("part_size").alias("source_size"))
    targets = stage(spark, source_targets(sizes, weights, max_epochs, fraction), root, "targets")

    earlier = Window.partitionBy("source").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    begins = (parts.withColumn("begin", F.coalesce(F.sum("part_size").over(earlier), F.lit(0)))
              .alias("p").join(targets.alias("t"),
                               F.col("p.source").eqNullSafe(F.col("t.source")))
              .select("p.source", "pid", "begin", "rem"))
    so_far = Window.partitionBy("pid", "source").orderBy("key")
    sums = (runs.alias("r").withColumn("run", F.sum("size").over(so_far))
            .join(begins.alias("b"), (F.col("r.pid") == F.col("b.pid"))
                  & F.col("r.source").eqNullSafe(F.col("b.source")))
            .select(F.col("r.source").alias("source"), "key", "size", "rem",
                    (F.col("begin") + F.col("run")).alias("run")))
    cuts = (sums.where(F.col("run") > F.col("rem")).groupBy("source")
            .agg(F.min(F.struct("key", "size", (F.col("rem") - F.col("run") + F.col("size"))
                                .alias("part"))).alias("cut")))
    plan = stage(spark, targets.alias("t").join(
        cuts.alias("c"), F.col("t.source").eqNullSafe(F.col("c.source")), "left")
        .select("t.source", "source_size", "target", "epochs", "cut"), root, "plan")

    name, p = fresh(docs, out), fresh(docs, "mix_plan")
    plan = small(plan.select(F.struct("*").alias(p)), MAX_BROADCAST_SOURCES)
    joined = docs.join(plan, docs[source_col].cast("string").eqNullSafe(F.col(f"{p}.source")), "left")
    size, key, cut = n_words(docs[text_col]), random_key(docs[id_col], seed), F.col(f"{p}.cut")
    copies = F.col(f"{p}.epochs") + F.coalesce((key < cut["key"]).cast("long"), F.lit(0))
    part = F.when((key == cut["key"]) & (cut["size"] > 0),
                  F.floor(size * cut["part"] / cut["size"])).otherwise(0)
    return joined.select(
        *[docs[c] for c in docs.columns],
        F.struct(size.alias("size"), F.col(f"{p}.source_size").alias("source_size"),
                 F.col(f"{p}.target").alias("target"), copies.alias("copies"), part.alias("part"),
                 (size * copies + part).alias("taken")).alias(name)), name


def mixed(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars",
          **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, columns as in ``docs``.

    The last copy of a document at its source's cut has its first ``part``
    words, joined by one space, and ``chars_col``, if there, counts them.
    """
    takes, name = mix_sources(docs, text_col=text_col, **options)
    again = fresh(takes, "mix_copy")
    copies, part = F.col(f"{name}.copies"), F.col(f"{name}.part")
    n = copies + (part > 0).cast("long")
    takes = takes.where(n > 0).withColumn(again, F.explode(F.sequence(F.lit(1).cast("long"), n)))
    cut = F.col(again) > copies
    text = F.when(cut, F.array_join(F.slice(words(F.col(text_col)), F.lit(1), part.cast("int")), " "))
    new = {text_col: F.coalesce(text, F.col(text_col)), chars_col: F.coalesce(
        F.length(text), F.col(chars_col)).cast(docs.schema[chars_col].dataType)
        if chars_col in docs.columns else None}
    return takes.select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    takes, name = mix_sources(docs)
    return takes.select("doc_id", *[F.col(f"{name}.{c}").alias(c)
                                    for c in ("size", "source_size", "target", "taken")])


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, source, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS k,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (
  SELECT source, source_size, source_size * 3.0::DOUBLE AS cap,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
              WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS w
  FROM s),
l AS (
  SELECT *, cap / w AS ratio,
         ((sum(source_size) OVER ())::DOUBLE
          - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
         / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY cap / w, source NULLS LAST
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) AS lev
  FROM w),
t AS (
  SELECT source, source_size,
         least(cap, (SELECT max(lev) FROM l WHERE ratio >= lev) * w) AS target FROM l),
e AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs
  FROM t),
r AS (
  SELECT d.doc_id, d.size, e.source_size, e.target, e.epochs,
         e.target - e.epochs * e.source_size AS rem,
         (sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k))::DOUBLE AS run,
         (sum(d.size) OVER (PARTITION BY d.source, d.k))::DOUBLE AS tie
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
       (size * epochs + CASE WHEN run <= rem THEN size
                             WHEN tie > 0 AND run - tie <= rem THEN floor(size * (rem - run + tie) / tie)
                             ELSE 0 END)::BIGINT AS taken
FROM r
"""
