"""CSV read by many tasks a file, with quoted line breaks and headers united by name.

Spark's CSV reader gives a file with quoted line breaks to one task. Here a
file is read as lines, in byte ranges, and a range cuts its own records:

1. every byte range counts its quotes (a partial aggregate in the scan). Quotes inside values
   are doubled, so a range starts inside a value if and only if the running sum of
   the ranges before it is odd;
2. with that parity, broadcast as the list of odd ranges, a streaming pass over each range
   finds the lines at which records begin and joins the lines of a record.
   The records are written once, together with the pieces at the ends of
   ranges that belong to a record over several of them;
3. the pieces are joined by the range in which their record begins. There are at most
   two a range, so this moves next to nothing;
4. the first record of every file is its header. The different headers are
   united by name; a table of each file's column positions, broadcast while small,
   tells the parse where a column stands, and a column that a file lacks is null.

No text is shuffled but the pieces. The parity belongs to a byte offset, so a
later scan that cuts files elsewhere is noticed and fails.

Files end their lines with ``\\n`` or ``\\r\\n``; line breaks inside values stay as they
are. Quotes stand around whole values or doubled inside them, as in RFC 4180.
Blank lines between records are skipped. A file with an open quote at its end, a repeated
column name, or a row with more or fewer values than its header fails the read
and is named.
"""

from __future__ import annotations

import contextlib
import csv
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodestar.sources.files import materialize, new_stage_root

#: Byte ranges (rows of about 150 bytes) whose parity may be broadcast; at 128 MB a range, 128 TB of CSV.
MAX_RANGES = 1_000_000
#: Files whose column positions are broadcast to the parse; beyond, the records are joined by file.
MAX_BROADCAST_FILES = 100_000
#: Different headers in one folder.
MAX_HEADERS = 10_000

#: Kinds of pieces: a whole record, the begin of one, and lines that go on with a record of an earlier range.
WHOLE, BEGUN, GOES_ON = range(3)

_PIECES = "file string, blk long, seq long, kind int, text string"
_PIECES_ARROW = pa.schema([("file", pa.string()), ("blk", pa.int64()), ("seq", pa.int64()), ("kind", pa.int32()),
                           ("text", pa.string())])


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of all files with the file and the byte range they were read in."""
    m = F.col("_metadata")
    return (spark.read.option("lineSep", "\n").text(path)
            .select(m["file_path"].alias("file"), m["file_block_start"].alias("blk"), "value"))


def range_parities(lines: DataFrame) -> DataFrame:
    """(file, blk, quotes, odd): whether a byte range starts inside a quoted value. Windows run over one row a range."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counts = lines.groupBy("file", "blk").agg(F.sum(quotes).cast("long").alias("quotes"))
    before = Window.partitionBy("file").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("odd", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)


class _Range:
    """The records of one byte range, line by line; ``odd`` tells whether it starts inside a value."""

    def __init__(self, file: str, blk: int, odd: bool):
        self.key, self.odd, self.seq = (file, blk), odd, 0
        self.kind, self.open = (GOES_ON if odd else BEGUN), []

    def add(self, values: pa.Array, out: list) -> None:
        """Takes the next lines; appends (kinds, texts) of what is finished."""
        quotes = pc.count_substring(values, pattern='"').to_numpy(zero_copy_only=False)
        inside = (int(self.odd) + np.r_[0, np.cumsum(quotes)]) % 2
        begins = np.flatnonzero(inside[:-1] == 0)
        self.odd = bool(inside[-1])
        first = int(begins[0]) if len(begins) else len(values)
        if first:
            self.open += values[:first].to_pylist()
        if not len(begins):
            return
        if self.open:
            self._close(out)
        ends = np.r_[begins[1:], len(values)]
        if self.odd:  # the last record goes on
            self.kind, self.open = BEGUN, values[int(begins[-1]):].to_pylist()
            begins, ends = begins[:-1], ends[:-1]
        single = ends - begins == 1
        texts = values.take(pa.array(begins)).to_pylist() if single.any() else [None] * len(begins)
        for k in np.flatnonzero(~single):
            texts[k] = "\n".join(values[int(begins[k]):int(ends[k])].to_pylist())
        self._put(out, WHOLE, texts)

    def _close(self, out: list) -> None:
        """The open lines end before the next line."""
        text = "\n".join(self.open)
        self._put(out, WHOLE if self.kind == BEGUN else GOES_ON, [text])
        self.kind, self.open = BEGUN, []

    def end(self, out: list) -> None:
        if self.open:
            if self.odd or self.kind == GOES_ON:
                self._put(out, self.kind, ["\n".join(self.open)])
            else:
                self._close(out)
            self.open = []

    def _put(self, out: list, kind: int, texts: list[str]) -> None:
        n = len(texts)
        if n:
            out.append(pa.RecordBatch.from_arrays(
                [pa.array([self.key[0]] * n, pa.string()), pa.array([self.key[1]] * n, pa.int64()),
                 pa.array(range(self.seq, self.seq + n), pa.int64()), pa.array([kind] * n, pa.int32()),
                 pa.array(texts, pa.string())], schema=_PIECES_ARROW))
            self.seq += n


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines (file, blk, value, odd) in file order to pieces."""
    now = None
    for rb in batches:
        files, blks = rb.column("file").dictionary_encode(), rb.column("blk").to_numpy()
        values, odd, of = rb.column("value"), rb.column("odd"), files.indices.to_numpy()
        change = (np.flatnonzero((of[1:] != of[:-1]) | (blks[1:] != blks[:-1])) + 1).tolist()
        for b, e in zip([0, *change], [*change, rb.num_rows], strict=True):
            if b == e:
                continue
            out: list[pa.RecordBatch] = []
            key = (files.dictionary[int(of[b])].as_py(), int(blks[b]))
            if now is None or now.key != key:
                if now is not None:
                    now.end(out)
                if odd[b].as_py() is None:
                    raise RuntimeError(f"byte ranges of {key[0]} changed between two scans; read it again")
                now = _Range(*key, odd[b].as_py())
            now.add(values.slice(b, e - b), out)
            yield from out
    if now is not None:
        out = []
        now.end(out)
        yield from out


@contextlib.contextmanager
def _ranges_of(spark: SparkSession, most: int | None):
    """Scans in this block cut files into byte ranges of at most ``most`` bytes."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    if most is not None:
        spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def csv_records(spark: SparkSession, path: str, root: str, range_bytes: int | None = None) -> DataFrame:
    """(file, blk, seq, text): every record of the files at ``path``, headers included, blank ones left out.

    (blk, seq) orders the records of a file.
    """
    with _ranges_of(spark, range_bytes):
        return _records(spark, path, root)


def _records(spark: SparkSession, path: str, root: str) -> DataFrame:
    lines = _lines(spark, path)
    ranges = materialize(spark, range_parities(lines), f"{root}/ranges")
    if ranges.limit(MAX_RANGES + 1).count() > MAX_RANGES:
        raise ValueError(f"{path} has more than {MAX_RANGES} byte ranges; raise spark.sql.files.maxPartitionBytes")
    open_ = ranges.groupBy("file").agg(F.sum("quotes").alias("n")).where("n % 2 = 1").select("file").first()
    if open_ is not None:
        raise ValueError(f"{open_['file']} ends inside a quoted value")
    # A broadcast join keeps the order of the lines in their partition.
    known = F.broadcast(ranges.select("file", "blk", "odd"))
    pieces = materialize(spark, lines.join(known, ["file", "blk"], "left").select("file", "blk", "value", "odd")
                         .mapInArrow(_cut, _PIECES), f"{root}/pieces")
    parts = pieces.where(F.col("kind") != WHOLE)
    in_order = Window.partitionBy("file").orderBy("blk", F.desc("kind"))  # what goes on stands before what begins
    owners = (parts.select("file", "blk", "seq", "kind")
              .withColumn("owner", F.last(F.when(F.col("kind") == BEGUN, F.struct("blk", "seq")), True).over(in_order)))
    joined = (parts.join(owners, ["file", "blk", "seq", "kind"]).groupBy("file", "owner")
              .agg(F.array_sort(F.collect_list(F.struct("blk", "text"))).alias("p"))
              .select("file", F.col("owner.blk").alias("blk"), F.col("owner.seq").alias("seq"),
                      F.array_join(F.col("p.text"), "\n").alias("text")))
    records = pieces.where(F.col("kind") == WHOLE).select("file", "blk", "seq", "text").unionByName(joined)
    return (records.withColumn("text", F.regexp_replace("text", r"\r\z", ""))
            .where(F.col("text") != ""))


def _names(header: str, file: str) -> list[str]:
    names = next(csv.reader(io.StringIO(header.removeprefix("\ufeff"), newline=""), doublequote=True))
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"header of {file} repeats columns {twice}")
    return names


def read_split_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
                   root: str | None = None, range_bytes: int | None = None) -> DataFrame:
    """The rows of the CSV files at ``path``, columns by header name, large files split over tasks.

    Without a ``schema`` the columns are those of all headers, all text: those of the
    first file (by path) in its order, then new ones as they appear in later
    files. With one its columns are selected by name and cast strictly (under
    ANSI mode); a column that no header has is an error. A file that lacks a
    column gives null. Empty values are null. ``root`` is the folder of the stages, by default a
    fresh one under the session's checkpoint folder; ``range_bytes`` the largest byte range, by default
    the session's ``spark.sql.files.maxPartitionBytes``.
    """
    root = root or new_stage_root(spark, "csv")
    records = csv_records(spark, path, root, range_bytes)
    heads = materialize(spark, records.where("blk = 0").groupBy("file").agg(
        F.min(F.struct("blk", "seq", "text")).alias("h")).select("file", "h.blk", "h.seq", F.col("h.text").alias("header")),
        f"{root}/headers")
    kinds = heads.groupBy("header").agg(F.min("file").alias("file")).orderBy("file").limit(MAX_HEADERS + 1).collect()
    if not kinds:
        if schema is None:
            raise ValueError(f"no CSV header at {path}")
        return spark.createDataFrame([], schema)
    if len(kinds) > MAX_HEADERS:
        raise ValueError(f"{path} has more than {MAX_HEADERS} different headers")
    layouts = [(k["header"], _names(k["header"], k["file"])) for k in kinds]
    union = list(dict.fromkeys(n for _, names in layouts for n in names))
    fields = [(n, None) for n in union] if schema is None else [
        (f.name, f.dataType) for f in spark.createDataFrame([], schema).schema.fields]
    missing = [n for n, _ in fields if n not in union]
    if missing:
        raise KeyError(f"no CSV header of {path} has columns {missing}")

    positions = spark.createDataFrame(
        [(h, len(names), [names.index(n) if n in names else -1 for n, _ in fields]) for h, names in layouts],
        "header string, width int, at array<int>")
    files = heads.join(F.broadcast(positions), "header").select("file", F.col("blk").alias("b0"), F.col("seq").alias("s0"),
                                                                "width", "at")
    if heads.limit(MAX_BROADCAST_FILES + 1).count() <= MAX_BROADCAST_FILES:
        files = F.broadcast(files)
    rows = records.join(files, "file").where((F.col("blk") != F.col("b0")) | (F.col("seq") != F.col("s0")))
    bare = F.regexp_replace("text", '"[^"]*"', "")
    n = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    told = F.concat(F.lit("a row of "), "file", F.lit(" has "), n.cast("string"), F.lit(" values, its header "),
                    F.col("width").cast("string"))
    widest = max(len(names) for _, names in layouts)
    parsed = F.from_csv(F.when(n == F.col("width"), F.col("text")).otherwise(F.raise_error(told)),
                        ", ".join(f"c{i} string" for i in range(widest)), {"escape": '"', "maxCharsPerColumn": "-1"})
    values = F.array(*[F.col(f"v.c{i}") for i in range(widest)])
    rows = rows.select(parsed.alias("v"), "at").select(values.alias("v"), "at")
    out = [F.get("v", F.get("at", F.lit(i))) for i in range(len(fields))]
    return rows.select(*[(c if t is None else c.cast(t)).alias(name) for c, (name, t) in zip(out, fields, strict=True)])
