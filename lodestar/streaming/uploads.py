"""Pick up uploaded survey files as they arrive (the upload-and-run step of J17).

Survey files are dropped into one upload folder and the ingestion stage turns
each into the materialized answer table. Here that stage is a Structured
Streaming query over the folder:

* the file source lists the folder and hands every new file to exactly one
  micro-batch; the list of files already taken lives in the query's
  checkpoint, so a restart resumes where it stopped;
* each micro-batch runs the batch transform (``plans.survey.prepare``: row
  ids, facility column, answer columns by name pattern) and writes its rows
  to its own folder ``batch=<id>`` with ``overwrite``. A batch that is
  retried after a failure rewrites only its own folder, so the output never
  holds the same answers twice, even though the ids are random;
* the ids are read back and checked unique, over all batches;
* with ``id_mode="hash"`` ids are reproducible: the query keeps, for each distinct
  row (its SHA-256), how often it has come so far, so the next identical row gets the next
  occurrence number whichever file or batch brings it. The same rows get the same set of ids
  in any order of uploads, and the same as ``assign_hash_ids`` gives them in one batch. The state
  lives in the checkpoint, a number a distinct row; a retried batch starts from the state before it;
* every file's header is checked against the schema; a file with other columns
  or another order fails its batch and is named;
* ``availableNow`` processes everything present and then stops, which is what
  an upload button needs; ``processing_time`` keeps the query running.

The checkpoint belongs to the output (``<out_path>`` + ``_checkpoint``) unless the
caller names one, so a second call goes on where the first one stopped. The CSV
source needs a schema: pass it, or let ``header_schema`` take the column names
from the header line (all columns as text). Answers are cast to one type for
all batches: the one given, else the one of the answers written before, else
the one that holds all answers now in the folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import DataType, StringType, StructField, StructType

from lodestar.functions.ids import assert_unique, hash_id, row_hash
from lodestar.functions.patterns import matching_columns
from lodestar.plans.survey import ID_COL, answer_type_of, prepare
from lodestar.sources.files import csv_options, path_exists, read_csv

BATCH_DIR = "batch"


def header_schema(spark: SparkSession, sample_path: str) -> StructType:
    """All-text schema named by the header line of ``sample_path``."""
    names = read_csv(spark, sample_path).columns
    return StructType([StructField(n, StringType(), True) for n in names])


def _answer_type(spark: SparkSession, upload_dir: str, out_path: str) -> DataType | str | None:
    if path_exists(spark, f"{out_path}/{BATCH_DIR}=*"):
        written = spark.read.parquet(out_path)
        return written.schema[matching_columns(written.columns)[0]].dataType
    return answer_type_of(read_csv(spark, upload_dir))


def _count_on(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The rows of one hash with their occurrence numbers, which go on from the batches before."""
    n = state.get[0] if state.exists else 0
    for pdf in frames:
        pdf["occurrence"] = range(n, n + len(pdf))
        n += len(pdf)
        yield pdf[["row", "occurrence"]].assign(row_hash=key[0])
    state.update((n,))


def with_hash_ids(stream: DataFrame) -> DataFrame:
    """A stream's rows with reproducible ids, by occurrence numbers kept in the query's state."""
    cols = stream.columns
    rows = stream.select(row_hash(cols).alias("row_hash"), F.to_json(F.struct(*cols)).alias("row"))
    numbered = rows.groupBy("row_hash").applyInPandasWithState(
        _count_on, "row string, occurrence long, row_hash string", "n long", "append", GroupStateTimeout.NoTimeout)
    return numbered.select(F.from_json("row", stream.schema).alias("r"),
                           hash_id(F.col("row_hash"), F.col("occurrence")).alias(ID_COL)).select("r.*", ID_COL)


def survey_upload_stream(spark: SparkSession, upload_dir: str, out_path: str,
                         schema: StructType, *, answer_type: DataType | str,
                         checkpoint: str | None = None, files_per_batch: int | None = None,
                         processing_time: str | None = None, id_mode: str = "random") -> StreamingQuery:
    """Start the pick-up query; returns the running ``StreamingQuery``.

    The ``id_mode`` of a checkpoint is fixed by its first run.
    """
    if id_mode not in ("random", "hash"):
        raise ValueError(f"id mode {id_mode!r} not in ('random', 'hash')")
    checkpoint = checkpoint or f"{out_path.rstrip('/')}_checkpoint"
    reader = csv_options(spark.readStream.schema(schema))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.csv(upload_dir)
    if id_mode == "hash":
        stream = with_hash_ids(stream)
    given = "given" if id_mode == "hash" else id_mode

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        target = f"{out_path}/{BATCH_DIR}={batch_id}"
        prepare(batch, answer_type, id_mode=given).write.mode("overwrite").parquet(target)
        assert_unique(batch.sparkSession.read.parquet(target), ID_COL)

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = (writer.trigger(processingTime=processing_time) if processing_time
              else writer.trigger(availableNow=True))
    return writer.start()


def ingest_uploads(spark: SparkSession, upload_dir: str, out_path: str,
                   schema: StructType | None = None, answer_type: DataType | str | None = None,
                   **kw) -> DataFrame:
    """Process every file now in ``upload_dir`` and return all answers written so far.

    The result has the batch columns (``participant_id, facility_name,
    <answers>``); the ``batch`` folder level is not a column.
    """
    some = path_exists(spark, f"{upload_dir}/*")
    if schema is None:
        schema = header_schema(spark, upload_dir)
    if answer_type is None:
        answer_type = _answer_type(spark, upload_dir, out_path) if some else "string"
    query = survey_upload_stream(spark, upload_dir, out_path, schema, answer_type=answer_type, **kw)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    if not path_exists(spark, f"{out_path}/{BATCH_DIR}=*"):  # no file has arrived yet
        return prepare(spark.createDataFrame([], schema), answer_type)
    written = spark.read.parquet(out_path).drop(BATCH_DIR)
    assert_unique(written, ID_COL)
    return written
