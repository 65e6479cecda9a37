"""Running streaming queries to a table, and reading the table back.

Sinks:

* Append streams (rows that never change: tokens, posts, closed windows) use
  Spark's own file sink, whose commit log makes it exactly-once.
* Update streams and per-batch results use ``foreachBatch``: every micro-batch
  is written to its own ``batch=<id>`` folder with mode overwrite. A batch that
  is retried after a failure (same id, same input, thanks to the checkpoint)
  replaces its own folder, so the table is exactly-once as well.
  ``read_latest`` keeps the newest version of every key.
* Several tables of one micro-batch (:func:`start_to_tables`): the batch is
  computed once, and each table's rows are written aside and then moved to
  ``<table>/batch=<id>`` at once. A table that has the batch already is left as
  it is, so a retried batch repeats nothing, and a stream that reads one of the
  tables sees every batch once.

:func:`window_actions` calls a function for every closed window.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from quarry.session import (
    folder_exists, make_folder, move_folder, remove_folder, scratch_path,
)

BATCH_COL = "batch"

# A transformation applied to each micro-batch on its own.
BatchFn = Callable[[DataFrame], DataFrame]
# Called with a closed window's start (epoch seconds) and its rows.
WindowFn = Callable[[int, DataFrame], None]


def batch_writer(out_dir: str, per_batch: BatchFn | None = None) -> Callable[[DataFrame, int], None]:
    """foreachBatch function: write the batch's rows to ``out_dir/batch=<id>``.

    ``per_batch`` (DataFrame -> DataFrame) is applied to each micro-batch on
    its own, e.g. a count that must not carry state across batches.
    """

    def write(batch_df: DataFrame, batch_id: int) -> None:
        out = per_batch(batch_df) if per_batch else batch_df
        out.write.mode("overwrite").parquet(f"{out_dir}/{BATCH_COL}={batch_id}")

    return write


def tables_writer(out_dir: str, tables: dict[str, BatchFn]) -> Callable[[DataFrame, int], None]:
    """foreachBatch function: write each of ``tables`` of the batch to
    ``out_dir/<table>/batch=<id>``. The batch is computed once for all."""
    base = out_dir.rstrip("/")

    def write(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        folder = f"{BATCH_COL}={batch_id}"
        todo = [n for n in tables if not folder_exists(spark, f"{base}/{n}/{folder}")]
        if not todo:
            return
        batch_df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for name in todo:
                aside = f"{base}/_aside/{name}/{folder}"
                tables[name](batch_df).write.mode("overwrite").parquet(aside)
                move_folder(spark, aside, f"{base}/{name}/{folder}")
        finally:
            batch_df.unpersist()

    return write


def window_actions(
    action: WindowFn, marks_dir: str, window: str = "window_start_epoch"
) -> Callable[[DataFrame, int], None]:
    """foreachBatch function for a windowed report in append mode:
    ``action(window start, rows of the window)`` for every window that the
    batch has closed, oldest first.

    A window closes in one batch. When its action has returned, the window is
    marked in ``marks_dir``; a retried batch skips marked windows and goes on
    at the one that failed. So an action that has returned is not run again,
    and one that failed half-way is: it should overwrite what it wrote, under
    the window's key. The windows that a batch closes are listed on the
    driver, their rows are not.
    """
    marks = marks_dir.rstrip("/")

    def run(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        batch_df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            closed = batch_df.select(window).distinct().orderBy(window).collect()
            for (start,) in closed:
                mark = f"{marks}/window={start}"
                if not folder_exists(spark, mark):
                    action(start, batch_df.where(F.col(window) == start))
                    make_folder(spark, mark)
        finally:
            batch_df.unpersist()

    return run


def _started(
    writer: DataStreamWriter, checkpoint: str, available_now: bool,
    processing_time: str | None, name: str | None,
) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def start_to_table(
    stream_df: DataFrame,
    out_dir: str,
    checkpoint: str,
    output_mode: str = "update",
    available_now: bool = True,
    processing_time: str | None = None,
    name: str | None = None,
    per_batch: BatchFn | None = None,
) -> StreamingQuery:
    """Start ``stream_df`` writing batch folders under ``out_dir``.

    ``available_now`` processes what is there (in several micro-batches when
    the source is rate-limited) and stops; otherwise ``processing_time`` sets
    the trigger interval of a continuous run.
    """
    writer = stream_df.writeStream.outputMode(output_mode).foreachBatch(
        batch_writer(out_dir, per_batch))
    return _started(writer, checkpoint, available_now, processing_time, name)


def start_to_tables(
    stream_df: DataFrame,
    out_dir: str,
    checkpoint: str,
    tables: dict[str, BatchFn],
    available_now: bool = True,
    processing_time: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start a stateless stream that writes several tables under ``out_dir``;
    their folders are there at once, so that other streams can read them. What
    an interrupted start left aside is removed."""
    spark = stream_df.sparkSession
    remove_folder(spark, f"{out_dir.rstrip('/')}/_aside")
    for table in tables:
        make_folder(spark, f"{out_dir.rstrip('/')}/{table}")
    writer = stream_df.writeStream.outputMode("append").foreachBatch(
        tables_writer(out_dir, tables))
    return _started(writer, checkpoint, available_now, processing_time, name)


def start_window_actions(
    report: DataFrame,
    action: WindowFn,
    marks_dir: str,
    checkpoint: str,
    available_now: bool = True,
    processing_time: str | None = None,
    name: str | None = None,
    window: str = "window_start_epoch",
) -> StreamingQuery:
    """Start a windowed report (with a watermark) that calls ``action`` for
    every window as it closes; see :func:`window_actions`."""
    writer = report.writeStream.outputMode("append").foreachBatch(
        window_actions(action, marks_dir, window))
    return _started(writer, checkpoint, available_now, processing_time, name)


def start_to_files(
    stream_df: DataFrame,
    out_dir: str,
    checkpoint: str,
    available_now: bool = True,
    processing_time: str | None = None,
    name: str | None = None,
    partition_by: str | None = None,
) -> StreamingQuery:
    """Start an append stream into a parquet table by Spark's file sink, in a
    folder for each value of ``partition_by``, if given."""
    writer = stream_df.writeStream.outputMode("append").format("parquet").option("path", out_dir)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    return _started(writer, checkpoint, available_now, processing_time, name)


def start_console(
    stream_df: DataFrame,
    num_rows: int = 10,
    output_mode: str = "append",
    processing_time: str | None = "2 seconds",
    checkpoint: str | None = None,
) -> StreamingQuery:
    """Print the first ``num_rows`` rows of every micro-batch (the reference's
    ``DStream.print()``), for interactive runs. Rows of a batch are fetched to
    the driver only up to ``num_rows``."""
    writer = (
        stream_df.writeStream.format("console")
        .outputMode(output_mode)
        .option("numRows", str(num_rows))
        .option("truncate", "false")
    )
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def run_to_table(
    stream_df: DataFrame,
    name: str,
    output_mode: str = "update",
    per_batch: BatchFn | None = None,
) -> str:
    """Run a stream over all available input and return its table folder. A
    failure of the stream is raised."""
    spark = stream_df.sparkSession
    out_dir = scratch_path(spark, f"{name}-out")
    checkpoint = scratch_path(spark, f"{name}-ckpt")
    start_to_table(stream_df, out_dir, checkpoint, output_mode, per_batch=per_batch).awaitTermination()
    return out_dir


def run_to_files(stream_df: DataFrame, name: str) -> DataFrame:
    """Run an append stream over all available input; its rows as a table."""
    spark = stream_df.sparkSession
    out_dir = scratch_path(spark, f"{name}-out")
    start_to_files(stream_df, out_dir, scratch_path(spark, f"{name}-ckpt")).awaitTermination()
    return spark.read.schema(stream_df.schema).parquet(out_dir)


def read_batches(spark: SparkSession, out_dir: str, schema: str | None = None) -> DataFrame:
    """All batch folders as one table with a ``batch`` column."""
    reader = spark.read
    if schema:
        reader = reader.schema(schema)
    return reader.parquet(out_dir)


def read_latest(spark: SparkSession, out_dir: str, keys: list[str]) -> DataFrame:
    """Newest version of every key (no ``batch`` column): an aggregate that
    combines before the shuffle, so a key costs one row a task however many
    versions it has."""
    df = read_batches(spark, out_dir)
    values = [c for c in df.columns if c != BATCH_COL and c not in keys]
    latest = df.groupBy(*keys).agg(F.max_by(F.struct(*values), BATCH_COL).alias("_v"))
    return latest.select(*keys, "_v.*")
