"""Streaming sources: new files in a directory, or lines from a socket."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def text_file_stream(
    spark: SparkSession, directory: str, max_files_per_trigger: int | None = None,
    max_bytes: int | None = None, nested: bool = False,
) -> DataFrame:
    """New text files in ``directory`` as a stream of lines (``value``).

    Files are picked up oldest first; ``max_files_per_trigger`` or
    ``max_bytes`` bounds one micro-batch (the reference picked up whatever
    arrived in each 2 s interval). ``nested``: also files in its folders.
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes))
    if nested:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.load(directory)


def socket_stream(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a TCP socket (``value``). Not fault tolerant: for
    experiments only; production feeds should come from files or a log bus.
    """
    return (
        spark.readStream.format("socket").option("host", host).option("port", str(port)).load()
    )
