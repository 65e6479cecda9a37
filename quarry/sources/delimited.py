"""Delimited-text scans: typed TSV, typed CSV, runtime-schema CSV, positional split.

Lines are split with Java's rules (``line.split(sep)``): there is no quoting,
empty fields stay empty strings, and trailing ones are dropped. A field that
is used but missing, or that does not parse, fails the job, as it does in the
reference; unused fields cost nothing and fail nothing, because an unused
column is never computed. ``on_malformed="null"`` reads such fields as NULL
instead, and :func:`malformed_lines` gives the lines they are on.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.text import java_split

# --- fixed values: record layouts of the input files, with field types -------
# users (tab separated)
USERS = {"id": "string", "email": "string", "language": "string", "location": "string",
         "age": "int", "gender": "string"}
# transactions (tab separated); amounts are read as bigint
TRANSACTIONS = {"trans_id": "int", "prod_id": "int", "user_id": "string",
                "purchase_amt": "bigint", "item_description": "string"}
# people (comma separated)
PEOPLE = {"name": "string", "age": "int"}
# ---------------------------------------------------------------------------

# Characters removed by Java's String.trim().
_JAVA_BLANKS = "".join(chr(c) for c in range(0x21))
_INTEGER = r"^[+-]?[0-9]+$"
MAX_HEADER_BYTES = 1 << 16


def _policy(on_malformed: str) -> None:
    if on_malformed not in ("error", "null"):
        raise ValueError("on_malformed must be 'error' or 'null'")


def _parsed(text: Column, kind: str) -> Column:
    """The field as ``kind``, NULL where it does not parse."""
    if kind == "string":
        return text
    if kind in ("int", "bigint"):
        return F.when(text.rlike(_INTEGER), text.try_cast(kind))
    return text.try_cast(kind)


def _field(parts: Column, i: int, name: str, kind: str, on_malformed: str, trim: bool) -> Column:
    text = F.get(parts, i)
    if trim and kind != "string":
        text = F.btrim(text, F.lit(_JAVA_BLANKS))
    value = _parsed(text, kind)
    if on_malformed == "error":
        said = F.concat(F.lit(f"malformed row: field {name!r} is "),
                        F.coalesce(F.concat(F.lit("'"), text, F.lit("'")), F.lit("missing")))
        value = F.when(value.isNull(), F.raise_error(said).cast(kind)).otherwise(value)
    return value.alias(name)


def read_fields(
    spark: SparkSession, path: str, fields: dict[str, str], sep: str = "\t",
    on_malformed: str = "error", trim: bool = False,
) -> DataFrame:
    """Lines of ``path`` as columns ``fields`` (name -> string, int, bigint,
    double ...), by position. ``trim``: Java-trim before parsing a number."""
    _policy(on_malformed)
    parts = spark.read.text(path).select(java_split("value", sep).alias("p"))
    return parts.select(*(
        _field(F.col("p"), i, name, kind, on_malformed, trim)
        for i, (name, kind) in enumerate(fields.items())
    ))


def malformed_lines(
    spark: SparkSession, path: str, fields: dict[str, str], sep: str = "\t", trim: bool = False
) -> DataFrame:
    """The lines of ``path`` on which a field of ``fields`` is missing or does
    not parse (column ``value``)."""
    lines = spark.read.text(path).select("value", java_split("value", sep).alias("p"))
    bad = F.lit(False)
    for i, (name, kind) in enumerate(fields.items()):
        bad = bad | _field(F.col("p"), i, name, kind, "null", trim).isNull()
    return lines.where(bad).select("value")


def read_tsv(
    spark: SparkSession, path: str, schema: T.StructType, on_malformed: str = "error"
) -> DataFrame:
    """Tab-separated file with a fixed schema."""
    fields = {f.name: f.dataType.simpleString() for f in schema}
    return read_fields(spark, path, fields, "\t", on_malformed)


def read_users(
    spark: SparkSession, path: str, id_type: T.DataType | None = None, on_malformed: str = "error"
) -> DataFrame:
    """Users TSV. The id is a string by default ("01" differs from "1")."""
    kind = id_type.simpleString() if id_type else "string"
    return read_fields(spark, path, USERS | {"id": kind}, "\t", on_malformed)


def read_transactions(
    spark: SparkSession, path: str, user_id_type: T.DataType | None = None,
    on_malformed: str = "error",
) -> DataFrame:
    """Transactions TSV. The user id is a string by default."""
    kind = user_id_type.simpleString() if user_id_type else "string"
    return read_fields(spark, path, TRANSACTIONS | {"user_id": kind}, "\t", on_malformed)


def read_people(spark: SparkSession, path: str, on_malformed: str = "error") -> DataFrame:
    """People CSV: the name is kept verbatim, the age is trimmed (Java
    ``trim``: characters up to U+0020) and parsed. ``"Rimi, 25"``: age 25."""
    return read_fields(spark, path, PEOPLE, ",", on_malformed, trim=True)


def header_schema(spark: SparkSession, header_path: str, sep: str = ",") -> T.StructType:
    """Schema from an external header file: all lines trimmed and
    concatenated, split on ``sep``; every field a nullable string.

    The path must be one file of at most MAX_HEADER_BYTES, since it is read
    on the driver.
    """
    files = spark.read.format("binaryFile").load(header_path).select("path", "length")
    files = files.where("length > 0").limit(2).collect()
    if len(files) != 1 or files[0]["length"] > MAX_HEADER_BYTES:
        raise ValueError(f"{header_path} is not one header file of at most {MAX_HEADER_BYTES} bytes")
    text = spark.read.text(files[0]["path"], wholetext=True).first()["value"]
    # Java's trim(): strip characters <= U+0020 from both ends of each line.
    lines = re.split(r"\r\n|\r|\n", text)
    header = "".join(line.strip(_JAVA_BLANKS) for line in lines)
    names = header.split(sep)
    while names and names[-1] == "":  # Java split drops trailing empties
        names.pop()
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def read_with_header_file(
    spark: SparkSession, data_path: str, header_path: str, sep: str = ",",
    on_malformed: str = "error",
) -> DataFrame:
    """CSV whose schema is only known at run time, from a header file. Values
    are kept verbatim, empty ones too; a used field that a line does not have
    fails the job."""
    schema = header_schema(spark, header_path, sep)
    return read_fields(spark, data_path, {f.name: "string" for f in schema}, sep, on_malformed)


def positional_fields(line: str | Column, sep: str, picks: dict[str, int]) -> list[Column]:
    """``line.split(sep)[i]`` for raw text lines, by name -> index.

    Uses Java split rules; an index past the end yields NULL.
    """
    parts = java_split(line, sep)
    return [F.get(parts, i).alias(name) for name, i in picks.items()]
