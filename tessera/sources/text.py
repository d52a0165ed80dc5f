"""Text sources: positional delimited text, header CSV, one-value-per-line word lists.

All readers take an explicit schema (no inference pass over the data).  Delimited text is read
as strings first and then trimmed and cast with ``try_cast``, so a malformed value becomes NULL
instead of failing the job under ANSI mode; ``min_fields`` leaves out lines of too few fields, which
:func:`short_lines` returns.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import nonempty, strip_cr


def _as_strings(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])


def read_delimited(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, *,
                   sep: str = ",", trim: bool = True, min_fields: int | None = None,
                   quote: str | None = "", flag_surplus: str | None = None) -> DataFrame:
    """Positional delimited text without header.

    * ``quote=""`` turns quoting off: quote characters are data (``quote=None`` keeps Spark's
      default ``"``).
    * Surplus fields are dropped, missing fields are NULL (PERMISSIVE mode); blank lines are
      skipped.
    * ``trim`` strips each field; values are cast to the schema types with ``try_cast``.
    * ``min_fields=n`` keeps lines of at least ``n`` fields, whatever is in them: an empty field or a
      value that does not parse is NULL and the row stays.  The others are ``short_lines``.
    * ``flag_surplus="name"`` adds a boolean column that is true when the line had more fields than
      the schema (e.g. an unquoted comma inside a title shifted the positions), so such rows can be
      reported as rejects while the positional reading is kept.
    """
    read_schema = _as_strings(schema)
    if flag_surplus:
        read_schema = read_schema.add(T.StructField("__surplus", T.StringType(), True))
    if min_fields:  # a line whose number of fields differs from the schema's is kept here as it is
        read_schema = read_schema.add(T.StructField("__line", T.StringType(), True))
    reader = spark.read.schema(read_schema).option("sep", sep).option("header", False) \
        .option("mode", "PERMISSIVE")
    if quote is not None:
        reader = reader.option("quote", quote)
    if min_fields:
        reader = reader.option("columnNameOfCorruptRecord", "__line")
    raw = reader.csv(list(paths) if not isinstance(paths, str) else paths)
    cols = []
    for f in schema.fields:
        c = F.trim(F.col(f.name)) if trim else F.col(f.name)
        cols.append((c if isinstance(f.dataType, T.StringType) else c.try_cast(f.dataType)).alias(f.name))
    if flag_surplus:
        cols.append(F.col("__surplus").isNotNull().alias(flag_surplus))
    if min_fields:
        raw = raw.where(F.col("__line").isNull()
                        | (field_count(F.col("__line"), sep, quote) >= min_fields))
    return raw.select(*cols)


def field_count(line: Column, sep: str, quote: str | None = "") -> Column:
    """Number of fields of a line; separators inside quotes do not count (``quote=""``: no quoting)."""
    mark = '"' if quote is None else quote
    pattern = re.escape(sep)
    if mark:
        q = re.escape(mark)
        pattern += f"(?=(?:[^{q}]*{q}[^{q}]*{q})*[^{q}]*$)"
    return F.size(F.split(line, pattern))


def short_lines(spark: SparkSession, paths: str | Sequence[str], min_fields: int, *, sep: str = ",",
                quote: str | None = "") -> DataFrame:
    """``line, n_fields`` of the lines that ``read_delimited(min_fields=...)`` leaves out (blank lines
    aside)."""
    lines = spark.read.text(list(paths) if not isinstance(paths, str) else paths)
    counted = lines.select(F.col("value").alias("line"),
                           field_count(F.col("value"), sep, quote).alias("n_fields"))
    return counted.where((F.trim("line") != "") & (F.col("n_fields") < min_fields))


def read_word_list(spark: SparkSession, paths: str | Sequence[str], col: str = "word") -> DataFrame:
    """One value per line: strip CR, drop NULL/empty lines, DISTINCT."""
    lines = spark.read.text(list(paths) if not isinstance(paths, str) else paths)
    words = lines.select(strip_cr("value").alias(col))
    return words.where(nonempty(col)).distinct()


def read_csv_table(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | None = None,
                   *, sep: str = ";", multi_line: bool = False, infer: bool = False) -> DataFrame:
    """Header CSV with quoted fields and ``""`` as the escaped quote.

    ``multi_line=True`` allows line breaks inside quotes; a file is then read by one task.
    :func:`read_csv_records` reads such files by many.

    Pass ``schema`` (recommended at scale: inference is a full extra scan); ``infer=True`` opts
    in to inference when no schema is known.
    """
    reader = spark.read.option("header", True).option("sep", sep).option("quote", '"') \
        .option("escape", '"').option("multiLine", multi_line)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(list(paths) if not isinstance(paths, str) else paths)


def read_csv_records(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, *,
                     sep: str = ";", header: bool = True) -> DataFrame:
    """Header CSV whose quoted fields may hold line breaks, each file read by many tasks.

    A line break ends a record where the number of quotes before it, from the file's beginning, is even
    (``""`` inside a field counts two).  The quotes of each split are counted first; their running sums
    tell every split whether it begins inside a field.  Records within a split are put together there; the
    pieces of those that cross a border, two a split at most, are joined by file.

    Records end in LF or CRLF; a line break inside quotes is kept as it is.  Empty lines are skipped,
    missing fields are NULL, values that do not parse are NULL.  A quote inside an unquoted field breaks
    the count: such files need ``read_csv_table(multi_line=True)``.
    """
    lines = spark.read.option("lineSep", "\n").text(list(paths) if not isinstance(paths, str) else paths)
    lines = lines.select(
        F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"),
        F.monotonically_increasing_id().alias("i"), F.col("value"),
        (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("q"))
    by_file = Window.partitionBy("f").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    splits = lines.groupBy("f", "b").agg(F.sum("q").alias("n")).select(
        "f", "b", F.coalesce(F.sum("n").over(by_file), F.lit(0)).alias("before"))
    here = Window.partitionBy("f", "b").orderBy("i")
    begun = F.col("before") + F.coalesce(F.sum("q").over(here.rowsBetween(Window.unboundedPreceding, -1)),
                                         F.lit(0))
    placed = lines.join(splits, ["f", "b"]).withColumn("begun", begun)
    # Record 0 of a split is what it continues of a split before.
    placed = placed.withColumn("r", F.sum((F.col("begun") % 2 == 0).cast("int")).over(here))
    pieces = placed.groupBy("f", "b", "r").agg(
        F.sort_array(F.collect_list(F.struct("i", "value"))).alias("lines"),
        (F.max(F.struct("i", F.col("begun") + F.col("q")))["col2"] % 2 == 0).alias("whole")).select(
        "f", "b", "r", F.concat_ws("\n", "lines.value").alias("text"),
        (F.col("whole") & (F.col("r") > 0)).alias("whole"))
    first = (F.col("b") == 0) & (F.col("r") == 1)
    in_file = Window.partitionBy("f").orderBy("b", "r")
    crossing = pieces.where("NOT whole").withColumn(
        "g", F.sum((F.col("r") > 0).cast("int")).over(in_file)).groupBy("f", "g").agg(
        F.sort_array(F.collect_list(F.struct("b", "r", "text"))).alias("p"),
        F.max(first.cast("int")).alias("first")).select(
        F.concat_ws("\n", "p.text").alias("text"), (F.col("first") == 1).alias("first"))
    records = pieces.where("whole").select("text", first.alias("first")).unionAll(crossing)
    if header:
        records = records.where(~F.col("first"))
    text = F.regexp_replace("text", "\r$", "")
    options = {"sep": sep, "quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}
    return records.select(text.alias("text")).where("text <> ''").select(
        F.from_csv("text", _ddl(schema), options).alias("r")).select("r.*")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace(chr(96), chr(96) * 2)}` {f.dataType.simpleString()}" for f in schema.fields)


def read_json_documents(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, *,
                        multi_line: bool = True) -> DataFrame:
    """JSON documents with an explicit schema.

    ``multi_line=True`` reads one (pretty-printed) document per file, as a document store dumps
    them; ``False`` reads JSON lines, which split across tasks.
    """
    return spark.read.schema(schema).option("multiLine", multi_line) \
        .option("mode", "PERMISSIVE").json(list(paths) if not isinstance(paths, str) else paths)
