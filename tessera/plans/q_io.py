"""Driver-table queries for sources, sinks and the table catalogue.

Each source/sink query writes a whole driver table in that format to a fresh folder under the
shared checkpoint folder (``spark.checkpoint.dir``), reads it back with the library reader and
returns the read-back DataFrame; the oracle is the original table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.logic import round_half_up, settled_sum
from tessera.operators.aggregate import mean_count
from tessera.plans import testbed as tb
from tessera.plans.q_relational import frames as frame_rows
from tessera.plans.registry import register, rnd, settled
from tessera.session import scratch_dir
from tessera.sinks.files import (format_lines, write_csv, write_json_arrays, write_json_lines, write_lines,
                                 write_single_csv, write_tsv)
from tessera.sources.tables import column_catalog, load_tables
from tessera.sources.text import (read_csv_records, read_csv_table, read_delimited, read_json_documents,
                                  read_word_list)

PART_SCHEMA = T.StructType([
    T.StructField("p_partkey", T.LongType()), T.StructField("p_name", T.StringType()),
    T.StructField("p_brand", T.StringType()), T.StructField("p_type", T.StringType()),
    T.StructField("p_size", T.IntegerType()), T.StructField("p_retailprice", T.DoubleType())])
EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])
DOCS_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])
NATION_REGION_SCHEMA = T.StructType([
    T.StructField("n_nationkey", T.IntegerType()), T.StructField("n_name", T.StringType()),
    T.StructField("r_name", T.StringType())])
FRAME_DOC_SCHEMA = T.StructType([
    T.StructField("camera_id", T.StringType()), T.StructField("frame_id", T.LongType()),
    T.StructField("source_timestamp", T.StringType()), T.StructField("person_count", T.LongType()),
    T.StructField("boxes", T.ArrayType(T.StructType([
        T.StructField("x1", T.DoubleType()), T.StructField("y1", T.DoubleType()),
        T.StructField("x2", T.DoubleType()), T.StructField("y2", T.DoubleType()),
        T.StructField("confidence", T.DoubleType()), T.StructField("class_id", T.LongType()),
        T.StructField("class_name", T.StringType())]))),
    T.StructField("processing_time_ms", T.DoubleType())])
ISO_SPARK = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
ISO_DUCK = "%Y-%m-%dT%H:%M:%S.%fZ"


@register("src_delimited", "SELECT * FROM part")
def src_delimited(spark, sf):
    """part as ``", "``-separated text (spaces after commas, no header) -> read_delimited."""
    path = scratch_dir(spark, "part-text")
    part = tb.table(spark, sf, "part")
    part.select(F.concat_ws(", ", *[F.col(c).cast("string") for c in part.columns])).write.text(path)
    return read_delimited(spark, path, PART_SCHEMA, sep=",", trim=True, min_fields=3)


@register("src_semicolon", "SELECT * FROM events")
def src_semicolon(spark, sf):
    """events as ``;`` text without quoting (props carry literal quotes) plus a surplus field."""
    path = scratch_dir(spark, "events-semicolon")
    ev = tb.table(spark, sf, "events")
    ev.select(F.concat_ws(";", *[F.col(c).cast("string") for c in ev.columns], F.lit("surplus"))) \
        .write.text(path)
    return read_delimited(spark, path, EVENTS_SCHEMA, sep=";", trim=False, quote="")


@register("src_csv_header", "SELECT * FROM documents")
def src_csv_header(spark, sf):
    """documents (multi-line texts) as header CSV with RFC-4180 quotes -> read_csv_records."""
    path = scratch_dir(spark, "documents-csv")
    write_csv(tb.table(spark, sf, "documents"), path, sep=";")
    return read_csv_records(spark, path, DOCS_SCHEMA, sep=";")


@register("src_json_docs", f"""
SELECT event_type AS camera_id, event_id AS frame_id, strftime(ts, '{ISO_DUCK}') AS source_timestamp,
       CAST(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 AS BIGINT) AS person_count,
       CAST(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 AS INTEGER) AS n_boxes,
       value AS processing_time_ms
FROM events""")
def src_json_docs(spark, sf):
    """Frame result documents (nested boxes) written as JSON and read back with a schema."""
    path = scratch_dir(spark, "frame-json")
    fr = frame_rows(spark, sf).select(
        "camera_id", "frame_id", F.date_format("source_ts", ISO_SPARK).alias("source_timestamp"),
        "person_count", "boxes", F.col("processing_ms").alias("processing_time_ms"))
    write_json_lines(fr, path)
    back = read_json_documents(spark, path, FRAME_DOC_SCHEMA, multi_line=False)
    return back.select("camera_id", "frame_id", "source_timestamp", "person_count",
                       F.size("boxes").alias("n_boxes"), "processing_time_ms")


@register("sink_tsv", """
SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey""")
def sink_tsv(spark, sf):
    path = scratch_dir(spark, "nation-tsv")
    nat = tb.table(spark, sf, "nation").join(tb.table(spark, sf, "region"),
                                             F.col("n_regionkey") == F.col("r_regionkey"))
    write_tsv(nat.select("n_nationkey", "n_name", "r_name"), path)
    return read_delimited(spark, path, NATION_REGION_SCHEMA, sep="\t", trim=False, quote=None)


@register("sink_single_csv", f"""
SELECT n_name AS nation, count(*) AS n_orders, {rnd(settled('o_totalprice'))} AS total_price
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def sink_single_csv(spark, sf):
    path = scratch_dir(spark, "orders-by-nation-csv")
    od = tb.table(spark, sf, "orders").join(tb.table(spark, sf, "customer"),
                                            F.col("o_custkey") == F.col("c_custkey"))
    nation = tb.table(spark, sf, "nation")
    agg = od.join(nation, F.col("c_nationkey") == F.col("n_nationkey")) \
        .groupBy(F.col("n_name").alias("nation")).agg(
            F.count(F.lit(1)).alias("n_orders"),
            F.round(settled_sum("o_totalprice"), 2).alias("total_price"))
    write_single_csv(agg, path)
    schema = T.StructType([T.StructField("nation", T.StringType()), T.StructField("n_orders", T.LongType()),
                           T.StructField("total_price", T.DoubleType())])
    return read_csv_table(spark, path, schema, sep=",", multi_line=False)


@register("sink_lines", f"""
WITH s AS (SELECT l_partkey AS movie, avg(l_quantity) AS m, count(l_quantity) AS n
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_partkey)
SELECT printf('%d %-20s %.2f %d', movie, p_name, {rnd('m')}, n) AS value
FROM s JOIN part ON movie = p_partkey""")
def sink_lines(spark, sf):
    """Per-movie formatted lines (``%d %-20s %.2f %d``) written as text and read back."""
    path = scratch_dir(spark, "movie-lines")
    stats = mean_count(tb.ratings(spark, sf), "movie", "rating", "m", "n") \
        .join(tb.table(spark, sf, "part").select(F.col("p_partkey").alias("movie"), "p_name"), "movie")
    format_lines(stats, "%d %-20s %.2f %d", ["movie", "p_name", round_half_up("m", 2), "n"]) \
        .write.text(path)
    return spark.read.text(path)


@register("sink_write_lines", """
SELECT printf('%d|%s', s_suppkey, s_name) AS value FROM supplier""")
def sink_write_lines(spark, sf):
    """supplier through ``write_lines``, read back as text."""
    path = scratch_dir(spark, "supplier-lines")
    write_lines(tb.table(spark, sf, "supplier"), "%d|%s", ["s_suppkey", "s_name"], path)
    return spark.read.text(path)


@register("src_json_multiline", "SELECT s_suppkey, s_name FROM supplier")
def src_json_multiline(spark, sf):
    """supplier as JSON documents with line breaks, a bounded number of them in an array a file, read in
    the multi-line form."""
    path = scratch_dir(spark, "supplier-docs")
    docs = tb.table(spark, sf, "supplier").select("s_suppkey", F.to_json(
        F.struct("s_suppkey", "s_name"), {"pretty": "true"}).alias("doc"))
    write_json_arrays(docs, path, "doc", order="s_suppkey")
    schema = T.StructType([T.StructField("s_suppkey", tb.table(spark, sf, "supplier")
                                         .schema["s_suppkey"].dataType),
                           T.StructField("s_name", T.StringType())])
    return read_json_documents(spark, path, schema).select("s_suppkey", "s_name")


@register("src_word_list", """
SELECT DISTINCT replace(line, chr(13), '') AS word
FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
WHERE replace(line, chr(13), '') <> ''""")
def src_word_list(spark, sf):
    """Every document's lines written as a text file, read back as a de-duplicated word list."""
    path = scratch_dir(spark, "doc-lines")
    tb.table(spark, sf, "documents").select("text").write.text(path)
    return read_word_list(spark, path)


@register("table_profile", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows, "
    f"CAST((SELECT count(*) FROM information_schema.columns WHERE table_name = '{t}') AS INTEGER) "
    f"AS n_cols FROM {t}" for t in tb.TABLES))
def table_profile(spark, sf):
    tables = load_tables(spark, sf, tb.TABLES)
    parts = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
                    F.lit(len(df.columns)).alias("n_cols")) for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# Names of column types in DuckDB and here.
TYPE_NAMES = {"BIGINT": "bigint", "INTEGER": "int", "SMALLINT": "smallint", "DOUBLE": "double",
              "FLOAT": "float", "VARCHAR": "string", "BOOLEAN": "boolean", "DATE": "date", "BLOB": "binary",
              "TIMESTAMP": "timestamp_ntz", "TIMESTAMP WITH TIME ZONE": "timestamp"}
_TYPE_SQL = (f"CASE replace(c.data_type, '[]', '') "
             f"{' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in TYPE_NAMES.items())} END")


@register("schema_catalog", f"""
WITH filled AS ({' UNION ALL '.join(
    f"SELECT '{t}' AS table_name, column_name, count(value) AS n FROM (UNPIVOT "
    f"(SELECT COLUMNS(*)::VARCHAR FROM {t}) ON COLUMNS(*) INTO NAME column_name VALUE value) "
    f"GROUP BY column_name" for t in tb.TABLES)})
SELECT c.table_name, CAST(c.ordinal_position AS INTEGER) AS ordinal, c.column_name,
       CASE WHEN c.data_type LIKE '%[]' THEN 'array<' || {_TYPE_SQL} || '>' ELSE {_TYPE_SQL} END AS type,
       c.is_nullable = 'YES' AS nullable, coalesce(filled.n, 0) AS n_values
FROM information_schema.columns c LEFT JOIN filled
  ON c.table_name = filled.table_name AND c.column_name = filled.column_name
WHERE c.table_name IN ({', '.join(f"'{t}'" for t in tb.TABLES)})""")
def schema_catalog(spark, sf):
    """(table, ordinal, column, type, nullable, non-NULL values) of every driver table: one aggregation a
    table."""
    parts = [column_catalog(name, df) for name, df in load_tables(spark, sf, tb.TABLES).items()]
    return reduce(lambda a, b: a.unionByName(b), parts)
