"""Edge fixtures (invented rows, hand-computed answers) for the semantics that bite."""

import datetime as dt
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.logic import bucketize, coalesce_default, safe_ratio
from tessera.functions.text import clean_text
from tessera.functions.time import iso_parse
from tessera.operators.aggregate import count_by, explode_labels, metric_table, pivot_mean
from tessera.operators.filters import clean_score, filter_year, split_malformed
from tessera.operators.joins import exclude_values, lookup
from tessera.operators.rank import first_per_bucket, global_rank, top_n_per_group
from tessera.plans import commerce as C
from tessera.plans import ratings as R
from tessera.plans import reviews as RV
from tessera.sources.text import read_delimited, read_word_list, short_lines


def _write(path, name, text):
    p = os.path.join(path, name)
    with open(p, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return p


# --- sources ------------------------------------------------------------------------------------

MOVIE_SCHEMA = T.StructType([T.StructField("movie", T.StringType()), T.StructField("title", T.StringType()),
                             T.StructField("genres", T.StringType())])
RATING_SCHEMA = T.StructType([T.StructField("user", T.StringType()), T.StructField("movie", T.StringType()),
                              T.StructField("rating", T.DoubleType()), T.StructField("ts", T.LongType())])


def test_read_delimited_trims_and_skips_short_rows(spark, tmp_dir):
    p = _write(tmp_dir, "films.txt",
               "71, Paper Harbour (2011), Mystery|Musical\n"
               "\n"
               "72,The Glass Orchard (1958),Western\n"
               "73, Only Two Fields\n")
    rows = read_delimited(spark, p, MOVIE_SCHEMA, min_fields=3).orderBy("movie").collect()
    assert [(r.movie, r.title, r.genres) for r in rows] == [
        ("71", "Paper Harbour (2011)", "Mystery|Musical"),
        ("72", "The Glass Orchard (1958)", "Western")]
    short = short_lines(spark, p, 3).collect()
    assert [(r.line, r.n_fields) for r in short] == [("73, Only Two Fields", 2)]


def test_min_fields_counts_fields_not_values(spark, tmp_dir):
    p = _write(tmp_dir, "films.txt", "1,,Comedy\n2,A,\n3\n4,B,Drama,extra\n,,\n")
    rows = read_delimited(spark, p, MOVIE_SCHEMA, min_fields=3).collect()
    assert sorted((r.movie or "", r.title or "", r.genres or "") for r in rows) == [
        ("", "", ""), ("1", "", "Comedy"), ("2", "A", ""), ("4", "B", "Drama")]
    p = _write(tmp_dir, "marks.txt", "1,10,abc,77\n2,11,4.5,x\n3,12,1.0\n")
    rows = read_delimited(spark, p, RATING_SCHEMA, min_fields=4).orderBy("user").collect()
    assert [tuple(r) for r in rows] == [("1", "10", None, 77), ("2", "11", 4.5, None)]
    rows = read_delimited(spark, p, RATING_SCHEMA, min_fields=3).orderBy("user").collect()
    assert [r.user for r in rows] == ["1", "2", "3"]
    p = _write(tmp_dir, "quoted.txt", '1,"a,b"\n2,"a,b",Drama\n')
    rows = read_delimited(spark, p, MOVIE_SCHEMA, min_fields=3, quote=None).collect()
    assert [tuple(r) for r in rows] == [("2", "a,b", "Drama")]
    assert [r.n_fields for r in short_lines(spark, p, 3, quote=None).collect()] == [2]


def test_read_delimited_flags_shifted_rows(spark, tmp_dir):
    p = _write(tmp_dir, "movies.txt", "1,Quay,Noir\n2,Salt, Ash and Rain (1994),Epic\n")
    rows = read_delimited(spark, p, MOVIE_SCHEMA, flag_surplus="shifted").orderBy("movie").collect()
    assert [(r.movie, r.title, r.genres, r.shifted) for r in rows] == [
        ("1", "Quay", "Noir", False), ("2", "Salt", "Ash and Rain (1994)", True)]


def test_read_delimited_bad_number_is_null(spark, tmp_dir):
    p = _write(tmp_dir, "ratings.txt", "1, 10, abc, 31\n2, 10, 4.5, 32\n")
    rows = read_delimited(spark, p, RATING_SCHEMA).orderBy("user").collect()
    assert rows[0].rating is None and rows[1].rating == 4.5


def test_semicolon_without_quoting(spark, tmp_dir):
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("review", T.StringType()),
                           T.StructField("category", T.StringType())])
    p = _write(tmp_dir, "reviews.csv", '1;He said "great;GENERAL;extra\nx2;short\n3;ok;ROOMS\n')
    rows = read_delimited(spark, p, schema, sep=";", trim=False, quote="").collect()
    assert [tuple(r) for r in rows] == [(1, 'He said "great', "GENERAL"), (None, "short", None),
                                        (3, "ok", "ROOMS")]


def test_word_list_strips_cr_blank_and_duplicates(spark, tmp_dir):
    p = _write(tmp_dir, "stop.txt", "the\r\nof\r\n\r\nthe\nchúng tôi\n")
    words = sorted(r.word for r in read_word_list(spark, p).collect())
    assert words == ["chúng tôi", "of", "the"]


# --- buckets and conditionals -------------------------------------------------------------------

def test_bucket_conventions_differ_at_edges(spark):
    ages = [17, 18, 34, 35, 36, 49, 50, 51, None]
    df = spark.createDataFrame([(a,) for a in ages], "age int")
    got = df.select("age", R.age_bucket("age", "left").alias("l"),
                    R.age_bucket("age", "right").alias("r")).collect()
    by_age = {r.age: (r.l, r.r) for r in got}
    assert by_age[17] == ("0-18", "Under 18")
    assert by_age[18] == ("18-35", "18-35")
    assert by_age[35] == ("35-50", "18-35")
    assert by_age[36] == ("35-50", "36-50")
    assert by_age[50] == ("50+", "36-50")
    assert by_age[51] == ("50+", "50+")
    assert by_age[None] == (None, None)


def test_bucketize_requires_labels(spark):
    import pytest
    with pytest.raises(ValueError):
        bucketize("x", [1, 2], ["a"], "left")


def test_safe_ratio_and_defaults(spark):
    df = spark.createDataFrame([(3, 0, ""), (3, 4, None), (1, 2, "cam")], "n long, d int, c string")
    rows = df.select(safe_ratio("n", "d", 4).alias("f"), coalesce_default("c", "unknown").alias("c")).collect()
    assert [(r.f, r.c) for r in rows] == [(3.0, "unknown"), (0.75, "unknown"), (0.5, "cam")]


# --- scores, counts, distinct metrics -----------------------------------------------------------

def test_clean_score_accepts_only_1_to_5(spark):
    df = spark.createDataFrame([(1, None), (2, "0"), (3, "6"), (4, "abc"), (5, "4.0"), (6, "5"), (7, "4.7")],
                               "id int, s string")
    got = sorted((r.id, r.s) for r in clean_score(df, "s").collect())
    assert got == [(5, 4), (6, 5)]


def test_count_by_skips_null_ids(spark):
    df = spark.createDataFrame([(1, "A"), (None, "A"), (2, "B")], "id int, cat string")
    got = {r.cat: r["count"] for r in count_by(df, "cat", "id").collect()}
    assert got == {"A": 1, "B": 1}


def test_metric_table_counts_null_once(spark):
    df = spark.createDataFrame([(1,), (None,), (1,), (None,)], "x int")
    row = metric_table({"xs": (df, "x")}).collect()[0]
    assert (row.metric, row.value) == ("xs", 2)
    assert metric_table({"xs": (df, "x")}, count_null=False).collect()[0].value == 1
    empty = df.where("x > 100")
    assert metric_table({"xs": (empty, "x")}).collect()[0].value == 0


# --- joins --------------------------------------------------------------------------------------

def test_full_outer_keeps_both_orphans(spark):
    movies = spark.createDataFrame([("m1", "A"), ("m2", "B")], "movie string, title string")
    ratings = spark.createDataFrame([("u", "m1", 4.0), ("u", "m9", 2.0)], "user string, movie string, rating double")
    out = {r.movie: (r.title, r.mean_rating, r.n_ratings)
           for r in R.movie_mean_count([ratings], movies).collect()}
    assert out == {"m1": ("A", 4.0, 1), "m2": ("B", None, 0), "m9": ("", 2.0, 1)}


def test_lookup_default_unknown(spark):
    users = spark.createDataFrame([("u1", "1"), ("u2", "99")], "user string, occ string")
    occ = spark.createDataFrame([("1", "Programmer"), ("1", "Artist")], "id string, name string")
    got = {r.user: r.name for r in lookup(users, occ, ("occ", "id"), "name").collect()}
    assert got == {"u1": "Programmer", "u2": "Unknown"}


def test_exclude_values_list_and_frame(spark):
    toks = spark.createDataFrame([("the",), ("hotel",), ("chúng tôi",)], "word string")
    assert sorted(r.word for r in exclude_values(toks, "word", ["the", "chúng tôi"]).collect()) == ["hotel"]
    stop = spark.createDataFrame([("hotel",), ("hotel",)], "w string")
    assert sorted(r.word for r in exclude_values(toks, "word", stop, "w").collect()) == ["chúng tôi", "the"]


def test_bridge_join_fans_out_k_times_r(spark):
    from tessera.operators.joins import bridge_join
    items = spark.createDataFrame([("o1", "p1"), ("o1", "p2"), ("o1", "p1"), ("o2", "p3")],
                                  "order_id string, product_id string")
    reviews = spark.createDataFrame([("o1", 5), ("o1", 3)], "order_id string, score int")
    got = sorted(tuple(r) for r in bridge_join(items, reviews, ["order_id", "product_id"], "order_id")
                 .select("product_id", "score").collect())
    assert got == [("p1", 3), ("p1", 5), ("p2", 3), ("p2", 5)]


# --- pivots and multi-label ---------------------------------------------------------------------

def test_pivot_ignores_unlisted_values_and_fills_default(spark):
    df = spark.createDataFrame([("m1", "M", 4.0), ("m1", "X", 1.0), ("m1", "m", 1.0), ("m2", "F", 3.0)],
                               "movie string, g string, r double")
    got = {r.movie: (r.male, r.female)
           for r in pivot_mean(df, "movie", "g", {"M": "male", "F": "female"}, "r", 0.0).collect()}
    assert got == {"m1": (4.0, 0.0), "m2": (0.0, 3.0)}


def test_explode_labels_drops_empty_labels(spark):
    df = spark.createDataFrame([("Drama||War",), ("Comedy|",), (None,)], "g string")
    assert sorted(r.label for r in explode_labels(df, "g").collect()) == ["Comedy", "Drama", "War"]


# --- text ---------------------------------------------------------------------------------------

def test_clean_text_rules(spark):
    import unicodedata
    nfd = unicodedata.normalize("NFD", "câu")
    df = spark.createDataFrame([("Phòng  rất; đẹp!!",), (nfd,)], "t string")
    got = [r.c for r in df.select(clean_text("t").alias("c")).collect()]
    assert got[0] == "phòng rất đẹp"
    assert got[1] == "ca u"  # combining mark is not a letter: NFD text splits (NFC is the caller's job)


def test_top_words_ties_break_alphabetically(spark):
    rows = [(1, "b a c", "X"), (2, "a b d", "X"), (3, "e", "Y")]
    df = spark.createDataFrame(rows, "id int, review string, category string")
    got = [(r.category, r.word, r.freq) for r in
           RV.top_words(df, [], n=2).orderBy("category", "freq", "word").collect()]
    assert got == [("X", "a", 2), ("X", "b", 2), ("Y", "e", 1)]


# --- time ---------------------------------------------------------------------------------------

def test_gap_rounding_decides_status(spark):
    base = dt.datetime(2024, 1, 1, 12, 0, 0)
    df = spark.createDataFrame([(1, base + dt.timedelta(seconds=400), base),
                                (2, base + dt.timedelta(seconds=500), base)],
                               "order_id int, delivered_ts timestamp, limit_ts timestamp")
    items = df.select("order_id", F.lit(1).alias("item_ordinal"), F.lit("s").alias("seller_id"))
    detail, _ = C.delivery_gaps(df.select("order_id", "delivered_ts", "limit_ts"), items)
    got = {r.order_id: (r.gap_days, r.status) for r in detail.collect()}
    assert got == {1: (0.0, C.STATUS_ON_TIME), 2: (0.01, C.STATUS_LATE)}


def test_iso_parse_offsets_and_fallback(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00Z",), ("2024-01-01T07:00:00+07:00",), ("",),
                                ("not a time",), (None,)], "s string")
    fb = F.lit("1999-01-01 00:00:00").cast("timestamp")
    got = [r.t for r in df.select(F.date_format(iso_parse("s", fb), "yyyy-MM-dd HH:mm").alias("t")).collect()]
    assert got == ["2024-01-01 00:00", "2024-01-01 00:00", "1999-01-01 00:00", "1999-01-01 00:00",
                   "1999-01-01 00:00"]


def test_filter_year_is_pushed_as_range(spark, tmp_dir):
    df = spark.createDataFrame([(1, dt.datetime(2023, 12, 31, 23, 59, 59)), (2, dt.datetime(2024, 1, 1)),
                                (3, dt.datetime(2024, 12, 31, 23, 59, 59)), (4, dt.datetime(2025, 1, 1))],
                               "id int, ts timestamp_ntz")
    df.write.parquet(os.path.join(tmp_dir, "t"))
    t = spark.read.parquet(os.path.join(tmp_dir, "t"))
    out = filter_year(t, "ts", 2024)
    assert sorted(r.id for r in out.collect()) == [2, 3]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


def test_split_malformed_routes_rejects(spark):
    df = spark.createDataFrame([("1",), ("x",), ("3",)], "n string")
    good, bad = split_malformed(df, {"n": "int"})
    assert sorted(r.n for r in good.collect()) == [1, 3]
    assert [r.n for r in bad.collect()] == ["x"]


# --- commerce -----------------------------------------------------------------------------------

def test_segments_every_branch(spark):
    ts = dt.datetime(2024, 1, 1)
    orders = spark.createDataFrame(
        [("o1", "vip", ts), ("o2", "vip", ts + dt.timedelta(days=10)), ("o3", "vip", ts + dt.timedelta(days=20)),
         ("o4", "rep", ts), ("o5", "rep", ts),
         ("o6", "high", ts), ("o7", "reg", ts), ("o8", "none", ts)],
        "order_id string, customer_id string, purchase_ts timestamp")
    items = spark.createDataFrame(
        [("o1", 150.0, 60.0), ("o2", 200.0, 10.0), ("o3", 300.0, 0.0), ("o4", 10.0, 1.0), ("o5", 10.0, 1.0),
         ("o6", 250.0, 0.0), ("o7", 20.0, 0.0)], "order_id string, price double, freight double")
    customers = spark.createDataFrame([(c, "VN", "HN") for c in ("vip", "rep", "high", "reg", "none")],
                                      "customer_id string, country string, city string")
    seg = {r.customer_id: r for r in C.customer_segments(orders, items, customers).collect()}
    assert seg["vip"].segment == C.SEGMENT_VIP and seg["vip"].span_days == 20
    assert seg["vip"].frequency == 0.15
    assert seg["rep"].segment == C.SEGMENT_REPEAT and seg["rep"].frequency == 2.0
    assert seg["high"].segment == C.SEGMENT_HIGH_VALUE
    assert seg["reg"].segment == C.SEGMENT_REGULAR
    assert seg["none"].avg_order_value is None and seg["none"].segment == C.SEGMENT_REGULAR


def test_seller_ranking_ties(spark):
    items = spark.createDataFrame(
        [("o1", 1, "s2", 10.0, 0.0), ("o2", 1, "s1", 10.0, 0.0), ("o3", 1, "s3", 5.0, 5.0),
         ("o4", 1, "s4", 30.0, 0.0)],
        "order_id string, item_ordinal int, seller_id string, price double, freight double")
    got = [(r.seller_rank, r.seller_id) for r in C.seller_ranking(items).orderBy("seller_rank").collect()]
    assert got == [(1, "s4"), (2, "s1"), (3, "s2"), (4, "s3")]


def test_global_rank_equals_row_number_for_any_partitioning(spark):
    from pyspark.sql import Window
    df = spark.range(0, 500).select((F.col("id") * 7919 % 101).alias("v"), F.col("id"))
    order = [F.col("v").desc(), F.col("id").asc()]
    want = {r.id: r.rn for r in df.select("id", F.row_number().over(Window.orderBy(*order)).alias("rn")).collect()}
    for n in (1, 3, 8):
        got = {r.id: r.rank for r in global_rank(df, order, "rank", num_partitions=n).collect()}
        assert got == want


def test_first_per_bucket_all_rows_and_winners(spark):
    t = dt.datetime(2024, 1, 1, 9, 0, 0)
    rows = [("cam", "f2", t + dt.timedelta(milliseconds=500)), ("cam", "f1", t + dt.timedelta(milliseconds=100)),
            ("cam", "f3", t + dt.timedelta(seconds=1)), ("cam2", "f4", t), (None, "f5", t), (None, "f6", t)]
    df = spark.createDataFrame(rows, "camera string, frame string, ts timestamp") \
        .withColumn("sec", F.date_trunc("second", "ts"))
    flags = {r.frame: r.is_first for r in first_per_bucket(df, ["camera", "sec"], ["ts", "frame"]).collect()}
    assert flags == {"f1": True, "f2": False, "f3": True, "f4": True, "f5": True, "f6": False}
    winners = sorted(r.frame for r in first_per_bucket(df, ["camera", "sec"], ["ts", "frame"],
                                                       winners_only=True).collect())
    assert winners == ["f1", "f3", "f4", "f5"]


def test_top_n_per_group_bounded(spark):
    df = spark.range(0, 100).select((F.col("id") % 3).alias("g"), F.col("id"))
    out = top_n_per_group(df, "g", [F.col("id").desc()], 4).collect()
    assert len(out) == 12
    assert {r.id for r in out if r.g == 0} == {99, 96, 93, 90}


# --- sinks --------------------------------------------------------------------------------------

def test_write_lines_refuses_existing_target(spark, tmp_dir):
    import pytest
    from tessera.sinks.files import write_lines
    df = spark.createDataFrame([("Heat", 4.125, 2)], "t string, m double, n long")
    path = os.path.join(tmp_dir, "out")
    write_lines(df, "%-6s %.2f %d", ["t", F.round("m", 2), "n"], path)
    assert [r.value for r in spark.read.text(path).collect()] == ["Heat   4.13 2"]
    with pytest.raises(Exception):
        write_lines(df, "%s", ["t"], path)


def test_single_csv_is_one_file(spark, tmp_dir):
    from tessera.sinks.files import write_single_csv
    path = os.path.join(tmp_dir, "one")
    write_single_csv(spark.range(0, 5000, 1, 7), path)
    assert len([f for f in os.listdir(path) if f.startswith("part-")]) == 1
    assert spark.read.option("header", True).csv(path).count() == 5000


# --- money ----------------------------------------------------------------------------------------

def _lines(spark, rows):
    return spark.createDataFrame(rows, "order_id string, item_ordinal int, seller_id string, "
                                       "price double, freight double")


def test_small_amounts_are_not_lost(spark):
    rows = [(f"o{i}", 1, "s", 0.004, 0.0) for i in range(1000)]
    got = C.seller_ranking(_lines(spark, rows)).collect()[0]
    assert (got.revenue, got.avg_line_revenue, got.n_items) == (4.0, 0.0, 1000)


def test_nan_amount_does_not_fail(spark):
    import math
    rows = [("o1", 1, "s1", float("nan"), 1.0), ("o2", 1, "s2", 2.0, 1.0)]
    got = {r.seller_id: r.revenue for r in C.seller_ranking(_lines(spark, rows)).collect()}
    assert math.isnan(got["s1"]) and got["s2"] == 3.0


def test_percentiles_equal_the_sorted_list(spark):
    import random
    import statistics
    from tessera.operators.rank import exact_percentiles
    rng = random.Random(1)
    rows = [("hot", rng.randrange(40)) for _ in range(900)] + [("a", 5), (None, 1), (None, 4), ("b", None)]
    df = spark.createDataFrame(rows, "k string, v long").repartition(5)
    got = {r.k: (r.low, r.mid, r.high) for r in
           exact_percentiles(df, ["k"], "v", {"low": 0.0, "mid": 0.5, "high": 0.99}).collect()}
    hot = sorted(v for k, v in rows if k == "hot")
    at = 0.99 * 899
    high = hot[int(at)] * (1 - at % 1) + hot[int(at) + 1] * (at % 1)
    assert got["hot"][:2] == (hot[0], statistics.median(hot)) and abs(got["hot"][2] - high) < 1e-9
    assert got["a"] == (5, 5, 5) and got[None][:2] == (1, 2.5) and "b" not in got
