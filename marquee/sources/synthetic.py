"""Synthetic landing derived from the driver's TPC-H-like tables.

The reference's own input file is not available, so the catalogue is built
from ``orders`` (one title per order) and its ``lineitem`` rows (packed
multi-value cells).  Every column is text, as a CSV landing would be.  The
rules (see FIXTURES.md section 3) are deterministic functions of the order key
``k`` and of the order's lines, so Spark and the DuckDB oracle
(``marquee.oracle.landing_sql``) produce the same rows.

Plan shape: lineitem is pruned to 4 numbers at the scan and shuffled once, by
order; all that follows stays where the order is.  Names come from supplier
(counted, and broadcast up to ``BROADCAST_SUPPLIERS`` rows; beyond, lines go to their
supplier and then, with names, to their order) and nation, lines of one order with the same three
values become their first one (a sorted aggregate, so an order with very many
lines streams through), the rest is packed per order and left-joined to orders
on the key the lines are already partitioned by.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The 42 platform genre labels, in order; a line's label is
# number (l_partkey % 42), 0-based.
GENRE_LABELS = (
    "TV Dramas", "Dramas", "TV Comedies", "Comedies", "TV Action & Adventure",
    "Action & Adventure", "TV Horror", "Horror Movies", "TV Thrillers", "Thrillers",
    "TV Mysteries", "TV Sci-Fi & Fantasy", "Sci-Fi & Fantasy", "Romantic TV Shows",
    "Romantic Movies", "International TV Shows", "International Movies",
    "Documentaries", "Docuseries", "Kids' TV", "Children & Family Movies",
    "Stand-Up Comedy & Talk Shows", "Stand-Up Comedy", "Independent Movies",
    "Classic & Cult TV", "Classic Movies", "Cult Movies", "Crime TV Shows",
    "Music & Musicals", "British TV Shows", "Reality TV", "Sports Movies",
    "Korean TV Shows", "Anime Series", "Spanish-Language TV Shows", "LGBTQ Movies",
    "Science & Nature TV", "Teen TV Shows", "Faith & Spirituality", "Anime Features",
    "Movies", "TV Shows",
)

# The 14 rating codes; a title's code is number (k % 15),
# 0-based, and k % 15 = 14 leaves the rating NULL.
RATING_CODES = (
    "G", "TV-G", "TV-Y", "PG", "TV-PG", "TV-Y7", "TV-Y7-FV",
    "PG-13", "TV-14", "R", "NC-17", "TV-MA", "NR", "UR",
)

# Landing defects used to make each assertion fire (FIXTURES.md section 4).
DEFECTS = (
    "dup_keys",          # T1: rows with k % 500 = 0 appear twice
    "null_keys",         # T2: show_id NULL where k % 500 = 1
    "bad_year",          # T3: release_year 'n/a' where k % 400 = 0
    "bad_duration",      # T4: duration '2 parts' where k % 300 = 0
    "bad_date",          # T5: date_added '2019-03-15' where k % 250 = 0
    "bad_type",          # T6: type 'Special' where k % 350 = 0
    "bad_rating",        # T7: rating 'XX' where k % 450 = 0
    "implausible_year",  # T10: release_year '1800' (k % 550 = 0) / '2999' (k % 550 = 1)
)

RAW_COLUMNS = (
    "show_id", "type", "title", "director", "cast", "country",
    "date_added", "release_year", "rating", "duration", "listed_in", "description",
)

# Up to so many suppliers (some 50 MB of keys and names) are broadcast, whatever
# the session's threshold; more are joined by a shuffle.
BROADCAST_SUPPLIERS = 500_000


def _first_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order and distinct (supplier name, nation, label) with the
    first line that carries them, partitioned by order."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.col("l_orderkey").alias("k"), "l_partkey", "l_suppkey", "l_linenumber")
    sup = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(
        "s_suppkey", "s_name", "s_nationkey")
    nat = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", "n_name")
    if sup.limit(BROADCAST_SUPPLIERS + 1).count() <= BROADCAST_SUPPLIERS:
        # The names come to where the orders are, so lines are shuffled once.
        li, sup = li.repartition("k"), F.broadcast(sup)
    labels = F.array(*[F.lit(x) for x in GENRE_LABELS])
    lines = (li.join(sup, li.l_suppkey == sup.s_suppkey)
               .join(nat, sup.s_nationkey == nat.n_nationkey))
    order_key = F.struct("l_linenumber", "l_partkey", "l_suppkey")
    label = F.element_at(labels, (F.col("l_partkey") % len(GENRE_LABELS)).cast("int") + 1)
    return lines.groupBy("k", "s_name", "n_name", label.alias("label")).agg(F.min(order_key).alias("o"))


def _pack_per_order(firsts: DataFrame) -> DataFrame:
    """Per order: ', '-joined distinct values of each kind, ordered by first line.

    A packed cell holds all values of its order, so one list per order is
    inherent in the landing's format; this one holds at most as many rows as
    the cell's names have labels."""
    lines = F.array_sort(F.collect_list(F.struct("o", "s_name", "n_name", "label")))
    packed = firsts.groupBy("k").agg(lines.alias("_l"))

    def joined(c: str) -> Column:
        # The first of equal values stays in place.
        return F.array_join(F.array_distinct(F.col(f"_l.{c}")), ", ")

    return packed.select(
        "k",
        joined("s_name").alias("cast_packed"),
        joined("n_name").alias("country_packed"),
        joined("label").alias("labels_packed"),
    )


def synthetic_landing(spark: SparkSession, sf_dir: str, defects=()) -> DataFrame:
    """The raw catalogue: 12 nullable text columns, one row per order
    (plus the defect rows asked for).  See FIXTURES.md for the rules."""
    unknown = set(defects) - set(DEFECTS)
    if unknown:
        raise ValueError(f"unknown defects: {sorted(unknown)}")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_orderkey").alias("k"), "o_custkey", "o_orderdate", "o_orderpriority")
    packed = _pack_per_order(_first_lines(spark, sf_dir))
    t = orders.join(packed, "k", "left")

    k = F.col("k")
    is_tv = (k % 10) < 3

    def person(i: int) -> Column:
        return F.concat(F.lit("Supplier#"),
                        F.lpad(((F.col("o_custkey") + i) % 10).cast("string"), 9, "0"))

    date_text = F.date_format(F.col("o_orderdate"), "MMMM d, yyyy")
    ratings = F.array(*[F.lit(x) for x in RATING_CODES])
    ks = k.cast("string")

    raw = t.select(
        k.alias("_k"),
        F.concat(F.lit("s"), ks).alias("show_id"),
        F.when(is_tv, F.lit("TV Show")).otherwise(F.lit("Movie")).alias("type"),
        F.concat(F.lit("Title "), ks).alias("title"),
        F.when(k % 3 == 0, F.lit(None).cast("string"))
         .when(k % 10 == 4, F.concat_ws(", ", person(0), person(7)))
         .when(k % 40 == 1, F.concat(F.lit("Guest#"), (k % 9973).cast("string")))
         .otherwise(person(0)).alias("director"),
        F.when(k % 11 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("cast_packed")).alias("cast"),
        F.when(k % 13 == 0, F.lit(None).cast("string"))
         .when(k % 97 == 0, F.concat(F.col("country_packed"), F.lit(", ")))
         .when(k % 193 == 0, F.concat(F.lit(", "), F.col("country_packed")))
         .when(k % 199 == 0, F.concat(F.col("country_packed"), F.lit(", ISLAND "), (k % 97).cast("string")))
         .otherwise(F.col("country_packed")).alias("country"),
        F.when(k % 700 == 0, F.lit(None).cast("string"))
         .when(k % 88 == 0, F.concat(F.lit(" "), date_text))
         .otherwise(date_text).alias("date_added"),
        (F.year("o_orderdate") - (k % 17) + 1).cast("string").alias("release_year"),
        F.when(k % 15 == 14, F.lit(None).cast("string"))
         .otherwise(F.element_at(ratings, (k % 15).cast("int") + 1)).alias("rating"),
        F.when(is_tv & (k % 60 == 1), F.concat((11 + k % 5).cast("string"), F.lit(" Seasons")))
         .when(is_tv & (k % 4 == 0), F.lit("1 Season"))
         .when(is_tv, F.concat((1 + k % 4).cast("string"), F.lit(" Seasons")))
         .when(k % 50 == 5, F.concat((205 + k % 61).cast("string"), F.lit(" min")))
         .otherwise(F.concat((60 + k % 120).cast("string"), F.lit(" min"))).alias("duration"),
        F.col("labels_packed").alias("listed_in"),
        F.concat(F.lit("Priority "), F.col("o_orderpriority")).alias("description"),
    )
    raw = _apply_defects(raw, set(defects))
    return raw.drop("_k")


def _apply_defects(raw: DataFrame, defects: set) -> DataFrame:
    k = F.col("_k")

    def override(col: str, cond: Column, value: str | None) -> None:
        nonlocal raw
        raw = raw.withColumn(col, F.when(cond, F.lit(value).cast("string")).otherwise(F.col(col)))

    if "null_keys" in defects:
        override("show_id", k % 500 == 1, None)
    if "implausible_year" in defects:
        override("release_year", k % 550 == 0, "1800")
        override("release_year", k % 550 == 1, "2999")
    if "bad_year" in defects:  # applied last: k % 400 wins over k % 550
        override("release_year", k % 400 == 0, "n/a")
    if "bad_duration" in defects:
        override("duration", k % 300 == 0, "2 parts")
    if "bad_date" in defects:
        override("date_added", k % 250 == 0, "2019-03-15")
    if "bad_type" in defects:
        override("type", k % 350 == 0, "Special")
    if "bad_rating" in defects:
        override("rating", k % 450 == 0, "XX")
    if "dup_keys" in defects:
        raw = raw.unionByName(raw.filter(k % 500 == 0))
    return raw
