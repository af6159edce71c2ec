"""Checkable queries over the review side (info files, reviews, HTML pages,
text functions, summary)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import aggregate as A
from ..operators import cleaning as CL
from ..operators import normalize as N
from ..operators import ordering as W
from ..operators.keys import consecutive_index
from ..operators.reviews import clean_reviews_split, info_tables, parse_info, review_tables
from ..operators.summary import airline_summary
from ..sources import files as S
from ..sources import html as H
from ..session import table, work_path
from . import fixtures as fx
from .oracle import norm_text, with_info, with_listing, with_reviews
from .registry import register


def _q(c: str):
    return F.col(f"`{c}`")


def reviews(spark: SparkSession, sf: str) -> DataFrame:
    return fx.raw_reviews(spark, sf)


def info(spark: SparkSession, sf: str) -> DataFrame:
    return fx.raw_info(spark, sf)


def review_valid(spark: SparkSession, sf: str) -> DataFrame:
    return clean_reviews_split(reviews(spark, sf))[0]


def labelled_sentiment(df: DataFrame) -> DataFrame:
    """Sentiment of a cleaned review from its star rating (class = stars-1)."""
    return df.withColumn("Sentiment", T.sentiment_bucket((F.col("Rating") - 1).cast("int")))


# ===================================================================== sources

@register("s2_read_reviews", with_reviews(
    "SELECT source AS airline, CASE WHEN e_rating IS NULL THEN 'no rating' ELSE CAST(CAST(e_rating AS INTEGER) AS VARCHAR) || '.0 of 5 bubbles' END "
    "AS rating, coalesce(title, '') AS title, sha256(coalesce(text, '')) AS review, doc_id % 4 = 0 AS no_services, count(*) AS n FROM rv GROUP BY ALL"))
def s2_read_reviews(spark, sf):
    """Every review written as multi-line CSV, a folder an airline, and read back in splits: whole rows."""
    path = work_path(spark, "reviews-csv")
    r = reviews(spark, sf).select("Rating", "Title", "Full Review", "Information", "Service Ratings", "Airline")
    (r.write.partitionBy("Airline").option("header", True).option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    back = S.read_reviews(spark, path)
    airline = F.url_decode(F.regexp_extract("source_path", r"Airline=([^/]+)", 1))
    return back.groupBy(airline.alias("airline"), F.col("Rating").alias("rating"), F.coalesce("Title", F.lit("")).alias("title"),
                        F.sha2(F.coalesce("Full Review", F.lit("")).cast("binary"), 256).alias("review"),
                        _q("Service Ratings").isNull().alias("no_services")).agg(F.count(F.lit(1)).alias("n"))


@register("s3_read_info", with_info(
    "SELECT s_name AS name, count(*) AS n FROM inf GROUP BY ALL"))
def s3_read_info(spark, sf):
    """Every source a file of its own, dealt over the cores, in one folder."""
    path = work_path(spark, "info-text")
    # A source that repeats is one file, as a folder for each would have it.
    records = info(spark, sf).groupBy("source").agg(F.array_join(F.collect_list("text"), "\n").alias("text")).select("text").repartition(4 * spark.sparkContext.defaultParallelism)
    records.write.option("maxRecordsPerFile", 1).option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(path)
    back = S.read_info(spark, path)
    parsed = back.select(T.field(F.col("text"), T.INFO_PATTERNS["name"]).alias("name"))
    return parsed.groupBy("name").agg(F.count(F.lit(1)).alias("n"))


@register("s7_html_cells", with_listing(
    "SELECT e_dep_loc AS dep_loc, e_dep_time AS dep_time, e_arr_loc AS arr_loc, e_arr_time AS arr_time, e_duration AS duration, e_aircraft AS aircraft, "
    "e_passenger AS passenger, e_price AS price, e_tax AS tax, e_total AS total, e_carry AS carry, e_checked AS checked, e_airline AS airline, "
    "e_flight AS flight, e_fare AS fare, array_to_string(e_policy, '/') AS policy, e_scrape AS scrape, count(*) AS n FROM cl GROUP BY ALL"))
def s7_html_cells(spark, sf):
    """Every listing as a detail page, its cells extracted by position and cleaned: the values of the source columns."""
    pages = fx.listing_pages(spark, sf)
    found = H.listing_rows(pages.withColumn("id", F.struct("page_id", _q("Scrape Time").alias("scrape"))), "id")
    texts = [F.nullif(_q(c), F.lit("")).alias(c) for c in H.LISTING_FIELDS]
    # The cleaner reads a list literal; the page's list is one already.
    raw = found.select(*texts, F.col("id.scrape").alias("Scrape Time"), F.array_join("Refund Policy", "/").alias("_policy"), F.lit("[]").alias("Refund Policy"))
    names = {"Departure Location": "dep_loc", "Departure Time": "dep_time", "Arrival Location": "arr_loc", "Arrival Time": "arr_time", "Flight Duration": "duration",
             "Aircraft Type": "aircraft", "Passenger Type": "passenger", "Price per Ticket": "price", "Taxes & Fees": "tax", "Total Price": "total",
             "Carry-on Baggage": "carry", "Checked Baggage": "checked", "Airline": "airline", "Flight Code": "flight", "Fare Class": "fare",
             "_policy": "policy", "Scrape Time": "scrape"}
    return CL.clean_listings(raw).select(*[_q(c).alias(n) for c, n in names.items()]).groupBy(*names.values()).agg(F.count(F.lit(1)).alias("n"))


@register("s8_html_repeated", with_reviews(
    f"SELECT doc_id // {fx.PAGE_REVIEWS} AS page_id, CAST(row_number() OVER (PARTITION BY doc_id // {fx.PAGE_REVIEWS} ORDER BY doc_id) AS INTEGER) AS pos, "
    "CASE WHEN e_rating IS NULL THEN 'no rating' ELSE CAST(CAST(e_rating AS INTEGER) AS VARCHAR) || '.0 of 5 bubbles' END AS rating, title, sha256(text) AS review, "
    "CASE WHEN doc_id % 4 = 0 THEN NULL ELSE CAST(1 + doc_id % 5 AS VARCHAR) || '.0 of 5 bubbles|Legroom;' || CAST(1 + doc_id // 5 % 5 AS VARCHAR) || '.0 of 5 bubbles|' "
    "|| ['Legroom', 'Seat comfort', 'Customer service'][doc_id % 3 + 1] END AS services FROM rv"))
def s8_html_repeated(spark, sf):
    """Pages of eight reviews: every review's fields and service ratings, in page order."""
    found = H.review_rows(fx.review_pages(spark, sf))
    services = F.array_join(F.transform(_q("Service Ratings"), lambda s: F.concat_ws("|", s["Service Rating"], s["Service Info"])), ";")
    return found.select("page_id", "pos", F.col("Rating").alias("rating"), F.col("Title").alias("title"),
                        F.sha2(_q("Full Review").cast("binary"), 256).alias("review"), services.alias("services"))


@register("s9_html_record", with_info(
    "SELECT k AS page_id, s_name AS name, '011 84 ' || CAST(1900 + k % 100 AS VARCHAR) AS phone, CAST(k AS VARCHAR) || ' Street, ' || n_name || ' Vietnam' AS address, "
    "'http://www.s' || CAST(k AS VARCHAR) || '.example.com/?a=1&b=2' AS website, 1 + (k % 9) / 2.0 AS rating, k * 37 + 100 AS reviews, "
    "CASE WHEN k % 7 = 0 THEN '' ELSE 'budget airline|hub ' || n_name || '|route ' || CAST(k % 13 AS VARCHAR) END AS mentions, "
    "CASE WHEN k % 11 = 0 THEN '' ELSE 'Cleanliness=' || CAST(1 + k % 4 AS VARCHAR) || ';Food & drink=' || CAST(1 + k % 3 AS VARCHAR) || ';Legroom=' || CAST(1 + k % 5 AS VARCHAR) END AS attributes, "
    "k * 37 % 5000 AS excellent, k * 53 % 3000 AS good FROM inf"))
def s9_html_record(spark, sf):
    """One page for each supplier: every field of its record."""
    def number(c):
        return F.translate(F.substring_index(c, " ", 1), ",", "").cast("bigint")

    found = H.info_records(fx.info_pages(spark, sf))
    attributes = F.array_join(F.array_sort(F.transform(F.map_entries("attributes"), lambda e: F.concat_ws("=", e["key"], e["value"]))), ";")
    return found.select(
        "page_id", "name", "phone", "address", F.array_join("website", "|").alias("website"), F.col("average_rating").cast("double").alias("rating"),
        number(F.col("total_review")).alias("reviews"), F.array_join("popular_mentions", "|").alias("mentions"), attributes.alias("attributes"),
        number(F.col("total_ratings")["Excellent"]).alias("excellent"), number(F.col("total_ratings")["Good"]).alias("good"))


# ================================================================== functions

_ADDR = "CAST(k AS VARCHAR) || ' Street, ' || n_name || ' Vietnam'"


@register("f1_regex_fields", with_info(
    "SELECT s_name AS name, '011 84 ' || CAST(1900 + k % 100 AS VARCHAR) || ' ' || CAST(k * 37 % 10000 AS VARCHAR) AS phone, "
    f"{_ADDR} AS address, 'http://www.s' || CAST(k AS VARCHAR) || '.example.com/' AS website FROM inf"))
def f1_regex_fields(spark, sf):
    t = F.col("text")
    p = T.INFO_PATTERNS
    return info(spark, sf).select(*[T.field(t, p[k]).alias(k) for k in ("name", "phone", "address", "website")])


@register("f2_regex_numbers", with_info(
    "SELECT CAST(1 + (k % 9) / 2.0 AS DOUBLE) AS rating, CAST(k * 37 + 100 AS INTEGER) AS total_review FROM inf"))
def f2_regex_numbers(spark, sf):
    t = F.col("text")
    p = T.INFO_PATTERNS
    return info(spark, sf).select(T.field_double(t, p["averating_rating"]).alias("rating"),
                                  T.field_int(t, p["total_review"]).alias("total_review"))


@register("f3_list_field", with_info(
    "SELECT s_name AS name, CASE WHEN k % 7 = 0 THEN '' ELSE 'budget airline|hub ' || n_name || '|route ' || "
    "CAST(k % 13 AS VARCHAR) END AS mentions, CASE WHEN k % 7 = 0 THEN 0 ELSE 3 END AS n FROM inf"))
def f3_list_field(spark, sf):
    m = T.list_field(F.col("text"))
    return info(spark, sf).select(T.field(F.col("text"), T.INFO_PATTERNS["name"]).alias("name"),
                                  F.array_join(m, "|").alias("mentions"), F.size(m).alias("n"))


@register("f4_map_field", with_info(
    "SELECT s_name AS name, CASE WHEN k % 11 = 0 THEN 0 ELSE 3 END AS n_attr, "
    "CASE WHEN k % 11 = 0 THEN NULL ELSE CAST(1 + k % 5 AS VARCHAR) || '.0 of 5 bubbles' END AS legroom, "
    "3 AS n_rating, CAST(k * 101 % 9000 + 1000 AS VARCHAR) AS terrible_raw FROM inf"))
def f4_map_field(spark, sf):
    t = F.col("text")
    a = T.map_field(t, T.INFO_PATTERNS["attributes"])
    r = T.map_field(t, T.INFO_PATTERNS["rating"])
    return info(spark, sf).select(
        T.field(t, T.INFO_PATTERNS["name"]).alias("name"), F.size(a).alias("n_attr"),
        F.element_at(a, F.lit("Legroom")).alias("legroom"), F.size(r).alias("n_rating"),
        F.replace(F.element_at(r, F.lit("Terrible")), F.lit(","), F.lit("")).alias("terrible_raw"))


@register("f5_bubbles", with_reviews("SELECT doc_id, e_rating AS rating FROM rv"))
def f5_bubbles(spark, sf):
    return reviews(spark, sf).select("doc_id", T.bubbles("Rating").alias("rating"))


@register("f6_travel_month", with_reviews(
    "SELECT doc_id, CASE WHEN info_kind = 'ok' THEN e_month END AS month FROM rv"))
def f6_travel_month(spark, sf):
    return reviews(spark, sf).select("doc_id", T.travel_month("Information").alias("month"))


@register("f7_normalize_text", f"SELECT doc_id, {norm_text('text')} AS norm FROM documents")
def f7_normalize_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.normalize_text("text").alias("norm"))


@register("f8_service_array", with_reviews(
    "SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN NULL ELSE 2 END AS n, "
    "CASE WHEN doc_id % 4 = 0 THEN NULL ELSE 'Legroom' END AS first_info FROM rv"))
def f8_service_array(spark, sf):
    s = T.service_array(_q("Service Ratings"))
    return reviews(spark, sf).select("doc_id", F.size(s).alias("n"),
                                     F.element_at(s, 1)["Service Info"].alias("first_info")) \
        .withColumn("n", F.when(F.col("n") >= 0, F.col("n")))


@register("f13_comma_int", with_info(
    "SELECT s_name AS name, CAST(k * 101 % 9000 + 1000 AS INTEGER) AS terrible FROM inf"))
def f13_comma_int(spark, sf):
    t = F.col("text")
    r = T.map_field(t, T.INFO_PATTERNS["rating"])
    return info(spark, sf).select(T.field(t, T.INFO_PATTERNS["name"]).alias("name"),
                                  T.comma_int(F.element_at(r, F.lit("Terrible"))).alias("terrible"))


def _stars_sql(r: str) -> str:
    return (f"repeat('★', CAST(floor({r}) AS INTEGER)) || CASE WHEN {r} - floor({r}) >= 0.5 THEN '⯪' ELSE '' END || "
            f"repeat('☆', 5 - CAST(floor({r}) AS INTEGER) - CASE WHEN {r} - floor({r}) >= 0.5 THEN 1 ELSE 0 END)")


_STARS_SQL = _stars_sql("r")


@register("f14_stars", with_info(
    f"SELECT s_name AS name, {_STARS_SQL} AS stars FROM (SELECT s_name, 1 + (k % 9) / 2.0 AS r FROM inf)"))
def f14_stars(spark, sf):
    t = F.col("text")
    r = T.field_double(t, T.INFO_PATTERNS["averating_rating"])
    return info(spark, sf).select(T.field(t, T.INFO_PATTERNS["name"]).alias("name"), T.stars(r).alias("stars"))


@register("f15_concat", with_reviews(
    "SELECT doc_id, coalesce('Title: ' || title || ', Review: ' || text, '') AS all_text FROM rv"))
def f15_concat(spark, sf):
    r = reviews(spark, sf)
    return r.select("doc_id", F.coalesce(T.review_text(F.col("Title"), _q("Full Review")), F.lit("")).alias("all_text"))


@register("f16_bucket", with_reviews(
    "SELECT doc_id, CASE WHEN e_rating IS NULL THEN NULL WHEN e_rating - 1 <= 2 THEN 'Negative' "
    "WHEN e_rating - 1 = 3 THEN 'Neutral' ELSE 'Positive' END AS sentiment FROM rv"))
def f16_bucket(spark, sf):
    r = reviews(spark, sf)
    return r.select("doc_id", T.sentiment_bucket((T.bubbles("Rating") - 1).cast("int")).alias("sentiment"))


# ======================================================= review normalisation

@register("n7_explode_array", with_info(
    "SELECT m AS popular_mention, airline_id FROM (SELECT airline_id, unnest(CASE WHEN k % 7 = 0 THEN [NULL::VARCHAR] "
    "ELSE ['budget airline', 'hub ' || n_name, 'route ' || CAST(k % 13 AS VARCHAR)] END) AS m FROM inf)"))
def n7_explode_array(spark, sf):
    return info_tables(parse_info(info(spark, sf)))["mention"]


@register("n8_explode_map", with_info(
    "SELECT airline_id, attribute_name, rating FROM (SELECT airline_id, unnest(['Legroom', "
    "'In-flight entertainment (WiFi, TV, movies)', 'Cleanliness']) AS attribute_name, "
    "unnest([CAST(1 + k % 5 AS DOUBLE), CAST(1 + k % 3 AS DOUBLE), CAST(1 + k % 4 AS DOUBLE)]) AS rating "
    "FROM inf WHERE k % 11 <> 0)"))
def n8_explode_map(spark, sf):
    return info_tables(parse_info(info(spark, sf)))["attribute"]


@register("n8b_ratings", with_info(
    "SELECT airline_id, rate_name, count FROM (SELECT airline_id, unnest(['Excellent', 'Good', 'Terrible']) AS rate_name, "
    "unnest([format('{:,}', k * 37 % 5000), format('{:,}', k * 53 % 3000), format('{:,}', k * 101 % 9000 + 1000)]) AS count "
    "FROM inf)"))
def n8b_ratings(spark, sf):
    return info_tables(parse_info(info(spark, sf)))["rating"]


@register("n9_explode_struct", with_reviews(
    "SELECT airline_id0 AS airline_id, svc AS service_name, r AS rating FROM (SELECT airline_id0, "
    "unnest(['Legroom', ['Legroom', 'Seat comfort', 'Customer service'][doc_id % 3 + 1]]) AS svc, "
    "unnest([CAST(1 + doc_id % 5 AS DOUBLE), CAST(1 + (doc_id // 5) % 5 AS DOUBLE)]) AS r "
    "FROM rk WHERE doc_id % 4 <> 0)"))
def n9_explode_struct(spark, sf):
    return review_tables(review_valid(spark, sf))["review_service"]


@register("n10_group_number", with_reviews(
    "SELECT source AS airline, airline_id0::INTEGER AS airline_id, count(*) AS n FROM rk GROUP BY ALL"))
def n10_group_number(spark, sf):
    v = review_valid(spark, sf)
    return v.groupBy(F.col("Airline").alias("airline"), "airline_id").agg(F.count(F.lit(1)).alias("n"))


@register("n11_owner_index", with_info("SELECT s_name AS name, airline_id::INTEGER AS airline_id FROM inf"))
def n11_owner_index(spark, sf):
    return info_tables(parse_info(info(spark, sf)))["info"].select("name", "airline_id")


# ============================================================= aggregates etc.

def _sentiment_reviews(spark, sf) -> DataFrame:
    return labelled_sentiment(review_valid(spark, sf))


_RK_SENT = ("CASE WHEN e_rating - 1 <= 2 THEN 'Negative' WHEN e_rating - 1 = 3 THEN 'Neutral' "
            "ELSE 'Positive' END")


@register("a6_dominant", with_reviews(
    "SELECT airline_id, value AS top_value, c AS top_count, total, round(c * 100.0 / total, 2)::DOUBLE AS percent FROM ("
    " SELECT airline_id0::INTEGER AS airline_id, value, c, sum(c) OVER (PARTITION BY airline_id0) AS total,"
    " row_number() OVER (PARTITION BY airline_id0 ORDER BY c DESC, value ASC) AS rn FROM ("
    f"  SELECT airline_id0, {_RK_SENT} AS value, count(*) AS c FROM rk GROUP BY ALL)) WHERE rn = 1"))
def a6_dominant(spark, sf):
    return A.dominant(_sentiment_reviews(spark, sf), "airline_id", "Sentiment")


@register("a10_bar_share", with_info(
    "SELECT airline_id, rate_name, c AS count_int, c / max(c) OVER (PARTITION BY airline_id) AS share FROM ("
    " SELECT airline_id, unnest(['Excellent', 'Good', 'Terrible']) AS rate_name,"
    " unnest([k * 37 % 5000, k * 53 % 3000, k * 101 % 9000 + 1000])::INTEGER AS c FROM inf)"))
def a10_bar_share(spark, sf):
    r = info_tables(parse_info(info(spark, sf)))["rating"]
    return A.bar_share(r).select("airline_id", "rate_name", "count_int", "share")


@register("w2_sort", with_reviews(
    "SELECT doc_id, e_month AS information, row_number() OVER (ORDER BY e_month DESC NULLS LAST, doc_id) AS rank FROM rk"))
def w2_sort(spark, sf):
    """The sorted rows with their places: ids that grow with the order of the rows, numbered."""
    v = W.sort_by(review_valid(spark, sf), "Information", ascending=False, tie=["doc_id"])
    placed = v.select("doc_id", F.col("Information").alias("information"), F.monotonically_increasing_id().alias("_place"))
    return consecutive_index(placed, [F.col("_place")], "rank").drop("_place")


@register("w3_top_n", with_reviews(
    "SELECT doc_id, e_month AS information, airline_id0::INTEGER AS airline_id FROM rk "
    "ORDER BY e_month DESC NULLS LAST, doc_id ASC LIMIT 5"))
def w3_top_n(spark, sf):
    v = review_valid(spark, sf)
    return W.top_n(v, "Information", 5, ascending=False, tie=["doc_id"]).select(
        "doc_id", F.col("Information").alias("information"), "airline_id")


@register("w3b_top_n_per_airline", with_reviews(
    "SELECT airline_id0::INTEGER AS airline_id, doc_id, rn::INTEGER AS rank FROM (SELECT airline_id0, doc_id, "
    "row_number() OVER (PARTITION BY airline_id0 ORDER BY e_month DESC NULLS LAST, doc_id) AS rn FROM rk) WHERE rn <= 5"))
def w3b_top_n_per_airline(spark, sf):
    v = review_valid(spark, sf)
    return W.top_n_per_group(v, "airline_id", "Information", 5, ascending=False, tie=["doc_id"]) \
        .select("airline_id", "doc_id", "rank")


@register("u2_union_many", with_reviews(
    "SELECT source AS airline, count(*) AS n, "
    "count(CASE WHEN CAST(substr(source, 4) AS INTEGER) % 2 = 0 THEN quality END) AS n_quality FROM rv GROUP BY ALL"))
def u2_union_many(spark, sf):
    """Frames of different columns, united by name."""
    r = reviews(spark, sf)
    even = F.regexp_extract("Airline", r"(\d+)$", 1).try_cast("int") % 2 == 0
    u = W.union_all(r.where(even).drop("toxic"), r.where(~even).drop("quality"))
    return u.groupBy(F.col("Airline").alias("airline")).agg(F.count(F.lit(1)).alias("n"), F.count("quality").alias("n_quality"))


@register("p21_source_tag", with_reviews(
    "SELECT CASE WHEN source IN ('src0', 'src1') THEN 'Group A' ELSE 'Other' END AS tag, count(*) AS n FROM rv GROUP BY ALL"))
def p21_source_tag(spark, sf):
    r = reviews(spark, sf)
    tag = CL.source_from_path(F.concat(F.lit("/reviews/"), F.col("Airline"), F.lit("_all_reviews.csv")),
                              {"/src0_": "Group A", "/src1_": "Group A"})
    t = CL.with_source(r, F.coalesce(tag, F.lit("Other")), "tag")
    return t.groupBy("tag").agg(F.count(F.lit(1)).alias("n"))


# ======================================================================= flows

@register("l4_info", with_info(
    "SELECT s_name AS name, '011 84 ' || CAST(1900 + k % 100 AS VARCHAR) || ' ' || CAST(k * 37 % 10000 AS VARCHAR) AS phone, "
    f"{_ADDR} AS address, 'http://www.s' || CAST(k AS VARCHAR) || '.example.com/' AS website, "
    "CAST(1 + (k % 9) / 2.0 AS DOUBLE) AS averating_rating, CAST(k * 37 + 100 AS INTEGER) AS total_review, airline_id::INTEGER AS airline_id FROM inf"))
def l4_info(spark, sf):
    from .flows import run_info_etl

    return run_info_etl(info(spark, sf))["info"]


@register("l5_reviews", with_reviews(
    f"SELECT e_rating AS rating, {norm_text('title')} AS title, {norm_text('text')} AS full_review, "
    "e_month AS information, airline_id0::INTEGER AS airline_id FROM rk"))
def l5_reviews(spark, sf):
    from .flows import run_review_etl

    t = run_review_etl(reviews(spark, sf))["airline_review"]
    return t.select(F.col("Rating").alias("rating"), F.col("Title").alias("title"),
                    _q("Full Review").alias("full_review"), F.col("Information").alias("information"), "airline_id")


@register("m19_summary", with_info(
    "SELECT i.airline_id::INTEGER AS airline_id, i.s_name AS name, "
    f"{_stars_sql('x.r')} AS rating_stars, "
    "CASE WHEN k % 7 = 0 THEN 0 ELSE 3 END AS n_mentions, "
    "CASE WHEN k % 11 = 0 THEN NULL ELSE 3 END AS rating_attrs "
    "FROM inf i, (SELECT k AS kk, 1 + (k % 9) / 2.0 AS r FROM inf) x WHERE x.kk = i.k"))
def m19_summary(spark, sf):
    it = info_tables(parse_info(info(spark, sf)))
    rv = _sentiment_reviews(spark, sf)
    # reviews of source ``srcN`` belong to the info record with airline_id N
    rv = rv.withColumn("airline_id", F.regexp_extract("Airline", r"(\d+)$", 1).cast("int"))
    tables = dict(it)
    tables["airline_review"] = rv
    s = airline_summary(tables)
    attrs = it["attribute"].groupBy("airline_id").agg(F.count(F.lit(1)).alias("rating_attrs"))
    return s.join(attrs, "airline_id", "left").select(
        "airline_id", "name", "rating_stars", F.coalesce("n_mentions", F.lit(0)).alias("n_mentions"),
        F.col("rating_attrs").cast("int").alias("rating_attrs"))


@register("m19b_summary_reviews", with_reviews(
    "SELECT CAST(regexp_extract(source, '(\\d+)$', 1) AS INTEGER) AS airline_id, "
    "value AS dominant_sentiment, round(c * 100.0 / total, 2)::DOUBLE AS dominant_percent FROM ("
    " SELECT source, value, c, sum(c) OVER (PARTITION BY source) AS total,"
    " row_number() OVER (PARTITION BY source ORDER BY c DESC, value ASC) AS rn FROM ("
    f"  SELECT source, {_RK_SENT} AS value, count(*) AS c FROM rk GROUP BY ALL)) WHERE rn = 1 "
    "AND CAST(regexp_extract(source, '(\\d+)$', 1) AS INTEGER) IN (SELECT row_number() OVER (ORDER BY s_name) - 1 FROM supplier)"))
def m19b_summary_reviews(spark, sf):
    it = info_tables(parse_info(info(spark, sf)))
    rv = _sentiment_reviews(spark, sf).withColumn("airline_id", F.regexp_extract("Airline", r"(\d+)$", 1).cast("int"))
    tables = dict(it)
    tables["airline_review"] = rv
    s = airline_summary(tables)
    return s.where(F.col("dominant_sentiment").isNotNull()).select("airline_id", "dominant_sentiment", "dominant_percent")
