"""Airline info and review tables (L4/L5 building blocks, N7-N11 applied)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .cleaning import partition_rejects
from .keys import consecutive_index
from .normalize import explode_array, group_number, make_service_ratings


def parse_info(info: DataFrame, text_col: str = "text", order_col: str = "source") -> DataFrame:
    """F1-F4 over key/value texts + owner id (position in ``order_col`` order)."""
    t = F.col(text_col)
    p = T.INFO_PATTERNS
    parsed = info.select(
        F.col(order_col),
        T.field(t, p["name"]).alias("name"),
        T.field(t, p["phone"]).alias("phone"),
        T.field(t, p["address"]).alias("address"),
        T.field(t, p["website"]).alias("website"),
        T.field_double(t, p["averating_rating"]).alias("averating_rating"),
        T.field_int(t, p["total_review"]).alias("total_review"),
        T.list_field(t, p["popular_mention"]).alias("popular_mention"),
        T.map_field(t, p["attributes"]).alias("attributes"),
        T.map_field(t, p["rating"]).alias("rating"),
    )
    return consecutive_index(parsed, [F.col(order_col)], "airline_id", start=0) \
        .withColumn("airline_id", F.col("airline_id").cast("int"))


def info_tables(parsed: DataFrame) -> dict[str, DataFrame]:
    """L4 output: INFO, MENTION, RATING, ATTRIBUTE."""
    from .normalize import make_attributes, make_ratings

    return {
        "info": parsed.select("name", "phone", "address", "website", "averating_rating", "total_review", "airline_id"),
        "mention": explode_array(parsed, "airline_id", "popular_mention", "popular_mention"),
        "rating": make_ratings(parsed),
        "attribute": make_attributes(parsed),
    }


def review_rules() -> dict:
    """Rows the source aborts on: rating without ``x.y of``, unreadable month."""
    return {
        "rating": F.col("Rating").isNull(),
        "travel_month": F.col("_raw_info").isNotNull() & F.col("Information").isNull(),
    }


def clean_reviews_split(reviews: DataFrame, airline_col: str = "Airline") -> tuple[DataFrame, DataFrame]:
    """F5 -> P19 -> F6 -> F7 -> airline id (N10), with rejects.

    Returns (clean reviews incl. parsed ``Service Ratings``, rejects)."""
    r = reviews.where(F.col("Information").isNotNull())        # P19
    r = r.withColumns({
        "_raw_info": F.col("Information"),
        "Rating": T.bubbles("Rating"),
        "Information": T.travel_month("Information"),
        "Title": T.normalize_text("Title"),
        "Full Review": T.normalize_text(F.col("`Full Review`")),
        "Service Ratings": T.service_array(F.col("`Service Ratings`")),
    })
    valid, rejects = partition_rejects(r, review_rules())
    valid = group_number(valid.drop("_raw_info"), airline_col, "airline_id").withColumn(
        "airline_id", F.col("airline_id").cast("int"))
    return valid, rejects.drop("_raw_info")


def review_tables(valid: DataFrame, airline_col: str = "Airline") -> dict[str, DataFrame]:
    """L5 output: AIRLINE_REVIEW and REVIEW_SERVICE."""
    return {
        "airline_review": valid.select("Rating", "Title", "Full Review", "Information", "airline_id"),
        "review_service": make_service_ratings(valid, "airline_id", "Service Ratings"),
    }
