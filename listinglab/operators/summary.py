"""Per-airline review summary for every airline in one job.

The source's web app ran six point lookups and pandas aggregations per
selected airline. Here each part is a grouped aggregate or a window per
airline over pre-aggregated rows, joined on ``airline_id``; the join sides
are one row per airline.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import stars
from .aggregate import bar_share, dominant
from .cleaning import filter_in

SENTIMENTS = ("Positive", "Neutral", "Negative")


def airline_summary(tables: dict[str, DataFrame], sentiments: Sequence[str] = SENTIMENTS,
                    newest_first: bool = True, n_reviews: int = 5) -> DataFrame:
    info = tables["info"].select("airline_id", "name", "averating_rating", "total_review")
    attrs = tables["attribute"].groupBy("airline_id").agg(F.array_join(F.array_sort(F.collect_list(
        F.concat(F.col("attribute_name"), F.lit(": "), stars(F.col("rating")))
    )), "; ").alias("attribute_stars"))
    bars = bar_share(tables["rating"]).groupBy("airline_id").agg(
        F.max("count_int").alias("max_rating_count"), F.count(F.lit(1)).alias("rating_bars"))
    mentions = tables["mention"].groupBy("airline_id").agg(F.count("popular_mention").alias("n_mentions"))
    reviews = tables["airline_review"]
    dom = dominant(reviews, "airline_id", "Sentiment").select(
        "airline_id", F.col("top_value").alias("dominant_sentiment"), F.col("percent").alias("dominant_percent"))
    picked = filter_in(reviews, "Sentiment", list(sentiments))
    key = F.col("Information").desc_nulls_last() if newest_first else F.col("Information").asc_nulls_last()
    w = Window.partitionBy("airline_id").orderBy(key, F.col("Title").asc_nulls_last())
    top = picked.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n_reviews) \
        .groupBy("airline_id").agg(F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct("_rn", "Title"))), lambda s: s["Title"]), " | ").alias("top_titles"))
    return (info.withColumn("rating_stars", stars(F.col("averating_rating")))
            .join(attrs, "airline_id", "left").join(bars, "airline_id", "left")
            .join(mentions, "airline_id", "left").join(dom, "airline_id", "left")
            .join(top, "airline_id", "left"))
