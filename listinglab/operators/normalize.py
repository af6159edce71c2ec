"""Dimension / fact table makers (N1-N13) and key lookups.

Surrogate keys never come from a global sort of the fact: the distinct keys
are aggregated first (a partial+final hash aggregate, map-side combined) and
numbered on that small table; the ids reach the fact through a join that
Spark plans from measured sizes.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import dim_id
from ..functions.text import bubbles
from ..schemas import SCHEDULE_COLUMNS, SCHEDULE_KEY, TICKET_COLUMNS
from .keys import consecutive_index
from .ordering import union_distinct

def _q(c: str):
    return F.col(f"`{c}`")


def make_airports(df: DataFrame) -> DataFrame:
    """Distinct (code, location) of departures UNION arrivals, distinct.

    The pairs of places that occur are found first, so the rows are read once."""
    pairs = df.select(*[_q(f"{side} Location{code}") for side in ("Departure", "Arrival") for code in (" Code", "")]).distinct()
    dep, arr = (pairs.select(_q(f"{side} Location Code").alias("AirportCode"), _q(f"{side} Location").alias("Location")) for side in ("Departure", "Arrival"))
    return union_distinct(dep, arr)


def make_airlines(df: DataFrame, registry: DataFrame | None = None,
                  order_col: str = "Scrape Time", name_col: str = "Airline") -> DataFrame:
    """Airline dimension with ids ``AL001...`` in order of first appearance.

    First appearance = earliest ``order_col`` (ties by name), a stable rule
    instead of file row order. With a ``registry`` (the existing AIRLINE
    table) known names keep their id and new names continue at max+1, so ids
    never change between runs. The numbering window runs over the distinct
    names only (one row per airline), never over the fact.
    """
    firsts = df.groupBy(_q(name_col).alias("Airline")).agg(F.min(_q(order_col)).alias("_first"))
    if registry is not None:
        known = registry.select("Airline")
        firsts = firsts.join(known, firsts.Airline.eqNullSafe(known.Airline), "left_anti")
        base = registry.select(F.max(F.regexp_extract("Airline_id", r"(\d+)$", 1).cast("int")).alias("_base"))
    else:
        base = firsts.sparkSession.range(1).select(F.lit(0).alias("_base"))
    numbered = consecutive_index(firsts, [F.col("_first").asc_nulls_last(), F.col("Airline").asc_nulls_last()], "_n")
    # ``base`` is a one-row aggregate (max existing id).
    new = (numbered.crossJoin(F.broadcast(base.select(F.coalesce("_base", F.lit(0)).alias("_base"))))
           .select(dim_id(F.col("_n") + F.col("_base")).alias("Airline_id"), "Airline"))
    if registry is not None:
        return registry.select("Airline_id", "Airline").unionByName(new)
    return new


def key_lookup(fact: DataFrame, dim: DataFrame, on: str, out: str | None = None) -> DataFrame:
    """Left join a dimension on a name, NULL matching NULL (``eqNullSafe``).

    Spark broadcasts the dimension where its measured bytes are below the
    threshold; otherwise both sides shuffle on the key."""
    d = dim.withColumnRenamed(on, "_k")
    j = fact.join(d, fact[f"`{on}`"].eqNullSafe(d["_k"]), "left").drop("_k")
    return j.drop(on) if out is None else j


def make_policies(df: DataFrame, airlines: DataFrame) -> DataFrame:
    """Distinct (airline, fare, policy) with the airline id joined on.

    The distinct triples by name are few; the lookup and the distinct by id
    read only them."""
    trip = df.select("Airline", "Fare Class", "Refund Policy").distinct()
    return key_lookup(trip, airlines, "Airline").select("Airline_id", "Fare Class", "Refund Policy").distinct()


def make_schedules(df: DataFrame) -> DataFrame:
    """Distinct flight schedules (7 columns)."""
    return df.select(*[_q(c) for c in SCHEDULE_COLUMNS]).distinct()


def make_tickets(df: DataFrame, airlines: DataFrame) -> DataFrame:
    """Fact rows: every remaining column + airline id, distinct.

    Equivalent to the source's distinct -> lookup -> drop -> distinct: the
    first distinct cannot change the final distinct set, so the fact is
    shuffled once: by the schedule's key, which serves the join with it too."""
    keep = [c for c in TICKET_COLUMNS if c != "Airline_id"] + ["Airline"]
    rest = df.select(*[_q(c) for c in keep])
    return key_lookup(rest, airlines, "Airline").select(*[_q(c) for c in TICKET_COLUMNS]).repartition(*[_q(c) for c in SCHEDULE_KEY]).distinct()


def normalize(df: DataFrame, registry: DataFrame | None = None) -> dict[str, DataFrame]:
    """All five tables from one cleaned input.

    The airline dimension is numbered once, on a checkpointed table; the
    input feeds five plans, so read it from a written table (as
    :func:`listinglab.plans.flows.run_listing_etl` does) when materialising
    all five. Nothing stays cached.
    """
    airlines = make_airlines(df, registry)
    return {
        "airport": make_airports(df),
        "airline": airlines,
        "refund_policy": make_policies(df, airlines),
        "flight_schedule": make_schedules(df),
        "ticket": make_tickets(df, airlines),
    }


# ------------------------------------------------------------ review side

def explode_array(df: DataFrame, owner: str, col: str, out: str) -> DataFrame:
    """One row per array element, owner kept; empty array -> one NULL row."""
    return df.select(F.explode_outer(_q(col)).alias(out), _q(owner))


def explode_map(df: DataFrame, owner: str, col: str, key: str, value: str) -> DataFrame:
    """(owner, key, value) per map entry; empty map -> no row."""
    return df.select(_q(owner), F.explode(_q(col)).alias(key, value))


def make_ratings(info: DataFrame, owner: str = "airline_id") -> DataFrame:
    """RATING(airline_id, rate_name, count) — count stays text."""
    return explode_map(info, owner, "rating", "rate_name", "count")


def make_attributes(info: DataFrame, owner: str = "airline_id") -> DataFrame:
    """ATTRIBUTE(airline_id, attribute_name, rating as double)."""
    m = explode_map(info, owner, "attributes", "attribute_name", "_r")
    return m.select(owner, "attribute_name", bubbles("_r").alias("rating"))


def make_service_ratings(df: DataFrame, owner: str = "airline_id", col: str = "Service Ratings") -> DataFrame:
    """(owner, service_name, rating) per struct of the array column."""
    e = df.where(_q(col).isNotNull()).select(_q(owner), F.explode(_q(col)).alias("_s"))
    return e.select(owner, F.col("_s.`Service Info`").alias("service_name"),
                    bubbles(F.col("_s.`Service Rating`")).alias("rating"))


def group_number(df: DataFrame, key: str, out: str = "airline_id") -> DataFrame:
    """Dense 0-based number of ``key`` in sorted order.

    Ranks the distinct keys (a small aggregate), then joins the numbers
    back; a global window over the fact itself is never used.
    """
    keys = df.select(_q(key).alias("_k")).distinct()
    ranked = consecutive_index(keys, [F.col("_k").asc_nulls_first()], out, start=0)
    return df.join(ranked, df[f"`{key}`"].eqNullSafe(ranked["_k"]), "left").drop("_k")


def check_key(df: DataFrame, key: Iterable[str], cols: Iterable[str]) -> DataFrame:
    """Functional-dependency check. One row per (column, violating key
    count): a key violates when it maps to more than one distinct value."""
    key, cols = list(key), list(cols)
    g = df.groupBy(*[_q(k) for k in key]).agg(
        *[F.count_distinct(_q(c)).alias(c) for c in cols])
    viol = g.select(*[F.sum(F.when(F.col(f"`{c}`") > 1, 1).otherwise(0)).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return viol.selectExpr(f"stack({len(cols)}, {stack}) as (column_name, violating_keys)") \
        .withColumn("holds", F.col("violating_keys") == 0)


def explode_counts(df: DataFrame, col: str, out: str = "value") -> DataFrame:
    """Explode a list column (empty -> NULL) and count each value."""
    return df.select(F.explode_outer(_q(col)).alias(out)).groupBy(out).count()


def first_match(df: DataFrame, dim: DataFrame, on: str, ret: str, out: str | None = None, dim_on: str | None = None) -> DataFrame:
    """Name -> id lookup; missing -> NULL; first row per name wins
    (the dimension is de-duplicated on the name first: min id)."""
    d = dim.groupBy(_q(dim_on or on).alias("_k")).agg(F.min(_q(ret)).alias(out or ret))
    return df.join(d, df[f"`{on}`"] == d["_k"], "left").drop("_k")
