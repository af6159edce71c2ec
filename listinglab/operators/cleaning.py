"""Row cleaning of flight listings (P1-P21) and the L1 clean chain.

All operators are narrow transformations (one ``Project``/``Filter``), so
they fuse into the scan's whole-stage-codegen stage: no shuffle, no Python.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import parsing as P
from ..functions.text import fold_name

PRICE_COLUMNS = ["Price per Ticket", "Taxes & Fees", "Total Price"]
REJECT_REASONS = "reject_reasons"

CLEAN_ORDER = [
    "Departure Location", "Departure Time", "Arrival Location", "Arrival Time",
    "Flight Duration", "Aircraft Type", "Passenger Type", "Number of Tickets",
    "Price per Ticket", "Taxes & Fees", "Total Price", "Carry-on Baggage",
    "Checked Baggage", "Refund Policy", "Scrape Time", "Airline", "Flight Code",
    "Fare Class", "Departure Location Code", "Arrival Location Code",
]


def split_ticket(df: DataFrame, col: str = "Ticket Price") -> DataFrame:
    """Add Airline, Flight Code, Fare Class; drop the source column."""
    c = F.col(f"`{col}`")
    # The middle part feeds three outputs: a projection of its own keeps it
    # from being recomputed inside each CASE branch.
    staged = df.withColumn("_after_flight", P._after_first(c, P.TICKET_FLIGHT_MARKER))
    airline, code, fare, _ = P.ticket_parts_from(c, F.col("_after_flight"))
    return staged.withColumns({"Airline": airline, "Flight Code": code, "Fare Class": fare}) \
        .drop(col, "_after_flight")


def clean_currency(df: DataFrame, cols: Iterable[str] = PRICE_COLUMNS) -> DataFrame:
    """Currency text -> bigint for each column."""
    return df.withColumns({c: P.currency(F.col(f"`{c}`")) for c in cols})


def with_dayfirst(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """P3 for each column."""
    return df.withColumns({c: P.dayfirst_timestamp(F.col(f"`{c}`")) for c in cols})


def parse_times(df: DataFrame) -> DataFrame:
    """P3 + P4: day-first departure/arrival, ISO scrape time."""
    df = with_dayfirst(df, ["Departure Time", "Arrival Time"])
    return df.withColumn("Scrape Time", P.iso_timestamp(F.col("`Scrape Time`")))


def coerce_times(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """P5: lenient ISO parse; unparsable values become NULL."""
    return df.withColumns({c: P.iso_timestamp(F.col(f"`{c}`")) for c in cols})


def clean_aircraft(df: DataFrame, col: str = "Aircraft Type") -> DataFrame:
    """P6."""
    return df.withColumn(col, P.aircraft(F.col(f"`{col}`")))


def duration_hours(df: DataFrame, col: str = "Flight Duration") -> DataFrame:
    """P7."""
    return df.withColumn(col, P.duration_hours(F.col(f"`{col}`")))


def baggage(df: DataFrame) -> DataFrame:
    """P8 + P9."""
    return df.withColumns({
        "Carry-on Baggage": P.carry_on_kg(F.col("`Carry-on Baggage`")),
        "Checked Baggage": P.checked_kg(F.col("`Checked Baggage`")),
    })


def parse_policy(df: DataFrame, col: str = "Refund Policy") -> DataFrame:
    """P10: list literal -> array<string> (NULL/bad -> [])."""
    return df.withColumn(col, P.policy_list(F.col(f"`{col}`")))


def clean_policy(df: DataFrame, col: str = "Refund Policy") -> DataFrame:
    """Strip ``- `` from every item of an array column."""
    return df.withColumn(col, P.policy_labels(F.col(f"`{col}`")))


def split_location(df: DataFrame) -> DataFrame:
    """Location text -> name + code columns for departure and arrival."""
    dep, arr = F.col("`Departure Location`"), F.col("`Arrival Location`")
    return df.withColumns({
        "Departure Location Code": P.location_code(dep),
        "Departure Location": P.location_name(dep),
        "Arrival Location Code": P.location_code(arr),
        "Arrival Location": P.location_name(arr),
    })


def project(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Select / reorder columns by name (pruned down to the scan)."""
    return df.select(*[F.col(f"`{c}`") for c in cols])


def drop_cols(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop columns."""
    return df.drop(*cols)


def fill_missing(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Fill NULLs with per-column constants."""
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.lit(v)) for c, v in values.items()})


def normalize_names(df: DataFrame) -> DataFrame:
    """ASCII-folded, underscore column names (metadata only)."""
    return df.toDF(*[fold_name(c) for c in df.columns])


def filter_in(df: DataFrame, col: str, values: Iterable | None) -> DataFrame:
    """Keep rows whose value is in ``values``; no selection keeps all."""
    vals = list(values or [])
    return df.where(F.col(f"`{col}`").isin(vals)) if vals else df


def drop_null(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop rows where any of ``cols`` is NULL."""
    return df.na.drop(how="any", subset=list(cols))


def with_source(df: DataFrame, name: str | Column, col: str = "Airline") -> DataFrame:
    """Tag rows with their source (a literal or a column expression)."""
    return df.withColumn(col, name if isinstance(name, Column) else F.lit(name))


def source_from_path(path_col: Column, mapping: Mapping[str, str]) -> Column:
    """P21 from the file name: ``CASE`` over file-name fragments."""
    expr = None
    for fragment, label in mapping.items():
        cond = F.instr(path_col, fragment) > 0
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


# Request fields of a scoring call -> feature column names (fixed values).
REQUEST_FIELDS = {
    "carry_on_baggage": "Carry-on_Baggage",
    "checked_baggage": "Checked_Baggage",
    "flight_duration": "Flight_Duration",
    "fare_class": "Fare_Class",
    "airline": "Airline_id",
    "arrival_location": "Arrival_Location_Code",
    "aircraft_type": "Aircraft_Type",
    "refund_policy": "Refund_Policy",
    "departure_time": "Departure_Time",
    "scrape_time": "Scrape_Time",
    "departure_location": "Departure_Location_Code",
}


def scoring_frame(requests: DataFrame) -> DataFrame:
    """P20: rename request fields to the feature column names."""
    return requests.select(*[F.col(src).alias(dst) for src, dst in REQUEST_FIELDS.items() if src in requests.columns])


# ---------------------------------------------------------------- P14 rejects

def reject_reasons(rules: Mapping[str, Column]) -> Column:
    """Comma-separated names of every rule that flags the row ('' = valid).

    ``concat_ws`` skips NULLs and is code-generated (an array ``filter``
    with a lambda would not be)."""
    return F.concat_ws(",", *[F.when(cond, F.lit(name)) for name, cond in rules.items()])


def partition_rejects(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Split into (valid, rejects) with a ``reject_reasons`` column.

    Plain filters: each output evaluates the columns that its rules and its
    readers need and no others. Where both outputs are wanted, write
    :func:`tag_listings` once and read its two parts."""
    tagged = df.withColumn(REJECT_REASONS, reject_reasons(rules))
    valid = tagged.where(F.col(REJECT_REASONS) == "").drop(REJECT_REASONS)
    return valid, tagged.where(F.col(REJECT_REASONS) != "")


#: What parses a judged column, by its raw column.
_PARSERS = {
    **{c: P.currency for c in PRICE_COLUMNS},
    "Departure Time": P.dayfirst_timestamp, "Arrival Time": P.dayfirst_timestamp, "Scrape Time": P.iso_timestamp, "Flight Duration": P.duration_hours,
    "Carry-on Baggage": P.carry_on_kg, "Checked Baggage": P.checked_kg, "Departure Location": P.location_code, "Arrival Location": P.location_code,
}


def listing_rules() -> dict[str, Column]:
    """Rules under which the source would abort: raw text present, parse NULL.

    They are stated over the raw columns, the parsers written out as the clean
    columns write them. The NULL test comes first and is always evaluated, so
    that a projection of both runs each parser once."""
    def bad(name: str) -> Column:
        r = F.col(f"`{name}`")
        present = r.isNotNull() & (r != F.lit(P.CHECKED_PLACEHOLDER)) if name == "Checked Baggage" else r.isNotNull()
        return F.when(_PARSERS[name](r).isNull(), present).otherwise(F.lit(False))

    return {
        "price_per_ticket": bad("Price per Ticket"),
        "taxes_fees": bad("Taxes & Fees"),
        "total_price": bad("Total Price"),
        "departure_time": bad("Departure Time"),
        "arrival_time": bad("Arrival Time"),
        "scrape_time": bad("Scrape Time"),
        "flight_duration": bad("Flight Duration"),
        "carry_on": bad("Carry-on Baggage"),
        "checked": bad("Checked Baggage"),
        "departure_location": bad("Departure Location"),
        "arrival_location": bad("Arrival Location"),
    }


def _judged(df: DataFrame) -> DataFrame:
    """The parsers whose results the rules look at."""
    return split_location(baggage(duration_hours(parse_times(clean_currency(df)))))


def _unjudged(df: DataFrame) -> DataFrame:
    """The other parsers."""
    df = parse_policy(clean_aircraft(split_ticket(df)))
    return df.withColumn("Number of Tickets", F.col("`Number of Tickets`").try_cast("int"))


def clean_chain(df: DataFrame) -> DataFrame:
    """P1 -> P2 -> P3/P4 -> P6/P7 -> P8/P9 -> P10 -> P12, one projection."""
    return _unjudged(_judged(df))


def _parsed(raw: DataFrame) -> DataFrame:
    """Clean columns, raw columns (``_raw_``) and the reject reasons.

    The reasons and the columns that they judge come from one projection of the
    raw columns. A filter on the reasons would be pushed below it, with every
    parser written out again, so the reasons alone pass a row-preserving
    generator (``explode`` of an array of one), which a predicate does not
    cross. All other columns are plain ones, and a query that does not read
    them does not make them."""
    kept = raw.withColumns({f"_raw_{c}": F.col(f"`{c}`") for c in raw.columns} | {"_reasons": reject_reasons(listing_rules())})
    judged = _judged(kept)
    return _unjudged(judged.select(*[F.col(f"`{c}`") for c in judged.columns if c != "_reasons"], F.explode(F.array("_reasons")).alias(REJECT_REASONS)))


def _clean_columns(raw_columns: Iterable[str]) -> list[str]:
    return CLEAN_ORDER + [c for c in raw_columns if c not in CLEAN_ORDER and c != "Ticket Price"]


def clean_listings_split(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """L1 with reject routing: (clean rows, rejected raw rows + reasons)."""
    tagged = _parsed(raw)
    return (project(tagged.where(F.col(REJECT_REASONS) == ""), _clean_columns(raw.columns)),
            tagged.where(F.col(REJECT_REASONS) != "").select(*[F.col(f"`_raw_{c}`").alias(c) for c in raw.columns], F.col(REJECT_REASONS)))


def tag_listings(raw: DataFrame) -> DataFrame:
    """L1 for one write: the clean columns, the raw ones of rejects, the
    reasons and ``is_reject`` (0 or 1) to partition by."""
    reasons = F.col(REJECT_REASONS)
    return _parsed(raw).select(*[F.col(f"`{c}`") for c in _clean_columns(raw.columns)],
                         *[F.when(reasons != "", F.col(f"`_raw_{c}`")).alias(f"_raw_{c}") for c in raw.columns],
                         reasons, (reasons != "").cast("int").alias("is_reject"))


def tagged_parts(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean rows, rejected raw rows + reasons) of a written :func:`tag_listings`."""
    raw = [c for c in tagged.columns if c.startswith("_raw_")]
    clean = [c for c in tagged.columns if c not in raw and c not in (REJECT_REASONS, "is_reject")]
    return (project(tagged.where("is_reject = 0"), clean),
            tagged.where("is_reject = 1").select(*[F.col(f"`{c}`").alias(c.removeprefix("_raw_")) for c in raw], REJECT_REASONS))


def clean_listings(raw: DataFrame) -> DataFrame:
    """L1: the clean chain; rows the source could not parse go to rejects."""
    return clean_listings_split(raw)[0]
