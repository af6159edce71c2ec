"""Declared schemas of the listing and review data (no inference at read time)."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of the raw listing file, in file order (fixed values).
RAW_LISTING_COLUMNS = [
    "Departure Location", "Departure Time", "Arrival Location", "Arrival Time",
    "Flight Duration", "Aircraft Type", "Ticket Price", "Passenger Type",
    "Number of Tickets", "Price per Ticket", "Taxes & Fees", "Total Price",
    "Carry-on Baggage", "Checked Baggage", "Refund Policy", "Scrape Time",
]

RAW_LISTING = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_LISTING_COLUMNS])

CLEAN_LISTING = T.StructType([
    T.StructField("Departure Location", T.StringType()),
    T.StructField("Departure Time", T.TimestampNTZType()),
    T.StructField("Arrival Location", T.StringType()),
    T.StructField("Arrival Time", T.TimestampNTZType()),
    T.StructField("Flight Duration", T.DoubleType()),
    T.StructField("Aircraft Type", T.StringType()),
    T.StructField("Passenger Type", T.StringType()),
    T.StructField("Number of Tickets", T.IntegerType()),
    T.StructField("Price per Ticket", T.LongType()),
    T.StructField("Taxes & Fees", T.LongType()),
    T.StructField("Total Price", T.LongType()),
    T.StructField("Carry-on Baggage", T.IntegerType()),
    T.StructField("Checked Baggage", T.IntegerType()),
    T.StructField("Refund Policy", T.ArrayType(T.StringType())),
    T.StructField("Scrape Time", T.TimestampNTZType()),
    T.StructField("Airline", T.StringType()),
    T.StructField("Flight Code", T.StringType()),
    T.StructField("Fare Class", T.StringType()),
    T.StructField("Departure Location Code", T.StringType()),
    T.StructField("Arrival Location Code", T.StringType()),
])

RAW_REVIEW_COLUMNS = ["Rating", "Title", "Full Review", "Information", "Service Ratings"]
RAW_REVIEW = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_REVIEW_COLUMNS])

SERVICE_RATINGS = "array<struct<`Service Rating`:string,`Service Info`:string>>"

# Normalised table columns.
AIRPORT_COLUMNS = ["AirportCode", "Location"]
AIRLINE_COLUMNS = ["Airline_id", "Airline"]
POLICY_COLUMNS = ["Airline_id", "Fare Class", "Refund Policy"]
SCHEDULE_COLUMNS = [
    "Departure Time", "Flight Code", "Departure Location Code",
    "Arrival Location Code", "Flight Duration", "Arrival Time", "Aircraft Type",
]
SCHEDULE_KEY = ["Departure Time", "Flight Code", "Departure Location Code"]
TICKET_COLUMNS = [
    "Departure Time", "Passenger Type", "Number of Tickets", "Price per Ticket",
    "Taxes & Fees", "Total Price", "Carry-on Baggage", "Checked Baggage",
    "Scrape Time", "Flight Code", "Fare Class", "Departure Location Code", "Airline_id",
]
POLICY_KEY = ["Airline_id", "Fare Class"]

INFO_COLUMNS = ["name", "phone", "address", "website", "averating_rating", "total_review", "airline_id"]
