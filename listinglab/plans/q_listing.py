"""Checkable queries over the flight-listing side (sources, cleaning,
normalisation, joins, aggregates, windows, maintenance, flows)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar as C
from ..functions import parsing as P
from ..functions import text as T
from ..operators import aggregate as A
from ..operators import cleaning as CL
from ..operators import joins as J
from ..operators import maintain as I
from ..operators import normalize as N
from ..operators import ordering as W
from ..schemas import SCHEDULE_KEY
from ..sinks import files as K
from ..sources import files as S
from ..session import table, work_path
from . import fixtures as fx
from .oracle import with_listing
from .registry import register


def _q(c: str):
    return F.col(f"`{c}`")


def raw(spark: SparkSession, sf: str) -> DataFrame:
    return fx.raw_listings(spark, sf)


def clean(spark: SparkSession, sf: str) -> DataFrame:
    return CL.clean_listings(raw(spark, sf))


def written(spark: SparkSession, sf: str, columns: list[str] | None = None) -> DataFrame:
    """The clean rows (or the columns that are read of them) as a written table: parsed once, however many plans read them."""
    rows = clean(spark, sf) if columns is None else CL.project(clean(spark, sf), columns)
    return spark.read.parquet(K.write_table(rows, work_path(spark, "clean"), "parquet", "fail"))


def tables(spark: SparkSession, sf: str) -> dict:
    return N.normalize(written(spark, sf))


# Every row of the five tables as text, to compare whole contents.
_TABLE_ROWS = {
    "airline": ("airline", ["airline_id", "airline"]),
    "airport": ("airport", ["airportcode", "location"]),
    "refund_policy": ("refund_policy", ["airline_id", "fare", "array_to_string(policy, '/')"]),
    "flight_schedule": ("schedule", ["e_dep_time", "e_flight", "e_dep_code", "e_arr_code", "CAST(round(e_duration * 100) AS BIGINT)", "e_arr_time", "e_aircraft"]),
    "ticket": ("ticket", ["e_dep_time", "e_passenger", "e_tickets", "e_price", "e_tax", "e_total", "e_carry", "e_checked", "e_scrape", "e_flight", "e_fare",
                          "e_dep_code", "airline_id"]),
}
_TABLE_ROWS_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS name, " + " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in cols) + f" AS row_text FROM {source}"
    for name, (source, cols) in _TABLE_ROWS.items())


def table_rows(found: dict) -> DataFrame:
    """(name, row_text) of the five tables, in the order of their columns."""
    kinds = {"double": lambda c: F.round(c * 100).cast("bigint"), "timestamp_ntz": lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss"),
             "array<string>": lambda c: F.array_join(c, "/")}
    out = None
    for name in _TABLE_ROWS:
        df = found[name]
        cells = [F.coalesce(kinds.get(k, lambda c: c)(_q(c)).cast("string"), F.lit("-")) for c, k in df.dtypes]
        part = df.select(F.lit(name).alias("name"), F.concat_ws("|", *cells).alias("row_text"))
        out = part if out is None else out.unionByName(part)
    return out


def _pj(c) -> F.Column:
    return F.array_join(c, "|")


# ===================================================================== sources

@register("s1_read_listings", with_listing(
    "SELECT e_day AS day, e_route AS route, count(*) AS n FROM lc GROUP BY ALL"))
def s1_read_listings(spark, sf):
    path = work_path(spark, "raw-listings")
    K.append_raw(fx.raw_listings(spark, sf, with_layout=True), path)
    df = S.read_listings(spark, f"{path}")
    return df.groupBy("day", "route").agg(F.count(F.lit(1)).alias("n"))


@register("s4_read_table", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def s4_read_table(spark, sf):
    return S.read_table(spark, f"{sf}/nation.parquet")


@register("s5_lookup_rows", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def s5_lookup_rows(spark, sf):
    return S.lookup_rows(table(spark, sf, "orders"), "o_orderstatus", "F").select("o_orderkey", "o_custkey", "o_totalprice")


@register("s6_csv_roundtrip", with_listing(
    "SELECT count(*) AS n, sum(e_total) AS total, count(e_dep_time) AS n_dep, "
    "sum(len(e_policy)) AS n_policy FROM cl"))
def s6_csv_roundtrip(spark, sf):
    path = work_path(spark, "clean-csv")
    K.write_table(clean(spark, sf), path, "csv", "replace")
    df = S.read_clean(spark, path)
    return df.agg(F.count(F.lit(1)).alias("n"), F.sum("Total Price").alias("total"),
                  F.count("Departure Time").alias("n_dep"), F.sum(F.size("Refund Policy")).alias("n_policy"))


# ======================================================================= sinks

@register("k1_write_tables", with_listing(_TABLE_ROWS_SQL, tables=True))
def k1_write_tables(spark, sf):
    root = work_path(spark, "tables")
    K.write_tables(tables(spark, sf), root, "parquet", "replace")
    return table_rows(K.read_tables(spark, root, list(_TABLE_ROWS)))


@register("k2_append", with_listing("SELECT 2 * count(*) AS n FROM airport", tables=True))
def k2_append(spark, sf):
    path = work_path(spark, "append")
    ap = tables(spark, sf)["airport"]
    K.write_table(ap, path, mode="append")
    K.write_table(ap, path, mode="append")
    failed = 0
    try:
        K.write_table(ap, path, mode="fail")
    except Exception:
        failed = 1
    assert failed == 1, "fail mode must refuse an existing table"
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"))


@register("k3_replace", with_listing("SELECT count(*) AS n FROM airport", tables=True))
def k3_replace(spark, sf):
    path = work_path(spark, "replace")
    ap = tables(spark, sf)["airport"]
    K.write_table(ap, path, mode="replace")
    K.write_table(ap, path, mode="replace")
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"))


@register("k5_append_partitioned", with_listing(
    "SELECT e_route AS route, 2 * count(*) AS n FROM lc GROUP BY ALL"))
def k5_append_partitioned(spark, sf):
    path = work_path(spark, "raw-append")
    r = fx.raw_listings(spark, sf, with_layout=True)
    K.append_raw(r, path)
    K.append_raw(r, path)
    return S.read_listings(spark, path).groupBy("route").agg(F.count(F.lit(1)).alias("n"))


@register("k6_length_limit", with_listing(
    "SELECT 'Aircraft Type' AS column_name, count(*) FILTER (WHERE length(e_aircraft) > 5) AS truncated FROM cl "
    "UNION ALL SELECT 'Arrival Location', count(*) FILTER (WHERE length(e_arr_loc) > 8) FROM cl"))
def k6_length_limit(spark, sf):
    _, counts = K.with_length_limits(clean(spark, sf), {"Aircraft Type": 5, "Arrival Location": 8})
    return counts


# ==================================================================== cleaning

@register("p1_split_ticket", with_listing(
    "SELECT e_airline AS airline, e_flight AS flight_code, e_fare AS fare_class FROM lc"))
def p1_split_ticket(spark, sf):
    a, c, f, _ = P.ticket_parts(_q("Ticket Price"))
    return raw(spark, sf).select(a.alias("airline"), c.alias("flight_code"), f.alias("fare_class"))


@register("p2_clean_currency", with_listing(
    "SELECT e_price AS price, e_tax AS tax, e_total AS total FROM lc"))
def p2_clean_currency(spark, sf):
    return CL.clean_currency(raw(spark, sf)).select(
        _q("Price per Ticket").alias("price"), _q("Taxes & Fees").alias("tax"), _q("Total Price").alias("total"))


@register("p3_parse_dayfirst", with_listing("SELECT e_dep_time AS dep, e_arr_time AS arr FROM lc"))
def p3_parse_dayfirst(spark, sf):
    return raw(spark, sf).select(P.dayfirst_timestamp(_q("Departure Time")).alias("dep"),
                                 P.dayfirst_timestamp(_q("Arrival Time")).alias("arr"))


@register("p4_parse_iso", with_listing("SELECT e_scrape AS scrape FROM lc"))
def p4_parse_iso(spark, sf):
    return raw(spark, sf).select(P.iso_timestamp(_q("Scrape Time")).alias("scrape"))


@register("p5_coerce_time", with_listing(
    "SELECT e_scrape AS scrape, CAST(NULL AS TIMESTAMP) AS arr FROM lc"))
def p5_coerce_time(spark, sf):
    r = CL.coerce_times(raw(spark, sf), ["Scrape Time", "Arrival Time"])
    return r.select(_q("Scrape Time").alias("scrape"), _q("Arrival Time").alias("arr"))


@register("p6_clean_aircraft", with_listing("SELECT e_aircraft AS aircraft FROM lc"))
def p6_clean_aircraft(spark, sf):
    return CL.clean_aircraft(raw(spark, sf)).select(_q("Aircraft Type").alias("aircraft"))


@register("p7_duration_hours", with_listing("SELECT e_duration AS duration FROM lc"))
def p7_duration_hours(spark, sf):
    return CL.duration_hours(raw(spark, sf)).select(_q("Flight Duration").alias("duration"))


@register("p8_carry_on", with_listing("SELECT e_carry AS carry_on FROM lc"))
def p8_carry_on(spark, sf):
    return raw(spark, sf).select(P.carry_on_kg(_q("Carry-on Baggage")).alias("carry_on"))


@register("p9_checked", with_listing("SELECT e_checked AS checked FROM lc"))
def p9_checked(spark, sf):
    return raw(spark, sf).select(P.checked_kg(_q("Checked Baggage")).alias("checked"))


@register("p10_parse_policy", with_listing(
    "SELECT array_to_string(e_policy, '|') AS policy, len(e_policy) AS n FROM lc"))
def p10_parse_policy(spark, sf):
    p = P.policy_list(_q("Refund Policy"))
    return raw(spark, sf).select(_pj(p).alias("policy"), F.size(p).alias("n"))


@register("p11_policy_labels", with_listing(
    "SELECT array_to_string(list_transform(e_policy, lambda x: replace(x, '- ', '')), '|') AS labels FROM lc"))
def p11_policy_labels(spark, sf):
    return raw(spark, sf).select(_pj(P.policy_labels(P.policy_list(_q("Refund Policy")))).alias("labels"))


@register("p12_split_location", with_listing(
    "SELECT e_dep_loc AS dep_name, e_dep_code AS dep_code, e_arr_loc AS arr_name, e_arr_code AS arr_code FROM lc"))
def p12_split_location(spark, sf):
    r = CL.split_location(raw(spark, sf))
    return r.select(_q("Departure Location").alias("dep_name"), _q("Departure Location Code").alias("dep_code"),
                    _q("Arrival Location").alias("arr_name"), _q("Arrival Location Code").alias("arr_code"))


@register("p13_project", with_listing("SELECT e_fare AS fare_class, e_total AS total, e_airline AS airline FROM cl"))
def p13_project(spark, sf):
    return CL.project(clean(spark, sf), ["Fare Class", "Total Price", "Airline"]).toDF("fare_class", "total", "airline")


@register("p14_rejects", with_listing(
    "SELECT reject_reason AS reasons, count(*) AS n FROM lc WHERE rejected GROUP BY ALL"))
def p14_rejects(spark, sf):
    _, rej = CL.clean_listings_split(raw(spark, sf))
    return rej.groupBy(F.col(CL.REJECT_REASONS).alias("reasons")).agg(F.count(F.lit(1)).alias("n"))


@register("p15_fill_missing", with_listing("SELECT coalesce(e_checked, 0) AS checked FROM cl"))
def p15_fill_missing(spark, sf):
    return CL.fill_missing(clean(spark, sf), {"Checked Baggage": 0}).select(_q("Checked Baggage").alias("checked"))


@register("p17_ascii_fold", with_listing(
    "SELECT replace(replace(strip_accents(e_dep_loc), 'đ', 'd'), 'Đ', 'D') AS dep, "
    "replace(replace(strip_accents(e_passenger), 'đ', 'd'), 'Đ', 'D') AS passenger FROM cl"))
def p17_ascii_fold(spark, sf):
    c = clean(spark, sf)
    names = CL.normalize_names(c).columns
    assert "Carry-on_Baggage" in names and "Taxes_&_Fees" in names
    return c.select(T.ascii_fold(_q("Departure Location")).alias("dep"),
                    T.ascii_fold(_q("Passenger Type")).alias("passenger"))


@register("p18_isin", with_listing(
    "SELECT e_arr_code AS code, count(*) AS n FROM cl WHERE e_arr_code IN ('N01', 'N02', 'N03') GROUP BY ALL"))
def p18_isin(spark, sf):
    f = CL.filter_in(clean(spark, sf), "Arrival Location Code", ["N01", "N02", "N03"])
    assert CL.filter_in(f, "Airline", []) is f
    return f.groupBy(_q("Arrival Location Code").alias("code")).agg(F.count(F.lit(1)).alias("n"))


@register("p19_drop_null", with_listing("SELECT count(*) AS n FROM cl WHERE e_carry IS NOT NULL AND e_checked IS NOT NULL"))
def p19_drop_null(spark, sf):
    return CL.drop_null(clean(spark, sf), ["Carry-on Baggage", "Checked Baggage"]).agg(F.count(F.lit(1)).alias("n"))


@register("p20_rename", with_listing(
    "SELECT e_carry AS \"Carry-on_Baggage\", e_duration AS \"Flight_Duration\", e_fare AS \"Fare_Class\", "
    "e_arr_loc AS \"Arrival_Location_Code\" FROM cl"))
def p20_rename(spark, sf):
    c = clean(spark, sf)
    req = c.select(_q("Carry-on Baggage").alias("carry_on_baggage"), _q("Flight Duration").alias("flight_duration"),
                   _q("Fare Class").alias("fare_class"), _q("Arrival Location").alias("arrival_location"))
    return CL.scoring_frame(req)


# ================================================================== functions

@register("f9_calendar", with_listing(
    "SELECT hour(e_dep_time) AS hour, isodow(e_dep_time) - 1 AS weekday FROM cl"))
def f9_calendar(spark, sf):
    c = clean(spark, sf)
    return c.select(C.hour_of_day(_q("Departure Time")).alias("hour"),
                    C.weekday_monday0(_q("Departure Time")).alias("weekday"))


@register("f10_days_before", with_listing(
    "SELECT CAST(floor(date_diff('microsecond', e_scrape, e_dep_time) / 86400000000.0) AS INTEGER) AS days FROM cl"))
def f10_days_before(spark, sf):
    return clean(spark, sf).select(C.days_between(_q("Departure Time"), _q("Scrape Time")).alias("days"))


@register("f12_day_group", with_listing(
    "SELECT CASE WHEN day(e_dep_time) <= 10 THEN '1-10' WHEN day(e_dep_time) <= 20 THEN '11-20' "
    "ELSE '21-30' END AS day_group, count(*) AS n FROM cl GROUP BY ALL"))
def f12_day_group(spark, sf):
    return clean(spark, sf).groupBy(C.day_group(_q("Departure Time")).alias("day_group")).agg(F.count(F.lit(1)).alias("n"))


@register("f17_month_window",
          "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS start_date, "
          "CAST(date_trunc('month', o_orderdate + INTERVAL 3 MONTH) - INTERVAL 1 DAY AS DATE) AS end_date, "
          "strftime(o_orderdate, '%d-%m-%Y') AS start_text FROM orders")
def f17_month_window(spark, sf):
    o = table(spark, sf, "orders")
    d = F.to_date("o_orderdate")
    txt = C.format_dmy(d)
    assert_roundtrip = C.parse_dmy(txt)
    return o.select("o_orderkey", assert_roundtrip.alias("start_date"), C.window_end(d, 3).alias("end_date"),
                    txt.alias("start_text"))


@register("f20_minutes", with_listing(
    "SELECT CAST(round(e_duration * 60) AS INTEGER) AS minutes, "
    "round(CAST(CAST(round(e_duration * 60) AS INTEGER) AS DOUBLE) / 60, 2) AS hours FROM cl"))
def f20_minutes(spark, sf):
    m = T.hours_to_minutes(_q("Flight Duration"))
    return clean(spark, sf).select(m.alias("minutes"), T.minutes_to_hours(m).alias("hours"))


@register("f19_dim_id", "SELECT 'AL' || lpad(CAST(p_partkey AS VARCHAR), CAST(greatest(3, length(CAST(p_partkey AS VARCHAR))) AS INTEGER), '0') AS id FROM part")
def f19_dim_id(spark, sf):
    return table(spark, sf, "part").select(C.dim_id(F.col("p_partkey")).alias("id"))


# ============================================================== normalisation

@register("n1_airports", with_listing("SELECT airportcode AS \"AirportCode\", location AS \"Location\" FROM airport",
                                      tables=True))
def n1_airports(spark, sf):
    return N.make_airports(clean(spark, sf))


@register("n2_airlines", with_listing("SELECT airline_id AS \"Airline_id\", airline AS \"Airline\" FROM airline",
                                      tables=True))
def n2_airlines(spark, sf):
    return N.make_airlines(clean(spark, sf))


@register("n2b_airline_registry", with_listing(
    "SELECT airline_id AS \"Airline_id\", airline AS \"Airline\" FROM airline", tables=True))
def n2b_airline_registry(spark, sf):
    c = written(spark, sf, ["Airline", "Scrape Time"])   # read by both runs
    first_year = c.where(F.year(_q("Scrape Time")) <= 1997)
    reg = N.make_airlines(first_year)
    # Registry run: ids of known airlines never change; new ones continue.
    full = N.make_airlines(c, registry=reg)
    return full


@register("n3_policies", with_listing(
    "SELECT airline_id AS \"Airline_id\", fare AS fare_class, array_to_string(policy, '|') AS policy FROM refund_policy",
    tables=True))
def n3_policies(spark, sf):
    t = tables(spark, sf)["refund_policy"]
    return t.select("Airline_id", _q("Fare Class").alias("fare_class"), _pj(_q("Refund Policy")).alias("policy"))


@register("n4_schedules", with_listing(
    "SELECT e_dep_time AS dep, e_flight AS flight, e_dep_code AS dep_code, e_arr_code AS arr_code, "
    "e_duration AS duration, e_arr_time AS arr, e_aircraft AS aircraft FROM schedule", tables=True))
def n4_schedules(spark, sf):
    return N.make_schedules(clean(spark, sf)).toDF("dep", "flight", "dep_code", "arr_code", "duration", "arr", "aircraft")


_TICKET_OUT = ["dep", "passenger", "tickets", "price", "tax", "total", "carry", "checked", "scrape", "flight",
               "fare", "dep_code", "airline_id"]


@register("n5_tickets", with_listing(
    "SELECT e_dep_time AS dep, e_passenger AS passenger, e_tickets AS tickets, e_price AS price, e_tax AS tax, "
    "e_total AS total, e_carry AS carry, e_checked AS checked, e_scrape AS scrape, e_flight AS flight, "
    "e_fare AS fare, e_dep_code AS dep_code, airline_id FROM ticket", tables=True))
def n5_tickets(spark, sf):
    t = tables(spark, sf)["ticket"]
    cols = ["Departure Time", "Passenger Type", "Number of Tickets", "Price per Ticket", "Taxes & Fees",
            "Total Price", "Carry-on Baggage", "Checked Baggage", "Scrape Time", "Flight Code", "Fare Class",
            "Departure Location Code", "Airline_id"]
    return t.select(*[_q(c).alias(o) for c, o in zip(cols, _TICKET_OUT)])


@register("n6_counts", with_listing(_TABLE_ROWS_SQL, tables=True))
def n6_counts(spark, sf):
    """All five tables, every row."""
    return table_rows(tables(spark, sf))


@register("n12_key_check", with_listing(
    "SELECT column_name, sum(CASE WHEN d > 1 THEN 1 ELSE 0 END) AS violating_keys, "
    "sum(CASE WHEN d > 1 THEN 1 ELSE 0 END) = 0 AS holds FROM ("
    " SELECT 'Arrival Location Code' AS column_name, count(DISTINCT e_arr_code) AS d FROM cl GROUP BY e_dep_time, e_flight, e_dep_code"
    " UNION ALL SELECT 'Aircraft Type', count(DISTINCT e_aircraft) FROM cl GROUP BY e_dep_time, e_flight, e_dep_code"
    ") GROUP BY column_name"))
def n12_key_check(spark, sf):
    return N.check_key(clean(spark, sf), SCHEDULE_KEY, ["Arrival Location Code", "Aircraft Type"])


@register("n13_explode_counts", with_listing(
    "SELECT label AS value, count(*) AS count FROM ("
    " SELECT unnest(CASE WHEN len(e_policy) = 0 THEN [NULL::VARCHAR] ELSE e_policy END) AS label FROM cl"
    ") GROUP BY ALL"))
def n13_explode_counts(spark, sf):
    return N.explode_counts(clean(spark, sf), "Refund Policy")


# ======================================================================= joins

@register("j1_ticket_schedule", with_listing(
    "SELECT t.airline_id AS \"Airline_id\", count(*) AS n, sum(t.e_total) AS total, sum(s.e_duration * 100)::BIGINT AS dur100 "
    "FROM ticket t JOIN schedule s ON t.e_dep_time = s.e_dep_time AND t.e_flight = s.e_flight "
    "AND t.e_dep_code = s.e_dep_code GROUP BY ALL", tables=True))
def j1_ticket_schedule(spark, sf):
    t = tables(spark, sf)
    j = J.ticket_schedule(t["ticket"], t["flight_schedule"])
    return j.groupBy("Airline_id").agg(F.count(F.lit(1)).alias("n"), F.sum("Total Price").alias("total"),
                                       F.round(F.sum(_q("Flight Duration") * 100)).cast("bigint").alias("dur100"))


@register("j2_ticket_policy", with_listing(
    "SELECT t.airline_id AS \"Airline_id\", count(*) AS n FROM ticket t JOIN refund_policy p ON t.airline_id = p.airline_id "
    "AND t.e_fare = p.fare GROUP BY ALL", tables=True))
def j2_ticket_policy(spark, sf):
    t = tables(spark, sf)
    return J.ticket_policy(t["ticket"], t["refund_policy"]).groupBy("Airline_id").agg(F.count(F.lit(1)).alias("n"))


@register("j3_key_lookup", with_listing(
    "SELECT t.e_airline AS airline, a.airline_id FROM (SELECT DISTINCT e_airline FROM cl) t "
    "LEFT JOIN airline a ON t.e_airline IS NOT DISTINCT FROM a.airline", tables=True))
def j3_key_lookup(spark, sf):
    c = clean(spark, sf)
    names = c.select("Airline").distinct()
    out = N.key_lookup(names, N.make_airlines(c), "Airline", out="keep")
    return out.select(F.col("Airline").alias("airline"), F.col("Airline_id").alias("airline_id"))


@register("j4_orphans",
          "SELECT o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE "
          "l.l_orderkey = o.o_orderkey AND year(l.l_shipdate) = year(o.o_orderdate) "
          "AND month(l.l_shipdate) = month(o.o_orderdate))")
def j4_orphans(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"))
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.year("l_shipdate").alias("y"),
                                             F.month("l_shipdate").alias("m"))
    return J.orphans(o, li, ["o_orderkey", "y", "m"]).select("o_orderkey")


@register("j5_outer_hist", with_listing(
    "SELECT coalesce(d.h, a.h) AS hour, coalesce(d.n, 0) AS departures, coalesce(a.n, 0) AS arrivals FROM "
    "(SELECT hour(e_dep_time) AS h, count(*) AS n FROM cl GROUP BY ALL) d FULL JOIN "
    "(SELECT hour(e_arr_time) AS h, count(*) AS n FROM cl GROUP BY ALL) a ON d.h IS NOT DISTINCT FROM a.h"))
def j5_outer_hist(spark, sf):
    c = clean(spark, sf)
    dep = c.groupBy(F.hour(_q("Departure Time")).alias("hour")).count()
    arr = c.groupBy(F.hour(_q("Arrival Time")).alias("hour")).count()
    return J.outer_hist(dep, arr, "hour", "departures", "arrivals")


@register("j6_first_match", with_listing(
    "SELECT a.airline_id, count(*) AS n FROM cl LEFT JOIN airline a ON cl.e_airline = a.airline GROUP BY ALL",
    tables=True))
def j6_first_match(spark, sf):
    c = clean(spark, sf)
    dim = N.make_airlines(c)
    dim2 = dim.unionByName(dim.select(F.lit("AL999").alias("Airline_id"), "Airline"))   # duplicate names: min id wins
    return N.first_match(c, dim2, "Airline", "Airline_id", "airline_id").groupBy("airline_id") \
        .agg(F.count(F.lit(1)).alias("n"))


# ================================================================== aggregates

_CATS = ["Airline", "Fare Class", "Aircraft Type", "Arrival Location Code"]
_ECATS = {"Airline": "e_airline", "Fare Class": "e_fare", "Aircraft Type": "e_aircraft",
          "Arrival Location Code": "e_arr_code"}


def _union_cats(fmt: str) -> str:
    return " UNION ALL ".join(fmt.format(name=k, col=v) for k, v in _ECATS.items())


@register("a1_distinct_values", with_listing(
    "SELECT DISTINCT * FROM (" + _union_cats("SELECT '{name}' AS column_name, CAST({col} AS VARCHAR) AS value FROM cl WHERE {col} IS NOT NULL") + ")"))
def a1_distinct_values(spark, sf):
    return A.distinct_values(clean(spark, sf), _CATS)


@register("a2_min_max", with_listing(
    "SELECT e_arr_loc AS arrival, min(e_duration) AS min, max(e_duration) AS max FROM cl GROUP BY ALL"))
def a2_min_max(spark, sf):
    return A.range_by(clean(spark, sf), "Arrival Location", "Flight Duration").withColumnRenamed("Arrival Location", "arrival")


@register("a3_calendar_counts", with_listing(
    "SELECT 'month' AS part, month(e_dep_time) AS value, count(*) AS n FROM cl GROUP BY ALL UNION ALL "
    "SELECT 'day', day(e_dep_time), count(*) FROM cl GROUP BY ALL UNION ALL "
    "SELECT 'weekday', isodow(e_dep_time) - 1, count(*) FROM cl GROUP BY ALL UNION ALL "
    "SELECT 'hour', hour(e_dep_time), count(*) FROM cl GROUP BY ALL"))
def a3_calendar_counts(spark, sf):
    return A.calendar_counts_of(clean(spark, sf), "Departure Time", ("month", "day", "weekday", "hour")).withColumnRenamed("count", "n")


@register("a4_bin_counts", with_listing(
    "SELECT strftime(e_dep_time, '%Y-%m') AS month, CASE WHEN day(e_dep_time) <= 10 THEN '1-10' "
    "WHEN day(e_dep_time) <= 20 THEN '11-20' ELSE '21-30' END AS day_group, count(*) AS flight_count "
    "FROM cl GROUP BY ALL"))
def a4_bin_counts(spark, sf):
    return A.bin_counts(clean(spark, sf), "Departure Time")


@register("a5_value_counts", with_listing(
    "SELECT e_aircraft AS value, count(*) AS count FROM cl WHERE e_aircraft IS NOT NULL GROUP BY ALL"))
def a5_value_counts(spark, sf):
    return A.value_counts(clean(spark, sf), "Aircraft Type")


@register("a7_policies_by_fare", with_listing(
    "SELECT airline, fare, array_to_string(list_transform(list_sort(coalesce(list(DISTINCT label) FILTER (WHERE label IS NOT NULL), CAST([] AS VARCHAR[])), 'ASC', 'NULLS LAST')"
    " || CASE WHEN bool_or(label IS NULL) THEN [NULL::VARCHAR] ELSE CAST([] AS VARCHAR[]) END, lambda x: coalesce(x, 'NULL')), '|') AS policies FROM ("
    " SELECT airline, fare, replace(label0, '- ', '') AS label FROM (SELECT e_airline AS airline, e_fare AS fare,"
    " unnest(CASE WHEN len(e_policy) = 0 THEN [NULL::VARCHAR] ELSE e_policy END) AS label0 FROM cl)"
    ") GROUP BY ALL"))
def a7_policies_by_fare(spark, sf):
    r = A.policies_by_fare(clean(spark, sf))
    return r.select(F.col("Airline").alias("airline"), _q("Fare Class").alias("fare"),
                    F.array_join("policies", "|", "NULL").alias("policies"))


def _set_agg(col: str) -> str:
    return (f"array_to_string(list_transform(list_sort(coalesce(list(DISTINCT {col}) FILTER (WHERE {col} IS NOT NULL), CAST([] AS INTEGER[])), 'ASC', 'NULLS LAST')"
            f" || CASE WHEN bool_or({col} IS NULL) THEN [NULL] ELSE CAST([] AS INTEGER[]) END, lambda x: coalesce(CAST(x AS VARCHAR), 'NULL')), '|')")


@register("a8_baggage_by_fare", with_listing(
    f"SELECT e_airline AS airline, e_fare AS fare, {_set_agg('e_carry')} AS carry_on, {_set_agg('e_checked')} AS checked "
    "FROM cl GROUP BY ALL"))
def a8_baggage_by_fare(spark, sf):
    r = A.baggage_by_fare(clean(spark, sf))
    return r.select(F.col("Airline").alias("airline"), _q("Fare Class").alias("fare"),
                    F.array_join(F.transform("carry_on", lambda x: x.cast("string")), "|", "NULL").alias("carry_on"),
                    F.array_join(F.transform("checked", lambda x: x.cast("string")), "|", "NULL").alias("checked"))


@register("a9_options", with_listing(
    "SELECT section, key1, key2, item FROM ("
    " SELECT DISTINCT * FROM ("
    "  SELECT 'Departure Location' AS section, NULL AS key1, NULL AS key2, e_dep_loc AS item FROM cl"
    "  UNION ALL SELECT 'Arrival Location', NULL, NULL, e_arr_loc FROM cl"
    "  UNION ALL SELECT 'Aircraft Type', NULL, NULL, e_aircraft FROM cl"
    "  UNION ALL SELECT 'Passenger Type', NULL, NULL, e_passenger FROM cl"
    "  UNION ALL SELECT 'Airline', NULL, NULL, e_airline FROM cl"
    "  UNION ALL SELECT 'Departure Location Code', NULL, NULL, e_dep_code FROM cl"
    "  UNION ALL SELECT 'Arrival Location Code', NULL, NULL, e_arr_code FROM cl) WHERE item IS NOT NULL"
    " UNION ALL SELECT 'Flight Duration', 'min', e_arr_loc, CAST(min(e_duration) AS VARCHAR) FROM cl GROUP BY e_arr_loc"
    " UNION ALL SELECT 'Flight Duration', 'max', e_arr_loc, CAST(max(e_duration) AS VARCHAR) FROM cl GROUP BY e_arr_loc"
    " UNION ALL SELECT DISTINCT 'Refund Policy', a, f, replace(l, '- ', '') FROM (SELECT e_airline AS a, e_fare AS f,"
    "  unnest(CASE WHEN len(e_policy) = 0 THEN [NULL::VARCHAR] ELSE e_policy END) AS l FROM cl)"
    " UNION ALL SELECT DISTINCT 'Baggage carry_on', e_airline, e_fare, CAST(e_carry AS VARCHAR) FROM cl"
    " UNION ALL SELECT DISTINCT 'Baggage checked', e_airline, e_fare, CAST(e_checked AS VARCHAR) FROM cl)"))
def a9_options(spark, sf):
    """Every choice of the options document, one row each."""
    return A.option_rows(written(spark, sf)).select("section", "key1", "key2", "item")


_PROFILED = {
    "Departure Location": ("string", "e_dep_loc"), "Departure Time": ("timestamp_ntz", "e_dep_time"), "Arrival Location": ("string", "e_arr_loc"),
    "Arrival Time": ("timestamp_ntz", "e_arr_time"), "Flight Duration": ("double", "e_duration"), "Aircraft Type": ("string", "e_aircraft"),
    "Passenger Type": ("string", "e_passenger"), "Number of Tickets": ("int", "e_tickets"), "Price per Ticket": ("bigint", "e_price"),
    "Taxes & Fees": ("bigint", "e_tax"), "Total Price": ("bigint", "e_total"), "Carry-on Baggage": ("int", "e_carry"),
    "Checked Baggage": ("int", "e_checked"), "Refund Policy": ("array<string>", "e_policy"), "Scrape Time": ("timestamp_ntz", "e_scrape"),
    "Airline": ("string", "e_airline"), "Flight Code": ("string", "e_flight"), "Fare Class": ("string", "e_fare"),
    "Departure Location Code": ("string", "e_dep_code"), "Arrival Location Code": ("string", "e_arr_code"),
}


_PROFILE_COLS = ["Aircraft Type", "Carry-on Baggage", "Checked Baggage", "Airline", "Fare Class", "Flight Code"]
_EPROF = {"Aircraft Type": "e_aircraft", "Carry-on Baggage": "e_carry", "Checked Baggage": "e_checked",
          "Airline": "e_airline", "Fare Class": "e_fare", "Flight Code": "e_flight"}


@register("a11_missing_ratio", with_listing(" UNION ALL ".join(
    f"SELECT '{k}' AS column_name, round(avg(CASE WHEN {v} IS NULL THEN 1 ELSE 0 END) * 100, 1) AS missing_ratio FROM cl"
    for k, (_, v) in _PROFILED.items())))
def a11_missing_ratio(spark, sf):
    return A.missing_ratio(clean(spark, sf), list(_PROFILED))


@register("a12_num_values", with_listing(" UNION ALL ".join(
    f"SELECT '{k}' AS column_name, count(DISTINCT {v}) AS num_values FROM cl" for k, (_, v) in _PROFILED.items())))
def a12_num_values(spark, sf):
    return A.num_values(clean(spark, sf), list(_PROFILED))


@register("a13_value_ratios", with_listing(
    "SELECT column_name, value, round(n * 100.0 / sum(n) OVER (PARTITION BY column_name), 1)::DOUBLE AS percent FROM ("
    + " UNION ALL ".join(
        f"SELECT '{k}' AS column_name, CAST({v} AS VARCHAR) AS value, count(*) AS n FROM cl WHERE {v} IS NOT NULL GROUP BY ALL"
        for k, v in _EPROF.items()) + ")"))
def a13_value_ratios(spark, sf):
    return A.value_ratios(clean(spark, sf), _PROFILE_COLS)


#: The columns whose values have one text form in both engines.
_EVERY = _EPROF | {"Departure Location": "e_dep_loc", "Arrival Location": "e_arr_loc", "Departure Location Code": "e_dep_code", "Arrival Location Code": "e_arr_code",
                   "Passenger Type": "e_passenger", "Number of Tickets": "e_tickets", "Price per Ticket": "e_price", "Taxes & Fees": "e_tax", "Total Price": "e_total"}


@register("a13_all_values", with_listing(
    "SELECT column_name, value, round(n * 100.0 / sum(n) OVER (PARTITION BY column_name), 1)::DOUBLE AS percent FROM (" + " UNION ALL ".join(
        f"SELECT '{k}' AS column_name, CAST({v} AS VARCHAR) AS value, count(*) AS n FROM cl WHERE {v} IS NOT NULL GROUP BY ALL" for k, v in _EVERY.items()) + ")"))
def a13_all_values(spark, sf):
    """Value percentages of every text and integer column."""
    return A.value_ratios(clean(spark, sf), list(_EVERY))


_NUM = {"Total Price": "e_total", "Flight Duration": "e_duration", "Carry-on Baggage": "e_carry"}


@register("a14_describe", with_listing(" UNION ALL ".join(
    f"SELECT '{k}' AS column_name, count({v}) AS count, round(avg({v}), 4) AS mean, round(stddev_samp({v}), 4) AS std, "
    f"CAST(min({v}) AS DOUBLE) AS min, round(quantile_cont({v}, 0.25), 4) AS p25, round(quantile_cont({v}, 0.5), 4) AS p50, "
    f"round(quantile_cont({v}, 0.75), 4) AS p75, CAST(max({v}) AS DOUBLE) AS max FROM cl" for k, v in _NUM.items())))
def a14_describe(spark, sf):
    d = A.describe_numeric(clean(spark, sf), list(_NUM))
    return d.select("column_name", "count", *[F.round(c, 4).alias(c) for c in ("mean", "std")], "min",
                    *[F.round(c, 4).alias(c) for c in ("p25", "p50", "p75")], "max")


@register("a15_duplicates", with_listing(
    "SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS duplicates FROM (SELECT count(*) AS c FROM cl "
    "GROUP BY e_dep_loc, e_dep_time, e_arr_loc, e_arr_time, e_duration, e_aircraft, e_passenger, e_tickets, e_price, "
    "e_tax, e_total, e_carry, e_checked, e_policy, e_scrape, e_airline, e_flight, e_fare, e_dep_code, e_arr_code)"))
def a15_duplicates(spark, sf):
    return A.duplicate_count(clean(spark, sf))


@register("a16_profile", with_listing(" UNION ALL ".join(
    f"SELECT '{k}' AS column_name, '{kind}' AS dtype, count(*) FILTER (WHERE {c} IS NULL) AS null_count, count(*) AS rows, {len(_PROFILED)} AS columns FROM cl"
    for k, (kind, c) in _PROFILED.items())))
def a16_profile(spark, sf):
    return A.profile(clean(spark, sf))


_CONST = {k: c for k, (_, c) in _PROFILED.items()}


@register("a17_constant_columns", with_listing("SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{k}' AS column_name, count(DISTINCT {v}) AS num_values FROM cl" for k, v in _CONST.items())
    + ") WHERE num_values <= 1"))
def a17_constant_columns(spark, sf):
    return A.constant_columns(clean(spark, sf), list(_CONST))


@register("a18_iqr", with_listing(
    "SELECT round(q1, 4) AS q1, round(q3, 4) AS q3, round(q3 - q1, 4) AS iqr, round(q1 - 1.5 * (q3 - q1), 4) AS lower, "
    "round(q3 + 1.5 * (q3 - q1), 4) AS upper, (SELECT count(*) FROM cl WHERE e_total < q1 - 1.5 * (q3 - q1) "
    "OR e_total > q3 + 1.5 * (q3 - q1)) AS outliers FROM (SELECT quantile_cont(e_total, 0.25) AS q1, "
    "quantile_cont(e_total, 0.75) AS q3 FROM cl)"))
def a18_iqr(spark, sf):
    r = A.iqr_outliers(clean(spark, sf), "Total Price")
    return r.select(*[F.round(c, 4).alias(c) for c in ("q1", "q3", "iqr", "lower", "upper")], "outliers")


@register("a19_histogram", with_listing(
    "SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((e_total - lo) / (hi - lo) * 10), 9) END AS INTEGER) AS bin, "
    "count(*) AS count FROM cl, (SELECT CAST(min(e_total) AS DOUBLE) AS lo, CAST(max(e_total) AS DOUBLE) AS hi FROM cl) "
    "WHERE e_total IS NOT NULL GROUP BY ALL"))
def a19_histogram(spark, sf):
    return A.histogram(clean(spark, sf), "Total Price", 10)


@register("a22_audit", with_listing(
    "SELECT 'raw' AS name, count(*) AS rows FROM lc UNION ALL SELECT 'clean', count(*) FROM cl "
    "UNION ALL SELECT 'rejects', count(*) FROM lc WHERE rejected"))
def a22_audit(spark, sf):
    r = raw(spark, sf)
    v, rej = CL.clean_listings_split(r)
    return A.audit({"raw": r, "clean": v, "rejects": rej})


# ===================================================== windows / sets / reshape

@register("w1_dedupe", with_listing("SELECT airportcode AS \"AirportCode\", location AS \"Location\" FROM airport",
                                    tables=True))
def w1_dedupe(spark, sf):
    ap = tables(spark, sf)["airport"]
    return W.dedupe(ap.unionByName(ap).unionByName(ap))


@register("w4_best_model", with_listing(
    "SELECT e_airline AS model_name, round(avg(e_duration), 4) AS mean_r2, round(avg(e_total) / 1000000.0, 6) AS mean_rmse "
    "FROM cl WHERE e_airline IS NOT NULL GROUP BY ALL ORDER BY mean_r2 DESC, mean_rmse ASC, model_name LIMIT 1"))
def w4_best_model(spark, sf):
    c = clean(spark, sf).where(F.col("Airline").isNotNull())
    res = c.groupBy(F.col("Airline").alias("model_name")).agg(
        F.round(F.avg("Flight Duration"), 4).alias("mean_r2"), F.round(F.avg("Total Price") / 1e6, 6).alias("mean_rmse"))
    return W.best_model(res)


@register("u1_union_all", with_listing("SELECT e_route AS route, count(*) AS n FROM lc GROUP BY ALL"))
def u1_union_all(spark, sf):
    r = fx.raw_listings(spark, sf, with_layout=True)
    even = r.where(F.substring("route", -1, 1).cast("int") % 2 == 0)
    odd = r.where(F.substring("route", -1, 1).cast("int") % 2 == 1)
    return W.union_all(even, odd).groupBy("route").agg(F.count(F.lit(1)).alias("n"))


@register("u4_distinct", with_listing(
    "SELECT count(*) AS n FROM (SELECT DISTINCT e_dep_time, e_flight, e_dep_code, e_fare, e_scrape, e_total FROM cl)"))
def u4_distinct(spark, sf):
    c = clean(spark, sf).select("Departure Time", "Flight Code", "Departure Location Code", "Fare Class",
                                "Scrape Time", "Total Price")
    return W.distinct_rows(c).agg(F.count(F.lit(1)).alias("n"))


@register("u5_melt", with_listing(
    "SELECT hour AS \"Hour\", \"Type\", \"Count\" FROM (SELECT coalesce(d.h, a.h) AS hour, coalesce(d.n, 0) AS \"Departure\", "
    "coalesce(a.n, 0) AS \"Arrival\" FROM (SELECT hour(e_dep_time) AS h, count(*) AS n FROM cl GROUP BY ALL) d "
    "FULL JOIN (SELECT hour(e_arr_time) AS h, count(*) AS n FROM cl GROUP BY ALL) a ON d.h IS NOT DISTINCT FROM a.h) "
    "UNPIVOT (\"Count\" FOR \"Type\" IN (\"Departure\", \"Arrival\"))"))
def u5_melt(spark, sf):
    c = clean(spark, sf)
    dep = c.groupBy(F.hour(_q("Departure Time")).alias("Hour")).count()
    arr = c.groupBy(F.hour(_q("Arrival Time")).alias("Hour")).count()
    wide = J.outer_hist(dep, arr, "Hour", "Departure", "Arrival")
    return W.melt(wide, ["Hour"], ["Departure", "Arrival"], "Type", "Count")


@register("u6_indicator", with_listing(
    "SELECT sum(CASE WHEN e_fare = 'AF' THEN 1 ELSE 0 END) AS \"Fare_AF\", sum(CASE WHEN e_fare = 'NO' THEN 1 ELSE 0 END) AS \"Fare_NO\", "
    "sum(CASE WHEN e_fare = 'RF' THEN 1 ELSE 0 END) AS \"Fare_RF\" FROM cl"))
def u6_indicator(spark, sf):
    w = W.indicators(clean(spark, sf), "Fare Class", ["AF", "NO", "RF"], prefix="Fare")
    return w.agg(*[F.sum(F.coalesce(F.col(c), F.lit(0))).cast("bigint").alias(c) for c in ("Fare_AF", "Fare_NO", "Fare_RF")])


# =============================================================== maintenance

NOW = "2001-09-15 12:00:00"


@register("i1_incremental", with_listing(
    "SELECT e_arr_code AS code, count(*) AS n FROM cl GROUP BY ALL"))
def i1_incremental(spark, sf):
    from ..streaming.incremental import ingest_new

    src = work_path(spark, "inc-src")
    out = work_path(spark, "inc-out")
    ck = work_path(spark, "inc-ckpt")
    r = fx.raw_listings(spark, sf, with_layout=True)
    early = r.where(F.col("day") <= F.lit("01_01_1997"))
    late = r.where(F.col("day") > F.lit("01_01_1997"))
    # the stream reads only the 16 raw columns; folders carry day/route
    K.append_raw(early, src)
    ingest_new(spark, src, out, ck)
    K.append_raw(late, src)
    ingest_new(spark, src, out, ck)      # second run picks up only new files
    from ..streaming.incremental import ingested

    res, _ = ingested(spark, out)
    return res.groupBy(_q("Arrival Location Code").alias("code")).agg(F.count(F.lit(1)).alias("n"))


@register("i2_merge_distinct", with_listing(
    "SELECT airportcode AS \"AirportCode\", location AS \"Location\" FROM airport", tables=True))
def i2_merge_distinct(spark, sf):
    c = written(spark, sf, [f"{side} Location{code}" for side in ("Departure", "Arrival") for code in (" Code", "")] + ["Scrape Time"])   # read by both runs
    old = N.make_airports(c.where(F.year(_q("Scrape Time")) <= 1997))
    new = N.make_airports(c)
    return I.merge_distinct(old, new, ["AirportCode", "Location"])


_CUT = "TIMESTAMP '2001-06-15 12:00:00'"


@register("i3_retention", with_listing(
    f"SELECT count(*) AS n, min(e_scrape) AS oldest FROM ticket WHERE e_scrape > {_CUT} OR e_scrape IS NULL", tables=True))
def i3_retention(spark, sf):
    t = tables(spark, sf)["ticket"]
    return I.retain(t, "Scrape Time", 3, NOW).agg(F.count(F.lit(1)).alias("n"), F.min("Scrape Time").alias("oldest"))


@register("i4_cascade", with_listing(
    f"SELECT count(*) AS n FROM schedule s WHERE EXISTS (SELECT 1 FROM ticket t WHERE (t.e_scrape > {_CUT} OR t.e_scrape IS NULL) "
    "AND t.e_dep_time = s.e_dep_time AND t.e_flight = s.e_flight AND t.e_dep_code = s.e_dep_code)", tables=True))
def i4_cascade(spark, sf):
    t = tables(spark, sf)
    out = I.cleanup(t, 3, NOW)
    return out["flight_schedule"].agg(F.count(F.lit(1)).alias("n"))


# ======================================================================= flows

_L1_COLS = ("e_dep_loc AS dep_loc, e_dep_time AS dep_time, e_arr_loc AS arr_loc, e_arr_time AS arr_time, "
            "e_duration AS duration, e_aircraft AS aircraft, e_passenger AS passenger, e_tickets AS tickets, "
            "e_price AS price, e_tax AS tax, e_total AS total, e_carry AS carry, e_checked AS checked, "
            "array_to_string(e_policy, '|') AS policy, e_scrape AS scrape, e_airline AS airline, e_flight AS flight, "
            "e_fare AS fare, e_dep_code AS dep_code, e_arr_code AS arr_code")
_L1_OUT = ["dep_loc", "dep_time", "arr_loc", "arr_time", "duration", "aircraft", "passenger", "tickets", "price",
           "tax", "total", "carry", "checked", "policy", "scrape", "airline", "flight", "fare", "dep_code", "arr_code"]


def l1_frame(df: DataFrame) -> DataFrame:
    cols = [_q(c) for c in CL.CLEAN_ORDER]
    cols[13] = _pj(_q("Refund Policy"))
    return df.select(*[c.alias(o) for c, o in zip(cols, _L1_OUT)])


@register("l1_clean", with_listing(f"SELECT {_L1_COLS} FROM cl"))
def l1_clean(spark, sf):
    return l1_frame(clean(spark, sf))


@register("l2_etl", with_listing(
    _TABLE_ROWS_SQL + " UNION ALL SELECT 'rejects', reject_reason FROM lc WHERE rejected", tables=True))
def l2_etl(spark, sf):
    """Two runs, the second over the first one's files and new ones: the tables hold every row once, airlines keep their ids."""
    from .flows import run_listing_etl, stored_tables

    src, out = work_path(spark, "etl-src"), work_path(spark, "etl-out")
    r = fx.raw_listings(spark, sf, with_layout=True)
    K.append_raw(r.where(F.col("day") <= F.lit("01_01_1997")), src)
    run_listing_etl(spark, src, out)
    K.append_raw(r.where(F.col("day") > F.lit("01_01_1997")), src)
    paths = run_listing_etl(spark, src, out)
    _, rejects = CL.tagged_parts(spark.read.parquet(paths["listings"]))
    return table_rows(stored_tables(spark, out)).unionByName(
        rejects.select(F.lit("rejects").alias("name"), F.col(CL.REJECT_REASONS).alias("row_text")))
