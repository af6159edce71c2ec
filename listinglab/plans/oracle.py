"""DuckDB oracle building blocks (test side).

These CTEs compute the *expected clean values* of the raw-shaped fixtures
directly from the driver tables' columns — they never parse the rendered
text — so a parser bug cannot cancel out against the same bug here.
"""

from __future__ import annotations

from .fixtures import POLICY_A, POLICY_N


def _pylist_sql(literal: str) -> str:
    import ast

    items = ast.literal_eval(literal)
    return "[" + ", ".join("'" + i.replace("'", "''") + "'" for i in items) + "]"


# Expected clean listing rows (e_* columns) for every raw row, plus ``rejected``.
LISTING = f"""
lb AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_extendedprice, l.l_tax,
         l.l_returnflag, l.l_linestatus, o.o_orderdate, n.n_nationkey, n.n_name,
         p.p_brand, p.p_type, p.p_size
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
lb2 AS (SELECT * FROM lb UNION ALL SELECT * FROM lb WHERE l_orderkey % 101 = 0),
ls AS (
  SELECT *,
    (l_orderkey % 997 = 0) AS bad,
    o_orderdate + to_hours(CAST(l_orderkey % 24 AS BIGINT)) + to_minutes(CAST((l_suppkey % 12) * 5 AS BIGINT)) AS dep_ts,
    1 + l_linenumber % 3 AS dur_h,
    l_partkey % 60 AS dur_m,
    o_orderdate + to_days(CAST(2 - l_partkey % 40 AS INTEGER)) + to_hours(CAST(l_suppkey % 24 AS BIGINT)) AS scrape_ts,
    CAST(round(l_extendedprice / 10) AS BIGINT) + 20000 * (1 + l_linenumber % 3) + 150 * (l_partkey % 60)
      + CASE WHEN l_suppkey % 3 = 0 THEN 400 * (20 + 5 * (l_partkey % 3)) ELSE 0 END
      + CASE l_returnflag WHEN 'A' THEN 3000 WHEN 'N' THEN 9000 ELSE 0 END + 500 * n_nationkey AS price0,
    (price0 * CAST(round(l_tax * 100) AS BIGINT)) // 100 AS tax0,
    'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS arr_code0,
    l_returnflag || l_linestatus AS fare0
  FROM lb2
),
lc AS (
  SELECT
    l_orderkey, l_linenumber, bad,
    'TP Hồ Chí Minh' AS e_dep_loc,
    CASE WHEN bad AND l_linenumber = 3 THEN NULL ELSE 'SGN' END AS e_dep_code,
    CASE WHEN bad AND l_linenumber = 6 THEN NULL ELSE dep_ts END AS e_dep_time,
    n_name AS e_arr_loc,
    arr_code0 AS e_arr_code,
    dep_ts + to_hours(CAST(dur_h AS BIGINT)) + to_minutes(CAST(dur_m AS BIGINT)) AS e_arr_time,
    CASE WHEN bad AND l_linenumber = 5 THEN NULL
         ELSE round(CAST(dur_h AS DOUBLE) + CAST(dur_m AS DOUBLE) / 60, 2) END AS e_duration,
    trim(p_type) AS e_aircraft,
    'Người lớn' AS e_passenger,
    1 AS e_tickets,
    CASE WHEN bad AND l_linenumber = 2 THEN NULL ELSE price0 END AS e_price,
    tax0 AS e_tax,
    price0 + tax0 AS e_total,
    CASE l_linenumber % 4 WHEN 0 THEN 18 WHEN 1 THEN 7 WHEN 2 THEN 10 END AS e_carry,
    CASE WHEN l_suppkey % 3 = 0 THEN 20 + 5 * (l_partkey % 3) END AS e_checked,
    CASE WHEN bad THEN CAST([] AS VARCHAR[])
         WHEN l_returnflag = 'A' THEN {_pylist_sql(POLICY_A)}
         WHEN l_returnflag = 'N' THEN {_pylist_sql(POLICY_N)}
         ELSE CAST([] AS VARCHAR[]) END AS e_policy,
    scrape_ts AS e_scrape,
    CASE WHEN bad AND l_linenumber IN (1, 4) THEN NULL ELSE p_brand END AS e_airline,
    CASE WHEN bad AND l_linenumber IN (1, 4) THEN NULL ELSE 'FL' || CAST(l_suppkey AS VARCHAR) END AS e_flight,
    CASE WHEN bad AND l_linenumber IN (1, 4) THEN NULL ELSE fare0 END AS e_fare,
    (bad AND l_linenumber IN (2, 3, 5, 6)) AS rejected,
    CASE WHEN bad AND l_linenumber = 2 THEN 'price_per_ticket'
         WHEN bad AND l_linenumber = 3 THEN 'departure_location'
         WHEN bad AND l_linenumber = 5 THEN 'flight_duration'
         WHEN bad AND l_linenumber = 6 THEN 'departure_time' END AS reject_reason,
    strftime(date_trunc('year', scrape_ts), '%d_%m_%Y') AS e_day,
    'SGN_to_' || arr_code0 AS e_route
  FROM ls
),
cl AS (SELECT * FROM lc WHERE NOT rejected)
"""

# Normalised tables from the expected clean rows.
TABLES = """
al_first AS (SELECT e_airline AS airline, min(e_scrape) AS first_seen FROM cl GROUP BY e_airline),
airline AS (
  SELECT 'AL' || lpad(CAST(rn AS VARCHAR), CAST(greatest(3, length(CAST(rn AS VARCHAR))) AS INTEGER), '0') AS airline_id, airline
  FROM (SELECT airline, row_number() OVER (ORDER BY first_seen ASC NULLS LAST, airline ASC NULLS LAST) AS rn
        FROM al_first)
),
airport AS (
  SELECT DISTINCT * FROM (
    SELECT e_dep_code AS airportcode, e_dep_loc AS location FROM cl
    UNION ALL SELECT e_arr_code, e_arr_loc FROM cl)
),
refund_policy AS (
  SELECT DISTINCT a.airline_id, t.e_fare AS fare, t.e_policy AS policy
  FROM (SELECT DISTINCT e_airline, e_fare, e_policy FROM cl) t
  LEFT JOIN airline a ON t.e_airline IS NOT DISTINCT FROM a.airline
),
schedule AS (
  SELECT DISTINCT e_dep_time, e_flight, e_dep_code, e_arr_code, e_duration, e_arr_time, e_aircraft FROM cl
),
ticket AS (
  SELECT DISTINCT t.e_dep_time, t.e_passenger, t.e_tickets, t.e_price, t.e_tax, t.e_total, t.e_carry,
         t.e_checked, t.e_scrape, t.e_flight, t.e_fare, t.e_dep_code, a.airline_id
  FROM (SELECT DISTINCT e_dep_time, e_passenger, e_tickets, e_price, e_tax, e_total, e_carry, e_checked,
               e_scrape, e_flight, e_fare, e_dep_code, e_airline, e_arr_code, e_duration, e_arr_time, e_aircraft
        FROM cl) t
  LEFT JOIN airline a ON t.e_airline IS NOT DISTINCT FROM a.airline
)
"""


def with_listing(select: str, tables: bool = False) -> str:
    """``WITH <listing CTEs>[, <table CTEs>] <select>``."""
    ctes = LISTING.strip()
    if tables:
        ctes += ",\n" + TABLES.strip()
    return f"WITH {ctes}\n{select}"


# Expected review rows (documents ⟕ labels), before cleaning.
REVIEWS = """
rv AS (
  SELECT d.doc_id, d.text, d.source, lb.quality, lb.toxic,
    CASE WHEN d.doc_id % 97 = 5 THEN NULL ELSE CAST(1 + d.doc_id % 5 AS DOUBLE) END AS e_rating,
    CASE WHEN d.doc_id % 10 = 3 THEN NULL
         WHEN d.doc_id % 89 = 7 THEN 'bad'
         ELSE 'ok' END AS info_kind,
    make_timestamp(2024, CAST(d.doc_id % 12 + 1 AS BIGINT), 1, 0, 0, 0) AS e_month,
    split_part(d.text, chr(10), 1) AS title
  FROM documents d LEFT JOIN labels lb ON d.doc_id = lb.doc_id
),
rk AS (SELECT *, dense_rank() OVER (ORDER BY source) - 1 AS airline_id0 FROM rv
       WHERE info_kind IS NOT NULL AND e_rating IS NOT NULL AND info_kind = 'ok')
"""


def norm_text(expr: str) -> str:
    """F7 in DuckDB."""
    return (f"regexp_replace(regexp_replace(lower(coalesce({expr}, '')), '\\s+', ' ', 'g'), "
            f"'[^\\p{{L}}\\p{{N}}_\\s]', '', 'g')")


def with_reviews(select: str) -> str:
    return f"WITH {REVIEWS.strip()}\n{select}"


INFO = """
inf AS (
  SELECT s.s_suppkey AS k, s.s_name, n.n_name,
         row_number() OVER (ORDER BY s.s_name) - 1 AS airline_id
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
)
"""


def with_info(select: str) -> str:
    return f"WITH {INFO.strip()}\n{select}"
