"""Row-level parsing edge cases (FIXTURES.md §8) on hand-made frames."""

import ast
import datetime as dt

from pyspark.sql import functions as F

from listinglab.functions import calendar as C
from listinglab.functions import parsing as P
from listinglab.functions import text as T
from listinglab.operators import cleaning as CL
from listinglab.schemas import RAW_LISTING_COLUMNS


def _one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr(F.col("v")).alias("o")).first()["o"]


def test_ticket_split(spark):
    rows = [("Vietnam Airlines Chuyến bay: VN123 Hạng vé : L",), ("Bamboo FL1",), (None,),
            ("A Chuyến bay: X1 Chuyến bay: X2 Hạng vé : Z",), ("A Chuyến bay: X1 Hạng vé : Z Hạng vé : Q",)]
    df = CL.split_ticket(spark.createDataFrame(rows, "`Ticket Price` string"))
    got = [tuple(r) for r in df.collect()]
    assert got[0] == ("Vietnam Airlines", "VN123", "L")
    assert got[1] == (None, None, None)          # no marker: all NULL
    assert got[2] == (None, None, None)          # NULL text
    assert got[3] == (None, None, None)          # second flight marker before the fare marker
    assert got[4] == ("A", "X1", "Z")            # text up to the 2nd fare marker only


def test_currency(spark):
    assert _one(spark, P.currency, "1,249,000 VNĐ") == 1249000
    assert _one(spark, P.currency, "abc VNĐ") is None
    assert _one(spark, P.currency, "1,000") == 1000       # no VNĐ
    assert _one(spark, P.currency, None) is None


def test_dayfirst_and_iso(spark):
    assert _one(spark, P.dayfirst_timestamp, "09:05 31/03/2025") == dt.datetime(2025, 3, 31, 9, 5)
    assert _one(spark, P.dayfirst_timestamp, "9:05, 1/4/2025") == dt.datetime(2025, 4, 1, 9, 5)
    assert _one(spark, P.dayfirst_timestamp, "25:05 31/03/2025") is None
    assert _one(spark, P.dayfirst_timestamp, "soon") is None
    assert _one(spark, P.dayfirst_timestamp, "10:00 31/02/2025") is None      # no Feb 31
    assert _one(spark, P.iso_timestamp, "2025-03-31 09:57:04") == dt.datetime(2025, 3, 31, 9, 57, 4)
    assert _one(spark, P.iso_timestamp, "nope") is None


def test_dayfirst_forms(spark):
    for text, want in [("07:05:59 01/02/2025", (7, 5, 59)), ("08:30 PM 01/02/2025", (20, 30, 0)), ("01/02/2025 08:30", (8, 30, 0)),
                       ("01/02/2025, 12:10:05 am", (0, 10, 5)), ("12:00 pm 01/02/2025", (12, 0, 0))]:
        assert _one(spark, P.dayfirst_timestamp, text) == dt.datetime(2025, 2, 1, *want)
    for text in ("13:00 PM 01/02/2025", "0:10 AM 01/02/2025", "07:61 01/02/2025", "07:05:60 01/02/2025", "07 01/02/2025", "07:05 XX 01/02/2025", "01/02/2025"):
        assert _one(spark, P.dayfirst_timestamp, text) is None


def test_staged_dayfirst_matches_expression(spark):
    vals = ["07:05:59 01/02/2025", "08:30 PM 01/02/2025", "01/02/2025 08:30", "12:10 am, 1/2/2025", "13:00 PM 1/2/2025", "1:2:3:4 1/2/2025", "1/2/2025", "", "09:05 31/03/2025", "9:5 1/4/2025", "23:59 29/02/2024", "bad", None, "12:00 31/04/2025"]
    df = spark.createDataFrame([(v, v) for v in vals], "`Departure Time` string, x string")
    staged = CL.with_dayfirst(df, ["Departure Time"]).select("Departure Time", P.dayfirst_timestamp("x").alias("e"))
    for r in staged.collect():
        assert r[0] == r[1]


def test_aircraft_duration_baggage(spark):
    assert _one(spark, P.aircraft, "Máy bay: Airbus A321 (máy bay lớn)") == "Airbus A321"
    assert _one(spark, P.duration_hours, "1 giờ 20 phút") == 1.33
    assert _one(spark, P.duration_hours, "2 giờ 0 phút") == 2.0
    assert _one(spark, P.duration_hours, "N/A") is None
    assert _one(spark, P.carry_on_kg, "2 x 9kg") == 18
    assert _one(spark, P.carry_on_kg, "7kg") == 7
    assert _one(spark, P.carry_on_kg, None) is None
    assert _one(spark, P.checked_kg, "Vui lòng chọn ở bước tiếp theo") is None
    assert _one(spark, P.checked_kg, "20kg") == 20


def test_policy_literals(spark):
    assert _one(spark, P.policy_list, "['- Áp dụng hoàn vé mất phí', '- Áp dụng đổi vé miễn phí, thu chênh lệch giá']") == [
        "- Áp dụng hoàn vé mất phí", "- Áp dụng đổi vé miễn phí, thu chênh lệch giá"]
    assert _one(spark, P.policy_list, "[]") == []
    assert _one(spark, P.policy_list, None) == []
    assert _one(spark, P.policy_list, "['- broken") == []
    assert _one(spark, P.policy_list, "[\"it's\", 'x']") == ["it's", "x"]
    for literal in ("""["a', 'b"]""", """['x, y', "[z]", 'it\\'s', ""]""", r"""['a\nb', "tab\there", 'caf\xe9', '\u1ea1 ok', 'back\\slash', '\\n']""", "['one',]"):
        assert _one(spark, P.policy_list, literal) == ast.literal_eval(literal)
    labels = spark.createDataFrame([(["- a", "- b - c"],)], "v array<string>").select(P.policy_labels("v")).first()[0]
    assert labels == ["a", "b c"]


def test_long_policy_items(spark):
    """An item of any length is read: a pattern with a choice for each character ends in a StackOverflowError."""
    long = "é, x " * 40_000
    for items in ([f"- {long}", "- b"], [f"it's {long}", "say 'b'"], [f'a\\ "{long}"', "b\n"]):
        assert _one(spark, P.policy_list, repr(items)) == items
    assert _one(spark, P.policy_list, f"['{long}") == []
    assert _one(spark, P.policy_list, "[ 'a' , '', \"\u0001\", ]") == ["a", "", "\u0001"]


def test_location(spark):
    assert _one(spark, P.location_name, "Hà Nội (HAN)") == "Hà Nội"
    assert _one(spark, P.location_code, "Hà Nội (HAN)") == "HAN"
    assert _one(spark, P.location_code, "Hà Nội") is None


def test_reject_routing(spark):
    good = ["Hà Nội (HAN)", "09:05 31/03/2025", "Đà Nẵng (DAD)", "10:25 31/03/2025", "1 giờ 20 phút",
            "Máy bay: Airbus A321", "VN Chuyến bay: VN1 Hạng vé : L", "Người lớn", "1", "1,000 VNĐ", "100 VNĐ",
            "1,100 VNĐ", "7kg", "Vui lòng chọn ở bước tiếp theo", "['- a']", "2025-03-01 08:00:00"]
    bad = list(good)
    bad[9] = "abc VNĐ"
    noparen = list(good)
    noparen[0] = "Hà Nội"
    df = spark.createDataFrame([tuple(good), tuple(bad), tuple(noparen)], CL_schema())
    valid, rejects = CL.clean_listings_split(df)
    assert valid.count() == 1
    reasons = sorted(r[0] for r in rejects.select(CL.REJECT_REASONS).collect())
    assert reasons == ["departure_location", "price_per_ticket"]
    v = valid.first()
    assert v["Checked Baggage"] is None and v["Total Price"] == 1100 and v["Airline"] == "VN"


def CL_schema():
    return ", ".join(f"`{c}` string" for c in RAW_LISTING_COLUMNS)


def test_text_functions(spark):
    assert _one(spark, T.bubbles, "4.0 of 5 bubbles") == 4.0
    assert _one(spark, T.bubbles, "great") is None
    assert _one(spark, T.travel_month, "Date of travel: March 2024") == dt.datetime(2024, 3, 1)
    assert _one(spark, T.travel_month, "Date of travel: Smarch 2024") is None
    assert _one(spark, T.normalize_text, "Tôi  đã\tbay!  It's ok") == "tôi đã bay its ok"
    assert _one(spark, T.normalize_text, None) == ""
    assert _one(spark, lambda c: T.stars(c), 2.5, "v double") == "★★⯪☆☆"
    assert _one(spark, lambda c: T.stars(c), 4.0, "v double") == "★★★★☆"
    assert _one(spark, T.comma_int, "4,035") == 4035
    assert _one(spark, T.ascii_fold, "Đà Nẵng Người lớn") == "Da Nang Nguoi lon"
    assert T.fold_name("Taxes & Fees") == "Taxes_&_Fees"
    assert T.fold_name("- Áp dụng đổi vé miễn phí, thu chênh lệch giá") == "Ap_dung_doi_ve_mien_phi_thu_chenh_lech_gia"
    assert _one(spark, lambda c: T.sentiment_bucket(c), 3, "v int") == "Neutral"


def test_calendar(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 3, 31, 6, 0), dt.datetime(2025, 3, 31, 11, 0))],
                               "d timestamp_ntz, s timestamp_ntz")
    r = df.select(C.days_between("d", "s").alias("days"), C.weekday_monday0("d").alias("wd"),
                  C.day_group("d").alias("g"), C.hour_of_day("d").alias("h")).first()
    assert r["days"] == -1       # scrape 5 hours after departure
    assert r["wd"] == 0          # a Monday
    assert r["g"] == "21-30"     # day 31 joins the last bin
    assert r["h"] == 6
    w = spark.createDataFrame([(dt.date(2025, 8, 15),)], "d date").select(C.window_end("d", 3)).first()[0]
    assert w == dt.date(2025, 10, 31)
    assert spark.range(1).select(C.dim_id(F.lit(1234))).first()[0] == "AL1234"
    assert spark.range(1).select(C.dim_id(F.lit(7))).first()[0] == "AL007"
