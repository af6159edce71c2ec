"""Feature tables of any width, scoring by names, repeated runs, saved pages."""

import datetime as dt

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from listinglab.operators import features as FE
from listinglab.operators import modeling as M
from listinglab.operators.cleaning import tag_listings, tagged_parts
from listinglab.sources import html as H

FRAME = ("Fare_Class string, Airline_id string, Arrival_Location_Code string, Aircraft_Type string, Refund_Policy array<string>, `Carry-on_Baggage` int, "
         "Checked_Baggage int, Flight_Duration double, Departure_Time timestamp_ntz, Scrape_Time timestamp_ntz, Total_Price long")


def _frame(spark, n=250):
    t = dt.datetime(2025, 1, 1, 7)
    return spark.createDataFrame([(f"F{k:03d}", "AL001" if k % 2 else None, "N01", "A321", ["Đổi vé", "Doi ve"] if k % 3 else None, None if k % 5 else 7, k % 4,
                                   1.0 + k % 3, t, t - dt.timedelta(days=k % 9), 1000 + 10 * (k % 3)) for k in range(n)], FRAME)


def test_every_category_and_label_has_a_slot(spark):
    f = _frame(spark)
    fm = FE.fit_features(f)
    names = fm.names()
    assert sum(n.startswith("Fare_Class_") for n in names) == 250 and "Airline_id_None" in names
    assert [n for n in names if n.lower().startswith("doi_ve")] == ["Doi_ve", "Doi_ve__2"]       # two labels, one ASCII form
    table, vector = FE.feature_table(f, fm), FE.assemble(f, fm)
    sums = table.agg(*[F.sum(F.coalesce(F.col(f"`{n}`"), F.lit(0))).cast("double") for n in names]).first()
    dense = vector.select(F.posexplode(vector_to_array("features")).alias("k", "x")).groupBy("k").agg(F.sum("x").alias("x")).orderBy("k").collect()
    assert [r.x for r in dense] == pytest.approx(list(sums), abs=1e-6)
    assert sums[names.index("Fare_Class_F249")] == 1


def test_unseen_values_are_zero_and_nulls_are_the_mean(spark):
    fm = FE.fit_features(_frame(spark))
    odd = _frame(spark, 1).withColumn("Fare_Class", F.lit("new")).withColumn("Carry-on_Baggage", F.lit(None).cast("int"))
    got = dict(zip(fm.names(), FE.assemble(odd, fm).select(vector_to_array("features")).first()[0], strict=True))
    assert sum(v for k, v in got.items() if k.startswith("Fare_Class_")) == 0 and got["Carry-on_Baggage"] == 0


def test_fitted_features_are_saved_and_read_back(spark, tmp_path):
    fm = FE.fit_features(_frame(spark))
    fm.save(spark, str(tmp_path / "fm"))
    assert FE.FeatureModel.load(spark, str(tmp_path / "fm")) == fm


def test_requests_with_names_get_ids(spark):
    requests = spark.createDataFrame([("Vietnam Airlines", "Ha Noi", "C_Boss"), ("nobody", None, "Eco")], "airline string, arrival_location string, fare_class string")
    airlines = spark.createDataFrame([("AL002", "Vietnam Airlines"), ("AL001", "Vietjet")], "Airline_id string, Airline string")
    airports = spark.createDataFrame([("HAN", "Ha Noi")], "AirportCode string, Location string")
    got = {(r.Airline_id, r.Arrival_Location_Code, r.Fare_Class) for r in M.lookup_requests(requests, airlines, airports).collect()}
    assert got == {("AL002", "HAN", "C_Boss"), (None, None, "Eco")}


def test_grids_and_ridge():
    assert {k: len(M.grid(k)) for k in ("GBT_fast", "GBT_slow", "RandomForest", "Ridge", "LinearRegression")} == {
        "GBT_fast": 32, "GBT_slow": 48, "RandomForest": 12, "Ridge": 6, "LinearRegression": 0}
    with pytest.raises(TypeError):
        M.ridge(1.0)()   # no penalty without the number of rows
    assert len(M.candidates()) == 5


def test_a_replayed_batch_adds_nothing(spark, tmp_path):
    from listinglab.plans.fixtures import raw_listings
    from listinglab.streaming.incremental import ingested, write_batch

    raw, out = raw_listings(spark, "/root/testdata/sf0.001").limit(300).cache(), str(tmp_path / "out")
    write_batch(raw, 0, out)
    write_batch(raw.limit(20), 1, out)
    clean, rejects = ingested(spark, out)
    want = clean.count() + rejects.count()
    write_batch(raw, 0, out)   # the batch again, as after a failure before the commit
    clean, rejects = ingested(spark, out)
    assert clean.count() + rejects.count() == want == 320
    parts = tagged_parts(tag_listings(raw))
    assert parts[0].columns == clean.columns and parts[1].columns == rejects.columns
    raw.unpersist()


def test_two_commits_leave_two_pointers(spark, tmp_path):
    from listinglab.sinks.files import commit_version, current_version

    root = str(tmp_path / "t")
    first = commit_version(spark, {"a": spark.range(3)}, root)
    second = commit_version(spark, {"a": spark.range(4)}, root)
    assert first != second and current_version(spark, root) == second
    assert sorted(p.name for p in (tmp_path / "t").glob("_CURRENT-*")) == ["_CURRENT-1", "_CURRENT-2"]


def test_a_cluster_without_a_shared_folder_is_an_error():
    from listinglab.session import checkpoint_root

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())


LISTING = """<div><table><tr><td><p>Sai Gon (SGN)</p><p>07:05 01/02/2025</p></td><td><p>2 giờ 5 phút</p><p>x</p><p>Máy bay: A321</p></td>
<td><p>Ha Noi (HAN)</p><p>09:10 01/02/2025</p></td><td><table class="n"><tr><td>logo</td><td><b>VJ &amp; co Chuyến bay: VJ1 Hạng vé : Eco</b> (chi tiết)</td></tr></table></td></tr></table>%s</div>"""
PRICES = "<table><tr><th>a</th></tr><tr><td>Người lớn</td><td>1</td><td>100 VNĐ</td><td>20 VNĐ</td><td>120 VNĐ</td></tr></table>"
BAGS = "<table><tbody><tr><td>h</td><td>i</td></tr><tr><td>carry</td><td>7kg</td></tr><tr><td>checked</td><td>20kg</td></tr></tbody></table>"
POLICY = "<table><tbody><tr><td>head</td></tr><tr><td>- one</td></tr><tr><td>- two</td></tr></tbody></table>"


def test_listing_pages(spark):
    pages = spark.createDataFrame([(1, LISTING % (PRICES + BAGS + POLICY)), (2, LISTING % PRICES), (3, "<p>no tables</p>"), (4, None)], "page_id long, html string")
    got = {r.page_id: r.asDict() for r in H.listing_rows(pages).collect()}
    assert set(got) == {1, 2}
    first = got[1]
    assert (first["Departure Location"], first["Arrival Time"], first["Flight Duration"], first["Aircraft Type"]) == (
        "Sai Gon (SGN)", "09:10 01/02/2025", "2 giờ 5 phút", "Máy bay: A321")
    assert first["Ticket Price"] == "VJ & co Chuyến bay: VJ1 Hạng vé : Eco"
    assert (first["Number of Tickets"], first["Total Price"], first["Carry-on Baggage"], first["Checked Baggage"], first["Refund Policy"]) == (
        "1", "120 VNĐ", "7kg", "20kg", ["- one", "- two"])
    assert got[2]["Total Price"] == "120 VNĐ" and got[2]["Carry-on Baggage"] is None and got[2]["Refund Policy"] is None


def test_review_pages(spark):
    one = ('<div class="lwGaE A"><svg class="UctUV d H0"><title>4.0 of 5 bubbles</title></svg><div class="biGQs _P fiohW uuBRH"><a>Good &lt;3</a></div>'
           '<span class="JguWG">Long <b>text</b></span><div class="biGQs _P pZUbB ncFvv osNWb">Date of travel: May 2024</div><div class="JxiyB f">'
           '<div class="msVPq"><svg class="UctUV d H0">3.0</svg><div class="biGQs _P pZUbB osNWb">Legroom</div></div><div class="msVPq"><div class="biGQs _P pZUbB osNWb">Food</div></div></div></div>')
    two = '<div class="lwGaE A"><div class="biGQs _P fiohW uuBRH">Only a title</div></div>'
    got = H.review_rows(spark.createDataFrame([(1, f"<html>{one}{two}</html>"), (2, "<html></html>"), (3, None)], "page_id long, html string")).orderBy("pos").collect()
    assert [(r.page_id, r.pos, r.Rating, r.Title, r["Full Review"], r.Information) for r in got] == [
        (1, 1, "4.0 of 5 bubbles", "Good <3", "Long text", "Date of travel: May 2024"), (1, 2, "", "Only a title", "", "")]
    assert [tuple(s) for s in got[0]["Service Ratings"]] == [("3.0", "Legroom"), ("", "Food")] and got[1]["Service Ratings"] is None


def test_info_pages(spark):
    page = ('<div class="jIkPg G u">Air</div><div class="jWfod u"><a href="tel:1">t</a><a href="http://a.example">w</a></div><span class="ammfn">4.1</span>'
            '<div class="TuqGj"><span class="_T">hub</span><span class="_T">cheap</span></div>'
            '<div class="HWAlD TQNLQ"><span class="exvvN">Legroom</span><span class="RkhSR">3.5</span></div><div class="HWAlD TQNLQ"><span class="exvvN">Food</span></div>'
            '<div class="jxnKb"><div class="Ygqck o W q">Good</div><div class="biGQs _P fiohW biKBZ osNWb">1,200</div></div>')
    got = {r.page_id: r for r in H.info_records(spark.createDataFrame([(1, page), (2, "<p></p>")], "page_id long, html string")).collect()}
    a, b = got[1], got[2]
    assert (a["name"], a.phone, a.average_rating, a.website, a.popular_mentions) == ("Air", "Not found", "4.1", ["http://a.example"], ["hub", "cheap"])
    assert a.attributes == {"Legroom": "3.5", "Food": ""} and a.total_ratings == {"Good": "1,200"}
    assert (b["name"], b.attributes, b.total_ratings, b.popular_mentions) == ("Not found", {}, {}, [])
