"""Queries that read their rows once, whatever is made of them, and files and state that stay small."""

import datetime as dt
import glob
import os

from pyspark.sql import functions as F

from listinglab.operators import aggregate as A
from listinglab.operators import cleaning as CL
from listinglab.operators import normalize as N
from listinglab.plans import q_reviews as QR
from listinglab.schemas import RAW_LISTING
from listinglab.sinks import files as K
from listinglab.sources import files as S
from listinglab.streaming.incremental import distinct_in_stream

RAW = {"Departure Location": "A (AAA)", "Departure Time": "07:05 01/02/2025", "Arrival Location": "B (BBB)", "Arrival Time": "08:30 PM, 1/2/2025", "Flight Duration": "1 giờ 5 phút",
       "Aircraft Type": "Máy bay: X", "Ticket Price": "Z Chuyến bay: F1 Hạng vé : E", "Passenger Type": "p", "Number of Tickets": "1", "Price per Ticket": "1,000 VNĐ",
       "Taxes & Fees": "10 VNĐ", "Total Price": "1,010 VNĐ", "Carry-on Baggage": "7kg", "Checked Baggage": None, "Refund Policy": "[]", "Scrape Time": "2025-01-01 00:00:00"}


def raw(spark, *changes):
    return spark.createDataFrame([tuple({**RAW, **c}[f.name] for f in RAW_LISTING.fields) for c in changes], RAW_LISTING)


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_the_cleaner_is_few_projections(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw(spark, {}, {"Arrival Time": "soon"}, {"Checked Baggage": "20kg", "Departure Time": "00:00 31/02/2025"}).write.parquet(path)
    df = CL.clean_listings(spark.read.parquet(path))
    assert optimized(df.select("`Total Price`")).count("Project") <= 3
    row = df.first()
    assert df.count() == 1 and row["Arrival Time"] == dt.datetime(2025, 2, 1, 20, 30) and row["Departure Time"] == dt.datetime(2025, 2, 1, 7, 5)
    rejects = CL.clean_listings_split(spark.read.parquet(path))[1]
    assert sorted(r["reject_reasons"] for r in rejects.collect()) == ["arrival_time", "departure_time"]


def test_aggregates_read_the_rows_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).select((F.col("id") % 7).alias("x"), F.timestamp_seconds(F.col("id") * 40_000).cast("timestamp_ntz").alias("at")).write.parquet(path)
    df = spark.read.parquet(path)
    found = A.calendar_counts_of(df, "at")
    assert optimized(found).count("Relation") == 1
    for part in ("month", "day", "weekday", "hour"):
        want = [(r[part], r["count"]) for r in A.calendar_counts(df, "at", part).collect()]
        assert [(r["value"], r["count"]) for r in found.where(F.col("part") == part).collect()] == want
    for out in (A.histogram(df, "x", 3), A.iqr_outliers(df, "x")):
        assert "Relation" not in optimized(out)   # the counts of the values are all that is read again
    assert {r["bin"]: r["count"] for r in A.histogram(df, "x", 3).collect()} == {0: 286, 1: 286, 2: 428}


def test_airports_read_the_rows_once(spark, tmp_path):
    path = str(tmp_path / "c")
    CL.clean_listings(raw(spark, {}, {"Arrival Location": "C (CCC)"})).write.parquet(path)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = N.make_airports(spark.read.parquet(path))
        assert sorted(map(tuple, found.collect())) == [("AAA", "A"), ("BBB", "B"), ("CCC", "C")]
        assert "ReusedExchange" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_raw_files_are_compressed_and_read_back(spark, tmp_path):
    path = str(tmp_path / "raw")
    rows = raw(spark, *[{"Total Price": f"{k} VNĐ"} for k in range(500)]).select("*", F.lit("01_01_2025").alias("day"), F.lit("AAA_to_BBB").alias("route"))
    K.append_raw(rows, path)
    K.append_raw(rows, path)
    files = glob.glob(f"{path}/**/part-*", recursive=True)
    assert files and all(f.endswith(".csv.gz") for f in files)
    back = S.read_listings(spark, path)
    assert back.count() == 1000 and back.exceptAll(rows.unionAll(rows).select(*back.columns)).count() == 0


def test_stream_state_holds_a_short_key(spark, tmp_path):
    path = str(tmp_path / "in")
    raw(spark, {}).write.option("header", True).csv(path)
    stream = distinct_in_stream(spark.readStream.schema(RAW_LISTING).option("header", True).csv(path), "93 days")
    assert "DeduplicateWithinWatermark [_key" in stream._jdf.queryExecution().analyzed().toString().replace("'", "")
    assert stream.columns == [f.name for f in RAW_LISTING.fields]


def test_info_records_are_files_of_one_folder(spark, sf, tmp_path, monkeypatch):
    path = str(tmp_path / "info")
    monkeypatch.setattr(QR, "work_path", lambda s, name: path)
    names = QR.s3_read_info(spark, sf)
    suppliers = spark.read.parquet(f"{sf}/supplier.parquet").count()
    files = [f for f in glob.glob(f"{path}/part-*.txt") if os.path.getsize(f)]   # an empty partition may leave an empty one
    assert names.agg(F.sum("n")).first()[0] == suppliers == len(files) and not glob.glob(f"{path}/*/")


def test_onehot_sums_make_no_dense_vectors(spark, sf):
    from listinglab.plans.q_model import m5_onehot

    assert "vector_to_array" not in optimized(m5_onehot(spark, sf)).lower() and "arrays_zip" in optimized(m5_onehot(spark, sf))


def test_constant_columns_need_no_table_of_values(spark):
    rows = [(1, -0.0, float("nan"), ["a"], None, "x", None), (1, 0.0, float("nan"), ["a"], None, None, "a"), (1, None, None, None, None, "x", "b")]
    schema = "i int, z double, nan double, l array<string>, n string, s string, t string"
    df = spark.createDataFrame(rows, schema)
    found = A.constant_columns(df, df.columns)
    assert sorted(tuple(r) for r in found.collect()) == [("i", 1), ("l", 1), ("n", 0), ("nan", 1), ("s", 1)]
    assert found.dtypes == [("column_name", "string"), ("num_values", "bigint")]
    assert "Expand" not in found._jdf.queryExecution().optimizedPlan().toString()
    empty = A.constant_columns(df.where("i > 1"), ["i", "l"])
    assert sorted(tuple(r) for r in empty.collect()) == [("i", 0), ("l", 0)]
