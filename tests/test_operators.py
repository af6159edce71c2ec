"""Operator semantics and properties on hand-made frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from listinglab.operators import aggregate as A
from listinglab.operators import features as FE
from listinglab.operators import joins as J
from listinglab.operators import maintain as I
from listinglab.operators import normalize as N
from listinglab.operators import ordering as W
from listinglab.operators.keys import consecutive_index


def test_consecutive_index_is_dense_and_ordered(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k"))
    out = consecutive_index(df, [F.col("k")], "i", start=0, partitions=7).collect()
    assert sorted((r["k"], r["i"]) for r in out) == [(k, k) for k in range(1000)]


def test_airline_ids_registry(spark):
    t = lambda d: dt.datetime(2025, 1, d)
    day1 = spark.createDataFrame([("B", t(2)), ("A", t(3)), (None, t(1))], "Airline string, `Scrape Time` timestamp_ntz")
    reg = N.make_airlines(day1)
    # order of first appearance (earliest scrape), NULL name included
    assert {r[1]: r[0] for r in reg.collect()} == {None: "AL001", "B": "AL002", "A": "AL003"}
    day2 = spark.createDataFrame([("C", t(1)), ("A", t(1))], "Airline string, `Scrape Time` timestamp_ntz")
    both = {r[1]: r[0] for r in N.make_airlines(day2, registry=reg).collect()}
    assert both == {None: "AL001", "B": "AL002", "A": "AL003", "C": "AL004"}   # ids never change


def test_null_safe_lookup(spark):
    fact = spark.createDataFrame([("A", 1), (None, 2)], "Airline string, x int")
    dim = spark.createDataFrame([("AL001", "A"), ("AL002", None)], "Airline_id string, Airline string")
    got = sorted((r["x"], r["Airline_id"]) for r in N.key_lookup(fact, dim, "Airline").collect())
    assert got == [(1, "AL001"), (2, "AL002")]


def test_group_number_alphabetical(spark):
    df = spark.createDataFrame([("Vietnam Airlines",), ("Bamboo Airways",), ("VietJetAir",), ("Bamboo Airways",)], "a string")
    got = {r["a"]: r["airline_id"] for r in N.group_number(df, "a").collect()}
    assert got == {"Bamboo Airways": 0, "VietJetAir": 1, "Vietnam Airlines": 2}


def test_check_key(spark):
    df = spark.createDataFrame([(1, "x", "p"), (1, "y", "p"), (2, "z", "q")], "k int, a string, b string")
    got = {r["column_name"]: (r["violating_keys"], r["holds"]) for r in N.check_key(df, ["k"], ["a", "b"]).collect()}
    assert got == {"a": (1, False), "b": (0, True)}


def test_dedupe_idempotent_and_merge(spark):
    df = spark.createDataFrame([("SGN", "HCM"), ("SGN", "HCM"), (None, "X"), (None, "X")], "c string, l string")
    once = W.dedupe(df)
    assert once.count() == 2 and W.dedupe(once).count() == 2
    new = spark.createDataFrame([("HAN", "Hà Nội"), ("SGN", "HCM")], "c string, l string")
    assert I.merge_distinct(once, new).count() == 3
    assert I.merge_distinct(once, new, ["c"]).count() == 3


def test_retention_boundary_and_cascade(spark):
    now = "2025-05-31 10:00:00"
    assert I.cutoff(now, 3) == dt.datetime(2025, 2, 28, 10, 0)   # clipped to month end, time kept
    tickets = spark.createDataFrame([
        (dt.datetime(2025, 2, 28, 10, 0), "F1"), (dt.datetime(2025, 2, 28, 10, 1), "F2"), (None, "F3")],
        "`Scrape Time` timestamp_ntz, `Flight Code` string")
    kept = {r[1] for r in I.retain(tickets, "Scrape Time", 3, now).collect()}
    assert kept == {"F2", "F3"}          # boundary deleted, NULL kept
    sched = spark.createDataFrame([("F1",), ("F2",), ("F9",)], "`Flight Code` string")
    left = {r[0] for r in I.drop_orphans(sched, I.retain(tickets, "Scrape Time", 3, now), ["Flight Code"]).collect()}
    assert left == {"F2"}


def test_normalize_join_restores_tickets(spark):
    from listinglab.plans.fixtures import raw_listings
    from listinglab.operators.cleaning import clean_listings

    clean = clean_listings(raw_listings(spark, "/root/testdata/sf0.001")).cache()
    t = N.normalize(clean)
    joined = J.ticket_schedule(t["ticket"], t["flight_schedule"])
    keys = ["Departure Time", "Flight Code", "Departure Location Code"]
    full = t["ticket"].where(F.col("`Departure Time`").isNotNull() & F.col("`Flight Code`").isNotNull()
                             & F.col("`Departure Location Code`").isNotNull())
    # every ticket with a full key fans out to the schedules of its key
    per_key = t["flight_schedule"].groupBy(*[F.col(f"`{k}`") for k in keys]).count()
    expected = full.join(per_key, keys).agg(F.sum("count")).first()[0]
    assert joined.count() == expected
    unique = N.check_key(t["flight_schedule"], keys, ["Arrival Location Code"]).first()
    assert unique["holds"] == (expected == full.count())
    assert J.null_key_count(t["ticket"], ["Departure Time", "Flight Code", "Departure Location Code"]).first()[0] \
        == t["ticket"].count() - full.count()


def test_exact_quantiles_match_percentile(spark):
    df = spark.range(0, 997).select(((F.col("id") * 37) % 101).cast("double").alias("v"))
    got = {r["q"]: r["value"] for r in A.exact_quantiles(df, "v", (0.25, 0.5, 0.75)).collect()}
    exp = df.agg(*[F.percentile("v", q).alias(str(q)) for q in (0.25, 0.5, 0.75)]).first()
    for q in (0.25, 0.5, 0.75):
        assert got[q] == pytest.approx(exp[str(q)])


def test_scaler_constant_and_inverse(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0)], "a double, b double")
    p = {r[0]: (r[1], r[2]) for r in FE.fit_scaler(df, ["a", "b"]).collect()}
    assert p["a"] == (2.0, 1.0) and p["b"] == (5.0, 1.0)       # population std; std 0 -> 1
    s = FE.scale(df, p)
    back = s.select(FE.inverse_scale(F.col("a"), *p["a"]).alias("a")).collect()
    assert [r[0] for r in back] == [1.0, 3.0, None]


def test_onehot_unseen_and_null(spark):
    train = spark.createDataFrame([("C_Boss",), ("C_BOSS",), (None,)], "Fare_Class string")
    cats = FE.fit_onehot(train, ["Fare_Class"])
    names = sorted(r[1] for r in cats.collect())
    assert names == ["C_BOSS", "C_Boss", "None"]          # case-sensitive, NULL is a category
    score = spark.createDataFrame([("Z",), ("C_Boss",)], "Fare_Class string")
    out = FE.onehot(score, cats).collect()
    # binary order: C_BOSS < C_Boss; the second name is made unique for Spark
    assert (out[0]["Fare_Class_C_BOSS"], out[0]["Fare_Class_C_Boss__2"], out[0]["Fare_Class_None"]) == (0, 0, 0)
    assert out[1]["Fare_Class_C_Boss__2"] == 1 and out[1]["Fare_Class_C_BOSS"] == 0


def test_multilabel_ignores_unseen(spark):
    df = spark.createDataFrame([(["a", "b"],), ([],)], "Refund_Policy array<string>")
    out = FE.multilabel(spark.createDataFrame([(["b", "zzz"],)], "Refund_Policy array<string>"), FE.fit_multilabel(df))
    r = out.first()
    assert r["a"] == 0 and r["b"] == 1 and "zzz" not in out.columns


def test_value_ratios_and_dominant(spark):
    df = spark.createDataFrame([("x", "P"), ("x", "P"), ("x", "N"), ("y", "N"), ("y", None)], "k string, s string")
    vr = {(r[0], r[1]): r[2] for r in A.value_ratios(df, ["s"]).collect()}
    assert vr == {("s", "P"): 50.0, ("s", "N"): 50.0}
    dom = {r["k"]: (r["top_value"], r["top_count"], r["total"], r["percent"]) for r in A.dominant(df, "k", "s").collect()}
    assert dom == {"x": ("P", 2, 3, 66.67), "y": ("N", 1, 1, 100.0)}


def test_top_n_fewer_rows_ok(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1), "a"), (None, "b")], "Information timestamp_ntz, t string")
    got = [r["t"] for r in W.top_n(df, "Information", 5, ascending=False).collect()]
    assert got == ["a", "b"]      # NULL last in both directions


def test_best_model(spark):
    res = spark.createDataFrame([("a", 0.9, 2.0), ("b", 0.9, 1.0), ("c", 0.5, 0.1)], "model_name string, mean_r2 double, mean_rmse double")
    assert W.best_model(res).first()["model_name"] == "b"
    assert W.best_model(res, "mean_rmse").first()["model_name"] == "c"


def test_commit_version_all_or_nothing(spark, tmp_path):
    from listinglab.sinks.files import commit_version, current_version

    root = str(tmp_path / "tables")
    a = spark.range(3).toDF("x")
    b = spark.range(5).toDF("y")
    v1 = commit_version(spark, {"a": a, "b": b}, root)
    assert current_version(spark, root) == v1
    bad = spark.range(2).select((F.lit(1) / F.lit(0)).cast("int").alias("x"))   # fails under ANSI at write time
    with pytest.raises(Exception):
        commit_version(spark, {"a": a, "b": bad.select(F.assert_true(F.lit(False)).alias("y"))}, root)
    # the pointer still names the complete first version
    assert current_version(spark, root) == v1
    assert spark.read.parquet(f"{v1}/b").count() == 5


def test_hot_value_spreads_over_partitions(spark):
    """One value holds a third of all rows: exact quantiles stay exact and the
    numbering does not put the hot value into a single task."""
    n = 30000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(5.0)).otherwise((F.col("id") % 997).cast("double")).alias("v"),
                               F.col("id"))
    got = {r["q"]: r["value"] for r in A.exact_quantiles(df, "v", (0.25, 0.5, 0.75)).collect()}
    exp = df.agg(*[F.percentile("v", q).alias(str(q)) for q in (0.25, 0.5, 0.75)]).first()
    for q in (0.25, 0.5, 0.75):
        assert got[q] == pytest.approx(exp[str(q)])
    vals = df.select("v", F.xxhash64("v", "id").alias("_t"))
    ranged = vals.repartitionByRange(8, "v", "_t").withColumn("p", F.spark_partition_id())
    hot = ranged.where("v = 5.0").groupBy("p").count().collect()
    assert len(hot) >= 2 and max(r["count"] for r in hot) < n // 3
