"""State in the stream, hashed tables, counts that take deltas, day sketches."""

import datetime as dt

import numpy as np
import pytest
from listinglab.operators import counted as CT
from listinglab.operators import sketches as SK
from listinglab.schemas import RAW_LISTING_COLUMNS
from listinglab.sinks import hashed as HT
from listinglab.streaming.incremental import ingest_distinct, ingested
from pyspark.sql import functions as F


def drop_file(spark, path, name, days):
    rows = [{c: f"{c} {d}" for c in RAW_LISTING_COLUMNS} | {"Scrape Time": (dt.datetime(2025, 1, 1) + dt.timedelta(days=d)).strftime("%Y-%m-%d %H:%M:%S") if d >= 0 else "never"}
            for d in days]
    text = ",".join(f'"{c}"' for c in RAW_LISTING_COLUMNS) + "\n" + "".join(",".join(f'"{r[c]}"' for c in RAW_LISTING_COLUMNS) + "\n" for r in rows)
    path.mkdir(exist_ok=True)
    (path / name).write_text(text)


def test_stream_state_is_bounded_by_the_watermark(spark, tmp_path):
    src, out, ck = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "ck")

    def run():
        return ingest_distinct(spark, str(src), out, ck, "10 days", transform=lambda df: df.withColumn("is_reject", F.lit(0)))

    def stored():
        return sorted(r["Scrape Time"][:10] for r in spark.read.parquet(out).collect())

    drop_file(spark, src, "a.csv", [0, 1, 2, 2, 2])
    assert run()["batches"] >= 1 and len(stored()) == 3
    drop_file(spark, src, "b.csv", [0, 1, 2, 3])   # the earlier rows again
    first = run()
    assert len(stored()) == 4 and first["state_rows"] == 4
    drop_file(spark, src, "c.csv", [100, 101])
    run()
    drop_file(spark, src, "d.csv", [102])
    later = run()
    assert len(stored()) == 7 and later["state_rows"] <= 3   # the first days have left the state
    drop_file(spark, src, "e.csv", [0, 1, 50])   # late: older than the watermark
    run()
    assert len(stored()) == 7
    drop_file(spark, src, "f.csv", [-1, -1])   # without a time: passes, for the rejects
    run()
    assert len(stored()) == 9


def test_hashed_table_touches_what_it_hits(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(200).select(F.col("id").alias("k"), F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("v"), F.array(F.col("id") % 2).alias("a"))
    HT.create_hashed(spark, path, rows.schema, rows.columns, 16)
    assert HT.read_hashed(spark, path).count() == 0
    assert HT.load_hashed(spark, path, rows.unionByName(rows))["added"] == 200
    files = {f: f.stat().st_mtime_ns for f in (tmp_path / "t" / "data").rglob("*.parquet")}
    one = rows.where("k = 7").withColumn("v", F.lit("new"))
    assert HT.load_hashed(spark, path, one) == {"touched": 1, "read": 1, "added": 1}
    now = {f: f.stat().st_mtime_ns for f in (tmp_path / "t" / "data").rglob("*.parquet")}
    gone = set(files) - set(now)
    assert len({f.parent for f in gone}) == 1 and all(now[f] == t for f, t in files.items() if f in now)
    assert HT.load_hashed(spark, path, rows.where("k < 5"))["touched"] == 0   # null values and arrays are equal to themselves
    got = {(r.k, r.v) for r in HT.read_hashed(spark, path).collect()}
    assert got == {(k, str(k) if k % 3 else None) for k in range(200)} | {(7, "new")}
    with pytest.raises(Exception):
        HT.create_hashed(spark, path, rows.schema, ["k"], 4)


def test_hashed_table_writes_a_touched_folder_once(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    HT.create_hashed(spark, path, rows.schema, ["k"], 4)
    for part in (rows.where("k < 30"), rows, rows.withColumn("v", F.lit(-1).cast("long"))):
        HT.load_hashed(spark, path, part)
    assert sorted((r.k, r.v) for r in HT.read_hashed(spark, path).collect()) == [(k, 2 * k) for k in range(50)]
    assert not list((tmp_path / "t").glob("*-final"))


def test_counts_follow_inserts_and_deletes(spark):
    rng = np.random.default_rng(4)
    schema = "g string, v string, x long"
    made = [(str(rng.integers(0, 3)) if rng.random() > 0.1 else None, str(rng.integers(0, 6)) if rng.random() > 0.2 else None, int(rng.integers(0, 50))) for _ in range(300)]
    rows = spark.createDataFrame(made, schema)
    gone, new = spark.createDataFrame(made[:120], schema), spark.createDataFrame(made[:40], schema)

    def counts(df):
        return CT.value_counts(df, ["v", "x"], "g")

    now = CT.apply_delta(counts(rows), counts(new), counts(gone))
    want = counts(spark.createDataFrame(made[120:] + made[:40], schema))
    assert sorted(map(tuple, now.collect()), key=repr) == sorted(map(tuple, want.select(*now.columns).collect()), key=repr)
    left = {}
    for g, _, x in made[120:] + made[:40]:
        left.setdefault(g or "", []).append(x)
    assert {r.group_key: (r.low, r.high, r.n) for r in CT.ranges(now, "x").collect()} == {g: (min(x), max(x), len(x)) for g, x in left.items()}
    with pytest.raises(Exception, match="more rows removed"):
        CT.apply_delta(counts(new), removed=counts(rows)).collect()


def test_sketches_merge_over_days(spark):
    rows = spark.range(60_000).select((F.col("id") % 30).alias("d"), (F.col("id") * 7919 % 5003).alias("v"), (F.col("id") * 31 % 10_007).cast("double").alias("x"),
                                      F.lit(None).cast("string").alias("none"))
    days = SK.day_sketches(rows, F.col("d"), ["v", "x", "none"])
    assert days.count() == 60
    got = {r.column_name: r for r in SK.distinct_counts(days, 5, 24).collect()}
    part = rows.where("d BETWEEN 5 AND 24")
    for c in ("v", "x"):
        exact = part.select(c).distinct().count()
        assert got[c].n == 40_000 and abs(got[c].distinct_values - exact) <= SK.DISTINCT_ERROR * exact
    for r in SK.quantiles(days, [0.1, 0.5, 0.9], 5, 24).where("column_name = 'x'").collect():
        below = part.where(F.col("x") <= r.value).count() / 40_000
        assert abs(below - r.share) <= SK.RANK_ERROR


def test_the_load_that_is_run_again_has_all_rows(spark, sf, monkeypatch):
    from listinglab.plans import q_stored as QS

    loads, load = [], HT.load_hashed
    monkeypatch.setattr(HT, "load_hashed", lambda s, path, new: loads.append((new.count(), load(s, path, new))) or loads[-1][1])
    rows = QS.i2_hashed_load(spark, sf).collect()
    assert all(r.rerun_adds_nothing and r.few_folders for r in rows)
    (first, _), (whole, _), (again, found), (few, narrow) = loads
    assert first < whole == again == sum(r.n for r in rows) and found == {"touched": 0, "read": 32, "added": 0}
    assert 4 < few < whole and narrow["read"] == 4


def test_a_load_leaves_its_table_alone(spark, tmp_path):
    """The plan of the new rows runs once a load, and nothing of a load stays beside the folders."""
    mark, path = tmp_path / "mark", str(tmp_path / "t")
    mark.mkdir()

    def passed(batches):
        import pathlib
        import uuid

        pathlib.Path(str(mark), uuid.uuid4().hex).touch()
        yield from batches

    rows = spark.range(40, numPartitions=1).selectExpr("id AS k", "id % 7 AS v")
    HT.create_hashed(spark, path, rows.schema, rows.columns, 4)
    loads = [HT.load_hashed(spark, path, r.mapInArrow(passed, r.schema)) for r in (rows.where("k < 30"), rows, rows)]
    assert [x["added"] for x in loads] == [30, 10, 0] and len(list(mark.iterdir())) == 3
    assert sorted(f.name for f in (tmp_path / "t").iterdir()) == ["_table", "data"]
    assert HT.read_hashed(spark, path).count() == 40
