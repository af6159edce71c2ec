"""Bucketed joins without a shuffle, look-ups that read few row groups."""

from listinglab.operators.joins import ticket_schedule
from listinglab.schemas import SCHEDULE_KEY
from listinglab.sinks.layout import write_bucketed, write_lookup
from listinglab.sources.files import lookup_rows
from pyspark.sql import functions as F


def test_bucketed_tables_join_without_an_exchange(spark):
    rows = spark.range(4000).select(
        F.timestamp_seconds(F.col("id") % 97).cast("timestamp_ntz").alias("Departure Time"), (F.col("id") % 53).cast("string").alias("Flight Code"),
        F.lit("SGN").alias("Departure Location Code"), F.col("id").alias("v"))
    left = write_bucketed(rows, SCHEDULE_KEY, 6)
    right = write_bucketed(rows.where("v < 500").withColumnRenamed("v", "w"), SCHEDULE_KEY, 6)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        joined = ticket_schedule(left, right, SCHEDULE_KEY)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        plain = rows.join(rows.where("v < 500").withColumnRenamed("v", "w"), SCHEDULE_KEY)
        assert joined.count() == plain.count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def rows_read(df):
    """Rows that the scan of a look-up gives to its filter."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaf = plan.collectLeaves().apply(0)
    return leaf.metrics().apply("numOutputRows").value()


def test_a_lookup_reads_few_row_groups(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = spark.range(200_000).select((F.col("id") * 7919 % 20_011).alias("code"), F.xxhash64("id").alias("other"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
        plain = str(tmp_path / "plain")
        rows.write.parquet(plain)
        table = write_lookup(rows, str(tmp_path / "t"), "code", ["other"], files=8, row_group_bytes=1 << 19)
        want = sorted(map(tuple, lookup_rows(spark.read.parquet(plain), "code", 4242).collect()))
        found = lookup_rows(table, "code", 4242)
        assert sorted(map(tuple, found.collect())) == want and len(want) > 5
        assert rows_read(found) < 20_000
        # A value that is not there: the range of its column holds it, the filter does not.
        assert rows_read(lookup_rows(table, "other", 1)) < rows_read(lookup_rows(spark.read.parquet(plain), "other", 1)) / 4
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
