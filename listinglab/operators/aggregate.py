"""Profiling and option aggregates.

Per-column results are returned in *long* form (one row per column, or per
column and value) built with ``stack``/``unpivot`` plus a grouped
aggregate, so the work is spread over the cluster by (column, value) and
nothing is collected into one row or one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar as C
from ..session import cut_lineage


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def _long(df: DataFrame, cols: Sequence[str], name: str = "column_name", value: str = "value") -> DataFrame:
    """Unpivot ``cols`` (cast to string) into (column_name, value) rows."""
    s = df.select(*[_q(c).cast("string").alias(c) for c in cols])
    return s.unpivot([], list(cols), name, value)


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A1: distinct non-NULL values per column, as (column_name, value)."""
    return _long(df, cols).where(F.col("value").isNotNull()).distinct()


def range_by(df: DataFrame, key: str, col: str) -> DataFrame:
    """A2: min and max of ``col`` per ``key``."""
    return df.groupBy(_q(key)).agg(F.min(_q(col)).alias("min"), F.max(_q(col)).alias("max"))


_PARTS = {
    "month": F.month, "day": F.dayofmonth, "weekday": C.weekday_monday0, "hour": F.hour,
}


def calendar_counts(df: DataFrame, col: str, part: str) -> DataFrame:
    """A3: row count per calendar part (month, day, weekday Monday=0, hour)."""
    return df.groupBy(_PARTS[part](_q(col)).alias(part)).count().orderBy(part)


def calendar_counts_of(df: DataFrame, col: str, parts: Sequence[str] = tuple(_PARTS)) -> DataFrame:
    """A3 for several parts in one pass: (part, value, count), in the order of the parts.

    Rows are counted by all parts together first, a table that the calendar
    bounds (at most 62,496 rows and one), and each part is summed from it."""
    joint = df.groupBy(*[_PARTS[p](_q(col)).alias(p) for p in parts]).agg(F.count(F.lit(1)).alias("n"))
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("place"), F.lit(p).alias("part"), _q(p).cast("int").alias("value")) for k, p in enumerate(parts)]))
    counts = joint.select(each.alias("e"), "n").groupBy("e.place", "e.part", "e.value").agg(F.sum("n").alias("count"))
    return counts.orderBy("place", "value").select("part", "value", "count")


def bin_counts(df: DataFrame, col: str) -> DataFrame:
    """A4: count per (month period, 10-day bin)."""
    return df.groupBy(C.month_label(_q(col)).alias("month"), C.day_group(_q(col)).alias("day_group")) \
        .agg(F.count(F.lit(1)).alias("flight_count"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """A5: value counts, NULL not counted, most frequent first (ties by value)."""
    return (df.where(_q(col).isNotNull()).groupBy(_q(col).alias("value")).count()
            .orderBy(F.desc("count"), F.asc("value")))


def dominant(df: DataFrame, key: str, col: str) -> DataFrame:
    """Per key: top value, its count, the total and percent (2 places).

    Counts are pre-aggregated per (key, value); the window then ranks the
    handful of values inside each key. Ties go to the smaller value.
    """
    counts = df.where(_q(col).isNotNull()).groupBy(_q(key).alias(key), _q(col).alias("value")).count()
    w = Window.partitionBy(key)
    ranked = counts.withColumn("_rn", F.row_number().over(w.orderBy(F.desc("count"), F.asc("value")))) \
        .withColumn("total", F.sum("count").over(w))
    return ranked.where("_rn = 1").select(
        key, F.col("value").alias("top_value"), F.col("count").alias("top_count"), "total",
        F.round(F.col("count") / F.col("total") * 100, 2).alias("percent"))


def _set_keep_null(col: Column) -> Column:
    """collect_set that keeps a NULL member (wrapped in a struct), sorted."""
    return F.array_sort(F.transform(F.collect_set(F.struct(col.alias("v"))), lambda s: s["v"]))


def policies_by_fare(df: DataFrame, airline: str = "Airline", fare: str = "Fare Class",
                     col: str = "Refund Policy") -> DataFrame:
    """Set of policy labels (``- `` stripped) per (airline, fare); an
    empty list contributes a NULL member."""
    e = df.select(_q(airline).alias(airline), _q(fare).alias(fare), F.explode_outer(_q(col)).alias("_p"))
    e = e.select(airline, fare, F.replace(F.col("_p"), F.lit("- "), F.lit("")).alias("policy"))
    return e.groupBy(airline, fare).agg(_set_keep_null(F.col("policy")).alias("policies"))


def baggage_by_fare(df: DataFrame, airline: str = "Airline", fare: str = "Fare Class") -> DataFrame:
    """Set of carry-on and checked kg per (airline, fare), NULL kept."""
    return df.groupBy(_q(airline).alias(airline), _q(fare).alias(fare)).agg(
        _set_keep_null(_q("Carry-on Baggage")).alias("carry_on"),
        _set_keep_null(_q("Checked Baggage")).alias("checked"))


OPTION_CATEGORIES = ["Departure Location", "Arrival Location", "Aircraft Type",
                     "Passenger Type", "Airline", "Departure Location Code", "Arrival Location Code"]


def option_rows(df: DataFrame) -> DataFrame:
    """A9 (flattened): rows (section, key1, key2, item) of the options document."""
    cats = distinct_values(df, OPTION_CATEGORIES).select(
        F.col("column_name").alias("section"), F.lit(None).cast("string").alias("key1"),
        F.lit(None).cast("string").alias("key2"), F.col("value").alias("item"))
    rng = range_by(df, "Arrival Location", "Flight Duration")
    dur = rng.select(F.lit("Flight Duration").alias("section"), F.lit("min").alias("key1"),
                     F.col("`Arrival Location`").alias("key2"), F.col("min").cast("string").alias("item")) \
        .unionByName(rng.select(F.lit("Flight Duration").alias("section"), F.lit("max").alias("key1"),
                                F.col("`Arrival Location`").alias("key2"), F.col("max").cast("string").alias("item")))
    pol = policies_by_fare(df).select(F.lit("Refund Policy").alias("section"), F.col("Airline").alias("key1"),
                                      F.col("`Fare Class`").alias("key2"), F.explode_outer("policies").alias("item"))
    bag = baggage_by_fare(df)
    carry = bag.select(F.lit("Baggage carry_on").alias("section"), F.col("Airline").alias("key1"),
                       F.col("`Fare Class`").alias("key2"),
                       F.explode_outer(F.transform("carry_on", lambda x: x.cast("string"))).alias("item"))
    checked = bag.select(F.lit("Baggage checked").alias("section"), F.col("Airline").alias("key1"),
                         F.col("`Fare Class`").alias("key2"),
                         F.explode_outer(F.transform("checked", lambda x: x.cast("string"))).alias("item"))
    return cats.unionByName(dur).unionByName(pol).unionByName(carry).unionByName(checked)


def options_document(df: DataFrame) -> DataFrame:
    """The nested options document as one JSON string.

    Built from pre-aggregated rows whose count is bounded by the number of
    distinct categories, airlines and fares (the UI's choice lists), not by
    the number of listings.
    """
    cats = distinct_values(df, OPTION_CATEGORIES).groupBy("column_name").agg(
        F.array_sort(F.collect_list("value")).alias("vals"))
    cat_map = cats.agg(F.map_from_entries(F.collect_list(F.struct("column_name", "vals"))).alias("categories"))
    rng = range_by(df, "Arrival Location", "Flight Duration").where(F.col("`Arrival Location`").isNotNull())
    dur = rng.agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("`Arrival Location`"), F.col("min")))).alias("min"),
        F.map_from_entries(F.collect_list(F.struct(F.col("`Arrival Location`"), F.col("max")))).alias("max"))
    per_fare = policies_by_fare(df).join(baggage_by_fare(df), ["Airline", "Fare Class"]) \
        .where(F.col("Airline").isNotNull() & F.col("`Fare Class`").isNotNull())
    per_airline = per_fare.groupBy("Airline").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("`Fare Class`"), F.col("policies")))).alias("pol"),
        F.map_from_entries(F.collect_list(F.struct(
            F.col("`Fare Class`"), F.struct(F.col("carry_on"), F.col("checked"))))).alias("bag"))
    top = per_airline.agg(
        F.map_from_entries(F.collect_list(F.struct("Airline", "pol"))).alias("Refund Policy"),
        F.map_from_entries(F.collect_list(F.struct("Airline", "bag"))).alias("Baggage"))
    doc = cat_map.crossJoin(dur).crossJoin(top)   # three one-row aggregates
    return doc.select(F.to_json(F.struct(
        F.col("categories"), F.struct("min", "max").alias("Flight Duration"),
        F.col("`Refund Policy`"), F.col("Baggage"))).alias("options"))


def bar_share(df: DataFrame, key: str = "airline_id", count_col: str = "count") -> DataFrame:
    """A10: count / max(count) per key (rating bars)."""
    cnt = df.withColumn("_cnt", F.replace(_q(count_col).cast("string"), F.lit(","), F.lit("")).try_cast("int"))
    w = Window.partitionBy(key)
    return cnt.withColumn("share", F.col("_cnt") / F.max("_cnt").over(w)).withColumnRenamed("_cnt", "count_int")


def missing_ratio(df: DataFrame, cols: Sequence[str], places: int = 1) -> DataFrame:
    """NULL percentage per column, one pass over the data."""
    one = df.select(*[F.round(F.avg(_q(c).isNull().cast("int")) * 100, places).alias(c) for c in cols])
    return one.unpivot([], list(cols), "column_name", "missing_ratio")


def num_values(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """Distinct non-NULL values per column (exact, or HLL++ when approx)."""
    fn = (lambda c: F.approx_count_distinct(c)) if approx else (lambda c: F.count_distinct(c))
    if approx:
        one = df.select(*[fn(_q(c)).cast("bigint").alias(c) for c in cols])
        return one.unpivot([], list(cols), "column_name", "num_values")
    # Exact: distinct (column, value) pairs once, then count per column —
    # one shuffle instead of an Expand per distinct aggregate.
    return distinct_values(df, cols).groupBy("column_name").agg(F.count(F.lit(1)).alias("num_values")) \
        .join(df.sparkSession.createDataFrame([(c,) for c in cols], "column_name string"), "column_name", "right") \
        .select("column_name", F.coalesce("num_values", F.lit(0)).cast("bigint").alias("num_values"))


def value_ratios(df: DataFrame, cols: Sequence[str], places: int = 1) -> DataFrame:
    """Percent of each value within its column (NULL not counted)."""
    counts = _long(df, cols).where(F.col("value").isNotNull()).groupBy("column_name", "value").count()
    totals = counts.groupBy("column_name").agg(F.sum("count").alias("_total"))
    # one row per column: bounded by len(cols)
    return counts.join(F.broadcast(totals), "column_name").select(
        "column_name", "value", F.round(F.col("count") / F.col("_total") * 100, places).alias("percent"))


def exact_quantiles_of(df: DataFrame, cols: Sequence[str], qs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Exact linear-interpolation quantiles of several columns in one job: (column_name, q, value).

    Equal values are counted first (map-side combine, so a hot value is one
    row), and the counts range-sorted by column and value. Sums by range
    partition, a table of partitions times columns, say which partition holds
    each wanted rank; only those partitions are totalled and looked into."""
    return quantiles_of_counts(_number_counts(df, cols), qs)


def _number_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, v, n): how often each value of each column occurs, as double."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), _q(c).cast("double").alias("v")) for c in cols]))
    return df.select(each.alias("x")).select("x.*").where("v IS NOT NULL").groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("n"))


def quantiles_of_counts(counts: DataFrame, qs: Sequence[float]) -> DataFrame:
    """The same from the counts (column_name, v, n) of the values."""
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    placed = cut_lineage(counts.repartitionByRange(parts, "column_name", "v").withColumn("_pid", F.spark_partition_id()))
    column = Window.partitionBy("column_name")
    spans = placed.groupBy("_pid", "column_name").agg(F.sum("n").alias("here")).select(
        "_pid", "column_name", "here", F.sum("here").over(column).alias("total"),
        (F.sum("here").over(column.orderBy("_pid")) - F.col("here")).alias("before"))
    ranks = F.explode(F.array(*[F.struct(F.lit(float(q)).alias("q"), (F.lit(float(q)) * (F.col("total") - 1)).alias("pos")) for q in qs]))
    wanted = spans.select("*", ranks.alias("r")).select("_pid", "column_name", "here", "before", "r.*").withColumn(
        "rank", F.explode(F.array_distinct(F.array(F.floor("pos"), F.ceil("pos"))))).where("before <= rank AND rank < before + here")
    # Two ranks for each column and quantile at most.
    held = placed.join(F.broadcast(wanted.select("_pid", "column_name", "before").distinct()), ["_pid", "column_name"])
    upto = held.withColumn("upto", F.col("before") + F.sum("n").over(Window.partitionBy("_pid", "column_name").orderBy("v")))
    hits = upto.drop("before").join(F.broadcast(wanted.drop("here", "before")), ["_pid", "column_name"]).where("upto - n <= rank AND rank < upto")
    return hits.groupBy("column_name", "q").agg(
        (F.min("v") + (F.max("v") - F.min("v")) * F.max(F.col("pos") - F.floor("pos"))).alias("value"))


def exact_quantiles(df: DataFrame, col: str, qs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Exact linear-interpolation quantiles of one column: (q, value)."""
    return exact_quantiles_of(df, [col], qs).select("q", "value")


def describe_numeric(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """Count, mean, std (n-1), min, 25%, 50%, 75%, max per column (long form).
    One pass for the moments of all columns and one for their quantiles."""
    qs = (0.25, 0.5, 0.75)
    kinds = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    if approx:
        kinds |= {f"p{int(q * 100)}": lambda v, q=q: F.percentile_approx(v, q, 10000) for q in qs}
    one = df.agg(*[F.struct(F.lit(c).alias("column_name"), *[f(_q(c).cast("double")).alias(k) for k, f in kinds.items()]).alias(f"_{i}")
                   for i, c in enumerate(cols)])
    stats = one.select(F.explode(F.array(*[f"_{i}" for i in range(len(cols))])).alias("s")).select("s.*")
    if not approx:
        found = exact_quantiles_of(df, cols, qs).groupBy("column_name").agg(
            *[F.max(F.when(F.col("q") == q, F.col("value"))).alias(f"p{int(q * 100)}") for q in qs])
        stats = stats.join(found, "column_name", "left")
    return stats.select("column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier identical row (all but the first)."""
    g = df.groupBy(*[_q(c) for c in df.columns]).count()
    return g.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("bigint").alias("duplicates"))


def profile(df: DataFrame) -> DataFrame:
    """Per column: type, NULL count, plus table rows and column count."""
    cols = df.columns
    one = df.select(F.count(F.lit(1)).alias("_rows"),
                    *[F.count(F.when(_q(c).isNull(), 1)).alias(c) for c in cols])
    long = one.unpivot(["_rows"], cols, "column_name", "null_count")
    types = df.sparkSession.createDataFrame([(c, t) for c, t in df.dtypes], "column_name string, dtype string")
    return long.join(F.broadcast(types), "column_name").select(
        "column_name", "dtype", F.col("null_count").cast("bigint").alias("null_count"),
        F.col("_rows").cast("bigint").alias("rows"), F.lit(len(cols)).alias("columns"))


#: Types whose values are equal exactly when their texts are.
_TEXT_EQUAL = {"string", "boolean", "tinyint", "smallint", "int", "bigint", "date", "timestamp_ntz"}


def constant_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Columns holding at most one distinct non-NULL value.

    Such a column's least value is its greatest: one row of extremes for each
    task, and no table of all values. Other types are compared as text, as A12 does."""
    kinds = dict(df.dtypes)
    text = {c: _q(c) if kinds[c] in _TEXT_EQUAL else _q(c).cast("string") for c in cols}
    one = df.agg(*[F.struct(F.lit(c).alias("column_name"), F.min(v).cast("string").alias("lo"), F.max(v).cast("string").alias("hi")).alias(f"_{i}")
                   for i, (c, v) in enumerate(text.items())])
    each = one.select(F.explode(F.array(*[f"_{i}" for i in range(len(text))])).alias("s")).select("s.*")
    return each.where("lo IS NULL OR lo = hi").select("column_name", F.col("lo").isNotNull().cast("bigint").alias("num_values"))


def iqr_outliers(df: DataFrame, col: str) -> DataFrame:
    """Quartiles, IQR, 1.5*IQR fences and the outlier count, all from the
    counts of the values: the rows are read once."""
    counts = cut_lineage(_number_counts(df, [col]))
    qq = quantiles_of_counts(counts, (0.25, 0.75))
    q = qq.agg(F.max(F.when(F.col("q") == 0.25, F.col("value"))).alias("q1"),
               F.max(F.when(F.col("q") == 0.75, F.col("value"))).alias("q3"))
    q = q.withColumn("iqr", F.col("q3") - F.col("q1")) \
        .withColumn("lower", F.col("q1") - 1.5 * F.col("iqr")).withColumn("upper", F.col("q3") + 1.5 * F.col("iqr"))
    cnt = counts.crossJoin(F.broadcast(q.select("lower", "upper"))) \
        .agg(F.coalesce(F.sum(F.when((F.col("v") < F.col("lower")) | (F.col("v") > F.col("upper")), F.col("n"))), F.lit(0)).alias("outliers"))
    return q.crossJoin(cnt)


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """Equal-width histogram between min and max (last bin closed), from
    the counts of the values: the rows are read once."""
    v = cut_lineage(_number_counts(df, [col]))
    mm = v.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    b = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1)))
    return v.crossJoin(F.broadcast(mm)).groupBy(b.cast("int").alias("bin")).agg(F.sum("n").alias("count"))


def audit(frames: dict[str, DataFrame]) -> DataFrame:
    """Row count per named frame (one small job per frame)."""
    out = None
    for name, f in frames.items():
        r = f.agg(F.count(F.lit(1)).cast("bigint").alias("rows")).select(F.lit(name).alias("name"), "rows")
        out = r if out is None else out.unionByName(r)
    return out
