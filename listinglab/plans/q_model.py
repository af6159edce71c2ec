"""Checkable queries over features, models and scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import features as FE
from ..operators import modeling as M
from ..operators import sentiment as SE
from ..operators.cleaning import normalize_names
from ..operators.joins import ticket_policy, ticket_schedule
from ..operators.normalize import normalize
from ..schemas import POLICY_KEY, SCHEDULE_KEY
from . import q_listing as QL
from . import q_reviews as QR
from .oracle import with_listing, with_reviews
from .registry import register
from ..session import stored, table


def _q(c: str):
    return F.col(f"`{c}`")


def frame(spark: SparkSession, sf: str) -> DataFrame:
    return FE.training_frame(normalize(QL.written(spark, sf)))


_JOINED = ("FROM ticket t JOIN schedule s ON t.e_dep_time = s.e_dep_time AND t.e_flight = s.e_flight "
           "AND t.e_dep_code = s.e_dep_code JOIN refund_policy p ON t.airline_id = p.airline_id AND t.e_fare = p.fare")


@register("m1_training_frame", with_listing(
    "SELECT count(*) AS n, sum(t.e_total) AS total, sum(coalesce(t.e_checked, 0)) AS checked, "
    "sum(len(p.policy)) AS labels, count(DISTINCT s.e_aircraft) AS aircraft " + _JOINED, tables=True))
def m1_training_frame(spark, sf):
    f = frame(spark, sf)
    return f.agg(F.count(F.lit(1)).alias("n"), F.sum("Total_Price").alias("total"),
                 F.sum("Checked_Baggage").cast("bigint").alias("checked"),
                 F.sum(F.size("Refund_Policy")).cast("bigint").alias("labels"),
                 F.count_distinct("Aircraft_Type").alias("aircraft"))


_NUMS = {"Carry-on_Baggage": "t.e_carry", "Checked_Baggage": "coalesce(t.e_checked, 0)",
         "Flight_Duration": "s.e_duration", "Total_Price": "t.e_total"}


@register("m4_zscore", with_listing(" UNION ALL ".join(
    f"SELECT '{k}' AS column_name, round(avg({v}), 4) AS mean, "
    f"round(CASE WHEN stddev_pop({v}) = 0 THEN 1.0 ELSE stddev_pop({v}) END, 4) AS std {_JOINED}"
    for k, v in _NUMS.items()), tables=True))
def m4_zscore(spark, sf):
    p = FE.fit_scaler(frame(spark, sf), list(_NUMS))
    return p.select("column_name", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"))


@register("m3_missing_numeric", with_listing(" UNION ALL ".join(
    f"SELECT '{k}' AS column_name, count(*) AS n, count(*) - count({v}) AS missing, CASE WHEN stddev_pop({v}) = 0 THEN 0.0 ELSE CAST(count({v}) AS DOUBLE) END AS squares {_JOINED}"
    for k, v in _NUMS.items()), tables=True))
def m3_missing_numeric(spark, sf):
    """Missing numbers are left out of the scaler's fit and stay missing when scaled: the squares of the others add up to their number."""
    f = frame(spark, sf)
    scaled = FE.scale(f, FE.fit_scaler(f, list(_NUMS)))
    long = scaled.select(F.explode(F.array(*[F.struct(F.lit(k).alias("column_name"), _q(k).cast("double").alias("x")) for k in _NUMS])).alias("v")).select("v.*")
    return long.groupBy("column_name").agg(F.count(F.lit(1)).alias("n"), (F.count(F.lit(1)) - F.count("x")).alias("missing"),
                                           F.round(F.sum(F.col("x") * F.col("x")), 3).alias("squares"))


_CATS = {"Fare_Class": "t.e_fare", "Airline_id": "t.airline_id", "Arrival_Location_Code": "s.e_arr_code",
         "Aircraft_Type": "s.e_aircraft"}


_WIDE = {**_CATS, "Flight_Code": "t.e_flight"}


@register("m5_onehot", with_listing(" UNION ALL ".join(
    f"SELECT '{k}' AS column_name, coalesce(CAST({v} AS VARCHAR), 'None') AS category, count(*) AS n {_JOINED} GROUP BY ALL"
    for k, v in _WIDE.items()), tables=True))
def m5_onehot(spark, sf):
    """Sums of the indicator vectors, also of a column with many thousands of categories."""
    from pyspark.sql.functions import unwrap_udt

    t = normalize(QL.written(spark, sf))
    f = ticket_policy(ticket_schedule(t["ticket"], t["flight_schedule"], SCHEDULE_KEY), t["refund_policy"], POLICY_KEY)
    f = stored(normalize_names(f).select(*_WIDE))
    out = None
    cats = FE._categories(FE.fit_onehot(f, list(_WIDE)))
    for c, values in cats.items():
        v = FE.onehot_vector(f, c, values, "_vec")
        # Only the slots that a row fills, however wide the vector.
        slots = v.select(unwrap_udt("_vec").alias("_s")).select(F.explode(F.arrays_zip("_s.indices", "_s.values")).alias("e"))
        slots = slots.where("e.values <> 0").groupBy(F.col("e.indices").alias("slot")).agg(F.sum("e.values").cast("bigint").alias("n"))
        named = spark.createDataFrame([(c, x, k) for k, x in enumerate(values)], "column_name string, category string, slot int")
        part = named.join(slots, "slot").select("column_name", "category", "n")
        out = part if out is None else out.unionByName(part)
    return out


@register("m6_multilabel", with_listing(
    "SELECT DISTINCT replace(l, '- ', '') AS label FROM (SELECT unnest(p.policy) AS l " + _JOINED + ")", tables=True))
def m6_multilabel(spark, sf):
    return FE.fit_multilabel(frame(spark, sf))


def _fold_sql(x: str) -> str:
    return (f"replace(replace(trim(replace(replace(strip_accents({x}), 'đ', 'd'), 'Đ', 'D'), '- '), ' ', '_'), ',', '')")


def _feature_sql(name: str, value: str) -> str:
    return f"SELECT {name} AS feature, CAST(sum(v) AS DOUBLE) AS total, CAST(sum(v * v) AS DOUBLE) AS squares FROM (SELECT {value} AS v {_JOINED})"


def _scaled_sql(name: str, value: str) -> str:
    """The scaled column's sum is zero, its squares' the number of values (none where they do not vary)."""
    return (f"SELECT '{name}' AS feature, 0.0 AS total, CASE WHEN stddev_pop({value}) = 0 THEN 0.0 ELSE CAST(count({value}) AS DOUBLE) END AS squares {_JOINED}")


@register("m10_features", with_listing(
    "SELECT feature, round(total, 3) AS total, round(squares, 3) AS squares FROM ("
    + " UNION ALL ".join(
        f"SELECT '{k}_' || coalesce(CAST({v} AS VARCHAR), 'None') AS feature, CAST(count(*) AS DOUBLE) AS total, "
        f"CAST(count(*) AS DOUBLE) AS squares {_JOINED} GROUP BY ALL" for k, v in _CATS.items())
    + " UNION ALL SELECT " + _fold_sql("replace(l, '- ', '')") + " AS feature, CAST(count(*) AS DOUBLE), CAST(count(*) AS DOUBLE) FROM "
      "(SELECT unnest(list_distinct(p.policy)) AS l " + _JOINED + ") GROUP BY ALL UNION ALL "
    + " UNION ALL ".join([
        _feature_sql("'Departure_Hour'", "hour(t.e_dep_time)"), _feature_sql("'Departure_DayOfWeek'", "isodow(t.e_dep_time) - 1"),
        _feature_sql("'Days_Before_Departure'", "floor(date_diff('microsecond', t.e_scrape, t.e_dep_time) / 86400000000.0)"),
        *[_scaled_sql(k, f"CAST({v} AS DOUBLE)") for k, v in _NUMS.items()]])
    + ")", tables=True))
def m10_features(spark, sf):
    """Every column of the feature table: its sum and sum of squares."""
    f = stored(frame(spark, sf))   # the fit reads the frame twice
    fm = FE.fit_features(f)
    t = FE.feature_table(f, fm)
    cols = t.columns
    sums = t.agg(*[F.sum(_q(c).cast("double")).alias(f"s{k}") for k, c in enumerate(cols)],
                 *[F.sum(_q(c).cast("double") * _q(c)).alias(f"q{k}") for k, c in enumerate(cols)])
    long = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"s{k}").alias("total"), F.col(f"q{k}").alias("squares"))
                               for k, c in enumerate(cols)]))
    return sums.select(long.alias("x")).select("x.feature", (F.round("x.total", 3) + 0.0).alias("total"), F.round("x.squares", 3).alias("squares"))


@register("m9_metrics", with_listing(
    "SELECT round(1 - sum((y - p) * (y - p)) / (sum(y * y) - count(y) * avg(y) * avg(y)), 6) AS r2, "
    "round(sqrt(sum((y - p) * (y - p)) / count(y)), 4) AS rmse, round(avg(abs(y - p)), 4) AS mae, count(y) AS n "
    "FROM (SELECT CAST(e_total AS DOUBLE) AS y, CAST(e_price AS DOUBLE) AS p FROM cl)"))
def m9_metrics(spark, sf):
    c = QL.clean(spark, sf).select(F.col("`Total Price`").cast("double").alias("Total_Price"),
                                   F.col("`Price per Ticket`").cast("double").alias("prediction"))
    m = M.metrics(c)
    return m.select(F.round("r2", 6).alias("r2"), F.round("rmse", 4).alias("rmse"), F.round("mae", 4).alias("mae"), "n")


@register("a20_residual_points", with_listing(
    "SELECT least(min(e_total), min(e_price)) AS lo, greatest(max(e_total), max(e_price)) AS hi, count(*) AS n "
    "FROM cl WHERE e_price IS NOT NULL"))
def a20_residual_points(spark, sf):
    c = QL.clean(spark, sf).select(F.col("`Total Price`").alias("Total_Price"),
                                   F.col("`Price per Ticket`").alias("prediction"))
    pts, rng = M.residual_points(c)
    return rng.crossJoin(pts.agg(F.count(F.lit(1)).alias("n")))


@register("m17b_inverse_scale", with_listing("SELECT CAST(t.e_total AS DOUBLE) AS price " + _JOINED, tables=True))
def m17b_inverse_scale(spark, sf):
    f = stored(frame(spark, sf).select(FE.TARGET))   # read twice
    p = {r["column_name"]: (r["mean"], r["std"]) for r in FE.fit_scaler(f, ["Total_Price"]).collect()}
    s = FE.scale(f, p)
    mean, std = p["Total_Price"]
    return s.select(F.round(FE.inverse_scale(F.col("Total_Price"), mean, std), 4).alias("price"))


# ------------------------------------------------------------------- models
# Linear models of one feature have a closed form that SQL can state; the folds are a column's remainder. For
# trees and texts the check is their number of rows and that they beat the mean or the larger class.

_XY = "xy AS (SELECT s.e_duration AS x, CAST(t.e_total AS DOUBLE) AS y, CAST(t.e_total % 5 AS INTEGER) AS fold " + _JOINED + ")"


def _xy(spark, sf) -> DataFrame:
    """Duration against price, as a one-slot vector and label, with a fold from the price's last digit."""
    from pyspark.ml.feature import VectorAssembler

    f = frame(spark, sf).select(_q("Flight_Duration").alias("x"), F.col(FE.TARGET).cast("double").alias(FE.TARGET),
                                (F.col(FE.TARGET) % 5).cast("int").alias("fold"))
    return stored(VectorAssembler(inputCols=["x"], outputCol="features").transform(f))


def _with_xy(select: str) -> str:
    return with_listing("", tables=True).rstrip() + ",\n" + _XY + "\n" + select


@register("m7_split", with_listing(
    "SELECT count(*) AS n, 3 AS splits, 0 AS keys_in_two, true AS shares_hold " + _JOINED, tables=True))
def m7_split(spark, sf):
    """The three parts hold all rows, no key twice, and 72, 8 and 20 % within two points."""
    f = frame(spark, sf)
    keyed = f.withColumn("_key", F.xxhash64(*[_q(c) for c in f.columns if c != "Refund_Policy"]))
    split = M.split3(keyed, ["_key"]).select("_key", "split")
    parts = split.groupBy("_key").agg(F.count_distinct("split").alias("parts"), F.count(F.lit(1)).alias("n"), F.first("split").alias("split"))
    share = {k: F.sum(F.when(F.col("split") == k, F.col("n")).otherwise(0)) / F.sum("n") for k in ("train", "val", "test")}
    close = [F.abs(share[k] - v) < 0.02 for k, v in (("train", 0.72), ("val", 0.08), ("test", 0.2))]
    return parts.agg(F.sum("n").alias("n"), F.count_distinct("split").cast("int").alias("splits"),
                     F.sum(F.when(F.col("parts") > 1, 1).otherwise(0)).cast("int").alias("keys_in_two"), (close[0] & close[1] & close[2]).alias("shares_hold"))


def _line(model, data: DataFrame) -> DataFrame:
    m = M.metrics(model.transform(data))
    return m.select(F.lit(round(float(model.coefficients[0]), 2)).alias("slope"), F.lit(round(float(model.intercept), 1)).alias("intercept"),
                    F.round("r2", 6).alias("r2"), "n")


@register("m11_linear", _with_xy(
    "SELECT round(regr_slope(y, x), 2) AS slope, round(regr_intercept(y, x), 1) AS intercept, round(regr_r2(y, x), 6) AS r2, count(*) AS n FROM xy"))
def m11_linear(spark, sf):
    d = _xy(spark, sf)
    return _line(dict(M.candidates())["LinearRegression"](*M._fit_sizes(d)).fit(d), d)


@register("m12_ridge", _with_xy(
    "SELECT alpha, round(b, 2) AS slope, round(my - b * mx, 1) AS intercept FROM (SELECT alpha, avg(x) AS mx, avg(y) AS my, "
    "regr_sxy(y, x) / (regr_sxx(y, x) + alpha) AS b FROM xy, (VALUES (1.0), (5000.0)) AS v(alpha) GROUP BY alpha)"))
def m12_ridge(spark, sf):
    """The default penalty, and one that shows."""
    d = _xy(spark, sf)
    rows = []
    for alpha in (1.0, 5000.0):
        m = M.ridge(alpha)(*M._fit_sizes(d)).fit(d)
        rows.append((alpha, round(float(m.coefficients[0]), 2), round(float(m.intercept), 1)))
    return spark.createDataFrame(rows, "alpha double, slope double, intercept double")


# Two features and a label: the normal equations of each fold and penalty written out.
_XY2 = ("xy AS (SELECT s.e_duration AS x, CAST(coalesce(t.e_checked, 0) AS DOUBLE) AS z, CAST(t.e_total AS DOUBLE) AS y, "
        "CAST(t.e_total % 5 AS INTEGER) AS fold " + _JOINED + ")")


def _cv_sql(points: str, select: str) -> str:
    """Cross-validation of two-feature candidates; ``points``: rows (name, alpha, ic), ic 1 with an intercept."""
    sums = ", ".join(f"sum({a} * {b}) - ic * sum({a}) * sum({b}) / count(*) AS {a}{b}" for a, b in ("xx", "xz", "zz", "xy", "zy"))
    return with_listing("", tables=True).rstrip() + ",\n" + _XY2 + f""",
        p(name, alpha, ic) AS (VALUES {points}),
        s AS (SELECT k, name, alpha, ic, avg(x) AS mx, avg(z) AS mz, avg(y) AS my, {sums}
              FROM xy, (SELECT unnest(range(5)) AS k), p WHERE fold <> k GROUP BY k, name, alpha, ic),
        b AS (SELECT *, ((zz + alpha) * xy - xz * zy) / ((xx + alpha) * (zz + alpha) - xz * xz) AS b1,
                     ((xx + alpha) * zy - xz * xy) / ((xx + alpha) * (zz + alpha) - xz * xz) AS b2 FROM s),
        e AS (SELECT k, name, alpha, ic, sum(power(xy.y - ic * (my - b1 * mx - b2 * mz) - b1 * xy.x - b2 * xy.z, 2)) AS sse,
                     var_pop(xy.y) * count(*) AS sst, count(*) AS n FROM xy JOIN b ON xy.fold = b.k GROUP BY k, name, alpha, ic)
        {select}"""


def _xy2(spark, sf) -> DataFrame:
    """Duration and checked baggage against price, with a fold from the price's last digit."""
    from pyspark.ml.feature import VectorAssembler

    f = frame(spark, sf).select(_q("Flight_Duration").alias("x"), _q("Checked_Baggage").cast("double").alias("z"),
                                F.col(FE.TARGET).cast("double").alias(FE.TARGET), (F.col(FE.TARGET) % 5).cast("int").alias("fold"))
    return VectorAssembler(inputCols=["x", "z"], outputCol="features").transform(f)


@register("m8_cv", _cv_sql("('LinearRegression', 0.0, 1), ('Ridge', 1.0, 1)",
                           "SELECT name AS model_name, round(avg(1 - sse / sst), 6) AS mean_r2, round(avg(sqrt(sse / n)), 2) AS mean_rmse FROM e GROUP BY name"))
def m8_cv(spark, sf):
    """5-fold CV of the linear candidates on two features, from one job's statistics; the others are cross-validated in l3_price_run."""
    cv = M.cross_validate(M.candidates()[:2], _xy2(spark, sf))
    return cv.select("model_name", F.round("mean_r2", 6).alias("mean_r2"), F.round("mean_rmse", 2).alias("mean_rmse"))


# Trees: their error on a fold, held against what SQL says of the same rows: the error of the mean and of group means.
_TREES = ("xy AS (SELECT s.e_duration AS x, coalesce(t.e_checked, 0) AS z, coalesce(t.e_carry, -1) AS c, hour(t.e_dep_time) AS h, "
          "CAST(t.e_total AS DOUBLE) AS y, t.e_total % 5 = 0 AS test " + _JOINED + "), "
          "m AS (SELECT avg(y) AS m FROM xy WHERE NOT test), g AS (SELECT z, floor(x) AS f, avg(y) AS m FROM xy WHERE NOT test GROUP BY ALL), "
          "e AS (SELECT y, m.m AS m, coalesce(g.m, m.m) AS gm FROM xy CROSS JOIN m LEFT JOIN g ON g.z = xy.z AND g.f = floor(x) WHERE test)")


def _price(spark, sf, features: tuple[str, ...] = ("x", "z", "c", "h")) -> DataFrame:
    """Price by duration, checked and carry-on baggage (and hour); the prices that end in 0 or 5 are for the test."""
    from pyspark.ml.feature import VectorAssembler

    f = FE.calendar_features(frame(spark, sf)).select(
        _q("Flight_Duration").alias("x"), _q("Checked_Baggage").alias("z"), F.coalesce(_q("Carry-on_Baggage"), F.lit(-1)).alias("c"),
        F.col("Departure_Hour").alias("h"), F.col(FE.TARGET).cast("double").alias(FE.TARGET), (F.col(FE.TARGET) % 5 == 0).alias("test"))
    return stored(VectorAssembler(inputCols=list(features), outputCol="features").transform(f))


def _against_means(d: DataFrame, name: str, build) -> DataFrame:
    train, test = d.where("NOT test"), d.where("test")
    y = F.col(FE.TARGET)
    scored = build(*M._fit_sizes(train)).fit(train).transform(test)
    means = train.groupBy("z", F.floor("x").alias("f")).agg(F.avg(FE.TARGET).alias("gm"))
    rows = scored.withColumn("f", F.floor("x")).join(means, ["z", "f"], "left").crossJoin(train.agg(F.avg(FE.TARGET).alias("m")))   # one row

    def rmse(c):
        return F.sqrt(F.avg((y - c) ** 2))

    out = rows.agg(F.count(F.lit(1)).alias("n"), rmse(F.col("m")).alias("mean_rmse"), rmse(F.coalesce("gm", "m")).alias("group_rmse"), rmse(F.col("prediction")).alias("rmse"))
    return out.select(F.lit(name).alias("model_name"), "n", F.round("mean_rmse", 2).alias("mean_rmse"), F.round("group_rmse", 2).alias("group_rmse"),
                      (F.col("rmse") < F.col("group_rmse")).alias("beats_groups"))


def _tree_sql(name: str) -> str:
    return with_listing("", tables=True).rstrip() + ",\n" + _TREES + (
        f"\nSELECT '{name}' AS model_name, count(*) AS n, round(sqrt(avg(power(y - m, 2))), 2) AS mean_rmse, "
        "round(sqrt(avg(power(y - gm, 2))), 2) AS group_rmse, true AS beats_groups FROM e")


@register("m13_forest", _tree_sql("RandomForest"))
def m13_forest(spark, sf):
    """The forest on price: a smaller error than the means by duration and baggage."""
    return _against_means(_price(spark, sf, ("x", "z", "c")), "RandomForest", dict(M.candidates())["RandomForest"])


@register("m14_gbt", _tree_sql("GBT_fast"))
def m14_gbt(spark, sf):
    """Second-order boosting on price: a smaller error than the means by duration and baggage."""
    return _against_means(_price(spark, sf), "GBT_fast", dict(M.candidates())["GBT_fast"])


_CUTS = " UNION ALL ".join(
    f"SELECT {k} AS feature, v, sum(g) OVER (ORDER BY v) AS gl, sum(n) OVER (ORDER BY v) AS hl, max(v) OVER () AS top "
    f"FROM (SELECT {c} AS v, sum(m - y) AS g, count(*) AS n FROM xy, a GROUP BY ALL)" for k, c in enumerate(("z", "c", "h")))


@register("m14_split", with_listing("", tables=True).rstrip() + ",\n" + _TREES + f""",
    a AS (SELECT avg(y) AS m, count(*) AS n FROM xy), cuts AS ({_CUTS}),
    s AS (SELECT feature, v, gl * gl / (hl + 1) + gl * gl / (n - hl + 1) AS gain, hl FROM cuts, a WHERE v < top)
    SELECT feature, CAST(v AS DOUBLE) AS at, round(gain / 1e9, 3) AS gain, CAST(hl AS BIGINT) AS lefts FROM s ORDER BY s.gain DESC, feature, v LIMIT 1""")
def m14_split(spark, sf):
    """The root split that the histograms give: feature, value, gain and rows to the left, over all rows."""
    from pyspark.ml.feature import VectorAssembler

    from ..operators import boosting as B

    d = _price(spark, sf).drop("features")
    d = VectorAssembler(inputCols=["z", "c", "h"], outputCol="features").transform(d)
    s = B.Booster(label=FE.TARGET)
    cuts = B.cut_values(d, 3, s.bins, s.features)
    mean, rows = d.agg(F.avg(FE.TARGET), F.count(FE.TARGET)).first()
    blocks = B._blocks(s, d, cuts, float(mean), rows)
    best = B.best_splits(B.histograms(blocks, 3, [], [B.Node()], [0], [0, 1, 2], 1.0, 0), s)
    at = F.element_at(F.element_at(F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in cuts]), F.col("feature") + 1), F.col("bin") + 1)
    return best.select("feature", at.alias("at"), F.round(F.col("gain") / 1e9, 3).alias("gain"), F.col("hl").cast("long").alias("lefts"))


_GRID = ", ".join(f"('Ridge(alpha={a}, fit_intercept={bool(i)})', {a}, {i})" for a in (0.1, 1.0, 10.0) for i in (1, 0))


@register("m15_tune", _cv_sql(_GRID, "SELECT name AS model_name, round(avg(1 - sse / sst), 6) AS mean_r2, round(avg(sqrt(sse / n)), 2) AS mean_rmse, "
                                     "row_number() OVER (ORDER BY avg(1 - sse / sst) DESC) = 1 AS best FROM e GROUP BY name"))
def m15_tune(spark, sf):
    """Grid search of the Ridge family: the scores of its six points, and the chosen one's model fitted on all rows."""
    d = stored(_xy2(spark, sf))
    (name, _), model = M.tune("Ridge", d)
    assert model.numFeatures == 2
    cv = M.cross_validate(M.grid("Ridge"), d)
    return cv.select("model_name", F.round("mean_r2", 6).alias("mean_r2"), F.round("mean_rmse", 2).alias("mean_rmse"),
                     (F.col("model_name") == name).alias("best"))


_HOLD = ("h AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a, avg(y) AS m, stddev_pop(y) AS s FROM xy WHERE fold <> 0), "
         "p AS (SELECT y, a + b * x AS p, s FROM xy, h WHERE fold = 0), "
         "r AS (SELECT 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS r2, sqrt(avg((y - p) * (y - p))) AS rmse, avg(abs(y - p)) AS mae, "
         "count(*) AS n, first(s) AS s FROM p)")


@register("m16_train_final", _with_xy("").rstrip() + ",\n" + _HOLD + "\nSELECT 'original' AS scale, round(r2, 6) AS r2, round(rmse, 2) AS rmse, round(mae, 2) AS mae, n FROM r "
          "UNION ALL SELECT 'scaled', round(r2, 6), round(rmse / s, 6), round(mae / s, 6), n FROM r")
def m16_train_final(spark, sf):
    """Fit on four folds of the scaled label, report on the fifth on both scales."""
    d = _xy(spark, sf)
    train = d.where("fold <> 0")
    p = FE._params(FE.fit_scaler(train, [FE.TARGET]))
    mean, std = p[FE.TARGET]
    scaled = FE.scale(d, p)
    model, _ = M.train_final(dict(M.candidates())["LinearRegression"], scaled.where("fold <> 0"), scaled.where("fold = 0"))
    rep = M.regression_report(model.transform(scaled.where("fold = 0")), mean, std)
    return rep.select("scale", F.round("r2", 6).alias("r2"), *[F.when(F.col("scale") == "scaled", F.round(c, 6)).otherwise(F.round(c, 2)).alias(c) for c in ("rmse", "mae")], "n")


@register("m17_score", with_listing(
    "SELECT c.e_airline AS airline, a.airline_id AS \"Airline_id\", c.e_arr_loc AS place, c.e_arr_code AS \"Arrival_Location_Code\", count(*) AS requests, "
    "count(*) AS prices FROM cl c JOIN airline a ON c.e_airline = a.airline WHERE c.e_dep_time IS NOT NULL GROUP BY ALL", tables=True))
def m17_score(spark, sf):
    """Every cleaned listing as a request with the airline's and the places' names: looked-up ids, and a price for each."""
    clean = QL.written(spark, sf)
    t = normalize(clean)
    f = stored(FE.training_frame(t))
    fm = FE.fit_features(f)
    train = stored(FE.assemble(f, fm))
    model = dict(M.candidates())["Ridge"](*M._fit_sizes(train)).fit(train)
    requests = clean.where(F.col("Airline").isNotNull() & F.col("`Departure Time`").isNotNull()).select(
        F.col("Airline").alias("airline"), F.col("`Arrival Location`").alias("arrival_location"), F.col("`Departure Location`").alias("departure_location"),
        *[_q(c).alias(c.lower().replace(" ", "_").replace("-", "_")) for c in (
            "Carry-on Baggage", "Checked Baggage", "Flight Duration", "Fare Class", "Aircraft Type", "Refund Policy", "Departure Time", "Scrape Time")])
    looked = M.lookup_requests(requests, t["airline"], t["airport"])
    scored = M.score(looked, model, fm, keep=["Airline_id", "Arrival_Location_Code"])
    out = scored.groupBy("Airline_id", "Arrival_Location_Code").agg(F.count(F.lit(1)).alias("requests"), F.count("predicted_price").alias("prices"))
    named = out.join(t["airline"], "Airline_id").join(t["airport"].select(F.col("AirportCode").alias("Arrival_Location_Code"), F.col("Location").alias("place")), "Arrival_Location_Code")
    return named.select(F.col("Airline").alias("airline"), "Airline_id", "place", "Arrival_Location_Code", "requests", "prices")


#: Words of one to five stars (of this fixture alone), set behind each sentence of a review.
_STAR_WORDS = ("terrible awful", "bad poor", "okay average", "good nice", "excellent wonderful")


@register("m18_sentiment", "SELECT CASE WHEN doc_id % 5 <= 2 THEN 'Negative' WHEN doc_id % 5 = 3 THEN 'Neutral' ELSE 'Positive' END AS stars_say, count(*) AS tested, "
                           "true AS beats_largest FROM documents WHERE doc_id % 97 <> 5 AND doc_id % 3 = 0 GROUP BY ALL")
def m18_sentiment(spark, sf):
    """Reviews whose words follow their stars: the ordinal model, fitted on two thirds, gives the last third its Sentiment, more often that of its stars than naming the most frequent one would."""
    from ..functions.text import bubbles, sentiment_bucket

    r = QR.reviews(spark, sf).select("doc_id", "Title", _q("Full Review"), bubbles(F.col("Rating")).alias("stars")).where("stars IS NOT NULL")
    words = F.element_at(F.array(*map(F.lit, _STAR_WORDS)), F.col("stars").cast("int"))
    text = F.concat(F.replace(_q("Full Review"), F.lit(". "), F.concat(F.lit(" "), words, F.lit(". "))), F.lit(" "), words)
    rows = stored(r.select("doc_id", "Title", text.alias("Full Review"), (F.col("stars") - 1).alias("label")))
    model = SE.fit_ordinal_sentiment(rows.where("doc_id % 3 > 0"))
    out = SE.enrich_sentiment(rows.where("doc_id % 3 = 0"), model)
    said = sentiment_bucket(F.col("label").cast("int"))
    by = out.groupBy(said.alias("stars_say")).agg(F.count(F.lit(1)).alias("tested"), F.count_if(F.col("Sentiment") == said).alias("agree"))
    every = Window.partitionBy(F.lit(1))   # three rows
    return by.select("stars_say", "tested", (F.sum("agree").over(every) > F.max("tested").over(every)).alias("beats_largest"))


@register("m18_text_classes", "SELECT count(*) AS tested, true AS beats_larger_class FROM documents WHERE doc_id % 5 = 0 AND lang IN ('de', 'en', 'es', 'fr')")
def m18_text_classes(spark, sf):
    """The text classifier on a class that the texts tell (their language): on the fifth that it did not see, its
    accuracy is above the larger class's share."""
    place = F.array_position(F.array(*map(F.lit, ("de", "en", "es", "fr"))), F.col("lang")).cast("int")
    rows = stored(table(spark, sf, "documents").where(place > 0).select(
        "doc_id", F.col("text").alias("Full Review"), F.lit("").alias("Title"), (place - 1).cast("double").alias("label")))
    model = SE.fit_sentiment(rows.where("doc_id % 5 <> 0"))
    out = model.transform(SE.with_text(rows.where("doc_id % 5 = 0")))
    share = F.greatest(*[F.avg((F.col("label") == k).cast("double")) for k in range(4)])
    return out.agg(F.count(F.lit(1)).alias("tested"), (F.avg((F.col("_class") == F.col("label")).cast("double")) > share).alias("beats_larger_class"))


@register("m18b_enrich", with_reviews(
    "SELECT count(*) AS reviews, count(*) AS enriched, true AS named, count(*) AS by_hook FROM rk"))
def m18b_enrich(spark, sf):
    """A model of the star ratings (five classes) gives every valid review its Sentiment, and so does the hook for other models."""
    valid = stored(QR.review_valid(spark, sf))
    model = SE.fit_sentiment(valid.where(F.col("Rating").isNotNull()).withColumn("label", F.col("Rating") - 1))
    out = SE.enrich_sentiment(valid, model)
    hook = SE.enrich_with_udf(valid, lambda texts: texts.str.len() % 5).agg(F.count("Sentiment").alias("by_hook"))
    named = F.bool_and(F.col("Sentiment").isin("Negative", "Neutral", "Positive"))
    return out.agg(F.count(F.lit(1)).alias("reviews"), F.count("Sentiment").alias("enriched"), named.alias("named")).crossJoin(hook)


@register("l3_price_run", with_listing(
    f"SELECT (SELECT count(*) FROM ticket WHERE e_scrape > {QL._CUT} OR e_scrape IS NULL) AS tickets, 5 AS models, true AS saved", tables=True))
def l3_price_run(spark, sf):
    """L3: cleanup committed -> features -> CV of all five candidates -> best -> final fit; a later process can score."""
    from ..sinks import files as K
    from .flows import run_price_flow

    root, path = QL.work_path(spark, "price-run"), QL.work_path(spark, "price-model")
    K.commit_version(spark, normalize(QL.written(spark, sf)), root)
    res = run_price_flow(spark, root, QL.NOW, 3, model_path=path)
    current = spark.read.parquet(f"{K.current_version(spark, root)}/ticket")
    again = FE.FeatureModel.load(spark, f"{path}-features")
    same = again == res["features"] and res["report"].first()["n"] >= 0
    return current.agg(F.count(F.lit(1)).alias("tickets")).select("tickets", F.lit(res["cv"].count()).cast("int").alias("models"), F.lit(same).alias("saved"))
