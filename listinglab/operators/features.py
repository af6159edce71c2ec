"""Feature engineering for the price model.

Fitted state is kept as small parameter tables (one row per column or per
category); only these bounded tables reach the driver, to turn them into
column expressions. Training and scoring share one feature function.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as C
from ..functions.text import fold_name
from ..schemas import POLICY_KEY, SCHEDULE_KEY
from .cleaning import normalize_names
from .joins import ticket_policy, ticket_schedule

# Feature column names of the source.
NUMERIC = ["Carry-on_Baggage", "Checked_Baggage", "Flight_Duration"]
TARGET = "Total_Price"
CATEGORICAL = ["Fare_Class", "Airline_id", "Arrival_Location_Code", "Aircraft_Type"]
MULTI_LABEL = "Refund_Policy"
DROPPED = ["Number_of_Tickets", "Price_per_Ticket", "Taxes_&_Fees",
           "Passenger_Type", "Departure_Location_Code", "Flight_Code"]
CALENDAR = ["Departure_Hour", "Departure_DayOfWeek", "Days_Before_Departure"]
NULL_TOKEN = "None"


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def training_frame(tables: dict[str, DataFrame]) -> DataFrame:
    """M1 (+M2, M3): tickets ⋈ schedules ⋈ policies, ASCII names, checked
    NULL -> 0, policy labels without ``- ``, unused columns dropped."""
    j = ticket_policy(ticket_schedule(tables["ticket"], tables["flight_schedule"], SCHEDULE_KEY),
                      tables["refund_policy"], POLICY_KEY)
    j = normalize_names(j)
    j = j.withColumn("Checked_Baggage", F.coalesce(_q("Checked_Baggage"), F.lit(0)))
    j = j.withColumn(MULTI_LABEL, F.transform(F.coalesce(_q(MULTI_LABEL), F.array().cast("array<string>")),
                                              lambda x: F.replace(x, F.lit("- "), F.lit(""))))
    return j.drop(*DROPPED)


def calendar_features(df: DataFrame, dep: str = "Departure_Time", scrape: str = "Scrape_Time") -> DataFrame:
    """F9/F10 on the feature frame."""
    return df.withColumns({
        "Departure_Hour": C.hour_of_day(_q(dep)),
        "Departure_DayOfWeek": C.weekday_monday0(_q(dep)),
        "Days_Before_Departure": C.days_between(_q(dep), _q(scrape)),
    })


# ----------------------------------------------------------------- M4 scaler

def fit_scaler(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """M4: (column_name, mean, std) with population std; std 0 -> 1.
    One pass over the data; NULLs are ignored in the fit."""
    one = df.select(*[F.struct(F.avg(_q(c)).alias("mean"), F.stddev_pop(_q(c)).alias("std")).alias(c) for c in cols])
    long = one.unpivot([], list(cols), "column_name", "p")
    return long.select("column_name", F.col("p.mean").alias("mean"),
                       F.when(F.col("p.std") == 0, F.lit(1.0)).otherwise(F.col("p.std")).alias("std"))


def _params(params: DataFrame) -> dict[str, tuple[float, float]]:
    # one row per scaled column
    return {r["column_name"]: (r["mean"], r["std"]) for r in params.collect()}


def scale(df: DataFrame, params: DataFrame | dict) -> DataFrame:
    """M4: (x - mean) / std per fitted column; NULL stays NULL."""
    p = params if isinstance(params, dict) else _params(params)
    return df.withColumns({c: (_q(c) - F.lit(m)) / F.lit(s) for c, (m, s) in p.items() if c in df.columns})


def inverse_scale(col: Column, mean: float, std: float) -> Column:
    """Back to the original scale: p * std + mean."""
    return col * F.lit(std) + F.lit(mean)


# ----------------------------------------------------------------- M5 one-hot

def fit_onehot(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """M5: category table (column_name, category), NULL as its own category,
    sorted; built by a distributed distinct."""
    s = df.select(*[F.coalesce(_q(c).cast("string"), F.lit(NULL_TOKEN)).alias(c) for c in cols])
    return s.unpivot([], list(cols), "column_name", "category").distinct()


def _categories(cats: DataFrame | dict) -> dict[str, list[str]]:
    """Sorted categories by column, as the fitted model holds them: one entry
    for each slot of a feature vector, as many as a model has coefficients."""
    if isinstance(cats, dict):
        return cats
    out: dict[str, list[str]] = {}
    for r in cats.collect():
        out.setdefault(r["column_name"], []).append(r["category"])
    return {c: sorted(v) for c, v in sorted(out.items())}


def _distinct_names(names: Sequence[str], taken: Sequence[str] = ()) -> list[str]:
    """Spark column names do not tell cases apart, categories do (``C_Boss``,
    ``C_BOSS``), and labels can fold to one ASCII name: a name that repeats
    another gets a ``__<n>`` suffix."""
    seen = {t.lower(): 1 for t in taken}
    out = []
    for name in names:
        k = name.lower()
        seen[k] = seen.get(k, 0) + 1
        out.append(name if seen[k] == 1 else f"{name}__{seen[k]}")
    return out


def onehot_names(cats: dict) -> list[tuple[str, str, str]]:
    """(column, category, name) for every slot of the one-hot vectors."""
    slots = [(c, v) for c, values in cats.items() for v in values]
    return [(c, v, n) for (c, v), n in zip(slots, _distinct_names([fold_name(f"{c}_{v}") for c, v in slots]), strict=True)]


def onehot(df: DataFrame, cats: DataFrame | dict) -> DataFrame:
    """M5, export view: ``<col>_<value>`` 0/1 columns in sorted category order,
    one for every category; unseen values -> all 0."""
    return df.withColumns({name: (F.coalesce(_q(col).cast("string"), F.lit(NULL_TOKEN)) == F.lit(val)).cast("tinyint")
                           for col, val, name in onehot_names(_categories(cats))})


def onehot_vector(df: DataFrame, col: str, categories: Sequence[str], out: str | None = None) -> DataFrame:
    """M5: one sparse vector for a column, a slot for each category in sorted
    order, whatever their number; unseen values have no slot and give zeros."""
    from pyspark.ml.feature import CountVectorizerModel

    # A one-element array against a fixed vocabulary is the indicator vector.
    tmp = f"_{fold_name(col)}_s"
    s = df.withColumn(tmp, F.array(F.coalesce(_q(col).cast("string"), F.lit(NULL_TOKEN))))
    return _vectors(s, tmp, categories, out or f"{fold_name(col)}_vec", CountVectorizerModel).drop(tmp)


def _vectors(df: DataFrame, col: str, vocabulary: Sequence[str], out: str, model) -> DataFrame:
    # A model needs at least one word; one that no value holds stands in for none.
    words = list(vocabulary) or ["\u0000none"]
    m = model.from_vocabulary(words, inputCol=col, outputCol=out)
    return m.setBinary(True).transform(df)


# ------------------------------------------------------------- M6 multilabel

def fit_multilabel(df: DataFrame, col: str = MULTI_LABEL) -> DataFrame:
    """M6: sorted distinct labels of an array column."""
    return df.select(F.explode(_q(col)).alias("label")).where("label is not null").distinct()


def _labels(labels: DataFrame | list) -> list[str]:
    """Sorted labels, a slot of the feature vector each."""
    return labels if isinstance(labels, list) else sorted(r["label"] for r in labels.collect())


def label_names(labels: Sequence[str], taken: Sequence[str] = ()) -> list[str]:
    return _distinct_names([fold_name(x) for x in labels], taken)


def multilabel(df: DataFrame, labels: DataFrame | list, col: str = MULTI_LABEL) -> DataFrame:
    """M6, export view: one 0/1 column per known label; unseen labels ignored."""
    lab = _labels(labels)
    return df.withColumns({n: F.array_contains(_q(col), F.lit(x)).cast("tinyint") for x, n in zip(lab, label_names(lab), strict=True)})


def multilabel_vector(df: DataFrame, labels: DataFrame | list, col: str = MULTI_LABEL, out: str = "labels_vec") -> DataFrame:
    """M6: one sparse 0/1 vector, a slot for each known label."""
    from pyspark.ml.feature import CountVectorizerModel

    tmp = "_labels_present"
    s = df.withColumn(tmp, F.array_compact(F.coalesce(_q(col), F.array().cast("array<string>"))))
    return _vectors(s, tmp, _labels(labels), out, CountVectorizerModel).drop(tmp)


# ----------------------------------------------------------------- M10 table

@dataclass
class FeatureModel:
    """Fitted feature state: scaler table, categories and labels."""
    scaler: dict
    categories: dict
    labels: list

    def target_params(self) -> tuple[float, float]:
        return self.scaler[TARGET]

    def names(self) -> list[str]:
        """The feature columns in the vector's order."""
        fixed = [*NUMERIC, *CALENDAR]
        onehots = onehot_names({c: self.categories.get(c, []) for c in CATEGORICAL})
        encoded = _distinct_names([n for _, _, n in onehots] + [fold_name(x) for x in self.labels], fixed)
        return [*NUMERIC, *encoded, *CALENDAR]

    def save(self, spark, path: str) -> None:
        """One JSON line in a folder of its own."""
        text = json.dumps({"scaler": self.scaler, "categories": self.categories, "labels": self.labels}, ensure_ascii=False)
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark, path: str) -> FeatureModel:
        d = json.loads(spark.read.text(path, wholetext=True).first()[0])
        return cls({k: tuple(v) for k, v in d["scaler"].items()}, d["categories"], d["labels"])


def fit_features(frame: DataFrame, fit_rows: DataFrame | None = None) -> FeatureModel:
    """Fit M4-M6 on ``fit_rows`` (default: all rows, as the source did;
    pass the training split to avoid target leakage).

    Two passes: the scaler's sums, and the distinct categories and labels
    together. What is collected is the model itself."""
    src = fit_rows if fit_rows is not None else frame
    scaler = _params(fit_scaler(src, NUMERIC + [TARGET]))
    empty = F.array().cast("array<string>")
    values = [F.transform(F.coalesce(_q(MULTI_LABEL), empty), lambda x: F.struct(F.lit(MULTI_LABEL).alias("column_name"), x.alias("category")))]
    values += [F.array(F.struct(F.lit(c).alias("column_name"), F.coalesce(_q(c).cast("string"), F.lit(NULL_TOKEN)).alias("category"))) for c in CATEGORICAL]
    seen = src.select(F.explode(F.concat(*values)).alias("v")).select("v.*").where("category IS NOT NULL").distinct()
    cats = _categories(seen)
    return FeatureModel(scaler, {c: cats.get(c, []) for c in CATEGORICAL}, cats.get(MULTI_LABEL, []))


def feature_table(frame: DataFrame, model: FeatureModel, keep: Sequence[str] = ()) -> DataFrame:
    """M10, export view: scaled numerics, one column for each category and
    label, calendar, target last."""
    f = scale(calendar_features(frame), model.scaler)
    slots = [(F.coalesce(_q(c).cast("string"), F.lit(NULL_TOKEN)) == F.lit(v)).cast("tinyint") for c in CATEGORICAL for v in model.categories.get(c, [])]
    slots += [F.coalesce(F.array_contains(_q(MULTI_LABEL), F.lit(x)), F.lit(False)).cast("tinyint") for x in model.labels]
    columns = [_q(c) for c in NUMERIC] + slots + [_q(c) for c in CALENDAR]
    tail = [_q(TARGET)] if TARGET in f.columns else []
    return f.select(*[_q(k) for k in keep], *[c.alias(n) for c, n in zip(columns, model.names(), strict=True)], *tail)


def assemble(frame: DataFrame, model: FeatureModel, keep: Sequence[str] = (), out: str = "features") -> DataFrame:
    """M10 for Spark ML: ``keep``, target and one sparse vector in the order of
    ``model.names()`` (NULL numerics -> 0 after scaling = mean). No column is
    made for a category, so their number does not matter to the plan."""
    from pyspark.ml.feature import VectorAssembler

    f = scale(calendar_features(frame), model.scaler)
    f = f.withColumns({c: F.coalesce(_q(c).cast("double"), F.lit(0.0)) for c in [*NUMERIC, *CALENDAR]})
    parts = []
    for c in CATEGORICAL:
        parts.append(f"_{c}_vec")
        f = onehot_vector(f, c, model.categories.get(c, []), parts[-1])
    f = multilabel_vector(f, model.labels, out="_labels_vec")
    f = VectorAssembler(inputCols=[*NUMERIC, *parts, "_labels_vec", *CALENDAR], outputCol=out).transform(f)
    tail = [TARGET] if TARGET in f.columns else []
    return f.select(*[_q(k) for k in keep], *[_q(t) for t in tail], out)
