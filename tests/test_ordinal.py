"""The ordinal model of stars (M18): its gradient, its order, and its error beside the multinomial's."""

import numpy as np
from listinglab.operators import ordinal as O
from listinglab.operators import sentiment as SE
from pyspark.sql import functions as F


def test_gradient_by_differences():
    rng = np.random.default_rng(1)
    s, y, w, raw = rng.normal(0, 2, 50), rng.integers(0, 5, 50), rng.random(50), np.array([-1.0, 0.2, -0.3, 0.1])
    loss, by_score, by_raw = O.loss_and_gradient(s, y, w, raw)
    e = 1e-6
    for k in range(4):
        up, down = raw.copy(), raw.copy()
        up[k] += e
        down[k] -= e
        assert abs((O.loss_and_gradient(s, y, w, up)[0] - O.loss_and_gradient(s, y, w, down)[0]) / (2 * e) - by_raw[k]) < 1e-4
    for k in range(0, 50, 7):
        up, down = s.copy(), s.copy()
        up[k] += e
        down[k] -= e
        assert abs((O.loss_and_gradient(up, y, w, raw)[0] - O.loss_and_gradient(down, y, w, raw)[0]) / (2 * e) - by_score[k]) < 1e-4
    assert (np.diff(O.thresholds(raw)) > 0).all()


def test_ordinal_beats_multinomial_on_ordered_stars(spark):
    """Reviews whose good and bad words make the stars: the ordinal model's mean distance on unseen texts is the smaller one."""
    rng = np.random.default_rng(3)
    good, bad, other = ([f"{k}{j}" for j in range(40)] for k in ("good", "bad", "word"))
    rows = []
    for k in range(900):
        balance = rng.integers(0, 9)
        text = [*rng.choice(good, balance), *rng.choice(bad, 8 - balance), *rng.choice(other, 12)]
        stars = int(np.clip(round(balance / 2 + rng.normal(0, 0.4)), 0, 4))
        rows.append((k, "t", " ".join(text), float(stars)))
    df = spark.createDataFrame(rows, "id long, Title string, `Full Review` string, label double").cache()
    train, test = df.where("id % 3 > 0"), df.where("id % 3 = 0")

    def distance(model):
        out = model.transform(SE.with_text(test))
        return out.agg(F.avg(F.abs(F.col("_class") - F.col("label")))).first()[0]

    ordinal, plain = SE.fit_ordinal_sentiment(train, num_features=1 << 10), SE.fit_sentiment(train, num_features=1 << 10)
    assert distance(ordinal) < distance(plain) and distance(ordinal) < 0.6
    named = SE.enrich_sentiment(test, ordinal)
    assert {r.Sentiment for r in named.select("Sentiment").distinct().collect()} == {"Negative", "Neutral", "Positive"}
    assert set(named.columns) == {*df.columns, "Sentiment"}
