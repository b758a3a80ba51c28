import numpy as np
import pandas as pd

from hourglass.operators import aggregates as A


def test_exact_quantiles_match_numpy_with_hot_group(spark):
    rng = np.random.default_rng(3)
    g = np.where(rng.random(3000) < 0.34, "hot", rng.choice(["a", "b", "c", "d"], 3000))
    x = rng.normal(50, 20, 3000).round(3)
    y = rng.exponential(5, 3000)
    pdf = pd.DataFrame({"g": g, "x": x, "y": y})
    pdf.loc[::17, "y"] = np.nan
    df = spark.createDataFrame(pdf).repartition(7)
    got = A.quantiles(df, ["x", "y"], [0.0, 0.25, 0.5, 0.75, 1.0], ["g"]).toPandas()
    for (grp, col, p), v in got.set_index(["g", "column_name", "p"])["value"].items():
        ref = pdf.loc[pdf.g == grp, col].dropna().quantile(p)
        assert abs(v - ref) < 1e-9, (grp, col, p, v, ref)


def test_describe_and_histogram(spark):
    rng = np.random.default_rng(5)
    x = rng.uniform(0, 10, 500)
    df = spark.createDataFrame(pd.DataFrame({"x": x}))
    d = A.describe(df, ["x"]).first()
    ref = pd.Series(x).describe()
    assert d["count"] == 500
    for k, r in [("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")]:
        assert abs(d[k] - ref[r]) < 1e-9
    h = A.histogram(df, "x", 30).orderBy("bin").toPandas()
    counts, _ = np.histogram(x, bins=30)
    assert h["count"].tolist() == counts.tolist()


def test_regression_metrics_match_numpy(spark):
    rng = np.random.default_rng(9)
    a = rng.uniform(0, 100, 200)
    p = a + rng.normal(0, 5, 200)
    df = spark.createDataFrame(pd.DataFrame({"a": a, "p": p}))
    m = A.regression_metrics(df, "a", "p").first()
    e = a - p
    assert abs(m["mae"] - np.abs(e).mean()) < 1e-9
    assert abs(m["rmse"] - np.sqrt((e ** 2).mean())) < 1e-9
    assert abs(m["r2"] - (1 - (e ** 2).sum() / ((a - a.mean()) ** 2).sum())) < 1e-9
    const = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0)], "a double, p double")
    assert A.regression_metrics(const, "a", "p").first()["r2"] is None


def test_duplicate_count(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (1, "y"), (2, "x")], "a int, b string")
    r = A.duplicate_count(df).first()
    assert (r["duplicates"], r["distinct_values"]) == (1, 3)
    assert A.duplicate_count(df, ["a"]).first()["duplicates"] == 2
