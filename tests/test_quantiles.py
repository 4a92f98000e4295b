"""Exact quantiles: the narrowing path against pandas, on skewed groups, ties and gaps."""

import numpy as np
import pandas as pd
import pytest

from pyspark.sql import functions as F

from panelloom.operators.cross_section import cross_section_quantile
from panelloom.operators.impute import group_median_impute, group_ratio_impute
from panelloom.operators.outliers import outlier_share, soft_winsorize
from panelloom.operators.quantiles import column_quantiles, group_quantiles, order_key

PROBS = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(5)
    n = 6000
    group = np.where(rng.random(n) < 0.4, "hot", rng.choice(list("abcdef"), n))
    x = rng.standard_cauchy(n)
    x[rng.random(n) < 0.1] = np.nan
    return pd.DataFrame({"g": group, "x": x, "y": rng.integers(0, 7, n).astype(float)})


def to_spark(spark, pdf):
    clean = pdf.astype(object).where(pdf.notna(), None)
    kinds = {"f": "double", "i": "bigint", "O": "string", "U": "string", "T": "string"}
    schema = ", ".join(f"{c} {kinds.get(pdf[c].dtype.kind, 'string')}" for c in pdf)
    return spark.createDataFrame([tuple(r) for r in clean.itertuples(index=False)], schema)


@pytest.mark.parametrize("accuracy,leaf", [(10_000, 200_000), (20, 200_000), (20, 10), (10_000, 1)])
def test_group_quantiles_equal_pandas(spark, frame, accuracy, leaf):
    got = group_quantiles(to_spark(spark, frame), ["x", "y"], PROBS, ["g"], accuracy, leaf).toPandas().set_index("g")
    want = frame.groupby("g")[["x", "y"]].quantile(PROBS)
    for g in want.index.get_level_values(0).unique():
        for c in ("x", "y"):
            np.testing.assert_allclose(got.loc[g, c], want.loc[g][c].to_numpy(), rtol=1e-12)
        assert got.loc[g, "x__n"] == frame[frame.g == g].x.count()


@pytest.mark.parametrize("leaf", [200_000, 3])
def test_column_quantiles_equal_pandas(spark, frame, leaf):
    got, rows = column_quantiles(to_spark(spark, frame), ["x", "y"], PROBS, 50, {"top": F.max("__x")}, leaf)
    for c in ("x", "y"):
        np.testing.assert_allclose(got[c], frame[c].quantile(PROBS).to_numpy(), rtol=1e-12)
        assert rows[c]["top"] == frame[c].max()


def test_order_keys_follow_the_doubles(spark):
    import struct
    rng = np.random.default_rng(1)
    bits = np.concatenate([rng.integers(0, 0x7FF0 << 48, 4000, np.int64), [0, 1, 2, 1 << 52, (1 << 52) - 1, 0x7FEF << 48, 0x7FF0 << 48]])
    powers = [2.0 ** k * f for k in range(-1074, 1024, 7) for f in (1.0, 1 + 2 ** -52, 1 - 2 ** -53) if 2.0 ** k * f > 0]
    values = [*np.frombuffer(bits.tobytes(), np.float64).tolist(), *powers, 2.0 ** 29, 8.0, float(np.nextafter(8, 0))]
    values += [-v for v in values]
    want = {v: struct.unpack("<q", struct.pack("<d", abs(v)))[0] * (-1 if v < 0 else 1) for v in values}
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = {r.x: r.k for r in df.select("x", order_key(F.col("x")).alias("k")).collect()}
    assert all(got[v] == want[v] for v in values)


def test_passes_are_bounded_for_any_spread(spark, monkeypatch):
    from panelloom.operators import quantiles
    rng = np.random.default_rng(2)
    x = 10.0 ** rng.uniform(-300, 300, 6000) * rng.choice([-1, 1], 6000)
    x[:40], x[40:80], x[80:100] = np.inf, -np.inf, 0.0
    passes, plain = [], quantiles._sized
    monkeypatch.setattr(quantiles, "_sized", lambda *a: passes.append(1) or plain(*a))
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    got = column_quantiles(df, ["x"], PROBS, 20, leaf=10)["x"]
    assert len(passes) <= 1 + 8
    ordered = np.sort(x)
    for p, value in zip(PROBS, got):
        at = p * (len(x) - 1)
        low, high = ordered[int(np.floor(at))], ordered[int(np.ceil(at))]
        want = low if low == high or at == int(at) else low + (high - low) * (at - np.floor(at))
        assert value == pytest.approx(want, rel=1e-9)


def test_unknown_columns_have_no_quantiles(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert column_quantiles(df, ["x"], [0.5]) == {"x": [None]}


def labels(spark, values):
    df = spark.createDataFrame([(i, "d", v) for i, v in enumerate(values)], "i int, Date string, x double")
    return [r.x_Quantile for r in cross_section_quantile(df, "x").orderBy("i").collect()]


def test_labels_of_literal_months(spark):
    assert labels(spark, [10.0, 1.0, 2.0, 9.0, 3.0, 8.0, 4.0, 7.0, 5.0, 6.0]) == [5, 1, 1, 5, 2, 4, 2, 4, 3, 3]
    assert labels(spark, [1.0, 2.0, 3.0]) == [None] * 3  # fewer values than labels
    assert labels(spark, [4.0] * 8) == [None] * 8  # no two edges differ
    assert labels(spark, [None, 1.0, 2.0, 3.0, 4.0, 5.0]) == [None, 1, 2, 3, 4, 5]
    # eight equal values: the edges 0 and 0 merge, which lowers the labels above
    assert labels(spark, [0.0] * 8 + [1.0, 2.0]) == [1] * 8 + [2, 2]


def test_labels_split_a_month_evenly(spark, frame):
    values = sorted(v for v in frame.x.tolist() if v == v)
    got = labels(spark, values)
    assert got == sorted(got)
    sizes = [got.count(k) for k in range(1, 6)]
    assert sum(sizes) == len(values) and max(sizes) - min(sizes) <= 1


def test_median_imputation_with_unknown_groups(spark):
    rows = [("a", 1.0, 10.0), ("a", 3.0, 10.0), ("a", None, -20.0), ("b", None, 5.0), (None, 7.0, 10.0), (None, None, 10.0),
            ("a", None, None)]
    df = spark.createDataFrame(rows, "g string, v double, d double")
    plain = sorted(map(str, [r["v"] for r in group_median_impute(df, "v", "g").collect()]))
    assert plain == sorted(["1.0", "3.0", "2.0", "3.0", "7.0", "3.0", "2.0"])
    ratio = [r["v"] for r in group_ratio_impute(df, "v", "g", "d").orderBy("g", "d").collect()]
    # group a: median ratio 0.2, a negative denominator is projected; b and the unknown group: 0.3
    assert sorted(round(v, 9) for v in ratio) == sorted([1.0, 3.0, -4.0, 1.5, 7.0, 3.0, 1.0])


def test_tails_are_compressed_from_the_nearest_outlier_on(spark):
    # 101 values around zero and two far ones above: 50 is the outlier nearest to the bulk
    values = [x / 50 for x in range(-50, 51)] + [50.0, 60.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    got = [r.x for r in soft_winsorize(df, ["x"]).orderBy("i").collect()]
    assert got[:-1] == values[:-1]
    assert got[-1] == pytest.approx(50 + np.log(11))
    share = outlier_share(df, ["x"]).first()
    assert (share["low"], share["high"], share["total"]) == pytest.approx((0, 200 / 103, 200 / 103))


def test_compression_keeps_order_and_the_inside(spark, frame):
    values = [(i, v) for i, v in enumerate(frame.x.tolist()) if v == v]
    df = spark.createDataFrame(values, "i int, x double")
    got = {r.i: r.x for r in soft_winsorize(df, ["x"]).collect()}
    pairs = sorted((v, got[i]) for i, v in values)
    changed = [v for v, x in pairs if x != v]
    assert changed and [x for _, x in pairs] == sorted(x for _, x in pairs)
    inside = [v for v, x in pairs if x == v]
    assert all(v < min(inside) or v > max(inside) for v in changed)
    share = outlier_share(df, ["x"]).first()
    # the outliers are what was changed and the two that mark the bounds
    assert round(share["total"] * len(values) / 100) == len(changed) + 2
