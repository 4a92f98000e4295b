"""Window and growth operators on hand-made and random panels, against pandas."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelloom.functions import metrics as M
from panelloom.operators import windows as W
from panelloom.operators.power import fit_exponents, transform_yeo_johnson
from test_quantiles import to_spark


def month(i):
    return dt.date(2000 + i // 12, i % 12 + 1, 1)


@pytest.fixture(scope="module")
def panel():
    rng = np.random.default_rng(11)
    rows = []
    for t in range(9):
        for i in range(t, 40):
            if rng.random() < 0.1:
                continue
            rows.append((f"T{t}", month(i), *[None if rng.random() < p else float(np.round(rng.normal(10, 4), 3)) for p in (0.05, 0, 0.3)]))
    return pd.DataFrame(rows, columns=["Ticker", "Date", "Open", "Close", "x"])


def frame(spark, pdf):
    rows = [tuple(None if isinstance(v, float) and np.isnan(v) else v for v in r) for r in pdf.itertuples(index=False)]
    kinds = {"Ticker": "string", "Date": "date"}
    return spark.createDataFrame(rows, ", ".join(f"{c} {kinds.get(c, 'double')}" for c in pdf))


def back(df, cols):
    return df.toPandas().sort_values(["Ticker", "Date"])[cols].to_numpy(dtype=float)


@pytest.mark.parametrize("limit", [0, 1, 2, 6])
def test_ffill_limit(spark, panel, limit):
    got = back(W.ffill_limit(frame(spark, panel), ["x"], limit), ["x"])[:, 0]
    want = panel.x if limit == 0 else panel.groupby("Ticker").x.ffill(limit=limit)
    np.testing.assert_array_equal(got, want.to_numpy(dtype=float))


def series(spark, values, name="x"):
    return spark.createDataFrame([("A", month(i), v) for i, v in enumerate(values)], f"Ticker string, Date date, {name} double")


def test_rolling_impute_of_literal_series(spark):
    def filled(values):
        return [r.x for r in W.rolling_impute(series(spark, values), ["x"]).orderBy("Date").collect()]

    # mild skew: the mean of the known among the last four
    assert filled([1.0, 2.0, None, 4.0, None]) == [1.0, 2.0, 1.5, 4.0, 3.0]
    # nothing known in reach stays unknown
    assert filled([None, 1.0, 2.0, 4.0, None, None, None, None])[0] is None
    assert filled([3.0, 1.0, 2.0, None, None, None, None, None])[-1] is None
    # one far value among zeros: the median, where the mean would be 25 or more
    assert filled([0.0] * 12 + [100.0, None])[-1] == 0.0
    # too few values, or all equal: no skew is known, the median again
    assert filled([5.0, 7.0, None]) == [5.0, 7.0, 6.0]
    assert filled([5.0, 5.0, 5.0, None]) == [5.0] * 4


def test_ttm_of_literal_series(spark):
    df = spark.createDataFrame(
        [("A", month(i), x, o) for i, (x, o) in enumerate([(1.0, 2.0), (2.0, 4.0), (None, 6.0), (4.0, 8.0)])]
        + [("B", month(i), x, 1.0) for i, x in enumerate([8.0, None, None, None, 1.0])],
        "Ticker string, Date date, x double, Open double")
    out = W.ttm_flows(df, ["x", "Open"], averaged=["Open"]).orderBy("Ticker", "Date").collect()
    assert [r.x_TTM for r in out[:4]] == pytest.approx([4.0, 6.0, 20 / 3, 9.0])
    assert [r.Open_TTM for r in out[:4]] == [2.0, 3.0, 4.0, 5.0]
    # carried over two months, not three
    assert [r.x_TTM for r in out[4:]] == pytest.approx([32.0, 32.0, 32.0, 32.0, 68 / 3])


def test_growth_limits_and_zero_base(spark):
    rows = [("A", month(i), v) for i, v in enumerate([0.0, 0.0, 0.0, 5.0, -5.0, 0.0, 500.0, -1.0, None])]
    out = W.growth_rates(spark.createDataFrame(rows, "Ticker string, Date date, v double"), ["v"], spans=(("QoQ", 3),))
    got = [r["v_QoQ"] for r in out.orderBy("Date").collect()]
    assert got == [None, None, None, 10.0, -10.0, None, 10.0, 0.8, None]


def test_lag_stays_within_the_entity(spark):
    df = spark.createDataFrame([("A", month(0), 1.0), ("A", month(1), 2.0), ("B", month(0), 3.0)], "Ticker string, Date date, v double")
    got = {(r["Ticker"], r["Date"]): r["v_Lag1"] for r in W.lag_value(df, ["v"]).collect()}
    assert got == {("A", month(0)): None, ("A", month(1)): 1.0, ("B", month(0)): None}


MARKET_MOVES = [None, 0.10, -0.05, 0.02, 0.07, -0.03, 0.01, 0.04, -0.06, 0.05, 0.03, -0.02, 0.06, -0.01]
ENTITY_MOVES = [None, 0.20, -0.12, 0.01, 0.09, -0.01, 0.03, 0.02, -0.15, 0.12, 0.01, -0.05, 0.08, 0.02]


def opens(moves, start):
    out = [start]
    for m in moves[1:]:
        out.append(out[-1] * (1 + m))
    return out


def covariance(a, b):
    return sum((x - sum(a) / len(a)) * (y - sum(b) / len(b)) for x, y in zip(a, b)) / (len(a) - 1)


@pytest.mark.parametrize("gap", [None, 8])
def test_returns_and_betas_of_literal_returns(spark, gap):
    n = len(MARKET_MOVES)
    schema = "Ticker string, Date date, Open double, Close double"
    index = [("MKT", month(i), v, v * 1.01) for i, v in enumerate(opens(MARKET_MOVES, 100.0))]
    rows = [("A", month(i), v, v * 1.03) for i, v in enumerate(opens(ENTITY_MOVES, 50.0)) if i != gap]
    out = {r.Date: r for r in W.returns_and_betas(
        spark.createDataFrame(rows, schema), spark.createDataFrame(index, schema)).collect()}
    assert len(out) == n - (gap is not None)
    own, market = [m or 0.0 for m in ENTITY_MOVES], [m or 0.0 for m in MARKET_MOVES]
    unknown = {0}
    if gap is not None:  # no return into the gap and none out of it
        unknown |= {gap, gap + 1}
        own[gap] = own[gap + 1] = 0.0
    for i in range(n):
        if i == gap:
            continue
        row, a, m = out[month(i)], own[max(0, i - 11):i + 1], market[max(0, i - 11):i + 1]
        assert row.MonthlyReturn == pytest.approx(own[i], abs=1e-12) and row.Return_IsMissing == int(i in unknown)
        assert row.MonthlyExcessReturn == pytest.approx(0.02)
        if i < 5:
            assert row.ShortTermBeta is None and row.Variance is None
        else:
            assert row.ShortTermBeta == pytest.approx(covariance(a, m) / covariance(m, m))
            assert row.Variance == pytest.approx(covariance(a, a))


def test_keep_last_limits_groups_before_the_shuffle(spark, panel):
    out = W.keep_last(frame(spark, panel), ["Ticker"], [F.desc("Date")])
    assert out._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") >= 2
    want = panel.sort_values("Date").drop_duplicates("Ticker", keep="last")
    assert out.count() == len(want)


def test_identity_of_total_and_parts(spark):
    """(total, first, second) before and after; the usual split is one to four."""
    cases = [
        ((100.0, 30.0, 70.0), (100.0, 30.0, 70.0)), ((None, 30.0, 70.0), (100.0, 30.0, 70.0)),
        ((100.0, None, 70.0), (100.0, 30.0, 70.0)), ((100.0, 30.0, None), (100.0, 30.0, 70.0)),
        ((100.0, None, None), (100.0, 20.0, 80.0)), ((None, None, 80.0), (100.0, 20.0, 80.0)),
        ((None, 20.0, None), (100.0, 20.0, 80.0)), ((0.0, None, None), (0.0, 0.0, 0.0)),
        ((0.0, 30.0, None), (0.0, 30.0, 0.0)), ((100.0, None, 130.0), (100.0, 0.0, 130.0)),
        ((100.0, -5.0, 70.0), (100.0, 0.0, 70.0)), ((None, -30.0, 90.0), (60.0, 0.0, 90.0)),
        ((None, None, None), (None, None, None)),
    ]
    df = spark.createDataFrame([(i, *before) for i, (before, _) in enumerate(cases)], "i int, t double, s double, g double")
    for row in M.identity_split(df, "t", "s", "g").collect():
        got, want = (row["t"], row["s"], row["g"]), cases[row["i"]][1]
        assert got == want if None in want else got == pytest.approx(want), cases[row["i"]]


def test_a_small_spread_around_a_large_return_keeps_its_digits(spark):
    rng = np.random.default_rng(8)
    months = [dt.date(2020 + k // 12, k % 12 + 1, 1) for k in range(14)]
    returns, market = 1e6 + 1e-3 * rng.normal(size=14), rng.normal(0.01, 0.05, 14)
    opens, index = np.cumprod(1 + returns), 100 * np.cumprod(1 + market)
    gone = {5, 9}  # months without a row count as zero returns
    rows = [(t, m, float(o), float(o)) for t in ("A", "B") for k, (m, o) in enumerate(zip(months, opens)) if t == "A" or k not in gone]
    schema = "Ticker string, Date date, Open double, Close double"
    out = W.returns_and_betas(spark.createDataFrame(rows, schema), spark.createDataFrame(
        [("M", m, float(o), float(o)) for m, o in zip(months, index)], schema))
    got = {(r.Ticker, r.Date): r for r in out.collect()}
    seen = {"A": np.concatenate([[0], opens[1:] / opens[:-1] - 1])}
    seen["B"] = np.where([k in gone or k - 1 in gone or k == 0 for k in range(14)], 0, seen["A"])
    m = np.concatenate([[0], index[1:] / index[:-1] - 1])
    for t in ("A", "B"):
        for k in range(5, 14):
            if t == "B" and k in gone:
                continue
            low = max(0, k - 11)
            r, x = seen[t][low:k + 1].astype(np.longdouble), m[low:k + 1].astype(np.longdouble)
            assert got[t, months[k]].Variance == pytest.approx(float(r.var(ddof=1)), rel=1e-6)
            beta = ((r - r.mean()) * (x - x.mean())).sum() / (len(r) - 1) / x.var(ddof=1)
            assert got[t, months[k]].ShortTermBeta == pytest.approx(float(beta), rel=1e-6, abs=1e-9)
    steady = seen["A"][2:14]
    assert got["A", months[13]].Variance == pytest.approx(steady.var(ddof=1), rel=1e-6) and steady.var() < 1e-4


def test_exponents_maximise_the_likelihood(spark):
    rng = np.random.default_rng(2)
    data = pd.DataFrame({"a": rng.lognormal(0, 1, 3000), "b": -rng.lognormal(0, 0.5, 3000), "c": rng.normal(0, 1e-3, 3000),
                         "d": rng.normal(5, 1, 3000), "k": 1.0})
    fitted = fit_exponents(to_spark(spark, data), list(data))

    def likelihood(x, lam):
        size = np.log1p(np.abs(x))
        p = np.where(x < 0, 2 - lam, lam)
        y = np.sign(x) * np.expm1(p * size) / p
        return -0.5 * np.log(y.var()) + (lam - 1) * np.mean(np.sign(x) * size)

    assert fitted["k"] == 1.0
    for c in "abcd":
        x, lam = data[c].to_numpy(), fitted[c]
        h = 1e-3 * max(1, abs(lam))
        assert likelihood(x, lam) >= max(likelihood(x, lam - h), likelihood(x, lam + h))
    out = transform_yeo_johnson(to_spark(spark, data), ["a", "b"]).toPandas()
    np.testing.assert_allclose(out[["a_Yeo", "b_Yeo"]].mean(), 0, atol=1e-9)
    np.testing.assert_allclose(out[["a_Yeo", "b_Yeo"]].std(ddof=0), 1, rtol=1e-9)
    assert list(out.columns) == ["c", "d", "k", "a_Yeo", "b_Yeo"]


def test_two_scans_give_exact_exponents(spark, monkeypatch):
    from panelloom.operators import power
    rng = np.random.default_rng(12)
    data = pd.DataFrame({"wide": rng.standard_cauchy(4000) * 100, "pos": rng.lognormal(3, 2, 4000), "mix": rng.normal(0.5, 2, 4000),
                         "far": 1e6 + rng.normal(0, 10, 4000), "gap": np.where(rng.random(4000) < 0.2, np.nan, rng.gamma(2, 3, 4000))})
    frame = to_spark(spark, data)
    scans = []
    for name in ("_histograms", "_log_likelihoods"):
        plain = getattr(power, name)
        monkeypatch.setattr(power, name, lambda *a, plain=plain: scans.append(1) or plain(*a))
    fitted = fit_exponents(frame, list(data))
    assert len(scans) == 2
    data["tiny"] = rng.exponential(1e-4, 4000)  # an exponent of some thousands
    fitted |= fit_exponents(to_spark(spark, data[["tiny"]]), ["tiny"])

    def slope(x, lam):
        h = 1e-3 * max(1, abs(lam))

        def likelihood(v):
            size = np.log1p(np.abs(x)).astype(np.longdouble)
            p = np.where(x < 0, 2 - v, v).astype(np.longdouble)
            y = np.sign(x) * np.where(p == 0, size, np.expm1(p * size) / np.where(p == 0, 1, p))
            return -np.log(y.var()) / 2 + (v - 1) * np.mean(np.sign(x) * size)
        return likelihood(lam - 2 * h) - 8 * likelihood(lam - h) + 8 * likelihood(lam + h) - likelihood(lam + 2 * h)

    for c in data:
        if c == "far":
            continue  # its likelihood is flat far beyond the precision of doubles
        x = data[c].dropna().to_numpy()
        reach = 0.5 * max(1, abs(fitted[c]) / 10)
        low, high = fitted[c] - reach, fitted[c] + reach
        assert slope(x, low) > 0 > slope(x, high)
        for _ in range(40):
            middle = (low + high) / 2
            low, high = (middle, high) if slope(x, middle) > 0 else (low, middle)
        assert fitted[c] == pytest.approx(low, abs=1e-6 * max(1, abs(low))), c


def test_duplicate_months_are_refused(spark):
    rows = [("A", dt.date(2020, 1, 1), 1.0), ("A", dt.date(2020, 1, 15), 2.0)]
    df = spark.createDataFrame(rows, "Ticker string, Date date, v double")
    with pytest.raises(ValueError):
        W.require_panel(df)
    assert W.require_panel(df.limit(1)).count() == 1
