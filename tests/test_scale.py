"""What is read, built or scaled once however often a query uses it."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import DATA
from panelloom.catalog import fixtures as X, load, plans_q
from panelloom.modelling import forest as O, validation as V
from panelloom.operators.ranking import expanding_folds
from panelloom.session import stage


@pytest.mark.parametrize("name", ["left_join_statements", "outer_join_statements", "load_statements", "coalesce_merge", "upsert_panel"])
def test_sources_that_are_used_twice_are_built_once(spark, name):
    """The sides come from one written table: none of them goes back to the line items."""
    files = load().QUERIES[name](spark, f"{DATA}/sf0.001").inputFiles()
    assert files and not [f for f in files if "lineitem" in f]


def test_raw_job_lands_tables_that_are_built_once(spark, monkeypatch):
    seen = []

    def land(t, folder):
        seen.append(t)
        raise InterruptedError

    monkeypatch.setattr(plans_q, "land", land)
    with pytest.raises(InterruptedError):
        plans_q.raw_job(X.Tables(spark, f"{DATA}/sf0.001"))
    assert seen[0].landed is not None


def test_build_features_is_not_written_before_it_is_returned(monkeypatch):
    panel = object()
    monkeypatch.setattr(plans_q, "feature_panel", lambda t: panel)
    assert plans_q.build_features(None) is panel


def test_folds_are_scaled_in_one_pass_as_if_side_by_side(spark, monkeypatch):
    """Borders cut months here; one sector and one month are unknown."""
    rows = [(f"E{e:02d}", None if e == 3 and m == 5 else dt.date(2020, m, 1), int((e * 7 + m) % 5 == 0), float((e * 37 + m * 11) % 23),
             None if e % 10 == 9 else "AB"[e % 2], "X") for e in range(40) for m in range(1, 8)]
    panel = spark.createDataFrame(rows, f"Ticker string, Date date, {O.LABEL} int, Margin double, Sector string, Industry string")
    calls, plain = [], V.scale_features
    monkeypatch.setattr(V, "scale_features", lambda *a, **k: calls.append(1) or plain(*a, **k))
    placed = stage(expanding_folds(panel.select("Date", "Ticker", O.LABEL, "Margin", "Sector", "Industry")))
    sides = V._scaled_once(placed, ["Margin"])

    def scores(df):
        return sorted((str(r.Date), r.Ticker, round(r.Margin, 9)) for r in df.collect())

    for number in range(1, 6):
        for got, part in zip(sides(number), (F.col("fold") < number, F.col("fold") == number)):
            assert scores(got) == scores(plain(placed.filter(part), ["Margin"]))
    assert len(calls) == 1
