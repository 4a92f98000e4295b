"""Feature job and model on the small test tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelloom import schema as S
from panelloom.modelling import contributions as N, forest as O, report as Q, validation as V
from panelloom.plans import train as T

TREES = {"numTrees": 12}


@pytest.fixture(scope="module")
def trained(feature_panel):
    return T.train(feature_panel, **TREES)


def test_feature_panel_is_complete(feature_panel):
    names = set(feature_panel.columns)
    assert {f"{c}_Yeo" for c in S.POWER_COLUMNS + S.POWER_COLUMNS_LATE} <= names
    assert {"DebtToEquity_Log1p", "CapExToRevenue_Log1p", "MonthlyExcessReturn_Quantile", O.LABEL} <= names
    assert not names & (set(S.POWER_COLUMNS) | set(S.LOG_COLUMNS) | {"MonthlyExcessReturn", "DateAdded", "Volume"})
    assert feature_panel.groupBy("Ticker", "Date").count().filter("count > 1").isEmpty()
    figures = feature_panel.agg(*[F.avg(f"{c}_Yeo").alias(c) for c in S.POWER_COLUMNS]).first()
    np.testing.assert_allclose(list(figures), 0, atol=0.2)
    shares = feature_panel.groupBy("Date").agg(F.avg(O.LABEL).alias("s"), F.countDistinct("MonthlyExcessReturn_Quantile").alias("k"),
                                                  F.count("*").alias("n")).filter("n >= 20 and k = 5").collect()
    assert all(0.1 < r["s"] < 0.35 for r in shares)


def test_the_feature_job_takes_few_spark_jobs(spark):
    """Every exchange is a job of its own under adaptive execution; it was 151 before."""
    from panelloom.catalog import fixtures as X, plans_q
    from panelloom.plans.features import build_features
    from panelloom.session import stage
    tables = X.Tables(spark, "/root/testdata/sf0.01", landed=True)
    raw, index = stage(plans_q.raw_panel(tables)), stage(X.market(tables))
    spark.sparkContext.setJobGroup("features", "count")
    try:
        stage(build_features(raw, index, plans_q.AS_OF))
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("features"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 64, jobs


def test_predictors_leave_out_statements_and_target(feature_panel):
    numeric, categorical = O.predictors(feature_panel)
    assert categorical == ["Sector"]
    assert not set(numeric) & (set(S.financial_columns()) | {O.LABEL, "Open", "Close", *S.WEAK_PREDICTORS})
    assert "ShortTermBeta" in numeric


def test_weights_balance_the_classes(trained):
    totals = O.class_weights(trained.history).groupBy(O.LABEL).agg(F.sum("weight").alias("w")).collect()
    n = trained.history.count()
    assert len(totals) == 2 and all(abs(r["w"] - n / 2) < 1e-6 * n for r in totals)


def test_ranking_and_report(spark, trained, feature_panel, tmp_path):
    ranked = O.ranked_predictions(trained.model, trained.live)
    rows = ranked.collect()
    assert len(rows) == trained.live.count() > 0
    assert [r["Probability_Top"] for r in rows] == sorted((r["Probability_Top"] for r in rows), reverse=True)
    assert all(r["Signal"] == ("Top_Quantile" if r["Predicted_Class"] == 1 else "Neutral") for r in rows)
    joined, path = Q.report(ranked, feature_panel, str(tmp_path), "2002-01-09")
    assert joined.count() == len(rows) == spark.read.csv(path, header=True).count()


def test_contributions_add_up(spark, trained):
    out = N.prediction_contributions(trained.model, trained.live, trained.names)
    assert out.count() == trained.live.count() * len(trained.names)
    assert N.additivity_gap(out).first()["gap"] < 1e-9
    sliced = N.prediction_contributions(trained.model, trained.live, trained.names, at_once=100)
    assert len(N.tree_slices(trained.model, 100)) > 1
    assert sliced.count() == out.count() and N.additivity_gap(sliced).first()["gap"] < 1e-9


def test_rows_of_one_entity_keep_their_identity(trained):
    entity = trained.history.groupBy("Ticker").count().orderBy(F.desc("count"), "Ticker").first()["Ticker"]
    months = trained.history.filter(F.col("Ticker") == entity)
    twice = months.unionAll(months)  # repeated keys as well
    out = N.prediction_contributions(trained.model, twice, trained.names)
    assert N.additivity_gap(out).first()["gap"] < 1e-9
    per = out.groupBy("row", "Ticker", "Date").agg(F.count("*").alias("n"), F.sum("contribution").alias("s"))
    rows = per.collect()
    assert len(rows) == 2 * months.count() and {r["n"] for r in rows} == {len(trained.names)}
    by_date = {}
    for r in rows:
        by_date.setdefault(r["Date"], []).append(round(r["s"], 9))
    assert all(len(x) == 2 and x[0] == x[1] for x in by_date.values()) and len({x[0] for x in by_date.values()}) > 1


def grown(rng, depth, features):
    """Saved nodes of a random tree whose paths repeat features, with weights that add up."""
    nodes = []

    def grow(level, stats):
        key = len(nodes)
        nodes.append(None)
        if level == depth or min(stats) < 1:
            nodes[key] = (stats, -1, -1, 0, [], -1)
            return key
        part = [float(rng.integers(0, int(s) + 1)) for s in stats]
        if sum(part) in (0.0, sum(stats)):
            part = [s / 2 for s in stats]
        feature = int(rng.integers(features))
        kind = -1 if feature else 4  # feature 0 is a category
        bounds = [float(rng.normal())] if feature else [float(c) for c in rng.choice(4, 2, replace=False)]
        low = grow(level + 1, part)
        high = grow(level + 1, [s - x for s, x in zip(stats, part)])
        nodes[key] = (stats, low, high, feature, bounds, kind)
        return key

    grow(0, [800.0, 700.0])
    return [{"treeID": 0, "id": i, "impurityStats": n[0], "leftChild": n[1], "rightChild": n[2],
             "split": {"featureIndex": n[3], "leftCategoriesOrThreshold": n[4], "numCategories": n[5]}} for i, n in enumerate(nodes)]


def worth(nodes, row, known, at=0):
    """Value of a tree when only the features in ``known`` are used."""
    n = nodes[at]
    stats, split = n["impurityStats"], n["split"]
    if n["leftChild"] < 0:
        return stats[1] / sum(stats) if sum(stats) else 0.0
    below = (n["leftChild"], n["rightChild"])
    if split["featureIndex"] in known:
        x, bounds = row[split["featureIndex"]], split["leftCategoriesOrThreshold"]
        left = x <= bounds[0] if split["numCategories"] == -1 else x in bounds
        return worth(nodes, row, known, below[0 if left else 1])
    return sum(sum(nodes[b]["impurityStats"]) / sum(stats) * worth(nodes, row, known, b) for b in below)


@pytest.mark.parametrize("depth, features", [(1, 2), (3, 3), (4, 6), (7, 4)])
def test_contributions_equal_the_subset_definition(depth, features):
    """Random trees, every subset of features by hand."""
    from itertools import combinations
    from math import factorial
    rng = np.random.default_rng(depth)
    for _ in range(3):
        nodes = grown(rng, depth, features)
        tree = N.tree_arrays(nodes, 1)
        x = np.column_stack([rng.integers(0, 4, 5), rng.normal(size=(5, features - 1))]).astype(float)
        got = N.attribute(x, tree)
        for i, row in enumerate(x):
            for f in range(features):
                others = [g for g in range(features) if g != f]
                want = sum(factorial(k) * factorial(features - 1 - k) / factorial(features)
                           * (worth(nodes, row, {*s, f}) - worth(nodes, row, set(s)))
                           for k in range(features) for s in combinations(others, k))
                assert got[i, f] == pytest.approx(want, abs=1e-12)
        assert N.expected_value(tree) == pytest.approx(worth(nodes, x[0], set()))


def test_deep_trees_are_attributed(trained, feature_panel):
    deep = T.train(feature_panel, numTrees=3, maxDepth=12, minInstancesPerNode=1)
    assert max(t.depth for t in deep.model.trees) >= 10
    assert N.additivity_gap(N.prediction_contributions(deep.model, deep.live, deep.names)).first()["gap"] < 1e-9


def test_history_figures(trained):
    confusion, precise = T.history_figures(trained)
    assert confusion.agg(F.sum("count")).first()[0] == trained.history.count()
    assert 0 <= precise.first()["precision"] <= 1


def test_validation(spark, trained, feature_panel):
    scores = V.time_series_cv(feature_panel, folds=3, parallelism=2, **TREES)
    assert [r["fold"] for r in scores.orderBy("fold").collect()] == [1, 2, 3]
    importance = O.feature_importance(spark, trained.model, trained.names).collect()
    assert len(importance) == len(trained.names) and abs(sum(r["importance"] for r in importance) - 1) < 1e-9


def test_grid_points_share_prepared_folds(spark, feature_panel, monkeypatch):
    scaled, plain = [], V.scale_features
    monkeypatch.setattr(V, "scale_features", lambda *a: scaled.append(1) or plain(*a))
    grid = {"numTrees": [4], "maxDepth": [2, 3], "seed": [1, 2]}
    out = V.grid_search_ts(feature_panel, grid, folds=2, parallelism=3)
    rows = out.collect()
    assert len(rows) == 4 and len(scaled) == 2 * 2  # both sides of each fold, whatever the grid
    assert [r["precision"] for r in rows] == sorted((r["precision"] for r in rows), reverse=True)
    single = V.cv_summary(V.time_series_cv(feature_panel, folds=2, numTrees=4, maxDepth=3, seed=2)).first()["mean"]
    chosen = next(r for r in rows if "'maxDepth': 3, 'seed': 2" in r["params"])
    assert chosen["precision"] == pytest.approx(single, abs=1e-12)


def test_three_phases_from_landed_files_to_the_report(spark, tmp_path):
    from panelloom.catalog import fixtures as X, plans_q
    from panelloom.plans import phases
    from panelloom.sources import sinks
    tables = X.Tables(spark, "/root/testdata/sf0.01", landed=True)
    landed, root = str(tmp_path / "landed"), str(tmp_path / "kept")
    plans_q.land(tables, landed)
    families = ("general", "banks")
    first = phases.run(spark, landed, root, plans_q.AS_OF, families, top=60, **TREES)
    assert first.path.endswith("/reports/2001_12_31.csv") and first.report.count() == spark.read.csv(first.path, header=True).count() > 0
    assert first.confusion.agg(F.sum("count")).first()[0] > 0 and 0 <= first.precision.first()["precision"] <= 1
    stored = sinks.open_store(spark, f"{root}/raw")
    before, version = stored.count(), sinks.latest_version(spark, f"{root}/raw")
    assert stored.select("Ticker").distinct().count() <= 60
    # a second run asks only for entities whose last month is behind, and loses nothing
    phases.extract(spark, landed, root, plans_q.AS_OF, families, top=60)
    again = sinks.open_store(spark, f"{root}/raw")
    assert again.count() >= before and again.groupBy("Ticker", "Date").count().filter("count > 1").isEmpty()
    assert sinks.latest_version(spark, f"{root}/raw") >= version


def test_wide_prices_and_entities_without_data(spark):
    import datetime
    from panelloom.plans import phases
    day = datetime.datetime(2020, 1, 2, 5)
    wide = spark.createDataFrame([(day, 1.0, None, 2.0, 3.0)], "Date timestamp, `Open|A` double, `Open|B` double, `Close|A` double, `Close|B` double")
    rows = {r.Ticker: (r.Open, r.Close) for r in phases.landed_prices(wide).collect()}
    assert rows == {"A": (1.0, 2.0), "B": (None, 3.0)}
    universe = spark.createDataFrame([("A",), ("B",), ("C",)], "Ticker string")
    statements = spark.createDataFrame([("A",), ("C",)], "Ticker string")
    assert sorted(r[0] for r in phases.without_data(universe, phases.landed_prices(wide), statements).collect()) == ["B", "C"]
