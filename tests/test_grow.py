"""The grown forest next to Spark's own, and what it holds."""

import math

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from panelloom.modelling import contributions as N, forest as O, grow as G
from panelloom.session import stage


@pytest.fixture(scope="module")
def encoded(spark):
    """Rows with a category, ties, a constant and a rare class."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(900):
        a, b, kind = float(rng.normal()), float(rng.integers(0, 12)), "xyz"[int(rng.integers(3))]
        hit = a + (b > 5) + (kind == "x") + rng.normal() > 2
        rows.append((f"E{i}", a, b, 7.0, float(np.round(rng.normal(), 1)), kind, int(hit)))
    df = spark.createDataFrame(rows, "Ticker string, a double, b double, c double, d double, Sector string, y int")
    return stage(O.encoder(["a", "b", "c", "d"], ["Sector"]).fit(df).transform(df).select("Ticker", "y", "features"))


ALL_ROWS = {"numTrees": 1, "bootstrap": False, "subsamplingRate": 1.0, "featureSubsetStrategy": "all"}


@pytest.mark.parametrize("settings", [
    {"maxDepth": 4, "minInstancesPerNode": 20}, {"maxDepth": 6, "minInstancesPerNode": 1, "maxBins": 9},
    {"maxDepth": 3, "impurity": "entropy", "minWeightFractionPerNode": 0.1}, {"maxDepth": 5, "minInfoGain": 0.02}, {"maxDepth": 0}])
def test_a_tree_of_all_rows_is_sparks_tree(encoded, settings):
    """Without draws and subsets nothing is left to chance: the same nodes, thresholds, counts and gains."""
    mine = O.fit_forest(encoded, "y", **ALL_ROWS, **settings)
    theirs = RandomForestClassifier(labelCol="y", featuresCol="features", weightCol="weight", **{**O.FOREST, **ALL_ROWS, **settings}).fit(
        O.class_weights(encoded, "y"))
    assert mine.toDebugString.splitlines()[1:] == theirs.toDebugString.splitlines()[1:]
    spark = encoded.sparkSession
    saved = [sorted(N.saved_nodes(spark, m).collect(), key=lambda r: r["id"]) for m in (mine, theirs)]
    for one, other in zip(*saved, strict=True):
        assert one["rawCount"] == other["rawCount"] and one["impurityStats"] == pytest.approx(other["impurityStats"])
        assert one["gain"] == pytest.approx(other["gain"])
        assert one["impurity"] == pytest.approx(other["impurity"]) or other["impurity"] == -1  # Spark's mark of a leaf without a split
    assert mine.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray())


def test_a_forest_is_sparks_in_distribution_and_repeats_itself(encoded):
    settings = {"numTrees": 150, "maxDepth": 4, "minInstancesPerNode": 10, "subsamplingRate": 0.5}

    def probabilities(model):
        rows = model.transform(encoded).select("Ticker", O.probability_of().alias("p")).collect()
        return np.array([r["p"] for r in sorted(rows)])

    mine, again = (probabilities(O.fit_forest(encoded, "y", **settings, seed=5)) for _ in range(2))
    theirs = probabilities(RandomForestClassifier(labelCol="y", featuresCol="features", weightCol="weight", **{**O.FOREST, **settings}).fit(
        O.class_weights(encoded, "y")))
    assert (mine == again).all()
    assert np.corrcoef(mine, theirs)[0, 1] > 0.98 and np.abs(mine - theirs).mean() < 0.03


def test_rows_are_held_as_bytes_whatever_the_trees(spark, encoded, monkeypatch):
    """What is written for the passes does not grow with the trees."""
    staged = []
    monkeypatch.setattr(G, "stage", lambda df: staged.append(stage(df)) or staged[-1])
    for trees in (3, 60):
        O.fit_forest(encoded, "y", numTrees=trees, maxDepth=3)
    sizes = [t.agg(F.sum(F.octet_length("x") + F.octet_length("y"))).first()[0] for t in staged]
    features = encoded.schema["features"].metadata["ml_attr"]["num_attrs"]
    assert sizes == [900 * (features + 1)] * 2


def test_a_level_in_several_passes_is_the_same(encoded, monkeypatch):
    settings = {"numTrees": 6, "maxDepth": 5, "minInstancesPerNode": 2}
    once = O.fit_forest(encoded, "y", **settings).toDebugString.splitlines()[1:]
    monkeypatch.setattr(G, "CELLS", 3000)
    assert O.fit_forest(encoded, "y", **settings).toDebugString.splitlines()[1:] == once


def test_draws_follow_the_poisson_law_and_the_row():
    hashes = G.row_hash(np.random.default_rng(4).integers(0, 1 << 63, 200_000).astype(np.uint64))
    table = G.draw_table(0.3, True)
    rows = [G.drawn(hashes, 42, tree, table) for tree in range(2)]
    for r in rows:
        times = np.bincount(np.bincount(r, minlength=len(hashes)))
        for k in range(4):
            share = math.exp(-0.3) * 0.3 ** k / math.factorial(k)
            assert abs(times[k] - share * len(hashes)) < 5 * math.sqrt(share * len(hashes))
    one, two = (np.bincount(r, minlength=len(hashes)) for r in rows)
    assert abs(np.corrcoef(one, two)[0, 1]) < 0.01
    part = G.drawn(hashes[500:900], 42, 0, table) + 500  # a block's draws do not depend on its place
    assert part.tolist() == rows[0][(rows[0] >= 500) & (rows[0] < 900)].tolist()
    assert len(G.drawn(hashes, 1, 0, G.draw_table(1.0, False))) == len(hashes)


def test_the_layout_of_the_rows_does_not_matter(encoded, monkeypatch):
    monkeypatch.setattr(G, "POINTS", 64)
    settings = {"numTrees": 5, "maxDepth": 4, "minInstancesPerNode": 5}
    one, other = (O.fit_forest(stage(df), "y", **settings).toDebugString.splitlines()[1:]
                  for df in (encoded.repartition(7, "Ticker"), encoded.orderBy(F.desc("Ticker")).coalesce(1)))
    assert one == other


def test_cells_keep_ranks_and_do_not_depend_on_the_order():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=90_000), np.zeros(5_000), 1e6 + rng.random(5_000), -rng.random(100) * 1e-300, [np.inf, -np.inf]])
    own = np.eye(2, dtype=np.int64)[rng.integers(0, 2, len(x))]
    whole = G.merged(x, x, own, 0)
    part = (x[:0], x[:0], own[:0], 0)
    for some in np.array_split(rng.permutation(len(x)), 9):
        part = G.merged(*(np.concatenate([a, b]) for a, b in zip(part, (x[some], x[some], own[some]))), part[3])
    for a, b in zip(whole, part):
        assert np.array_equal(a, b)
    lo, hi, counts, _ = whole
    assert 1000 < len(lo) <= G.POINTS and (counts.sum(axis=0) == own.sum(axis=0)).all() and (hi[:-1] < lo[1:]).all()
    for k in (10, len(lo) // 2, len(lo) - 5):
        assert counts[:k].sum() == (x <= hi[k - 1]).sum()
    near = 1000 + rng.random(50_000) / 1e6  # values that agree in most bits
    assert len(G.merged(near, near, np.ones((50_000, 1), np.int64), 0)[0]) > 1000
    assert G.borders(np.array([1.0, 2.0, 4.0]), np.array([1.0, 2.0, 4.0]), np.ones(3), 31).tolist() == [1.5, 3.0]
    assert len(G.borders(lo, hi, counts.sum(axis=1), 31)) == 31


def test_spark_grows_what_has_more_than_two_categories(spark, encoded):
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    rows = spark.createDataFrame([("abc"[i % 3], float(i % 7), int(i % 3 == 0)) for i in range(120)], "s string, v double, y int")
    coded = VectorAssembler(inputCols=["k", "v"], outputCol="features").transform(
        StringIndexer(inputCol="s", outputCol="k").fit(rows).transform(rows))
    model = O.fit_forest(coded, "y", numTrees=2, minInstancesPerNode=1, subsamplingRate=1.0)
    assert model.getNumTrees == 2 and model.numClasses == 2
    with pytest.raises(ValueError):
        O.fit_forest(encoded.limit(0), "y")
