"""Whitening, ranked search and near-duplicate vectors: exact figures, SQL and brute force."""

import math

import numpy as np
import pytest
from compare import compare, duck

from panelloom.llm import lattice, queries, ranking, whitening

SF, SMALL = "/root/testdata/sf0.01", "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def embeddings(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    return ([r.vec_id for r in rows], np.array([r.embedding for r in rows], np.float64), [r.label for r in rows])


# ---- whitening --------------------------------------------------------------------------------


def whitened_by_hand(vectors):
    x = np.floor(1024 * vectors).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    return ((n * x - sums) ** 2).sum(axis=1), centred @ axes[:, :8] / np.sqrt(values[:8]), values / values.sum()


def test_whitening_query_equals_the_eigenvectors(spark, embeddings):
    ids, vectors, _ = embeddings
    rows = {(r.vec_id, r.component): r for r in queries.op11_whitening(spark, SF).collect()}
    assert len(rows) == 8 * len(ids)
    deviation, white, explained = whitened_by_hand(vectors)
    for at, i in enumerate(ids):
        for k in range(8):
            row = rows[i, k + 1]
            assert (row.n, row.deviation) == (len(ids), deviation[at])
            assert abs(row.whitened) == pytest.approx(abs(white[at, k]), rel=1e-8, abs=1e-9)
            assert row.explained == pytest.approx(explained[k], rel=1e-10) and row.identity_error < 1e-9
    for k in range(8):  # either sign, the same for all rows
        signs = {np.sign(rows[i, k + 1].whitened * white[at, k]) for at, i in enumerate(ids) if abs(white[at, k]) > 1e-6}
        assert len(signs) == 1


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(3)
    good = rng.normal(size=(40, 12)).tolist()
    bad = [None, [], [1.0] * 11 + [None], [1.0] * 11 + [float("nan")], [float("inf")] + [1.0] * 11, [1.0] * 5]
    rows = [(i, v, "x", 0.5) for i, v in enumerate(good + bad)] + [(0, good[0], "x", 0.5), (None, good[1], "x", 0.5)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, whitened string, deviation double")
    out, model, error = whitening.whiten(frame)
    got = out.collect()
    assert model.centre.n == len(got) == 42 and error < 1e-9
    deviation, white, _ = whitened_by_hand(np.array([*good, good[0], good[1]]))
    assert sorted(int(r.deviation) for r in got) == sorted(deviation.tolist())
    assert np.allclose(sorted(abs(r.whitened[0]) for r in got), sorted(abs(white[:, 0])))
    empty, none, _ = whitening.whiten(frame.limit(0))
    assert none is None and empty.count() == 0
    assert whitening.whiten(frame.filter("vec_id > 40"))[0].count() > 0  # a handful of rows, most not usable


def test_whitening_without_variance_in_some_directions(spark):
    rng = np.random.default_rng(5)
    flat = np.column_stack([rng.normal(size=(30, 3)), np.full((30, 2), 0.25)])
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(flat.tolist())], "vec_id long, embedding array<double>")
    out, model, error = whitening.whiten(frame)
    rows = out.collect()
    assert [w is None for w in rows[0].whitened] == [False] * 3 + [True] * 2 and error < 1e-9
    assert model.explained[:3].sum() == pytest.approx(1)
    one = whitening.whiten(frame.limit(1))[0].first()
    assert one.whitened == [None] * 5 and one.deviation == 0
    # more dimensions than rows
    wide = spark.createDataFrame([(i, v) for i, v in enumerate(rng.normal(size=(6, 20)).tolist())], "vec_id long, embedding array<double>")
    rows = whitening.whiten(wide)[0].collect()
    assert all(w is not None for r in rows for w in r.whitened[:5]) and all(w is None for r in rows for w in r.whitened[5:])


def test_sums_are_exact_where_doubles_are_not():
    centre = whitening.Centre(3, [2 ** 60 + 1, 5])
    x = np.array([[2 ** 58, 1], [2 ** 59, 3]], np.int64)
    want = [sum((3 * int(a) - s) ** 2 for a, s in zip(row, centre.sums)) for row in x]
    assert centre.deviations(x).tolist() == want
    rows = np.random.default_rng(0).normal(size=(9, 4))
    f = np.triu(np.random.default_rng(1).normal(size=(4, 4))) + 3 * np.eye(4)
    assert np.allclose(whitening.solved(rows, [f, f]) @ f @ f, rows)


# ---- ranked search ----------------------------------------------------------------------------


def ranked_by_hand(docs, items):
    bags = [(i, ranking.terms((t or "").encode())) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n, size = len(bags), sum(len(b) for _, b in bags)
    df = {}
    for _, b in bags:
        for t in set(b):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        scored = []
        for i, b in bags:
            m, score = 75 + (25 * len(b) * n) // size, 0
            for t in ranking.terms((text or "").encode()):
                if t in df and t in b:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    score += w * ((10 ** 9 * b.count(t)) // (1000 * b.count(t) + 12 * m))
            if score > 0:
                scored.append((-score, -1 if i is None else i, i))
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(scored, key=lambda x: x[:2])[:20], 1)]
    return sorted(out, key=str)


def found(frame):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in frame.collect()), key=str)


def test_ranking_with_copies_ties_and_odd_rows(spark):
    rng = np.random.default_rng(7)
    words = [f"w{x}" for x in range(30)] + ["Ünï", "x_y", "9"]
    docs = [(i, " ".join(rng.choice(words, int(rng.integers(1, 30))))) for i in range(150)]
    docs += [(200 + i, docs[3][1].upper() + "!") for i in range(60)]  # a class beyond the best twenty
    docs += [(300, None), (301, ""), (302, "!? ."), (303, "long " * 30_000), (None, docs[5][1]), (7, docs[7][1]), (7, docs[7][1])]
    items = [(1, docs[3][1]), (2, "w1 w1 w2"), (3, None), (4, "--"), (5, "unknown"), (6, "ÜNÏ Ünï long"), (None, "w3"), (8, docs[7][1])]
    d = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id long, text string, item_id string, score int")
    q = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, rank string")
    assert found(ranking.best_documents(d, q)) == ranked_by_hand(docs, items)
    assert ranking.best_documents(d.limit(0), q).count() == 0
    assert ranking.best_documents(d, q.limit(0)).count() == 0


def test_items_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(ranking, "ITEMS", 3)
    docs = [(i, f"a{i % 3} b{i % 5} c{i % 7}") for i in range(60)]
    items = [(i, f"a{i % 3} c{i}") for i in range(8)]
    got = ranking.best_documents(spark.createDataFrame(docs, "doc_id long, text string"),
                                 spark.createDataFrame(items, "item_id long, text string"))
    assert found(got) == ranked_by_hand(docs, items)


def test_equal_bags_are_scored_once(spark):
    docs = spark.createDataFrame([(i, "alpha beta gamma" if i % 3 else "alpha") for i in range(900)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "alpha beta")], "item_id long, text string")
    rows = ranking.best_documents(docs, items).orderBy("rank").collect()
    assert [r.doc_id for r in rows] == [i for i in range(900) if i % 3][:20]


# ---- near-duplicate vectors -------------------------------------------------------------------


def test_lattice_points_are_the_nearest():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 8)) * 1.5
    got = lattice.nearest_lattice(x)
    around = lattice.neighbours()
    assert len({tuple(v) for v in around.tolist()}) == 240 and np.allclose((around ** 2).sum(axis=1), 2)
    for p, q in zip(x, got):
        whole = np.allclose(q, np.rint(q)) and q.sum() % 2 == 0
        half = np.allclose(q - 0.5, np.rint(q - 0.5)) and (q - 0.5).sum() % 2 == 0
        assert whole or half
        # the Voronoi cell is bounded by the shortest vectors and those of norm 4
        assert ((p - q) ** 2).sum() <= ((p - q - around) ** 2).sum(axis=1).min() + 1e-12
        assert ((p - q) ** 2).sum() <= 1 + 1e-12  # the covering radius


def linked_by_hand(rows, cosine=lattice.COSINE):
    n, links = len(rows), [0] * len(rows)
    parent = list(range(n))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    def good(v, label):
        return v is not None and label is not None and len(v) and all(c is not None and math.isfinite(c) for c in v) and any(v)

    for a in range(n):
        for b in range(a):
            (_, u, k), (_, v, m) = rows[a], rows[b]
            if good(u, k) and good(v, m) and k == m and len(u) == len(v):
                if np.dot(u, v) / math.sqrt(np.dot(u, u) * np.dot(v, v)) >= cosine:
                    links[a] += 1
                    links[b] += 1
                    parent[find(a)] = find(b)
    least = {}
    for a in range(n):
        if rows[a][0] is not None:
            least[find(a)] = min(least.get(find(a), rows[a][0]), rows[a][0])
    return sorted(((rows[a][0], links[a], least.get(find(a)), rows[a][0] == least.get(find(a))) for a in range(n)), key=str)


def rows_of(frame):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in frame.collect()), key=str)


def vectors_with_families(rng, d, families, size, spread, alone=60):
    out = [v for v in rng.normal(size=(alone, d))]
    for _ in range(families):
        centre = rng.normal(size=d)
        centre /= np.linalg.norm(centre)
        out += [centre + spread * rng.normal(size=d) / math.sqrt(d) for _ in range(size)]
    return out


@pytest.mark.parametrize("d, size, spread", [(64, 30, 0.25), (64, 100, 0.15), (16, 20, 0.2), (3, 20, 0.1)])
def test_links_equal_all_pairs(spark, d, size, spread):
    """Loose families, one that makes balls, and vectors shorter than the lattice blocks."""
    rng = np.random.default_rng(d + size)
    rows = [(i, v.tolist(), int(i % 2)) for i, v in enumerate(vectors_with_families(rng, d, 3, size, spread))]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, label int, n_links int")
    assert rows_of(lattice.near_duplicates(frame)) == linked_by_hand(rows)


def test_large_cells_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(lattice, "DENSE", 16)
    rng = np.random.default_rng(9)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors_with_families(rng, 32, 2, 120, 0.22, alone=20))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    rows = [(i, np.array(v, np.float32).astype(float).tolist(), k) for i, v, k in rows]
    assert rows_of(lattice.near_duplicates(frame, chunk=7)) == linked_by_hand(rows)


def test_odd_vectors(spark):
    v = [1.0, 2.0, 3.0, 4.0]
    rows = [(5, v, 1), (3, v, 1), (4, [2 * x for x in v], 1), (2, v, 2), (9, v, None), (8, None, 1), (7, [], 1), (6, [0.0] * 4, 1),
            (10, [1.0, None, 3.0, 4.0], 1), (11, [1.0, float("nan"), 3.0, 4.0], 1), (12, [1.0, 2.0, 3.0], 1), (3, v, 1), (None, v, 2),
            (13, [-x for x in v], 1), (14, [1e300 * x for x in v], 1), (15, [float("inf")] * 4, 1)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, kept string")
    plain = [(i, [1.0, 2.0, 3.0, 4.0] if i == 14 else x, k) for i, x, k in rows]  # the squares of 1e300 pass a double
    assert rows_of(lattice.near_duplicates(frame)) == linked_by_hand(plain)
    assert lattice.near_duplicates(frame.limit(0)).count() == 0


def test_recall_at_the_threshold():
    rng = np.random.default_rng(4)
    u = lattice.units_of(rng.normal(size=(3000, 64)), 64)
    z = rng.normal(size=(3000, 64))
    z = lattice.units_of(z - (z * u).sum(axis=1, keepdims=True) * u, 64)
    w = lattice.COSINE * u + math.sqrt(1 - lattice.COSINE ** 2) * z
    group = np.zeros(3000, np.int64)
    cells = [np.concatenate(lattice._lattice(64).cells(x, group), axis=1) for x in (u, w)]
    shared = np.mean([bool(set(a) & set(b)) for a, b in zip(cells[0].tolist(), cells[1].tolist())])
    assert shared > 0.997


def test_ranking_query_matches_sql(spark):
    assert compare(spark, duck(SMALL), "op12_bag_ranking", queries.QUERIES, queries.ORACLE, SMALL) == []
