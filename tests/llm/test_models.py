"""Language identification and class-based scores: exact parts by brute force, the rest by held-out rows."""

import itertools
import math
from collections import Counter

import numpy as np
import pytest

from panelloom.llm import brown, langid, queries
from panelloom.llm.common import py_id_remainder

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").collect()


def all_paths(scores, moves):
    """Marginals and expected transitions by enumeration."""
    n, k = scores.shape
    marginal, pairs, total = np.zeros((n, k)), np.zeros((k, k)), 0.0
    for path in itertools.product(range(k), repeat=n):
        weight = math.exp(sum(scores[t, y] for t, y in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:])))
        total += weight
        for t, y in enumerate(path):
            marginal[t, y] += weight
        for a, b in zip(path, path[1:]):
            pairs[a, b] += weight
    return marginal / total, pairs / total


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(5)
    moves = rng.normal(size=(3, 3))
    chains = [rng.normal(size=(n, 3)) for n in (6, 4, 4, 1)]
    got = langid.forward_backward(np.concatenate(chains), np.array([6, 4, 4, 1]), moves)
    assert np.allclose(got, np.concatenate([all_paths(c, moves)[0] for c in chains]))
    marginal, pairs = langid.expected_counts(np.stack(chains[1:3]), moves)
    assert np.allclose(marginal[1], all_paths(chains[2], moves)[0])
    assert np.allclose(pairs, all_paths(chains[1], moves)[1] + all_paths(chains[2], moves)[1])


def test_held_out_accuracy_and_split(spark, documents):
    rows = {r.doc_id: r for r in queries.op2_language(spark, SF).collect()}
    assert len(rows) == len(documents)
    right = []
    for d in documents:
        row = rows[d.doc_id]
        assert row.held_out == (py_id_remainder(d.doc_id, 4) == 2)
        assert 0 <= row.score <= 1
        if row.held_out:
            right.append(row.lang_pred == d.lang)
    assert np.mean(right) > 0.97


def test_language_of_odd_rows_and_switches(spark, documents):
    sample = [(d.lang, langid.FIND(d.text.lower())) for d in documents[:400]]
    model = langid.train(sample, rounds=120)
    frame = spark.createDataFrame(
        [(1, None, "x"), (2, "", "x"), (3, "12 3! _", "x"), (4, "the", "x"), (4, "the", "x")], "doc_id long, text string, score string")
    rows = langid.predict(frame, model).collect()
    assert [(r.lang_pred, r.score) for r in rows if r.doc_id < 4] == [("und", 0.0)] * 3
    assert len({(r.lang_pred, r.score) for r in rows if r.doc_id == 4}) == 1
    assert langid.predict(frame.limit(0), model).count() == 0
    english = next(d.text for d in documents if d.lang == "en" and 200 < len(d.text) < 900)
    german = next(d.text for d in documents if d.lang == "de" and 200 < len(d.text) < 900)
    mixed = spark.createDataFrame([(1, english + " " + german)], "doc_id long, text string")
    runs = langid.predict(mixed, model, runs=True).first().runs
    share = Counter()
    for r in runs:
        share[r.lang] += r.words
    n = len(langid.FIND((english + " " + german).lower()))
    assert runs[0].lang == "en" and runs[-1].lang == "de" and sum(share.values()) == n
    assert share["en"] + share["de"] > 0.9 * n
    assert [r.first for r in runs] == [sum(x.words for x in runs[:i]) for i in range(len(runs))]


def test_no_labels_means_undetermined(spark):
    frame = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    model = langid.fit(frame)
    assert langid.predict(frame, model).first().lang_pred == "und"


def dense_neighbours(pairs, classes):
    def neighbours(label):
        marks = np.eye(classes)[label]
        return pairs @ marks, pairs.T @ marks
    return neighbours


def test_exchange_raises_the_likelihood():
    rng = np.random.default_rng(2)
    hidden = np.arange(60) % 3
    pairs = rng.poisson(np.where(hidden[:, None] == (hidden[None, :] + 1) % 3, 40, 1)).astype(float)
    order = rng.permutation(60)
    pairs, hidden = pairs[order][:, order], hidden[order]

    def value(mark):
        onto = np.zeros((3, 3))
        np.add.at(onto, (mark[:, None], mark[None, :]), pairs)
        return brown.likelihood(onto)

    label = brown.exchange(dense_neighbours(pairs, 3), np.diag(pairs), 3, rounds=20)
    assert value(label) > value(np.arange(60) % 3)
    assert value(label) >= value(hidden) - 0.02 * abs(value(hidden))
    # one sweep with sums that are in step is the exchange itself: no single move is left that gains
    label, onto = np.arange(60) % 3, np.zeros((3, 3))
    after, before = dense_neighbours(pairs, 3)(label)
    np.add.at(onto, label, after)
    brown.sweep(label, after, before, np.diag(pairs), onto)
    assert onto.sum() == pytest.approx(pairs.sum())


def test_sparse_pairs_and_classes_grow_with_the_vocabulary(spark):
    rng = np.random.default_rng(6)
    kinds = [[f"{c}{i}" for i in range(40)] for c in "nva"]
    texts = [" ".join(rng.choice(kinds[(start + k) % 3]) for k in range(30)) for start in rng.integers(0, 3, 300)] + [None, ""]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    words = [w.encode() for group in kinds for w in group]
    numbers = spark.sparkContext.broadcast({w: i for i, w in enumerate(words)})
    got = {(r.a, r.b): r.n for r in brown.map_batches(frame, lambda it: brown._sparse_pairs(it, numbers, len(words)), "a int, b int, n long")
           .groupBy("a", "b").sum("n").toDF("a", "b", "n").collect()}
    want = Counter()
    for t in texts:
        ids = [numbers.value[w] for w in brown.tokens_of(t or "") if w in numbers.value]
        want.update(zip(ids, ids[1:]))
    assert got == want
    label = brown.cluster(frame, words, classes=3, rounds=12)
    assert set(label) == set(words)
    together = [Counter(label[w.encode()] for w in group).most_common(1)[0][1] / len(group) for group in kinds]
    assert np.mean(together) > 0.8
    model, counts = brown.fit(frame)
    assert {w for w in words} <= set(model.classes)  # all of them occur often enough, whatever their number


def test_base_score_by_brute_force_and_model_beats_it(spark, documents):
    rows = {r.doc_id: r for r in queries.op4_brown_lm(spark, SF).collect()}
    tokens = {d.doc_id: brown.tokens_of(d.text or "") for d in documents}
    counts = Counter()
    for i, words in tokens.items():
        if py_id_remainder(i, 7) != 2:
            counts.update(words)
    n, v = sum(counts.values()), len(counts)
    for i, words in tokens.items():
        row = rows[i]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        assert row.base_score == pytest.approx(base, rel=1e-9)
        assert (row.n_tokens, row.n_known, row.train_tokens) == (len(words), sum(counts[w] > 0 for w in words), n)
        assert row.held_out == (py_id_remainder(i, 7) == 2)
    held = [r for r in rows.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_scores_follow_the_model(spark, documents):
    some = [(d.doc_id, d.text) for d in documents[:150]] + [(1, "the the"), (1, "the the"), (None, None)]
    frame = spark.createDataFrame(some, "doc_id long, text string")
    model, counts = brown.fit(frame.select("text"))
    table = {bytes(r.word): r.n for r in counts.collect()}
    of = brown.Classes(model.classes, brown.CLASSES).__getitem__
    got = brown.score(frame, model, counts).collect()
    assert len(got) == len(some)
    want = []
    for i, text in some:
        words, before, total = brown.tokens_of(text or ""), brown.CLASSES, 0.0
        for w in words:
            total += model.moves[before, of(w)] + model.emission(table.get(w, 0), of(w))
            before = of(w)
        want.append((i if i is not None else -1, round(total, 6)))
    assert sorted((r.doc_id if r.doc_id is not None else -1, round(r.score, 6)) for r in got) == sorted(want)
    # probabilities of a class's words and of all classes after a class sum to one
    assert np.allclose((10 ** model.moves).sum(axis=1), 1)
    k = of(b"the")
    mass = sum(10 ** model.emission(n, k) for w, n in table.items() if of(w) == k) + 10 ** model.emission(0, k)
    assert mass == pytest.approx(1)


def test_frequent_words_are_few_and_the_largest(spark):
    frame = spark.createDataFrame([(f"w{i}".encode(), 1 + i // 3) for i in range(300)], "word binary, n long")
    got = brown.frequent_words(frame, 50)
    assert 30 <= len(got) <= 50 and min(n for _, n in got) > 80
    assert brown.frequent_words(frame.limit(0), 50) == []


def test_empty_training_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    model, counts = brown.fit(frame.select("text"))
    other = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    row = brown.score(other, model, counts).first()
    assert (row.n_tokens, row.n_known) == (3, 0) and math.isfinite(row.score)
    assert brown.score(frame, model, counts).count() == 0


def test_classes_do_not_change_when_rows_are_repeated(spark):
    """Words are clustered by their share alone, so twice the input gives the same classes."""
    texts = ["red fox runs home", "blue fox runs home", "red cat sits there", "blue cat sits there", "a b c d e f"]
    once, thrice = (brown.fit(spark.createDataFrame([(t,) for t in texts * n], "text string"))[0].classes for n in (1, 3))
    assert once == thrice


def test_a_word_takes_the_class_that_raises_the_likelihood_most():
    """Against the likelihood itself, with counts small, large, equal and absent."""
    rng = np.random.default_rng(8)
    onto = rng.poisson(6, (5, 5)).astype(float) * (rng.random((5, 5)) < 0.8)
    after, before = (rng.poisson(2.5, (60, 5)) * (rng.random((60, 5)) < 0.6) for _ in range(2))
    got = brown.best_classes(after, before, onto)
    for a, b, k in zip(after, before, got):
        values = []
        for new in range(5):
            moved = onto.copy()
            moved[new] += a
            moved[:, new] += b
            # other words' part of the sums is the same for every class
            values.append(brown.likelihood(moved))
        assert values[k] == pytest.approx(max(values), abs=1e-9)


def test_every_training_word_gets_a_class_by_its_neighbours(spark, monkeypatch):
    """Words below the share, also those that no table that travels holds, and the scores that follow."""
    rng = np.random.default_rng(9)
    kinds = [[f"{c}{i}" for i in range(6)] for c in "nva"]
    seldom = [[f"{c}rare{i}" for i in range(150)] for c in "nva"]
    texts = []
    for start in rng.integers(0, 3, 400):
        words = [str(rng.choice(kinds[(start + k) % 3])) for k in range(30)]
        for k in rng.choice(30, 3, replace=False):
            words[k] = str(rng.choice(seldom[(start + k) % 3]))
        texts.append(" ".join(words))
    texts += ["lone", "x" * 100 + " n1", None, "lone lone unheard"]
    frame = spark.createDataFrame([(i, t, i % 9 != 8) for i, t in enumerate(texts)], "doc_id long, text string, train boolean")
    monkeypatch.setattr(brown, "SHARE", 100)
    monkeypatch.setattr(brown, "FREQUENT", 40)
    model, counts = brown.fit(frame.filter("train").select("text"))
    table = {bytes(r.word): (r.n, r.k) for r in counts.collect()}
    want = Counter(w for i, t in enumerate(texts) if i % 9 != 8 for w in brown.tokens_of(t or ""))
    assert {w: n for w, (n, _) in table.items()} == want and len(table) == counts.count()
    assert len(model.classes) < len(table)
    assert all(k < brown.CLASSES for w, (_, k) in table.items() if w != brown.END)
    # seldom words share classes with the words in whose place they stand
    of_kind = [{table[w.encode()][1] for w in group} for group in kinds]
    right = [table[w.encode()][1] in of_kind[g] for g, group in enumerate(seldom) for w in group if w.encode() in table]
    assert np.mean(right) > 0.9

    def of(word):
        return table[word][1] if word in table else brown.CLASSES + 1 + brown.ending(word)

    moves = np.zeros((brown.SIZE, brown.SIZE))
    rows = {i: [of(w) for w in brown.tokens_of(t or "")] for i, t in enumerate(texts)}
    for i, ks in rows.items():
        if i % 9 != 8:
            np.add.at(moves, ([brown.CLASSES, *ks[:-1]], ks), 1)
    assert np.allclose(brown.Model.learn(model, moves).moves, model.moves)
    both, scores = brown.fit_and_score(frame, "train")
    assert np.allclose(both.moves, model.moves)
    for got in (scores, brown.score(frame, model, counts)):
        found = {r.doc_id: r for r in got.collect()}
        assert len(found) == len(texts)
        for i, t in enumerate(texts):
            words, ks = brown.tokens_of(t or ""), rows[i]
            score = sum(model.moves[a, b] + model.emission(table.get(w, (0, 0))[0], b) for w, a, b in zip(words, [brown.CLASSES, *ks], ks))
            base = sum(model.base(table.get(w, (0, 0))[0]) for w in words)
            row = found[i]
            assert (row.n_tokens, row.n_known) == (len(words), sum(w in table for w in words))
            assert (row.score, row.base_score) == (pytest.approx(score), pytest.approx(base))


def test_the_class_of_an_ending_in_sql(spark):
    words = [b"", b"a", b"ab", b"abc", b"abcdef", b"abcdefg", bytes(range(128, 140)), "gr\u00fc\u00dfe".encode(), b"\x00", b"a\x00"]
    frame = spark.createDataFrame([(w,) for w in words], "word binary")
    got = {bytes(r.word): r.k for r in frame.select("word", brown._ending_class("word").alias("k")).collect()}
    assert got == {w: brown.CLASSES + 1 + brown.ending(w) for w in words}
