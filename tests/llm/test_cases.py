"""Cases that every text operator defines: empty tables, repeats, very long texts, clashing columns, switches."""

import math

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from panelloom.llm import bpe, brown, decontam, langid, licenses, lines, merkle, omh, queries, repair
from panelloom.llm.common import py_id_remainder, vocabulary

SMALL, SF = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(100_000)) + "\n" + "The same long line of words again and again. " * 3


@pytest.fixture(scope="module")
def long_frame(spark):
    return spark.createDataFrame([(1, LONG), (2, "a short text"), (3, None)], "doc_id long, text string").cache()


def rows_by_id(frame):
    return {r.doc_id: r for r in frame.collect()}


def test_very_long_texts_and_tokens(spark, long_frame):
    tokenizer = Tokenizer.from_file(vocabulary(bpe.VOCABULARY))
    tokenizer.no_truncation()
    row = rows_by_id(bpe.encode_decode(long_frame))[1]
    assert row.ids == tokenizer.encode(LONG, add_special_tokens=False).ids and row.decoded == LONG
    words = Tokenizer.from_file(vocabulary(repair.VOCABULARY))
    words.no_truncation()
    assert rows_by_id(repair.write_and_read(long_frame))[1].n_tokens == len(words.encode(LONG, add_special_tokens=False).ids) + 1
    assert bpe.encode(long_frame.limit(0)).count() == 0 and bpe.encode_decode(long_frame.limit(0)).count() == 0
    twice = bpe.encode(long_frame.filter("doc_id = 2").unionAll(long_frame.filter("doc_id = 2"))).collect()
    assert len(twice) == 2 and twice[0] == twice[1]


def test_very_long_texts_in_models_and_scans(spark, long_frame):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = langid.fit(docs)
    got = rows_by_id(langid.predict(long_frame, model))
    assert got[1].lang_pred in model.languages and 0 < got[1].score <= 1 and got[3].lang_pred == "und"
    lm, counts = brown.fit(long_frame.select("text"))
    scored = rows_by_id(brown.score(long_frame, lm, counts))
    assert scored[1].n_tokens == len(brown.tokens_of(LONG)) == scored[1].n_known and math.isfinite(scored[1].score)
    kept = rows_by_id(lines.dedup_lines(long_frame))
    assert kept[1].text == LONG and kept[1].n_lines == 2
    notice = licenses.TEMPLATES[0][1]
    scans = spark.createDataFrame([(1, f"{LONG} {notice}"), (2, notice), (2, notice)], "doc_id long, text string")
    found = licenses.scan(scans).collect()
    assert {r.doc_id for r in found} == {1, 2}
    item = " ".join(LONG.split()[150_000:150_020])
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    hit = rows_by_id(decontam.phrase_hits(long_frame, bench))
    assert hit[1].n_hit >= 20 and hit[1]["items"] == ["7"] and hit[1].near == 1 and hit[2].n_hit == 0


def test_columns_named_like_results(spark):
    text = "one two three four five six seven eight nine ten eleven twelve thirteen"
    names = ["n_tokens", "word", "n", "rare", "start", "containment", "license", "class_id", "class_rows", "fingerprint", "near_next",
             "i", "t", "__found", "__near", "__hits", "near", "k", "lang_pred", "score", "certainty", "ids", "bucket", "row", "marks", "__h", "__drops", "__lines", "__c0__"]
    frame = spark.createDataFrame([(i, text, *["x"] * len(names)) for i in range(3)],
                                  "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    bench = spark.createDataFrame([(1, text, "y")], "item_id long, text string, i string")
    lm, counts = brown.fit(frame.select("text"))
    assert [r.n_tokens for r in brown.score(frame, lm, counts).collect()] == [14] * 3
    assert licenses.scan(frame).count() == 0
    assert {(r.class_id, r.class_rows) for r in omh.near_duplicates(frame).collect()} == {(0, 3)}
    assert {(r.n_chars, r.near_next) for r in merkle.compare_with_next(frame).collect()} == {(len(text), 1.0)}
    hits = decontam.phrase_hits(frame, bench).collect()
    assert {(r.n_hit, r.near, r["i"], r["__found"]) for r in hits} == {(13, 1, "x", "x")}
    assert {(r.text, r["__h"], r["__c0__"]) for r in lines.dedup_lines(frame).collect()} == {(text, "x", "x"), ("", "x", "x")}
    assert bpe.encode(frame).count() == repair.write_and_read(frame).count() == 3


def test_code_switched_texts_stay_in_the_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {}
    for r in docs.filter("length(text) between 400 and 2000").orderBy("doc_id").collect():
        texts.setdefault(r.lang, r.text)
    assert len(texts) == 4
    parts = [t[:400] for t in texts.values()]
    mixed = [(10_001, " ".join(parts)), (10_002, "\n".join(parts[:3]))]  # no language has 40 % of the words
    more = spark.createDataFrame([(i, t, None, "s", len(t)) for i, t in mixed], docs.schema)
    out = corpus_pipeline.language(spark, docs.unionAll(more), SF).filter("doc_id > 10000").collect()
    assert {r.doc_id: r.text for r in out} == dict(mixed)


def slow_marginals(scores, moves):
    """Forward-backward over one chain, step by step."""
    local, step = np.exp(scores - scores.max(axis=1, keepdims=True)), np.exp(moves)
    n, k = local.shape
    forward, backward = np.zeros((n, k)), np.ones((n, k))
    for t in range(n):
        forward[t] = local[t] * ([1.0] * k if t == 0 else [sum(forward[t - 1, a] * step[a, b] for a in range(k)) for b in range(k)])
        forward[t] /= forward[t].sum()
    for t in range(n - 2, -1, -1):
        backward[t] = [sum(step[a, b] * local[t + 1, b] * backward[t + 1, b] for b in range(k)) for a in range(k)]
        backward[t] /= backward[t].sum()
    out = forward * backward
    return out / out.sum(axis=1, keepdims=True)


def test_language_query_by_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = rows_by_id(queries.op2_language(spark, SMALL))
    model = langid.fit(docs.filter(~langid.held_out()))
    assert rows.keys() == texts.keys()
    for i, text in texts.items():
        words = langid.FIND((text or "").lower())
        assert rows[i].held_out == (py_id_remainder(i, 4) == 2)
        if not words:
            assert (rows[i].lang_pred, rows[i].score) == ("und", 0.0)
            continue
        mean = slow_marginals(model.emissions(words).astype(float), model.moves).mean(axis=0)
        assert rows[i].lang_pred == model.languages[int(mean.argmax())] and rows[i].score == pytest.approx(mean.max(), rel=1e-4)


def test_near_copies_are_those_of_the_stated_similarity(spark):
    """A copy with a few changed words is caught up to the bound and not beyond: a word costs five shingles."""
    rng = np.random.default_rng(31)
    rows, want = [], {}
    for g in range(40):
        base = [f"g{g}w{x}" for x in rng.integers(0, 10_000, 150)]
        changed = int(rng.integers(1, 8))
        copy = list(base)
        for at in rng.choice(150, changed, replace=False):
            copy[at] = f"new{g}x{at}"
        rows += [(2 * g, " ".join(base)), (2 * g + 1, " ".join(copy))]
        want[g] = omh.aligned(omh.shingles(base), omh.shingles(copy)) > 0
    got = rows_by_id(omh.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")))
    assert {g: got[2 * g + 1].class_id == 2 * g for g in want} == want and 5 < sum(want.values()) < 35
