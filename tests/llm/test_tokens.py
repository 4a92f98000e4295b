"""Encoding, decoding and token files against the public library."""

import hashlib
import json
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from panelloom.llm import bpe, queries, repair
from panelloom.llm.common import vocabulary

SF = "/root/testdata/sf0.001"
HARD = [
    "", None, " ", "\n\n  x \n", "don't I'LL we'll", "a\x1cb\x1d \x85c d᠎ e​ f", "<|endoftext|>a<|endoftext|>",
    "12³½Ⅷ①", "é é İ Σς", "\U0001F600一" * 50, "ab" * 700, "!!'s ''s", "<|startoftext|> x",
    "՘Ᲊ꟏ x", "tab\tand\rreturn", "$%&" * 300,
]


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def library(path):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def hard_frame(spark):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(HARD)], "doc_id long, text string, ids string")


def test_encoding_equals_the_library(spark, documents):
    tokenizer = library(vocabulary(bpe.VOCABULARY))
    for row in queries.op1_bpe(spark, SF).collect():
        ids = tokenizer.encode(documents[row.doc_id] or "", add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        text = tokenizer.decode(ids, skip_special_tokens=False)
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_hard_texts_and_round_trip(spark):
    tokenizer = library(vocabulary(bpe.VOCABULARY))
    rows = {r.doc_id: r for r in bpe.encode_decode(hard_frame(spark)).collect()}
    assert len(rows) == len(HARD)
    for i, text in enumerate(HARD):
        assert rows[i].ids == tokenizer.encode(text or "", add_special_tokens=False).ids, repr(text)
        assert rows[i].decoded == (text or "")


def test_long_words_take_the_same_merges():
    model = bpe.ByteBpe(open(vocabulary(bpe.VOCABULARY), "rb").read())
    rng = np.random.default_rng(1)
    for n in (2, 17, 255, 300, 900):
        parts = [model.byte_ids[b] for b in rng.integers(97, 103, n)]
        assert model.merges._scan(list(parts)) == model.merges._heap(list(parts))


def test_decode_of_given_ids(spark):
    frame = spark.createDataFrame([(1, [15496, 995]), (2, None), (3, [50256, 99999]), (4, [])], "doc_id long, ids array<int>")
    got = {r.doc_id: r.decoded for r in bpe.decode(frame).collect()}
    assert got == {1: "Hello world", 2: "", 3: "<|endoftext|>", 4: ""}


def test_token_files_equal_the_library(spark, documents):
    tokenizer = library(vocabulary(repair.VOCABULARY))
    rows = {r.doc_id: r for r in queries.op7_token_files(spark, SF).collect()}
    start = 0
    for doc_id in sorted(documents):
        ids = [*tokenizer.encode(documents[doc_id] or "", add_special_tokens=False).ids, 1]
        row = rows[doc_id]
        assert (row.start, row.n_tokens) == (start, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert len(rows) == len(documents)


def test_hard_texts_in_files(spark):
    tokenizer = library(vocabulary(repair.VOCABULARY))
    rows = {r.doc_id: r for r in repair.write_and_read(hard_frame(spark)).collect()}
    for i, text in enumerate(HARD):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        assert rows[i].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes()), repr(text)


def test_repeated_rows_and_null_identifiers_in_files(spark):
    frame = spark.createDataFrame([(3, "one two"), (3, "one two"), (None, "three"), (1, None)], "doc_id long, text string")
    rows = repair.write_and_read(frame).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.start, r.n_tokens) for r in rows) == [
        (-1, 0, 2), (1, 2, 1), (3, 3, 3), (3, 6, 3)]
    empty = repair.write_and_read(frame.limit(0))
    assert empty.count() == 0


def a_shard(docs):
    counts = [len(d) for d in docs]
    rules, symbols = repair.compress(np.concatenate(docs), np.array(counts))
    lengths = repair.expansion_lengths(rules)
    blocks, sizes = repair.blocks_of(symbols, lengths)
    return rules, symbols, {"rules": rules.tobytes(), "lengths": lengths.tobytes(), "blocks": blocks, "block_ids": sizes, "counts": counts}


def test_grammar_round_trip_and_random_access(monkeypatch):
    rng = np.random.default_rng(3)
    docs = [rng.choice([7, 8, 9, 7], n).astype(np.uint32) for n in (1, 2, 3000, 5, 1, 40_000)]
    docs.append(np.full(999, 5, np.uint32))
    docs += [rng.integers(0, 40_000, 60_000).astype(np.uint32)]
    rules, symbols, shard = a_shard(docs)
    assert len(rules) and len(symbols) < sum(shard["counts"]) and len(shard["blocks"]) > 10
    for at, ids in enumerate(docs):
        assert (repair.decode_document(shard, at) == ids).all()
    for r, length in enumerate(np.frombuffer(shard["lengths"], "<u4").tolist()):
        assert len(repair.expand(rules, np.array([repair.FIRST + r], "<u4"))) == length
    whole = np.concatenate(docs)
    for start in rng.integers(0, len(whole), 60).tolist():
        stop = start + int(rng.integers(0, 9000))
        assert (repair.decode_range(shard, start, stop) == whole[start:stop]).all()
    opened = []
    plain = repair.opened
    monkeypatch.setattr(repair, "opened", lambda block: opened.append(block) or plain(block))
    repair.decode_range(shard, len(whole) - 50, len(whole) - 20)
    assert len(opened) == 1  # a short range at the end opens the last block alone


def test_no_frequent_pair_is_left_inside_a_document():
    rng = np.random.default_rng(4)
    docs = [rng.choice(12, int(n), p=np.arange(12, 0, -1) / 78).astype(np.uint32) for n in rng.integers(1, 400, 200)]
    rules, symbols, shard = a_shard(docs)
    ends = set(np.cumsum(shard["counts"]).tolist())
    left, at = {}, 0
    for a, b, wide in zip(symbols.tolist(), symbols.tolist()[1:], repair.widths(symbols, np.frombuffer(shard["lengths"], "<u4")).tolist()):
        at += wide
        if at not in ends:
            left[a, b] = left.get((a, b), 0) + 1
    assert len(rules) > 50 and max(left.values()) < repair.FREQUENT


def test_frequent_pairs_beside_rare_ones_are_found_late():
    """Places that were closed as too rare open again next to a new symbol; runs of one id nest deeply."""
    rng = np.random.default_rng(5)
    phrase = rng.integers(0, 40_000, 300).astype(np.uint32)
    docs = [np.concatenate([rng.integers(0, 40_000, int(n)).astype(np.uint32), phrase]) for n in rng.integers(0, 900, 200)]
    docs += [np.full(1 << 15, 3, np.uint32), np.zeros(1, np.uint32)]
    rules, symbols, shard = a_shard(docs)
    assert (repair.expand(rules, symbols) == np.concatenate(docs)).all()
    lengths = np.frombuffer(shard["lengths"], "<u4")
    assert lengths.max() >= 300 and len(symbols) < sum(shard["counts"]) - 200 * 290
    assert len(repair.expand(rules, symbols[:0])) == 0


def test_reading_does_not_move_the_shards(spark, tmp_path):
    """The offsets are sent to the shards; no exchange carries their blocks, whatever the planner knows of sizes."""
    frame = spark.createDataFrame([(i, f"text {i}") for i in range(40)], "doc_id long, text string")
    path = repair.write_shards(frame, str(tmp_path / "shards"), shard_ids=16)
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = repair.read_shards(spark, path)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert rows.count() == 40
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert "BroadcastHashJoin" in joins[0]  # the outermost, of shards and offsets


def test_vocabularies_are_not_in_the_repository():
    assert json.loads(open(vocabulary(bpe.VOCABULARY)).read())["model"]["type"] == "BPE"
    assert not vocabulary(bpe.VOCABULARY).startswith("/root/repo")
