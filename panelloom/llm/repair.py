"""Token ids in binary files, compressed by a grammar of frequent pairs (Re-Pair).

Texts are encoded with a published tokenizer file, an end id is added to each, and the ids are
written in ascending order of the identifier. A shard is a run of documents of about
``SHARD_IDS`` ids (a longer document is a shard of its own). Per shard, neighbouring ids that occur
together ``FREQUENT`` times or more are replaced by nonterminals, round after round, all such pairs of
a round at once, never across the end of a document, until no pair is left that occurs so often;
rules and the length of each rule's expansion are stored with the shard.

File format: Parquet, one row per shard, so any store that Spark reaches will do and a lost
task's part is never seen: ``bucket`` and ``shard`` (order), ``n_ids``, ``doc_ids``, ``counts``
(ids per document), ``rules`` (little-endian 32-bit pairs; rule r makes symbol FIRST + r),
``lengths`` (32-bit expansion lengths of the rules), ``blocks`` (``BLOCK`` 32-bit symbols each; the
file's own codec packs them) and ``block_ids`` (ids that each block expands to). A range of ids is found by these
lengths: the blocks that hold it are opened, the symbols that reach into it expanded.

Texts of Latin characters are split into words by the tokenizer's own pattern, and each distinct
word is encoded once by the library's model; other texts, and those that hold a special token, go
through the library whole.

Cases: a null text counts as empty and has the end id alone; ties in the identifier are ordered
by a hash of the text; a null identifier comes first. No rows: no shards, empty results.
"""

import os
import re
import zlib
from array import array
from codecs import charmap_decode

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from panelloom.llm.bpe import byte_alphabet
from panelloom.llm.common import bucket_count, map_batches, ordered_buckets, slices, vocabulary
from panelloom.session import scratch_path

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
SHARD_IDS = 1 << 20
FIRST = 1 << 17  # symbols from here on are nonterminals
FREQUENT = 64
BLOCK = 1 << 12
TABLE_BITS = 18
TABLE = 1 << TABLE_BITS

# letters among the characters below U+0250 and what they become in lower case, by Python's own classes
_LETTER = re.compile(r"[^\W\d_²³¹¼½¾]").match
LETTERS = "".join(sorted({x for c in map(chr, range(0x250)) for x in (c, *c.lower()) if _LETTER(x)}))
ASCII_WORDS = re.compile(r"[a-z]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\sa-z0-9]+", re.A).findall
LATIN_WORDS = re.compile(rf"[{LETTERS}]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\s{LETTERS}0-9²³¹¼½¾]+|[²³¹¼½¾]").findall
# texts that go through the library whole: those with a character from U+0250 on, with one of the
# separators that Python alone takes for spaces, or with the start of a special token
HIGH = re.compile("[^\0-\u024f]").search
APART = ("<|", "\x1c", "\x1d", "\x1e", "\x1f")


def _plain(text):
    """Whether a text can be cut at white space and encoded piece by piece."""
    if any(x in text for x in APART):
        return False
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return not HIGH(text)
    return True


class Pieces(dict):
    """Lower-case text between white space to packed 16-bit ids; no match of the word pattern spans it.

    Words and short pieces are kept in two generations of ``limit`` each, so that frequent ones
    stay when the younger one is full. A word's ids come from the library's model, which takes its bytes as the
    printable characters that stand for them.
    """

    def __init__(self, model, limit=300_000):
        self.tokens, self.limit, self.older = model.tokenize, limit, {}
        self.printable = "".join(byte_alphabet())

    def _word(self, word):
        plain = word if word.isascii() else charmap_decode(word.encode("utf-8", "replace"), "strict", self.printable)[0]
        return array("H", [t.id for t in self.tokens(plain)]).tobytes()

    def __missing__(self, piece):
        got = self.older.get(piece)
        if got is None:
            if piece.isalpha():
                got = self._word(piece)
            elif piece[-1] in ".,;:!?" and piece[:-1].isalpha():  # a word and one mark behind it
                word = piece[:-1]
                got = (self.get(word) or self.older.get(word) or self._word(word)) + self._mark(piece[-1])
            else:
                words = (ASCII_WORDS if piece.isascii() else LATIN_WORDS)(piece)
                got = b"".join(self[w] if w.isalpha() else self._word(w) for w in words)
        if len(piece) <= 32:
            self[piece] = got
        return got

    def _mark(self, mark):
        got = self.get(mark)
        if got is None:
            got = self[mark] = self._word(mark)
        return got

    def settle(self):
        if len(self) > self.limit:
            self.older = dict(self)
            self.clear()


class Encoder:
    """Text to ids, piece by piece where the text can be cut, else by the library whole."""

    def __init__(self, content):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(content.decode())
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.pieces = Pieces(self.tokenizer.model)

    def _library(self, text):
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()

    def encode(self, texts):
        """Packed 16-bit ids of each text."""
        self.pieces.settle()
        get = self.pieces.__getitem__
        return [b"".join(map(get, t.lower().split())) if _plain(t) else self._library(t) for t in texts]


# ---- the grammar ------------------------------------------------------------------------------


def compress(ids, counts):
    """(rules, symbols) of the ids of a shard's documents, of which there are ``counts``.

    A place whose pair was too rare stays closed until a new symbol is next to it: replacing other pairs
    adds none of its kind.
    """
    s = ids.astype(np.uint32)
    last = np.zeros(len(s), bool)
    last[np.cumsum(counts) - 1] = True
    open_ = ~last  # no pair goes across the end of a document
    rules, made = [np.zeros((0, 2), np.uint32)], 0
    standing, numbers = np.zeros(TABLE, np.uint64), np.zeros(TABLE, np.uint32)
    while True:
        at = np.flatnonzero(open_)
        a, b = s[at], s[at + 1]
        slot = ((a * np.uint32(0x9E3779B1) ^ b * np.uint32(0x85EBCA77)) >> np.uint32(32 - TABLE_BITS)).astype(np.intp)
        heavy = (np.bincount(slot, minlength=TABLE) >= FREQUENT)[slot]
        open_[at[~heavy]] = False
        at, slot, both = at[heavy], slot[heavy], a[heavy].astype(np.uint64) << np.uint64(32) | b[heavy]
        # one pair stands for its slot; what it hides is seen once that pair is gone
        standing[slot] = both
        own = np.flatnonzero(standing[slot] == both)
        frequent = np.bincount(slot[own], minlength=TABLE) >= FREQUENT
        if frequent.any():
            chosen = np.flatnonzero(frequent)
            pairs, numbers[chosen] = standing[chosen], np.arange(len(chosen))
            own = own[frequent[slot[own]]]
            at, place = at[own], numbers[slot[own]]
        else:  # a frequent pair may still be hidden by rare ones
            pairs, back, n = np.unique(both, return_inverse=True, return_counts=True)
            number = np.cumsum(n >= FREQUENT) - 1
            at, place, pairs = at[(n >= FREQUENT)[back]], number[back][(n >= FREQUENT)[back]], pairs[n >= FREQUENT]
            if not len(pairs):
                break
        # of overlapping hits every second one, from the left
        apart = np.diff(at) > 1
        if not apart.all():
            number = np.arange(len(at))
            first = np.maximum.accumulate(np.where(np.concatenate([[True], apart]), number, 0))
            even = (number - first) % 2 == 0
            at, place = at[even], place[even]
        s[at] = FIRST + made + place
        last[at] = last[at + 1]
        open_[at], open_[at[at > 0] - 1] = True, True
        stay = np.ones(len(s), bool)
        stay[at + 1] = False
        s, last, open_ = s[stay], last[stay], open_[stay]
        open_ &= ~last
        rules.append(np.column_stack([pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)]).astype(np.uint32))
        made += len(pairs)
    return np.concatenate(rules).astype("<u4"), s.astype("<u4")


def expanded_rules(rules, lengths):
    """(ids of all rules one after the other, where each begins)."""
    flat = rules.ravel()
    while True:  # one level of all rules in a pass
        made = flat >= FIRST
        if not made.any():
            return flat, np.cumsum(lengths, dtype=np.int64) - lengths
        wide = 1 + made
        at, pairs = (np.cumsum(wide) - wide)[made], rules[flat[made] - FIRST]
        flat = np.repeat(flat, wide)
        flat[at], flat[at + 1] = pairs[:, 0], pairs[:, 1]


def expand(rules, symbols, lengths=None):
    """Ids of symbols."""
    lengths = expansion_lengths(rules) if lengths is None else lengths
    wide = widths(symbols, lengths)
    flat, starts = expanded_rules(rules, lengths)
    # every id is read from its rule's expansion or, behind all of them, from the symbol itself
    source = np.arange(len(flat), len(flat) + len(symbols))
    made = symbols >= FIRST
    source[made] = starts[symbols[made] - FIRST]
    ends = np.cumsum(wide)
    at = np.repeat(source - ends + wide, wide) + np.arange(ends[-1] if len(ends) else 0)
    return np.concatenate([flat, symbols])[at].astype("<u4", copy=False)


def expansion_lengths(rules):
    lengths = [1] * len(rules)
    for r, (a, b) in enumerate(rules.tolist()):
        lengths[r] = (lengths[a - FIRST] if a >= FIRST else 1) + (lengths[b - FIRST] if b >= FIRST else 1)
    return np.array(lengths, "<u4")


def widths(symbols, lengths):
    """Ids that each symbol expands to."""
    out = np.ones(len(symbols), np.int64)
    made = symbols >= FIRST
    out[made] = lengths[symbols[made] - FIRST]
    return out


def blocks_of(symbols, lengths):
    """(blocks, ids of each block)."""
    at = range(0, len(symbols), BLOCK)
    wide = widths(symbols, lengths)
    return ([symbols[k:k + BLOCK].tobytes() for k in at],
            np.add.reduceat(wide, list(at)).tolist() if len(symbols) else [])


def opened(block):
    return np.frombuffer(block, "<u4")


def decode_range(shard, start, stop):
    """Ids from ``start`` to before ``stop`` of a shard row (a mapping); other blocks stay closed."""
    ends = np.cumsum(shard["block_ids"])
    stop = min(stop, int(ends[-1]) if len(ends) else 0)
    if start >= stop:
        return np.zeros(0, "<u4")
    first, final = np.searchsorted(ends, [start, stop - 1], side="right").tolist()
    symbols = np.concatenate([opened(b) for b in shard["blocks"][first:final + 1]])
    rules, lengths = np.frombuffer(shard["rules"], "<u4").reshape(-1, 2), np.frombuffer(shard["lengths"], "<u4")
    before = int(ends[first]) - shard["block_ids"][first]  # ids of the closed blocks in front
    reach = np.cumsum(widths(symbols, lengths)) + before
    low, high = np.searchsorted(reach, [start, stop - 1], side="right").tolist()
    begin = int(reach[low - 1]) if low else before
    return expand(rules, symbols[low:high + 1])[start - begin:stop - begin]


def decode_document(shard, number):
    """Ids of one document of a shard row."""
    start = sum(shard["counts"][:number])
    return decode_range(shard, start, start + shard["counts"][number])


# ---- files ------------------------------------------------------------------------------------

_ENCODERS = {}


def _encoder(content):
    key = (len(content), zlib.crc32(content))
    if key not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(content)
    return _ENCODERS[key]


def _packed(batches, content):
    encoder = _encoder(content)
    for batch in slices(batches):
        texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(encoder.encode(texts), pa.binary())], [*batch.schema.names[:-1], "ids"])


SHARD = ("bucket int, shard int, n_ids long, doc_ids array<{kind}>, counts array<long>, "
         "rules binary, lengths binary, blocks array<binary>, block_ids array<long>")


def _shards(batches, end_id, shard_ids):
    _ENCODERS.clear()  # a worker that has encoded needs the room of its pieces now
    bucket, number, ids, docs, size, kind = None, 0, [], [], 0, pa.int64()

    def row():
        flat = np.concatenate(ids)
        counts = np.array([len(x) for x in ids])
        rules, symbols = compress(flat, counts)
        lengths = expansion_lengths(rules)
        blocks, sizes = blocks_of(symbols, lengths)
        return pa.RecordBatch.from_arrays(
            [pa.array([bucket], pa.int32()), pa.array([number], pa.int32()), pa.array([len(flat)], pa.int64()),
             pa.array([docs], pa.list_(kind)), pa.array([counts.tolist()], pa.list_(pa.int64())),
             pa.array([rules.tobytes()], pa.binary()), pa.array([lengths.tobytes()], pa.binary()),
             pa.array([blocks], pa.list_(pa.binary())), pa.array([sizes], pa.list_(pa.int64()))],
            ["bucket", "shard", "n_ids", "doc_ids", "counts", "rules", "lengths", "blocks", "block_ids"])

    end = np.array([end_id], np.uint32)
    for batch in batches:
        kind = batch.schema.field(1).type
        for b, i, packed in zip(*[c.to_pylist() for c in batch.columns]):
            own = np.concatenate([np.frombuffer(packed, "<u2").astype(np.uint32), end])
            if ids and (b != bucket or size + len(own) > shard_ids):
                yield row()
                number = number + 1 if b == bucket else 0
                ids, docs, size = [], [], 0
            elif b != bucket:
                number = 0
            bucket = b
            ids.append(own)
            docs.append(i)
            size += len(own)
    if ids:
        yield row()


def write_shards(df, path, doc_id="doc_id", text="text", tokenizer=None, end_id=END_ID, shard_ids=SHARD_IDS):
    """Encode, order and compress all texts of ``df`` into the Parquet folder ``path``."""
    spark = df.sparkSession
    with open(tokenizer or vocabulary(VOCABULARY), "rb") as file:
        content = spark.sparkContext.broadcast(file.read())
    kind = df.schema[doc_id].dataType.simpleString()
    count = bucket_count(spark)
    dealt = ordered_buckets(df.select(F.col(doc_id).alias("i"), F.col(text).alias("t")), "i", count)
    packed = map_batches(
        dealt.select("__bucket", "__k", F.xxhash64("t").alias("h"), "i", "t"), lambda it: _packed(it, content.value),
        f"b int, k long, h long, i {kind}, ids binary")
    ordered = packed.repartition(max(1, count // 2), "b").sortWithinPartitions("b", "k", "h").select("b", "i", "ids")
    map_batches(ordered, lambda it: _shards(it, end_id, shard_ids), SHARD.format(kind=kind)).write.parquet(path)
    return path


def _read(batches):
    for batch in batches:
        names = batch.schema.names
        kind = batch.schema.field(names.index("doc_ids")).type.value_type
        for at in range(batch.num_rows):
            row = {n: batch.column(c)[at].as_py() for c, n in enumerate(names)}
            rules = np.frombuffer(row["rules"], "<u4").reshape(-1, 2)
            ids = expand(rules, np.concatenate([opened(b) for b in row["blocks"]]))
            ends = np.cumsum(np.array(row["counts"], np.int64))
            starts = ends - row["counts"]
            data = memoryview(ids.tobytes())
            crcs = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
            n = len(crcs)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], kind), pa.array(starts + row["before"]),
                 pa.array(row["counts"], pa.int64()), pa.array(crcs, pa.int64()),
                 pa.array([row["bucket"]] * n, pa.int32()), pa.array([row["shard"]] * n, pa.int32())],
                ["doc_id", "start", "n_tokens", "ids_crc32", "bucket", "shard"])


def read_shards(spark, path):
    """One row per document: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``, ``bucket``, ``shard``.

    A shard begins after the ids of the buckets and shards before it. Sizes per bucket are few,
    as many as ranges; inside a bucket the shards are numbered in order.
    """
    shards = spark.read.parquet(path)
    sizes = shards.groupBy("bucket").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = sizes.select("bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__buckets"))
    inside = Window.partitionBy("bucket").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # offsets from the narrow columns alone, three numbers a shard; as their size is not known to the planner
    # it is told to send them to the shards, which are not moved
    offsets = shards.select("bucket", "shard", "n_ids").withColumn(
        "__shards", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(buckets, "bucket").select(
        "bucket", "shard", (F.col("__buckets") + F.col("__shards")).alias("before"))
    placed = shards.join(F.broadcast(offsets), ["bucket", "shard"]).select(
        "bucket", "shard", "before", "doc_ids", "counts", "rules", "blocks")
    kind = shards.schema["doc_ids"].dataType.elementType.simpleString()
    return map_batches(placed, _read, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long, bucket int, shard int")


def write_and_read(df, doc_id="doc_id", text="text", tokenizer=None):
    """Write ``df`` to a fresh folder of the shared one and read the documents back."""
    path = write_shards(df, scratch_path(df.sparkSession), doc_id, text, tokenizer)
    return read_shards(df.sparkSession, path)
