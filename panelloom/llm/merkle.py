"""Fingerprints of texts as Merkle trees over pieces of a few words, paragraphs and sections.

Paragraphs are lines. A leaf ends after a word with a full stop and after a word whose checksum says
so (one in ``LEAF_WORDS``), words beyond ``LONG_WORD`` characters inside as well, so every text has
leaves of a few words whatever its marks, and an edit moves no ends but its own. A section ends after a
paragraph whose digest says so (one in ``SECTION``). A node's digest is that of its children's
digests; equal roots mean equal texts.

A fingerprint is ``root/section:paragraph.leaf.leaf:paragraph...`` in hexadecimal, the root in
full, the others by their first 32 bits. Likeness is 1 for equal roots, else the share of leaves
that two fingerprints have in common, as multisets, of the larger one. ``differing`` walks down
the branches that differ and names the leaves on either side.

For the next document in descending order of the identifier only neighbours must meet. Texts are
dealt once into ranges of the identifier; the first text of each range also goes to the range
before it, and a task streams through its ranges in order with two texts in hand.

Cases: a null text counts as empty; the empty text has one empty leaf. Ties in the identifier
are ordered by a hash of the text, a null identifier comes last; a single row is its own next.
"""

import hashlib
import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from panelloom.llm.common import bucket_count, map_batches, ordered_buckets, slices

SECTION = 8
LEAF_WORDS = 8
#: characters of a word from which on it is cut as well, and one in how many places
LONG_WORD, LONG_PIECE = 64, 32

def _digest(data):
    return hashlib.blake2b(data, digest_size=16).digest()


class _Ends(dict):
    """Whether a leaf ends after a word; the answers of a bounded number of words are kept."""

    def __missing__(self, word):
        ends = word.endswith(".") or zlib.crc32(word.encode("utf-8", "surrogatepass")) % LEAF_WORDS == 0
        if len(self) < 300_000:
            self[word] = ends
        return ends


_ENDS = _Ends()


def leaves(line):
    """Pieces of a line: (text, whether a space or the line's end follows); joined they give the line."""
    words = line.split(" ")
    out, first = [], 0
    for at, word in enumerate(words):
        if len(word) > LONG_WORD:
            # the end of a piece inside a word depends on the four characters before it
            cuts = [k + 4 for k in range(len(word) - 4)
                    if zlib.crc32(word[k:k + 4].encode("utf-8", "surrogatepass")) % LONG_PIECE == 0]
            if cuts:
                out.append((" ".join([*words[first:at], word[:cuts[0]]]), False))
                out += [(word[a:b], False) for a, b in zip(cuts, cuts[1:])]
                out.append((word[cuts[-1]:], True))
                first = at + 1
                continue
        if _ENDS[word]:
            out.append((" ".join(words[first:at + 1]), True))
            first = at + 1
    if first < len(words):
        out.append((" ".join(words[first:]), True))
    return out


def fingerprint(text):
    """The tree of a text, written out."""
    sections, paragraphs, out = [], [], []
    parts = []
    for line in text.split("\n"):
        marks = [_digest((b"l" if spaced else b"c") + piece.encode("utf-8", "surrogatepass")) for piece, spaced in leaves(line)]
        paragraph = _digest(b"p" + b"".join(marks))
        paragraphs.append(paragraph)
        parts.append(":" + paragraph[:4].hex() + "".join("." + mark[:4].hex() for mark in marks))
        if paragraph[-1] % SECTION == 0:
            sections.append(_digest(b"s" + b"".join(paragraphs)))
            out.append("/" + sections[-1][:4].hex() + "".join(parts))
            paragraphs, parts = [], []
    if paragraphs:
        sections.append(_digest(b"s" + b"".join(paragraphs)))
        out.append("/" + sections[-1][:4].hex() + "".join(parts))
    return _digest(b"r" + b"".join(sections)).hex() + "".join(out)


LEAF = re.compile(r"\.([0-9a-f]{8})").findall


def likeness(a, b):
    """Likeness of two fingerprints, 0 to 1."""
    if a[:32] == b[:32]:
        return 1.0
    x, y = LEAF(a), LEAF(b)
    most = max(len(x), len(y))
    shared = sum((Counter(x) & Counter(y)).values())
    return min(shared / most, 1 - 1e-9)


def _tree(mark):
    root, *sections = mark.split("/")
    return root, [(s[:8], [(p[:8], p[9:].split(".")) for p in s[9:].split(":")]) for s in sections]


def _outer(x, y, same):
    """Numbers of equal items at the front and at the back."""
    front = 0
    while front < min(len(x), len(y)) and same(x[front], y[front]):
        front += 1
    back = 0
    while back < min(len(x), len(y)) - front and same(x[-1 - back], y[-1 - back]):
        back += 1
    return front, back


def differing(a, b):
    """Where two texts differ: ((from, to), (from, to)) paragraph numbers on either side, or None.

    Equal sections are passed over whole; inside the others equal paragraphs are.
    """
    (ra, sa), (rb, sb) = _tree(a), _tree(b)
    if ra == rb:
        return None
    front, back = _outer(sa, sb, lambda p, q: p[0] == q[0])
    before = sum(len(s[1]) for s in sa[:front])
    pa_, pb_ = ([p for s in side[front:len(side) - back] for p in s[1]] for side in (sa, sb))
    f, k = _outer(pa_, pb_, lambda p, q: p[0] == q[0])
    return (before + f, before + len(pa_) - k), (before + f, before + len(pb_) - k)


def fingerprints(df, text="text", keys=("doc_id",)):
    """``keys`` and ``fingerprint`` of every row."""
    frame = df.select(*[f"`{k}`" for k in keys], F.col(text).alias("__text"))
    kinds = "".join(f"`{k}` {df.schema[k].dataType.simpleString()}, " for k in keys)

    def marked(batches):
        for batch in slices(batches):
            marks = [fingerprint(t or "") for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(marks, pa.string())],
                                             [*batch.schema.names[:-1], "fingerprint"])

    return map_batches(frame, marked, kinds + "fingerprint string")


def in_next_order(df, doc_id="doc_id", text="text"):
    """Rows (bucket, copy, id, text) dealt and sorted so that each row's next one follows it."""
    spark = df.sparkSession
    count = bucket_count(spark)
    dealt = ordered_buckets(df.select(F.col(doc_id).alias("i"), F.col(text).alias("t")), "i", count)
    tops = [(r["__bucket"], r["k"]) for r in dealt.groupBy("__bucket").agg(F.max("__k").alias("k")).collect()]
    tops.sort()
    # the first row of a range also ends the range above it; the very first one ends the lowest
    goes = [(k, tops[(at + 1) % len(tops)][0]) for at, (_, k) in enumerate(tops)]
    table = spark.createDataFrame(goes, "top long, above int")
    copies = dealt.join(F.broadcast(table), F.col("__k") == F.col("top"), "left").select(
        "i", "t", "__k", F.explode(F.expr(
            "filter(array(named_struct('b', __bucket, 'copy', 0), named_struct('b', above, 'copy', 1)), x -> x.b is not null)"
        )).alias("x"))
    rows = copies.select(F.col("x.b").alias("b"), F.col("x.copy").alias("copy"), "__k", "i", "t", F.xxhash64("t").alias("h"))
    return rows.repartition(max(1, count // 2), "b").sortWithinPartitions("b", "copy", F.desc("__k"), "h").select("b", "copy", "i", "t")


def edited(text, following):
    """The last half of the text replaced by as many first characters of the next one."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _compared(batches):
    last = None  # bucket, id, text, fingerprint of a row whose next one is still to come
    for batch in slices(batches, rows=256):
        out = [[] for _ in range(8)]
        columns = [c.to_pylist() for c in batch.columns]
        for bucket, copy, i, text in zip(*columns):
            text = text or ""
            if last is not None and last[0] != bucket:
                raise ValueError("a range without the first row of the next one")
            if last is None and copy:
                continue  # a further row with the same first identifier
            mark = fingerprint(text)
            if last is not None:
                _, own_id, own, own_mark = last
                changed = edited(own, text)
                changed_mark = own_mark if changed == own else fingerprint(changed)
                row = (own_id, len(own), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
                       own_mark, changed_mark, likeness(own_mark, changed_mark), likeness(own_mark, mark), i)
                for column, value in zip(out, row):
                    column.append(value)
            last = None if copy else (bucket, i, text, mark)
        kind = batch.schema.field(2).type
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[0], kind), pa.array(out[1], pa.int64()), *[pa.array(c, pa.string()) for c in out[2:5]],
             *[pa.array(c, pa.float64()) for c in out[5:7]], pa.array(out[7], kind)],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "next_id"])


def compare_with_next(df, doc_id="doc_id", text="text"):
    """Fingerprints of every row, of its edited text and their likeness; see ``edited``."""
    kind = df.schema[doc_id].dataType.simpleString()
    if df.isEmpty():
        ordered = df.select(F.lit(0).alias("b"), F.lit(0).alias("copy"), F.col(doc_id).alias("i"), F.col(text).alias("t"))
    else:
        ordered = in_next_order(df, doc_id, text)
    return map_batches(ordered, _compared, (
        f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        f"near_edited double, near_next double, next_id {kind}"))
