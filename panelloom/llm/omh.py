"""Near-duplicate groups by Order MinHash, verified by a banded alignment.

A text is its sequence of 5-word shingles, each labelled with the number of its occurrence. A
sketch keeps, for one hash, the ``K`` shingles of least hash *in text order*, so two texts share
it if they share these shingles in the same order: it follows edit similarity where a plain
MinHash follows sets. ``SKETCHES`` sketches per text are its buckets.

Two texts are near copies if their alignment matches M labelled shingles in order with
M / (n + m - M) at least 0.8. The alignment runs inside the band of diagonals that such a value
allows, hence it is exact: a path outside the band has too many unmatched shingles.

A bucket never yields all its pairs. Its members meet the bucket's leader (the least hash of the
text's key); verified links make groups. Whatever is left in buckets of several groups is settled
exactly by positional prefix filtering: with a text's shingles in one global order, rare ones first,
two texts that match ``M`` shingles have a first common shingle at positions i and j with
min(n - i, m - j) >= M. Every shingle also flips one of a text's parity bits, so the bits of two texts
differ in at most n + m - 2 M places. Pairs that fail either are under 0.8, the others are aligned and
link their groups. The texts that have a shingle in their prefixes are compared by these bits inside
tasks, in pieces of two chunks of at most ``CHUNK`` texts; members of a shingle's largest group do not
meet each other. Of a piece only the texts that may reach 0.8 with another one go on. They meet their
shingles in a second task, which counts the common ones of each pair left, aligns where these suffice and
writes the links that join further groups: rows grow with the texts of a piece, not with its pairs. Equal
texts are one node from the start.

Recall: two texts of similarity J share a sketch with probability about J ** K, 0.26 at 0.8, so
at least one of 24 with 0.999. ``tests/llm`` measures it against all pairs.

Cases: texts with the same words, and non-null texts without words that are equal, are copies; a
null text is in a class of its own. Texts of under five words are one shingle, hence near copies
only as copies; short texts use sketches of fewer shingles. A class's id is its least
identifier. Repeated rows stay, in the same class; a null identifier is the least only if all are.
"""

import bisect
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from panelloom.llm.common import map_batches, slices, staged
from panelloom.llm.components import components

SHINGLE = 5
SIMILARITY = 0.8
SKETCHES = 24
#: shingles in a sketch, for texts of from .. to shingles; the ranges overlap by more than 1 / 0.8
LEVELS = ((1, 1, 12), (3, 9, 40), (6, 32, 1 << 62))
#: 64-bit words of a text's parity bits
PARITY = 8
#: words whose hashes a worker keeps
WORDS_KEPT = 200_000
#: texts of a shingle's prefixes that one piece of work holds on either side
CHUNK = 4096
#: shingles that one piece of work holds on either side where pairs are aligned, or one text
MARKS = 1 << 20
FIND = re.compile(r"[^\W_]+").findall
PRIME = np.uint64(0x9E3779B97F4A7C15)
MULTIPLIERS = np.array([(0xD1342543DE82EF95 * (2 * j + 1) ^ 0x2545F4914F6CDD1D << (j % 7)) % (1 << 64) | 1
                        for j in range(SKETCHES)], np.uint64)


def mixed(x):
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class WordHashes(dict):
    def __missing__(self, word):
        value = xxhash.xxh3_64_intdigest(word.encode("utf-8", "replace"))
        if len(self) < WORDS_KEPT:
            self[word] = value
        return value


_HASHES = WordHashes()


def shingles(words):
    """Hashes of the labelled shingles of a list of words, in order; all differ."""
    if not words:
        return np.zeros(0, np.uint64)
    if len(_HASHES) >= WORDS_KEPT:
        _HASHES.clear()
    w = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    size = min(SHINGLE, len(w))
    n = len(w) - size + 1
    h = np.full(n, size, np.uint64)
    for k in range(size):
        h = h * PRIME + w[k:k + n]
    h = mixed(h)
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    if same.any():
        at = np.arange(n)
        first = np.concatenate([[True], ~same])
        number = at - np.maximum.accumulate(np.where(first, at, 0))
        label = np.empty(n, np.uint64)
        label[order] = number.astype(np.uint64)
        h = np.where(label > 0, mixed(h + label * PRIME), h)
    return h


def sketches(h):
    """Bucket hashes of a text: per level and hash the least shingles in text order."""
    out = []
    for k, least, most in LEVELS:
        if not least <= len(h) <= most:
            continue
        k = min(k, len(h))
        step = max(1, (1 << 21) // len(h))  # hashes at once, to bound the matrix
        for at in range(0, SKETCHES, step):
            v = mixed(h[None, :] * MULTIPLIERS[at:at + step, None])
            if k < len(h):
                chosen = np.sort(np.argpartition(v, k - 1, axis=1)[:, :k], axis=1)
                v = np.take_along_axis(v, chosen, axis=1)
            value = np.full(len(v), k, np.uint64)
            for j in range(v.shape[1]):
                value = value * PRIME + v[:, j]
            out.append(mixed(value + np.arange(at, at + len(v), dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def aligned(a, b, similarity=SIMILARITY):
    """Similarity of two sequences of labelled shingles, exact where it reaches the bound, else 0.

    Labelled shingles are unique, so the best alignment is a longest increasing run of matched
    positions; only those inside the band count.
    """
    n, m = len(a), len(b)
    if not n or not m or min(n, m) < similarity * max(n, m):
        return 0.0
    band = int((n + m) * (1 - similarity) / (1 + similarity)) + 1
    order = np.argsort(b)
    at = np.minimum(np.searchsorted(b, a, sorter=order), m - 1)
    hit = b[order[at]] == a
    i, j = np.flatnonzero(hit), order[at][hit]
    inside = np.abs(i - j) <= band
    j = j[inside]
    least = similarity / (1 + similarity) * (n + m)
    if len(j) < least:
        return 0.0
    if (np.diff(j) > 0).all():
        length = len(j)
    else:
        tails = []
        for x in j.tolist():
            k = bisect.bisect_left(tails, x)
            if k == len(tails):
                tails.append(x)
            else:
                tails[k] = x
        length = len(tails)
    got = length / (n + m - length)
    return got if got >= similarity else 0.0


def _prepared(batches):
    for batch in slices(batches):
        keys, buckets = [], []
        for text in batch.column(batch.num_columns - 1).to_pylist():
            if text is None:
                keys.append(None)
                buckets.append([])
                continue
            words = FIND(text.lower())
            plain = " ".join(words) if words else "\0" + text
            keys.append(xxhash.xxh3_128_digest(plain.encode("utf-8", "replace")))
            buckets.append(sketches(shingles(words)).view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(keys, pa.binary()), pa.array(buckets, pa.list_(pa.int64()))],
            [*batch.schema.names[:-1], "__key", "__buckets"])


def _verified(batches):
    """(a, b) of the pairs whose shingle lists ``ma`` and ``mb`` align."""
    for batch in slices(batches, rows=256):
        ma, mb = batch.column(2), batch.column(3)
        good = np.array([bool(aligned(ma[k].values.to_numpy().view(np.uint64), mb[k].values.to_numpy().view(np.uint64)))
                         for k in range(batch.num_rows)], bool)
        mask = pa.array(good)
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])


def _buckets(prepared):
    """(bucket, key) rows, single-member buckets removed."""
    nodes = prepared.filter("size(__buckets) > 0").select("__key", "__buckets").dropDuplicates(["__key"])
    rows = nodes.select(F.col("__key").alias("key"), F.explode("__buckets").alias("bucket"))
    several = rows.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket")
    return rows.join(several.hint("merge"), "bucket", "left_semi")


def _candidates(members):
    """Pairs (a, b) of a member and its bucket's leader."""
    first = members.groupBy("bucket").agg(F.min(F.struct(F.xxhash64("key").alias("h"), "key")).alias("lead"))
    return members.join(first, "bucket").filter(F.col("key") != F.col("lead.key")).select(
        F.col("key").alias("a"), F.col("lead.key").alias("b")).distinct()


def parity(h):
    """Per bit how often the hashes fall on it, modulo 2, as ``PARITY`` words."""
    bits = np.bincount((h >> np.uint64(40)).astype(np.int64) % (64 * PARITY), minlength=64 * PARITY) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def _shingled(batches):
    """(key, text) to (key, marks, bits): shingles in text order and parity words."""
    for batch in slices(batches):
        marks = [shingles(FIND(t.lower())) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([h.view(np.int64) for h in marks], pa.list_(pa.int64())),
             pa.array([parity(h) for h in marks], pa.list_(pa.int64()))], ["key", "marks", "bits"])


def _unsettled(members):
    """(key, group) of the texts in buckets that hold several groups."""
    several = members.groupBy("bucket").agg(F.min("group").alias("g0"), F.max("group").alias("g1")).filter("g0 != g1")
    return members.join(several.select("bucket").hint("merge"), "bucket", "left_semi").select("key", "group").distinct()


def _postings(texts):
    """(h, row, gid, n, left, bits): the shingles of each text's prefix, from (row, gid, marks, bits).

    A pair of n and m shingles needs M >= t / (1 + t) * (n + m) matches, hence a common shingle with
    that many left in both texts. ``left`` counts the shingles of the text from this one on.
    """
    rows = texts.select("row", F.explode("marks").alias("h"))
    shared = rows.groupBy("h").agg(F.count("*").alias("f")).filter("f > 1")
    rated = rows.join(shared.hint("merge"), "h").groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("f", "h"))).alias("common"))
    # shingles of one text alone come first in the order and match nothing
    first = texts.join(rated.hint("merge"), "row").withColumns(
        {"n": F.size("marks"), "alone": F.size("marks") - F.size("common")})
    reach = F.floor((1 - SIMILARITY) * F.col("n") + 1e-6).cast("int") + 1 - F.col("alone")
    return first.filter(reach > 0).select("row", "gid", "n", "alone", "bits", F.posexplode(F.slice("common", 1, reach)).alias("at", "x")).select(
        F.col("x.h").alias("h"), "row", "gid", "n", (F.col("n") - F.col("alone") - F.col("at")).alias("left"), "bits")


def _pieces(postings, chunk=CHUNK):
    """Pieces (h, i, j) of postings: chunk i of the texts outside a shingle's largest group against all.

    They meet every later chunk of their own kind (j >= i) and every chunk of the largest group (j < 0).
    """
    sizes = postings.groupBy("h", "gid").agg(F.count("*").alias("c")).groupBy("h").agg(
        F.max(F.struct("c", "gid")).alias("x"), F.sum("c").alias("total")).filter(F.col("total") > F.col("x.c"))
    plan = sizes.select("h", F.col("x.gid").alias("main"), F.ceil(F.col("x.c") / chunk).cast("int").alias("qm"),
                        F.ceil((F.col("total") - F.col("x.c")) / chunk).cast("int").alias("qs"))
    rows = postings.join(plan.hint("merge"), "h")
    main = F.col("gid") == F.col("main")
    part = F.pmod(F.xxhash64("row"), F.when(main, F.col("qm")).otherwise(F.col("qs")).cast("long")).cast("int")
    # (i, j, role): the roles are left 0, right 1, and 2 where a chunk meets itself
    pieces = F.expr("""
        if(main, transform(sequence(0, qs - 1), i -> struct(i as i, -1 - part as j, 1 as role)),
           concat(transform(sequence(0, qm - 1), j -> struct(part as i, -1 - j as j, 0 as role)),
                  transform(sequence(part, qs - 1), j -> struct(part as i, j as j, if(j = part, 2, 0) as role)),
                  if(part > 0, transform(sequence(0, part - 1), i -> struct(i as i, part as j, 1 as role)), array())))""")
    return rows.withColumns({"main": main, "part": part}).select("h", "row", "gid", "n", "left", "bits", F.explode(pieces).alias("x")).select(
        "h", "x.i", "x.j", "x.role", "row", "gid", "n", "left", "bits")


def _may_match(role, row, gid, n, left, bits):
    """Positions (a, b) of the pairs of one piece that may reach ``SIMILARITY``."""
    one, two = np.flatnonzero(role != 1), np.flatnonzero(role != 0)
    out_a, out_b = [], []
    for at in range(0, len(one), 256):
        some = one[at:at + 256]
        total = n[some][:, None] + n[two][None, :]
        need = SIMILARITY * total - 1e-6
        open_ = (gid[some][:, None] != gid[two][None, :]) & (
            np.minimum(left[some][:, None], left[two][None, :]) * (1 + SIMILARITY) >= need)
        open_ &= (role[some][:, None] != 2) | (some[:, None] < two[None, :])
        i, j = np.nonzero(open_)
        i, j = some[i], two[j]
        for k in range(0, len(i), 1 << 17):
            a, b = i[k:k + (1 << 17)], j[k:k + (1 << 17)]
            differing = np.bitwise_count(bits[a] ^ bits[b]).sum(axis=1, dtype=np.int64)
            both = n[a] + n[b]
            good = (both - differing) * ((1 + SIMILARITY) / 2) >= SIMILARITY * both - 1e-6
            out_a.append(a[good])
            out_b.append(b[good])
    return (np.concatenate(out_a), np.concatenate(out_b)) if out_a else (role[:0], role[:0])


PIECE = ("h", "i", "j")
#: a piece with its share of the left and of the right side, where the shingles come along
SHARE = (*PIECE, "p", "q")


def _whole(batches, keys):
    """Tables of whole pieces (runs of equal ``keys``) from batches that may end inside one."""
    held = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        columns = [_numbers(table, k) for k in keys]
        if held and [c[0] for c in columns] != [held[0].column(k)[0].as_py() for k in keys]:
            yield pa.concat_tables(held).combine_chunks()
            held = []
        differs = np.logical_or.reduce([c != c[-1] for c in columns])
        cut = int(np.flatnonzero(differs)[-1]) + 1 if differs.any() else 0
        if cut:  # the last piece may go on in the next batch
            yield pa.concat_tables([*held, table.slice(0, cut)]).combine_chunks()
            held = []
        held.append(table.slice(cut))
    if held:
        yield pa.concat_tables(held).combine_chunks()


def _numbers(table, name):
    return table.column(name).combine_chunks().to_numpy(zero_copy_only=False)


def _pieces_of(table, keys):
    """(from, to) of the pieces of a table, and what ``_may_match`` needs of all its rows."""
    columns = [_numbers(table, k) for k in keys]
    cuts = (np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in columns])) + 1).tolist()
    role, row, gid, n, left = (_numbers(table, k) for k in ("role", "row", "gid", "n", "left"))
    bits = table.column("bits").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, PARITY).view(np.uint64)
    return (list(zip([0, *cuts], [*cuts, len(role)])),
            (role, row, gid, n.astype(np.int64), left.astype(np.int64), bits))


def _shares(role, n, limit):
    """(position, p, q, role) of a piece's rows, either side cut into shares of about ``limit`` shingles."""
    def cut(at):
        return (np.cumsum(n[at]) - n[at]) // limit

    if role[0] == 2:  # a chunk that meets itself: every share meets itself and the later ones
        at = np.arange(len(role))
        share = cut(at)
        for p in range(int(share[-1]) + 1):
            for q in range(p, int(share[-1]) + 1):
                for own, kind in (((p, 2),) if p == q else ((p, 0), (q, 1))):
                    yield at[share == own], p, q, kind
        return
    sides = np.flatnonzero(role == 0), np.flatnonzero(role == 1)
    one, two = cut(sides[0]), cut(sides[1])
    for p in range(int(one[-1]) + 1):
        for q in range(int(two[-1]) + 1):
            yield sides[0][one == p], p, q, 0
            yield sides[1][two == q], p, q, 1


def _matched(batches, limit=MARKS):
    """The rows of a piece that may match another one of it, in shares; as many as rows, not as pairs."""
    for table in _whole(batches, PIECE):
        pieces, columns = _pieces_of(table, PIECE)
        found = [[] for _ in range(4)]
        for x, y in pieces:
            role, row, gid, n, left, bits = (c[x:y] for c in columns)
            a, b = _may_match(role, row, gid, n, left, bits) if y - x > 1 else (role[:0], role[:0])
            if not len(a):
                continue
            kept = np.unique(np.concatenate([a, b]))
            for at, p, q, kind in _shares(role[kept], n[kept], limit):
                for out, values in zip(found, (kept[at] + x, np.full(len(at), p), np.full(len(at), q), np.full(len(at), kind))):
                    out.append(values)
        at, p, q, kind = (np.concatenate(f) if f else np.zeros(0, np.int64) for f in found)
        some = table.select([*PIECE, "row", "left"]).take(pa.array(at, pa.int64()))
        for name, values in (("p", p), ("q", q), ("role", kind)):
            some = some.append_column(name, pa.array(values.astype(np.int32)))
        yield from some.combine_chunks().to_batches()


def _near_in(role, row, gid, n, left, bits, marks, forest):
    """Positions (a, b) of a piece's pairs that align; with ``forest`` only those that join further groups."""
    a, b = _may_match(role, row, gid, n, left, bits)
    if not len(a):
        return []
    ids = np.unique(np.concatenate(marks), return_inverse=True)[1]
    start = np.cumsum(n) - n
    group = np.unique(gid, return_inverse=True)[1]
    label, held, out = np.arange(len(row)), np.zeros(len(ids), bool), []
    firsts = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])).tolist()
    for x, y in zip(firsts, [*firsts[1:], len(a)]):
        one, others = int(a[x]), b[x:y]
        own = ids[start[one]:start[one] + n[one]]
        held[own] = True
        for at in range(0, len(others), 512):
            some = others[at:at + 512]
            if forest:
                some = some[label[group[some]] != label[group[one]]]
            if not len(some):
                continue
            # how many shingles each shares with the one
            ends = np.cumsum(n[some])
            place = np.arange(int(ends[-1])) + np.repeat(start[some] - ends + n[some], n[some])
            common = np.add.reduceat(held[ids[place]], ends - n[some], dtype=np.int64)
            for other in some[common * (1 + SIMILARITY) >= SIMILARITY * (n[some] + n[one]) - 1e-6].tolist():
                u, v = label[group[one]], label[group[other]]
                if not (forest and u == v) and aligned(marks[one], marks[other]):
                    out.append((row[one], row[other]))
                    label[label == v] = u
        held[own] = False
    return out


def _linked(batches, forest):
    """(a, b) row numbers of the pairs that align, from pieces with their shingles."""
    for table in _whole(batches, SHARE):
        pieces, columns = _pieces_of(table, SHARE)
        lists, found = table.column("marks").combine_chunks(), []
        for x, y in pieces:
            marks = [lists[k].values.to_numpy().view(np.uint64) for k in range(x, y)]
            found += _near_in(*(c[x:y] for c in columns), marks, forest)
        pairs = np.unique(np.sort(np.array(found, np.int64).reshape(-1, 2), axis=1), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def _prefix_pairs(texts, chunk=CHUNK, forest=False, limit=MARKS):
    """Pairs (a, b) of rows of different groups that align.

    What the parity bits leave open of a piece goes on as its rows, not as pairs, and meets its shingles
    in the task that aligns. With ``forest`` a piece yields only pairs that join groups not yet joined in it.
    """
    pieces = _pieces(staged(_postings(texts)), chunk)
    dealt = pieces.repartition(*PIECE).sortWithinPartitions(*PIECE)
    open_ = staged(map_batches(
        dealt, lambda it: _matched(it, limit), "h long, i int, j int, row long, left int, p int, q int, role int"))
    full = open_.join(texts, "row").withColumn("n", F.size("marks"))
    shares = full.repartition(*SHARE).sortWithinPartitions(*SHARE)
    return map_batches(shares, lambda it: _linked(it, forest), "a long, b long").distinct()


def _aligned_pairs(pairs, texts):
    """The pairs (a, b) of keys whose marks align."""
    full = pairs
    for side in ("a", "b"):
        own = texts.select(F.col("key").alias(side), F.col("key").alias(f"n{side}"), F.col("marks").alias(f"m{side}"))
        full = full.join(own, side)
    return staged(map_batches(full.select("na", "nb", "ma", "mb"), _verified, "a binary, b binary"))


def near_groups(prepared, chunk=CHUNK):
    """(node, component) of keys that have a near copy: least key of the group; None without any."""
    members = staged(_buckets(prepared))
    # the texts are moved once, and only those that share a bucket are kept; the merge hints keep the
    # plan the same at every size
    keys = members.select("key").distinct()
    texts = prepared.select(F.col("__key").alias("key"), F.col("__text").alias("text"))
    some = texts.join(keys.hint("merge"), "key", "left_semi").groupBy("key").agg(F.first("text").alias("text"))
    own = staged(map_batches(some, _shingled, "key binary, marks array<bigint>, bits array<bigint>"))
    pairs = staged(_candidates(members))
    if pairs.isEmpty():
        return None
    groups = staged(components(_aligned_pairs(pairs, own)))
    named = groups.select(F.col("node").alias("key"), F.col("component").alias("group"))
    grouped = staged(members.join(named, "key", "left").select("bucket", "key", F.coalesce("group", "key").alias("group")))
    # groups are told apart by a 64-bit hash where texts are compared
    open_ = staged(_unsettled(grouped).join(own, "key").select(
        F.monotonically_increasing_id().alias("row"), "group", F.xxhash64("group").alias("gid"), "marks", "bits"))
    pairs = staged(_prefix_pairs(open_.select("row", "gid", "marks", "bits"), chunk, forest=True))
    if pairs.isEmpty():
        return groups
    for side in ("a", "b"):
        pairs = pairs.join(open_.select(F.col("row").alias(side), F.col("group").alias(f"g{side}")), side)
    merged = staged(components(pairs, "ga", "gb"))
    merged = merged.select(F.col("node").alias("group"), F.col("component").alias("further"))
    every = named.unionAll(merged.select("group", "group")).distinct()  # groups of a single text among them
    return every.join(merged, "group", "left").select(
        F.col("key").alias("node"), F.coalesce("further", "group").alias("component")).distinct()


def near_duplicates(df, text="text", doc_id="doc_id"):
    """``doc_id``, ``class_id`` (least identifier of the class) and ``class_rows`` per row of ``df``."""
    frame = df.select(F.col(doc_id).alias("__id"), F.col(text).alias("__text"), F.col(text).alias("__last"))
    kind = df.schema[doc_id].dataType.simpleString()
    prepared = staged(map_batches(
        frame, _prepared, f"__id {kind}, __text string, __key binary, __buckets array<bigint>"))
    groups = near_groups(prepared)
    rows = prepared.select("__id", "__key")
    if groups is not None:
        rows = rows.join(groups.withColumnRenamed("node", "__key"), "__key", "left").select(
            "__id", F.coalesce("component", "__key").alias("__class"))
    else:
        rows = rows.select("__id", F.col("__key").alias("__class"))
    classes = rows.filter("__class IS NOT NULL").groupBy("__class").agg(
        F.min("__id").alias("class_id"), F.count("*").alias("class_rows"))
    return rows.join(classes, "__class", "left").select(
        F.col("__id").alias(doc_id), F.coalesce("class_id", "__id").alias("class_id"),
        F.coalesce("class_rows", F.lit(1)).alias("class_rows"))
