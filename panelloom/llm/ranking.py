"""Ranked lexical search by bag deduplication.

Every document is reduced to its bag: the occurrences of the terms that some item asks for, and the
length norm m. Documents of the same bag have the same score for every item, so bags are made
classes (dealt by a hash, compared whole), each class is scored once, and only the classes that can
reach an item's best are expanded into their documents by ascending identifier.

Scores are whole numbers: a term weighs w = floor(1000 * ln((2N + 2) / (2df + 1))), a document has
m = 75 + (25 * n * N) div L, and the score adds w * ((10^9 * tf) div (1000 * tf + 12 * m)) over the
item's terms with repeats. N, L and df are counted over all documents.

Plan: items are taken in blocks of ``ITEMS`` rows, so that what a task holds of them is bounded by
a parameter; texts are scanned once a block, in workers that count the block's terms. Bags are staged; one
aggregate gives N and L, one df, one the classes (combined on the map side, so copies of a
document that fill a third of the table leave each task as one row). A task scores its classes
against the block and keeps the best ``k`` per item: a class outside these cannot reach the item's
best, as each better class has a document that comes before all of its own. Members are expanded by
a window with a group limit, so a class of any size gives at most ``k`` rows a task.

Cases: a null text, or one without terms, counts nowhere and is never found. A document row is a
document and an item row an item, also where rows or identifiers repeat; a null identifier comes first
among equal scores. Columns other than identifier and text are not read, so no name can clash.
An empty table, or items without terms, gives an empty result.
"""

import heapq
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from panelloom.llm.common import map_batches, slices, staged

BEST = 20
#: items of a block; a block's terms and its matrix of weights are what a task holds
ITEMS = 256
#: characters of a block's items, unless one item alone has more
ITEM_CHARS = 1 << 20
# terms as UTF-8: ASCII digits and letters and all bytes of other characters
FIND = re.compile(rb"[0-9A-Za-z\x80-\xff]+").findall


def terms(data):
    """Terms of a UTF-8 text, only A-Z lower-cased (``bytes.lower`` does just that)."""
    return FIND(data.lower())


def _utf8(column):
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def _bags(batches, shared):
    vocabulary = shared.value
    for batch in slices(batches, rows=2048):
        lengths, ids, counts = [], [], []
        for text in _utf8(batch.column(1)):
            words = terms(text)
            bag = Counter(map(vocabulary.get, words))
            bag.pop(None, None)
            mine = sorted(bag)
            lengths.append(len(words))
            ids.append(mine)
            counts.append([bag[t] for t in mine])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(lengths, pa.int64()), pa.array(ids, pa.list_(pa.int32())),
             pa.array(counts, pa.list_(pa.int64()))], ["__id", "n", "ids", "tfs"])


def _scores(ids, tfs, sizes, m, weights):
    """(rows, items) scores of bags given one after the other."""
    tfs = tfs.astype(np.int64)
    part = (1_000_000_000 * tfs) // (1000 * tfs + 12 * np.repeat(m, sizes))
    starts = np.cumsum(sizes) - sizes
    return np.add.reduceat(weights[ids] * part[:, None], starts, axis=0)


def _best(batches, shared, k):
    """Per item of the block the best ``k`` classes of this task, by score, then least identifier."""
    weights = shared.value
    kept = [[] for _ in range(weights.shape[1])]  # heaps of (score, -order, class, first)
    for batch in slices(batches, rows=2048, nbytes=1 << 18):
        names, first = batch.column(0).to_pylist(), batch.column(1).to_numpy(zero_copy_only=False)
        m = batch.column(2).to_numpy(zero_copy_only=False)
        lists = batch.column(3)
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        got = _scores(lists.flatten().to_numpy(zero_copy_only=False), batch.column(4).flatten().to_numpy(zero_copy_only=False),
                      sizes, m, weights)
        for item, heap in enumerate(kept):
            column = got[:, item]
            rows = np.flatnonzero(column > (heap[0][0] - 1 if len(heap) == k else 0))
            if len(rows) > k:
                rows = rows[np.lexsort((first[rows], -column[rows]))[:k]]
            for row in rows:
                entry = (int(column[row]), -int(first[row]), names[row])
                if len(heap) < k:
                    heapq.heappush(heap, entry)
                elif entry > heap[0]:
                    heapq.heapreplace(heap, entry)
    out = [(item, name, score, -order) for item, heap in enumerate(kept) for score, order, name in heap]
    yield pa.RecordBatch.from_arrays(
        [pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.int64()),
         pa.array([o[2] for o in out], pa.int64()), pa.array([o[3] for o in out], pa.int64())],
        ["item", "class", "score", "first"])


def _blocks(items, item_id, text):
    """Items as lists of (identifier, Counter of terms), block by block; the rows come in pieces."""
    block, chars = [], 0
    for row in items.select(F.col(f"`{item_id}`").alias("i"), F.col(f"`{text}`").alias("t")).filter(
            F.col("t").isNotNull()).toLocalIterator():
        bag = Counter(terms(row["t"].encode("utf-8", "replace")))
        if not bag:
            continue
        if block and (len(block) == ITEMS or chars + len(row["t"]) > ITEM_CHARS):
            yield block
            block, chars = [], 0
        block.append((row["i"], bag))
        chars += len(row["t"])
    if block:
        yield block


def _ranked(docs, block, k):
    """(item number, ``__id``, score, rank) of the best ``k`` documents of each item of a block."""
    spark = docs.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, bag in block for t in bag}))}
    kind = docs.schema["__id"].dataType.simpleString()
    shared = spark.sparkContext.broadcast(vocabulary)
    bags = staged(map_batches(docs, lambda it: _bags(it, shared), f"__id {kind}, n long, ids array<int>, tfs array<long>")
                  .filter("n > 0"))
    total = bags.agg(F.count("*").alias("N"), F.sum("n").alias("L")).first()
    if not total["N"]:
        return None
    holding = {r["t"]: r["df"] for r in bags.select(F.explode("ids").alias("t")).groupBy("t").agg(F.count("*").alias("df")).collect()}
    weights = np.zeros((len(vocabulary), len(block)), np.int64)
    for item, (_, bag) in enumerate(block):
        for term, count in bag.items():
            t = vocabulary[term]
            weights[t, item] = count * math.floor(1000 * math.log((2 * total["N"] + 2) / (2 * holding.get(t, 0) + 1)))
    # as decimals: n * N may pass 64 bits
    m = F.expr(f"75L + (25BD * cast(n as decimal(19,0)) * {total['N']}BD) div {total['L']}BD")
    matching = bags.filter("size(ids) > 0").select("__id", m.alias("m"), "ids", "tfs").withColumn("h", F.xxhash64("m", "ids", "tfs"))
    # equal hashes only deal the rows out: a class is what has the same bag and m throughout
    bag = ["h", "m", "ids", "tfs"]
    first = F.min(F.coalesce(F.col("__id").cast("long"), F.lit(-(1 << 63)))).alias("first")
    classes = staged(matching.groupBy(*bag).agg(first).withColumn("class", F.monotonically_increasing_id()))
    weights = spark.sparkContext.broadcast(weights)
    found = map_batches(classes.select("class", "first", "m", "ids", "tfs"), lambda it: _best(it, weights, k),
                        "item int, class long, score long, first long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), "first", "class")
    best = staged(found.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k).drop("r", "first"))
    asked = classes.join(best.select("class").distinct(), "class", "left_semi").select("class", *bag)
    inside = Window.partitionBy("class").orderBy("__id")
    members = matching.join(asked, bag).select("class", "__id").withColumn("r", F.row_number().over(inside))
    members = members.filter(F.col("r") <= k).drop("r")
    last = Window.partitionBy("item").orderBy(F.desc("score"), "__id")
    return best.join(members, "class").withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= k).select(
        "item", "__id", "score", "rank")


def best_documents(docs, items, k=BEST, doc_id="doc_id", text="text", item_id="item_id", item_text="text"):
    """``item_id``, ``rank`` (from 1), ``doc_id`` and ``score`` of each item's best documents."""
    spark = docs.sparkSession
    frame = docs.select(F.col(f"`{doc_id}`").alias("__id"), F.col(f"`{text}`").alias("__text"))
    own = items.schema[item_id].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {own}, rank int, doc_id {docs.schema[doc_id].dataType.simpleString()}, score long")
    for block in _blocks(items, item_id, item_text):
        rows = _ranked(frame, block, k)
        if rows is None:
            break
        names = spark.createDataFrame([(n, i) for n, (i, _) in enumerate(block)], f"item int, item_id {own}")
        out = out.unionAll(rows.join(F.broadcast(names), "item").select(
            "item_id", "rank", F.col("__id").alias("doc_id"), "score"))
    return out
