"""Language-model scores from a class-based bigram model (Brown classes).

    log P(text) = sum over tokens of  log P(class | class before) + log P(word | class)

Words are assigned to classes by exchange clustering: a word moves to the class that raises the
likelihood of the class bigrams most. Words that make up one in ``SHARE`` tokens or more, ``SHARE`` words at
most by arithmetic, shape the classes: their pair counts stay a Spark table of (word, word, n); a round is one
job that adds them up to (word, class of the neighbour), and the driver, which holds these sums and the class by
class table, moves the words one after the other. A round whose classes are no better ends it. Every other
training word, of any number, then moves in a task to the class that raises the likelihood most, by all its
neighbours that have a class by then; without any, to one by its ending. Endings that are classes of their
own serve words never seen. The share is the only rule, so rows repeated any number of times give the same classes. All
counts (words, class transitions, words and tokens per class) cover all training rows. Transitions are mixed with
the class unigram, emissions are add-``ADD`` smoothed within the class, unseen words included.

Count and class of frequent words travel as a table bounded by ``FREQUENT`` and ``SHARE``; tokens of all others are
joined with the whole table (word, n, k), by a shuffle, and their classes put in their places in the text's
sequence of classes, from which transitions are counted and scored.

Cases: a null text counts as empty and scores its one end token. Tokens are separated by ASCII
white space, A-Z lower-cased, then one end token. Without training rows all counts are 0 and
every class is uniform. Rows with the same identifier are scored each on its own.
"""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from panelloom.llm.common import map_batches, slices, small_rows, staged

END = b"\n"  # cannot occur in a token
SHARE = 50_000
ROUNDS = 5
CLASSES = 64
ENDINGS = 64
FREQUENT = 60_000
LONGEST_FREQUENT = 64
ADD = 0.5
MIX = 0.02


def tokens_of(text):
    """Lower-cased tokens and the end; ``bytes`` methods know ASCII alone."""
    words = text.encode("utf-8", "replace").lower().split()
    words.append(END)
    return words


def ending(word):
    """Number from 0 of a word's ending."""
    tail = word[-3:]
    value = len(word) > 6
    for b in tail:
        value = value * 131 + b
    return value * 40503 % 65521 % ENDINGS


# ---- counts -----------------------------------------------------------------------------------


def _word_counts(batches):
    counts = Counter()

    def flush():
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    for batch in slices(batches):
        for text in batch.column(0).to_pylist():
            counts.update(tokens_of(text or ""))
        if len(counts) > 200_000:
            yield flush()
            counts.clear()
    if counts:
        yield flush()


def word_counts(texts):
    """``word`` (binary), ``n`` of every token of a one-column table of texts; the end included."""
    part = map_batches(texts, _word_counts, "word binary, n long")
    return part.groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts, limit=FREQUENT, also=()):
    """Up to ``limit`` words with the highest counts, their counts and the columns ``also``, as a list.

    A histogram of counts gives the threshold, so nothing is sorted in one task. Words tied at
    the threshold are all left out: fewer words, never more.
    """
    short = counts.filter(F.length("word") <= LONGEST_FREQUENT)
    # 16 steps per doubling, so at most 16 * 63 rows
    level = F.floor(F.log2("n") * 16).cast("int")
    steps = {r["level"]: r["size"] for r in short.groupBy(level.alias("level")).agg(F.count("*").alias("size")).collect()}
    total, least = 0, None
    for step in sorted(steps, reverse=True):
        if total + steps[step] > limit:
            break
        total, least = total + steps[step], step
    if least is None:
        return []
    rows = small_rows(short.filter(level >= least), limit)
    return sorted(((bytes(r["word"]), r["n"], *(r[c] for c in also)) for r in rows), key=lambda x: (-x[1], x[0]))


# ---- exchange clustering ----------------------------------------------------------------------


def _entropy(x):
    return np.where(x > 0, x * np.log(np.maximum(x, 1)), 0.0)


def likelihood(onto):
    """Of the class bigrams, from the class by class counts; constants left out."""
    return _entropy(onto).sum() - _entropy(onto.sum(axis=0)).sum() - _entropy(onto.sum(axis=1)).sum()


def sweep(label, after, before, own, onto):
    """Move each word to its best class in turn; ``after`` and ``before`` are those of the round's begin.

    ``onto`` is kept in step with the moves. Returns the number of words moved.
    """
    moved = 0
    for w in range(len(label)):
        old = label[w]
        a, b, s = after[w].copy(), before[w].copy(), own[w]
        a[old] -= s
        b[old] -= s
        onto[old] -= a
        onto[:, old] -= b
        onto[old, old] -= s
        left, right = onto.sum(axis=1), onto.sum(axis=0)
        flat = _entropy(onto)
        gain = (_entropy(onto + a) - flat).sum(axis=1) + (_entropy(onto + b[:, None]) - flat).sum(axis=0)
        diagonal = np.diag(onto)
        row, column = diagonal + a, diagonal + b  # the cell where both changes meet
        gain += _entropy(row + b + s) - _entropy(row) - _entropy(column) + _entropy(diagonal)
        gain -= _entropy(left + a.sum() + s) - _entropy(left) + _entropy(right + b.sum() + s) - _entropy(right)
        new = int(gain.argmax())
        onto[new] += a
        onto[:, new] += b
        onto[new, new] += s
        moved += new != old
        label[w] = new
    return moved


def exchange(neighbours, own, classes, rounds=ROUNDS):
    """Class of each word, maximising the class bigrams' likelihood."""
    return exchanged(neighbours, own, classes, rounds)[0]


def exchanged(neighbours, own, classes, rounds=ROUNDS):
    """Class of each word, and the class by class counts under these classes.

    ``neighbours(label)`` gives the counts (word, class of the word after it) and (word, class of the
    word before it) under a labelling, ``own`` how often a word follows itself. Words start
    round-robin in order of frequency. Within a round the sums of a word's neighbours are those of the
    round's begin; a round that has not raised the likelihood is taken back and ends it.
    """
    label = np.arange(len(own)) % classes
    best, kept, table = -math.inf, label, np.zeros((classes, classes))
    for number in range(rounds + 1):
        after, before = neighbours(label)
        onto = np.zeros((classes, classes))
        np.add.at(onto, label, after)
        value = likelihood(onto)
        if value <= best:
            break
        best, kept, table = value, label.copy(), onto.copy()
        if number == rounds or not sweep(label, after, before, own, onto):
            break
    return kept, table


def _sparse_pairs(batches, numbers, size):
    """(a, b, n) of neighbouring words that both have a number, added up per some slices."""
    cells, counts, held = [], [], 0

    def flush():
        cell, at = np.unique(np.concatenate(cells), return_inverse=True)
        n = np.bincount(at, np.concatenate(counts), len(cell)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array((cell // size).astype(np.int32)), pa.array((cell % size).astype(np.int32)),
                                           pa.array(n)], ["a", "b", "n"])

    get = numbers.value.get
    for batch in slices(batches):
        tokens, ends = [], []
        for text in batch.column(0).to_pylist():
            tokens += tokens_of(text or "")
            ends.append(len(tokens) - 1)
        now = np.fromiter((get(t, -1) for t in tokens), np.int64, len(tokens))
        both = (now[:-1] >= 0) & (now[1:] >= 0)  # the end has no number, so no pair spans two texts
        cell, n = np.unique(now[:-1][both] * size + now[1:][both], return_counts=True)
        cells.append(cell)
        counts.append(n)
        held += len(cell)
        if held > 2_000_000:
            yield flush()
            cells, counts, held = [], [], 0
    if held:
        yield flush()


def cluster(texts, words, classes=CLASSES, rounds=ROUNDS):
    """Class by word of ``words`` (the most frequent first) from their pairs in all texts."""
    return clustered(texts, words, classes, rounds)[0]


def clustered(texts, words, classes=CLASSES, rounds=ROUNDS):
    """The same, and the class by class counts."""
    spark, size = texts.sparkSession, len(words)
    classes = min(classes, size)
    numbers = spark.sparkContext.broadcast({w: i for i, w in enumerate(words)})
    pairs = map_batches(texts, lambda it: _sparse_pairs(it, numbers, size), "a int, b int, n long")
    pairs = staged(pairs.groupBy("a", "b").agg(F.sum("n").alias("n")))
    own = np.zeros(size)
    for row in small_rows(pairs.filter("a = b").select("a", "n"), size):
        own[row["a"]] = row["n"]

    def neighbours(label):
        of = F.broadcast(spark.createDataFrame(list(enumerate(label.tolist())), "w int, k int"))  # ``SHARE`` rows at most
        sides = [pairs.join(of, pairs[there] == of["w"]).groupBy(F.col(here).alias("word"), "k").agg(F.sum("n").alias("n")).withColumn(
            "side", F.lit(side)) for side, (here, there) in enumerate((("a", "b"), ("b", "a")))]
        out = np.zeros((2, size, classes))
        table = sides[0].unionAll(sides[1]).toArrow()
        word, k, n, side = (table.column(c).to_numpy() for c in ("word", "k", "n", "side"))
        out[side, word, k] = n
        return out[0], out[1]

    label, onto = exchanged(neighbours, own, classes, rounds)
    return dict(zip(words, label.tolist())), onto


# ---- words that are not exchanged in turn -----------------------------------------------------------

WORDS = 100_000  # that a task gives classes to, about
RIGHT = 128  # a neighbour's class is a byte; after the word it has this added
UNKNOWN = 255


class _Codes(dict):
    """Classes of the words known, and a number from 256 for every other word met since the last ``begin``."""

    def begin(self, labels):
        self.clear()
        self.update(labels)
        self.fixed = len(self)

    def __missing__(self, word):
        code = self[word] = 256 + len(self) - self.fixed
        return code


def _around(batches, labels):
    """(word, n, classes of the neighbours that have one) of every other word, added up per some slices."""
    codes, found, held = _Codes(), [], 0
    codes.begin(labels)

    def flush():
        at, cells, n = (np.concatenate(part) for part in zip(*found))
        known = cells < UNKNOWN
        words = list(codes)[codes.fixed:]
        times = np.bincount(at[n], minlength=len(words))
        at, cells = at[known], cells[known]
        offsets = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(words)))]).astype(np.int32)
        data = cells[np.argsort(at, kind="stable")].astype(np.uint8)
        return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(times, pa.int64()), pa.BinaryArray.from_buffers(
            pa.binary(), len(words), [None, pa.py_buffer(offsets), pa.py_buffer(data)])], ["word", "n", "cells"])

    for batch in slices(batches):
        tokens = []
        for text in batch.column(0).to_pylist():
            tokens += tokens_of(text or "")
        now = np.fromiter(map(codes.__getitem__, tokens), np.int32, len(tokens))
        place = np.flatnonzero(now >= 256)  # never the last token, which is an end
        if len(place):
            word, left, right = now[place] - 256, now[place - 1], now[place + 1]
            left[place == 0] = CLASSES
            found.append((np.concatenate([word, word]), np.concatenate([np.where(left < CLASSES, left, UNKNOWN),
                          np.where(right < CLASSES, right + RIGHT, UNKNOWN)]), np.arange(2 * len(word)) < len(word)))
            held += len(word)
        if len(codes) - codes.fixed > 200_000 or held > 4_000_000:
            yield flush()
            found, held = [], 0
            codes.begin(labels)
    if held:
        yield flush()


def best_classes(after, before, onto):
    """The class that raises the likelihood of the class bigrams ``onto`` most, for each of some words by itself.

    ``after`` and ``before`` are (words x classes) counts of the neighbours. Equal counts of a cell gain the same, so
    the small ones are a matrix product each.
    """
    gain = np.zeros(after.shape)
    flat = _entropy(onto)
    for counts, others, table, base in ((after, before, onto, flat), (before, after, onto.T, flat.T)):
        for n in range(1, 5):
            gain += (counts == n).astype(float) @ (_entropy(table + n) - base).T
        words, cells = np.nonzero(counts > 4)
        for at in range(0, len(words), 20_000):
            word, k = words[at:at + 20_000], cells[at:at + 20_000]
            first = np.flatnonzero(np.diff(word, prepend=-1))
            more = _entropy(table.T[k] + counts[word, k][:, None]) - base.T[k]
            gain[word[first]] += np.add.reduceat(more, first, axis=0)
        sums = table.sum(axis=1) + others  # the neighbours' own sums hold the word in any case
        gain -= _entropy(sums + counts.sum(axis=1, keepdims=True)) - _entropy(sums)
    word, k = np.nonzero((after > 0) & (before > 0))  # the cell where both changes meet
    a, b, x = after[word, k], before[word, k], onto[k, k]
    gain[word, k] += _entropy(x + a + b) - _entropy(x + a) - _entropy(x + b) + _entropy(x)
    return gain.argmax(axis=1)


def _assigned(batches, onto):
    """(word, n, k) from all rows (word, n, cells) of some words."""
    classes, index, found = len(onto), _Codes(), []
    index.begin({})
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            some = batch.slice(at, 4096)
            place = np.fromiter(map(index.__getitem__, some.column(0).to_pylist()), np.int32, some.num_rows) - 256
            data, starts = _sequences(some.column(2))
            sizes = np.diff(starts, append=len(data))
            found.append((place, some.column(1).to_numpy(), np.repeat(place, sizes), data))
    if not found:
        return
    place, n, of, cells = (np.concatenate(part) for part in zip(*found))
    n = np.bincount(place, n, len(index)).astype(np.int64)
    order = np.argsort(of, kind="stable")
    of, cells, words = of[order], cells[order], list(index)
    for at in range(0, len(words), 4096):
        some = words[at:at + 4096]
        begin, end = np.searchsorted(of, [at, at + len(some)])
        table = np.bincount((of[begin:end] - at) * 256 + cells[begin:end], minlength=len(some) * 256).reshape(-1, 256)
        k = best_classes(table[:, RIGHT:RIGHT + classes], table[:, :classes], onto) if classes else np.zeros(len(some), np.int64)
        for i in np.flatnonzero(table.sum(axis=1) == 0).tolist():  # no neighbour has a class
            k[i] = ending(some[i]) % classes if classes else CLASSES + 1 + ending(some[i])
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.binary()), pa.array(n[at:at + 4096]), pa.array(k, pa.int32())], ["word", "n", "k"])


# ---- the model --------------------------------------------------------------------------------


class Classes(dict):
    """Word to class: the words given, the end's own class, else the class of the ending."""

    def __init__(self, labels, classes):
        super().__init__(labels)
        self.first = classes + 1
        self[END] = classes
        self.fixed = len(self)

    def __missing__(self, word):
        return self.first + ending(word)


SIZE = CLASSES + 1 + ENDINGS


class Model:
    """What a task needs to score: bounded by the parameters above, whatever the corpus.

    ``classes`` and ``frequent`` have class and count of the words that travel with it; those of all others are
    in the table of counts.
    """

    def __init__(self, classes, frequent, class_tokens, class_words, total, distinct):
        self.classes, self.frequent, self.total, self.distinct = classes, frequent, total, distinct
        # one more word per class stands for all words not seen
        self.class_log = np.log10(class_tokens + ADD * (class_words + 1))
        self.moves = None

    def learn(self, transitions):
        uni = (transitions.sum(axis=0) + 1.0) / (transitions.sum() + len(transitions))
        sums = transitions.sum(axis=1, keepdims=True)
        rows = np.where(sums > 0, transitions / np.maximum(sums, 1), uni)
        self.moves = np.log10((1 - MIX) * rows + MIX * uni)
        return self

    def base(self, n):
        return math.log10((n + 1) / (self.total + self.distinct + 1))

    def emission(self, n, k):
        return math.log10(n + ADD) - self.class_log[k]


def lexicon(texts):
    """The model but for its transitions, and the table (word, n, k) of a one-column table of training texts."""
    spark = texts.sparkSession
    counted = staged(word_counts(texts))
    totals = counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    floor = -(-totals["n"] // SHARE)
    often = small_rows(counted.filter((F.col("n") >= floor) & (F.length("word") <= LONGEST_FREQUENT) & (F.col("word") != F.lit(END))), SHARE)
    often = sorted(((bytes(r["word"]), r["n"]) for r in often), key=lambda r: (-r[1], r[0]))
    labels, onto = clustered(texts, [w for w, _ in often]) if often else ({}, np.zeros((0, 0)))
    shared = spark.sparkContext.broadcast({**labels, END: CLASSES})
    around = map_batches(texts, lambda it: _around(it, shared.value), "word binary, n long, cells binary")
    parts = max(spark.sparkContext.defaultParallelism, totals["v"] // WORDS + 1)
    others = map_batches(around.repartition(parts, "word"), lambda it: _assigned(it, onto), "word binary, n long, k int")
    ends = counted.filter(F.col("word") == F.lit(END)).select("word", "n", F.lit(CLASSES).alias("k"))
    exchanged_ = spark.createDataFrame([(w, n, labels[w]) for w, n in often], "word binary, n long, k int")
    counts = staged(others.unionAll(exchanged_).unionAll(ends))
    rows = small_rows(counts.groupBy("k").agg(F.sum("n").alias("tokens"), F.count("*").alias("words")), SIZE)
    class_tokens, class_words = np.zeros(SIZE), np.zeros(SIZE)
    for r in rows:
        class_tokens[r["k"]], class_words[r["k"]] = r["tokens"], r["words"]
    known = {**{w: (n, k) for w, n, k in frequent_words(counts, also=("k",))}, **{w: (n, labels[w]) for w, n in often}}
    return Model({w: k for w, (_, k) in known.items()}, {w: n for w, (n, _) in known.items()},
                 class_tokens, class_words, totals["n"], totals["v"]), counts


def _encoded(batches, shared):
    """Sums over the words that travel with the model, classes of all tokens, and the words that have none there."""
    model = shared.value
    numbers = {w: i for i, w in enumerate(model.frequent)}
    of = Classes(model.classes, CLASSES)
    classes = np.array([of[w] for w in numbers] + [UNKNOWN], np.uint8)  # the last one serves all other words
    base_of = np.array([model.base(n) for n in model.frequent.values()] + [0.0])
    emission_of = np.array([model.emission(n, k) for n, k in zip(model.frequent.values(), classes.tolist())] + [0.0])
    numbers, none = _Numbers(numbers), len(numbers)
    for batch in slices(batches):
        tokens, ends = [], []
        for text in batch.column(batch.num_columns - 1).to_pylist():
            tokens += tokens_of(text or "")
            ends.append(len(tokens))
        ids = np.fromiter(map(numbers.__getitem__, tokens), np.int64, len(tokens))
        starts = np.array([0, *ends[:-1]], np.int64)
        lengths = np.array(ends, np.int64) - starts
        rare = np.flatnonzero(ids == none)
        offsets = np.searchsorted(rare, [0, *ends]).astype(np.int32)
        seen = np.add.reduceat((ids != none).astype(np.int64), starts)
        words = pa.StructArray.from_arrays([
            pa.array([tokens[i] for i in rare.tolist()], pa.binary()),
            pa.array((rare - np.repeat(starts, np.diff(offsets))).astype(np.int32))], ["word", "at"])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(lengths), pa.array(seen), pa.array(np.add.reduceat(base_of[ids], starts)),
             pa.array(np.add.reduceat(emission_of[ids], starts)), _binaries(classes[ids], [0, *ends]),
             pa.ListArray.from_arrays(pa.array(offsets), words)],
            [*batch.schema.names[:-1], "n_tokens", "n_known", "base_score", "emission", "seq", "rare"])


class _Numbers(dict):
    def __missing__(self, word):
        return self.none

    def __init__(self, numbers):
        super().__init__(numbers)
        self.none = len(numbers)


def _binaries(data, offsets):
    return pa.BinaryArray.from_buffers(pa.binary(), len(offsets) - 1, [
        None, pa.py_buffer(np.array(offsets, np.int32)), pa.py_buffer(np.ascontiguousarray(data, np.uint8))])


def _sequences(column):
    """All bytes of a binary column and where its rows begin."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]], offsets[:-1] - offsets[0]


def _filled(batches):
    """The classes found by the join, ``at * 256 + k`` each, put in their places."""
    for batch in slices(batches):
        if batch.num_rows:
            *rest, seq, places = batch.columns
            data, starts = _sequences(seq)
            data = data.copy()
            found, sizes = places.flatten().to_numpy(), pc.fill_null(pc.list_value_length(places), 0).to_numpy()
            data[np.repeat(starts, sizes) + (found >> 8)] = found & 255
            yield pa.RecordBatch.from_arrays([*rest, _binaries(data, [*starts.tolist(), len(data)])], batch.schema.names[:-1])


def _ending_class(word):
    """``Classes`` of a word that has none, in SQL."""
    size = F.length(word)
    value = (size > 6).cast("long")
    for back in (2, 1, 0):
        byte = F.conv(F.hex(F.expr(f"substring({word}, length({word}) - {back}, 1)")), 16, 10).cast("long")
        value = F.when(size > back, value * 131 + byte).otherwise(value)
    return (CLASSES + 1 + value * 40503 % 65521 % ENDINGS).cast("int")


def encode(df, model, counts, text="text", keys=("doc_id",)):
    """``keys``, ``n_tokens``, ``n_known``, ``base_score``, ``emission`` and the classes ``seq`` of every row of ``df``, staged.

    Rows get a number of their own, so those that share an identifier stay apart.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    kinds = "".join(f"`{k}` {df.schema[k].dataType.simpleString()}, " for k in keys)
    figures = kinds + "n_tokens long, n_known long, base_score double, emission double, seq binary"
    frame = df.select(*[f"`{k}`" for k in keys], F.col(text).alias("__text"))
    first = map_batches(frame, lambda it: _encoded(it, shared), figures + ", rare array<struct<word:binary, at:int>>")
    first = staged(first.withColumn("__row", F.monotonically_increasing_id()))
    places = first.select("__row", F.inline("rare")).join(counts, "word", "left")
    n, k = F.coalesce("n", F.lit(0)), F.coalesce("k", _ending_class("word"))
    places = places.select("__row", "at", n.alias("n"), k.alias("k"))
    n, class_log = F.col("n"), F.array(*[F.lit(float(x)) for x in model.class_log])
    sums = places.groupBy("__row").agg(
        F.sum(F.when(n > 0, 1).otherwise(0)).alias("__known"),
        F.sum(F.log10((n + 1) / F.lit(float(model.total + model.distinct + 1)))).alias("__base"),
        F.sum(F.log10(n + F.lit(ADD)) - F.get(class_log, F.col("k"))).alias("__emission"),
        F.collect_list(F.col("at").cast("long") * 256 + F.col("k")).alias("__places"))
    joined = first.drop("rare").join(sums, "__row", "left").select(
        *[f"`{k}`" for k in keys], "n_tokens", *[(F.col(a) + F.coalesce(F.col(b), F.lit(0))).alias(a) for a, b in (
            ("n_known", "__known"), ("base_score", "__base"), ("emission", "__emission"))], "seq", "__places")
    return staged(map_batches(joined, _filled, figures))


def transitions(encoded):
    """(class, class) counts of neighbouring tokens of encoded texts; a text begins after an end."""
    def count(batches):
        counts = np.zeros(SIZE * SIZE, np.int64)
        for batch in slices(batches):
            if batch.num_rows:
                now = _sequences(batch.column(0))[0].astype(np.int64)
                counts += np.bincount(np.concatenate([[CLASSES], now[:-1]]) * SIZE + now, minlength=len(counts))
        cells = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(counts[cells], pa.int64())], ["cell", "n"])

    out = np.zeros(SIZE * SIZE, np.int64)
    for row in small_rows(map_batches(encoded.select("seq"), count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")), SIZE * SIZE):
        out[row["cell"]] = row["n"]
    return out.reshape(SIZE, SIZE)


def scored(encoded, model, keys=("doc_id",)):
    """``keys``, ``n_tokens``, ``n_known``, ``base_score`` and ``score`` of encoded rows."""
    moves = encoded.sparkSession.sparkContext.broadcast(model.moves)

    def run(batches):
        for batch in slices(batches):
            if batch.num_rows:
                data, starts = _sequences(batch.column(batch.num_columns - 1))
                now = data.astype(np.int64)
                score = np.add.reduceat(moves.value[np.concatenate([[CLASSES], now[:-1]]), now], starts)
                score += batch.column(batch.num_columns - 2).to_numpy()
                yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(score)], [*batch.schema.names[:-2], "score"])

    kinds = "".join(f"`{k}` {encoded.schema[k].dataType.simpleString()}, " for k in keys)
    return map_batches(encoded.select(*[f"`{k}`" for k in keys], "n_tokens", "n_known", "base_score", "emission", "seq"), run,
                       kinds + "n_tokens long, n_known long, base_score double, score double")


def fit(texts):
    """Model and table (word, n, k) of a one-column table of training texts (null: empty)."""
    model, counts = lexicon(texts)
    return model.learn(transitions(encode(texts, model, counts, texts.columns[0], ()))), counts


def score(df, model, counts, text="text", keys=("doc_id",)):
    """``keys``, ``n_tokens``, ``n_known``, ``base_score`` and ``score`` of every row of ``df``."""
    return scored(encode(df, model, counts, text, keys), model, keys)


def fit_and_score(df, train, text="text", keys=("doc_id",)):
    """Model of the rows of ``df`` where the column ``train`` is true, and the scores of all its rows; texts are encoded once."""
    model, counts = lexicon(df.filter(train).select(text))
    encoded = encode(df, model, counts, text, (*keys, train))
    model.learn(transitions(encoded.filter(train)))
    return model, scored(encoded, model, keys)


def perplexity(score_column, tokens):
    """Per-token perplexity from a log10 probability."""
    return F.pow(F.lit(10.0), -F.col(score_column) / F.col(tokens))
