"""Language of texts by a linear-chain conditional random field over their words.

Each word gets one score per language from hashed features (character n-grams of two to four
over the word between boundary marks, so that prefixes and suffixes are among them, and the word
itself if it is in the lexicon); learned transitions tie neighbouring words. Forward-backward
gives every word's distribution over the languages, also in code-switched text. A text's
language is the one with the largest mean probability over its words; that mean is the score.

Fitting reads a bounded sample of labelled rows: about ``PER_LANGUAGE`` rows of each language,
chosen by a hash of the identifier among texts of up to ``LONGEST_FITTED`` characters (a language
of which there is no such text is not learned). Training chains are pieces of these texts joined
across languages, so the transitions see switches. Prediction reads every text whole, and a worker
holds the words of ``BYTES_AT_ONCE`` bytes of texts at a time, or of one longer text. ``certainty`` is
the mean over a text's words of their own best probability: it is high for a text of several
languages whose every word is clear.

Cases: a null text, or one without letters, is ``und`` with score 0; so is every text when there
is no labelled row. Rows repeat as they are; label, source and identifier are never inputs of a
prediction. Words are maximal runs of letters, lower-cased.
"""

import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from panelloom.llm.common import id_remainder, map_batches, slices, texts_of

PER_LANGUAGE = 250
LONGEST_FITTED = 20_000
BUCKETS = 1 << 17
LEXICON = 20_000
UNDETERMINED = "und"
FIND = re.compile(r"[^\W\d_]+").findall
#: words whose chains are worked on at once (one longer text goes alone), and bytes of text taken from a batch
WORDS_AT_ONCE = 1 << 17
BYTES_AT_ONCE = 1 << 20
FRESH_AT_ONCE = 1 << 13


def feature_rows(words):
    """(hashed n-gram positions, first position of each word) for a list of words."""
    text = "^" + "$^".join(words) + "$"
    c = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    starts = np.zeros(len(words), np.int64)
    np.cumsum(lengths[:-1], out=starts[1:])
    left = np.repeat(starts + lengths, lengths) - np.arange(len(c))  # characters up to the word's end
    rows = np.full((len(c), 3), BUCKETS, np.int64)
    h = c * np.uint64(0x9E3779B97F4A7C15)
    for k in (1, 2, 3):
        h = h[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + c[k:] * np.uint64(0x9E3779B97F4A7C15)
        mixed = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
        hashed = ((mixed >> np.uint64(40)) & np.uint64(BUCKETS - 1)).astype(np.int64)
        inside = left[:len(hashed)] > k
        rows[:len(hashed), k - 1] = np.where(inside, hashed, BUCKETS)
    return rows, starts


class Model:
    """Weights by feature and language, the lexicon, and the log transition scores."""

    def __init__(self, languages, lexicon):
        self.languages, n = list(languages), len(languages)
        self.lexicon = {w: i for i, w in enumerate(lexicon)}
        self.ngrams = np.zeros((BUCKETS + 1, n), np.float32)  # the last row stays zero
        self.whole = np.zeros((len(lexicon) + 1, n), np.float32)
        self.moves = np.zeros((n, n))

    def emissions(self, words):
        rows, starts = feature_rows(words)
        out = np.add.reduceat(self.ngrams[rows].sum(axis=1), starts, axis=0)
        none = len(self.lexicon)
        return out + self.whole[np.fromiter((self.lexicon.get(w, none) for w in words), np.int64, len(words))]


def forward_backward(scores, lengths, moves):
    """Marginals of many chains at once.

    ``scores`` holds the chains one after the other, longest first; step t works on the chains
    that are longer than t.
    """
    n, k = scores.shape
    starts = np.zeros(len(lengths), np.int64)
    np.cumsum(lengths[:-1], out=starts[1:])
    local = np.exp(scores - scores.max(axis=1, keepdims=True))
    step = np.exp(moves - moves.max())
    alpha = np.empty_like(local)
    longest = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(longest), side="left")  # chains longer than t
    now = np.full((len(lengths), k), 1.0 / k)
    for t in range(longest):
        m = active[t]
        at = starts[:m] + t
        now = (now[:m] @ step if t else now[:m]) * local[at]
        now /= now.sum(axis=1, keepdims=True)
        alpha[at] = now
    beta = np.ones((len(lengths), k))
    for t in range(longest - 1, -1, -1):
        m = active[t]
        at = starts[:m] + t
        here = beta[:m]
        alpha[at] *= here
        if t:
            back = (local[at] * here) @ step.T
            beta[:m] = back / back.sum(axis=1, keepdims=True)
    alpha /= alpha.sum(axis=1, keepdims=True)
    return alpha


def expected_counts(scores, moves):
    """Marginals (chains, length, languages) and expected transitions of chains of equal length."""
    n, length, k = scores.shape
    local = np.exp(scores - scores.max(axis=2, keepdims=True))
    step = np.exp(moves - moves.max())
    alpha, beta = np.empty_like(local), np.ones_like(local)
    for t in range(length):
        now = local[:, t] * (alpha[:, t - 1] @ step if t else 1.0)
        alpha[:, t] = now / now.sum(axis=1, keepdims=True)
    pairs = np.zeros((k, k))
    for t in range(length - 1, 0, -1):
        ahead = local[:, t] * beta[:, t]
        both = alpha[:, t - 1, :, None] * step * ahead[:, None, :]
        pairs += (both / both.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        back = ahead @ step.T
        beta[:, t - 1] = back / back.sum(axis=1, keepdims=True)
    marginal = alpha * beta
    return marginal / marginal.sum(axis=2, keepdims=True), pairs


def _chains(sample, rng, length, count):
    """Training chains of equal length from pieces of texts of changing language."""
    by = {}
    for language, words in sample:
        if words:
            by.setdefault(language, []).append(words)
    names = sorted(by)
    words, labels = [], []
    for _ in range(count):
        chain, marks = [], []
        language = names[rng.integers(len(names))]
        while len(chain) < length:
            source = by[language][rng.integers(len(by[language]))]
            size = int(rng.integers(5, length + 1))
            at = int(rng.integers(0, max(1, len(source) - size + 1)))
            piece = source[at:at + size][:length - len(chain)]
            chain += piece
            marks += [names.index(language)] * len(piece)
            language = names[rng.integers(len(names))]
        words.append(chain)
        labels.append(marks)
    return names, words, np.array(labels)


def train(sample, rounds=240, chains=48, length=40, rate=0.25, seed=7):
    """Fit by stochastic gradients (AdaGrad) on the chains' log likelihood.

    ``sample`` is a list of (language, words). The result depends on the sample alone.
    """
    sample = sorted((lang, words) for lang, words in sample)
    counts = {}
    for _, words in sample:
        for w in words:
            counts[w] = counts.get(w, 0) + 1
    lexicon = sorted((w for w, n in counts.items() if n > 1), key=lambda w: (-counts[w], w))[:LEXICON]
    languages = sorted({lang for lang, words in sample if words})
    model = Model(languages, lexicon)
    if len(languages) < 2:
        return model
    rng, k = np.random.default_rng(seed), len(languages)
    sums = [np.full_like(model.ngrams, 1e-3), np.full_like(model.whole, 1e-3)]
    move_sum = np.full((k, k), 1e-3)
    none = len(model.lexicon)
    for _ in range(rounds):
        _, words, labels = _chains(sample, rng, length, chains)
        flat = [w for chain in words for w in chain]
        scores = model.emissions(flat).astype(np.float64)
        marginal, pairs = expected_counts(scores.reshape(chains, length, k), model.moves)
        truth = np.eye(k)[labels]
        error = ((truth - marginal) / chains).reshape(-1, k)
        observed = np.einsum("ctk,ctl->kl", truth[:, :-1], truth[:, 1:])
        gradient = (observed - pairs) / chains
        move_sum += gradient ** 2
        model.moves += 0.1 * gradient / np.sqrt(move_sum)
        rows, starts = feature_rows(flat)
        spread = np.repeat(np.arange(len(flat)), np.diff(np.append(starts, len(rows))))
        index = np.fromiter((model.lexicon.get(w, none) for w in flat), np.int64, len(flat))
        for table, total, at, which, zero in (
                (model.ngrams, sums[0], rows.reshape(-1), np.repeat(spread, 3), BUCKETS),
                (model.whole, sums[1], index, np.arange(len(flat)), none)):
            used, inverse = np.unique(at, return_inverse=True)
            g = np.stack([np.bincount(inverse, error[which, j], len(used)) for j in range(k)], axis=1)
            g -= 1e-4 * table[used]
            g[used == zero] = 0
            total[used] += g ** 2
            table[used] += (rate * g / np.sqrt(total[used])).astype(np.float32)
    return model


class Predictor:
    """Words seen before keep their scores; the cache is dropped when it grows too large."""

    def __init__(self, model, limit=200_000):
        self.model, self.limit = model, limit
        self.reset()

    def reset(self):
        outer = self

        class Numbers(dict):
            def __missing__(self, word):
                number = self[word] = len(self)
                outer.fresh.append(word)
                return number

        self.numbers, self.fresh, self.filled = Numbers(), [], 0
        self.known = np.zeros((1024, len(self.model.languages)))

    def scores(self, words):
        if len(self.numbers) > self.limit:
            self.reset()
        ids = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
        if self.fresh:
            more = self.filled + len(self.fresh)
            if more > len(self.known):  # grows by doubling
                room = np.zeros((max(more, 2 * len(self.known)), self.known.shape[1]))
                room[:self.filled] = self.known[:self.filled]
                self.known = room
            for at in range(0, len(self.fresh), FRESH_AT_ONCE):  # their n-grams are what takes room
                some = self.fresh[at:at + FRESH_AT_ONCE]
                self.known[self.filled + at:self.filled + at + len(some)] = self.model.emissions(some)
            self.fresh, self.filled = [], more
        return self.known[ids]

    def predict(self, texts, with_runs=False):
        """Per text (language, score, certainty, runs): a run is (first word, words, language)."""
        out = [(UNDETERMINED, 0.0, 0.0, [])] * len(texts)
        if not self.model.languages:
            return out
        words = [FIND(t.lower()) for t in texts]
        order = sorted((i for i, w in enumerate(words) if w), key=lambda i: -len(words[i]))
        while order:
            took, size = 0, 0
            while took < len(order) and (not took or size + len(words[order[took]]) <= WORDS_AT_ONCE):
                size += len(words[order[took]])
                took += 1
            some, order = order[:took], order[took:]
            lengths = np.array([len(words[i]) for i in some])
            marginal = forward_backward(
                self.scores([w for i in some for w in words[i]]), lengths, self.model.moves)
            starts = np.cumsum(lengths) - lengths
            means = np.add.reduceat(marginal, starts, axis=0) / lengths[:, None]
            best = means.argmax(axis=1)
            clear = np.add.reduceat(marginal.max(axis=1), starts) / lengths
            for row, i in enumerate(some):
                runs = []
                if with_runs:
                    label = marginal[starts[row]:starts[row] + lengths[row]].argmax(axis=1)
                    cuts = [0, *(np.flatnonzero(np.diff(label)) + 1).tolist(), len(label)]
                    runs = [(a, b - a, self.model.languages[label[a]]) for a, b in zip(cuts, cuts[1:])]
                out[i] = (self.model.languages[best[row]], min(1.0, float(means[row, best[row]])), min(1.0, float(clear[row])), runs)
        return out


def labelled_sample(df, doc_id="doc_id", text="text", lang="lang", per_language=PER_LANGUAGE):
    """(language, words) of about ``per_language`` rows of each language, chosen by hash."""
    rows = df.select(F.col(doc_id).alias("i"), F.col(text).alias("t"), F.col(lang).alias("l")).filter(
        F.col("l").isNotNull() & F.col("t").isNotNull() & (F.length("t") <= LONGEST_FITTED))
    counts = {r["l"]: r["n"] for r in rows.groupBy("l").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return []
    draw = F.pmod(F.xxhash64(F.col("i").cast("string"), F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    share = F.create_map([x for k, n in counts.items() for x in (F.lit(k), F.lit(per_language / n))])
    chosen = rows.filter(draw < F.element_at(share, F.col("l"))).select("l", "t")
    # the draw gives the expected number; no repetition of identifiers may exceed it without bound
    first = chosen.orderBy(F.xxhash64("t"), "l").limit(2 * per_language * len(counts) + 100)
    return [(r["l"], FIND(r["t"].lower())) for r in first.collect()]


def fit(df, doc_id="doc_id", text="text", lang="lang", per_language=PER_LANGUAGE):
    return train(labelled_sample(df, doc_id, text, lang, per_language))


_PREDICTORS = {}


def _predicted(batches, shared, with_runs, at, keep):
    """Predictions of column ``at``; the first ``keep`` columns are passed on."""
    model, name = shared[0].value, shared[1]
    predictor = _PREDICTORS.get(name)
    if predictor is None:
        _PREDICTORS.clear()
        predictor = _PREDICTORS[name] = Predictor(model)
    run = pa.list_(pa.struct([("first", pa.int32()), ("words", pa.int32()), ("lang", pa.string())]))
    for batch in slices(batches, rows=8192, nbytes=BYTES_AT_ONCE):
        got = predictor.predict(texts_of(batch.column(at)), with_runs)
        columns = [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()),
                   pa.array([g[2] for g in got], pa.float64())]
        names = ["lang_pred", "score", "certainty"]
        if with_runs:
            columns.append(pa.array([[dict(zip(("first", "words", "lang"), r)) for r in g[3]] for g in got], run))
            names.append("runs")
        yield pa.RecordBatch.from_arrays([*batch.columns[:keep], *columns], [*batch.schema.names[:keep], *names])


def predict(df, model, text="text", keys=("doc_id",), runs=False):
    """``keys``, ``lang_pred``, ``score`` and ``certainty`` of every row; with ``runs`` also the labelled word runs."""
    shared = (df.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex)
    kinds = "".join(f"`{k}` {df.schema[k].dataType.simpleString()}, " for k in keys)
    schema = kinds + "lang_pred string, score double, certainty double" + (
        ", runs array<struct<first:int, words:int, lang:string>>" if runs else "")
    keys = list(keys)
    # the text goes to the workers once, also where it is a key itself
    sent = [F.col(f"`{k}`") for k in keys] + ([] if text in keys else [F.col(f"`{text}`").alias("__text")])
    at = keys.index(text) if text in keys else len(keys)
    return map_batches(df.select(*sent), lambda it: _predicted(it, shared, runs, at, len(keys)), schema)


def held_out(doc_id="doc_id"):
    return id_remainder(doc_id, 4) == 2
