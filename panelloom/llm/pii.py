"""Personal data in texts: fixed patterns, and bootstrapped contexts for what they miss.

The base kinds are found by their expressions, leftmost and without overlap per kind. They are
the seeds. Candidates are all other runs of tokens that hold a digit or an at sign, whatever their
shape, as long as they could be of the kind at all (``plausible``: enough digits, marks or letters).
The two words before and the word before with the word after are the lexical patterns of an instance.

Spark scores the graph of (pattern, instance) edges in rounds. A pattern's confidence for a kind is
the sum of its distinct instances' scores over their weights, smoothed: a seed of the kind scores 1
and a seed of another kind 0, either with weight 1; an instance that accepted patterns have reached
has their score (1 - product of 1 - confidence) and weight 1; an instance of which nothing is known
yet scores 0 with weight ``UNKNOWN``, so a context full of unlabelled numbers stays rejected, while
one in which most are seeds is accepted. A pattern is accepted from ``SUPPORT`` distinct seeds and
``CONFIDENCE`` on, and stays so; rounds go on until none is added. Instances that reach
``INSTANCE_SCORE`` become spans. Base spans always stay.

Every expression runs in linear time: where an alternative could start at each character of a
long run, the run is entered once, from its anchor ("@") or its first digit.

Cases: a null text counts as empty and has no spans; positions are code points, ends exclusive.
Rows with the same identifier keep their own spans; repeated rows count as one instance.
"""

import re

import pyarrow as pa
from pyspark.sql import functions as F

from panelloom.llm.common import map_batches, slices, staged

KINDS = ("email", "ip", "card", "phone")
SUPPORT = 5
SMOOTHING = 1.0
#: weight of an instance that no accepted pattern has reached
UNKNOWN = 0.5
CONFIDENCE = 0.8
INSTANCE_SCORE = 0.8
#: characters of the longest candidate; no identifier of these kinds is longer
LONGEST = 254

# fixed values: the base expressions; a digit before the start would belong to the same run
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]").search
NOT_DIGIT = re.compile(r"[^0-9]+")

TOKEN = re.compile(r"\S+").finditer
AT = ("@", "(at)", "[at]")
EDGES = ".,;:!?\"'`"


def luhn(digits):
    total = 0
    for at, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if at % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _local_start(text, at, least):
    start = at
    while start > least and text[start - 1] in LOCAL:
        start -= 1
    return start


def base_spans(text):
    """(kind number, start, end) of the base kinds, by start, then kind."""
    found = []
    if "@" in text:
        done = 0
        for m in DOMAIN.finditer(text):
            start = _local_start(text, m.start(), done)
            if start < m.start():
                done = m.end()
                found.append((0, start, done))
    if DIGIT(text):
        for m in IP.finditer(text):
            parts = m.group().split(".")
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in parts):
                found.append((1, *m.span()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = NOT_DIGIT.sub("", m.group())
                if 14 <= len(digits) <= 19 and luhn(digits):
                    found.append((2, *m.span()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= len(NOT_DIGIT.sub("", m.group())) <= 15:
                    found.append((3, *m.span()))
    found.sort(key=lambda s: (s[1], s[0]))
    return found


def plausible(kind, run):
    """Whether a run of tokens could be of a kind at all, whatever its shape."""
    digits = sum(c.isdigit() and c.isascii() for c in run)
    if kind == 0:
        return any(x in run for x in AT) and sum(c.isalpha() for c in run) >= 4
    if kind == 1:
        return 4 <= digits <= 12 and len(NOT_DIGIT.findall(run)) >= 3 and len(run) <= 40
    if kind == 2:
        return 14 <= digits <= 19 and luhn(NOT_DIGIT.sub("", run))
    return 7 <= digits <= 15 and 2 * digits >= len(run)


def _trimmed(text, start, end):
    """A run without marks at its ends; a bracket goes unless its partner is in the run."""
    while start < end:
        run = text[start:end]
        if run[-1] in EDGES or (run[-1] in ")]}" and run.count(run[-1]) > run.count("([{"[")]}".index(run[-1])])):
            end -= 1
        elif run[0] in EDGES or (run[0] in "([{" and run.count(run[0]) > run.count(")]}"["([{".index(run[0])])):
            start += 1
        else:
            break
    return start, end


def runs(text):
    """(start, end) of runs of tokens with digits, one space apart, and of tokens with an at sign."""
    out, begin, finish = [], None, None
    for m in TOKEN(text):
        token = m.group()
        if DIGIT(token):
            if begin is not None and m.start() == finish + 1 and text[finish] == " ":
                finish = m.end()
                continue
            if begin is not None:
                out.append((begin, finish))
            begin, finish = m.span()
        else:
            if begin is not None:
                out.append((begin, finish))
                begin = None
            if any(x in token for x in AT):
                out.append(m.span())
    if begin is not None:
        out.append((begin, finish))
    return out


def loose_spans(text, taken):
    """(kind number, start, end) of candidates that touch no base span."""
    if not DIGIT(text) and not any(x in text for x in AT):
        return []
    out, at = [], 0
    ends = sorted((s, e) for _, s, e in taken)
    for first, last in runs(text):
        while at < len(ends) and ends[at][1] <= first:
            at += 1
        if at < len(ends) and ends[at][0] < last:
            continue
        if last - first > LONGEST:
            continue
        start, end = _trimmed(text, first, last)
        out += [(kind, start, end) for kind in range(len(KINDS)) if plausible(kind, text[start:end])]
    return out


def _words_before(text, end, count):
    """The last ``count`` whole words before a position, looking back as far as needed."""
    reach = 64
    while True:
        start = max(0, end - reach)
        words = text[start:end].split()
        if start and not text[start - 1].isspace() and not text[start].isspace():
            words = words[1:]  # the first may be cut
        if len(words) >= count or not start:
            return words[-count:]
        reach *= 2


def _word_after(text, start):
    """The first whole word after a position."""
    reach = 64
    while True:
        words = text[start:start + reach].split(None, 1)
        if len(words) == 2 or start + reach >= len(text):
            return words[:1]
        if words and text[start:start + reach][-1].isspace():
            return words[:1]
        reach *= 2


def contexts(text, start, end):
    """Lexical patterns around a span: the two words before, and the words around."""
    left = [w.lower() for w in _words_before(text, start, 2)]
    right = [w.lower() for w in _word_after(text, end)]
    out = []
    if len(left) == 2:
        out.append("<< " + " ".join(left))
    if left and right:
        out.append("<> " + left[-1] + " _ " + right[0])
    return out


SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])
EDGE = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("seed", pa.bool_()),
                  ("instance", pa.string()), ("patterns", pa.list_(pa.string()))])


def _found(batches):
    for batch in slices(batches):
        spans, edges = [], []
        for text in batch.column(batch.num_columns - 1).to_pylist():
            text = text or ""
            base = base_spans(text)
            loose = loose_spans(text, base)
            spans.append([dict(zip(("kind", "start", "end"), s)) for s in base])
            edges.append([
                {"kind": k, "start": s, "end": e, "seed": seed, "instance": text[s:e], "patterns": contexts(text, s, e)}
                for some, seed in ((base, True), (loose, False)) for k, s, e in some])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(spans, pa.list_(SPAN)), pa.array(edges, pa.list_(EDGE))],
            [*batch.schema.names[:-1], "spans", "edges"])


def score_graph(edges):
    """Accepted (kind, instance) from edges (kind, instance, seed, pattern), by bootstrapping.

    Each round is a few aggregates and joins; a pattern with very many instances is summed with
    map-side combining, and its score reaches its edges by a join that adaptive execution splits.
    """
    edges = staged(edges.groupBy("kind", "pattern", "instance").agg(F.max("seed").alias("seed")))
    seeds = staged(edges.filter("seed").select("kind", "instance").distinct())
    # a seed of another kind speaks against the pattern's
    other = seeds.select(F.col("kind").alias("of"), "instance").join(edges.filter(~F.col("seed")), "instance").filter(
        "of <> kind").select("kind", "instance").distinct().withColumn("against", F.lit(True))
    marked = staged(edges.join(other, ["kind", "instance"], "left").join(
        seeds.withColumn("labelled", F.lit(True)), ["kind", "instance"], "left").select(
        "kind", "pattern", "instance", F.coalesce("labelled", F.lit(False)).alias("seed"), F.coalesce("against", F.lit(False)).alias("against")))
    score, known = None, 0
    while True:
        rated = marked.withColumn("score", F.lit(None).cast("double")) if score is None else marked.join(
            score, ["kind", "instance"], "left")
        worth = F.when(F.col("seed"), 1.0).when(F.col("against"), 0.0).otherwise(F.coalesce("score", F.lit(0.0)))
        weight = F.when(F.col("seed") | F.col("against") | F.col("score").isNotNull(), 1.0).otherwise(UNKNOWN)
        good = staged(rated.groupBy("kind", "pattern").agg(
            (F.sum(worth * weight) / (F.sum(weight) + SMOOTHING)).alias("confidence"), F.count_if("seed").alias("seeds")).filter(
            (F.col("seeds") >= SUPPORT) & (F.col("confidence") >= CONFIDENCE)))
        count = good.count()
        if count <= known:
            break
        known = count
        score = staged(marked.filter(~F.col("seed") & ~F.col("against")).join(good, ["kind", "pattern"]).groupBy("kind", "instance").agg(
            (1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9)))))).alias("score")))
    if score is None:
        return seeds.limit(0)
    return score.filter(F.col("score") >= INSTANCE_SCORE).select("kind", "instance")


def find(df, text="text", keys=("doc_id",)):
    """``keys``, ``base`` and ``spans``: arrays of (kind, start, end) sorted by start, then kind.

    ``kind`` counts in ``KINDS``. The texts are read once; what is found is staged and small.
    """
    frame = df.select(*[f"`{k}`" for k in keys], F.col(text).alias("__text"))
    kinds = "".join(f"`{k}` {df.schema[k].dataType.simpleString()}, " for k in keys)
    span = "struct<kind:int, start:bigint, end:bigint>"
    edge = "struct<kind:int, start:bigint, end:bigint, seed:boolean, instance:string, patterns:array<string>>"
    rows = staged(map_batches(frame, _found, kinds + f"spans array<{span}>, edges array<{edge}>").withColumn(
        "__row", F.monotonically_increasing_id()))
    loose = staged(rows.select("__row", F.inline("edges")).filter(~F.col("seed")))
    added = None
    if not loose.isEmpty():
        edges = rows.select(F.inline("edges")).select("kind", "instance", "seed", F.explode("patterns").alias("pattern"))
        # only patterns that touch a candidate can add something
        open_ = loose.select("kind", F.explode("patterns").alias("pattern")).distinct()
        accepted = score_graph(edges.join(open_, ["kind", "pattern"], "left_semi"))
        added = loose.join(accepted, ["kind", "instance"]).groupBy("__row").agg(
            F.collect_list(F.struct("kind", "start", "end")).alias("more"))
    base = F.col("spans")
    if added is None:
        return rows.select(*[f"`{k}`" for k in keys], base.alias("base"), base.alias("spans"))
    ordered = F.expr("transform(array_sort(transform(concat(spans, coalesce(more, array())), "
                     "s -> struct(s.start as start, s.kind as kind, s.end as end))), s -> struct(s.kind as kind, s.start as start, s.end as end))")
    return rows.join(added, "__row", "left").select(
        *[f"`{k}`" for k in keys], base.alias("base"), ordered.alias("spans"))
