"""Benchmark passages in training texts, by a positional inverted index.

Words are lower-cased runs of ASCII letters and digits and of all non-ASCII characters. A window
is ``WINDOW`` consecutive words of an item; a shorter item is one window. A document word inside
an occurrence of any window is hit.

The index: how often each benchmark term occurs in the documents; then, per window, its rarest
and second rarest term; and for these terms the postings (term, document, position), stored as a
table. A posting less its term's offset in the item is a shift; the lists of the two terms are
intersected per (document, item, shift). What is left is checked word by word in the text. The same
lists give the proximity matches: a window's two terms within ``WINDOW`` words, in any order. Every
step is a join or an aggregate over columns; no Python runs on the rows.

Cases: null texts and texts without words have no words and no hits; items without words or
without an identifier are ignored; repeated items count once, items that share an identifier
count as one; repeated rows are each treated alike, a null document identifier like any other.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from panelloom.llm.common import ascii_lower, computed, set_apart, staged

WINDOW = 13
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SHARE = 20  # contaminated from one hit word in so many


def words(text):
    """Array of the words of a text column."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS, -1), "")


def _items(benchmark, item_id, text, window):
    """(item, id, w: words, n: window length) of the distinct items that have words."""
    rows = benchmark.select(F.col(item_id).cast("string").alias("id"), F.col(text).alias("t")).dropna().distinct()
    return rows.select(F.xxhash64("id", "t").alias("item"), "id", words(F.col("t")).alias("w")).filter(
        F.size("w") > 0).withColumn("n", F.least(F.size("w"), F.lit(window)))


def _placed(docs, doc_id, text):
    """(i: id, t: hash of the text, at, term) of every word of every document."""
    return docs.select(F.col(doc_id).alias("i"), F.xxhash64(text).alias("t"),
                       F.posexplode(words(F.col(text))).alias("at", "term"))


class Index:
    """The tables of one benchmark against one set of documents."""

    def __init__(self, docs, benchmark, doc_id="doc_id", text="text", item_id="item_id", item_text="text",
                 window=WINDOW):
        self.items = staged(_items(benchmark, item_id, item_text, window))
        terms = self.items.select("item", "n", F.size("w").alias("size"), F.posexplode("w").alias("p", "term"))
        vocabulary = staged(terms.select("term").distinct())
        placed = _placed(docs, doc_id, text)
        self.frequency = staged(placed.select("term").join(vocabulary, "term", "left_semi").groupBy("term").agg(
            F.count("*").alias("f")))
        # a window's rarest terms; a window with a term that never occurs cannot occur
        rated = terms.join(self.frequency, "term", "left").withColumn("f", F.coalesce("f", F.lit(0)))
        first = F.greatest(F.col("p") - F.col("n") + 1, F.lit(0))
        last = F.least(F.col("p"), F.col("size") - F.col("n"))
        inside = rated.withColumn("s", F.explode(F.sequence(first, last)))
        order = Window.partitionBy("item", "s").orderBy("f", "p")
        ranked = inside.withColumn("k", F.row_number().over(order)).filter("k <= 2")
        self.windows = staged(
            ranked.groupBy("item", "s").agg(
                F.min("f").alias("f"), F.min_by("p", "k").alias("p1"), F.max_by("p", "k").alias("p2"))
            .filter("f > 0"))
        chosen = self.windows.select("item", F.explode(F.array("p1", "p2")).alias("p")).distinct()
        self.anchors = staged(terms.join(chosen, ["item", "p"]).select("item", "p", "term"))
        wanted = staged(self.anchors.select("term").distinct())
        self.postings = staged(placed.join(wanted, "term", "left_semi"))

    def alignments(self):
        """(i, t, item, shift, ps): where item positions ``ps`` meet their terms in a document."""
        met = self.postings.join(self.anchors, "term").select(
            "i", "t", "item", "p", (F.col("at") - F.col("p")).alias("shift"))
        return met.groupBy("i", "t", "item", "shift").agg(F.collect_set("p").alias("ps"))

    def candidates(self):
        """Per document the windows whose two rarest terms stand at the right distance."""
        several = self.windows.groupBy("item").agg(F.collect_list(F.struct("s", "p1", "p2")).alias("ws"))
        left = self.alignments().join(several, "item").select(
            "i", "t", "item", "shift",
            F.explode(F.expr("filter(ws, x -> array_contains(ps, x.p1) and array_contains(ps, x.p2))")).alias("x"))
        found = left.join(self.items.select("item", "id", "w", "n"), "item").select(
            "i", "t", "id", (F.col("shift") + F.col("x.s")).alias("start"),
            F.expr("slice(w, x.s + 1, n)").alias("w")).filter("start >= 0")
        return found.groupBy("i", "t").agg(F.collect_set(F.struct("id", "start", "w")).alias("__found"))


def phrase_hits(docs, benchmark, doc_id="doc_id", text="text", item_id="item_id", item_text="text", window=WINDOW):
    """``docs`` with ``n_words``, ``n_hit``, ``items`` (identifiers as sorted strings), ``contaminated``, ``near``.

    ``near`` is the number of items with a proximity match (``near_items``).
    """
    index = Index(docs, benchmark, doc_id, text, item_id, item_text, window)
    near = near_items(index, window).groupBy("i", "t").agg(F.count("*").alias("__near"))
    exact = index.candidates()
    found = staged(near.join(exact.withColumnsRenamed({"i": "__ei", "t": "__et"}),
                             F.col("i").eqNullSafe(F.col("__ei")) & (F.col("t") == F.col("__et")), "left").drop("__ei", "__et"))
    new = ("n_words", "n_hit", "items", "contaminated", "near")
    apart, own = set_apart(docs)
    kept = [c for c in docs.columns if c not in new]
    joined = apart.withColumn("__h", F.xxhash64(own[text])).join(
        found, F.col(own[doc_id]).eqNullSafe(F.col("i")) & (F.col("__h") == F.col("t")), "left")
    split = computed(joined, "__w", words(F.col(own[text])))
    checked = computed(split, "__hits", F.expr(
        "filter(coalesce(__found, array()), c -> slice(__w, c.start + 1, size(c.w)) = c.w)"))
    covered = F.expr("size(array_distinct(flatten(transform(__hits, h -> sequence(h.start, h.start + size(h.w) - 1)))))")
    counted = checked.select(
        *[F.col(own[c]).alias(c) for c in kept], F.size("__w").cast("long").alias("n_words"), covered.cast("long").alias("n_hit"),
        F.expr("array_sort(array_distinct(transform(__hits, h -> h.id)))").alias("items"),
        F.coalesce("__near", F.lit(0)).cast("long").alias("near"))
    return counted.withColumn("contaminated", (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words")))


def near_items(index, within=WINDOW):
    """(i, t, id): the items of which a window's two rarest terms stand within ``within`` words, in any order.

    A window of one word is met by that word; two places of one term must be two places. The terms are
    those that the phrase search starts from, so every phrase match is a proximity match. A document's
    places of a term are one sorted list, and two lists are merged, so no pair of places is formed.
    """
    places = staged(index.postings.groupBy("i", "t", "term").agg(F.array_sort(F.collect_list("at")).alias("ps")))
    one, two = (index.anchors.select("item", F.col("p").alias(f"p{k}"), F.col("term").alias(f"t{k}")) for k in (1, 2))
    pairs = index.windows.join(one, ["item", "p1"]).join(two, ["item", "p2"]).join(
        index.items.select("item", "id"), "item").select("id", F.least("t1", "t2").alias("t1"), F.greatest("t1", "t2").alias("t2"),
                                                         (F.col("p1") == F.col("p2")).alias("alone")).distinct()
    pairs = staged(pairs)
    asked = pairs.select("t1", "t2", "alone").distinct()
    first = places.withColumnsRenamed({"term": "t1", "ps": "ps1"}).join(asked, "t1")
    second = places.withColumnsRenamed({"i": "i2", "t": "h2", "term": "t2", "ps": "ps2"})
    both = first.join(second, first["i"].eqNullSafe(second["i2"]) & (first["t"] == second["h2"]) & (first["t2"] == second["t2"])).select(
        "i", "t", "t1", first["t2"], "alone", "ps1", "ps2")
    # the least distance of two merged lists is one between neighbours; a place is doubled, the second list's are odd
    met = computed(both, "m", F.when(F.col("t1") == F.col("t2"), F.transform("ps1", lambda a: 4 * a)).otherwise(F.array_sort(F.concat(
        F.transform("ps1", lambda a: 2 * a), F.transform("ps2", lambda a: 2 * a + 1)))))
    close = F.expr(f"""alone or (size(m) > 1 and exists(sequence(1, size(m) - 1), k ->
        if(t1 = t2, m[k] - m[k - 1] < 4 * {within}, m[k] % 2 <> m[k - 1] % 2 and m[k] div 2 - m[k - 1] div 2 < {within})))""")
    return met.filter(close).join(pairs, ["t1", "t2", "alone"]).select("i", "t", "id").distinct()
