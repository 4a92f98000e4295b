"""Removal of lines that repeat across documents.

A line's key is the line without ASCII white space at its ends, A-Z lower-cased. Keys of at
least ``MIN_CHARS`` characters in at least ``MIN_DOCUMENTS`` documents lose all their lines
except those in the largest identifier that holds them. The other lines stay, joined by ``\\n``.

Plan: lines are exploded, only the 128-bit hashes of long keys are shuffled; distinct documents
per hash are counted with map-side combining, so a line in a third of all documents meets no
single task. The keys to drop come back to the lines by a second join on the hash, and the
positions to drop to the texts by a join on the document; a text is rebuilt from the positions
that stay.

Cases: a null or empty text is one empty line and stays as it is. Rows of the same identifier are
one document for the counts; repeated rows are each treated alike. A null identifier counts as a
document, smaller than any other. Other columns pass through; ``n_lines``, ``n_dropped`` replace
columns of these names.
"""

from pyspark.sql import functions as F

from panelloom.llm.common import ascii_lower, set_apart, staged

MIN_CHARS = 20
MIN_DOCUMENTS = 3
SPACE = " \t\n\x0b\x0c\r"


def _exploded(df, doc_id, text, min_chars):
    """(id, row hash, position, key hash) of every line with a long key."""
    lines = df.select(
        F.col(doc_id).alias("i"), F.xxhash64(text).alias("t"),
        F.posexplode(F.split(F.coalesce(text, F.lit("")), "\n", -1)).alias("at", "line"))
    key = ascii_lower(F.btrim("line", F.lit(SPACE)))
    return lines.select("i", "t", "at", key.alias("key")).filter(F.length("key") >= min_chars).select(
        "i", "t", "at", F.unhex(F.md5("key")).alias("k"))


def repeated_lines(df, doc_id="doc_id", text="text", min_chars=MIN_CHARS, min_documents=MIN_DOCUMENTS):
    """``k`` (key hash), ``n`` documents and ``last``, the struct of the largest identifier."""
    lines = _exploded(df, doc_id, text, min_chars).select("k", F.struct("i").alias("i"))
    return lines.groupBy("k").agg(F.countDistinct("i").alias("n"), F.max("i").alias("last")).filter(
        F.col("n") >= min_documents)


def dedup_lines(df, doc_id="doc_id", text="text", min_chars=MIN_CHARS, min_documents=MIN_DOCUMENTS):
    """The rows of ``df`` with the text deduplicated, ``n_lines`` (before) and ``n_dropped``."""
    repeated = staged(repeated_lines(df, doc_id, text, min_chars, min_documents))
    drops = (
        _exploded(df, doc_id, text, min_chars).join(repeated, "k")
        .filter(~F.col("last.i").eqNullSafe(F.col("i")))
        .groupBy("i", "t").agg(F.collect_set("at").alias("__drops")).withColumnsRenamed({"i": "__i", "t": "__t"}))
    kept = [c for c in df.columns if c not in ("n_lines", "n_dropped")]
    apart, own = set_apart(df, kept)
    joined = apart.withColumn("__h", F.xxhash64(own[text])).join(
        drops, F.col(own[doc_id]).eqNullSafe(F.col("__i")) & (F.col("__h") == F.col("__t")), "left")
    split = joined.withColumn("__lines", F.split(F.coalesce(own[text], F.lit("")), "\n", -1))
    n = F.size("__lines")
    stay = F.array_except(F.sequence(F.lit(0), n - 1), F.col("__drops"))
    rebuilt = F.array_join(F.transform(stay, lambda i: F.get("__lines", i)), "\n")
    out = F.when(F.col("__drops").isNull(), F.col(own[text])).otherwise(rebuilt)
    return split.select(
        *[(out if c == text else F.col(own[c])).alias(c) for c in kept],
        n.cast("long").alias("n_lines"),
        F.when(F.col("__drops").isNull(), 0).otherwise(F.size("__drops")).cast("long").alias("n_dropped"))
