"""From raw documents to token ids, in stages that are each written and read again.

A stage takes (spark, docs, sf_dir) and returns a frame; all but the last return the columns of
``documents``. Every stage works on all rows that the one before kept.
"""

from pyspark.sql import functions as F

from panelloom.llm import bpe, decontam, langid, lines, omh
from panelloom.session import scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: a text over whose words the best language has less than this mean probability is rejected: its words
#: are of no language that is known. Words of several languages, each clear by itself, are kept.
LEAST_CERTAINTY = 0.4
ORACLE_SQL = None  # a trained model and sketches: tests/llm compares with brute force


def _columns(df):
    return df.select(*COLUMNS)


def language(spark, docs, sf_dir):
    """Rows in a recognised language; the label is the prediction.

    Rows without letters (null texts among them), and rows whose words are likely in no language, go;
    code-switched rows stay, with the language of most of their words. A table without labels has
    nothing to learn from: then rows with letters stay, labels as is.
    """
    model = langid.fit(docs.filter(~langid.held_out()))
    if not model.languages:
        return _columns(docs.filter(F.col("text").rlike(r"\p{L}")))
    known = langid.predict(docs, model, keys=("doc_id", "source", "text"))
    kept = known.filter((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("certainty") >= LEAST_CERTAINTY))
    return _columns(kept.withColumns({"lang": F.col("lang_pred"), "n_chars": F.length("text").cast("long")}))


def line_dedup(spark, docs, sf_dir):
    """Lines of other documents dropped; rows that lose all their lines go with them."""
    kept = lines.dedup_lines(docs).filter((F.col("n_dropped") < F.col("n_lines")))
    return _columns(kept.withColumn("n_chars", F.length("text").cast("long")))


def near_dedup(spark, docs, sf_dir):
    """One document of each class of near copies: that of the least identifier.

    Of rows that share this identifier one stays; rows without an identifier stay, unless they
    are copies of a row that has one.
    """
    classes = omh.near_duplicates(docs)
    key = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    stay = classes.filter(F.col("doc_id").eqNullSafe(F.col("class_id"))).select(key.alias("__key")).distinct()
    # the join deals the rows out by the key, which serves the removal of repeated rows as well
    kept = docs.withColumn("__key", key).join(stay, "__key", "left_semi")
    return _columns(kept.dropDuplicates(["__key", "text"]))


def decontamination(spark, docs, sf_dir):
    """Documents without a contaminating share of benchmark words.

    Rows without words stay, and so do all rows if there is no benchmark item; rows that repeat are judged alike.
    """
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return _columns(decontam.phrase_hits(docs, benchmark).filter(~F.col("contaminated")))


def tokens(spark, docs, sf_dir):
    """Token ids of what is left, a row per row; a null text has no ids."""
    coded = bpe.encode(docs, keys=("doc_id", "lang", "source"))
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language", language),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("tokens", tokens),
]


def run(spark, sf_dir):
    """All stages over ``documents``; each stage's result is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for _, stage in STAGES:
        path = scratch_path(spark)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
