"""The registered queries of the text operators, and their SQL where SQL can say it."""

from pyspark.sql import functions as F

from panelloom.llm import bpe, brown, decontam, langid, lattice, licenses, lines, merkle, omh, pii, ranking, repair, whitening
from panelloom.llm.common import id_remainder


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _sha(text):
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def op1_bpe(spark, sf_dir):
    """Token ids of every text and the text decoded from them."""
    docs = _table(spark, sf_dir, "documents")
    return bpe.encode_decode(docs).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        _sha(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"),
        _sha(F.col("decoded")).alias("decoded_sha256"))


def op2_language(spark, sf_dir):
    """Language of every text, learned from the rows that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(~langid.held_out()))
    return langid.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(langid.held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")


def op3_order_minhash(spark, sf_dir):
    """Class of near copies of every document."""
    return omh.near_duplicates(_table(spark, sf_dir, "documents"))


def op4_brown_lm(spark, sf_dir):
    """Log probability of every text under the class bigram model and under the base."""
    docs = _table(spark, sf_dir, "documents")
    test = F.coalesce(id_remainder("doc_id", 7) == 2, F.lit(False))
    model, scored = brown.fit_and_score(docs.select("doc_id", "text", (~test).alias("train")), "train")
    return scored.select(
        "doc_id", test.alias("held_out"), "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"),
        "base_score", "score", brown.perplexity("score", "n_tokens").alias("perplexity"))


def op5_line_dedup(spark, sf_dir):
    """Lines that repeat across documents dropped."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", _sha(F.col("text")).alias("kept_sha256"))


def op6_merkle(spark, sf_dir):
    """Fingerprints of every text and of its edited text."""
    return merkle.compare_with_next(_table(spark, sf_dir, "documents"))


def op7_token_files(spark, sf_dir):
    """Token ids written to compressed shards and read back."""
    return repair.write_and_read(_table(spark, sf_dir, "documents"))


def op8_pii(spark, sf_dir):
    """Personal data of every text."""
    found = pii.find(_table(spark, sf_dir, "documents"))
    names = "element_at(array('email', 'ip', 'card', 'phone'), s.kind + 1)"

    def written(column):
        return F.expr(f"array_join(transform({column}, s -> concat_ws(':', {names}, s.start, s.end)), ',')")

    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = {k})) as long)").alias(f"n_{name}")
              for k, name in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, _sha(written("base")).alias("base_sha256"), written("spans").alias("spans"))


def op9_license_scan(spark, sf_dir):
    """License notices of every text: per document and license the places and the best match."""
    found = licenses.scan(_table(spark, sf_dir, "documents"))
    return found.groupBy("doc_id", "license").agg(
        F.countDistinct("start").alias("n_places"), F.min("start").alias("first_word"),
        F.max("containment").alias("containment"))


def op10_decontamination(spark, sf_dir):
    """Benchmark windows in every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.phrase_hits(docs, _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        _sha(F.array_join("items", ",")).alias("items_sha256"), "contaminated", F.col("near").alias("n_near"))


def op11_whitening(spark, sf_dir):
    """The first components of every usable vector, whitened over all of them."""
    out, model, error = whitening.whiten(_table(spark, sf_dir, "embeddings"))
    n = model.centre.n if model else 0
    explained = model.explained.tolist()[:whitening.COMPONENTS] if model else []
    shares = F.array(*[F.lit(e) for e in explained]) if explained else F.array().cast("array<double>")
    return out.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"),
        F.expr("try_cast(deviation as bigint)").alias("deviation"), "whitened",
        F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))


def op12_bag_ranking(spark, sf_dir):
    """The best documents of every benchmark item."""
    return ranking.best_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_lattice_dedup(spark, sf_dir):
    """Near-duplicate links and components of every vector."""
    return lattice.near_duplicates(_table(spark, sf_dir, "embeddings"))


def pipeline(spark, sf_dir):
    """The corpus pipeline at the top of the repository."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_bpe, op2_language, op3_order_minhash, op4_brown_lm, op5_line_dedup, op6_merkle, op7_token_files,
    op8_pii, op9_license_scan, op10_decontamination, op11_whitening, op12_bag_ranking,
    op13_lattice_dedup, pipeline)}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORDS = ("list_filter(regexp_split_to_array(" + _LOWER.format("coalesce(text, '')") +
          r", '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')")

_TERMS = ("regexp_extract_all(" + _LOWER.format("coalesce(text, '')") +
          r", '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

ORACLE = {
    "op12_bag_ranking": f"""
WITH d AS (SELECT doc_id, {_TERMS} AS w FROM documents),
whole AS (SELECT count(*) AS big_n, CAST(sum(len(w)) AS BIGINT) AS big_l FROM d WHERE len(w) > 0),
q AS (SELECT item_id, t, count(*) AS qtf
      FROM (SELECT item_id, unnest({_TERMS}) AS t FROM benchmark) GROUP BY ALL),
tf AS (SELECT doc_id, t, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS t FROM d)
       WHERE t IN (SELECT t FROM q) GROUP BY ALL),
df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
wt AS (SELECT t, CAST(floor(1000 * ln((2 * big_n + 2) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS wt FROM df, whole),
m AS (SELECT doc_id, 75 + ((25 * len(w) * big_n) // big_l) AS m FROM d, whole WHERE len(w) > 0),
scored AS (SELECT item_id, doc_id, CAST(sum(qtf * wt * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
           FROM q JOIN wt USING (t) JOIN tf USING (t) JOIN m USING (doc_id) GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
WHERE rank <= 20""",
    "op5_line_dedup": f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
line AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM split),
keyed AS (SELECT *, {_LOWER.format(f"trim(line, {_SPACE})")} AS key FROM line),
repeated AS (SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20
             GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT k.*, r.key IS NOT NULL AND k.doc_id <> r.last AS dropped
           FROM keyed k LEFT JOIN repeated r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, CAST(count_if(dropped) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op10_decontamination": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS id, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT id, least(len(w), 13) AS n, array_to_string(w[s:s + least(len(w), 13) - 1], ' ') AS g
        FROM (SELECT id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
grams AS (SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS g
          FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, id, s, h.n FROM grams h JOIN win USING (n, g)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT doc_id, id FROM hits) GROUP BY doc_id),
place AS (SELECT doc_id, unnest(w) AS term, generate_subscripts(w, 1) AS at FROM d),
bw AS (SELECT id, s, s + k AS p, w[s + k] AS term
       FROM (SELECT id, w, s, unnest(range(0, least(len(w), 13))) AS k
             FROM (SELECT id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS s FROM b WHERE len(w) > 0))),
f AS (SELECT term, count(*) AS f FROM place WHERE term IN (SELECT term FROM bw) GROUP BY term),
rated AS (SELECT id, s, p, term, coalesce(f, 0) AS f, row_number() OVER (PARTITION BY id, s ORDER BY coalesce(f, 0), p) AS r
          FROM bw LEFT JOIN f USING (term)),
pairs AS (SELECT DISTINCT id, t1, t2, alone FROM (
          SELECT id, s, min(term) FILTER (r = 1) AS t1, coalesce(min(term) FILTER (r = 2), min(term) FILTER (r = 1)) AS t2,
                 count(*) = 1 AS alone, min(f) AS least FROM rated WHERE r <= 2 GROUP BY id, s) WHERE least > 0),
near AS (SELECT doc_id, count(DISTINCT id) AS n_near FROM (
          SELECT x.doc_id, id FROM pairs JOIN place x ON x.term = t1 JOIN place y ON y.term = t2 AND y.doc_id = x.doc_id
            AND (alone OR (abs(x.at - y.at) < 13 AND x.at <> y.at))) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated, coalesce(n_near, 0) AS n_near
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN near USING (doc_id)""",
}
