"""What the text operators share: mapping Arrow batches, staged tables, ranges of identifiers."""

import os
import zlib

import pyarrow as pa
from pyspark.sql import functions as F

from panelloom.session import ship_package, stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def vocabulary(name):
    """Path of a published tokenizer file, in ``TOKENIZER_FOLDER`` if that is set; the driver reads it."""
    folder = os.environ.get("TOKENIZER_FOLDER")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers
    return str(public_tokenizers.path(name))


def map_batches(df, fn, schema):
    """``mapInArrow`` over batches of bounded size, with the package shipped first."""
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


def texts_of(column):
    """The texts of an Arrow column as Python strings; null becomes the empty text."""
    return [x or "" for x in column.to_pylist()]


def slices(batches, rows=512, nbytes=1 << 23):
    """Cut Arrow batches into smaller ones, by rows and by bytes, to bound what a worker holds."""
    for batch in batches:
        n = batch.num_rows
        step = max(1, min(rows, int(n * nbytes / max(batch.nbytes, 1)) or 1)) if n else 1
        for at in range(0, n, step):
            yield batch.slice(at, step)


def list_array(values, counts, kind):
    """Arrow list array from flat numpy values and the number of values per row."""
    offsets = [0]
    for n in counts:
        offsets.append(offsets[-1] + n)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def ascii_lower(text):
    """A-Z to lower case and nothing else; ``lower`` does just that where all is ASCII."""
    text = F.col(text) if isinstance(text, str) else text
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))


def id_remainder(doc_id, modulus):
    """crc32 of the id as text, modulo; the documented split into training and held-out rows."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus


def py_id_remainder(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus


def staged(df):
    """A table in the shared folder, read back; see ``panelloom.session.stage``."""
    return stage(df)


def small_rows(df, limit):
    """Rows of a table whose size is bounded by a model parameter, checked before they come."""
    rows = df.take(limit + 1)
    if len(rows) > limit:
        raise ValueError(f"expected at most {limit} rows")
    return rows


def ordered_buckets(df, key, count):
    """``df`` with ``__k`` (the key, null as the least value) and ``__bucket``: ranges of the key in order.

    The range ends come from a quantile sketch of the key column alone, so the rest of ``df`` is
    not computed twice as it would be by the sampling of a range partitioning.
    """
    least = -(1 << 63)
    keyed = df.withColumn("__k", F.coalesce(F.col(key).cast("long"), F.lit(least)))
    shares = [i / count for i in range(1, count)]
    ends = keyed.agg(F.approx_percentile("__k", shares, 10_000)).first()[0] if shares else []
    ends = sorted({e for e in ends or []})
    if not ends:
        return keyed.withColumn("__bucket", F.lit(0))
    return keyed.withColumn("__bucket", F.size(F.filter(F.lit(ends).cast("array<bigint>"), lambda e: e < F.col("__k"))))


def bucket_count(spark):
    return max(1, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))


def set_apart(df, names=None):
    """``df`` with its columns (or ``names`` of them) as ``c0``, ``c1``, ... between marks, and name -> new name.

    For operators that carry all columns along: no name of theirs can clash with a name of the operator.
    """
    new = {c: f"__c{k}__" for k, c in enumerate(df.columns if names is None else names)}
    return df.select(*[F.col(f"`{c}`").alias(n) for c, n in new.items()]), new


def computed(df, name, expression):
    """Add a column that is computed once per row.

    A filter or a further projection may be merged with a plain alias, and the expression then
    stands in its place, possibly at every element of a lambda; what a generator returns stays.
    """
    return df.select("*", F.explode(F.array(expression)).alias(name))
