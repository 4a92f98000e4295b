"""Panels and reports to files."""

import datetime
import json
import os
import time as clock
import uuid
from functools import reduce

from pyspark.sql import functions as F

from panelloom.functions.text import clean_symbol
from panelloom.operators.joins import new_rows_anti, upsert_panel
from panelloom.schema import KEY, TIME
from panelloom.session import stage


def write_panel(df, path, time=TIME):
    """Parquet, partitioned by year.

    The rebalance keeps a year's rows together in tasks of the advisory size: a small year gives
    one file, a large one is split over as many tasks as it needs.
    """
    dated = df.withColumn("year", F.year(time)).hint("rebalance", "year")
    dated.write.mode("overwrite").partitionBy("year").parquet(path)


def read_written(spark, path, first=None, last=None):
    """A written panel; with dates ``first`` or ``last`` only the years between them are listed."""
    df = spark.read.parquet(path)
    for bound, keep in ((first, lambda y: F.col("year") >= y), (last, lambda y: F.col("year") <= y)):
        if bound is not None:
            df = df.filter(keep(_day(bound).year))
    return df.drop("year")


def _day(value):
    return value if isinstance(value, datetime.date) else datetime.date.fromisoformat(str(value)[:10])


def write_report_csv(df, folder, as_of):
    """``<folder>/Y_M_D.csv`` (no zero padding), a directory of headed CSV parts."""
    day = _day(as_of)
    path = f"{folder}/{day.year}_{day.month}_{day.day}.csv"
    df.write.mode("overwrite").csv(path, header=True)
    return path


def append_exclusions(new, stored, key=KEY):
    """Distinct symbols of both lists, sorted."""
    both = new.select(clean_symbol(key).alias(key)).union(stored.select(clean_symbol(key).alias(key)))
    return both.dropna().filter(F.col(key) != "").distinct().orderBy(key)


def save_exclusions(new, path, key=KEY):
    """Append the symbols that the list at ``path`` does not hold; whether any were new.

    Nothing is written otherwise. The list is a folder that only grows; read it with
    ``read_exclusions``.
    """
    spark = new.sparkSession
    stored = read_exclusions(spark, path, key)
    fresh = append_exclusions(new, stored, key).join(stored, key, "left_anti")
    if fresh.isEmpty():
        return False
    fresh.coalesce(1).write.mode("append").parquet(path)
    return True


def read_exclusions(spark, path, key=KEY):
    """The list at ``path``, empty where there is no such folder; what cannot be read is an error."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], f"{key} string")
    return spark.read.parquet(path).select(key).distinct()


# --- versioned store: Spark cannot overwrite what it is reading ---------------------------
#
# Each write goes to a folder of its own name; a commit says which folder holds which year from this
# version on. A commit is a small file named by its version that is created only if there is none of
# that name, so of two writers that start from one version a single one gets the next number. The
# other reads what was committed meanwhile, merges anew if that touched its years, and tries the
# following number. Readers follow the commits: a folder without one is never seen, and years that a
# write does not touch keep their files.

COMMITS = "_commits"
COMMIT_SCHEMA = "version long, year int, folder string, of int, words long"
#: a written year's keys are kept as a Bloom filter as well: bits per key, and how many of them a key sets
KEYS, BITS, HASHES = "_keys", 10, 7
#: seconds after which a commit file that was created but never filled is taken for abandoned
ABANDONED = 30.0


def _file_system(spark, path):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark, path):
    at, fs = _file_system(spark, path)
    return fs.exists(at)


def _remove(spark, path):
    at, fs = _file_system(spark, path)
    fs.delete(at, True)


def create_once(spark, path, text):
    """Create a small file with its content unless the name is taken; whether it was created."""
    at, fs = _file_system(spark, path)
    if fs.getUri().getScheme() == "file":  # a link is made whole or not at all
        local = fs.makeQualified(at).toUri().getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        draft = f"{os.path.dirname(local)}/.{uuid.uuid4().hex}"
        with open(draft, "w") as file:
            file.write(text)
        try:
            os.link(draft, local)
        except FileExistsError:
            return False
        finally:
            os.unlink(draft)
        return True
    if fs.exists(at):
        return False
    try:
        out = fs.create(at, False)
    except Exception as error:  # the JVM's exception says whether another writer was first
        if fs.exists(at):
            return False
        raise error
    out.write(bytearray(text.encode()))
    out.close()
    return True


def commits(spark, root):
    """(version, year, folder) of all whole commits, None when nothing was committed."""
    if not path_exists(spark, f"{root}/{COMMITS}"):
        return None
    rows = spark.read.schema(COMMIT_SCHEMA).json(f"{root}/{COMMITS}").filter("folder IS NOT NULL")
    whole = rows.groupBy("version").agg(F.count("*").alias("n"), F.max("of").alias("of")).filter("n = of")
    return rows.join(whole.select("version"), "version", "left_semi").select("version", "year", "folder", "words")


def _state(spark, root):
    """(last version, {year: (version, folder, words of its key filter)}); the commits are a few rows per write."""
    known = commits(spark, root)
    if known is None:
        return 0, {}
    best = known.groupBy("year").agg(F.max(F.struct("version", "folder", "words")).alias("r"), F.max("version").alias("v")).collect()
    years = {row["year"]: tuple(row["r"]) for row in best if row["year"] is not None}
    return max((row["v"] for row in best), default=0), years


def current_years(spark, root):
    """{year: folder} as last committed."""
    return {year: folder for year, (_, folder, _) in _state(spark, root)[1].items()}


def latest_version(spark, root):
    return _state(spark, root)[0] or None


def open_store(spark, root, first=None, last=None):
    """The store as last committed, None when nothing was saved yet or no year is in reach."""
    years = current_years(spark, root)
    low, high = (None if x is None else _day(x).year for x in (first, last))
    wanted = [f"{root}/{folder}/year={year}" for year, folder in sorted(years.items())
              if (low is None or year >= low) and (high is None or year <= high)]
    return spark.read.parquet(*wanted) if wanted else None


def _written(df, root, version, time):
    """Write ``df`` to a fresh folder; (folder, {year: words of its key filter})."""
    spark = df.sparkSession
    folder = f"v{version}-{uuid.uuid4().hex[:12]}"
    write_panel(df, f"{root}/{folder}", time)
    written = spark.read.parquet(f"{root}/{folder}")
    words = {row["year"]: row["count"] * BITS // 64 + 1 for row in written.groupBy("year").count().collect()}
    set_bits = _key_bits(written, time, words)
    set_bits.groupBy("year", "word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).write.parquet(f"{root}/{folder}/{KEYS}")
    return folder, words


def _key_bits(rows, time, words, key=KEY):
    """The bits (word, bit) that each row's key sets in its year's filter of so many words; other years are left out."""
    known = {y: w for y, w in words.items() if y is not None}
    if not known:
        return rows.filter(F.lit(False)).select("*", F.lit(0).cast("long").alias("word"), F.lit(0).alias("bit"))
    size = F.create_map(*[F.lit(x) for y, w in known.items() for x in (y, 64 * w)])
    first, second = F.xxhash64(key, F.to_date(time)), F.xxhash64(F.lit(1), F.to_date(time), key)
    sized = rows.withColumns({"year": F.year(time), "__first": first, "__second": second})
    sized = sized.withColumn("__size", F.try_element_at(size, F.col("year")).cast("decimal(20,0)")).filter("__size IS NOT NULL")
    place = F.expr(f"transform(sequence(0, {HASHES - 1}), i -> cast(pmod(cast(__first as decimal(22,0)) + i * cast(__second as decimal(22,0)), __size) as long))")
    return sized.withColumn("__at", F.explode(place)).withColumns(
        {"word": F.expr("__at div 64"), "bit": F.expr("cast(__at % 64 as int)")}).drop("__first", "__second", "__size", "__at")


def _commit(spark, root, version, years, folder):
    rows = [{"version": version, "year": year, "folder": folder, "of": len(years), "words": words}
            for year, words in sorted(years.items(), key=str)]
    return create_once(spark, f"{root}/{COMMITS}/{version:012d}.json", "".join(json.dumps(row) + "\n" for row in rows))


def _settled(spark, root, version):
    """The state once commit ``version``, which exists, is whole or abandoned."""
    until = clock.monotonic() + ABANDONED
    while True:
        last, years = _state(spark, root)
        if last >= version or clock.monotonic() > until:
            return max(last, version), years
        clock.sleep(0.2)


def save_version(df, root, time=TIME):
    """Write the years of ``df`` to a new folder, then commit them whatever they held before."""
    spark = df.sparkSession
    version = _state(spark, root)[0] + 1
    folder, years = _written(df, root, version, time)
    while not _commit(spark, root, version, years, folder):
        version = _settled(spark, root, version)[0] + 1
    return version


def upsert_store(new, root, time=TIME):
    """Merge new rows into the store and return it as read back; None if nothing is new.

    Only the years of ``new`` are read and written. Writers may run side by side: the merge is
    repeated over what others have committed to these years in the meantime.
    """
    spark = new.sparkSession
    new = stage(new)
    touched = {row["y"] for row in new.select(F.year(time).alias("y")).distinct().collect()}
    if not touched:
        return None
    last, years = _state(spark, root)
    while True:
        base = {y: years[y] for y in touched & years.keys()}
        paths = [f"{root}/{folder}/year={y}" for y, (_, folder, _) in sorted(base.items())]
        merged = upsert_panel(new, spark.read.parquet(*paths)) if paths else new
        folder, written = _written(merged, root, last + 1, time)
        while not _commit(spark, root, last + 1, written, folder):
            last, years = _settled(spark, root, last + 1)
            if {y: years[y] for y in touched & years.keys()} != base:
                break  # another writer's rows are in these years now
        else:
            return open_store(spark, root)
        _remove(spark, f"{root}/{folder}")


def new_rows_of_store(new, root, time=TIME, key=KEY):
    """The rows of ``new`` whose key is not stored yet, and the years whose files had to be read for that.

    A key that its year's filter does not hold is new for certain. Only years with a key that the
    filter may hold are read, and of them the key columns.
    """
    spark = new.sparkSession
    rows = stage(new.withColumn("__row", F.monotonically_increasing_id()))
    years = _state(spark, root)[1]
    if not years:
        return rows.drop("__row"), []
    probes = _key_bits(rows.select("__row", key, time), time, {y: words for y, (_, _, words) in years.items()})
    filters = [spark.read.parquet(f"{root}/{folder}/{KEYS}").filter(F.col("year").isin(
        [y for y, (_, f, _) in years.items() if f == folder])) for folder in {f for _, f, _ in years.values()}]
    table = reduce(lambda a, b: a.unionAll(b), filters)
    held = F.coalesce((F.col("bits").bitwiseAND(F.expr("shiftleft(1L, bit)"))) != 0, F.lit(False))
    maybe = stage(probes.join(table, ["year", "word"], "left").groupBy("__row", "year").agg(
        F.bool_and(held).alias("maybe")).filter("maybe"))
    read = sorted(row["year"] for row in maybe.select("year").distinct().collect())
    if not read:
        return rows.drop("__row"), read
    stored = spark.read.parquet(*[f"{root}/{years[y][1]}/year={y}" for y in read]).select(key, time)
    asked = rows.join(maybe.select("__row"), "__row", "left_semi")
    sure = rows.join(maybe.select("__row"), "__row", "left_anti")
    return sure.unionByName(new_rows_anti(asked, stored, key, time)).drop("__row"), read
