"""Landed files to DataFrames."""

from functools import reduce

from pyspark.sql import functions as F

from panelloom.functions.dates import next_month_begin, publish_date, utc_midnight
from panelloom.functions.text import clean_symbol
from panelloom.operators.filters import drop_future_rows
from panelloom.operators.joins import outer_join_statements
from panelloom.operators.reshape import single_to_long, wide_to_long
from panelloom.schema import (
    COMPUTED_LATER, CONSTITUENT_SCHEMA, KEY, PROVIDER_B, PROVIDER_B_NAMES, SOURCE, SYMBOL_SCHEMA, TIME,
    UNUSED_PRICE_COLUMNS,
)
from panelloom.session import null_if_nan


def read_panel(spark, path, schema=None):
    """A parquet panel with NaN turned into null. With ``schema`` no footer is read for inference."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return null_if_nan(reader.parquet(path))


def read_keys_pruned(spark, path, key=KEY, time=TIME):
    """Only the key columns; the scan reads nothing else."""
    return spark.read.parquet(path).select(F.col(key), F.to_date(time).alias(time))


def read_csv_list(spark, path, schema=SYMBOL_SCHEMA):
    return spark.read.schema(schema).csv(path, header=True)


def read_constituents(spark, path):
    """Index members: symbol cleaned, joining date kept as text."""
    raw = read_csv_list(spark, path, CONSTITUENT_SCHEMA)
    return raw.select(clean_symbol("Symbol").alias(KEY), F.col("Date added").alias("DateAdded"))


def read_prices(df, attributes, entities, time=TIME, zone=None):
    """A landed wide price table to the long panel: UTC days, needed columns, rows with a close."""
    if entities and len(entities) > 1:
        long = wide_to_long(df, attributes, entities, time)
    else:
        long = single_to_long(df, entities[0])
    dated = long.withColumn(time, utc_midnight(F.col(time), zone))
    return drop_columns(dated).dropna(subset=["Close"])


def drop_columns(df, cols=UNUSED_PRICE_COLUMNS):
    return df.drop(*cols)


def add_source_tag(df, tag, source=SOURCE):
    return df.withColumn(source, F.lit(tag))


def load_statements(families, keys=(KEY, "Report Date")):
    """Provider B: per sector family a full outer join of its three statements, then all families.

    ``families`` is a list of (income, balance, cash flow); their columns may differ.
    """
    joined = [outer_join_statements(*family, keys) for family in families]
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), joined)
    return out.withColumn(KEY, clean_symbol(KEY))


def standardise_columns(df, as_of=None, names=PROVIDER_B_NAMES, missing=COMPUTED_LATER, tag=PROVIDER_B,
                        extra=()):
    """Provider B under the common names, dated to the month after publication.

    ``extra`` names further columns to keep, such as the report date.
    """
    if "Report Date" in df.columns:
        published = F.col("Publish Date") if "Publish Date" in df.columns else F.lit(None).cast("date")
        df = df.withColumn("Publish Date", publish_date(published, F.col("Report Date")))
    renamed = df.withColumnsRenamed(names).withColumns({c: F.lit(None).cast("double") for c in missing})
    dated = renamed.withColumn(TIME, next_month_begin(F.to_date("Publish Date")))
    wanted = list(dict.fromkeys([*names.values(), *missing, TIME, KEY, *extra]))
    out = add_source_tag(dated.select(*[c for c in wanted if c in dated.columns]), tag)
    return out if as_of is None else drop_future_rows(out, as_of)
