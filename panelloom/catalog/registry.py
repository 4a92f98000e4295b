"""Registry of the check queries: a Spark callable and, where SQL can say it, the same in SQL."""

from pyspark.sql import functions as F

from panelloom.catalog.fixtures import Tables, with_fixtures

QUERIES = {}
ORACLE = {}


def query(name, sql=None, needs=(), extra=()):
    """Register ``fn(tables)`` under ``name``; ``sql`` is stated over the fixtures in ``needs``."""

    def register(fn):
        def run(spark, folder):
            return fn(Tables(spark, folder))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = with_fixtures(sql, *needs, extra=extra)
        return fn

    return register


def rounded(df, *cols, places=6):
    """Comparable doubles: rounded, without negative zero."""
    return df.withColumns({c: F.round(c, places) + F.lit(0.0) for c in cols})


def r(expr, alias=None, places=6):
    """SQL text of the same rounding."""
    text = f"(round({expr}, {places}) + 0.0e0)"
    return f"{text} AS {alias}" if alias else text


def rs(cols, places=6, prefix=""):
    return ", ".join(r(prefix + c, c, places) for c in cols)
