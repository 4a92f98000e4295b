"""Run registered queries next to their SQL in DuckDB and compare row by row.

    python tests/compare.py [sf] [name ...]
"""

import datetime
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
CLOCK = {}
KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "boolean": "BOOLEAN",
}


def duck(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    return "null" if v is None else repr(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark, con, name, queries, oracle, folder):
    """Problems found for one query, as text; empty when both sides agree."""
    df = queries[name](spark, folder)
    got = rows_of(df.columns, [tuple(x) for x in df.collect()])
    CLOCK[name] = time.time()
    if name not in oracle:
        return [] if got else ["no rows"]
    cur = con.execute(oracle[name])
    described = cur.description
    names = [d[0] for d in described]
    want = rows_of(names, cur.fetchall())
    problems = []
    if sorted(names) != sorted(df.columns):
        problems.append(f"columns {sorted(df.columns)} vs {sorted(names)}")
    kinds = {d[0]: str(d[1]) for d in described}
    for column, kind in df.dtypes:
        if KINDS.get(kind, kind).upper() != kinds.get(column, "").upper():
            problems.append(f"type of {column}: {kind} vs {kinds.get(column)}")
    if got != want:
        only_got = [x for x in got if x not in set(want)][:3]
        only_want = [x for x in want if x not in set(got)][:3]
        problems.append(f"rows {len(got)} vs {len(want)}; only ours {only_got}; only sql {only_want}")
    return problems


def main(argv):
    import __spark_entry__ as entry
    from panelloom.session import local_session

    folder = f"/root/testdata/sf{argv[0] if argv else '0.01'}"
    spark = local_session()
    con = duck(folder)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in argv[1:] or sorted(queries):
        start = time.time()
        try:
            problems = compare(spark, con, name, queries, oracle, folder)
        except Exception as error:  # report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        bad += bool(problems)
        spent = CLOCK.get(name, time.time()) - start
        kind = "sql" if name in oracle else "rows"
        print(f"{'BAD' if problems else 'ok '} {kind:4} {spent:6.2f}s + {time.time() - start - spent:5.2f}s {name}", flush=True)
        for text in problems:
            print("     ", text[:1500])
    print(f"{bad} of {len(argv[1:] or queries)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
