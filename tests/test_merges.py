"""Joins, reshaping, sources and sinks."""

import datetime as dt
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelloom import schema as S, session
from panelloom.functions import dates, text
from panelloom.functions import metrics as M
from panelloom.operators import aggregates as A, filters as C, joins as J, ranking as K, reshape as R
from panelloom.plans.macro import macro_monthly
from panelloom.plans.raw_panel import build_raw_panel, provider_a_statements
from panelloom.sources import readers, sinks


def d(text_):
    return dt.date.fromisoformat(text_)


def test_symbols_and_labels(spark):
    df = spark.createDataFrame([(" BRK.B ", "real-estate & LEASING"), (None, None), ("A B", "&"), ("GPS", "a  b&c")], "s string, l string")
    got = df.select(text.clean_symbol("s"), text.clean_label("l"), text.remap_symbol(text.clean_symbol("s"))).collect()
    assert [tuple(r) for r in got] == [
        ("BRK-B", "Real Estate And Leasing", "BRK-B"), (None, None, None), ("AB", "And", "AB"), ("GPS", "A B&c", "GAP")]


def test_dates(spark):
    df = spark.createDataFrame([("2020-01-31",), ("2020-02-01",), ("n/a",), (None,)], "t string")
    got = df.select(dates.next_month_begin(F.try_to_date("t") if hasattr(F, "try_to_date") else F.try_to_timestamp("t")),
                    dates.years_since(F.col("t"), "2022-07-31")).collect()
    assert [r[0] for r in got] == [d("2020-02-01"), d("2020-03-01"), None, None]
    assert [r[1] for r in got] == [2.0, 2.0, 0.0, 0.0]


def test_asof_against_brute_force_with_a_hot_entity(spark):
    rng = np.random.default_rng(1)
    start = dt.datetime(2024, 1, 1)
    at = lambda: start + dt.timedelta(hours=int(rng.integers(0, 24 * 20)))
    pick = lambda: int(0 if rng.random() < 0.5 else rng.integers(1, 20))
    periods = [(i, pick(), at()) for i in range(400)]
    events = [(pick(), at()) for _ in range(300)]
    got = J.asof_forward(
        spark.createDataFrame(periods, "i int, e int, t timestamp_ntz"), spark.createDataFrame(events, "e int, p timestamp_ntz"),
        "e", "t", "p", ["i"], days=2).collect()
    assert len(got) == 400
    for row in got:
        _, e, t = periods[row["i"]]
        hits = [p for x, p in events if x == e and t < p <= t + dt.timedelta(days=2)]
        want = min(hits) if hits else None
        assert row["p"] == want
        assert row["PublicationDate"] == (want.date() if want else (t + dt.timedelta(days=30)).date())


def test_merge_prefers_first_and_tags_both(spark):
    a = spark.createDataFrame([("X", d("2020-01-01"), 1.0, None, "yfinance"), ("X", d("2020-01-01"), 2.0, None, "yfinance")],
                              "Ticker string, Date date, u double, v double, FinancialsSource string")
    b = spark.createDataFrame([("X", d("2020-01-01"), 9.0, 8.0, 7.0, "simFin"), ("Y", d("2020-01-01"), 9.0, 8.0, 7.0, "simFin")],
                              "Ticker string, Date date, u double, v double, w double, FinancialsSource string")
    got = {r["Ticker"]: r for r in J.coalesce_merge(a, b, order=["u"]).collect()}
    assert got["X"][2:] == (2.0, 8.0, S.BOTH_PROVIDERS, 7.0)
    assert got["Y"][2:] == (9.0, 8.0, "simFin", 7.0)
    same = J.upsert_panel(a.limit(1), a.limit(1))
    assert sorted(same.collect()) == sorted(a.limit(1).collect())


def test_source_guards(spark):
    rows = [("yfinance", -1.0), ("simFin", -1.0), (S.BOTH_PROVIDERS, -1.0), (None, -1.0), ("simFin", None)]
    df = spark.createDataFrame(rows, "FinancialsSource string, DepreciationAndAmortization_TTM double")
    df = df.withColumns({c: F.lit(-1.0) for c in ("TotalRevenue_TTM", "CurrentDebt", "LongTermDebt")})
    out = M.flip_sign_by_source(M.null_invalid_sign(df)).collect()
    assert [r[1] for r in out] == [None, 1.0, -1.0, -1.0, None]
    assert all(r["TotalRevenue_TTM"] is None for r in out)


def test_reshape(spark):
    wide = spark.createDataFrame([(d("2020-01-01"), 1.0, 2.0, 3.0, None)], "Date date, `Open|A` double, `Open|B` double, `Close|A` double, `Close|B` double")
    long = R.wide_to_long(wide, ["Open", "Close"], ["A", "B"])
    assert sorted(map(tuple, long.select("Ticker", "Open", "Close").collect())) == [("A", 1.0, 3.0), ("B", 2.0, None)]
    assert readers.read_prices(wide, ["Open", "Close"], ["A", "B"]).count() == 1
    assert R.strip_column_spaces(spark.createDataFrame([(1,)], "`a b` int")).columns == ["ab"]
    plan = R.dense_grid(long, long)._jdf.queryExecution().optimizedPlan().toString()
    assert "Cross" not in plan


def test_a_hot_hour_is_cut_by_its_rows(spark):
    """One entity with everything in one hour: parts of bounded size, the same answers."""
    rng = np.random.default_rng(3)
    base = dt.datetime(2024, 1, 1, 10)
    # most of them within one second
    offsets = np.concatenate([rng.integers(0, 1_000_000, 3000), rng.integers(0, 3_600_000_000, 500)])
    moments = [base + dt.timedelta(microseconds=int(x)) for x in offsets]
    periods = [("hot", k, m) for k, m in enumerate(moments[::2])] + [("cold", -1, base - dt.timedelta(days=1)), ("none", -2, base)]
    events = [("hot", m) for m in moments[1::2]] + [("cold", base), ("hot", None)]
    p = spark.createDataFrame(periods, "e string, k int, at timestamp_ntz")
    v = spark.createDataFrame(events, "e string, seen timestamp_ntz")
    got = {r.k: r.seen for r in J.first_event_after(p, v, "e", "at", "seen", ["k"], days=2, rows=100).collect()}
    known = sorted(m for m in moments[1::2])
    for e, k, at in periods[:-2]:
        assert got[k] == next((m for m in known if m > at), None)
    assert got[-1] == base and got[-2] is None and len(got) == len(periods)
    both = p.selectExpr("e", "at as __t").unionAll(v.filter("seen is not null").selectExpr("e", "seen as __t"))
    parts = J.time_buckets(both, "e", rows=100).filter("e = 'hot'").groupBy("__hour", "__part").count().collect()
    assert len(parts) > 20 and max(r["count"] for r in parts) < 250
    plan = J.time_buckets(both, "e", rows=100)
    assert plan.filter("e <> 'hot'").select("__part").distinct().count() == 1


def test_files(spark, tmp_path):
    (tmp_path / "c.csv").write_text("Symbol,Date added\nBRK.B,2010-01-01\nA ,\n")
    got = readers.read_constituents(spark, str(tmp_path / "c.csv")).collect()
    assert [tuple(r) for r in got] == [("BRK-B", "2010-01-01"), ("A", None)]
    panel = spark.createDataFrame([("A", d("2020-01-01"), 1.0), ("A", d("2021-01-01"), float("nan"))], "Ticker string, Date date, Open double")
    sinks.write_panel(panel, str(tmp_path / "p"))
    assert sorted(p.name for p in (tmp_path / "p").iterdir() if p.name.startswith("year")) == ["year=2020", "year=2021"]
    assert readers.read_panel(spark, str(tmp_path / "p")).filter("Open IS NULL").count() == 1
    path = sinks.write_report_csv(panel, str(tmp_path), "2026-01-05")
    assert path.endswith("/2026_1_5.csv") and spark.read.csv(path, header=True).count() == 2
    stored = sinks.append_exclusions(spark.createDataFrame([("B",), ("A",)], "Ticker string"), spark.createDataFrame([("A",), (None,)], "Ticker string"))
    assert [r[0] for r in stored.collect()] == ["A", "B"]


def test_many_entities_turn_quickly(spark, tmp_path):
    """The plan does not grow with the entities: planning and running take seconds."""
    import time
    import pyarrow as pa
    import pyarrow.parquet as pq
    entities = [f"E{i}" for i in range(20_000)]
    table = pa.table({"Date": [d("2020-01-01"), d("2020-02-01")], **{f"Open|{e}": [float(i), None] for i, e in enumerate(entities)}})
    pq.write_table(table, str(tmp_path / "wide.parquet"))
    wide = spark.read.schema("Date date, " + ", ".join(f"`Open|{e}` double" for e in entities)).parquet(str(tmp_path / "wide.parquet"))
    start = time.monotonic()
    long = R.wide_to_long(wide, ["Open"], entities)
    plan = long._jdf.queryExecution().simpleString()
    rows = {(r.Ticker, r.Date): r.Open for r in long.collect()}
    assert time.monotonic() - start < 90
    assert len(rows) == 40_000 and rows["E77", d("2020-01-01")] == 77.0 and rows["E77", d("2020-02-01")] is None
    assert plan.count("E19999") <= 4


def test_columns_of_several_types_and_names(spark):
    wide = spark.createDataFrame([(d("2020-01-01"), 1, 2.5, "x")], "Date date, `v|A` int, `v|B` double, other string")
    assert sorted(map(tuple, R.wide_to_long(wide, ["v"], ["A", "B"]).collect())) == [(d("2020-01-01"), "A", 1.0), (d("2020-01-01"), "B", 2.5)]
    assert R.wide_to_long(wide, ["v"], []).count() == 0 and R.wide_to_long(wide.limit(0), ["v"], ["A"]).count() == 0
    with pytest.raises(ValueError):
        R.wide_to_long(wide, ["v"], ["C"])


def test_store_can_be_updated_from_itself(spark, tmp_path):
    root = str(tmp_path / "store")
    schema = "Ticker string, Date date, Open double, v double"
    assert sinks.open_store(spark, root) is None
    sinks.upsert_store(spark.createDataFrame([("A", d("2020-01-01"), 1.0, 5.0)], schema), root)
    new = spark.createDataFrame([("A", d("2020-01-01"), 2.0, None), ("A", d("2020-02-01"), 3.0, None)], schema)
    out = sinks.upsert_store(new, root)
    assert sorted(map(tuple, out.collect())) == [("A", d("2020-01-01"), 2.0, 5.0), ("A", d("2020-02-01"), 3.0, None)]
    again = sinks.upsert_store(out, root)
    assert sorted(again.collect()) == sorted(out.collect())
    assert sinks.upsert_store(new.filter("false"), root) is None


def test_interleaved_writers_lose_nothing(spark, tmp_path, monkeypatch):
    root, schema = str(tmp_path / "store"), "Ticker string, Date date, Open double, v double"
    def row(ticker, open_, v=None, year=2020):
        return spark.createDataFrame([(ticker, d(f"{year}-03-01"), open_, v)], schema)
    sinks.upsert_store(row("A", 1.0, 5.0), root)
    commit, calls = sinks._commit, []

    def late(spark_, root_, version, years, folder):
        if not calls:  # between the first writer's read and its commit a second one comes through
            calls.append(version)
            sinks.upsert_store(row("A", 2.0).unionAll(row("B", 9.0)), root)
            sinks.upsert_store(row("D", 4.0, year=2022), root)
        return commit(spark_, root_, version, years, folder)

    monkeypatch.setattr(sinks, "_commit", late)
    out = sinks.upsert_store(row("A", None, 6.0).unionAll(row("C", 3.0)), root)
    assert calls == [2] and sinks.latest_version(spark, root) == 4
    assert sorted(map(tuple, out.collect())) == [
        ("A", d("2020-03-01"), 2.0, 6.0), ("B", d("2020-03-01"), 9.0, None), ("C", d("2020-03-01"), 3.0, None),
        ("D", d("2022-03-01"), 4.0, None)]
    folders = {p.name for p in (tmp_path / "store").iterdir() if p.name.startswith("v")}
    assert len(folders) == 4  # the attempt that lost has removed its folder


def test_many_writers_at_once(spark, tmp_path):
    from multiprocessing.pool import ThreadPool
    root, schema = str(tmp_path / "store"), "Ticker string, Date date, Open double"
    def write(i):
        sinks.upsert_store(spark.createDataFrame([(f"T{i}", d("2020-01-01"), float(i)), (f"T{i}", d(f"20{10 + i}-01-01"), 0.0)], schema), root)
    with ThreadPool(4) as pool:
        pool.map(write, range(4))
    rows = {(r.Ticker, r.Date.year) for r in sinks.open_store(spark, root).collect()}
    assert rows == {(f"T{i}", y) for i in range(4) for y in (2020, 2010 + i)}
    assert sinks.latest_version(spark, root) == 4


def test_a_commit_is_made_once_and_unfinished_ones_are_not_read(spark, tmp_path, monkeypatch):
    root, schema = str(tmp_path / "store"), "Ticker string, Date date, Open double"
    path = f"{root}/{sinks.COMMITS}/x.json"
    assert sinks.create_once(spark, path, "{}") and not sinks.create_once(spark, path, "{}")
    (tmp_path / "store" / sinks.COMMITS / "x.json").unlink()
    monkeypatch.setattr(sinks, "ABANDONED", 0.5)
    (tmp_path / "store" / sinks.COMMITS / f"{1:012d}.json").write_text("")  # its writer was lost
    sinks.upsert_store(spark.createDataFrame([("A", d("2020-01-01"), 1.0)], schema), root)
    assert sinks.latest_version(spark, root) == 2 and sinks.open_store(spark, root).count() == 1


def test_new_rows_skip_years_whose_filter_rules_them_out(spark, tmp_path):
    root, schema = str(tmp_path / "store"), "Ticker string, Date date, Open double"
    first = [(f"T{i}", d(f"{y}-0{m}-01"), 1.0) for y in range(2015, 2021) for m in (1, 2) for i in range(60)]
    sinks.upsert_store(spark.createDataFrame(first, schema), root)
    sinks.upsert_store(spark.createDataFrame([(f"T{i}", d("2019-05-01"), 2.0) for i in range(60)], schema), root)
    new = spark.createDataFrame([("T1", d("2019-05-01"), 0.0), ("T1", d("2019-06-01"), 0.0), ("T2", d("2016-02-01"), 0.0),
                                 ("X", d("2017-01-01"), 0.0), ("T3", d("2023-01-01"), 0.0), ("T4", None, 0.0)], schema)
    rows, read = sinks.new_rows_of_store(new, root)
    want = J.new_rows_anti(new, sinks.open_store(spark, root))
    assert sorted(map(str, rows.collect())) == sorted(map(str, want.collect()))
    assert {2016, 2019} <= set(read) and set(read) <= {2016, 2017, 2019}
    # a filter of ten bits a key errs on about one key in a hundred
    unseen = spark.createDataFrame([(f"U{i}", d("2018-01-01"), 0.0) for i in range(2000)], schema)
    bits = sinks._state(spark, root)[1]
    probes = sinks._key_bits(unseen.withColumn("__row", F.monotonically_increasing_id()), "Date", {2018: bits[2018][2]})
    table = spark.read.parquet(f"{root}/{bits[2018][1]}/{sinks.KEYS}")
    wrong = probes.join(table, ["year", "word"], "left").groupBy("__row").agg(F.bool_and(F.coalesce(
        F.col("bits").bitwiseAND(F.expr("shiftleft(1L, bit)")) != 0, F.lit(False))).alias("m")).filter("m").count()
    assert wrong < 60
    fresh, none = sinks.new_rows_of_store(new, str(tmp_path / "other"))
    assert fresh.count() == 6 and none == []


def test_an_unreadable_store_is_not_taken_for_an_empty_one(spark, tmp_path):
    root, schema = str(tmp_path / "store"), "Ticker string, Date date, Open double"
    sinks.upsert_store(spark.createDataFrame([("A", d("2020-01-01"), 1.0)], schema), root)
    folder = next(p for p in (tmp_path / "store").iterdir() if p.name.startswith("v"))
    folder.rename(tmp_path / "elsewhere")
    with pytest.raises(Exception):
        sinks.upsert_store(spark.createDataFrame([("A", d("2020-01-01"), 2.0)], schema), root)
    listing = tmp_path / "list"
    listing.mkdir()
    (listing / "part-0.parquet").write_bytes(b"not a table")
    with pytest.raises(Exception):
        sinks.read_exclusions(spark, str(listing)).collect()


def files(spark, root, year):
    return sorted(p.rsplit("/", 1)[1] for p in sinks.open_store(spark, root, f"{year}-01-01", f"{year}-12-31").inputFiles())


def test_untouched_years_keep_their_files(spark, tmp_path):
    root, schema = str(tmp_path / "store"), "Ticker string, Date date, Open double"
    sinks.upsert_store(spark.createDataFrame([("A", d("2019-01-01"), 1.0), ("A", d("2020-01-01"), 1.0)], schema), root)
    before = {y: files(spark, root, y) for y in (2019, 2020)}
    out = sinks.upsert_store(spark.createDataFrame([("A", d("2020-01-01"), 2.0), ("B", d("2021-01-01"), 3.0)], schema), root)
    assert files(spark, root, 2019) == before[2019] and files(spark, root, 2020) != before[2020]
    assert sorted(map(tuple, out.collect())) == [
        ("A", d("2019-01-01"), 1.0), ("A", d("2020-01-01"), 2.0), ("B", d("2021-01-01"), 3.0)]
    # two writers never share a folder; the record decides
    folders = [p.name for p in (tmp_path / "store").iterdir() if p.name.startswith("v")]
    assert len(set(folders)) == 2 and sinks.current_years(spark, root)[2019] != sinks.current_years(spark, root)[2020]
    sinks.write_panel(out, str(tmp_path / "p"))
    plan = sinks.read_written(spark, str(tmp_path / "p"), first="2020-06-01")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_exclusions_are_saved_once(spark, tmp_path):
    path = str(tmp_path / "list")
    frame = lambda *names: spark.createDataFrame([(n,) for n in names], "Ticker string")
    assert sinks.save_exclusions(frame("B", "A", None), path) and not sinks.save_exclusions(frame("A"), path)
    before = sorted(p.name for p in (tmp_path / "list").iterdir())
    assert not sinks.save_exclusions(frame("A", "B"), path)
    assert before == sorted(p.name for p in (tmp_path / "list").iterdir())
    assert sinks.save_exclusions(frame("C"), path)
    assert sorted(r[0] for r in sinks.read_exclusions(spark, path).collect()) == ["A", "B", "C"]


def test_cells_with_two_values_are_refused(spark):
    rows = [("A", d("2020-01-01"), "Total Revenue", 1.0), ("A", d("2020-01-01"), "Total Revenue", 2.0)]
    df = spark.createDataFrame(rows, "Ticker string, Date date, Item string, Value double")
    with pytest.raises(Exception, match="more than one value"):
        R.transpose_statement(df, ["Total Revenue"], ["Ticker", "Date"]).collect()
    with pytest.raises(Exception, match="more than one value"):
        R.long_to_wide(df, ["A"], "Value").collect()
    one = R.transpose_statement(df.limit(1), ["Total Revenue", "Other"], ["Ticker", "Date"]).first()
    assert (one["Total Revenue"], one["Other"]) == (1.0, None)


def test_merge_wants_an_order(spark):
    df = spark.createDataFrame([("X", d("2020-01-01"), 1.0)], "Ticker string, Date date, u double")
    with pytest.raises(ValueError):
        J.coalesce_merge(df, df)


def test_two_periods_of_one_month_keep_the_later(spark):
    schema = "Ticker string, PeriodEnd timestamp, Item string, Value double"
    items = spark.createDataFrame([("A", dt.datetime(2020, 3, 31), "Total Revenue", 5.0), ("A", dt.datetime(2020, 4, 30), "Total Revenue", 6.0)], schema)
    events = spark.createDataFrame([("A", dt.datetime(2020, 5, 20))], "Ticker string, Published timestamp")
    dated = provider_a_statements(items, None, None, events)
    assert dated.count() == 2 and {r.Date for r in dated.collect()} == {d("2020-06-01")}
    other = dated.limit(0)
    kept = J.coalesce_merge(dated, other, order=["PeriodEnd"]).collect()
    assert [r["Total Revenue"] for r in kept] == [6.0]
    guessed = provider_a_statements(items, None, None, None)
    assert {r.Date for r in guessed.collect()} == {d("2020-05-01"), d("2020-06-01")}


def test_a_run_leaves_nothing_behind(spark):
    outer = session.run_folder(spark)
    with session.run_scope(spark):
        df = session.stage(spark.range(3).toDF("x"))
        assert df.count() == 3
        folder = session.run_folder(spark).removeprefix("file://")
        assert folder != outer and os.path.isdir(folder)
    assert not os.path.exists(folder) and session.run_folder(spark) == outer


def test_positions_and_folds(spark):
    df = spark.range(1003).select((F.col("id") % 7).cast("string").alias("Ticker"), F.date_add(F.lit(d("2020-01-01")), (F.col("id") / 7).cast("int")).alias("Date"))
    got = [tuple(r) for r in K.ordered_position(df, chunks=5).orderBy("__pos").collect()]
    assert [g[2] for g in got] == list(range(1003))
    assert [(g[1], g[0]) for g in got] == sorted((g[1], g[0]) for g in got)
    sizes = {r["fold"]: r["count"] for r in K.expanding_folds(df).groupBy("fold").count().collect()}
    assert sizes == {0: 1003 - 5 * 167, **{i: 167 for i in range(1, 6)}}


def test_split_and_sets(spark):
    df = spark.createDataFrame([("A", d("2020-01-01")), ("A", d("2020-02-01")), ("B", d("2020-02-01"))], "Ticker string, Date date")
    train, live = C.split_latest_date(df)
    assert (train.count(), live.count()) == (1, 2)
    plan = live._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    assert A.set_difference(df, df.filter("Ticker = 'A'")).collect()[0][0] == "B"


def test_macro_months(spark):
    at = lambda t: dt.datetime.fromisoformat(t)
    rows = [("g", at("2020-01-03"), 1.0), ("g", at("2020-01-20"), 2.0), ("g", at("2020-01-25"), None), ("u", at("2020-03-01"), 3.0), ("z", at("2020-02-01"), 9.0)]
    out = macro_monthly(spark.createDataFrame(rows, "indicator string, ts timestamp, value double"), ["g", "u"])
    assert sorted(map(tuple, out.collect())) == [(d("2020-01-31"), 2.0, None), (d("2020-03-31"), None, 3.0)]


def test_provider_a_rows_are_dated_by_publication(spark):
    t = dt.datetime(2020, 3, 31)
    items = spark.createDataFrame([("A", t, "Total Revenue", 5.0), ("A", t, "Unknown", 1.0), ("B", t, "Net Income", 2.0)],
                                  "Ticker string, PeriodEnd timestamp, Item string, Value double")
    balance = spark.createDataFrame([("A", t, "Total Liabilities Net Minority Interest", 7.0)], items.schema)
    events = spark.createDataFrame([("A", dt.datetime(2020, 5, 20))], "Ticker string, Published timestamp")
    out = {r["Ticker"]: r for r in provider_a_statements(items, balance, None, events).collect()}
    assert out["A"]["Date"] == d("2020-06-01") and out["B"]["Date"] == d("2020-05-01")
    assert out["A"]["Total Revenue"] == 5.0 and out["A"]["Total Liabilities"] == 7.0 and out["A"]["Capital Expenditure"] is None
    assert out["A"]["FinancialsSource"] == S.PROVIDER_A


def test_incremental_raw_panel(spark, tmp_path):
    """A second run over a store only brings entities that are behind."""
    from panelloom.catalog import fixtures as X, plans_q as Q
    t = X.Tables(spark, "/root/testdata/sf0.001", landed=True)
    full = Q.raw_panel(t)
    root = str(tmp_path / "raw")
    store = sinks.upsert_store(full, root)
    assert store.count() == full.count()
    behind = build_raw_panel(
        Q.provider_b(t), X.prices(t), Q.provider_a(t), X.info(t), X.constituents(t),
        "2001-12-31", X.exclusions(t), stored=store.filter("Ticker <> 'S3'"))
    assert {r[0] for r in behind.select("Ticker").distinct().collect()} <= {"S3"} | {
        r[0] for r in A.stale_tickers(store.select("Ticker"), store, "2001-12-31").collect()}
