"""The flat-file job: headers, quotes, state by day, bad rows."""

import gzip
import os
from datetime import datetime, timezone

import pytest

from barlake.plans import backfill, store
from barlake.schemas import FLAT_DAYS
from barlake.sources.landing import read_flat_files

KW = dict(asset_class="stocks", timeframe="minute", now="2024-02-01 00:00:00")


def ns(*at):
    return int(datetime(*at, tzinfo=timezone.utc).timestamp()) * 10**9


def put(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    opener = gzip.open if name.endswith(".gz") else open
    with opener(os.path.join(folder, name), "wt") as f:
        f.write("\n".join(lines) + "\n")


HEADER = "ticker,volume,open,close,high,low,window_start,transactions"


def days(spark, root):
    return {(str(r["day"]), r["status"]): (r["tickers"], r["rows"], r["bad"])
            for r in store.read_appended(spark, root, "flat_days", FLAT_DAYS).collect()}


def test_quotes_and_column_orders(spark, scratch):
    put(scratch, "2024-01-02.csv.gz", [HEADER, f'"A,B",1,2,3,4,1.5,{ns(2024, 1, 2, 15)},7', f'"say ""hi""",1,2,3,4,1.5,{ns(2024, 1, 2, 15)},7'])
    put(scratch, "2024-01-03.csv", ["﻿Ticker, Window_Start,close", f"C,{ns(2024, 1, 3, 15)},9.5"])
    got = {r["ticker"]: r for r in read_flat_files(spark, scratch).collect()}
    assert set(got) == {"A,B", 'say "hi"', "C"}
    assert (got["A,B"]["volume"], got["A,B"]["close"], got["A,B"]["transactions"]) == (1.0, 3.0, 7)
    assert (got["C"]["close"], got["C"]["open"], got["C"]["volume"]) == (9.5, None, None)
    put(scratch, "2024-01-04.csv", ["symbol,time", "A,1"])
    with pytest.raises(ValueError, match="no header"):
        read_flat_files(spark, scratch)


def test_a_file_is_taken_once_and_only_when_its_day_is_complete(spark, scratch):
    root, folder = f"{scratch}/lake", f"{scratch}/flat/2024/01"
    row = lambda s, d, v: f"{s},{v},1,1.5,2,0.5,{ns(2024, 1, d, 15)},5"
    put(folder, "2024-01-02.csv.gz", [HEADER, row("A", 2, 1), row("B", 2, 2)])
    put(folder, "2024-01-03.csv.gz", [HEADER, row("A", 3, 3)])
    run = lambda end: backfill.run_flat_files(spark, root, f"{scratch}/flat", target_end=end, run_id=end, **KW)
    first = run("2024-01-02")
    assert (first.files_opened, first.bars_written, first.succeeded, first.exit_code) == (1, 2, 2, 0)
    assert run("2024-01-02").files_opened == 0
    second = run("2024-01-03")
    assert (second.files_opened, second.bars_written) == (1, 1)
    assert days(spark, root) == {("2024-01-02", "taken"): (2, 2, 0), ("2024-01-03", "taken"): (1, 1, 0)}
    state = {r["symbol"]: (str(r["last_complete_date"]), r["bar_count"]) for r in store.read_manifest(spark, root).collect()}
    assert state == {"A": ("2024-01-03", 2), "B": ("2024-01-02", 1)}
    put(folder, "2024-01-02.csv.gz", [HEADER, row("A", 2, 99), row("B", 2, 2), row("C", 2, 4)])  # published again
    third = run("2024-01-03")
    assert (third.files_opened, third.bars_written) == (1, 1)  # stored bars stay, the new ticker comes in
    assert sorted(r["volume"] for r in store.read_bars(spark, root).collect()) == [1.0, 2.0, 3.0, 4.0]


def test_bad_rows_and_files_are_reported(spark, scratch):
    root, folder = f"{scratch}/lake", f"{scratch}/flat"
    put(folder, "2024-01-02.csv", [HEADER, f"A,1,1,1.5,2,0.5,{ns(2024, 1, 2, 15)},5", "B,1,1,1.5,2,0.5,soon,5", f",1,1,1.5,2,0.5,{ns(2024, 1, 2, 15)},5",
                                   f"C,many,1,1.5,2,0.5,{ns(2024, 1, 2, 15)},5"])
    put(folder, "2024-01-03.csv", ["A,1,1,1.5,2,0.5,1,5"])
    put(folder, "notes.csv", [HEADER])
    out = backfill.run_flat_files(spark, root, folder, target_end="2024-01-31", run_id="r", **KW)
    assert (out.files_opened, out.bars_written, out.succeeded, out.errors, out.exit_code) == (3, 1, 1, 2, 1)  # B and C brought no good row
    assert days(spark, root) == {("2024-01-02", "taken"): (3, 4, 3), ("2024-01-03", "no header"): (0, 0, 0), ("None", "no date in its name"): (0, 0, 0)}
    rows = backfill.read_quarantine(spark, root).collect()
    assert len(rows) == 3 and {r["reason"] for r in rows} == {"corrupt record"} and any('"many"' in r["record"] for r in rows)
    assert backfill.run_flat_files(spark, root, folder, target_end="2024-01-31", run_id="r2", **KW).files_opened == 0


def test_headers_are_found_among_the_few_lines_that_can_be_one(spark, tmp_path):
    from barlake.sources import landing as L
    texts = {"a": '"Ticker", "window_start"\nA_B,1\nC,2\n', "b": "x,y\nA,1\n", "c": "A,1\n﻿ticker,Window_Start,open\n"}
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_text(text, encoding="utf-8")
    got = [(names, [f.rsplit("/", 1)[1] for f in files]) for names, files in L.flat_headers(spark, [f"{tmp_path}/{n}.csv" for n in texts])]
    assert got == [(None, ["b.csv"]), (["ticker", "window_start"], ["a.csv"]), (["ticker", "window_start", "open"], ["c.csv"])]


def test_the_first_batch_of_a_lake_meets_no_stored_keys(spark, tmp_path):
    """Where no bars are stored yet the batch is only de-duplicated: its rows are sorted
    once, and not joined with an empty table."""
    from barlake.operators import state as S
    from barlake.plans import store
    none = store.read_bars(spark, str(tmp_path / "none"), with_partitions=True)
    new = spark.createDataFrame([(None,) * len(store.LAKE_SCHEMA)], store.LAKE_SCHEMA)
    fresh = S.fresh_rows(none, new, store.LAKE_KEY)
    plan = fresh._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("min_by") == 1 and fresh.count() == 1
