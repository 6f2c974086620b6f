"""Attempts, quarantine, the ledger of files and bars that wait for their day."""

import gzip
import json
import os
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from barlake.plans import actions, backfill, store
from barlake.schemas import LANDING_FILES
from barlake.sources import landing as L
from barlake.streaming import update
from tests.test_ingest_rules import bar, land
from tests.test_store import _run, _universe

CRYPTO = dict(asset_class="crypto", timeframe="minute")


def date_file(path, symbol, name, at):
    """Set the modification time of a landed file."""
    stamp = at.replace(tzinfo=timezone.utc).timestamp()
    os.utime(os.path.join(path, f"symbol={symbol}", f"{name}.json"), (stamp, stamp))


def volumes(spark, root):
    return [r["volume"] for r in store.read_bars(spark, root).orderBy("symbol", "timestamp").collect()]


def test_bars_of_the_running_day_are_stored_next_day(spark, scratch):
    """Two bars of the 10th, update at noon, one bar of the 11th, update on the 12th."""
    root, landing, ckpt = f"{scratch}/lake", f"{scratch}/landing", f"{scratch}/ckpt"
    land(landing, "X:B", "a", [bar(datetime(2024, 1, 10, 9, 0), 1.0), bar(datetime(2024, 1, 10, 9, 1), 2.0)])
    update.run_update(spark, landing, root, ckpt, now="2024-01-10 12:00:00", **CRYPTO)
    assert volumes(spark, root) == [] and backfill.read_pending(spark, root, "crypto", "minute").count() == 2
    land(landing, "X:B", "b", [bar(datetime(2024, 1, 11, 9, 0), 3.0)])
    update.run_update(spark, landing, root, ckpt, now="2024-01-12 01:00:00", **CRYPTO)
    assert volumes(spark, root) == [1.0, 2.0, 3.0]
    assert backfill.read_pending(spark, root, "crypto", "minute").count() == 0
    assert store.read_manifest(spark, root).first()["bar_count"] == 3


def test_pending_bars_are_admitted_when_nothing_more_lands(spark, scratch):
    root, landing, ckpt = f"{scratch}/lake", f"{scratch}/landing", f"{scratch}/ckpt"
    land(landing, "X:B", "a", [bar(datetime(2024, 1, 10, 9, 0), 1.0)])
    runs = [update.run_update(spark, landing, root, ckpt, now=now, **CRYPTO)
            for now in ("2024-01-10 12:00:00", "2024-01-10 13:00:00", "2024-01-11 01:00:00", "2024-01-11 02:00:00")]
    assert runs == [1, 0, 1, 0] and volumes(spark, root) == [1.0]


def test_a_crash_after_the_pending_table_loses_nothing(spark, scratch, monkeypatch):
    root, landing = f"{scratch}/lake", f"{scratch}/landing"
    kw = dict(timeframe="minute", start="2024-01-10")
    land(landing, "X:B", "a", [bar(datetime(2024, 1, 10, 9, 0), 1.0), bar(datetime(2024, 1, 11, 9, 0), 2.0)])
    with monkeypatch.context() as m:
        m.setattr(store, "record_state", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            _run(spark, root, landing, ["X:B"], end="2024-01-10", run_id="a", **kw)
    assert backfill.read_pending(spark, root, "crypto", "minute").count() == 1
    for end, stored, opened in (("2024-01-10", [1.0], 1), ("2024-01-11", [1.0, 2.0], 0)):
        assert _run(spark, root, landing, ["X:B"], end=end, run_id=end, **kw).files_opened == opened
        assert volumes(spark, root) == stored
    assert store.read_manifest(spark, root).first()["bar_count"] == 2


def test_a_crash_between_year_files_is_replayed(spark, scratch, monkeypatch):
    """Bars of two years; the write dies after the first year's files are there."""
    root, landing = f"{scratch}/lake", f"{scratch}/landing"
    land(landing, "X:B", "a", [bar(datetime(2023, 12, 31, 23, 59), 1.0), bar(datetime(2024, 1, 1, 0, 0), 2.0)])
    write = store.write_bars

    def half(bars, where, **kw):
        write(bars.where("year = 2023"), where, **kw)
        raise RuntimeError("killed between year files")
    kw = dict(timeframe="minute", start="2023-12-31", end="2024-01-01")
    with monkeypatch.context() as m:
        m.setattr(store, "write_bars", half)
        with pytest.raises(RuntimeError):
            _run(spark, root, landing, ["X:B"], run_id="a", **kw)
    assert volumes(spark, root) == [1.0]
    assert _run(spark, root, landing, ["X:B"], run_id="b", **kw).bars_written == 1
    assert volumes(spark, root) == [1.0, 2.0] and store.read_manifest(spark, root).first()["bar_count"] == 2


def test_the_bar_of_its_own_day_is_provisional(spark, scratch):
    """A daily bar fetched on its own day waits, also when its day is over, until a
    later attempt brings the whole one."""
    root, landing, ckpt = f"{scratch}/lake", f"{scratch}/landing", f"{scratch}/ckpt"
    kw = dict(asset_class="crypto", timeframe="daily")
    land(landing, "X:B", "a", [bar(datetime(2024, 1, 9), 1.0), bar(datetime(2024, 1, 10), 5.0)])
    date_file(landing, "X:B", "a", datetime(2024, 1, 10, 15))
    for now in ("2024-01-10 16:00:00", "2024-01-11 01:00:00"):
        update.run_update(spark, landing, root, ckpt, now=now, **kw)
    assert volumes(spark, root) == [1.0]
    land(landing, "X:B", "b", [{**bar(datetime(2024, 1, 10), 9.0), "attempt": 1704934800000}])  # 11 January 01:00
    update.run_update(spark, landing, root, ckpt, now="2024-01-11 02:00:00", **kw)
    assert volumes(spark, root) == [1.0, 9.0] and backfill.read_pending(spark, root, "crypto", "daily").count() == 0


def test_an_error_does_not_outlive_a_good_attempt(spark, scratch):
    root, landing = f"{scratch}/lake", f"{scratch}/landing"
    kw = dict(timeframe="daily", start="2024-01-01", end="2024-01-02")
    land(landing, "X:B", "a", [{"error": "timeout"}])
    first = _run(spark, root, landing, ["X:B"], run_id="a", **kw)
    assert (first.errors, first.exit_code, first.files_opened) == (1, 2, 1)
    land(landing, "X:B", "b", [bar(datetime(2024, 1, 1), 1.0), bar(datetime(2024, 1, 2), 2.0)])
    second = _run(spark, root, landing, ["X:B"], run_id="b", **kw)
    assert (second.succeeded, second.exit_code, second.files_opened) == (1, 0, 1) and volumes(spark, root) == [1.0, 2.0]


def test_bars_of_a_failed_attempt_are_not_taken(spark, scratch):
    root, landing = f"{scratch}/lake", f"{scratch}/landing"
    land(landing, "X:B", "a", [bar(datetime(2024, 1, 1), 1.0), {"error": "timeout on page 2"}])
    out = _run(spark, root, landing, ["X:B"], timeframe="daily", start="2024-01-01", end="2024-01-02", run_id="a")
    assert (out.errors, out.bars_written) == (1, 0)


def test_a_line_that_does_not_parse_is_quarantined(spark, scratch):
    root, landing, ckpt = f"{scratch}/lake", f"{scratch}/landing", f"{scratch}/ckpt"
    land(landing, "X:B", "a", [bar(datetime(2024, 1, 1), 1.0), {"o": 1.0}, bar(datetime(9999, 1, 1), 1.0),
                               {**bar(datetime(2024, 1, 2), 2.0), "v": "many"}])
    with open(f"{landing}/symbol=X:B/a.json", "a") as f:
        f.write('{"o": 1.0, "t": \n')
    for now in ("2024-01-03 01:00:00", "2024-01-04 01:00:00"):
        update.run_update(spark, landing, root, ckpt, asset_class="crypto", timeframe="daily", now=now)
    assert volumes(spark, root) == [1.0]
    rows = backfill.read_quarantine(spark, root).collect()
    assert sorted(r["reason"] for r in rows) == ["corrupt record", "corrupt record", "record without time", "time that no bar can have"]
    assert {r["symbol"] for r in rows} == {"X:B"} and all(r["record"] and r["file"].endswith("a.json") for r in rows)
    assert json.loads(next(r["record"] for r in rows if r["reason"] == "record without time")) == {"o": 1.0}


def test_authentication_that_was_mended_does_not_abort(spark, scratch):
    root, landing = f"{scratch}/lake", f"{scratch}/landing"
    kw = dict(timeframe="daily", start="2024-01-01", end="2024-01-01")
    land(landing, "A", "a", [{"error": "x", "error_kind": "auth"}])
    land(landing, "B", "a", [bar(datetime(2024, 1, 1), 1.0)])
    date_file(landing, "B", "a", datetime(2024, 1, 3))  # before the failure
    with pytest.raises(backfill.FatalFetchError):
        _run(spark, root, landing, ["A", "B"], run_id="a", **kw)
    land(landing, "A", "b", [{**bar(datetime(2024, 1, 1), 2.0), "attempt": 4102444800000}])
    out = _run(spark, root, landing, ["A", "B"], run_id="b", **kw)
    assert (out.succeeded, out.files_opened) == (2, 3) and volumes(spark, root) == [2.0, 1.0]


def test_the_stream_goes_on_after_a_failed_authentication(spark, scratch):
    root, landing, ckpt = f"{scratch}/lake", f"{scratch}/landing", f"{scratch}/ckpt"
    kw = dict(asset_class="crypto", timeframe="daily")
    land(landing, "B", "a", [bar(datetime(2024, 1, 1), 1.0)])
    date_file(landing, "B", "a", datetime(2024, 1, 3))
    land(landing, "A", "a", [{"error": "x", "error_kind": "auth"}])
    with pytest.raises(backfill.FatalFetchError):
        update.run_update(spark, landing, root, ckpt, now="2024-01-03 01:00:00", **kw)
    assert volumes(spark, root) == []
    land(landing, "A", "b", [bar(datetime(2024, 1, 1), 2.0)])
    assert update.run_update(spark, landing, root, ckpt, now="2024-01-03 02:00:00", **kw) == 1
    assert volumes(spark, root) == [2.0, 1.0]


def test_one_table_does_not_stop_the_others(spark, scratch):
    root, landing, ckpt = f"{scratch}/lake", f"{scratch}/landing", f"{scratch}/ckpt"
    for asset in ("crypto", "stocks"):
        land(f"{landing}/{asset}/daily", "S", "a", [bar(datetime(2024, 1, 3, 5), 1.0)])
        update.run_update(spark, f"{landing}/{asset}/daily", root, f"{ckpt}/{asset}-daily", asset_class=asset, timeframe="daily",
                          now="2024-01-04 12:00:00")
        land(f"{landing}/{asset}/daily", "S", "b", [bar(datetime(2024, 1, 4, 5), 2.0)])
    land(f"{landing}/crypto/daily", "S", "c", [{"error": "x", "error_kind": "auth", "attempt": 4102444800000}])
    with pytest.raises(update.UpdateError) as caught:
        update.update_all(spark, landing, root, ckpt, now="2024-01-05 12:00:00")
    assert list(caught.value.failed) == [("crypto", "daily")] and caught.value.done == {("stocks", "daily"): 1}
    log = {(r["run_id"].split("-")[1], r["status"]) for r in spark.read.parquet(store.table_path(root, "run_log")).collect()}
    assert ("crypto", "aborted") in log and store.read_bars(spark, root, asset_class="stocks").count() == 2


def test_inline_validation_and_corporate_actions_of_the_update(spark, scratch):
    root, landing, ckpt = f"{scratch}/lake", f"{scratch}/landing", f"{scratch}/ckpt"
    folder, kw = f"{landing}/stocks/daily", dict(asset_class="stocks", timeframe="daily")
    land(folder, "A", "a", [{**bar(datetime(2024, 1, 3, 5), 1.0), "l": 3.0}, {**bar(datetime(2024, 1, 2, 5), 1.0), "v": None},
                            bar(datetime(2024, 1, 2, 5), 4.0)])
    land(folder, "B", "a", [bar(datetime(2024, 1, 3, 5), 1.0)])
    # The policy drops the bar; what was wrong with it is on record all the same.
    update.run_update(spark, folder, root, f"{ckpt}/stocks-daily", now="2024-01-04 12:00:00", ohlc="drop", **kw)
    found = {(r["symbol"], r["check"], str(r["day"])) for r in backfill.read_findings(spark, root).collect()}
    assert {("A", "ohlc", "2024-01-03"), ("A", "duplicate", "2024-01-02")} <= found and not any(s == "B" for s, _, _ in found)
    before = backfill.read_findings(spark, root).count()
    land(folder, "B", "b", [bar(datetime(2024, 1, 4, 5), 2.0)])
    splits = spark.createDataFrame([("A", date(2024, 1, 2), 1.0, 4.0, 4.0)],
                                   "symbol string, execution_date date, split_from double, split_to double, ratio double")
    with pytest.raises(update.UpdateError) as caught:  # a table without its columns stops neither bars nor splits
        update.update_all(spark, landing, root, ckpt, now="2024-01-05 12:00:00",
                          corporate_actions={"dividends": splits.select("symbol"), "splits": splits})
    assert list(caught.value.failed) == [("actions", "dividends")]
    assert caught.value.done == {("stocks", "daily"): 1, ("actions", "splits"): 1}
    assert actions.read(spark, root, "splits").count() == 1
    assert backfill.read_findings(spark, root).count() == before  # a clean batch adds none
    assert update.update_all(spark, landing, root, ckpt, now="2024-01-05 13:00:00", corporate_actions={"splits": splits}) \
        == {("stocks", "daily"): 0, ("actions", "splits"): 2}
    assert actions.read(spark, root, "splits").count() == 1


def test_inline_validation_of_a_backfill(spark, scratch):
    root, landing = f"{scratch}/lake", f"{scratch}/landing"
    kw = dict(asset_class="crypto", timeframe="daily", default_start="2024-01-01", now="2024-01-05 12:00:00", validate=True)
    land(landing, "A", "a", [{"error": "x", "error_kind": "server"}])
    out = backfill.run(spark, root, _universe(spark, "A"), landing, target_end="2024-01-02", run_id="a", **kw)
    assert (out.errors, out.findings) == (1, 0)
    land(landing, "A", "b", [{**bar(datetime(2024, 1, 1), 1.0), "h": 0.1, "attempt": 4102444800000}])
    out = backfill.run(spark, root, _universe(spark, "A"), landing, target_end="2024-01-02", run_id="b", **kw)
    rows = backfill.read_findings(spark, root).collect()
    assert out.bars_written == 1 and out.findings == len(rows) > 0
    assert {(r["symbol"], r["check"], r["run_id"]) for r in rows} == {("A", "ohlc", "b")}


def test_policies_of_the_update(spark, scratch):
    root, landing, ckpt = f"{scratch}/lake", f"{scratch}/landing", f"{scratch}/ckpt"
    kw = dict(asset_class="crypto", timeframe="daily")
    wrong = {**bar(datetime(2024, 1, 1), 1.0), "l": 3.0}
    land(landing, "A", "a", [wrong, bar(datetime(2024, 1, 2), 2.0)])
    update.run_update(spark, landing, root, ckpt, now="2024-01-03 01:00:00", ohlc="drop", **kw)
    assert volumes(spark, root) == [2.0]


def test_files_are_opened_again_only_where_the_window_reaches_back(spark, scratch):
    root, landing = f"{scratch}/lake", f"{scratch}/landing"
    kw = dict(asset_class="crypto", timeframe="daily", target_end="2024-01-03", now="2024-01-05 00:00:00")
    for i, day in enumerate((1, 2, 3)):
        land(landing, "X:[B]{1}", f"f{i}", [bar(datetime(2024, 1, day), float(day))])
    land(landing, "OTHER", "f", [bar(datetime(2024, 1, 1), 9.0)])
    got = [backfill.run(spark, root, _universe(spark, "X:[B]{1}"), landing, default_start=start, run_id=start, extend_head=True, **kw)
           for start in ("2024-01-02", "2024-01-02", "2024-01-01", "2024-01-01")]
    assert [(o.files_opened, o.bars_written) for o in got] == [(3, 2), (0, 0), (3, 1), (0, 0)]
    assert store.read_appended(spark, root, "landing_files", LANDING_FILES).where("symbol = 'OTHER'").count() == 0


def test_many_files_are_joined_to_the_scan(spark, scratch, monkeypatch):
    landing = f"{scratch}/landing"
    for i in range(4):
        land(landing, "X:A B", f"f{i}", [bar(datetime(2024, 1, 1 + i), float(i))])
    listing = L.list_files(spark, landing)
    chosen = listing.where("path LIKE '%f1%' OR path LIKE '%f3%'").withColumn("from_date", F.lit(None).cast("date"))
    for most in (100, 1):
        monkeypatch.setattr(L, "MAX_PATHS", most)
        assert sorted(r["v"] for r in L.read_chosen(spark, landing, chosen).collect()) == [1.0, 3.0]


def test_a_backfill_never_indexes_all_landed_files_on_the_driver(spark, scratch, monkeypatch):
    """Two waves of more files than one scan takes: listed and read by tasks, and what the
    reader alone can read (here an array) goes to it in batches."""
    root, landing = f"{scratch}/lake", f"{scratch}/landing"
    monkeypatch.setattr(L, "MAX_PATHS", 2)
    monkeypatch.setattr(L, "BATCH_PATHS", 2)
    read, handed = L.read_landing, []

    def watched(spark, path, *, files=None, **kw):
        handed.append(None if files is None else len(files))
        return read(spark, path, files=files, **kw)
    monkeypatch.setattr(L, "read_landing", watched)
    monkeypatch.setattr(L, "list_by_index", lambda *a: pytest.fail("all files are indexed"))
    symbols = [f"S{i}" for i in range(6)]
    for wave, day in (("a", 1), ("b", 2)):
        for i, s in enumerate(symbols):
            land(landing, s, wave, [bar(datetime(2024, 1, day), float(i))])
            if i % 2:
                with open(f"{landing}/symbol={s}/{wave}.json") as f:
                    lines = f.read().splitlines()
                with open(f"{landing}/symbol={s}/{wave}.json", "w") as f:
                    f.write(f"[{', '.join(lines)}]\n")
        out = _run(spark, root, landing, symbols, timeframe="daily", start="2024-01-01", end=f"2024-01-0{day}", run_id=wave)
        assert (out.files_opened, out.bars_written, out.errors) == (6, 6, 0)
    assert _run(spark, root, landing, symbols, timeframe="daily", start="2024-01-01", end="2024-01-02", run_id="c").files_opened in (None, 0)
    assert volumes(spark, root) == [float(i) for i in range(6) for _ in range(2)]
    assert None not in handed and sum(handed) == 6 and len(handed) > 2


ODD_NAMES = ["A", "X:[B]{1}", "a%41b", "%zz", "q?*", "b\\s", "sp ace", "Ü\xa0é", "h#a", "t`|<>\"^", "p+&=,;@!$'()~", "_u", ".h",
             "__HIVE_DEFAULT_PARTITION__", "%C3%9C", "\U0001F600"]


def rows_of(df):
    return sorted(str(tuple(r)) for r in df.collect())


def test_tasks_list_what_the_index_lists(spark, scratch):
    """Symbols, paths, times and lengths as Spark's index has them (the ledger compares them)."""
    landing = f"{scratch}/la nd"
    for n in ODD_NAMES:
        os.makedirs(f"{landing}/symbol={n}/below")
        for f in ("a [1].json", "_h.json", ".x.json", "empty.json", "y._COPYING_", "below/z.json"):
            with open(f"{landing}/symbol={n}/{f}", "w") as out:
                out.write("" if f == "empty.json" else "{}\n")
    listed = L.list_in_tasks(spark, landing)
    assert rows_of(listed) == rows_of(L.list_by_index(spark, landing)) and listed.count() == 2 * len(ODD_NAMES)
    windows = spark.createDataFrame([("A", date(2024, 1, 1))], "symbol string, from_date date")
    chosen = L.files_to_open(listed, spark.createDataFrame([], LANDING_FILES), windows)
    assert chosen.count() == 2 and "SortMergeJoin" in chosen._jdf.queryExecution().toString()  # not sent to the driver
    os.makedirs(f"{landing}/other")
    assert L.list_in_tasks(spark, landing) is None  # for Spark to judge
    assert L.list_in_tasks(spark, f"{landing}/other") is None


ODD_LINES = [b'{"o": 1.0, "t": 1}', b'{"o": 1.0, "t":', b'{"o": "x", "t": 5, "v": 2}', b'{"o": 1}{"o": 2}', b'{"t": 1.5}', b'{"t": "7"}',
             b'{"v": NaN, "h": "Infinity"}', b"{'o': 1}", b'{"o": 1,}', b'{"error": {"a": [1]}}', b'{"attempt": -60000000000000}', b'{}', b' \t{"o": 3} ',
             b'{"symbol": "Q", "O": 1}', b'null', b'5', b'[]', b'[{"o": 1}, {"t": 2}]', b'[{"o": 1}, {"t": "x"}]', b'\x0b{"o": 1}', b'{"error": "\xff"}',
             b'\xef\xbb\xbf{"o": 1}', b'{"o": 1}\r{"o": 2}\r\n', b'{"o": 1}\x00', b'{"error": "\xc2\x85\xe2\x80\xa8"}', b' \n\t\n']


def test_tasks_read_what_the_reader_reads(spark, scratch, monkeypatch):
    os.makedirs(f"{scratch}/landing/symbol=S")
    files = {f"{k}{i}.json": before + x + b"\n" for i, x in enumerate(ODD_LINES) for k, before in (("a", b""), ("b", b'{"o": 9, "t": 3}\n\n'))}
    files |= {"c.json.gz": gzip.compress(b'{"o": 4}\n'), "d.txt": b'{"o": 5}\n', "e.json": b'{"o": 6}\n' * 200}
    for name, data in files.items():
        with open(f"{scratch}/landing/symbol=S/{name}", "wb") as f:
            f.write(data)
    monkeypatch.setattr(L, "MAX_PATHS", 1)
    monkeypatch.setattr(L, "MAX_LENGTH", 1_000)
    chosen = L.list_files(spark, f"{scratch}/landing")
    left = {os.path.basename(r["_path"]) for r in L.read_in_tasks(chosen).where("_left").collect()}
    assert {"c.json.gz", "d.txt", "e.json", "a17.json", "b22.json"} <= left and not left & {"a0.json", "b1.json", "a24.json"}
    got, want = L.read_chosen(spark, f"{scratch}/landing", chosen), L.read_landing(spark, f"{scratch}/landing")
    assert got.dtypes == want.dtypes and rows_of(got) == rows_of(want)


def test_landing_is_one_visible_file_per_symbol_and_task(spark, scratch):
    """What a wave lands is read back as it was, whatever the symbols; no task listing,
    committer or writer per symbol is needed for that."""
    symbols = ["X:B/%", "A B", "S'{1}[2]^", "Ü=1", "", None]
    raw = spark.createDataFrame([(s, float(i), None if i else 7) for s in symbols for i in range(3)], "symbol string, o double, n int")
    L.write_landing(raw.repartition(3, "symbol"), f"{scratch}/plain")
    files = [os.path.join(d, f) for d, _, names in os.walk(f"{scratch}/plain") for f in names]
    assert len(files) == 5 and not [f for f in files if os.path.basename(f)[0] in "._"]
    raw.repartition(1).write.partitionBy("symbol").json(f"{scratch}/spark")
    got = [sorted((r["symbol"] or "", r["o"], r["n"]) for r in L.read_landing(spark, f"{scratch}/{n}").collect()) for n in ("plain", "spark")]
    assert got[0] == got[1] and len(got[0]) == 18
    L.write_landing(raw.where("symbol = 'A B'").repartition(1), f"{scratch}/plain")
    assert L.list_files(spark, f"{scratch}/plain").count() == 6


def test_tasks_follow_bytes_not_files(spark, scratch):
    """Two hundred small files: one listing of few tasks, and few tasks to read them."""
    from barlake.session import small_files
    L.write_landing(spark.range(400).select(F.concat(F.lit("S"), F.col("id") % 200).alias("symbol"), F.lit(1.0).alias("o")).repartition(4, "symbol"),
                    f"{scratch}/landing")
    assert int(spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")) <= 200
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    with small_files(spark):
        assert L.read_landing(spark, f"{scratch}/landing").rdd.getNumPartitions() <= 8
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before
    assert L.read_landing(spark, f"{scratch}/landing").count() == 400
