"""Streaming jobs: restarts, late ticks, replayed epochs."""

import time

import pytest
from pyspark.sql import functions as F

from tests.ticks import by_symbol, frame, random_ticks, tick
from tickloom.operators import bars
from tickloom.operators.series import build_series
from tickloom.schema import uniform_thresholds
from tickloom.sources import lake, messages
from tickloom.streaming import jobs


def feed(spark, folder, rows):
    jobs.stage_messages(lake.tick_lines(frame(spark, rows)), folder)


def stream(spark, folder, **options):
    return jobs.ticks_of(jobs.file_messages(spark, folder, **options))


def messages_in(spark, folder):
    return jobs.file_messages(spark, folder)


def test_minute_split_over_batches_and_rerun_epoch(spark, tmp_path):
    src, out, cp = (str(tmp_path / n) for n in ("src", "out", "cp"))
    rows = [tick("GOLD", i, i, 10 + i) for i in range(60)]
    for part in (rows[:25], rows[25:]):
        feed(spark, src, part)
        query = jobs.ingest(messages_in(spark, src), out, cp, None)
        query.awaitTermination()
    table = lake.bar_table(spark, f"{out}/bars")
    assert table.rows().count() == 2
    merged = bars.merge_partials(table.rows()).first()
    assert (merged.open_price, merged.close_price, merged.tick_count) == (10, 69, 60)
    # the same epoch again replaces its files
    raw = lake.raw_table(spark, f"{out}/raw")
    raw.write(lake.tick_lines(frame(spark, rows[:25])), 0, str(query.id))
    assert raw.read().count() == 60


def test_partial_bars_stay_partial_through_compactions(spark, tmp_path):
    src, out, cp = (str(tmp_path / n) for n in ("src", "out", "cp"))
    rows = [tick("GOLD", i, i, 10 + i * i % 7, volume=i) for i in range(90)] + [tick("GOLD", 99, 86400, 3)]
    table = lake.bar_table(spark, f"{out}/bars")
    for k in range(0, 91, 18):
        feed(spark, src, rows[k : k + 18])
        jobs.ingest(messages_in(spark, src), out, cp, None).awaitTermination()
        table.compact()
    table.compact(finished=True)
    got = sorted(bars.merge_partials(table.read()).drop("dt").collect())
    assert got == sorted(bars.merge_partials(bars.partial_bars(frame(spark, rows))).drop("dt").collect())
    lake.compact_bars(table.read(), str(tmp_path / "orc"), before="2026-07-12")
    assert lake.read_orc(spark, str(tmp_path / "orc")).count() == 2


def test_compaction_merges_finished_days_once(spark, tmp_path):
    lake_path, table = str(tmp_path / "bars"), str(tmp_path / "table")
    day = 86400
    for batch in ([tick("GOLD", 1, 0, 5)], [tick("GOLD", 2, 1, 6), tick("GOLD", 3, day, 7)]):
        lake.append_json(bars.partial_bars(frame(spark, batch)), lake_path)
    for _ in range(2):
        lake.compact_bars(lake.read_bars(spark, lake_path), table, before="2026-07-12")
    got = lake.read_orc(spark, table).collect()
    assert [(r.open_price, r.close_price, r.tick_count) for r in got] == [(5, 6, 2)]
    lake.compact_bars(lake.read_bars(spark, lake_path), table, before="2026-07-13", since="2026-07-12")
    assert lake.read_orc(spark, table).count() == 2


def test_unreadable_messages_are_set_aside_and_counted(spark, tmp_path):
    src, out, cp = (str(tmp_path / n) for n in ("src", "out", "cp"))
    feed(spark, src, [tick("GOLD", 1, 0, 5)])
    spark.createDataFrame([("broken",), ('{"symbol": "TIN"}',)], "value string").write.mode("append").text(src)
    jobs.ingest(messages_in(spark, src), out, cp, None).awaitTermination()
    feed(spark, src, [tick("GOLD", 2, 1, 5), tick("OIL", 3, 1, 5)])
    query = jobs.ingest(messages_in(spark, src), out, cp, None)
    query.awaitTermination()
    assert lake.raw_table(spark, f"{out}/raw").read().count() == 3
    rejected = {(r.value, r.reason) for r in lake.rejected_table(spark, f"{out}/rejected").read().collect()}
    assert rejected == {("broken", "not a tick"), ('{"symbol": "TIN"}', "unknown symbol")}
    flow = {r.symbol: (r.messages, r.ticks, r.rejected) for r in lake.flow_table(spark, f"{out}/flow").read().collect()}
    assert flow == {"GOLD": (2, 2, 0), "OIL": (1, 1, 0), "TIN": (1, 0, 1), None: (1, 0, 1)}
    assert sum(p.numInputRows for p in query.recentProgress) == 2
    files = lake.files_by_symbol(lake.file_inventory(spark, [f"{out}/raw/{f}" for f in lake.raw_table(spark, f"{out}/raw").folders()]))
    assert {r.symbol: r.lake_files for r in files.collect()} == {"GOLD": 2, "OIL": 1}


def test_folders_stay_flat_over_many_micro_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "COMPACT_EVERY", 3)
    src, out, cp = (str(tmp_path / n) for n in ("src", "out", "cp"))
    for k in range(12):
        lines = lake.tick_lines(frame(spark, [tick("GOLD", k, 20 * k, 10 + k)])).coalesce(1)
        jobs.stage_messages(lines, src)
    jobs.ingest(jobs.file_messages(spark, src, 1), f"{out}/a", f"{cp}/a", None).awaitTermination()
    jobs.stream_bars(jobs.ticks_of(jobs.file_messages(spark, src, 1)), f"{out}/b", f"{cp}/b", interval=None).awaitTermination()
    for table in ("a/raw", "a/bars", "a/flow", "b"):
        assert len(list((tmp_path / "out" / table / "delta").glob("*"))) <= 9
        assert len(list((tmp_path / "out" / table / "base").glob("*"))) <= 2
        assert len(list((tmp_path / "out" / table / "manifest").glob("[0-9]*"))) <= 3
    assert lake.raw_table(spark, f"{out}/a/raw").read().count() == 12
    got = {r.minute.minute: r.tick_count for r in jobs.current_bars(spark, f"{out}/b").collect()}
    assert got == {30: 3, 31: 3, 32: 3, 33: 3}
    assert len(jobs.streamed_bars(spark, f"{out}/b").folders()) <= 5


def test_late_tick_is_dropped_and_counted(spark, tmp_path):
    src, out, cp = (str(tmp_path / n) for n in ("src", "out", "cp"))
    feed(spark, src, [tick("GOLD", 1, 0, 5), tick("GOLD", 2, 7200, 6)])
    jobs.stream_bars(stream(spark, src), out, cp, delay="1 minute", interval=None).awaitTermination()
    feed(spark, src, [tick("GOLD", 3, 1, 99), tick("GOLD", 4, 7201, 7)])
    counter = jobs.LateRows()
    spark.streams.addListener(counter)
    try:
        query = jobs.stream_bars(stream(spark, src), out, cp, delay="1 minute", interval=None)
        query.awaitTermination()
        spark._jsparkSession.sparkContext().listenerBus().waitUntilEmpty()
        for _ in range(100):
            if counter.of(query):
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(counter)
    assert counter.of(query) == 1
    got = {r.minute.strftime("%H:%M"): (r.close_price, r.tick_count) for r in jobs.current_bars(spark, out).collect()}
    assert got == {"13:30": (5, 1), "15:30": (7, 2)}


def averages_over_slices(spark, tmp_path):
    src, out, state, cp = (str(tmp_path / n) for n in ("src", "out", "state", "cp"))
    rows = sorted(random_ticks(900), key=lambda r: (r["event_ts"], r["seq"]))
    for k in range(0, 900, 300):
        feed(spark, src, rows[k : k + 300])
        jobs.moving_averages(stream(spark, src), out, state, cp, None).awaitTermination()
    got = {r.seq: r for r in spark.read.parquet(out).collect()}
    for rs in by_symbol(rows).values():
        p = [r["price"] for r in rs]
        for i, r in enumerate(rs):
            g = got[r["seq"]]
            assert g.sma_20 == (pytest.approx(sum(p[i - 19 : i + 1]) / 20) if i >= 19 else None)
            assert g.price_change == (pytest.approx(p[i] - p[i - 1]) if i else None)


def test_averages_continue_over_restarts(spark, tmp_path):
    averages_over_slices(spark, tmp_path)


def test_micro_batches_make_no_tables(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "build_series", None)
    before = len(spark.catalog.listTables())
    averages_over_slices(spark, tmp_path)
    assert len(spark.catalog.listTables()) == before


def test_averages_over_many_small_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "MICRO_ROWS", 0)
    monkeypatch.setattr(jobs, "build_series", lambda ticks: build_series(ticks, block_rows=7))
    averages_over_slices(spark, tmp_path)


def test_state_is_kept_for_two_epochs(spark, tmp_path):
    src, out, state, cp = (str(tmp_path / n) for n in ("src", "out", "state", "cp"))
    for k in range(5):
        feed(spark, src, [tick("GOLD", k, k, 10 + k)])
        jobs.moving_averages(stream(spark, src), out, state, cp, None).awaitTermination()
        assert len(list((tmp_path / "state").glob("epoch=*"))) <= 2


def test_late_tick_gets_no_average(spark, tmp_path):
    src, out, state, cp = (str(tmp_path / n) for n in ("src", "out", "state", "cp"))
    feed(spark, src, [tick("GOLD", i, i, 10 + i) for i in range(10, 30)])
    jobs.moving_averages(stream(spark, src), out, state, cp, None).awaitTermination()
    feed(spark, src, [tick("GOLD", 1, 1, 500), tick("GOLD", 40, 40, 50)])
    jobs.moving_averages(stream(spark, src), out, state, cp, None).awaitTermination()
    got = {r.seq: r for r in spark.read.parquet(out).collect()}
    assert got[1].late and got[1].sma_5 is None
    assert not got[40].late and got[40].price_change == 50 - 39


def test_keyed_upsert_replay_changes_nothing(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    feed(spark, src, [tick("GOLD", 1, 0, 5), tick("GOLD", 2, 0, 6), tick("OIL", 3, 0, 7)])
    for cp in ("cp1", "cp2"):  # a second reader from the oldest message
        jobs.keyed_upsert(stream(spark, src), out, str(tmp_path / cp), None).awaitTermination()
    got = sorted((r.symbol, r.price, r.mid_price) for r in jobs.keyed_table(spark, out).read().collect())
    assert got == [("GOLD", 6, 6), ("OIL", 7, 7)]


def test_a_new_checkpoint_and_a_second_reader_lose_nothing(spark, tmp_path):
    out = str(tmp_path / "out")
    table = jobs.keyed_table(spark, out)

    def run(src, cp, *rows):
        feed(spark, str(tmp_path / src), rows)
        jobs.keyed_upsert(stream(spark, str(tmp_path / src)), out, str(tmp_path / cp), None).awaitTermination()

    for k in range(3):
        run("src", "cp", tick("GOLD", k, k, k))
    assert table.compact()
    run("other", "new checkpoint", tick("OIL", 7, 100, 7), tick("GOLD", 9, 0, 99))
    run("third", "second reader", tick("GAS", 8, 100, 8))
    run("third", "second reader", tick("GAS", 9, 101, 9))
    want = {("GOLD", 99.0), ("GOLD", 1.0), ("GOLD", 2.0), ("OIL", 7.0), ("GAS", 8.0), ("GAS", 9.0)}
    for _ in range(3):
        assert {(r.symbol, r.price) for r in table.read().collect()} == want
        table.compact(finished=True)


def test_first_tick_of_a_key_wins_with_watermark_dedup(spark, tmp_path):
    src = str(tmp_path / "src")
    feed(spark, src, [tick("GOLD", 1, 0, 5), tick("GOLD", 2, 0, 6), tick("GOLD", 3, 1, 7)])
    query = (
        jobs.first_per_key(stream(spark, src)).writeStream.format("memory").queryName("first_keys")
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert spark.table("first_keys").groupBy("timestamp").agg(F.count("*").alias("c")).where("c > 1").count() == 0
    assert spark.table("first_keys").count() == 2


def test_alert_stream(spark, tmp_path):
    src, out, state, cp = (str(tmp_path / n) for n in ("src", "out", "state", "cp"))
    slices = ([tick("GOLD", 1, 0, 500), tick("OIL", 2, 0, 50, volatility=0.7), tick("GAS", 3, 0, 50)],
              [tick("OIL", 4, 5, 20), tick("GAS", 5, 5, 51), tick("GAS", 0, -5, 0.5)])
    for rows in slices:
        feed(spark, src, rows)
        jobs.stream_alerts(
            stream(spark, src), uniform_thresholds(spark, 100, 1, 50), out, state, cp, None
        ).awaitTermination()
    got = {(r.seq, r.kind): r.price_change_pct for r in spark.read.parquet(out).collect()}
    assert got == {(1, "upper"): None, (4, "volatility"): -60, (0, "lower"): None}


def test_messages_are_parsed_once(spark, tmp_path):
    feed(spark, str(tmp_path / "src"), [tick("GOLD", 1, 0, 5)])
    plan = jobs.ticks_of(spark.read.text(str(tmp_path / "src")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1 and "get_json_object" not in plan


def test_broker_source_names_what_is_missing(spark):
    with pytest.raises(Exception, match="kafka"):
        messages.broker_stream(spark, "broker:9092", 5000)
