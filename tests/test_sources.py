"""Readers, writers, replay."""

import json

import pytest
from pyspark.sql import functions as F

from tests.ticks import frame, random_ticks, tick
from tickloom.operators.series import build_series
from tickloom.operators import bars
from tickloom.plans import serve
from tickloom.sources import csvfiles, lake, messages, replay
from tickloom.sources.merge_table import MergeTable
from tickloom.sources.thresholds import ThresholdStore

HEADER = "timestamp,price,volume,bid,ask,spread,direction,volatility,high,low"
LINE = " 2026-07-11 13:30:53 ,4111.500000,5.000000,4111.439563,4111.560437,0.120873, FLAT ,0.000000,4111.5,4111.5"


def test_csv_with_byte_order_mark_and_padding(spark, tmp_path):
    path = tmp_path / "gold.csv"
    path.write_text("﻿" + HEADER + "\n" + LINE + "\n", encoding="utf-8")
    got = csvfiles.read_ticks(spark, {"GOLD": str(path), "OIL": str(tmp_path / "missing.csv")}).collect()
    assert len(got) == 1
    r = got[0]
    assert (r.symbol, r.timestamp, r.event_time, r.direction) == ("GOLD", "2026-07-11 13:30:53", "2026-07-11 13:30:53", "FLAT")
    assert r.price == 4111.5 and r.spread == 0.120873


def test_csv_with_nothing_to_read(spark, tmp_path):
    assert csvfiles.read_ticks(spark, {"OIL": str(tmp_path / "missing.csv")}).count() == 0
    with pytest.raises(ValueError):
        csvfiles.read_ticks(spark, {"TIN": "x"})


def test_csv_bad_number_fails_the_load(spark, tmp_path):
    path = tmp_path / "gold.csv"
    path.write_text(HEADER + "\n" + LINE.replace("4111.500000", "n/a") + "\n")
    with pytest.raises(Exception):
        csvfiles.read_ticks(spark, {"GOLD": str(path)}).collect()


def test_csv_series_keeps_file_order_over_splits(spark, tmp_path):
    paths = {}
    for k, symbol in enumerate(["GOLD", "OIL"]):
        lines = [
            f"2026-07-11 13:{i // 600:02d}:{(i // 10) % 60:02d},{i + k},1,1,2,0.1,FLAT,0,1,1" for i in range(3000)
        ]
        paths[symbol] = str(tmp_path / f"{symbol}.csv")
        (tmp_path / f"{symbol}.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        series = csvfiles.read_series(spark, paths)
        assert series.rows.where((F.col("symbol") == "GOLD") & (F.col("price") != F.col("pos"))).count() == 0
        assert series.rows.where((F.col("symbol") == "OIL") & (F.col("price") != F.col("pos") + 1)).count() == 0
        assert series.rows.count() == 6000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_message_round_trip_and_quarantine(spark):
    ticks = lake.tick_lines(frame(spark, [tick("GOLD", 1, 0, 5.25)]))
    sent = messages.encode(ticks)
    assert sent.first().key == "GOLD_2026-07-11 13:30:00"
    assert messages.decode(sent).first().price == 5.25
    good = json.loads(sent.first().value)
    texts = [
        json.dumps(good), "not json", json.dumps({**good, "symbol": "TIN"}),
        json.dumps({**good, "price": "5.5"}), json.dumps({**good, "price": "n/a"}),
        json.dumps({**good, "event_time": "2026-07-11T13:30:00"}), json.dumps({**good, "event_time": "soon"}),
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, value string")
    reasons = {r.id: r.reason for r in messages.quarantine(df, "id").collect()}
    assert reasons == {1: "not a tick", 2: "unknown symbol", 4: "bad price", 6: "bad time"}
    decoded = {r.id: r for r in messages.decode(df, "value", "id").collect()}
    assert decoded[3].price == 5.5 and decoded[5].event_ts == decoded[0].event_ts


def test_raw_lake_as_catalog_table(spark, tmp_path):
    path = str(tmp_path / "raw")
    lake.append_json(lake.tick_lines(frame(spark, random_ticks(200))), path)
    table = lake.register_raw(spark, "raw_ticks_test", path)
    assert table.count() == 200
    assert spark.table("gold_tick").where("symbol <> 'GOLD'").count() == 0
    assert spark.table("gold_tick").count() > 0
    plan = lake.read_raw(spark, path).where("symbol = 'OIL' AND dt = DATE'2026-07-11'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(symbol" in plan


def test_layers_are_plain_sql_views(spark):
    lake.register_layers({"layer_ticks": frame(spark, [tick("GOLD", 1, 0, 5)])})
    assert spark.sql("SELECT max(price) AS m FROM layer_ticks").first().m == 5


def test_orc_overwrites_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "orc")
    day = 86400
    rows = lake.tick_lines(frame(spark, [tick("GOLD", 1, 0, 1), tick("GOLD", 2, day, 2)]))
    lake.overwrite_orc(rows, path)
    lake.overwrite_orc(lake.tick_lines(frame(spark, [tick("GOLD", 3, day, 3)])), path)
    assert sorted(r.price for r in lake.read_orc(spark, path).collect()) == [1, 3]


def test_upsert_keeps_the_later_row(spark, tmp_path):
    path = str(tmp_path / "keyed")

    def rows(*ticks):
        return frame(spark, ticks).withColumns({"timestamp": F.date_format("event_ts", "yyyy-MM-dd HH:mm"), "dt": F.to_date("event_ts")})

    tables = []

    def write(*ticks):
        changes = rows(*ticks)
        tables.append(lake.KeyedTable(spark, path, changes.schema, ["symbol", "timestamp"], ["event_ts", "seq"]))
        tables[-1].write(changes, len(tables))

    write(tick("GOLD", 1, 0, 1), tick("GOLD", 2, 1, 2), tick("OIL", 3, 0, 9), tick("GOLD", 4, 86400, 4))
    write(tick("GOLD", 5, 5, 5), tick("OIL", 0, 0, 8))
    write(tick("GOLD", 5, 5, 5))
    got = sorted((r.symbol, r.timestamp[:10], r.price) for r in tables[-1].read().collect())
    assert got == [("GOLD", "2026-07-11", 5), ("GOLD", "2026-07-12", 4), ("OIL", "2026-07-11", 9)]


def test_keyed_table_keeps_bad_times_and_survives_a_stop(spark, tmp_path):
    schema = "symbol string, timestamp string, event_ts timestamp, seq long, dt date"
    make = lambda *rows: spark.createDataFrame(list(rows), schema)
    table = lake.KeyedTable(spark, str(tmp_path / "t"), make().schema, ["symbol", "timestamp"], ["event_ts", "seq"])
    keys = lambda: sorted((r.timestamp, r.seq) for r in table.read().collect())
    assert keys() == []
    table.write(make(("GOLD", "bad 1", None, 1, None)), 0)
    table.write(make(("GOLD", "bad 2", None, 2, None)), 1)
    assert keys() == [("bad 1", 1), ("bad 2", 2)]
    table.write(make(("GOLD", "bad 2", None, 2, None)), 1)  # the epoch again
    table.compact()
    table.write(make(("GOLD", "bad 1", None, 7, None)), 2)
    assert keys() == [("bad 1", 7), ("bad 2", 2)]
    (tmp_path / "t" / "base" / "stopped").mkdir(parents=True)  # a compaction that never finished
    (tmp_path / "t" / "delta" / "main.99").mkdir()  # a batch that never finished
    assert keys() == [("bad 1", 7), ("bad 2", 2)]
    for epoch in range(3, 20):
        table.write(make(("OIL", str(epoch % 3), None, epoch, None)), epoch)
        if epoch % 5 == 4:
            table.compact()
    assert len(keys()) == 5
    table.sweep()
    assert not (tmp_path / "t" / "base" / "stopped").exists() and len(keys()) == 5
    assert len(list((tmp_path / "t" / "delta").glob("main.*"))) <= 12


def _counting(spark, path):
    """A table of sums, whose merge must take every delta exactly once."""
    schema = spark.createDataFrame([], "k string, n long").schema
    return MergeTable(spark, path, schema, F.col("k"), lambda rows: rows.groupBy("k").agg(F.sum("n").alias("n")))


def test_every_delta_counts_once_and_only_touched_buckets_are_rewritten(spark, tmp_path):
    table = _counting(spark, str(tmp_path / "t"))
    add = lambda epoch, writer, *rows: table.write(spark.createDataFrame(list(rows), "k string, n long"), epoch, writer)
    sums = lambda t=table: {r.k: r.n for r in t.read().collect()}
    add(0, "a", ("x", 1), ("y", 1), ("a/b [c]", 1), (None, 1))
    add(0, "b", ("x", 10))
    add(1, "a", ("x", 100))
    want = {"x": 111, "y": 1, "a/b [c]": 1, None: 1}
    assert sums() == want
    assert table.compact()  # a.0 only: the newest delta of each writer may come again
    assert sums() == want
    held = dict(table._manifest().base)
    add(1, "a", ("x", 100))  # the newest epoch again
    add(2, "a", ("x", 1000))
    assert table.compact() and sums() == {**want, "x": 1111}
    now = table._manifest().base
    assert now["y"] == held["y"] and now["x"] != held["x"] and set(now) == {"x", "y", "a_b__c_", "none"}
    add(0, "a", ("x", 5))  # an epoch that is in the base cannot come again; it is not counted twice
    assert sums() == {**want, "x": 1111}
    assert sums(_counting(spark, str(tmp_path / "t"))) == {**want, "x": 1111}
    assert {r.k for r in table.read(lambda bucket: bucket == "y").collect()} == {"y"}


def test_a_reader_goes_on_while_a_compaction_replaces_its_files(spark, tmp_path):
    table = _counting(spark, str(tmp_path / "t"))
    for epoch in range(3):
        table.write(spark.createDataFrame([("x", 1)], "k string, n long"), epoch)
    listed = table.read()
    table.compact()
    assert listed.first().n == 3


def test_of_two_compactions_one_gives_up(spark, tmp_path, monkeypatch):
    first, second = (_counting(spark, str(tmp_path / "t")) for _ in range(2))
    for epoch in range(3):
        first.write(spark.createDataFrame([("x", 1)], "k string, n long"), epoch)
    real = first._write

    def slow(rows, folder):
        real(rows, folder)
        assert second.compact()

    monkeypatch.setattr(first, "_write", slow)
    assert not first.compact()
    assert first.read().first().n == 3 and len(list((tmp_path / "t" / "base").glob("*"))) == 1


def test_candles_walk_backwards_over_days(spark, tmp_path):
    path = str(tmp_path / "bars")
    rows = [tick("GOLD", 100 * d + m, 86400 * d + 60 * m, d + m) for d in range(9) for m in range(4)]
    lake.append_json(bars.partial_bars(frame(spark, rows + [tick("OIL", 5000, 0, 1)])), path)
    found = lake.newest_bars(spark, path, "GOLD", 5)
    assert sorted({f.split("dt=")[1][:10] for f in found.inputFiles()}) == ["2026-07-17", "2026-07-18", "2026-07-19"]
    whole = serve.candles(lake.read_bars(spark, path), "GOLD", 5).collect()
    assert serve.candles(found, "GOLD", 5).collect() == whole and len(whole) == 5
    assert serve.candles(lake.newest_bars(spark, path, "GOLD", 500), "GOLD", 500).count() == 36
    assert lake.newest_bars(spark, path, "TIN", 5).count() == 0
    files = lake.files_by_symbol(lake.file_inventory(spark, [path]))
    counted = {r.symbol: r.lake_files for r in files.collect()}
    assert counted == {s: len(list((tmp_path / "bars" / f"symbol={s}").rglob("*.json"))) for s in ("GOLD", "OIL")}
    assert "ReadSchema: struct<path:string,length:bigint>" in files._jdf.queryExecution().executedPlan().toString()
    assert lake.file_inventory(spark, []).count() == 0


def test_thresholds_are_stored(spark, tmp_path):
    columns = "symbol string, upper double, lower double, vol_pct double"
    limits = lambda *rows: spark.createDataFrame(list(rows), columns).coalesce(1)
    defaults = limits(("GOLD", 9.0, 1.0, 5.0), ("OIL", 8.0, 2.0, 5.0))
    seen = lambda: {r.symbol: r.upper for r in ThresholdStore(spark, str(tmp_path / "t")).current(defaults).collect()}
    assert seen() == {"GOLD": 9, "OIL": 8}
    ThresholdStore(spark, str(tmp_path / "t")).put(limits(("GOLD", 7.0, 1.0, 1.0), ("GOLD", 3.0, 2.0, 1.0), ("TIN", 1.0, 0.0, 1.0)))
    assert seen() == {"GOLD": 3, "OIL": 8, "TIN": 1}
    store = ThresholdStore(spark, str(tmp_path / "t"))
    store.put(limits(("OIL", 4.0, 2.0, 1.0)))
    store.delete(["GOLD", "TIN", "NEVER"])
    assert seen() == {"GOLD": 9, "OIL": 4}
    store.put(limits(("GOLD", 2.0, 1.0, 1.0)))
    assert seen() == {"GOLD": 2, "OIL": 4}


def test_replay_order_matches_a_simulated_feed(spark):
    rows = random_ticks(500)
    series = build_series(frame(spark, rows))
    names = ["OIL", "GOLD", "GAS"]
    got = [r.seq for r in replay.round_robin(series, names).orderBy("send_order").collect()]
    queues = {s: [r.seq for r in series.rows.where(F.col("symbol") == s).orderBy("pos").collect()] for s in ("GOLD", "OIL", "GAS")}
    want = []
    for i in range(max(map(len, queues.values()))):
        want += [q[i] for q in queues.values() if i < len(q)]
    assert got == want


def test_replay_symbols():
    assert replay.chosen_symbols("gold, oil") == ["GOLD", "OIL"]
    assert len(replay.chosen_symbols(None)) == 5
    with pytest.raises(ValueError):
        replay.chosen_symbols("gold,tin")


def test_loop_shifts_or_repeats(spark):
    series = build_series(frame(spark, [tick("GOLD", 1, 0, 1), tick("GOLD", 2, 9, 2)]))
    times = sorted(r.event_ts for r in replay.loop(series, 3).collect())
    assert [(t - times[0]).seconds for t in times] == [0, 9, 10, 19, 20, 29]
    assert replay.loop(series, 3, shift=False).select("event_ts").distinct().count() == 2
