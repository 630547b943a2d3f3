"""Ordered blocks against naive per-symbol loops, with hot symbols and hot instants."""

import statistics

import pytest
from pyspark.sql import functions as F

from tests.ticks import by_symbol, frame, random_ticks, tick
from tickloom.operators import detail, indicators, ranking, risk
from tickloom.operators.series import LEAD_IN, append_days, build_series, reaching
from tickloom.plans import marts


@pytest.fixture(scope="module", params=[False, True], ids=["hot-symbol", "hot-instant"])
def case(request, spark):
    rows = random_ticks(3000, hot_instant=request.param)
    return by_symbol(rows), build_series(frame(spark, rows), block_rows=256)


def test_places_are_exact(case):
    naive, series = case
    got = {(r.symbol, r.pos): r.seq for r in series.rows.collect()}
    want = {(s, i): r["seq"] for s, rs in naive.items() for i, r in enumerate(rs)}
    assert got == want


def test_blocks_bound_the_rows_of_any_group(case):
    _, series = case
    largest = series.table.groupBy("symbol", "block").count().agg(F.max("count")).first()[0]
    assert largest <= series.block_rows + LEAD_IN + 1


def test_windows_cross_block_edges(case):
    naive, series = case
    got = {
        r.seq: r
        for r in indicators.indicator_frame(
            series, sma=indicators.sma(20), mom=indicators.momentum(10), rsi=indicators.rsi(14),
            bb=indicators.bollinger_position(20),
        ).collect()
    }
    for rows in naive.values():
        p = [r["price"] for r in rows]
        for i, r in enumerate(rows):
            g = got[r["seq"]]
            assert (g.sma is None) == (i < 19) and (g.rsi is None) == (i < 14)
            if i >= 10:
                assert g.mom == pytest.approx((p[i] - p[i - 10]) / p[i - 10] * 100)
            if i >= 14:
                d = [p[j] - p[j - 1] for j in range(i - 13, i + 1)]
                up = sum(x for x in d if x > 0) / 14
                down = sum(-x for x in d if x < 0) / 14
                assert g.rsi == pytest.approx(100 - 100 / (1 + up / (down + 1e-10)))
            if i >= 19:
                w = p[i - 19 : i + 1]
                assert g.sma == pytest.approx(sum(w) / 20)
                assert g.bb == pytest.approx((p[i] - sum(w) / 20) / (statistics.stdev(w) * 2 + 1e-10))


def test_drawdown_over_blocks(case):
    naive, series = case
    got = {r.symbol: r.max_drawdown_pct for r in risk.max_drawdown(series).collect()}
    for symbol, rows in naive.items():
        peak, worst = 0.0, 0.0
        for r in rows:
            peak = max(peak, r["price"])
            worst = max(worst, (peak - r["price"]) / peak * 100)
        assert got[symbol] == pytest.approx(worst)


def test_intraday_extremes_over_blocks(case):
    naive, series = case
    got = {r.seq: (r.day_high, r.day_low) for r in detail.intraday_extremes(series).collect()}
    for rows in naive.values():
        day = None
        for r in rows:
            if r["event_ts"].date() != day:
                day, high, low = r["event_ts"].date(), r["price"], r["price"]
            high, low = max(high, r["price"]), min(low, r["price"])
            assert got[r["seq"]] == (high, low)


def test_daily_drawdown_over_blocks(case):
    naive, series = case
    got = {(r.symbol, r.dt): r.max_drawdown for r in marts.dashboard_metrics(series).collect()}
    want = {}
    for symbol, rows in naive.items():
        peak = {}
        for r in rows:
            key = (symbol, r["event_ts"].date())
            peak[key] = max(peak.get(key, 0.0), r["price"])
            want[key] = max(want.get(key, 0.0), (peak[key] - r["price"]) / peak[key] * 100)
    assert got == pytest.approx(want)


def test_next_tick_label_crosses_edges(case):
    naive, series = case
    rows = series.table.withColumn("next", F.lead("seq").over(detail.block_window())).where("own").collect()
    got = {r.seq: r.next for r in rows}
    for rs in naive.values():
        for a, b in zip(rs, [*rs[1:], None]):
            assert got[a["seq"]] == (b["seq"] if b else None)


def test_latest_rows_and_downsample(case):
    naive, series = case
    got = {}
    for r in risk.latest_ticks(series, 30, days=None).collect():
        got.setdefault(r.symbol, set()).add(r.seq)
    assert got == {s: {r["seq"] for r in rs[-30:]} for s, rs in naive.items()}
    tiles = ranking.downsample(series, 40).groupBy("symbol").agg(F.count("*").alias("c"), F.max("pos").alias("m"))
    for r in tiles.collect():
        assert r.c == min(40, len(naive[r.symbol])) and r.m == len(naive[r.symbol]) - 1


def test_block_windows_need_no_shuffle(case):
    _, series = case
    frame_ = indicators.indicator_frame(series, sma=indicators.sma(20))
    assert "Exchange" not in frame_._jdf.queryExecution().executedPlan().toString()


def test_carry_join_never_moves_the_ticks(case, spark):
    """Beyond the broadcast size only the block summaries are shuffled."""
    _, series = case
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = detail.intraday_extremes(series)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan
    ticks_side = plan[plan.index("SortMergeJoin") : plan.index("FileScan")]
    assert "Exchange" not in ticks_side


def test_layout_spreads_blocks():
    from tickloom.operators.series import MAX_BLOCK_ROWS, MIN_BLOCK_ROWS, ROWS_PER_BUCKET, _layout

    assert _layout(0, 8) == (MIN_BLOCK_ROWS, 8)
    for rows in (10_000, 5_000_000, 10**9, 2 * 10**12, 10**15):
        block_rows, buckets = _layout(rows, 8)
        assert MIN_BLOCK_ROWS <= block_rows <= MAX_BLOCK_ROWS and 8 <= buckets
        assert rows / buckets <= ROWS_PER_BUCKET
        assert rows < 500_000 or rows / block_rows / buckets >= 15


def test_warehouse_layers(spark, tmp_path):
    from tickloom.plans import warehouse

    rows = random_ticks(500)
    series = build_series(frame(spark, rows), block_rows=256)
    root = str(tmp_path / "warehouse")
    warehouse.build(series, root)
    before = {name: df.count() for name, df in warehouse.layers(spark, root).items()}
    warehouse.refresh(series, root)
    assert {name: df.count() for name, df in warehouse.layers(spark, root).items()} == before
    assert before["ods_tick"] == before["dwd_tick_detail"] == 500 and before["ads_latest_snapshot"] == 5
    warehouse.register(spark, root)
    got = spark.sql("SELECT sum(tick_count) AS n FROM dws_tick_1min").first().n
    assert got == 500


@pytest.mark.parametrize("block_rows", [1, 8, 130])
def test_long_look_backs_over_small_blocks(spark, block_rows):
    rows = random_ticks(900)
    series = build_series(frame(spark, rows), block_rows=block_rows)
    got = {
        r.seq: r
        for r in indicators.indicator_frame(
            series, mom=indicators.momentum(100), sma=indicators.sma(200), near=indicators.sma(20)
        ).collect()
    }
    assert len(got) == 900
    for rs in by_symbol(rows).values():
        p = [r["price"] for r in rs]
        for i, r in enumerate(rs):
            g = got[r["seq"]]
            assert g.mom == (pytest.approx((p[i] - p[i - 100]) / p[i - 100] * 100) if i >= 100 else None)
            assert g.sma == (pytest.approx(sum(p[i - 199 : i + 1]) / 200) if i >= 199 else None)
            assert g.near == (pytest.approx(sum(p[i - 19 : i + 1]) / 20) if i >= 19 else None)


def test_look_back_beyond_the_copies_is_refused(spark):
    from tickloom.operators.series import last_rows

    for refused in (lambda: last_rows(LEAD_IN + 1), lambda: indicators.lagged("price", LEAD_IN + 1),
                    lambda: indicators.momentum(1000), lambda: indicators.rsi(LEAD_IN),
                    lambda: build_series(frame(spark, random_ticks(5)), block_rows=0)):
        with pytest.raises(ValueError):
            refused()


def test_newest_rows_prune_the_scan(case):
    _, series = case
    for rows in (risk.latest_ticks(series, 30), marts.newest_with_change(series)):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        conditions = rows._jdf.queryExecution().optimizedPlan().toString()
        pushed = [line for line in plan.split("\n") if "FileScan" in line]
        assert all("PushedFilters" in line for line in pushed) and " >= " in conditions
        assert "Join" not in conditions and "max(event_ts" not in conditions
        assert plan.count("FileScan") == 1


def test_a_build_leaves_one_copy(spark):
    import os

    from tickloom.session import shared_dir

    root = os.path.join(shared_dir(spark).removeprefix("file:"), "tickloom")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    build_series(frame(spark, random_ticks(300)), derive=lambda s: s.table.where("own").withColumn("twice", F.col("price") * 2))
    made = sorted(name.rpartition("-")[0] for name in set(os.listdir(root)) - before)
    assert made == ["ends", "series"]


def test_same_second_ticks_keep_their_sequence(spark):
    rows = [tick("GOLD", 2, 0, 12), tick("GOLD", 1, 0, 10), tick("GOLD", 3, 0, 11)]
    series = build_series(frame(spark, rows))
    assert [r.price for r in series.rows.orderBy("pos").collect()] == [10, 12, 11]


def _mean(values):
    return sum(values) / len(values)


def test_long_look_backs_cross_many_blocks(case):
    naive, series = case
    made = indicators.long_frame(
        series, averages={"m": 700, "short": 3}, changes={"c": 300}, strengths={"s": 500}
    )
    got = {r.seq: r for r in made.collect()}
    assert len(got) == sum(map(len, naive.values()))
    seen = 0
    for rows in naive.values():
        p = [r["price"] for r in rows]
        for i, r in enumerate(rows):
            g = got[r["seq"]]
            assert (g.m is None) == (i < 699) and (g.c is None) == (i < 300) and (g.s is None) == (i < 500)
            assert g.short is None if i < 2 else g.short == pytest.approx(_mean(p[i - 2 : i + 1]))
            if i >= 699:
                assert g.m == pytest.approx(_mean(p[i - 699 : i + 1]))
                seen += 1
            if i >= 300:
                assert g.c == pytest.approx((p[i] - p[i - 300]) / p[i - 300] * 100)
            if i >= 500:
                d = [p[j] - p[j - 1] for j in range(i - 499, i + 1)]
                up, down = _mean([max(x, 0.0) for x in d]), _mean([max(-x, 0.0) for x in d])
                assert g.s == pytest.approx(100 - 100 / (1 + up / (down + 1e-10)))
    assert seen > 500


def test_long_look_backs_shuffle_no_tick(spark):
    deep = reaching(build_series(frame(spark, random_ticks(600)), block_rows=128), 300)
    assert deep.lead_in == 300 and reaching(deep, 200) is deep
    plan = indicators.long_frame(deep, averages={"m": 300})._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_long_means_of_odd_values(spark):
    rows = [tick("GOLD", i, i, 5.0) for i in range(900)]
    rows[400]["price"], rows[401]["price"], rows[402]["price"] = float("nan"), None, 1e300
    series = build_series(frame(spark, rows), block_rows=100)
    got = {r.seq: r.m for r in indicators.long_frame(series, averages={"m": 300}).collect()}
    assert got[298] is None and got[399] == 5.0 and got[899] == 5.0
    assert got[400] is None and got[701] is None and got[702] == 5.0
    with pytest.raises(ValueError):
        indicators.long_frame(series, averages={"m": 0})
    assert indicators.long_frame(build_series(frame(spark, rows[:0])), averages={"m": 300}).count() == 0


def quote_frame(spark, rows):
    return frame(spark, rows).select("symbol", "seq", "event_ts", "price", "volume", "spread")


def test_appended_days_equal_a_full_build(spark):
    rows = random_ticks(3000)
    days = sorted({r["event_ts"].date() for r in rows})
    assert len(days) >= 3
    late = [dict(r, symbol="NEW", seq=r["seq"] + 10_000) for r in rows[:300] if r["event_ts"].date() == days[-1]]
    whole = build_series(quote_frame(spark, rows + late), detail.derive_tick_columns, block_rows=256)
    series = build_series(
        quote_frame(spark, [r for r in rows if r["event_ts"].date() == days[0]]), detail.derive_tick_columns, block_rows=256
    )
    files = set(series.table.inputFiles())
    for day in days[1:]:
        more = [r for r in rows + late if r["event_ts"].date() == day]
        series = append_days(series, quote_frame(spark, more), detail.derive_tick_columns)
    assert files < set(series.table.inputFiles())

    def table(s):
        made = indicators.indicator_frame(s, sma=indicators.sma(20), rsi=indicators.rsi(14))
        kept = ("symbol", "seq", "pos", "block", "high", "low", "direction", "sma", "rsi")
        return sorted(tuple(r) for r in made.select(*kept).collect())

    assert table(series) == table(whole)
    assert {tuple(r) for r in series.ends.collect()} == {tuple(r) for r in whole.ends.collect()}
    assert append_days(series, quote_frame(spark, [])) is series
    with pytest.raises(ValueError):
        append_days(series, quote_frame(spark, rows[:1]))
