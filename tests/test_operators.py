"""Edge cases of single operators."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.ticks import START, by_symbol, frame, random_ticks, tick
from tickloom.functions.numeric import fixed
from tickloom.functions.temporal import interval_text, parse_time
from tickloom.operators import alerts, bars, correlation, detail, history, indicators, quality, ranking, risk
from tickloom.operators.series import build_series
from tickloom.plans import model, serve
from tickloom.schema import default_thresholds, uniform_thresholds


def test_open_and_close_follow_sequence_within_a_second(spark):
    rows = [tick("GOLD", 1, 0, 10), tick("GOLD", 2, 0, 11), tick("GOLD", 4, 59, 13), tick("GOLD", 3, 59, 12)]
    bar = bars.tick_bars(build_series(frame(spark, rows)).rows).first()
    assert (bar.open_price, bar.close_price, bar.tick_count) == (10, 13, 4)


def test_merged_partials_equal_one_batch(spark):
    rows = random_ticks(800)
    whole = build_series(frame(spark, rows)).rows
    split = frame(spark, rows).withColumn("batch", F.col("seq") % 7)
    merged = bars.merge_partials(bars.partial_bars(split, "1 minute", "batch"))
    direct = bars.tick_bars(whole)

    def shown(df):
        return sorted(
            (r.symbol, r.minute, r.open_price, r.high_price, r.low_price, r.close_price, round(r.avg_price, 9),
             r.total_volume, r.tick_count, r.dt) for r in df.collect()
        )

    assert shown(merged) == shown(direct)


def test_sliding_bars_cover_each_tick_size_over_slide_times(spark):
    rows = random_ticks(300)
    got = bars.sliding_bars(frame(spark, rows), "5 minutes", "1 minute").agg(F.sum("tick_count")).first()[0]
    assert got == 5 * len(rows)


def test_bar_extremes_differ_by_layer(spark):
    rows = [tick("GOLD", 1, 0, 10, high=99.0, low=1.0), tick("GOLD", 2, 1, 12, high=99.0, low=1.0)]
    series = build_series(frame(spark, rows))
    lake_bar, mart_bar = bars.tick_bars(series.rows).first(), bars.summary_bars(series.rows).first()
    assert (lake_bar.high_price, lake_bar.low_price) == (99, 1)
    assert (mart_bar.high_price, mart_bar.low_price) == (12, 10)


def test_spread_and_mid_guards(spark):
    rows = [tick("GOLD", 1, 0, 0.0, bid=0.0, ask=1.0), tick("GOLD", 2, 1, 10.0, bid=9.0, ask=11.0, spread=2.0)]
    got = {r.seq: (r.spread_pct, r.mid_price) for r in detail.enrich(frame(spark, rows)).collect()}
    assert got == {1: (None, None), 2: (20.0, 10.0)}


def test_zero_prices_never_divide(spark):
    rows = [tick("GOLD", i, i, 0.0 if i % 3 else 5.0, volume=0.0) for i in range(60)]
    series = build_series(frame(spark, rows))
    assert indicators.feature_table(series).where("own").count() == 60
    assert bars.summary_bars(series.rows).count() == 1
    assert risk.max_drawdown(series).first().max_drawdown_pct == 100.0
    assert detail.with_changes(series).where("price_change_pct IS NULL").count() > 1


@pytest.mark.parametrize("prices, want", [([1, 2, 3, 4], 3), ([1, 2, 3], 2), ([5], 5), ([2.1, 2.9, 2.5, 7], 2.9)])
def test_upper_median(spark, prices, want):
    rows = [tick("GOLD", i, i, p) for i, p in enumerate(prices)]
    assert history.upper_median(frame(spark, rows)).first().median == want


def test_upper_median_random(spark):
    rows = random_ticks(2000)
    got = {r.symbol: r.median for r in history.upper_median(frame(spark, rows)).collect()}
    for symbol, rs in by_symbol(rows).items():
        prices = sorted(r["price"] for r in rs)
        assert got[symbol] == prices[len(prices) // 2]


def test_constant_series_correlates_to_zero(spark):
    rows = []
    for i in range(200):
        rows += [tick("GOLD", 10 * i, i, 5.0), tick("OIL", 10 * i + 1, i, float(i)), tick("GAS", 10 * i + 2, i, 400.0 - i)]
    series = build_series(frame(spark, rows))
    names = ("GOLD", "OIL", "GAS")
    got = {
        (r.from_symbol, r.to_symbol): r.value
        for r in correlation.correlation_matrix(correlation.aligned_samples(series, 10, names), names).collect()
    }
    assert got[("GOLD", "OIL")] == 0 and got[("GOLD", "GOLD")] == 0
    assert got[("OIL", "GAS")] == -1 and got[("GAS", "OIL")] == -1 and got[("OIL", "OIL")] == 1


def test_samples_cut_to_the_shortest_series(spark):
    rows = [tick("GOLD", i, i, i + 1) for i in range(100)] + [tick("OIL", 1000 + i, i, i + 1) for i in range(31)]
    series = build_series(frame(spark, rows))
    assert correlation.aligned_samples(series, 10, ("GOLD", "OIL")).count() == 4  # ceil(31 / 10)


def test_strength_labels(spark):
    df = spark.createDataFrame([(0.6,), (0.5,), (0.0,), (-0.5,), (-0.6,)], "r double")
    got = [r.s for r in df.select(correlation.strength(F.col("r")).alias("s")).collect()]
    assert got == ["strong positive", "weak positive", "weak negative", "weak negative", "strong negative"]


@pytest.mark.parametrize(
    "keyword, want",
    [("10-20", {2, 3}), ("15-", {3, 4}), ("-10", {1, 2}), ("UP", {3}), ("gol", {1, 2, 3}), ("", {1, 2, 3, 4}),
     ("15-x", {3, 4}), ("x-15", set())],
)
def test_search_keywords(spark, keyword, want):
    rows = [tick("GOLD", 1, 0, 5), tick("GOLD", 2, 1, 10), tick("GOLD", 3, 2, 20, direction="UP"), tick("OIL", 4, 0, 30)]
    matched = frame(spark, rows).where(ranking.search_predicate(keyword))
    assert {r.seq for r in matched.collect()} == want


def test_search_lists_symbols_in_order_and_stops_at_the_limit(spark):
    rows = [tick("OIL", 1, 0, 5), tick("GOLD", 2, 9, 6), tick("GOLD", 3, 3, 7)]
    got = ranking.search(build_series(frame(spark, rows)), "", 2).collect()
    assert [(r.symbol, r.price) for r in got] == [("GOLD", 7), ("GOLD", 6)]


def test_symbol_without_ticks(spark):
    series = build_series(frame(spark, [tick("GOLD", 1, 0, 5), tick("GOLD", 2, 1, 6)]))
    got = {r.symbol: r for r in serve.latest(series).collect()}
    assert len(got) == 5
    assert (got["GAS"].price, got["GAS"].direction, got["GAS"].volume) == (0, "N/A", 0)
    assert (got["GOLD"].price, got["GOLD"].price_change, got["GOLD"].price_change_pct) == (6, 1, 20)
    risk_rows = {r.symbol: r for r in serve.risk(series).collect()}
    assert risk_rows["OIL"].tick_count == 0 and risk_rows["OIL"].max_drawdown_pct == 0


def test_latest_ignores_ticks_older_than_a_week(spark):
    rows = [tick("GOLD", 1, 0, 5), tick("OIL", 2, 8 * 86400, 6)]
    got = {r.symbol: r.direction for r in serve.latest(build_series(frame(spark, rows))).collect()}
    assert got["GOLD"] == "N/A" and got["OIL"] == "FLAT"


def test_drawdown_directions(spark):
    rows = [tick("GOLD", i, i, p) for i, p in enumerate([10, 20, 15, 40])]
    latest = risk.latest_ticks(build_series(frame(spark, rows)), 500)
    assert risk.drawdown_of_latest(latest).first().max_drawdown_pct == 25.0
    assert risk.drawdown_of_latest(latest, newest_first=True).first().max_drawdown_pct == 75.0


def test_zero_and_missing_volatility_are_left_out(spark):
    rows = [tick("GOLD", 1, 0, 5, volatility=0.0), tick("GOLD", 2, 1, 5, volatility=0.2), tick("GOLD", 3, 2, 5, volatility=None)]
    got = risk.risk_metrics(build_series(frame(spark, rows))).first()
    assert (got.avg_volatility, got.max_volatility, got.tick_count) == (0.2, 0.2, 3)


def test_alert_kinds_and_config(spark):
    ticks = spark.createDataFrame(
        [("GOLD", START, 1, 150.0, 60.0), ("GOLD", START, 2, 0.5, -10.0), ("OIL", START, 3, 50.0, None)],
        "symbol string, event_ts timestamp, seq bigint, price double, price_change_pct double",
    )
    got = {(r.seq, r.kind, r.threshold) for r in alerts.evaluate(ticks, uniform_thresholds(spark, 100, 1, 50)).collect()}
    assert got == {(1, "upper", 100.0), (1, "volatility", 50.0), (2, "lower", 1.0)}
    changes = spark.createDataFrame([("GAS", 9.0, 1.0, 3.0)], "symbol string, upper double, lower double, vol_pct double")
    defaults = default_thresholds(spark)
    changed = alerts.upsert_thresholds(defaults, changes)
    assert changed.count() == 5 and changed.where("symbol = 'GAS'").first().upper == 9.0
    assert alerts.reset_threshold(changed, defaults, "GAS").where("symbol = 'GAS'").first().upper == 4.0


def test_candles_are_ordered_across_days(spark):
    rows = [tick("GOLD", d, d * 86400, 10 + d) for d in range(3)]
    got = serve.candles(bars.partial_bars(frame(spark, rows)), "GOLD", 2).collect()
    assert [r.bar_time for r in got] == ["2026-07-12 13:30:00", "2026-07-13 13:30:00"]
    assert {r.time for r in got} == {"13:30"}


def test_bar_averages_carry_over_days(spark):
    rows = [tick("GOLD", i, i * 40_000, i + 1) for i in range(30)]
    got = {r.minute: r for r in indicators.bar_sma(bars.tick_bars(build_series(frame(spark, rows)).rows)).collect()}
    for i in range(30):
        r = got[(START + timedelta(seconds=i * 40_000)).replace(second=0)]
        for n, value in ((5, r.sma_5), (10, r.sma_10), (20, r.sma_20)):
            want = sum(range(i - n + 2, i + 2)) / n if i >= n - 1 else None
            assert value == (pytest.approx(want) if want is not None else None)


def test_feature_warm_up_and_last_label(spark):
    rows = [tick("GOLD", i, i, 10 + i % 7, volume=1 + i % 3, direction="UP" if i % 2 else "DOWN") for i in range(30)]
    got = indicators.training_rows(build_series(frame(spark, rows))).collect()
    assert sorted(r.pos for r in got) == list(range(19, 29))
    assert all(r.label == (1 if (r.pos + 1) % 2 else 0) for r in got)


def test_zero_volume_five_ticks_ago_drops_the_row(spark):
    rows = [tick("GOLD", i, i, 10 + i % 7, volume=0.0 if i == 20 else 1.0) for i in range(30)]
    got = {r.pos for r in indicators.training_rows(build_series(frame(spark, rows))).collect()}
    assert 25 not in got and 24 in got and 26 in got


def test_constant_price_features_are_finite(spark):
    rows = [tick("GOLD", i, i, 10.0) for i in range(40)]
    row = indicators.training_rows(build_series(frame(spark, rows))).first()
    assert row.rsi == 0.0 and row.bb_pos == 0.0


def test_time_split_keeps_order(spark):
    rows = [tick("GOLD", i, i, 10 + i % 7, volume=1 + i % 3) for i in range(101)]
    got = model.labelled_rows(build_series(frame(spark, rows))).collect()
    assert max(r.pos for r in got if r.split == "train") == 80
    assert min(r.pos for r in got if r.split == "test") == 81


def test_flips_cross_blocks(spark):
    rows = [("GOLD", b, b * 10 + i, p) for b, ps in enumerate(["0011", "1", "0"]) for i, p in enumerate(map(int, ps))]
    df = spark.createDataFrame(rows, "symbol string, block bigint, pos bigint, prediction int")
    assert sorted(r.pos for r in model.prediction_flips(df).collect()) == [2, 20]


def test_model_train_save_load_score(spark, tmp_path):
    rows = [
        tick(s, 1000 * k + i, i, 10 + (i * (k + 3)) % 11, volume=1 + i % 3, direction="UP" if (i * (k + 3)) % 11 > 5 else "DOWN")
        for k, s in enumerate(["GOLD", "OIL"]) for i in range(120)
    ] + [tick("GAS", 9000 + i, i, 3 + i) for i in range(24)]
    series = build_series(frame(spark, rows))
    folder = str(tmp_path / "models")
    with pytest.raises(ValueError):
        model.load_bundle(spark, folder)
    first = model.train_bundle(series, folder, trees=2)
    second = model.train_bundle(series, folder, trees=3, shuffled=True)
    assert (first.card["version"], second.card["version"]) == (1, 2)
    assert model.load_bundle(spark, folder).card == second.card and model.load_bundle(spark, folder, 1).card == first.card
    held = model.evaluation(model.soft_vote(first.model, model.labelled_rows(series).where("split = 'test'"))).first()
    assert held.asDict() == {k: first.card[k] for k in ("accuracy", "base_rate", "row_count")}
    (tmp_path / "models" / "version=9").mkdir()  # a version without a card does not count
    got = {r.symbol: r for r in model.predict_newest(series, model.load_bundle(spark, folder, 1)).collect()}
    assert got["GAS"].prediction == "not enough data" and got["GAS"].confidence == 0
    assert got["GOLD"].prediction in ("UP", "DOWN") and got["GOLD"].model_version == 1
    assert got["GOLD"].accuracy == pytest.approx(first.card["accuracy"], abs=1e-4)
    assert got["GOLD"].prob_up + got["GOLD"].prob_down == pytest.approx(1, abs=0.002)
    # live ticks that are too few are filled from history, and score like the whole history there
    live = build_series(series.rows.where("(symbol = 'GOLD' AND pos >= 80) OR (symbol = 'OIL' AND pos >= 110)").drop("pos", "block"))
    alone = {r.symbol: r.prediction for r in model.predict_newest(live, first).collect()}
    assert alone["OIL"] == "not enough data" != alone["GOLD"]
    filled = {r.symbol: r for r in model.predict_newest(live, first, series).collect()}
    assert filled["OIL"] == got["OIL"] and filled["GOLD"].prediction == got["GOLD"].prediction


def test_random_split_is_a_partition(spark):
    rows = spark.range(500).withColumn("label", F.lit(1))
    fit, held = model.random_split(rows)
    assert fit.count() + held.count() == 500 and fit.intersect(held).isEmpty() and 50 < held.count() < 150


def test_fixed_rounding(spark):
    df = spark.createDataFrame([(1.005,), (0.125,), (-1.234567891,), (1e20,)], "x double")
    assert [r.y for r in df.select(fixed("x", 2).alias("y")).collect()] == [1.0, 0.13, -1.23, 1e20]


def test_time_layouts(spark):
    df = spark.createDataFrame([("2026-07-11 13:30:53",), ("2026-07-11T13:30:53",), ("11/07/2026",), (None,)], "t string")
    want = datetime(2026, 7, 11, 13, 30, 53)
    assert [r.p for r in df.select(parse_time("t").alias("p")).collect()] == [want, want, None, None]


def test_window_names():
    assert [interval_text(t) for t in ("1min", "5min", "1h", "2d", "10 minutes")] == [
        "1 minute", "5 minute", "1 hour", "2 day", "10 minutes"]


def test_rules_and_health(spark):
    rows = [tick("GOLD", 1, 0, 5), tick("GOLD", 2, 1, -1, direction="SIDE", bid=3.0, ask=2.0, high=9.0, low=1.0),
            tick("GOLD", 3, 2, 5, direction=None)]
    r = quality.tick_rules(frame(spark, rows)).first()
    assert (r.tick_count, r.bad_direction, r.crossed_quote, r.outside_range, r.price_not_positive) == (3, 2, 1, 1, 1)
    health = {h.layer: h.status for h in quality.layer_health({"a": frame(spark, rows), "b": frame(spark, [])}).collect()}
    assert health == {"a": "OK", "b": "EMPTY"}


def test_median_of_prices_close_together(spark):
    from tickloom.operators import history

    ticks = spark.range(4001).selectExpr("'GAS' as symbol", "3.0 + id / 4001.0D as price")
    assert history.upper_median(ticks).first().median == 3.0 + 2000 / 4001.0
    parts = (
        ticks.groupBy("symbol", "price").count().repartitionByRange(8, "symbol", "price")
        .select(F.spark_partition_id().alias("p")).distinct().count()
    )
    assert parts > 1


def test_mean_is_exact_and_safe(spark):
    from tickloom.functions.numeric import mean_of

    def mean(values):
        return spark.createDataFrame([(v,) for v in values], "x double").agg(mean_of("x").alias("m")).first().m

    assert mean([0.1] * 7 + [None]) == 0.7 / 7
    assert mean([1e8 + 0.25, -0.75, 3.5]) == (1e8 + 3.0) / 3
    assert mean([]) is None and mean([None]) is None
    assert mean([1e300, 1.0]) == 5e299
    assert mean([float("nan"), 1.0]) != mean([1.0])


def test_repeated_threshold_changes_keep_one_row(spark):
    from tickloom.operators import alerts
    from tickloom.schema import default_thresholds

    changes = spark.createDataFrame([("GOLD", 3.0, 0.5, 9.0), ("GOLD", 2.0, 0.5, 9.0)], "symbol string, upper double, lower double, vol_pct double").coalesce(1)
    got = alerts.upsert_thresholds(default_thresholds(spark), changes).collect()
    assert len(got) == 5 and [r.upper for r in got if r.symbol == "GOLD"] == [2.0]


@pytest.mark.parametrize(("keyword", "low", "high"), [
    ("10-20", 10, 20), ("10-", 10, None), ("-20", None, 20), (" 1.5 - 2 ", 1.5, 2), ("10-x", 10, None), ("10-2x", 10, None),
    ("10-20-30", 10, 20),
])
def test_keyword_ranges(spark, keyword, low, high):
    from tickloom.operators.ranking import search_predicate

    rows = spark.createDataFrame([("GOLD", "UP", p / 2) for p in range(-10, 90)], "symbol string, direction string, price double")
    got = sorted(r.price for r in rows.where(search_predicate(keyword)).collect())
    want = [p / 2 for p in range(-10, 90) if (low is None or p / 2 >= low) and (high is None or p / 2 <= high)]
    assert got == want


def test_keywords_that_are_text(spark):
    from tickloom.operators.ranking import search_predicate

    rows = spark.createDataFrame([("GOLD", "UP", 1.0), ("X-10", "DOWN", 2.0)], "symbol string, direction string, price double")
    for keyword, want in (("x-10", [2.0]), ("-", [2.0]), ("up", [1.0]), ("", [1.0, 2.0])):
        assert sorted(r.price for r in rows.where(search_predicate(keyword)).collect()) == want
