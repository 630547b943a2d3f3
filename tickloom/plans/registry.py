"""Named queries over the test tables; each takes (spark, sf_dir) and returns a DataFrame.

Only presentation happens here: timestamps and dates become text and doubles are rounded, so that
any SQL engine can reproduce the values.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.numeric import fixed
from tickloom.functions.temporal import parse_time, time_text
from tickloom.operators import alerts, bars, correlation, detail, history, indicators, quality, ranking, risk
from tickloom.operators.series import TickSeries, append_days, build_series
from tickloom.plans import marts, model, serve, warehouse
from tickloom.plans.ticks import quotes, tick_series
from tickloom.schema import NUMBER_FIELDS, TICK_FIELDS, default_thresholds, symbol_dim, uniform_thresholds
from tickloom.session import new_folder, stored
from tickloom.sources import csvfiles, lake, messages, replay
from tickloom.sources.thresholds import ThresholdStore
from tickloom.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ROWS_ONLY = {"ml_train_eval", "ml_predict_latest", "ml_prediction_flips"}


def present(df: DataFrame, digits: int = 6) -> DataFrame:
    """Text for times, fixed decimals for doubles."""
    shown = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.TimestampType):
            c = time_text(c)
        elif isinstance(field.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.DoubleType):
            c = fixed(c, digits)
        shown.append(c.alias(field.name))
    return df.select(*shown)


def query(name: str, clock: str = "dense", digits: int = 6):
    """Register a function of the tick series as a named query.

    Wide bars show 8 digits: means of cents over 32 or 64 ticks end exactly between two 6-digit values.
    """

    def wrap(fn: Callable[[TickSeries], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return present(fn(tick_series(spark, sf_dir, clock)), digits)

        QUERIES[name] = run
        return fn

    return wrap


def _spark(s: TickSeries) -> SparkSession:
    return s.table.sparkSession


# --- bars -------------------------------------------------------------------------------------
query("bars_1min")(lambda s: bars.tick_bars(s.rows))
query("dws_1min")(lambda s: bars.summary_bars(s.rows, "1 minute").drop("bar_time"))
query("dws_5min", digits=8)(lambda s: bars.summary_bars(s.rows, "5 minutes").drop("bar_time"))
query("serve_aggregates", digits=8)(lambda s: serve.aggregates(s, "15min"))
query("bars_hourly", "wide")(lambda s: bars.hourly_bars(s.rows))
query("bars_sliding", digits=8)(lambda s: bars.sliding_bars(s.rows, "5 minutes", "1 minute"))


@query("bars_merge_partials")
def _(s):
    batch = F.floor(F.unix_seconds("event_ts") / F.lit(10))
    ticks = s.rows.withColumn("batch", batch)
    return bars.merge_partials(bars.partial_bars(ticks, "1 minute", "batch"))


# --- detail layer -----------------------------------------------------------------------------
query("dwd_tick_detail", "wide")(lambda s: detail.tick_detail(s))
query("enrich_spread_mid")(
    lambda s: detail.enrich(s.rows).select("symbol", "seq", "price", "spread_pct", "mid_price")
)
query("derive_direction")(
    lambda s: detail.derive_direction(s).select("symbol", "seq", "price", "previous_price", "derived_direction")
)
query("intraday_high_low", "wide")(
    lambda s: detail.intraday_extremes(s).select("symbol", "seq", F.to_date("event_ts").alias("dt"), "day_high", "day_low")
)


@query("parse_event_time", "wide")
def _(s):
    layout = F.when(F.col("seq") % 3 == 0, F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss")).when(
        F.col("seq") % 3 == 1, time_text("event_ts")
    ).otherwise(F.date_format("event_ts", "dd/MM/yyyy HH:mm"))
    return s.rows.withColumn("text", layout).withColumn("parsed", parse_time("text")).select(
        "seq", "text", "parsed", F.to_date("parsed").alias("dt"), F.hour("parsed").alias("hour"),
        F.date_format("parsed", "HH:mm").alias("minute"), F.date_trunc("hour", "parsed").alias("hour_start"),
    )


# --- indicators -------------------------------------------------------------------------------
def _indicator(name: str, clock: str = "dense", **columns):
    def run(s):
        made = {k: v() for k, v in columns.items()}
        return indicators.indicator_frame(s, **made).select("symbol", "seq", *made)

    query(name, clock)(run)


_indicator("sma_ticks", **{f"sma_{n}": (lambda n=n: indicators.sma(n)) for n in (5, 10, 20)})
_indicator("rsi_14", rsi=lambda: indicators.rsi(14))
_indicator("bollinger_pos", bb_pos=lambda: indicators.bollinger_position(20))
_indicator(
    "momentum",
    mom5=lambda: indicators.momentum(5), mom10=lambda: indicators.momentum(10), chg1=lambda: indicators.momentum(1),
)
_indicator(
    "volume_features",
    vol_ratio=lambda: indicators.volume_ratio(5), vol_chg=lambda: indicators.momentum(5, "volume"),
)
query("sma_long")(
    lambda s: indicators.long_frame(
        s, averages={"sma_300": 300, "sma_1000": 1000}, changes={"mom_500": 500}, strengths={"rsi_400": 400}
    ).select("symbol", "seq", "sma_300", "sma_1000", "mom_500", "rsi_400")
)
query("sma_bars", "wide")(lambda s: indicators.bar_sma(bars.tick_bars(s.rows)))


def _series_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All but the last two days built, then those two days appended one by one."""
    ticks = quotes(spark, sf_dir, "wide").withColumn("dt", F.to_date("event_ts"))
    newest = ticks.agg(F.max("dt")).first()[0]
    series = build_series(ticks.where(F.col("dt") < F.date_sub(F.lit(newest), 1)), detail.derive_tick_columns)
    for back in (1, 0):
        series = append_days(series, ticks.where(F.col("dt") == F.date_sub(F.lit(newest), back)), detail.derive_tick_columns)
    made = indicators.indicator_frame(series, sma_20=indicators.sma(20))
    return present(made.select("symbol", "seq", "pos", "direction", "high", "low", "sma_20"))


QUERIES["series_append"] = _series_append

# --- risk -------------------------------------------------------------------------------------
query("max_drawdown")(lambda s: risk.max_drawdown(s))
query("max_drawdown_newest_first", "wide")(
    lambda s: risk.drawdown_of_latest(risk.latest_ticks(s, 500, 7), newest_first=True)
)
query("risk_metrics", "wide")(lambda s: serve.risk(s))
query("risk_radar", "wide")(lambda s: risk.risk_radar(risk.risk_metrics(s)))

# --- marts and history ------------------------------------------------------------------------
query("ads_dashboard_metrics", "wide")(lambda s: marts.dashboard_metrics(s))
query("ads_latest_snapshot", "wide")(lambda s: marts.latest_snapshot(s))
query("hist_stats", "wide")(lambda s: history.history_profile(s.rows))
query("hist_total_rollup")(lambda s: history.total_rollup(s.rows))

# --- serving ----------------------------------------------------------------------------------
query("serve_latest", "wide")(lambda s: serve.latest(s))
query("serve_trend")(lambda s: serve.trend(s, "GOLD"))
query("serve_volume", "wide")(lambda s: serve.volume(s))
query("serve_summary", "wide")(lambda s: serve.summary(s))
query("hist_vs_latest", "wide")(lambda s: serve.history_vs_latest(s))


def _without(s: TickSeries, symbol: str) -> TickSeries:
    """The series as if a symbol had never traded."""
    return replace(s, table=s.table.where(F.col("symbol") != symbol), ends=s.ends.where(F.col("symbol") != symbol))


# a known symbol without ticks keeps its row, with zeros
query("serve_latest_gap", "wide")(lambda s: serve.latest(_without(s, "GAS")))
query("serve_volume_gap", "wide")(lambda s: serve.volume(_without(s, "GAS")))
query("serve_summary_gap", "wide")(lambda s: serve.summary(_without(s, "GAS")))
query("hist_vs_latest_gap", "wide")(lambda s: serve.history_vs_latest(_without(s, "GAS")))
query("sample_head")(lambda s: ranking.first_rows(s, "GOLD", 5).select(
    "symbol", "event_ts", "price", "volume", "bid", "ask", "spread", "direction"))
query("trend_downsample")(lambda s: ranking.downsample(s, 800).select("symbol", "tile", "seq", "event_ts", "price"))
query("systematic_sample")(lambda s: correlation.every_nth(s, 50).select("symbol", "sample_idx", "seq", "price"))
query("search_price_range")(lambda s: ranking.search(s, "10-20"))


@query("search_half_open")
def _(s):
    found = [ranking.search(s, k).withColumn("keyword", F.lit(k)) for k in ("100-", "-1")]
    return found[0].unionByName(found[1])


@query("search_keyword")
def _(s):
    found = [ranking.search(s, k).withColumn("keyword", F.lit(k)) for k in ("up", "gol", "")]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query("dim_symbols", "wide")
def _(s):
    return symbol_dim(_spark(s)).join(s.lengths, "symbol", "left").select(
        "symbol", "name", "unit", "color", "base", F.coalesce("n", F.lit(0)).alias("tick_count")
    )


@query("serve_candles", "wide")
def _(s):
    path = new_folder(_spark(s), "bars")
    lake.append_json(bars.partial_bars(s.rows), path)
    return serve.candles(lake.newest_bars(_spark(s), path, "GOLD", 60), "GOLD", 60)


@query("source_fallback", "wide")
def _(s):
    live = bars.hourly_bars(s.rows.where(F.col("symbol").isin("GOLD", "OIL")))
    return serve.primary_or_fallback(live, bars.hourly_bars(s.rows))


@query("enough_rows_fallback")
def _(s):
    columns = ("symbol", "event_ts", "seq", "price")
    enough = (F.col("symbol") == "GOLD") | ((F.col("symbol") == "OIL") & (F.col("pos") < 24))
    return serve.enough_or_history(s.rows.where(enough).select(*columns), s.rows.select(*columns))


def _raw_path(s: TickSeries) -> str:
    path = new_folder(_spark(s), "raw")
    lake.append_json(lake.tick_lines(s.rows), path, in_time_order=True)
    return path


def _raw_lake(s: TickSeries) -> DataFrame:
    return lake.read_raw(_spark(s), _raw_path(s))


@query("data_asset_stats", "wide")
def _(s):
    path = _raw_path(s)
    files = lake.files_by_symbol(lake.file_inventory(_spark(s), [path]))
    stats = serve.asset_stats(s, lake.read_raw(_spark(s), path), files)
    return stats.withColumn("has_files", F.col("lake_files") > 0).drop("lake_files")

# --- correlation ------------------------------------------------------------------------------
query("correlation_matrix")(lambda s: correlation.correlation_matrix(correlation.aligned_samples(s)))
query("correlation_full")(lambda s: correlation.correlation_matrix(correlation.aligned_samples(s, 1)))
query("correlation_by_minute")(
    lambda s: correlation.correlation_pairs(correlation.aligned_bars(bars.tick_bars(s.rows)))
)
query("correlation_top_pairs")(lambda s: correlation.top_pairs(correlation.aligned_samples(s)))

# --- alerts -----------------------------------------------------------------------------------


def _alerts(s: TickSeries) -> DataFrame:
    return alerts.evaluate(detail.with_changes(s), uniform_thresholds(_spark(s), 100, 1, 50))


query("alerts_evaluate")(_alerts)
query("alerts_recent")(lambda s: alerts.newest_alerts(_alerts(s), 20))


def _learned_thresholds(s: TickSeries) -> DataFrame:
    """New limits for two symbols from their own history."""
    return s.rows.where(F.col("symbol").isin("GOLD", "OIL")).groupBy("symbol").agg(
        fixed(F.avg("price") * 2.0, 4).alias("upper"),
        fixed(F.avg("price") / 2.0, 4).alias("lower"),
        fixed(F.max("volatility") * 100.0, 4).alias("vol_pct"),
    )


def _threshold_store(s: TickSeries) -> ThresholdStore:
    """A store that saw a draft of the learned limits, then the limits themselves."""
    store = ThresholdStore(_spark(s), new_folder(_spark(s), "thresholds"))
    learned = _learned_thresholds(s)
    store.put(learned.withColumns({c: F.col(c) * 10 for c in ("upper", "lower", "vol_pct")}))
    store.put(learned)
    return store


query("alert_config_upsert")(lambda s: _threshold_store(s).current(default_thresholds(_spark(s))))


@query("alert_config_reset")
def _(s):
    store = _threshold_store(s)
    store.delete(["GOLD"])
    return store.current(default_thresholds(_spark(s)))

# --- sources and sinks ------------------------------------------------------------------------


def _csv_folder(s: TickSeries, price=None) -> tuple[str, dict[str, str]]:
    root = new_folder(_spark(s), "csv")
    rows = lake.tick_lines(s.rows)
    if price is not None:
        rows = rows.withColumn("price", price)
    return root, csvfiles.write_ticks(rows, root)


query("src_csv_ticks")(lambda s: csvfiles.read_ticks(_spark(s), _csv_folder(s)[1]))


@query("union_symbols", "wide")
def _(s):
    rows = csvfiles.read_ticks(_spark(s), _csv_folder(s)[1])
    return rows.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("row_count"), F.min(parse_time("timestamp")).alias("first_time"),
        F.max(parse_time("timestamp")).alias("last_time"), F.sum("volume").alias("total_volume"),
    )


@query("src_validate")
def _(s):
    text = F.when(F.col("seq") % 97 == 0, F.lit("n/a")).otherwise(F.col("price").cast("string"))
    return quality.parse_report(csvfiles.read_checked(_spark(s), _csv_folder(s, text)[0]))


@query("ods_scan", "wide")
def _(s):
    rows = _raw_lake(s).withColumn("event_ts", parse_time("event_time"))
    return lake.keep_present(
        rows, ["symbol", "seq", "event_ts", "dt", "price", "volume", "bid", "ask", "spread", "direction", "venue"]
    )


@query("dwd_roundtrip_orc", "wide")
def _(s):
    path = new_folder(_spark(s), "orc")
    rows = detail.tick_detail(s)
    lake.overwrite_orc(rows, path, in_time_order=True)
    return lake.read_orc(_spark(s), path, rows.schema).select(
        "symbol", "dt", "seq", "event_time", "price", "spread_pct", "price_change", "mid_price", "hour"
    )


def _mixed_messages(s: TickSeries) -> DataFrame:
    """seq, value: tick messages of which some are broken, retyped, incomplete or unknown."""
    kind = F.col("seq") % 50
    iso = F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss")
    changed = {
        "symbol": F.when(kind == 37, "TIN").otherwise(F.col("symbol")),
        "price": F.when(kind == 41, "n/a").otherwise(F.col("price").cast("string")),
        "volume": F.when(kind != 31, F.col("volume")),
        "event_time": F.when(kind == 23, iso).otherwise(F.col("event_time")),
    }
    fields = [changed.get(c, F.col(c)).alias(c) for c in TICK_FIELDS]
    numeric = [F.col("price") if c == "price" else f for c, f in zip(TICK_FIELDS, fields)]
    as_text = F.to_json(F.struct(*fields))
    as_number = F.to_json(F.struct(*numeric))
    return lake.tick_lines(s.rows).withColumn("event_ts", parse_time("event_time")).select(
        "seq",
        F.when(kind == 7, F.substring(as_number, 2, 30))
        .when(kind.isin(13, 41), as_text)
        .otherwise(as_number).alias("value"),
    )


query("json_decode_ticks")(
    lambda s: messages.decode(_mixed_messages(s), "value", "seq").select(
        "seq", "symbol", "price", "volume", "spread", "direction", "event_ts", "dt"
    )
)
query("json_quarantine")(lambda s: messages.quarantine(_mixed_messages(s), "seq").select("seq", "reason"))


@query("json_encode_ticks")
def _(s):
    texts = ("symbol", "event_time", "direction")
    read_back = F.json_tuple("value", *texts, *NUMBER_FIELDS).alias(*texts, *NUMBER_FIELDS)
    return messages.encode(lake.tick_lines(s.rows)).select("key", read_back).select(
        "key", *texts, *[F.col(c).cast("double").alias(c) for c in NUMBER_FIELDS]
    )


query("replay_round_robin")(lambda s: replay.round_robin(s).select("symbol", "seq", "round", "send_order"))
query("replay_loop")(lambda s: replay.loop(s, 2).select("symbol", "seq", "pass", "event_ts", "price"))


@query("upsert_latest_by_key")
def _(s):
    by_minute = s.rows.select("symbol", F.date_trunc("minute", "event_ts").alias("timestamp"), "event_ts", "seq", "price")
    return lake.latest_by_key(by_minute, ["symbol", "timestamp"], ["event_ts", "seq"]).drop("event_ts")


# --- data quality -----------------------------------------------------------------------------
query("tick_rules")(lambda s: quality.tick_rules(s.rows))


@query("layer_health", "wide")
def _(s):
    root = new_folder(_spark(s), "warehouse")
    warehouse.build(s, root)
    return quality.layer_health(
        warehouse.layers(_spark(s), root) | {"alerts_above_1e9": s.rows.where("price > 1e9")}
    )


@query("adhoc_sql", "wide")
def _(s):
    spark, root = _spark(s), new_folder(_spark(s), "views")
    lake.overwrite_orc(bars.summary_bars(s.rows, "5 minutes"), f"{root}/dws_tick_5min")
    lake.register_layers({"dws_tick_5min": lake.read_orc(spark, f"{root}/dws_tick_5min")})
    return spark.sql(
        "SELECT symbol, CAST(dt AS STRING) AS dt, sum(tick_count) AS ticks, max(high_price) AS high FROM dws_tick_5min "
        "WHERE up_count > down_count GROUP BY symbol, dt"
    )


@query("flow_reconcile")
def _(s):
    """Messages, stored ticks and rejected messages that the ingest counted, next to what its lake and the keyed table hold."""
    spark, root = _spark(s), _ingested(s)
    rows = quality.flow_counts({"lake_rows": lake.raw_table(spark, f"{root}/raw").rows(), "keyed_docs": _keyed(s).read()})
    counted = lake.flow_table(spark, f"{root}/flow").read()
    return counted.join(rows, "symbol", "left").select(
        "symbol", "messages", "ticks", "rejected", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("lake_rows", "keyed_docs")]
    )


# --- model ------------------------------------------------------------------------------------
query("ml_features")(
    lambda s: indicators.training_rows(s).select("symbol", "seq", *indicators.FEATURES, "label")
)
query("ml_label_balance")(
    lambda s: indicators.training_rows(s).groupBy("symbol").agg(
        F.count(F.lit(1)).alias("row_count"), F.avg(F.col("label").cast("double")).alias("up_share")
    )
)
query("ml_split")(lambda s: model.labelled_rows(s).select("symbol", "seq", "label", "split"))

query("ml_newest_features")(lambda s: model.newest_features(s).select("symbol", "seq", *indicators.FEATURES))
query("ml_holdout_base")(
    lambda s: model.labelled_rows(s).where("split = 'test'").agg(
        F.count(F.lit(1)).alias("row_count"), F.avg(F.col("label").cast("double")).alias("base_rate")
    )
)


@query("rule_flips")
def _(s):
    called = indicators.indicator_frame(s, sma_5=indicators.sma(5)).where("sma_5 IS NOT NULL")
    called = called.withColumn("prediction", (F.col("price") > F.col("sma_5")).cast("int"))
    return model.prediction_flips(called).select("symbol", "seq", "previous", "prediction")


_once: dict[tuple, object] = {}
_once_lock = threading.RLock()


def _one(s: TickSeries, what: str, make):
    """Make a model or stream output once per tick series and application."""
    key = (_spark(s).sparkContext.applicationId, id(s), what)
    with _once_lock:
        if key not in _once:
            _once[key] = make()
        return _once[key]


def _labelled(s: TickSeries) -> DataFrame:
    return _one(s, "labelled", lambda: stored(model.labelled_rows(s), "labelled"))


def _bundle(s: TickSeries) -> model.Bundle:
    return _one(s, "model", lambda: model.train_bundle(s, new_folder(_spark(s), "models"), rows=_labelled(s)))


query("ml_train_eval")(lambda s: model.evaluation(model.soft_vote(_bundle(s).model, _labelled(s).where("split = 'test'"))))
query("ml_predict_latest")(lambda s: model.predict_newest(s, _bundle(s), s))


@query("ml_prediction_flips")
def _(s):
    scored = stored(
        model.soft_vote(_bundle(s).model, _labelled(s)).select("symbol", "block", "pos", "seq", "event_ts", "prediction"),
        "scored",
    )
    return model.prediction_flips(scored).drop("block")


# --- streaming --------------------------------------------------------------------------------
SLICES = 3


def _arrive(s: TickSeries, lines: DataFrame, start) -> None:
    """Feed tick lines to a streaming job in time slices; the job restarts from its checkpoint
    after every slice and runs until the slice is consumed. ``start(messages)`` starts the job."""
    spark = _spark(s)
    source = new_folder(spark, "source")
    t = F.unix_timestamp(F.try_to_timestamp("event_time"))
    low, high = lines.agg(F.min(t), F.max(t)).first()
    step = (high - low) // SLICES + 1
    t = F.coalesce(t, F.lit(low))  # a message without a time comes first
    for k in range(SLICES):
        jobs.stage_messages(lines.where((t >= low + k * step) & (t < low + (k + 1) * step)), source)
        start(jobs.file_messages(spark, source)).awaitTermination()


def _ingested(s: TickSeries) -> str:
    """Folder that the ingest filled from every tick and some messages of an unknown symbol, compacted meanwhile."""

    def make():
        folder = new_folder(_spark(s), "ingest")
        lines = lake.tick_lines(s.rows)
        strange = lines.where("seq % 97 = 0").withColumn("symbol", F.lit("TIN"))
        _arrive(s, lines.unionByName(strange), lambda m: jobs.ingest(m, f"{folder}/out", f"{folder}/cp", None))
        for table in (lake.raw_table, lake.bar_table, lake.rejected_table, lake.flow_table):
            table(_spark(s), f"{folder}/out/{table.__name__.split('_')[0].replace('bar', 'bars')}").compact()
        return f"{folder}/out"

    return _one(s, "ingest", make)


@query("stream_raw_ingest")
def _(s):
    rows = lake.raw_table(_spark(s), f"{_ingested(s)}/raw").read()
    return rows.select("symbol", "seq", "event_time", "dt", "price", "volume", "bid", "ask", "direction")


query("stream_bars_partial")(
    lambda s: bars.merge_partials(lake.bar_table(_spark(s), f"{_ingested(s)}/bars").rows())
)


def _streamed_bars(s: TickSeries, size: str, slide: str | None) -> DataFrame:
    folder = new_folder(_spark(s), "streambars")
    _arrive(
        s, lake.tick_lines(s.rows),
        lambda m: jobs.stream_bars(jobs.ticks_of(m), f"{folder}/out", f"{folder}/cp", size, slide, "10 minutes", None),
    )
    return jobs.current_bars(_spark(s), f"{folder}/out")


query("stream_bars_watermark")(lambda s: _streamed_bars(s, "1 minute", None).drop("dt", "minute_end"))
query("stream_bars_sliding", digits=8)(lambda s: _streamed_bars(s, "5 minutes", "1 minute").drop("dt"))


def _keyed(s: TickSeries):
    """The keyed table after one reader of all messages, of which some have no time, a compaction, and a second reader."""

    def make():
        spark, folder = _spark(s), new_folder(_spark(s), "keyed")
        lines = lake.tick_lines(s.rows).withColumn("timestamp", F.substring("timestamp", 1, 16))
        bad = lines.where("seq % 50 = 23").withColumns(
            {"timestamp": F.concat(F.lit("bad "), "seq"), "event_time": F.lit("soon")}
        )
        _arrive(
            s, lines.unionByName(bad), lambda m: jobs.keyed_upsert(jobs.ticks_of(m), f"{folder}/out", f"{folder}/cp", None)
        )
        table = jobs.keyed_table(spark, f"{folder}/out")
        table.compact()
        _arrive(s, lines.where("seq % 3 = 0"), lambda m: jobs.keyed_upsert(jobs.ticks_of(m), f"{folder}/out", f"{folder}/cp2", None))
        return table

    return _one(s, "keyed", make)


query("stream_keyed_upsert")(
    lambda s: _keyed(s).read().select("symbol", "timestamp", "seq", "price", "spread_pct", "mid_price")
)


@query("stream_alerts")
def _(s):
    spark = _spark(s)
    folder = new_folder(spark, "streamalerts")
    limits = uniform_thresholds(spark, 100, 1, 50)
    _arrive(
        s, lake.tick_lines(s.rows),
        lambda m: jobs.stream_alerts(jobs.ticks_of(m), limits, f"{folder}/out", f"{folder}/state", f"{folder}/cp", None),
    )
    return spark.read.parquet(f"{folder}/out").drop("epoch")


@query("stream_sma_state")
def _(s):
    folder = new_folder(_spark(s), "streamsma")
    _arrive(
        s, lake.tick_lines(s.rows),
        lambda m: jobs.moving_averages(jobs.ticks_of(m), f"{folder}/out", f"{folder}/state", f"{folder}/cp", None),
    )
    return _spark(s).read.parquet(f"{folder}/out").drop("epoch", "event_ts")
