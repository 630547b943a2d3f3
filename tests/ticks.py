"""Hand-made ticks and naive single-machine versions of the operators."""

from __future__ import annotations

from datetime import datetime, timedelta

START = datetime(2026, 7, 11, 13, 30, 0)
SCHEMA = (
    "symbol string, seq bigint, event_ts timestamp, price double, volume double, bid double, ask double, "
    "spread double, direction string, volatility double, high double, low double"
)


def tick(symbol, seq, second, price, volume=1.0, **extra):
    row = {
        "symbol": symbol, "seq": seq, "event_ts": START + timedelta(seconds=second), "price": float(price),
        "volume": float(volume), "bid": price - 0.05, "ask": price + 0.05, "spread": 0.1,
        "direction": "FLAT", "volatility": 0.0, "high": float(price), "low": float(price),
    }
    row.update(extra)
    return row


def frame(spark, rows):
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], SCHEMA)


def random_ticks(count, hot_share=0.6, seed=5, hot_instant=False):
    """Most ticks belong to GOLD; with hot_instant a third of all share one second."""
    import random

    rng = random.Random(seed)
    others = ["OIL", "SILVER", "COPPER", "GAS"]
    rows = []
    for i in range(count):
        symbol = "GOLD" if rng.random() < hot_share else rng.choice(others)
        second = 5000 if hot_instant and rng.random() < 0.34 else rng.randrange(0, 200_000)
        rows.append(tick(symbol, i, second, round(rng.uniform(1, 200), 2), rng.randrange(0, 9)))
    return rows


def by_symbol(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r["symbol"], r["event_ts"], r["seq"])):
        out.setdefault(r["symbol"], []).append(r)
    return out
